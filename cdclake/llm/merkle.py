"""Merkle manifest of a table: a tree over each group's rows, a tree over the groups, and a proof per row.

A level is a table of nodes with their place in it. The slot-zero node of
each run of siblings names its siblings' places by adding slot offsets, meets them in
an equijoin and emits the parent. Proofs come down the same levels: each run adds its
siblings to what is known of its parent. Only built-in functions; no level,
run or proof passes the driver but the one root.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .scratch import Scratch

ARITY = 16  # siblings of a run
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
BLOCK_ROWS = 200_000  # rows that one task puts in order, about
WIDTH = 32  # bytes of a digest


def hex_of(digests: Column) -> Column:
    """One or more digests, one after another, as lower-case hex text."""
    return F.lower(F.hex(digests))


def hashed(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def leaf_of(fields: list[Column]) -> Column:
    """Digest of a row's fields: each ``-`` if null, else its UTF-8 byte count, a colon and its text."""
    texts = [x.cast("string") for x in fields]
    return hashed(F.concat(*[F.when(x.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(x).cast("string"), F.lit(":"), x)) for x in texts]))


def proof_of(path: Column) -> Column:
    """Digest of all siblings of a path, from the leaf to the root, left to right (hex text)."""
    return F.sha2(F.array_join(F.transform(path, lambda x: hex_of(F.concat(x["left"], x["right"]))), ""), 256)


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its path lead to."""
    return F.aggregate(path, leaf, lambda digest, x: hashed(F.concat(hex_of(x["left"]), hex_of(digest), hex_of(x["right"]))))


def placed(rows: DataFrame, order: list[str], scratch: Scratch, name: str, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """rows with ``at`` (place in its group ``g`` by ``order``, nulls first) and ``n`` (the group's rows).

    ``order`` must tell all rows apart. Rows are dealt to blocks by ranges of (g, order), so a group
    that holds a third of all rows lies in many; a block counts its rows, and the counts of the
    blocks before it are where it begins.
    """
    spark = rows.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows.count() // block_rows))
    ranged = scratch.keep(rows.repartitionByRange(parts, "g", *order).withColumn("block", F.spark_partition_id()), f"{name}_ranged")
    sizes = ranged.groupBy("g", "block").agg(F.count("*").alias("size"))
    group = Window.partitionBy("g")
    sizes = sizes.select("g", "block", (F.sum("size").over(group.orderBy("block")) - F.col("size")).alias("begin"), F.sum("size").over(group).alias("n"))
    inner = ranged.withColumn("at", F.row_number().over(Window.partitionBy("g", "block").orderBy(*order)) - 1)
    out = inner.join(sizes, ["g", "block"]).withColumn("at", F.col("at") + F.col("begin")).drop("block", "begin")
    out = scratch.keep(out, f"{name}_placed")
    scratch.drop(f"{name}_ranged")
    return out


def _runs(nodes: DataFrame, arity: int) -> DataFrame:
    """(g, run, n, members, digest) of the level above: what slot-zero nodes meet at their siblings' places.

    n is the number of nodes of the group on the new level, members the run's digests one after another.
    """
    heads = nodes.where((F.col("n") > 1) & (F.col("at") % arity == 0)).select(
        "g", "n", F.col("at").alias("head"), F.explode(F.sequence(F.lit(0).cast("long"), F.least(F.lit(arity - 1).cast("long"), F.col("n") - 1 - F.col("at")))).alias("slot"))
    heads = heads.withColumn("sibling", F.col("head") + F.col("slot"))
    met = heads.join(nodes.select("g", F.col("at").alias("sibling"), "digest"), ["g", "sibling"])
    runs = met.groupBy("g", "head", "n").agg(F.sort_array(F.collect_list(F.struct("slot", hex_of(F.col("digest")).alias("hex")))).alias("members"))
    runs = runs.withColumn("members", F.array_join(F.transform("members", lambda x: x["hex"]), ""))
    return runs.select("g", F.expr(f"head div {arity}").alias("run"), F.expr(f"(n + {arity - 1}) div {arity}").alias("n"), F.unhex("members").alias("members"), hashed(F.col("members")).alias("digest"))


def _tree(nodes: DataFrame, arity: int, scratch: Scratch, name: str) -> tuple[list[DataFrame], DataFrame]:
    """(levels of runs, from the leaves; the top digest of every group: g, level, digest)."""
    levels: list[DataFrame] = []
    tops = [nodes.where("n = 1").select("g", F.lit(0).alias("level"), "digest")]
    most = nodes.agg(F.max("n")).first()[0] or 0
    while most > 1:
        runs = scratch.keep(_runs(nodes, arity), f"{name}{len(levels)}")
        levels.append(runs)
        nodes = runs.select("g", F.col("run").alias("at"), "n", "digest")
        tops.append(nodes.where("n = 1").select("g", F.lit(len(levels)).alias("level"), "digest"))
        most = -(-most // arity)
    return levels, reduce(DataFrame.unionByName, tops)


def _beside(members: Column, slot: Column) -> Column:
    """(left, right): a run's digests but that of ``slot``."""
    return F.struct(F.substring(members, F.lit(1), (WIDTH * slot).cast("int")).alias("left"), F.substring(members, (WIDTH * (slot + 1) + 1).cast("int"), F.octet_length(members)).alias("right"))


def _above(levels: list[DataFrame], tops: DataFrame, arity: int) -> DataFrame:
    """(g, run, members, up, top) for runs of leaves: the path from a run's parent to the root, and the group's top digest.

    A group that is one leaf has a run without members.
    """
    known = tops.where(F.col("level") == len(levels)).select("g", F.lit(0).cast("long").alias("at"), "up", F.col("digest").alias("top"))
    for k in range(len(levels) - 1, -1, -1):
        met = levels[k].select("g", F.col("run").alias("at"), "members").join(known, ["g", "at"]).withColumnRenamed("at", "run")
        ended = tops.where(F.col("level") == k).select("g", F.lit(0).cast("long").alias("at"), "up", F.col("digest").alias("top"))
        if k:
            below = levels[k - 1].where("n > 1").select("g", F.col("run").alias("at"), F.expr(f"run div {arity}").alias("run"))
            path = F.concat(F.array(_beside(F.col("members"), F.col("at") % arity)), F.col("up"))
            known = below.join(met, ["g", "run"]).select("g", "at", path.alias("up"), "top").unionByName(ended)
        else:
            known = met.unionByName(ended.withColumnRenamed("at", "run").withColumn("members", F.lit(None).cast("binary")))
    return known if levels else known.withColumnRenamed("at", "run").withColumn("members", F.lit(None).cast("binary"))


def manifest(docs: DataFrame, *, fields: tuple[str, ...] = FIELDS, group: str = "source", order: str = "doc_id", arity: int = ARITY, carry: dict[str, Column] | None = None) -> DataFrame:
    """Leaf, group root, root and proof path of every row: ``order``, leaf, subroot, root (digests as binary), path, and the ``carry`` columns.

    A leaf is the digest of ``fields``; a missing or null field counts as ``-``. In each
    group leaves ascend by ``order`` (null first, ties by leaf, so equal rows give one result). Of
    more than one node, every ``arity`` consecutive ones, the last of them fewer, become
    the digest of their hex texts; what remains is the group's root. These, ordered by group (null first, by UTF-8
    bytes), give the root likewise. path lists, from the leaf to the root, the siblings left and right
    of each step; a step without siblings has empty ones. Repeated rows are leaves of their own. An empty table has no rows. Other columns are ignored.

    The text is read once, for its digest. Places come from ranges and counts
    (``placed``), so a group that holds a third of all rows is spread.
    """
    scratch = Scratch(docs.sparkSession, "merkle")
    of = lambda x: F.col(f"`{x}`") if x in docs.columns else F.lit(None)
    g = F.when(of(group).isNull(), F.lit("")).otherwise(F.concat(F.lit("="), of(group).cast("string")))
    rows = docs.select(g.alias("g"), of(order).cast("long").alias(order), leaf_of([of(x) for x in fields]).alias("digest"), *[c.alias(f"carry_{x}") for x, c in (carry or {}).items()])
    rows = scratch.keep(rows.withColumn("row", F.monotonically_increasing_id()), "rows")
    leaves = placed(rows, [order, "digest", "row"], scratch, "leaves")
    scratch.drop("rows")
    levels, tops = _tree(leaves, arity, scratch, "run")
    tops = scratch.keep(tops, "tops")

    groups = placed(tops.select(F.lit("").alias("g"), F.col("g").alias("of"), "digest"), ["of"], scratch, "groups")
    upper, top = _tree(groups, arity, scratch, "group_run")
    root = top.select(hex_of(F.col("digest")).alias("digest")).first()
    above = _above(upper, top.withColumn("up", F.expr("array()").cast("array<struct<left:binary,right:binary>>")), arity)
    paths = _with_path(groups, above, arity).select(F.col("of").alias("g"), F.col("path").alias("up"))

    below = _above(levels, tops.join(paths, "g"), arity)
    out = _with_path(leaves, below, arity)
    return out.select(order, F.col("digest").alias("leaf"), F.col("top").alias("subroot"), F.unhex(F.lit(root[0] if root else None)).alias("root"), "path", *[F.col(f"carry_{x}").alias(x) for x in carry or {}])


def _with_path(nodes: DataFrame, above: DataFrame, arity: int) -> DataFrame:
    """Leaves with their whole path, and their group's top digest."""
    met = nodes.withColumn("run", F.expr(f"at div {arity}")).join(above, ["g", "run"])
    return met.withColumn("path", F.when(F.col("members").isNull(), F.col("up")).otherwise(F.concat(F.array(_beside(F.col("members"), F.col("at") % arity)), F.col("up"))))
