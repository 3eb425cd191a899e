"""N-gram Jaccard join by MinHash banding, with exact verification on full shingle sets."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import connected_components
from .scratch import Scratch
from .text import U, mix, pieces, shingles, utf8, words

SIZE = 5  # words in a shingle
THRESHOLD = 0.8  # least similarity of a link
RECALL = 0.9999  # target probability that a pair of exactly that similarity becomes a candidate
MOST_HASHES = 128  # upper limit of bands x rows
CHUNK = 256  # members of a bucket that one task compares with as many others


def choose_bands(threshold: float = THRESHOLD, recall: float = RECALL, most: int = MOST_HASHES) -> tuple[int, int]:
    """(bands, rows): the most rows a band for which the fewest bands that reach the recall fit in ``most`` hashes.

    A pair of similarity s meets in a band of r rows with probability s**r, so
    it is missed by b bands with (1 - s**r)**b. More rows leave fewer false candidates.
    """
    best = None
    for rows in range(1, most + 1):
        hit = threshold**rows
        bands = 1 if hit >= 1 else int(np.ceil(np.log(1 - recall) / np.log1p(-hit)))
        if bands * rows > most:
            break
        best = (bands, rows)
    if best is None:
        raise ValueError(f"no banding of {most} hashes reaches a recall of {recall} at {threshold}")
    return best


def _sets(batch: pa.RecordBatch, size: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For pieces of a batch: first row, shingle hashes, and each row's first shingle (one more than rows)."""
    data, off = utf8(batch.column("text"))
    for i, j in pieces(off):
        runs, at = shingles(*words(data[off[i] : off[j]], off[i : j + 1] - off[i]), size)
        yield i, runs, at


def _digest(found: np.ndarray) -> bytes:
    """128 bits that name a set of hashes."""
    return np.array([found.sum(dtype=np.uint64), mix(found ^ U(0x5851F42D4C957F2D)).sum(dtype=np.uint64)], np.uint64).tobytes()


def signatures(docs: DataFrame, size: int, bands: int, rows: int) -> DataFrame:
    """doc_id, text_key, node (128-bit digest of the shingle set; null without words), bands (band hashes)."""
    factors = np.random.default_rng(97).integers(1, 2**63, (bands, rows), dtype=np.uint64) * U(2) + U(1)
    steps = np.random.default_rng(98).integers(1, 2**63, rows, dtype=np.uint64) * U(2) + U(1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes: list[bytes | None] = [None] * batch.num_rows
            table = np.zeros((batch.num_rows, bands), np.uint64)
            for i, runs, at in _sets(batch, size):
                full = np.flatnonzero(np.diff(at))
                if not len(full):
                    continue
                start, buffer = at[full], np.empty_like(runs)
                for b in range(bands):
                    total = np.full(len(full), b, np.uint64)
                    for r in range(rows):
                        np.multiply(runs, factors[b, r], out=buffer)
                        total += np.minimum.reduceat(buffer, start) * steps[r]
                    table[i + full, b] = mix(total)
                for x in full:
                    nodes[i + x] = _digest(np.unique(runs[at[x] : at[x + 1]]))
            flat = pa.array(table.view(np.int64).reshape(-1))
            lists = pa.ListArray.from_arrays(pa.array(np.arange(batch.num_rows + 1, dtype=np.int32) * bands), flat)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text_key"), pa.array(nodes, pa.binary()), lists], ["doc_id", "text_key", "node", "bands"])

    return _keyed(docs).mapInArrow(run, "doc_id bigint, text_key bigint, node binary, bands array<bigint>")


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_key"), F.col("text").cast("string").alias("text"))


def shingle_sets(docs: DataFrame, size: int) -> DataFrame:
    """node, shingles (sorted distinct 64-bit hashes) of texts with words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, runs, at in _sets(batch, size):
                found = [np.unique(runs[at[x] : at[x + 1]]) for x in np.flatnonzero(np.diff(at))]
                yield pa.RecordBatch.from_arrays([pa.array([_digest(x) for x in found], pa.binary()), pa.array([x.tobytes() for x in found], pa.binary())], ["node", "shingles"])

    return docs.mapInArrow(run, "node binary, shingles binary")


def common_counts(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections, by blocks of shingles so that memory is bounded by members x block."""
    ids, index = np.unique(np.concatenate(sets), return_inverse=True)
    member = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    shared = np.bincount(index, minlength=len(ids)) > 1
    rank = np.cumsum(shared) - 1
    keep = shared[index]
    member, index = member[keep], rank[index[keep]]
    order = np.argsort(index, kind="stable")
    member, index = member[order], index[order]
    out = np.zeros((len(sets), len(sets)), np.float64)
    width = 4096
    for low in range(0, int(shared.sum()), width):
        a, b = np.searchsorted(index, [low, low + width])
        block = np.zeros((len(sets), width), np.float32)
        block[member[a:b], index[a:b] - low] = 1
        out += block @ block.T
    return out.astype(np.int64)


def _verify(threshold: float):
    def run(key: tuple, table: pa.Table) -> pa.Table:
        bucket, left, right = (x.as_py() for x in key)
        rows = {}
        for row in table.select(["node", "chunk", "buckets", "shingles"]).to_pylist():
            rows[row["node"]] = row
        nodes = sorted(rows)
        sets = [np.frombuffer(rows[x]["shingles"], np.uint64) for x in nodes]
        size = np.array([len(x) for x in sets])
        chunk = np.array([rows[x]["chunk"] for x in nodes])
        common = common_counts(sets) if len(nodes) > 1 else np.zeros((len(nodes), len(nodes)), np.int64)
        linked = common >= threshold * (size[:, None] + size[None, :] - common) - 1e-9
        linked &= (chunk[:, None] != chunk[None, :]) if left != right else True
        np.fill_diagonal(linked, False)
        if linked.any():  # each pair counts in the first bucket that it shares
            earlier = [[b for b in rows[x]["buckets"] if b < bucket] for x in nodes]
            names = {b: k for k, b in enumerate(sorted({b for x in earlier for b in x}))}
            for low in range(0, len(names), 4096):
                block = np.zeros((len(nodes), 4096), np.float32)
                for i, x in enumerate(earlier):
                    for b in x:
                        if low <= names[b] < low + 4096:
                            block[i, names[b] - low] = 1
                linked &= (block @ block.T) == 0
        links = linked.sum(1)
        root = list(range(len(nodes)))
        for i in np.flatnonzero(links):  # nodes are sorted, so the first of a linked group is its smallest
            if root[i] == i:
                todo = [i]
                while todo:
                    for j in np.flatnonzero(linked[todo.pop()]):
                        if j != i and root[j] == j:
                            root[j] = i
                            todo.append(j)
        found = np.flatnonzero(links)
        return pa.table({"node": pa.array([nodes[i] for i in found], pa.binary()), "links": pa.array(links[found], pa.int64()), "root": pa.array([nodes[root[i]] for i in found], pa.binary())})

    return run


def jaccard_join(docs: DataFrame, **options) -> DataFrame:
    """Near-duplicate links of whole texts: one row per input row.

    Columns: doc_id; text_class, the smallest doc_id with the same set of
    word runs; n_copies, rows of that set; class_id, the smallest doc_id of
    the group that links connect; n_links, how many different sets have a
    similarity of ``threshold`` or more with this one.

    Options: size, threshold, recall, chunk (see the constants above). Sets are those of runs of ``size`` words (a shorter text has one run of all
    its words), held as 64-bit hashes. Bands and rows follow from ``recall``.
    Copies are folded into one node first, so a group of copies costs one
    node. A band bucket with the same members as another is looked at once.
    Buckets are compared in pairs of chunks of ``chunk`` members, so no task
    holds a whole large bucket, and what leaves a task is a count and a root
    for each member, never the pairs.

    Null or blank texts link to nothing and are their own class, as is a null
    doc_id's blank row. Repeated rows stay repeated. Other columns are ignored.
    """
    return links_by_text(docs, **options).drop("text_key")


def links_by_text(docs: DataFrame, *, size: int = SIZE, threshold: float = THRESHOLD, recall: float = RECALL, chunk: int = CHUNK) -> DataFrame:
    """``jaccard_join`` with text_key, the hash that tells apart texts of one doc_id."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "jaccard")
    bands, rows = choose_bands(threshold, recall)
    signed = scratch.keep(signatures(docs, size, bands, rows), "signatures")
    full = signed.where("node is not null")
    classes = scratch.keep(
        full.groupBy("node").agg(F.min("doc_id").alias("text_class"), F.count("*").alias("n_copies"), F.min(F.struct("doc_id", "text_key")).alias("at"), F.min("bands").alias("bands")), "classes")

    member = classes.select("node", F.explode("bands").alias("bucket"))
    buckets = (member.groupBy("bucket").agg(F.count("*").alias("m"), F.sum(F.xxhash64("node").cast("decimal(38,0)")).alias("s"), F.bit_xor(F.xxhash64(F.lit(1), "node")).alias("x"))
               .where("m > 1").groupBy("m", "s", "x").agg(F.min("bucket").alias("bucket")).select("bucket", "m"))
    placed = scratch.keep(member.join(buckets, "bucket"), "placed")
    needed = placed.groupBy("node").agg(F.sort_array(F.collect_set("bucket")).alias("buckets"))
    wanted = classes.join(needed.select("node"), "node").select("at.doc_id", "at.text_key")
    same = lambda a, b: a["doc_id"].eqNullSafe(b["doc_id"]) & (a["text_key"] == b["text_key"])
    keyed = _keyed(docs)
    texts = keyed.join(wanted, same(keyed, wanted), "left_semi").select("text")
    sets = shingle_sets(texts, size).groupBy("node").agg(F.first("shingles").alias("shingles"))
    held = scratch.keep(needed.join(sets, "node"), "sets")

    parts = F.ceil(F.col("m") / F.lit(chunk)).cast("int")
    cut = placed.withColumn("chunk", F.pmod(F.xxhash64("node", F.lit(7)), parts).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), parts - 1)))
    cut = cut.select("node", "bucket", "chunk", F.least("chunk", "other").alias("low"), F.greatest("chunk", "other").alias("high"))
    found = (cut.join(held, "node").groupBy("bucket", "low", "high")
             .applyInArrow(_verify(threshold), "node binary, links bigint, root binary"))
    found = scratch.keep(found, "found")
    scratch.drop("placed", "sets")
    groups = connected_components(found.select(F.col("node").alias("a"), F.col("root").alias("b")), scratch)
    linked = found.groupBy("node").agg(F.sum("links").alias("n_links")).join(groups, "node").join(classes.select("node", "text_class"), "node")
    least = linked.groupBy("component").agg(F.min("text_class").alias("class_id"))
    linked = linked.join(least, "component").select("node", "n_links", "class_id")
    named = scratch.keep(
        classes.select("node", "text_class", "n_copies").join(linked, "node", "left")
        .select("node", "text_class", "n_copies", F.coalesce("class_id", "text_class").alias("class_id"), F.coalesce("n_links", F.lit(0)).alias("n_links")), "named")
    scratch.drop("found", "classes")
    blank = signed.where("node is null").select(
        "doc_id", "text_key", F.col("doc_id").alias("text_class"), F.lit(1).cast("long").alias("n_copies"), F.col("doc_id").alias("class_id"), F.lit(0).cast("long").alias("n_links"))
    return full.select("doc_id", "text_key", "node").join(named, "node").select(blank.columns).unionByName(blank)


def one_of_each(docs: DataFrame, **options) -> DataFrame:
    """docs without the rows whose class (``jaccard_join``) has a smaller doc_id; all columns stay.

    Of repeated rows with the same doc_id and text one stays. Rows without a doc_id stay, as nothing names them.
    """
    links = links_by_text(docs, **options)
    gone = links.where("doc_id <> class_id").select(F.col("doc_id").alias("__id"), F.col("text_key").alias("__key")).distinct()
    left = docs.join(gone, (docs["doc_id"].cast("long") == F.col("__id")) & (F.xxhash64(docs["text"]) == F.col("__key")), "left_anti")
    repeated = links.where("doc_id = class_id").groupBy("doc_id", "text_key").count().where("count > 1").limit(1).count()
    if repeated:
        left = left.where("doc_id is not null").dropDuplicates(["doc_id", "text"]).unionByName(left.where("doc_id is null"))
    return left


__all__ = ["choose_bands", "jaccard_join", "links_by_text", "one_of_each", "signatures", "shingle_sets"]
