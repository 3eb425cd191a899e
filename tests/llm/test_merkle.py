import hashlib
import random

from pyspark.sql import functions as F

from cdclake.llm.merkle import folded, hex_of, leaf_of, manifest, proof_of

SCHEMA = "doc_id bigint, source string, lang string, n_chars bigint, text string, leaf int, root int, path int, n int"  # clashing names


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return h(*["-" if x is None else f"{len(str(x).encode())}:{x}" for x in row[:5]])


def climb(nodes, arity=16):
    """(top, per node the siblings to it) of a list of digests."""
    paths, where, level = [[] for _ in nodes], list(range(len(nodes))), nodes
    while len(level) > 1:
        for k, at in enumerate(where):
            low = at - at % arity
            paths[k] += [x for j, x in enumerate(level[low : low + arity], low) if j != at]
            where[k] = at // arity
        level = [h(*level[i : i + arity]) for i in range(0, len(level), arity)]
    return level[0], paths


def plain(rows, arity=16):
    groups = {}
    for r in rows:
        groups.setdefault(r[1], []).append(r)
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    tops, inner = [], {}
    for s in order:
        held = sorted(groups[s], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        top, paths = climb([leaf(r) for r in held], arity)
        tops.append(top)
        inner[s] = (held, top, paths)
    root, outer = climb(tops, arity)
    return sorted((r[0], leaf(r), top, root, h(*p, *outer[k])) for k, s in enumerate(order) for held, top, paths in [inner[s]] for r, p in zip(held, paths)), root


def key(rows):
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1:]))


def check(spark, rows, **options):
    docs = spark.createDataFrame([(*r, 1, 2, 3, 4) for r in rows], SCHEMA)
    out = manifest(docs, **options).select("doc_id", hex_of(F.col("leaf")).alias("leaf"), hex_of(F.col("subroot")).alias("subroot"), hex_of(F.col("root")).alias("root"), proof_of(F.col("path")).alias("proof"), hex_of(folded(F.col("leaf"), F.col("path"))).alias("again")).collect()
    groups = {}
    for r in rows:
        groups.setdefault(r[1], []).append(r)
    want = plain_rows(rows, options.get("arity", 16))
    assert key(tuple(r)[:5] for r in out) == key(want)
    assert all(r["again"] == r["root"] for r in out)


def plain_rows(rows, arity):
    groups = {}
    for r in rows:
        groups.setdefault(r[1], []).append(r)
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    held = {s: sorted(groups[s], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r))) for s in order}
    climbed = {s: climb([leaf(r) for r in held[s]], arity) for s in order}
    root, outer = climb([climbed[s][0] for s in order], arity) if order else (None, [])
    return [(r[0], leaf(r), climbed[s][0], root, h(*p, *outer[k])) for k, s in enumerate(order) for r, p in zip(held[s], climbed[s][1])]


def test_against_a_plain_tree(spark):
    r = random.Random(3)
    sizes = {None: 3, "": 1, "a": 1, "b": 16, "c": 17, "é": 33, "hot": 600, "\U0001f600": 257}
    rows = [(i * 3 + k, s, r.choice(["en", None]), r.choice([None, 12]), r.choice([None, "", "Some Text é", "x" * 5000])) for k, (s, n) in enumerate(sizes.items()) for i in range(n)]
    rows += [rows[700]] * 40 + [(None, "hot", None, None, "no id"), (None, "hot", None, None, "no id either")]
    r.shuffle(rows)
    check(spark, rows)


def test_many_groups_and_small_arity(spark):
    check(spark, [(i, f"s{i % 37}", "en", i, f"t{i}") for i in range(200)], arity=2)
    check(spark, [(i, f"s{i}", "en", i, f"t{i}") for i in range(40)], arity=3)


def test_one_row_and_none(spark):
    check(spark, [(5, "only", None, 1, "text")])
    assert manifest(spark.createDataFrame([], SCHEMA)).count() == 0


def test_a_changed_row_does_not_lead_to_the_root(spark):
    rows = spark.createDataFrame([(i, "a", "en", 3, "Abc" if i % 2 else "abc") for i in range(50)], "doc_id long, source string, lang string, n_chars long, text string")
    lower = leaf_of([F.col("doc_id"), F.col("source"), F.col("lang"), F.col("n_chars"), F.lower("text")])
    out = manifest(rows, carry={"given": lower}).select("doc_id", (folded(F.col("given"), F.col("path")) == F.col("root")).alias("same")).collect()
    assert {r.doc_id for r in out if not r.same} == set(range(1, 50, 2))
