import random
from collections import defaultdict

from conftest import SF_SMALL
from cdclake.llm.packing import best_fit, pack


def plain(sizes, sources, clusters, capacity):
    """Best fit by looking at every bin."""
    bins, out = [], [None] * len(sizes)
    for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        fits = [(room, b) for b, (room, s, c) in enumerate(bins) if room >= sizes[i] and (sources[i] is None or sources[i] not in s) and (clusters[i] is None or clusters[i] not in c)]
        if fits:
            _, b = min(fits)
        else:
            b = len(bins)
            bins.append((capacity, set(), set()))
        room, s, c = bins[b]
        bins[b] = (room - sizes[i], s | {sources[i]}, c | {clusters[i]})
        out[i] = b
    return out


def test_the_tightest_compatible_bin_is_found():
    for seed in range(20):
        rng = random.Random(seed)
        n = 150
        args = [rng.randrange(1, 60) for _ in range(n)], [rng.choice([None, "a", "a", "b", "c", "d"]) for _ in range(n)], [rng.choice([None, *range(40)]) for _ in range(n)], 64
        assert best_fit(*args) == plain(*args)
    assert best_fit([], [], [], 8) == [] and best_fit([8, 8, 4, 4], [None] * 4, [1, 1, 2, 2], 8) == [0, 1, 2, 3]


def check(docs, rows, capacity, sources):
    bins, parts = defaultdict(list), defaultdict(list)
    for r in rows:
        bins[r["bin_id"]].append(r)
        parts[r["doc_id"]].append(r)
    for held in bins.values():
        held.sort(key=lambda r: r["bin_offset"])
        at = 0
        for r in held:
            assert r["bin_offset"] == at and r["bin_tokens"] <= capacity
            at += r["n_tokens"]
        assert at == held[0]["bin_tokens"]
        known = [sources[r["doc_id"]] for r in held if sources[r["doc_id"]] is not None]
        assert len(known) == len(set(known))
        texts = [docs[r["doc_id"]] for r in held]
        assert len({" ".join((t or "").split()) for t in texts}) == len(texts)
    for doc, held in parts.items():
        held.sort(key=lambda r: r["part"])
        assert sum(r["n_tokens"] for r in held) == len((docs[doc] or "").split()) + 1
        assert [r["start"] for r in held] == [k * capacity for k in range(len(held))] and all(r["parts"] == len(held) for r in held)


def test_whole_documents_are_packed_once(spark):
    table = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    docs = {r["doc_id"]: r for r in table.collect()}
    for options in ({}, {"capacity": 300, "shard_rows": 50}):
        rows = pack(table, **options).collect()
        assert {r["doc_id"] for r in rows} == set(docs)
        check({k: r["text"] for k, r in docs.items()}, rows, options.get("capacity", 2048), {k: r["source"] for k, r in docs.items()})


def test_edge_cases(spark):
    rows = [(1, None, None), (2, "", "s"), (3, "a " * 100, "s"), (4, "a " * 100, "s"), (5, "b", None), (5, "b", None), (None, "c d", "t")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string").withColumnRenamed("x", "y")
    out = pack(df.selectExpr("*", "1 AS bin_id", "2 AS n_tokens"), capacity=16).collect()
    assert sum(r["n_tokens"] for r in out) == sum(len((t or "").split()) + 1 for _, t, _ in rows)
    assert len({r["bin_id"] for r in out if r["doc_id"] == 5}) == 2
    assert pack(df.limit(0)).count() == 0 and pack(df.drop("source"), capacity=16).count() == len(out)
    assert pack(df.selectExpr("*", "7 AS topic"), capacity=16, cluster="topic").select("bin_id").distinct().count() == len(out)
