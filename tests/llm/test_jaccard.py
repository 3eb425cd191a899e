import random
import re

import pytest
from conftest import SF_SMALL
from cdclake.llm.jaccard import choose_bands, jaccard_join, one_of_each


def sets_of(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def brute(rows):
    """doc_id -> (text_class, n_copies, class_id, n_links); doc_ids are distinct."""
    sets = {k: sets_of(t) for k, t in rows}
    same = {}
    for k, s in sets.items():
        same.setdefault(s if s else k, []).append(k)
    near = {min(v): s for s, v in ((s, v) for s, v in same.items()) if isinstance(s, frozenset)}
    links = {k: [j for j in near if j != k and len(near[k] & near[j]) >= 0.8 * len(near[k] | near[j]) - 1e-9] for k in near}
    group = {}
    for k in sorted(near):
        todo = [k]
        while todo:
            x = todo.pop()
            if x not in group:
                group[x] = k
                todo += links[x]
    out = {}
    for s, v in same.items():
        for k in v:
            out[k] = (min(v), len(v), group.get(min(v), k), len(links.get(min(v), [])))
    return out


def check(spark, rows, **options):
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r["doc_id"]: tuple(r)[1:] for r in jaccard_join(df, **options).select("doc_id", "text_class", "n_copies", "class_id", "n_links").collect()}
    assert got == brute(rows)


def near_copies(n, seed=1, words=80):
    rng = random.Random(seed)
    base = [f"w{rng.randrange(10**6)}" for _ in range(words)]
    out = []
    for _ in range(n):
        x = list(base)
        for _ in range(rng.choice([0, 1, 1, 2, 3])):
            x[rng.randrange(words)] = f"v{rng.randrange(10**6)}"
        out.append(" ".join(x))
    return out


def test_banding_reaches_its_recall():
    for threshold, recall, most in ((0.8, 0.9999, 128), (0.5, 0.99, 256), (0.9, 0.999, 64)):
        bands, rows = choose_bands(threshold, recall, most)
        assert 1 - (1 - threshold**rows) ** bands >= recall and bands * rows <= most
    assert choose_bands() == (24, 5)
    with pytest.raises(ValueError):
        choose_bands(0.1, 0.9999, 8)


def test_documents_match_brute_force(spark):
    check(spark, [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()])


def test_a_hot_group_in_small_chunks_loses_no_link(spark):
    texts = near_copies(120) + near_copies(3, seed=2) + [f"other text number {i} with a few more words {i}" for i in range(20)] + ["same words again and again here"] * 40
    check(spark, list(enumerate(texts)), chunk=16)


def test_edge_cases(spark):
    check(spark, [(1, None), (2, ""), (3, "  "), (4, "a"), (5, "a"), (6, "a b"), (7, "b a"), (8, "x " * 5000), (9, "x " * 4000), (10, "a b c d e"), (11, "a\tb\nc d  e")])
    rows = [(1, "a b c d e f", "k"), (1, "a b c d e f", "k"), (1, "other words that stand here now", "k"), (None, "a b c d e f", None), (None, None, None), (5, "z y x w v u", "t")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, node string").withColumnsRenamed({"node": "bucket"})
    assert jaccard_join(df).count() == len(rows) and jaccard_join(df.limit(0)).count() == 0
    left = one_of_each(df)
    assert left.columns == df.columns
    assert sorted((r["doc_id"] or 0, (r["text"] or "")[:1]) for r in left.collect()) == [(0, ""), (0, "a"), (1, "a"), (1, "o"), (5, "z")]


def test_one_document_of_each_group_stays(spark):
    rows = list(enumerate(near_copies(12) + ["a quite different text that nobody copies at all"] * 3))
    want = {v[2] for v in brute(rows).values()}
    assert {r["doc_id"] for r in one_of_each(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()} == want
