from collections import Counter, defaultdict

import pytest
from conftest import SF_SMALL
from cdclake.llm.mixing import DIMENSIONS, KEPT, SMOOTHING, mix, sample


def shares(rows, x, weight):
    out = defaultdict(float)
    for r in rows:
        out[r["mix"][x]] += r["mix"]["n_tokens"] * weight(r)
    whole = sum(out.values())
    return {k: v / whole for k, v in out.items()}


def test_marginals_are_met_and_tokens_kept(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    rows = mix(docs, smoothing=0.7, kept=0.5).collect()
    assert len(rows) == docs.count()
    for x in DIMENSIONS:
        raw = {k: v**0.7 for k, v in shares(rows, x, lambda r: 1).items()}
        target = {k: v / sum(raw.values()) for k, v in raw.items()}
        got = shares(rows, x, lambda r: r["mix"]["weight"])
        assert all(abs(got[k] - target[k]) <= 2e-4 * target[k] for k in target)
    total = sum(r["mix"]["n_tokens"] for r in rows)
    assert abs(sum(r["mix"]["n_tokens"] * r["mix"]["probability"] for r in rows) - 0.5 * total) < 1e-6 * total
    taken = sum(r["mix"]["n_tokens"] for r in rows if r["mix"]["sampled"])
    assert 0.35 * total < taken < 0.65 * total
    again = {r["doc_id"] for r in sample(docs, smoothing=0.7, kept=0.5).collect()}
    assert again == {r["doc_id"] for r in rows if r["mix"]["sampled"]}


def test_weights_match_plain_fitting(spark):
    cells = {("a", "en", "x"): 30, ("a", "fr", "x"): 5, ("b", "en", "y"): 10, ("b", "fr", "x"): 20, ("b", "en", "x"): 7, ("a", "fr", "y"): 3}
    rows = [(i, " ".join(["w"] * (n - 1)), *c) for i, (c, n) in enumerate(cells.items())]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string, lang string, topic string")
    targets = {"source": {"a": 0.5, "b": 0.5}, "lang": {"en": 3, "fr": 1}, "topic": {"x": 0.6, "y": 0.4}}
    got = {(r["source"], r["lang"], r["topic"]): r["mix"]["weight"] for r in mix(df, targets=targets, tolerance=1e-5).collect()}
    weight, total = dict.fromkeys(cells, 1.0), sum(cells.values())
    for _ in range(500):
        for d, x in enumerate(DIMENSIONS):
            whole = sum(targets[x].values())
            for v, share in targets[x].items():
                now = sum(cells[c] * weight[c] for c in cells if c[d] == v) / total
                for c in cells:
                    if c[d] == v:
                        weight[c] *= share / whole / now
    assert all(got[c] == pytest.approx(weight[c], rel=1e-3) for c in cells)


def test_edge_cases(spark):
    rows = [(1, None, None, None), (2, "", "s", None), (3, "a " * 50, "s", "en"), (3, "a " * 50, "s", "en"), (None, "b c", None, "en")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string, lang string").selectExpr("*", "5 AS weight", "6 AS tokens", "'t' AS value")
    out = mix(df, kept=1.0).collect()
    assert len(out) == len(rows) and all(0 <= r["mix"]["probability"] <= 1 for r in out)
    assert sample(df).columns == df.columns and mix(df.limit(0)).count() == 0
    assert mix(df.select("doc_id", "text")).count() == len(rows)
    none = mix(df, targets={"lang": {"fr": 1.0}}).collect()  # a target that no row can meet leaves no weight
    assert len(none) == len(rows)


def test_copies_meet_the_targets_at_the_defaults(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    rows = mix(docs).collect()
    assert max(r["mix"]["weight"] for r in rows) > 1 / KEPT  # cells that one copy of each document cannot fill
    for x in DIMENSIONS:
        raw = {k: v**SMOOTHING for k, v in shares(rows, x, lambda r: 1).items()}
        target = {k: v / sum(raw.values()) for k, v in raw.items()}
        got, drawn = shares(rows, x, lambda r: r["mix"]["expected"]), shares(rows, x, lambda r: r["mix"]["copies"])
        assert all(abs(got[k] - target[k]) <= 2e-4 * target[k] and abs(drawn[k] - target[k]) < 0.05 for k in target)
    total = sum(r["mix"]["n_tokens"] for r in rows)
    assert abs(sum(r["mix"]["n_tokens"] * r["mix"]["expected"] for r in rows) - KEPT * total) < 1e-3 * total
    assert all(abs(r["mix"]["copies"] - r["mix"]["expected"]) < 1 for r in rows)
    again = Counter(r["doc_id"] for r in sample(docs, repeats=True).collect())
    assert again == Counter({r["doc_id"]: r["mix"]["copies"] for r in rows if r["mix"]["copies"]}) and max(again.values()) > 1


def test_marginals_that_contradict_each_other_are_reported(spark, caplog):
    rows = [(1, "w " * 49, "a", "de", "t"), (2, "w " * 39, "b", "en", "t"), (3, "w " * 9, "b", "fr", "t")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string, lang string, topic string")
    targets = {"source": {"a": 0.5, "b": 0.5}, "lang": {"de": 0.4, "en": 0.4, "fr": 0.2}}  # only a has de, and a has only de
    with caplog.at_level("WARNING", "cdclake.llm.mixing"):
        got = shares(mix(df, targets=targets, sweeps=3).collect(), "lang", lambda r: r["mix"]["weight"])
    assert got["de"] == pytest.approx(0.4) and "after 3 sweeps" in caplog.text and "source 0.2" in caplog.text
    caplog.clear()
    mix(df, targets={"source": targets["source"]}, smoothing=1.0)
    assert not caplog.text


def test_a_column_named_mix_stays(spark):
    docs = spark.createDataFrame([(i, f"word {i}", "en", "s", i) for i in range(50)], "doc_id long, text string, lang string, source string, mix int")
    for out in (sample(docs), sample(docs, repeats=True)):
        assert out.columns == docs.columns and all(r["mix"] == r["doc_id"] for r in out.collect())
    with pytest.raises(ValueError):
        mix(docs)
    assert mix(docs, column="drawn").select("mix", "drawn.n_tokens").count() == 50
