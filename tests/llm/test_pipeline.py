import corpus_pipeline
from conftest import SF_SMALL
from test_jaccard import brute as near_brute
from test_quality import base
from test_substrings import brute_words


def test_stages_follow_brute_force(spark, tmp_path):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    columns, names = docs.columns, [x for x, _ in corpus_pipeline.STAGES]
    assert names == ["quality rules", "near duplicates", "repeated passages", "mixture", "packing"]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        before = {r["doc_id"]: r for r in docs.collect()}
        stage(spark, docs, SF_SMALL).write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        rows = docs.collect()
        after = {r["doc_id"]: r for r in rows}
        assert set(after) <= set(before)
        if k < 4:
            assert docs.columns == columns and len(after) == len(rows)
        if k == 0:
            for i, r in before.items():
                n, _, _, _, repeated = base(r["text"])
                assert not (i in after and (n < 50 or 100 * repeated > 50 * n))
            assert all(set(r["text"].split("\n")) <= set(before[i]["text"].split("\n")) for i, r in after.items())
        elif k == 1:
            assert set(after) == {v[2] for v in near_brute([(i, r["text"]) for i, r in before.items()]).values()}
            assert all(after[i] == before[i] for i in after)
        elif k == 2:
            ids = list(before)
            rest = {i: x[0].decode() for i, x in zip(ids, brute_words([before[i]["text"] for i in ids], 51))}
            assert {i: r["text"] for i, r in after.items()} == {i: t for i, t in rest.items() if t.split()}
            assert all(r["n_chars"] == len(r["text"]) for r in rows)
        elif k == 3:
            assert all(after[i] == before[i] for i in after) and len(after) > 0.5 * len(before)
        else:
            assert set(after) == set(before) and max(r["bin_tokens"] for r in rows) <= 2048


def test_run_equals_the_stages_and_is_registered(spark):
    import __spark_entry__ as entry

    out = entry.queries()["pipeline"](spark, SF_SMALL)
    assert out.count() > 0 and "bin_id" in out.columns
    assert sum(name.startswith("op") for name in entry.queries()) == 13
