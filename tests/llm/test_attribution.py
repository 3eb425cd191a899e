import numpy as np
import pytest
import tiktoken
from conftest import SF_SMALL
from cdclake.llm.attribution import PATTERN, RULES, VOCABULARY, allocate, encode_whole, field_tokens, read_ranks, section_tokens


def plain(start, end, cuts, rule):
    n = len(cuts) - 1
    out, crossing, share = [0] * n, [0] * n, [0.0] * n
    for a, b in zip(start, end):
        parts = [max(0, min(b, cuts[k + 1]) - max(a, cuts[k])) for k in range(n)]
        held = [k for k in range(n) if parts[k]]
        out[{"start": held[0], "end": held[-1], "largest": int(np.argmax(parts))}[rule]] += 1
        for k in held:
            share[k] += parts[k] / (b - a)
            crossing[k] += len(held) > 1
    return out, crossing, share


@pytest.mark.parametrize("rule", RULES)
def test_allocation_matches_a_plain_interval_join(rule):
    rng = np.random.default_rng(2)
    for _ in range(60):
        size = rng.integers(1, 9, rng.integers(0, 30))
        end = np.cumsum(size)
        total = int(end[-1]) if len(end) else 0
        cuts = np.r_[0, np.sort(rng.integers(0, total + 1, rng.integers(0, 12))), total]
        got, want = allocate(end - size, end, cuts, rule), plain(end - size, end, cuts, rule)
        assert got[0].tolist() == want[0] and got[1].tolist() == want[1] and np.allclose(got[2], want[2])
        assert got[0].sum() == len(size)


def test_whole_documents_are_encoded_once(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").limit(60)
    encoding = tiktoken.Encoding("t", pat_str=PATTERN, mergeable_ranks=read_ranks(VOCABULARY), special_tokens={})
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    for sections in ("lines", "sentences"):
        found = {}
        for r in section_tokens(docs, sections=sections).collect():
            found.setdefault(r["doc_id"], []).append(r)
        for doc, text in texts.items():
            held = sorted(found[doc], key=lambda r: r["section"])
            n = len(encoding.encode_ordinary(text))
            assert sum(r["n_tokens"] for r in held) == n and sum(r["token_share"] for r in held) == pytest.approx(n)
            assert "".join(text[r["start_char"] : r["end_char"]] for r in held) == text
            if sections == "lines":
                assert [text[r["start_char"] : r["end_char"]] for r in held] == (text.splitlines(keepends=True) if "\n" in text else [text])


def test_fields_and_edge_cases(spark):
    df = spark.createDataFrame([(1, "A title", "é body\nof it"), (2, None, "only"), (3, "", None), (4, "x" * 5000, " y")], "id bigint, title string, body string").selectExpr("*", "1 AS section", "'q' AS text")
    got = {}
    for r in field_tokens(df, "id", ["title", "body"]).collect():
        got.setdefault(r["id"], {})[r["field"]] = r
    assert {k: set(v) for k, v in got.items()} == {k: {"title", "body"} for k in (1, 2, 3, 4)}
    assert got[1]["title"]["end_char"] == 8 and got[1]["body"]["end_char"] == 20 and got[3]["body"]["n_tokens"] == 0
    docs = spark.createDataFrame([(1, None), (2, ""), (None, "a. b"), (3, "a. b"), (3, "a. b")], "doc_id bigint, text string")
    rows = section_tokens(docs).collect()
    assert len(rows) == 8 and sum(r["n_tokens"] for r in rows if r["doc_id"] in (1, 2)) == 0
    assert section_tokens(docs.limit(0)).count() == 0
    assert [r["n_crossing"] for r in rows if r["doc_id"] is None] == [1, 1]
    with pytest.raises(ValueError):
        section_tokens(docs, rule="middle")


@pytest.mark.parametrize("blank", [" ", "\n", " \t ", "　", "\x85"])
def test_long_runs_of_blanks_keep_their_tokens(blank):
    encoding = tiktoken.Encoding("t", pat_str=PATTERN, mergeable_ranks=read_ranks(VOCABULARY), special_tokens={})
    run = (blank * 5000)[:5000]
    for text in ("a" + run + "b", run + "7", "!" + run, run, "a" + run[:1500] + "." + run + " 's", run + "\x1c" + run):
        assert encode_whole(encoding, text) == encoding.encode_ordinary(text)


def test_millions_of_equal_characters(spark):
    texts = [x * 2_000_000 for x in (" ", "\n", "a", "#", "7")] + ["a" + " " * 2_000_000 + "b. c"]
    rows = section_tokens(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), sections="lines")
    got = {r["doc_id"]: r for r in rows.groupBy("doc_id").agg({"end_char": "max", "n_tokens": "sum"}).collect()}
    assert all(got[k]["max(end_char)"] == len(t) and got[k]["sum(n_tokens)"] > 0 for k, t in enumerate(texts))
