import zlib
from collections import Counter

import numpy as np
import pytest
from conftest import SF_SMALL
from cdclake.llm import ppm
from cdclake.llm.ppm import DISCOUNT, ORDER, adaptive_bits, adaptive_score, score


def coded(text, order=ORDER):
    return b"\n" * order + b" ".join((text or "").encode().lower().split()) + b"\n"


class Plain:
    """The model as dictionaries, one lookup a byte."""

    def __init__(self, texts, order=ORDER):
        level = Counter()
        for t in texts:
            b = coded(t, order)
            level.update(b[i - order : i + 1] for i in range(order, len(b)))
        self.order, self.near = order, {}
        while level:
            for gram, n in level.items():
                self.near.setdefault(gram[:-1], {})[gram[-1]] = n
            level = Counter(g[1:] for g in level if len(g) > 1)

    def chance(self, past, symbol):
        excluded, p = set(), 1.0
        for k in range(self.order, -1, -1):
            left = {s: n for s, n in self.near.get(past[self.order - k :], {}).items() if s not in excluded}
            if left:
                whole = sum(left.values())
                if symbol in left:
                    return p * (left[symbol] - DISCOUNT) / whole
                p *= DISCOUNT * len(left) / whole
            excluded |= left.keys()
        return p / (256 - len(excluded))

    def score(self, text):
        b = coded(text, self.order)
        return sum(np.log10(self.chance(b[i - self.order : i], b[i])) for i in range(self.order, len(b)))


def check(spark, rows, **options):
    held = {k: k is not None and zlib.crc32(str(k).encode()) % 7 == 2 for k, _ in rows}
    train = [t for k, t in rows if not held[k]]
    model, counts = Plain(train, options.get("order", ORDER)), Counter()
    for t in train:
        counts.update([*(t or "").encode().lower().split(), None])
    n, v = sum(counts.values()), len(counts)
    got = score(spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("*", "1 AS block", "2 AS key"), **options).collect()
    assert len(got) == len(rows)
    texts = {k: t for k, t in rows}
    for r in got:
        t = texts[r["doc_id"]]
        tokens = [*(t or "").encode().lower().split(), None]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (held[r["doc_id"]], len(tokens), sum(counts[w] > 0 for w in tokens), n)
        assert r["base_score"] == pytest.approx(sum(np.log10((counts[w] + 1) / (n + v + 1)) for w in tokens), rel=1e-9)
        assert r["score"] == pytest.approx(model.score(t), rel=1e-9)
    return got


def test_scores_match_brute_force(spark):
    rows = [(r["doc_id"], r["text"][:1500]) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").limit(60).collect()]
    check(spark, rows)
    check(spark, rows[:20], order=3)


def test_edge_cases(spark):
    check(spark, [(0, None), (1, ""), (2, " \n"), (3, "A b É"), (4, "a B é"), (5, "x" * 3000), (6, "\x00\x01 \x7f"), (5000, "a")] + [(i, "same text here") for i in range(10, 30)])
    assert score(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0
    only_held = [k for k in range(50) if zlib.crc32(str(k).encode()) % 7 == 2][:3]
    for r in score(spark.createDataFrame([(k, "ab") for k in only_held], "doc_id bigint, text string")).collect():
        assert r["score"] == pytest.approx(3 * np.log10(1 / 256)) and r["train_tokens"] == 0 and r["n_known"] == 0
    with pytest.raises(ValueError):
        score(spark.createDataFrame([], "doc_id bigint, text string"), order=9)


def test_probabilities_sum_to_one_and_order_helps():
    model = Plain(["the cat sat on the mat", "the dog sat"])
    for past in (b"e cat", b"\n\n\n\n\n", b"zzzzz", b"n the"):
        assert sum(model.chance(past, s) for s in range(256)) == pytest.approx(1)


def test_adaptive_code_length(spark):
    assert adaptive_bits("") == pytest.approx(8) and adaptive_bits(None) == adaptive_bits(" ")
    assert adaptive_bits("abcdefgh " * 30) < 0.2 * 8 * len("abcdefgh " * 30)
    rows = adaptive_score(spark.createDataFrame([(1, "a b"), (2, None)], "doc_id bigint, text string")).collect()
    assert {r["doc_id"]: r["bits"] for r in rows} == {1: adaptive_bits("a b"), 2: adaptive_bits("")}


def test_grams_are_worked_out_once_however_many_blocks_hold_them(spark, monkeypatch):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").limit(80).cache()
    keep, seen, got = ppm.Scratch.keep, {}, {}

    def count(self, df, name):
        out = keep(self, df, name)
        seen[name] = out.count()
        return out

    monkeypatch.setattr(ppm.Scratch, "keep", count)
    for blocks in (4, 64):
        monkeypatch.setattr(ppm, "BLOCKS", blocks)
        got[blocks] = {r["doc_id"]: tuple(r) for r in score(docs).collect()}, dict(seen)
    few, many = got[4], got[64]
    assert few[1]["totals"] == many[1]["totals"] and few[1]["asked"] < many[1]["asked"]  # what tasks work on follows distinct keys
    assert few[0].keys() == many[0].keys()
    for k, row in few[0].items():
        assert row == pytest.approx(many[0][k], rel=1e-9)
