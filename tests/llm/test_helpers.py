"""Words, shingles, anchors and components against plain Python."""

import random
import re

import numpy as np
import pyarrow as pa

from cdclake.llm.anchors import anchors, window_minima
from cdclake.llm.components import connected_components
from cdclake.llm.scratch import Scratch
from cdclake.llm.text import byte_hashes, pieces, shingles, span_hash, prefix_hash, utf8, word_spans, words

TEXTS = ["", None, " ", "one", "a b c d e", "tab\tand\nline\r\x0b\x0cfeed  x", "é ü x  y", "end ", " start", "a b c d e f g h"] * 3


def test_words_and_bytes_match_a_regex():
    data, off = utf8(pa.chunked_array([pa.array(TEXTS[:7]), pa.array(TEXTS[7:])]))
    start, end = word_spans(data, off)
    got = [[] for _ in TEXTS]
    for a, b in zip(start, end):
        got[int(np.searchsorted(off, a, "right")) - 1].append(data[a:b].tobytes().decode())
    assert got == [re.findall(r"[^\x20\x09-\x0D]+", t or "") for t in TEXTS]
    assert [x for i, j in pieces(off, 10) for x in range(i, j)] == list(range(len(TEXTS)))


def test_hashes_depend_on_the_bytes_alone():
    data = np.frombuffer(b"abcabcxabc", np.uint8)
    sums = prefix_hash(data)
    h = span_hash(sums, np.array([0, 3, 7, 0, 1]), np.array([3, 6, 10, 2, 3]))
    assert h[0] == h[1] == h[2] and len({int(x) for x in h}) == 3


def test_shingles_match_tuples():
    data, off = utf8(pa.array(TEXTS))
    for size in (1, 3, 5):
        runs, at = shingles(*words(data, off), size)
        names = {}
        for k, t in enumerate(TEXTS):
            w = re.findall(r"[^\x20\x09-\x0D]+", t or "")
            want = [tuple(w[i : i + size]) for i in range(len(w) - size + 1)] if len(w) >= size else [tuple(w)] * bool(w)
            got = runs[at[k] : at[k + 1]].tolist()
            assert len(got) == len(want)
            for g, x in zip(got, want):
                assert names.setdefault(x, g) == g
        assert len(set(names.values())) == len(names)


def test_anchors_cover_all_windows_alike():
    rng = random.Random(3)
    texts = ["".join(rng.choice("ab") for _ in range(n)) for n in (10, 64, 200, 0, 90)] + ["a" * 150]
    texts.append(texts[2][50:150])
    data, off = utf8(pa.array(texts))
    row, at, low, high, _ = anchors(byte_hashes(data), off, 64, 30)
    place = {}
    seen = 0
    for r, a, lo, hi in zip(row, at, low, high):
        for p in range(lo, hi + 1):
            seen += 1
            window = data[p : p + 64].tobytes()
            assert 0 <= a - p < 30 and place.setdefault(window, a - p) == a - p
    assert seen == sum(max(0, len(t) - 63) for t in texts)
    values = np.array([5, 3, 9, 3, 8, 7, 1, 2], np.uint64)
    assert window_minima(values, 3).tolist() == [min(values[i : i + 3]) for i in range(6)]


def test_components_of_chains_hubs_and_nothing(spark):
    edges = [(i, i + 1) for i in range(30)] + [(100, 100 + k) for k in range(1, 40)] + [(7, 7), (None, 3), (200, 201), (201, 200)]
    df = spark.createDataFrame(edges, "a bigint, b bigint")
    got = {r["node"]: r["component"] for r in connected_components(df, Scratch(spark, "t")).collect()}
    assert got == {**{i: 0 for i in range(31)}, **{100 + k: 100 for k in range(40)}, 200: 200, 201: 200}
    assert connected_components(df.limit(0), Scratch(spark, "t")).count() == 0
