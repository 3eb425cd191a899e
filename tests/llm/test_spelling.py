import random
import re
import zlib

import numpy as np
import pytest

from cdclake.llm.scratch import Scratch
from cdclake.llm.spelling import Index, near_words, one_error, spelling_variants

SCHEMA = "doc_id bigint, text string, word int, n string, near int"  # clashing names


def edits(w, letters):
    out = {w[:i] + w[i + 1 :] for i in range(len(w))}
    out |= {w[:i] + c + w[i:] for i in range(len(w) + 1) for c in letters}
    out |= {w[:i] + c + w[i + 1 :] for i in range(len(w)) for c in letters}
    return out - {w}


def plain(rows, drop_every=31):
    count = {}
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            sum_ = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if drop_every and sum_ % drop_every == 0:
                at = sum_ % len(run)
                run = run[:at] + run[at + 1 :]
            if len(run) >= 7:
                count[run] = count.get(run, 0) + 1
    count = {w: n for w, n in count.items() if n >= 2}
    letters = {c for w in count for c in w}
    near = {w: [v for v in edits(w, letters) if v in count] for w in count}
    form = {w: min(vs, key=lambda v: (-count[v], v)) for w, vs in near.items() if vs}
    form = {w: v for w, v in form.items() if count[v] >= 10 * count[w]}

    def root(w):
        while w in form:
            w = form[w]
        return w

    return {(w, n, len(near[w]), form.get(w), count.get(form.get(w)), root(w)) for w, n in count.items()}


def test_index_finds_all_one_error_words():
    r = random.Random(8)
    for letters in ("ab", "abcé", "abcdefgh"):
        words = sorted({"".join(r.choice(letters) for _ in range(r.randrange(2, 9))) for _ in range(400)})
        index = Index(words)
        asked = sorted({"".join(r.choice(letters + "z") for _ in range(r.randrange(2, 9))) for _ in range(300)} | set(words[:100]))
        exact = np.array([len(w) - len(w) // 2 for w in asked])
        got = set(zip(*(x.tolist() for x in one_error(index, asked, exact))))
        where = {w: k for k, w in enumerate(words)}
        def keeps(w, v, n):  # one error left of w's last n letters
            return any(v == x + w[-n:] for x in edits(w[:-n], letters))
        want = {(i, where[v]) for i, w in enumerate(asked) for v in edits(w, letters) if v in where and keeps(w, v, len(w) - len(w) // 2)}
        assert {x for x in got if words[x[1]] != asked[x[0]]} == want


@pytest.mark.parametrize("limits", [{}, {"index_words": 7, "query_words": 5}])
def test_near_words_in_one_or_many_cells(spark, limits):
    r = random.Random(9)
    words = sorted({"same" + "".join(r.choice("abc") for _ in range(r.randrange(3, 6))) for _ in range(300)} | {"".join(r.choice("abcdÿ") for _ in range(r.randrange(7, 10))) for _ in range(200)})
    frame = spark.createDataFrame([(w, 3) for w in words], "word string, n bigint")
    got = [(x.word, x.near) for x in near_words(frame, Scratch(spark, "t"), **limits).collect()]
    letters = {c for w in words for c in w}
    assert sorted(got) == sorted((w, v) for w in words for v in edits(w, letters) if v in set(words))


def test_against_brute_force(spark):
    r = random.Random(10)
    base = ["".join(r.choice("etaoinshréÉ") for _ in range(r.randrange(7, 12))) for _ in range(60)]
    rows = []
    for i in range(400):
        some = r.choices(base, weights=[1 / (k + 1) for k in range(60)], k=30)
        some = [w[:k] + r.choice("xyz") + w[k + (r.random() < 0.5) :] if r.random() < 0.05 and (k := r.randrange(len(w))) is not None else w for w in some]
        rows.append((i, " ".join(w.upper() if r.random() < 0.1 else w for w in some)))
    rows += [(3, rows[3][1]), (None, rows[4][1]), (500, None), (501, ""), (502, "a" * 300), (503, "a" * 300), (504, "a" * 299), (505, "a" * 299 + "b " + "a" * 299), (506, "x1-×÷×÷×÷× 2"), (507, "×÷×÷×÷×")]
    rows += [(600, "repeated " * 3000)] * 3
    docs = spark.createDataFrame([(*x, 1, "x", 2) for x in rows], SCHEMA)
    got = spelling_variants(docs, drop_every=31)
    assert got.columns == ["word", "n", "n_near", "form", "form_n", "root"]
    want = plain(rows)
    assert {tuple(x) for x in got.collect()} == want
    assert sum(x[3] is not None for x in want) > 20


def test_forms_are_followed_to_the_last(spark):
    text = " ".join(["walking"] * 2 + ["talking"] * 20 + ["stalking"] * 200)
    got = {x.word: (x.form, x.root, x.n_near) for x in spelling_variants(spark.createDataFrame([(1, text)], "doc_id long, text string")).collect()}
    assert got == {"walking": ("talking", "stalking", 1), "talking": ("stalking", "stalking", 2), "stalking": (None, "stalking", 1)}


def test_very_long_words(spark):
    long = "ab" * 5000
    text = " ".join([long] * 30 + [long[:4000] + long[4001:]] * 3 + [long[:-1] + "c"] * 2 + ["x" * 9999] * 2)
    got = {x.word: (x.n_near, x.form) for x in spelling_variants(spark.createDataFrame([(1, text)], "doc_id long, text string")).collect()}
    assert got[long] == (2, None) and got[long[:4000] + long[4001:]] == (1, long) and got[long[:-1] + "c"] == (1, long) and got["x" * 9999] == (0, None)


def test_empty_table(spark):
    assert spelling_variants(spark.createDataFrame([], SCHEMA)).count() == 0
