import hashlib
import random
import re
from collections import Counter

import pytest
from cdclake.llm.substrings import repeated_bytes, without_repeats


def brute(texts, length):
    raw = [(t or "").encode() for t in texts]
    seen = Counter(b[p : p + length] for b in raw for p in range(len(b) - length + 1))
    out = []
    for b in raw:
        gone = bytearray(len(b))
        for p in range(len(b) - length + 1):
            if seen[b[p : p + length]] > 1:
                gone[p : p + length] = b"\1" * length
        rest = bytes(x for x, g in zip(b, gone) if not g)
        out.append((len(b), sum(gone), len([x for x in bytes(gone).split(b"\0") if x]), rest))
    return out


def brute_words(texts, length):
    """Per text: (rest, maximal runs) without the words of runs of ``length`` words that occur anywhere else too."""
    words = [list(re.finditer(rb"[^\x20\x09-\x0D]+", (t or "").encode())) for t in texts]
    runs = lambda w: (tuple(x[0] for x in w[p : p + length]) for p in range(len(w) - length + 1))
    seen = Counter(r for w in words for r in runs(w))
    out = []
    for t, w in zip(texts, words):
        gone = bytearray(len(w))
        for p, r in enumerate(runs(w)):
            if seen[r] > 1:
                gone[p : p + length] = b"\1" * length
        raw, spans = (t or "").encode(), [(m.start(), m.end()) for m in re.finditer(b"\1+", bytes(gone))]
        for a, b in reversed(spans):
            raw = raw[: w[a].start()] + raw[w[b - 1].end() :]
        out.append((raw, len(spans)))
    return out


def check(spark, texts, length):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in repeated_bytes(df, length=length).collect()}
    want = brute(texts, length)
    assert got == {k: (*x[:3], hashlib.sha256(x[3]).hexdigest()) for k, x in enumerate(want)}
    return df, want


def make(seed, alphabet, n=60):
    rng = random.Random(seed)
    word = lambda k: "".join(rng.choice(alphabet) for _ in range(k))
    shared = [word(rng.choice([63, 64, 65, 70, 130, 300])) for _ in range(8)]
    texts = []
    for _ in range(n):
        parts = [word(rng.randrange(0, 120)) if rng.random() < 0.6 else rng.choice(shared) for _ in range(rng.randrange(0, 6))]
        texts.append("".join(parts))
    return texts + [None, "", texts[3], texts[3], "a" * 200, "a" * 64, "a" * 63, "ab" * 90, "ab" * 90]


@pytest.mark.parametrize("seed,alphabet", [(1, "ab"), (2, "abcdefgh "), (3, "aé€"), (4, "x\n")])
def test_random_texts_match_brute_force(spark, seed, alphabet):
    check(spark, make(seed, alphabet), 64)


def test_a_passage_that_most_texts_hold(spark):
    rng = random.Random(9)
    word = lambda k: "".join(rng.choice("abcdefghij ") for _ in range(k))
    passage = word(900)
    texts = [word(rng.randrange(300)) + passage[: rng.choice([399, 400, 401, 900])] + word(rng.randrange(300)) for _ in range(40)] + [word(5000), passage * 3]
    check(spark, texts, 400)


def test_texts_without_their_repeats(spark):
    texts = make(3, "aé€")
    df, want = check(spark, texts, 64)
    left = without_repeats(df.selectExpr("doc_id", "text", "length(text) AS n_chars", "'x' AS key", "doc_id AS spans"), length=64)
    assert left.columns == ["doc_id", "text", "n_chars", "key", "spans"]
    got = {r["doc_id"]: r for r in left.collect()}
    for k, (t, x) in enumerate(zip(texts, want)):
        rest = x[3].decode("utf-8", "ignore")
        if x[1] and not rest.split():
            assert k not in got
        else:
            assert got[k]["text"] == (rest if x[1] else t)


@pytest.mark.parametrize("seed", [5, 6])
def test_passages_of_words_match_brute_force(spark, seed):
    rng = random.Random(seed)
    blank = lambda: rng.choice([" ", " ", "\n", "  ", "\t\r\n"])
    word = lambda: rng.choice(["a", "é", "of", "the", "€uro", "end."]) + rng.choice("abcd")
    line = lambda w: "".join(x + blank() for x in w)
    shared = [[word() for _ in range(rng.choice([50, 51, 52, 60, 200]))] for _ in range(6)]
    texts = [blank().join(line([word() for _ in range(rng.randrange(80))]) if rng.random() < 0.6 else line(rng.choice(shared)) for _ in range(rng.randrange(5))) for _ in range(60)]
    texts += [None, "", " \n ", line(shared[0]), line(shared[0]), line(shared[5]) + line(shared[5]), "x " * 51, "x " * 50, "x " * 52, "y " * 51, "y " * 51, "z " * 50, "z " * 50]
    df = spark.createDataFrame([(k, t, k) for k, t in enumerate(texts)], "doc_id bigint, text string, n_passages int")
    want = brute_words(texts, 51)
    assert sum(n > 0 for _, n in want) > 20
    got = {r.doc_id: r for r in repeated_bytes(df, passage=51).collect()}
    assert {k: got[k].n_passages for k in got} == {k: n for k, (_, n) in enumerate(want)}
    assert {k: (got[k].n_removed, got[k].kept_sha256) for k in got} == {k: (x[1], hashlib.sha256(x[3]).hexdigest()) for k, x in enumerate(brute(texts, 400))}
    left = {r.doc_id: r for r in without_repeats(df, length=51, unit="words").collect()}
    assert set(left) == {k for k, (rest, n) in enumerate(want) if not n or rest.split()}
    assert all(left[k].text == (texts[k] if not want[k][1] else want[k][0].decode()) for k in left if texts[k] not in texts[:k] + texts[k + 1 :])


def test_empty_table_null_and_repeated_ids(spark):
    df = spark.createDataFrame([(None, "x" * 500), (1, "x" * 500), (1, "x" * 500), (1, "y")], "doc_id bigint, text string")
    assert repeated_bytes(df.limit(0)).count() == 0 and without_repeats(df.limit(0)).count() == 0
    assert sorted(r["n_removed"] for r in repeated_bytes(df).collect()) == [0, 500, 500, 500]
    with pytest.raises(ValueError):
        repeated_bytes(df, length=20)
