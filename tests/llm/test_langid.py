import zlib

import numpy as np
import pyarrow as pa
from conftest import SF_SMALL
from cdclake.llm.langid import codewords, decode, grams, identify
from cdclake.llm.text import utf8


def test_codewords_tell_languages_apart():
    assert codewords(0).shape == (0, 0) and codewords(1).shape == (1, 0) and codewords(2).shape == (2, 1)
    for n in (3, 4, 5, 12, 40):
        code = codewords(n)
        assert (np.abs(code.sum(0)) < n).all()
        distance = [(code[i] != code[j]).sum() for i in range(n) for j in range(i)]
        assert min(distance) >= (2 if n <= 5 else code.shape[1] // 5)
    assert [(codewords(4)[0] != codewords(4)[j]).sum() for j in (1, 2, 3)] == [4, 4, 4]


def test_decoding_corrects_a_wrong_bit():
    code = codewords(4)
    margins = 3.0 * code.astype(float)
    margins[:, 2] *= -1
    best, score, unsure = decode(margins, code, np.full(code.shape[1], 1 / code.shape[1]))
    assert best.tolist() == [0, 1, 2, 3] and (score > 0.5).all() and not unsure.any()
    best, score, unsure = decode(np.zeros((1, code.shape[1])), code, np.full(code.shape[1], 1 / code.shape[1]))
    assert best[0] == 0 and abs(score[0] - 0.25) < 1e-9 and unsure[0]


def test_grams_stay_inside_their_text():
    texts = ["abcd", "", None, "AB", "abcd", "x  y, é!"]
    data, off = utf8(pa.array(texts))
    for found, at in grams(data, off):
        one = [found[a:b].tolist() for a, b in zip(at[:-1], at[1:])]
        assert one[0] == one[4]
        for k, t in enumerate(texts):
            alone, where = utf8(pa.array([t]))
            assert one[k] in [f.tolist() for f, _ in grams(alone, where)]


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    lang = {r["doc_id"]: r["lang"] for r in docs.collect()}
    rows = identify(docs).collect()
    assert len(rows) == len(lang)
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) and 0 <= r["score"] <= 1
    held = [r for r in rows if r["held_out"]]
    assert sum(r["lang_pred"] == lang[r["doc_id"]] for r in held) >= 0.95 * len(held)


def test_edge_cases(spark):
    rows = [(i, "the cat and the dog " * 9, "en", "s") for i in range(20)] + [(100 + i, "der hund und die katze " * 9, "de", "s") for i in range(20)]
    odd = [(200, None, "en", "s"), (201, "", None, None), (202, "123 #!", "de", "s"), (203, "é", None, "s"), (204, "und die katze " * 9000, None, "s"), (None, "the dog and", None, "s"), (0, "the cat and the dog " * 9, "en", "s")]
    df = spark.createDataFrame(rows + odd, "doc_id bigint, text string, lang string, score string")
    got = {(r["doc_id"]): r for r in identify(df).collect()}
    assert [got[k]["lang_pred"] for k in (200, 201, 202)] == ["und"] * 3 and got[204]["lang_pred"] == "de" and got[None]["lang_pred"] == "en"
    assert not got[None]["held_out"] and got[203]["lang_pred"] in ("de", "en")
    assert identify(df).count() == len(rows + odd) and identify(df.limit(0)).count() == 0
    assert {r["lang_pred"] for r in identify(df.selectExpr("doc_id", "text", "CAST(null AS string) AS lang")).collect()} == {"und"}
    assert {r["lang_pred"] for r in identify(df.where("lang = 'de'")).collect()} <= {"de", "und"}


def plain_features(text):
    """Features of one text, n-gram by n-gram."""
    from cdclake.llm.langid import BUCKETS, ORDERS

    fold = [b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in (text or "").encode()]
    factors, out = (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F), []
    for n in ORDERS:
        for p in range(len(fold) - n + 1):
            if fold[p] == fold[p + 1] == 32:
                continue
            h = n
            for k in range(n):
                h = (h ^ fold[p + k]) * factors[k] & 0xFFFFFFFF
                h ^= h >> 15
            out.append(h % BUCKETS)
    return out


def test_predictions_match_plain_naive_bayes_and_decoding(spark):
    import math
    import random
    from collections import Counter

    from cdclake.llm.langid import AMBIGUOUS, BUCKETS, CLIP, EVIDENCE

    r = random.Random(12)
    words = {"aa": "the of and cat dog house".split(), "bb": "der und katze hund haus ist".split(), "cc": "le la chat chien maison été".split()}
    rows = [(i, " ".join(r.choice(words[x] if r.random() < 0.8 else words["aa"]) for _ in range(r.randrange(0, 25))), x) for i, x in enumerate(r.choice(list(words)) for _ in range(90))]
    rows += [(500, None, "aa"), (501, "Katze chat cat", None)]
    got = {x.doc_id: x for x in identify(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    langs = sorted(words)
    counts = {x: Counter() for x in langs}
    for i, t, x in rows:
        if t is not None and x and zlib.crc32(str(i).encode()) % 4 != 2:
            counts[x].update(plain_features(t))
    total = {x: sum(c.values()) + 0.5 * BUCKETS for x, c in counts.items()}
    code = codewords(3).tolist()
    odds, importance = [{} for _ in code[0]], []
    for b in range(len(code[0])):
        mean = lambda f, sign: sum((counts[x][f] + 0.5) / total[x] for k, x in enumerate(langs) if code[k][b] == sign) / sum(code[k][b] == sign for k in range(3))
        seen = set().union(*counts.values())
        rest = BUCKETS - len(seen)
        for f in [*seen, -1]:  # -1: any feature that was never seen
            odds[b][f] = math.log(mean(f, 1) / mean(f, -1))
        importance.append(sum((mean(f, 1) - mean(f, -1)) * odds[b][f] * (rest if f == -1 else 1) for f in odds[b]))
    importance = [x / sum(importance) * len(importance) for x in importance]
    for i, t, _ in rows:
        found = plain_features(t)
        if not any(c.isalpha() for c in t or ""):
            assert (got[i].lang_pred, got[i].score, got[i].ambiguous) == ("und", 0.0, False)
            continue
        margins = [sum(max(-CLIP, min(CLIP, odds[b].get(f, odds[b][-1]))) for f in found) * EVIDENCE / max(len(found), 1) * min(len(found) / EVIDENCE, 1) for b in range(len(code[0]))]
        loss = [sum(w * math.log1p(math.exp(-m * c)) if -m * c < 500 else w * -m * c for w, m, c in zip(importance, margins, word)) for word in code]
        order = sorted(loss)
        assert abs(got[i].score - 1 / sum(math.exp(order[0] - x) for x in loss)) < 1e-4
        if order[1] - order[0] > 1e-3:
            assert got[i].lang_pred == langs[loss.index(order[0])] and (abs(order[1] - order[0] - AMBIGUOUS) < 1e-3 or got[i].ambiguous == (order[1] - order[0] < AMBIGUOUS))
