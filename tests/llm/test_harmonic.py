import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cdclake.llm.harmonic import VOCABULARY, Encoder, harmonic_pack, plan, sequences

SCHEMA = "doc_id bigint, text string, length string, ids string"  # columns with the names of the result's
tokenizers = pytest.importorskip("tokenizers")


@pytest.fixture(scope="module")
def tokenizer():
    return tokenizers.Tokenizer.from_file(VOCABULARY)


def test_ids_are_those_of_whole_texts(tokenizer):
    r = random.Random(4)
    words = ["Word", "word,", "Été", "été!", "naïve", "STRASSE", "straße", "It's", "don't.", "H\u0331", "h\u0331", "J\u030cx", "I\u0307", "<|ENDOFTEXT|>", "a.b", "x;y", "Ørsted", "ÿÿ"]
    plain = [" ".join(r.choice(words[:9] + words[-4:]) for _ in range(12)) for _ in range(200)]
    signs = words + [chr(c) for c in range(48)] + list("abXYZ'std09é́　 \x85İΣ\U0001f600") + ["<|endoftext|>", "'s", " ", "\n"]
    texts = ["".join(r.choice(signs) for _ in range(r.randrange(50))) for _ in range(2000)] + ["", None, "x" * 20000, " " * 20000]
    encode = Encoder(open(VOCABULARY).read(), most=2000)
    encode = Encoder(open(VOCABULARY).read())
    for x in plain + words:
        assert encode(pa.array([x]))[0].tolist() == tokenizer.encode(x, add_special_tokens=False).ids
    for begin in (0, 500, 400):
        ids, first = encode(pa.array(texts).slice(begin))
        for i, text in enumerate(texts[begin:]):
            assert ids[first[i] : first[i + 1]].tolist() == tokenizer.encode(text or "", add_special_tokens=False).ids, repr(text)


def test_plan_covers_each_token_once_and_pads_little():
    r = random.Random(5)
    for _ in range(500):
        capacity, least = r.choice([8, 16, 64]), r.choice([1, 2, 4])
        sizes = np.array(sorted((r.choice([r.randrange(1, 3 * capacity), r.randrange(1, capacity), 1, capacity]) for _ in range(r.randrange(40))), reverse=True), np.int64)
        found = plan(sizes, capacity, least)
        tokens = [(i, s + k) for i, s, n in zip(found["item"], found["start"], found["length"]) for k in range(n)]
        assert len(tokens) == len(set(tokens)) == sizes.sum()
        held = {}
        for s, at, n in sorted(zip(found["sequence"], found["offset"], found["length"])):
            assert n > 0 and at == held.get(s, 0)
            held[s] = at + n
        assert sorted(held) == list(range(len(held)))
        assert all(capacity - least < n <= capacity or n & (n - 1) == 0 for n in held.values())


def test_class_k_holds_k_documents_a_sequence():
    sizes = np.array([1500, 1000, 1000, 900, 800, *[650] * 5, *[500] * 20, 30, 20, 10])  # the last ones fill gaps
    found = plan(sizes, 2048)
    kinds = 2048 // sizes
    assert [int(found["class"][found["item"] == i][0]) for i in range(len(sizes))] == kinds.tolist()
    whole = {i: int(found["sequence"][found["item"] == i][0]) for i in range(len(sizes)) if (found["item"] == i).sum() == 1}
    assert whole[1] == whole[2] and whole[5] == whole[6] == whole[7] and whole[10] == whole[13]


def packed(spark, rows, **options):
    docs = spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA)
    out = harmonic_pack(docs, **options)
    assert out.columns == ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset", "sequence_tokens", "class"]
    return out


def test_texts_come_back_from_their_pieces(spark, tokenizer):
    r = random.Random(6)
    rows = [(i, " ".join(r.choice(["the", "quick", "Fox", "jumps!", "été"]) for _ in range(int(r.paretovariate(0.7) * 20) % 6000))) for i in range(150)]
    rows += [(7, rows[7][1]), (None, "no id"), (200, None), (201, ""), (202, "   \n")]
    rows += [(300, "the same text in very many rows")] * 80
    out = packed(spark, rows, shard_tokens=20000).persist()
    pieces = out.orderBy("doc_id", "start").collect()
    copies = {}
    for doc, text in rows:
        copies.setdefault((doc, text), 0)
        copies[doc, text] += 1
    want = {}
    for (doc, text), n in copies.items():
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [1]
        want.setdefault(doc, []).extend((k, t, len(ids)) for k, t in enumerate(ids) for _ in range(n))
    got = {}
    for p in pieces:
        ids = np.frombuffer(p.ids, "<u4")
        assert len(ids) == p.length
        got.setdefault(p.doc_id, []).extend((p.start + k, int(t), p.doc_tokens) for k, t in enumerate(ids))
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in want.items()}

    full = {s.sequence_id: s for s in sequences(out).collect()}
    spans = {}
    for p in pieces:
        spans.setdefault(p.sequence_id, []).append((p.offset, p.length, bytes(p.ids), p.sequence_tokens))
    for s, held in spans.items():
        held.sort()
        assert [x[0] for x in held] == np.cumsum([0] + [x[1] for x in held])[:-1].tolist()
        n = sum(x[1] for x in held)
        assert b"".join(x[2] for x in held) == bytes(full[s].ids) and n == full[s].n_tokens == held[0][3]
        assert 2040 < n <= 2048 or n & (n - 1) == 0
    assert len(spans) == len(full)


def test_checksum_of_ids(spark):
    row = packed(spark, [(1, "one two three")]).select("ids", F.crc32("ids").alias("sum")).first()
    assert row["sum"] == zlib.crc32(bytes(row["ids"]))


def test_empty_table(spark):
    assert packed(spark, []).count() == 0
