"""Language identification by error-correcting output codes over binary n-gram classifiers."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .text import pieces, utf8

BUCKETS = 1 << 15  # hashed n-gram features
ORDERS = (3, 4)  # bytes of an n-gram
SAMPLE = 4000  # labelled rows a language, about, that the classifiers learn from
CLIP = 4.0  # largest log odds of one n-gram
EVIDENCE = 30.0  # n-grams that a text's mean log odds counts for
AMBIGUOUS = 0.2  # least lead in loss over the next language that isn't flagged

_FOLD = np.full(256, 32, np.uint32)  # letters in lower case and bytes of other scripts; all else is a blank
_FOLD[97:123] = np.arange(97, 123)
_FOLD[65:91] = np.arange(97, 123)
_FOLD[128:] = np.arange(128, 256)
_FACTORS = [np.uint32(x) for x in (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F)]


def codewords(languages: int, seed: int = 7) -> np.ndarray:
    """(languages, bits) of +1 and -1, no column constant: all splits of up to five languages, else random ones far apart."""
    if languages < 2:
        return np.ones((languages, 0), np.int8)
    if languages <= 5:
        splits = np.arange(1, 2 ** (languages - 1))
        return np.where(splits[None, :] >> np.arange(languages)[:, None] & 1, 1, -1).astype(np.int8)
    bits, rng, best, far = int(np.ceil(10 * np.log2(languages))), np.random.default_rng(seed), None, -1
    for _ in range(200):
        code = rng.choice(np.array([-1, 1], np.int8), (languages, bits))
        agree = code.astype(np.int32) @ code.T
        np.fill_diagonal(agree, -bits)
        distance = (bits - agree.max()) // 2
        if distance > far and (np.abs(code.sum(0)) < languages).all():
            best, far = code, distance
    if best is None or far < 1:
        raise ValueError(f"no code of {bits} bits tells {languages} languages apart")
    return best


def grams(data: np.ndarray, off: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each order: features of all texts, and per text the index of its first (one more than texts)."""
    folded = _FOLD[data]
    for n in ORDERS:
        m = len(folded) - n + 1
        if m <= 0:
            yield np.empty(0, np.int64), np.zeros(len(off), np.int64)
            continue
        mixed = np.full(m, n, np.uint32)
        blank = np.ones(m, bool)
        for k in range(n):
            part = folded[k : k + m]
            mixed = (mixed ^ part) * _FACTORS[k]
            mixed ^= mixed >> np.uint32(15)
            if k < 2:
                blank &= part == 32
        keep = ~blank  # runs of blanks tell nothing
        for k in range(1, n):
            cut = off[1:-1] - k
            keep[cut[(cut >= 0) & (cut < m)]] = False
        where = np.flatnonzero(keep)
        yield (mixed[where] & np.uint32(BUCKETS - 1)).astype(np.int64), np.searchsorted(where, off)


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    totals: dict[str, np.ndarray] = {}
    for batch in batches:
        data, off = utf8(batch.column("text"))
        langs = batch.column("lang").to_pylist()
        for i, j in pieces(off):
            for found, at in grams(data[off[i] : off[j]], off[i : j + 1] - off[i]):
                for k in range(j - i):
                    if at[k + 1] > at[k]:
                        total = totals.setdefault(langs[i + k], np.zeros(BUCKETS, np.int64))
                        total += np.bincount(found[at[k] : at[k + 1]], minlength=BUCKETS)
    for lang, total in totals.items():
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(total[at])], ["lang", "feature", "n"])


def train(labelled: DataFrame, *, sample: int = SAMPLE) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
    """(languages, code, weights of each bit's classifier, importance of each bit).

    labelled has doc_id, text and lang. About ``sample`` rows of each language, chosen by hash,
    are read whole; the counts that reach the driver are one a language and
    feature, whatever the table's size. Each bit is a binary naive Bayes
    classifier between the languages that have it and the others, each language counting alike.
    """
    rows = labelled.where("lang is not null and text is not null").select("doc_id", F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    sizes = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    languages = sorted(sizes)
    code = codewords(len(languages))
    if not languages:
        return [], code, np.zeros((BUCKETS, 0), np.float32), np.zeros(0)
    shares = F.create_map(*[F.lit(x) for lang in languages for x in (lang, min(1.0, sample / sizes[lang]))])
    draw = F.pmod(F.xxhash64(F.lit(5), "doc_id", F.length("text")), F.lit(2**40)) / F.lit(float(2**40))
    counts = rows.where(draw < F.element_at(shares, F.col("lang"))).select("text", "lang").mapInArrow(_counts, "lang string, feature int, n bigint").groupBy("lang", "feature").agg(F.sum("n").alias("n"))
    table = np.zeros((len(languages), BUCKETS))
    got = counts.toArrow()
    index = {x: k for k, x in enumerate(languages)}
    table[[index[x] for x in got.column("lang").to_pylist()], got.column("feature").to_numpy()] = got.column("n").to_numpy()
    chance = (table + 0.5) / (table.sum(1, keepdims=True) + 0.5 * BUCKETS)
    weights, importance = np.zeros((BUCKETS, code.shape[1]), np.float32), np.zeros(code.shape[1])
    for b in range(code.shape[1]):
        one, zero = chance[code[:, b] > 0].mean(0), chance[code[:, b] < 0].mean(0)
        odds = np.log(one / zero)
        weights[:, b] = np.clip(odds, -CLIP, CLIP)
        importance[b] = ((one - zero) * odds).sum()
    return languages, code, weights, importance / max(importance.sum(), 1e-12)


def decode(margins: np.ndarray, code: np.ndarray, importance: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(best language, score in 0 to 1, ambiguous) from each text's bit margins: least weighted logistic loss to a codeword."""
    if code.shape[1] == 0:
        n = len(margins)
        return np.zeros(n, np.int64), np.ones(n), np.zeros(n, bool)
    scaled = importance * len(importance)
    loss = np.stack([(scaled * np.logaddexp(0, -margins * word)).sum(1) for word in code.astype(np.float64)], 1)
    order = np.sort(loss, 1)
    chance = np.exp(-(loss - order[:, :1]))
    return loss.argmin(1), 1 / chance.sum(1), order[:, 1] - order[:, 0] < AMBIGUOUS


def predict(docs: DataFrame, model: tuple[list[str], np.ndarray, np.ndarray, np.ndarray]) -> DataFrame:
    """docs (its columns but text stay) with lang_pred, score and ambiguous, from whole texts alone.

    A null text or one without a letter is ``und`` with score 0, as is every
    text if nothing was learned. A text without n-grams, such as one letter, has
    margins of 0: the tie goes to the language that sorts first, and is flagged. Empty tables give no rows.
    """
    languages, code, weights, importance = model
    others = [x for x in docs.columns if x != "text"]
    fields = [f for f in docs.schema.fields if f.name in others]
    schema = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in fields) + "lang_pred string, score double, ambiguous boolean"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, off = utf8(batch.column("text"))
            margins = np.zeros((batch.num_rows, code.shape[1]))
            for i, j in pieces(off, 1 << 20):
                seen = np.zeros(j - i)
                for found, at in grams(data[off[i] : off[j]], off[i : j + 1] - off[i]):
                    n = np.diff(at)
                    full = np.flatnonzero(n)
                    seen += n
                    if len(full):
                        margins[i + full] += np.add.reduceat(weights[found], at[full], axis=0, dtype=np.float64)
                margins[i:j] *= (EVIDENCE / np.maximum(seen, 1) * np.minimum(seen / EVIDENCE, 1))[:, None]
            best, score, unsure = decode(margins, code, importance)
            letter = batch.column("__letter").to_numpy(zero_copy_only=False).astype(bool) & bool(languages)
            names = np.array([*languages, "und"], dtype=object)[np.where(letter, best, len(languages))]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(x) for x in others], pa.array(names.tolist(), pa.string()), pa.array(np.where(letter, score, 0.0)), pa.array(unsure & letter)],
                [*others, "lang_pred", "score", "ambiguous"])

    letter = F.coalesce(F.col("text").cast("string").rlike(r"\p{L}"), F.lit(False))
    ready = docs.select(*[F.col(f"`{x}`") for x in others], F.col("text").cast("string").alias("text"), letter.alias("__letter"))
    return ready.mapInArrow(run, schema)


def identify(docs: DataFrame, *, folds: int = 4, held: int = 2, sample: int = SAMPLE) -> DataFrame:
    """doc_id, held_out, lang_pred, score, ambiguous of every row; rows whose crc32(doc_id) mod ``folds`` is ``held`` teach nothing.

    A row without a doc_id is not held out. Repeated rows and copies are judged alike.
    """
    held_out = F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(folds)) == held, F.lit(False))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out.alias("held_out"), "text", "lang")
    model = train(rows.where("not held_out"), sample=sample)
    return predict(rows.select("doc_id", "held_out", "text"), model)
