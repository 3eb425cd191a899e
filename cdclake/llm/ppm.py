"""Language-model scoring by prediction by partial matching over bytes.

A text is scored as its words in lower case (A-Z only), each followed by a
blank, the last by an end mark; the context before the first byte is end marks.
A byte's probability comes from the longest context in which training saw it. Every
step to a shorter one costs an escape and excludes the symbols of the contexts left behind.
With update exclusion a shorter context counts how many longer ones led to a symbol, that is
how often it was reached by an escape. A symbol's count gives up ``DISCOUNT``, and what a context's symbols
give up is its escape estimate. All lower orders follow from the counts of the
longest, so the trie is one table of grams, and a gram's log probability
is a function of the gram: it is worked out once and looked up.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import Scratch
from .text import pieces, prefix_hash, span_hash, utf8, word_spans

ORDER = 5  # bytes of the longest context
DISCOUNT = 0.35  # of a count that goes to the escape
LOW = 2  # contexts of up to so many bytes are in a table of 256**3 rows at most, which every task gets
BLOCK_BYTES = 12 << 20  # text of a block, about: what one task scores against the grams that it needs
BLOCKS = 16  # least number of blocks
PIECE = 1 << 19  # bytes of text that arrays are made for at a time, about
MERGE = 8  # lists of distinct keys that are held before they are merged
MODEL_ROWS = 1 << 20  # distinct grams that one task works out, about
END, GAP = 10, 32
END_WORD = np.int64(-7046029254386353131)  # stands for the end token among word hashes

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def symbols(data: np.ndarray, off: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(grams, first gram of each text, word hashes, first word of each text); firsts have one more than texts.

    A gram packs a symbol and the ``order`` bytes before it into one integer.
    """
    data = _LOWER[data]
    start, end = word_spans(data, off)
    size = end - start
    first_word = np.searchsorted(start, off)
    words = np.diff(first_word)
    text = np.repeat(np.arange(len(words)), words)
    length = np.zeros(len(words), np.int64)
    np.add.at(length, text, size + 1)
    length[words == 0] = 1
    first = np.r_[0, np.cumsum(length)]
    out = np.full(first[-1] + order * len(words), END, np.uint8)
    begin = np.cumsum(size + 1) - (size + 1)
    begin += order * (text + 1) + np.cumsum(words == 0)[text] if len(text) else 0
    flat = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
    out[flat + np.repeat(begin, size)] = data[flat + np.repeat(start, size)]
    gaps = np.ones(len(size), bool)
    gaps[first_word[1:][words > 0] - 1] = False
    out[(begin + size)[gaps]] = GAP
    last = np.arange(first[-1]) + np.repeat(order * np.arange(1, len(words) + 1), length)
    grams = np.zeros(first[-1], np.int64)
    for k in range(order, -1, -1):
        grams = (grams << 8) | out[last - k]
    hashes = span_hash(prefix_hash(data), start, end).view(np.int64)
    return grams, first, hashes, first_word


def _summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    new = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]][: len(keys)])
    return keys[new], np.add.reduceat(counts, new) if len(new) else counts


def _distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    keys = np.sort(keys)
    new = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]][: len(keys)])
    return keys[new], np.diff(np.r_[new, len(keys)])


def _needs(order: int):
    """Distinct grams (kind 0) and words (kind 1) of a block, with their counts in its training texts."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        data, off = utf8(table.column("text"))
        held = table.column("held_out").to_numpy(zero_copy_only=False).astype(bool)
        found: list[list[tuple[np.ndarray, np.ndarray]]] = [[], []]
        for i, j in pieces(off, PIECE):
            grams, first, words, first_word = symbols(data[off[i] : off[j]], off[i : j + 1] - off[i], order)
            words = np.r_[words, np.full(j - i, END_WORD)]
            for kind, keys, row in ((0, grams, np.repeat(held[i:j], np.diff(first))), (1, words, np.r_[np.repeat(held[i:j], np.diff(first_word)), held[i:j]])):
                found[kind].append(_distinct(keys[~row]))
                other, _ = _distinct(keys[row])
                found[kind].append((other, np.zeros(len(other), np.int64)))
                if len(found[kind]) >= MERGE:
                    found[kind] = [_summed(*(np.concatenate(x) for x in zip(*found[kind])))]
        parts = []
        while found:  # each kind's lists go as soon as they are merged
            parts.append(_summed(*(np.concatenate(x) for x in zip(*found.pop(0)))))
        kind = np.repeat(np.array([0, 1], np.int8), [len(x[0]) for x in parts])
        keys, counts = (np.concatenate([x[i] for x in parts]) for i in (0, 1))
        del parts
        return pa.table({"block": pa.array(np.full(len(kind), key[0].as_py(), np.int32)), "kind": pa.array(kind), "key": pa.array(keys), "n": pa.array(counts.astype(np.int64, copy=False))})

    return run


class Level:
    """Counts of one order: sorted codes (context and symbol), and per context its total, its distinct symbols, and where its codes lie."""

    def __init__(self, codes: np.ndarray, counts: np.ndarray):
        self.codes, self.counts = codes, counts
        context = codes >> 8
        new = np.flatnonzero(np.r_[True, context[1:] != context[:-1]][: len(context)])
        self.contexts = context[new]
        self.total = np.add.reduceat(counts, new) if len(new) else counts[:0]
        self.kinds = np.add.reduceat((counts > 0).astype(np.int64), new) if len(new) else counts[:0]
        self.of = np.repeat(np.arange(len(new)), np.diff(np.r_[new, len(context)]))

    def count(self, codes: np.ndarray) -> np.ndarray:
        return _look(self.codes, self.counts, codes)

    def shorter(self, k: int) -> Level:
        """The level of contexts of k bytes, one less: each code counts its longer ones that occurred."""
        return Level(*_summed(self.codes & ((1 << 8 * (k + 1)) - 1), (self.counts > 0).astype(np.int64)))


def _look(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    if not len(keys):
        return np.zeros(len(wanted), values.dtype)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, values[at], 0)


def _hashed(keys: np.ndarray, values: np.ndarray) -> Callable[[np.ndarray], np.ndarray]:
    """``_look`` in distinct keys of any order, by a hash table: for far more lookups than keys."""
    if not len(keys):
        return lambda wanted: np.zeros(len(wanted), values.dtype)
    index = pd.Index(keys)

    def look(wanted: np.ndarray) -> np.ndarray:
        at = index.get_indexer(wanted)
        return np.where(at >= 0, values[at], 0)

    return look


def log_probability(grams: np.ndarray, counts: np.ndarray, low: list[Level], order: int) -> np.ndarray:
    """log10 probability of each gram's symbol after its context.

    grams are sorted and hold all grams of the corpus whose contexts end in the
    same LOW + 1 bytes; ``low`` holds the whole corpus's levels of contexts of 0 to LOW bytes.
    """
    levels = {k: low[k] for k in range(LOW + 1)} | {order: Level(grams, counts)}
    for k in range(order - 1, LOW, -1):
        levels[k] = levels[k + 1].shorter(k)
    chance, alive = np.ones(len(grams)), np.ones(len(grams), bool)
    seen_total = np.zeros(len(grams))  # counts, at the order at hand, of symbols excluded by longer contexts
    seen_kinds = np.zeros(len(grams))
    for k in range(order, -1, -1):
        level = levels[k]
        code = grams & ((1 << 8 * (k + 1)) - 1)
        context = code >> 8
        total, kinds, count = _look(level.contexts, level.total, context), _look(level.contexts, level.kinds, context), level.count(code)
        left, kinds_left = total - seen_total, kinds - seen_kinds
        here = alive & (count > 0)
        chance[here] *= (count[here] - DISCOUNT) / left[here]
        on = alive & (count == 0) & (kinds_left > 0)
        chance[on] *= DISCOUNT * kinds_left[on] / left[on]
        alive &= count == 0
        if k:  # what this context's symbols count for one order down
            below = np.where(level.counts > 0, levels[k - 1].count(level.codes & ((1 << 8 * k) - 1)), 0)
            sums = np.bincount(level.of, below, len(level.contexts))
            seen_total, seen_kinds = _look(level.contexts, sums, context), kinds
    if alive.any():
        chance[alive] /= 256 - (low[0].kinds[0] if len(low[0].kinds) else 0)
    return np.log10(chance)


def low_levels(codes: np.ndarray, counts: np.ndarray) -> list[Level]:
    """Levels of contexts of 0 to LOW bytes from the counts of the last."""
    levels = [Level(*_summed(codes, counts))]
    for k in range(LOW - 1, -1, -1):
        levels.append(levels[-1].shorter(k))
    return levels[::-1]


def _chances(low, order: int):
    """Log probabilities of grams that come with their counts, all grams of a context suffix in one task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [[b.column(x).to_numpy() for x in ("key", "n")] for b in batches if b.num_rows]
        if not parts:
            return
        keys, counts = (np.concatenate(x) for x in zip(*parts))
        order_of = np.argsort(keys)
        keys, counts = keys[order_of], counts[order_of]
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(log_probability(keys, counts, low_levels(*low.value), order), pa.float64())], ["key", "value"])

    return run


def _score(order: int, tokens: int, kinds: int):
    floor = np.log10(tokens + 1.0 * (kinds + 1))

    def run(key: tuple, docs: pa.Table, model: pa.Table) -> pa.Table:
        data, off = utf8(docs.column("text"))
        held = docs.column("held_out").to_numpy(zero_copy_only=False).astype(bool)
        known = []
        for kind in (0, 1):
            part = model.filter(pc.equal(model.column("kind"), kind))
            known.append(_hashed(part.column("key").to_numpy(), part.column("value").to_numpy()))
        score, base, n_known, n_tokens = (np.zeros(docs.num_rows, x) for x in (np.float64, np.float64, np.int64, np.int64))
        parts = []
        for i, j in pieces(off, PIECE):
            grams, first, found, first_word = symbols(data[off[i] : off[j]], off[i : j + 1] - off[i], order)
            score[i:j] = np.add.reduceat(known[0](grams), first[:-1])
            n_tokens[i:j] = np.diff(first_word) + 1
            parts.append((i, j, np.insert(found, first_word[1:], END_WORD)))  # each text's words and its end
        local = [_distinct(words[~np.repeat(held[i:j], n_tokens[i:j])]) for i, j, words in parts]
        local = _summed(*(np.concatenate(x) for x in zip(*local)))
        for i, j, words in parts:
            count = np.maximum(known[1](words), _look(*local, words))
            first = np.cumsum(n_tokens[i:j]) - n_tokens[i:j]
            n_known[i:j] = np.add.reduceat((count > 0).astype(np.int64), first)
            base[i:j] = np.add.reduceat(np.log10(count + 1) - floor, first)
        return pa.table({"doc_id": docs.column("doc_id"), "held_out": docs.column("held_out"), "n_tokens": pa.array(n_tokens), "n_known": pa.array(n_known),
                         "train_tokens": pa.array(np.full(docs.num_rows, tokens)), "base_score": pa.array(base), "score": pa.array(score)})

    return run


def score(docs: DataFrame, *, folds: int = 7, held: int = 2, order: int = ORDER, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Scores of every whole text, learning from rows whose crc32(doc_id) mod ``folds`` is not ``held``.

    doc_id, held_out, n_tokens (words and one end), n_known (tokens seen in
    training), train_tokens, base_score (add-one unigram log10 probability), score (the model's
    log10 probability). A null or blank text is its end mark. A row without a
    doc_id is not held out. Without training rows every byte has probability 1/256.
    Repeated rows are scored, and learned from, as often as they occur.

    Texts are dealt into blocks by hash. A block asks for its distinct grams and
    words only, so what is gathered follows the corpus, and no task holds the
    model. Counts are summed by key, combined before they are shuffled; grams meet by the last bytes of
    their contexts, once each however many blocks hold them, and a join of any key brings
    the answers to the blocks that asked.
    """
    if not LOW < order <= 6:
        raise ValueError(f"order must be between {LOW + 1} and 6")
    spark = docs.sparkSession
    scratch = Scratch(spark, "ppm")
    held_out = F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(folds)) == held, F.lit(False))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out.alias("held_out"), text.alias("text"))
    size = rows.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    blocks = max(BLOCKS, -(-size // block_bytes))
    rows = rows.withColumn("block", F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks)).cast("int"))
    asked = scratch.keep(rows.groupBy("block").applyInArrow(_needs(order), "block int, kind tinyint, key bigint, n bigint"), "asked")
    totals = scratch.keep(asked.groupBy("key", "kind").agg(F.sum("n").alias("n"), F.count("*").alias("blocks")), "totals")
    tail = lambda n: F.col("key").bitwiseAND(F.lit((1 << 8 * n) - 1)).alias("key")
    short = totals.where("kind = 0 and n > 0").select(tail(LOW + 2)).distinct().groupBy(tail(LOW + 1)).agg(F.count("*").alias("n")).toArrow()
    low = spark.sparkContext.broadcast((short.column("key").to_numpy(), short.column("n").to_numpy()))
    found = totals.agg(F.count_if(F.col("kind") == 0).alias("grams"), F.sum(F.when(F.col("kind") == 1, F.col("n"))).alias("tokens"), F.count_if((F.col("kind") == 1) & (F.col("n") > 0)).alias("words")).first()
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-found["grams"] // MODEL_ROWS))
    suffix = F.shiftright("key", 8).bitwiseAND(F.lit((1 << 8 * (LOW + 1)) - 1))
    grams = totals.where("kind = 0").select("key", "n").repartition(parts, suffix).mapInArrow(_chances(low, order), "key bigint, value double")
    words = totals.where("kind = 1 and blocks > 1").select("key", F.lit(1).cast("tinyint").alias("kind"), F.col("n").cast("double").alias("value"))  # a block knows the others itself
    model = scratch.keep(grams.select("key", F.lit(0).cast("tinyint").alias("kind"), "value").unionByName(words), "model")
    scratch.drop("totals")
    brought = scratch.keep(asked.select("block", "kind", "key").join(model, ["key", "kind"]).select("block", "kind", "key", "value"), "brought")
    scratch.drop("asked", "model")
    result = "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"
    return rows.groupBy("block").cogroup(brought.groupBy("block")).applyInArrow(_score(order, int(found["tokens"] or 0), int(found["words"])), result)


def adaptive_bits(text: str | None, order: int = ORDER) -> float:
    """Code length in bits of a text that is learned as it is read, from nothing."""
    coded = b" ".join((text or "").encode().lower().split()) + bytes([END])
    counts: dict[bytes, dict[int, int]] = {}
    past, bits = bytes([END]) * order, 0.0
    for symbol in coded:
        excluded: set[int] = set()
        at, chance = order, 0.0
        while at >= 0:
            left = {s: n for s, n in counts.get(past[order - at :], {}).items() if s not in excluded}
            if left:
                whole = sum(left.values())
                if symbol in left:
                    chance = (left[symbol] - DISCOUNT) / whole
                    break
                bits -= np.log2(DISCOUNT * len(left) / whole)
                excluded |= left.keys()
            at -= 1
        bits -= np.log2(chance or 1 / (256 - len(excluded)))
        for k in range(max(at, 0), order + 1):  # update exclusion: contexts shorter than the one that knew it stay
            near = counts.setdefault(past[order - k :], {})
            near[symbol] = near.get(symbol, 0) + 1
        past = past[1:] + bytes([symbol])
    return float(bits)


def adaptive_score(docs: DataFrame, *, order: int = ORDER) -> DataFrame:
    """doc_id, bits: each whole text's own code length, without any training (null counts as empty).

    A Python loop over each text's bytes, for small inputs; ``score`` is the way for a corpus.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([adaptive_bits(x.as_py(), order) for x in batch.column("text")], pa.float64())], ["doc_id", "bits"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, "doc_id bigint, bits double")
