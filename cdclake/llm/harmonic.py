"""Harmonic packing of whole documents into token sequences of a fixed length.

Lengths fall into reciprocal-capacity classes: class k holds what fits a
sequence k times but not k + 1 times. Sequences of class k take k documents each, which
every worker does for its own documents, without looking at any other's.
What is left free in them is filled with the documents of the smallest
classes, cut where a sequence is full.
"""

from __future__ import annotations

import json
import re
import sys
from collections.abc import Iterator
from itertools import chain
from types import ModuleType

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import Scratch
from .text import pieces

CAPACITY = 2048  # tokens of a sequence
VOCABULARY = "/opt/tokenizers/word_bpe_49k.json"
END = 1  # id that ends each document
SHARD_TOKENS = 1_000_000  # tokens that one task packs, about
LEAST_GAP = 8  # a smaller gap is padded, as no piece should be that short
PLAIN, LATIN = re.compile("[a-z]+"), re.compile("[a-zß-öø-ÿ]+")  # fixed values: words without capitals or marks
TOKENS = "doc_id bigint, n_tokens bigint, ids binary"
PIECES = "doc_id bigint, start bigint, length bigint, ids binary, doc_tokens bigint, sequence_id bigint, offset bigint, sequence_tokens bigint, class int"


class Encoder:
    """Ids of whole texts, special tokens not added, for vocabularies whose tokens never hold white space.

    ``vocabulary`` is the text of a tokenizer file. A text's ids are those of its parts between
    ASCII blanks. Parts that were met before, up to ``most`` of them, are not encoded again. If the
    tokenizer lower-cases and takes letters as words, texts are cut before punctuation
    and lower-cased first, so that more parts are alike, and parts that its rules leave as they are skip these.
    """

    def __init__(self, vocabulary: str, most: int = 350_000):
        from tokenizers import Tokenizer, normalizers

        self.tokenizer, self.bare, self.most = Tokenizer.from_str(vocabulary), None, most
        rules = json.loads(vocabulary)
        kinds = [[x["type"] for x in (rules.get(part) or {}).get(inner, [])] for part, inner in (("normalizer", "normalizers"), ("pre_tokenizer", "pretokenizers"))]
        if kinds == [["NFC", "Replace", "Lowercase"], ["Split", "ByteLevel"]]:
            self.bare = Tokenizer.from_str(json.dumps(rules | {"pre_tokenizer": rules["pre_tokenizer"]["pretokenizers"][1]}))
            self.bare.normalizer = normalizers.Sequence([])
        self._forget()

    def _forget(self) -> None:
        self.row: dict[str, int] = {}
        self.flat, self.size = np.empty(0, np.int32), np.empty(0, np.int64)

    def _ids(self, parts: list[str]) -> list[list[int]]:
        if self.bare is None:
            return [x.ids for x in self.tokenizer.encode_batch_fast(parts, add_special_tokens=False)]
        tokenize = self.bare.model.tokenize
        out = [[t.id for t in tokenize(x)] if PLAIN.fullmatch(x) else None for x in parts]
        rest = [k for k, x in enumerate(out) if x is None]
        for tokenizer, mine in ((self.bare, True), (self.tokenizer, False)):
            some = [k for k in rest if (LATIN.fullmatch(parts[k]) is not None) == mine]
            for k, x in zip(some, tokenizer.encode_batch_fast([parts[k] for k in some], add_special_tokens=False)):
                out[k] = x.ids
        return out

    def _learn(self, parts: list[str]) -> None:
        ids = self._ids(parts)
        self.row.update(zip(parts, range(len(self.row), len(self.row) + len(parts))))
        self.flat = np.concatenate([self.flat, np.fromiter(chain.from_iterable(ids), np.int32)])
        self.size = np.concatenate([self.size, np.fromiter((len(x) for x in ids), np.int64)])

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids, offsets, one more than texts); null is empty."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        if self.bare is not None:
            texts = pc.replace_substring_regex(texts, r"([A-Za-zÀ-ÖØ-öø-ÿ])([.,;:!?])", r"\1 \2")
            if not pc.any(pc.match_substring_regex(texts, r"<\||\p{M}")).as_py():  # special tokens, and marks that join small letters only
                texts = pc.ascii_lower(texts)
        split = pc.ascii_split_whitespace(texts)
        parts = split.flatten().dictionary_encode()
        words = parts.dictionary.to_pylist()
        new = [x for x in words if x not in self.row]
        if len(self.row) + len(new) > self.most:
            self._forget()
            new = words
        for i in range(0, len(new), 20_000):
            self._learn(new[i : i + 20_000])
        row = np.array([self.row[x] for x in words], np.int64)[parts.indices.to_numpy(zero_copy_only=False)]
        n = self.size[row]
        first = np.concatenate([[0], np.cumsum(n)])
        at = np.repeat(((np.cumsum(self.size) - self.size)[row] - first[:-1]).astype(np.int32), n)
        at += np.arange(first[-1], dtype=np.int32)
        return self.flat[at], first[np.asarray(split.offsets) - split.offsets[0].as_py()]


def _encoder(vocabulary: str) -> Encoder:
    """A worker process's encoder, kept from task to task with the parts that it knows."""
    held = sys.modules.setdefault("_cdclake_encoder", ModuleType("_cdclake_encoder"))
    if getattr(held, "vocabulary", None) != vocabulary:
        held.vocabulary, held.encoder = vocabulary, Encoder(vocabulary)
    return held.encoder


def _tokens(vocabulary, end: int, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoder(vocabulary.value)
        for batch in batches:
            texts = batch.column("text")
            size = np.concatenate([[0], np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))])
            for i, j in pieces(size, 2 << 20):
                ids, at = encode(texts.slice(i, j - i))
                ids = np.insert(ids, at[1:], end).astype(f"<u{width}")
                edge = (at + np.arange(len(at))) * width
                column = pa.Array.from_buffers(pa.large_binary(), j - i, [None, pa.py_buffer(edge.astype(np.int64)), pa.py_buffer(ids)])
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(i, j - i), pa.array(np.diff(edge) // width), column.cast(pa.binary())], ["doc_id", "n_tokens", "ids"])

    return run


def plan(sizes: np.ndarray, capacity: int = CAPACITY, least_gap: int = LEAST_GAP) -> dict[str, np.ndarray]:
    """Pieces (item, start, length, sequence, offset, class) of items of the given sizes, which stand in descending order.

    Whole capacities of an item fill sequences of their own (class 1). The rests stand in
    classes; the sequences of class k take k rests each, in order. Rests are placed so, class by class, as long as the gaps
    do not hold all rests that are still to come; these are then cut to fill the
    gaps one after another, the largest first. What is over, one capacity at most, makes
    sequences of powers of two, which need no padding. So only gaps
    below ``least_gap`` are left.
    """
    full, rest = sizes // capacity, sizes % capacity
    item = np.repeat(np.arange(len(sizes)), full)
    nth = np.arange(len(item)) - np.repeat(np.cumsum(full) - full, full)
    parts = [(item, nth * capacity, np.full(len(item), capacity), np.arange(len(item)), np.zeros(len(item), np.int64), np.ones(len(item), np.int64))]
    used = len(item)

    order = np.flatnonzero(rest)[np.argsort(-rest[rest > 0], kind="stable")]
    size = rest[order]
    kind = capacity // np.maximum(size, 1)  # reciprocal class
    new = np.r_[True, kind[1:] != kind[:-1]][: len(kind)]
    begin = np.flatnonzero(new)
    place = np.arange(len(kind)) - np.repeat(begin, np.diff(np.r_[begin, len(kind)]))
    opens = place % np.maximum(kind, 1) == 0
    bins = np.cumsum(opens) - 1
    last = np.flatnonzero(np.r_[opens[1:], True][: len(kind)])  # each bin's last rest
    fill = np.bincount(bins, size, len(last)).astype(np.int64) if len(kind) else np.empty(0, np.int64)
    gap = capacity - fill
    room = np.cumsum(np.where(gap >= least_gap, gap, 0))
    left = size.sum() - np.cumsum(fill)
    taken = int(np.argmax(room >= left)) if len(last) else 0  # bins that stay: in the next one the gaps would be more than enough
    cut = last[taken - 1] + 1 if taken else 0

    whole = slice(0, cut)
    before = np.cumsum(size[whole]) - size[whole]
    first = np.flatnonzero(opens[whole])
    parts.append((order[whole], (full * capacity)[order[whole]], size[whole], used + bins[whole], before - before[first][bins[whole]] if cut else before, kind[whole]))
    # The rests that fill gaps, as one line of tokens, meet the gaps and then the powers of two.
    sand = slice(cut, None)
    total = int(size[sand].sum())
    wide = np.flatnonzero(gap[:taken] >= least_gap)
    wide = wide[np.argsort(-gap[wide], kind="stable")]
    over = total - int(gap[wide].sum())
    powers = [1 << b for b in range(int(over).bit_length() - 1, -1, -1) if over >> b & 1] if over > 0 else []
    sequence = np.concatenate([used + wide, used + taken + np.arange(len(powers))]).astype(np.int64)
    fits = np.concatenate([gap[wide], powers]).astype(np.int64)
    at = np.concatenate([fill[wide], np.zeros(len(powers), np.int64)])
    ends, stops = np.cumsum(size[sand]), np.cumsum(fits)
    edges = np.union1d(ends, stops[stops < total]).astype(np.int64)
    low = np.concatenate([[0], edges[:-1]]) if len(edges) else edges
    of, into = np.searchsorted(ends, low, "right"), np.searchsorted(stops, low, "right")
    origin = order[sand][of]
    parts.append((origin, (full * capacity)[origin] + low - (ends - size[sand])[of], edges - low, sequence[into], at[into] + low - (stops - fits)[into], kind[sand][of]))
    return dict(zip(("item", "start", "length", "sequence", "offset", "class"), (np.concatenate(x).astype(np.int64) for x in zip(*parts))))


def _pack(capacity: int, least_gap: int, width: int):
    def run(key: tuple, table: pa.Table) -> pa.Table:
        shard = key[0].as_py()
        table = table.sort_by([("n_tokens", "descending"), ("doc_id", "ascending"), ("row", "ascending")])
        sizes = table.column("n_tokens").to_numpy().astype(np.int64)
        found = plan(sizes, capacity, least_gap)
        length = found["length"]
        ids = [memoryview(x.as_buffer()) for chunk in table.column("ids").chunks for x in chunk]
        cut = b"".join(ids[i][a * width : (a + n) * width] for i, a, n in zip(found["item"].tolist(), found["start"].tolist(), length.tolist()))
        edge = np.concatenate([[0], np.cumsum(length)]) * 4
        cut = pa.Array.from_buffers(pa.large_binary(), len(length), [None, pa.py_buffer(edge), pa.py_buffer(np.frombuffer(cut, f"<u{width}").astype("<u4"))]).cast(pa.binary())
        tokens = np.bincount(found["sequence"], length).astype(np.int64)
        item = pa.array(found["item"])
        return pa.table({
            "doc_id": table.column("doc_id").take(item), "start": pa.array(found["start"]), "length": pa.array(length), "ids": cut, "doc_tokens": table.column("n_tokens").take(item),
            "sequence_id": pa.array(found["sequence"] + (shard << 32)), "offset": pa.array(found["offset"]), "sequence_tokens": pa.array(tokens[found["sequence"]]), "class": pa.array(found["class"], pa.int32())})

    return run


def harmonic_pack(docs: DataFrame, *, capacity: int = CAPACITY, vocabulary: str = VOCABULARY, end: int = END, least_gap: int = LEAST_GAP, shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """Pieces of all documents' tokens and where each lies: a row per piece, each token in exactly one.

    doc_id, start (tokens of the document before the piece), length, ids (its
    tokens as little-endian unsigned 32-bit numbers), doc_tokens (with the end id), sequence_id, offset (in
    the sequence, without gaps from 0), sequence_tokens (its fill) and class (of
    the document's last part; 1 for whole capacities). A sequence holds
    ``capacity`` tokens, up to ``least_gap`` - 1 fewer, or a power of two. A null or
    empty text is its end id. Repeated rows are packed as often as they occur; ties go by doc_id, null last. An empty table has no pieces. Other columns are ignored.

    Texts are encoded once and written with their tokens. Tasks hold about ``shard_tokens`` tokens of
    documents dealt by a hash of the row's number, so no source, document or
    group of copies can fill one, and pack them on their own; a longer
    document is one task's work. Each task adds up to eleven short sequences, which is the price of packing in parallel.
    """
    scratch = Scratch(docs.sparkSession, "harmonic")
    with open(vocabulary, encoding="utf-8") as file:
        rules = file.read()
    largest = max([end, *(x["id"] for x in json.loads(rules).get("added_tokens", [])), *json.loads(rules)["model"]["vocab"].values()])
    width = 2 if largest < 1 << 16 else 4  # bytes of an id on its way
    held = docs.sparkSession.sparkContext.broadcast(rules)  # a vocabulary's size doesn't follow the data
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = texts.mapInArrow(_tokens(held, end, width), TOKENS).withColumn("row", F.monotonically_increasing_id())
    rows = scratch.keep(rows, "tokens")
    total = rows.agg(F.sum("n_tokens")).first()[0] or 0
    shards = max(1, -(-total // shard_tokens))
    dealt = rows.withColumn("shard", F.pmod(F.xxhash64("row"), F.lit(shards)))
    return dealt.groupBy("shard").applyInArrow(_pack(capacity, least_gap, width), PIECES)


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, ids, n_tokens) of packed pieces: whole sequences, without their padding."""
    held = packed.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", F.hex("ids").alias("ids")))).alias("held"), F.sum("length").alias("n_tokens"))
    return held.select("sequence_id", F.unhex(F.array_join(F.transform("held", lambda x: x["ids"]), "")).alias("ids"), "n_tokens")
