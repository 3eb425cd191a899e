"""Exact removal of repeated strings of bytes or words by bucket refinement over sampled suffixes.

A 400-byte string is repeated when it starts anywhere else too; so is a run of 51 words, whatever blanks stand between them. Comparing all
suffixes would move many times the input, so only suffixes at content-defined
anchors are put into buckets, and every window of that length belongs to one anchor:

1. q-gram buckets: the anchors of all texts, by the long gram that every
   window of the anchor must contain. A bucket with one text is settled, and
   texts without a shared bucket leave.
2. the remaining texts get closer anchors. A bucket is refined by the identifier
   of its members' whole window range: members that agree are settled as repeated.
3. members that disagree are refined window by window, by the identifiers of
   the bytes at each later offset.

Identifiers are 64-bit hashes of the bytes they stand for; a window is compared
within its bucket, so two identifiers must collide for a wrong answer.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .anchors import GRAM, anchors
from .quality import words_of
from .scratch import Scratch
from .text import U, byte_hashes, mix, pieces, prefix_hash, prefix_sums, span_hash, utf8, word_spans

LENGTH = 400  # bytes of a repeated string
PASSAGE = 51  # words of a repeated passage
WIDE, NEAR = 16 / 25, 8 / 25  # most distance between a window's start and its anchor in the two rounds, by its length
EMPTY = hashlib.sha256(b"").hexdigest()


def _text() -> Column:
    return F.coalesce(F.col("text").cast("string"), F.lit(""))


def _key() -> Column:
    return F.unhex(F.md5(_text()))


def _short(key: Column) -> Column:
    return F.conv(F.hex(F.substring(key, 1, 8)), 16, -10).cast("long")


def symbols(data: np.ndarray, offsets: np.ndarray, unit: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hashes, offsets, first bytes, ends) of the bytes or words of texts; offsets count symbols."""
    if unit == "bytes":
        at = np.arange(len(data))
        return byte_hashes(data), offsets, at, at + 1
    start, end = word_spans(data, offsets)
    return span_hash(prefix_hash(data), start, end), np.searchsorted(start, offsets), start, end


def _first_round(length: int, spread: int, unit: str):
    """bucket, text (64 bits of its key), twice (the text holds the bucket twice)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, off = utf8(batch.column("text"))
            key = batch.column("key").to_numpy(zero_copy_only=False)
            for i, j in pieces(off, 2 << 20):
                values, first, _, _ = symbols(data[off[i] : off[j]], off[i : j + 1] - off[i], unit)
                row, at, _, _, sums = anchors(values, first, length, spread)
                bucket = span_hash(sums, at, at + length - spread + 1)
                order = np.lexsort((bucket, row))
                bucket, row = bucket[order], row[order]
                new = np.r_[True, (bucket[1:] != bucket[:-1]) | (row[1:] != row[:-1])][: len(bucket)]
                count = np.diff(np.r_[np.flatnonzero(new), len(bucket)])
                yield pa.RecordBatch.from_arrays([pa.array(bucket[new].view(np.int64)), pa.array(key[i + row[new]]), pa.array(count > 1)], ["bucket", "text_key", "twice"])

    return run


def _second_round(length: int, spread: int, unit: str):
    """bucket, inner (identifier of all symbols of the anchor's windows), key, at, low, high."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, off = utf8(batch.column("text"))
            for i, j in pieces(off, 2 << 20):
                values, rel, _, _ = symbols(data[off[i] : off[j]], off[i : j + 1] - off[i], unit)
                row, at, low, high, sums = anchors(values, rel, length, spread)
                bucket = span_hash(sums, at, at + length - spread + 1)
                inner = mix(span_hash(sums, low, high + length) + (at - low).astype(np.uint64) * U(0x9E3779B97F4A7C15))
                start = rel[row]
                ints = [pa.array((x - start).astype(np.int32)) for x in (at, low, high)]
                yield pa.RecordBatch.from_arrays([pa.array(bucket.view(np.int64)), pa.array(inner.view(np.int64)), batch.column("key").take(pa.array(i + row)), *ints], ["bucket", "inner", "key", "at", "low", "high"])

    return run


def _windows(length: int, unit: str):
    """bucket, window (identifier of one window and its place), inner, back (symbols from start to anchor), alone."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, off = utf8(batch.column("text"))
            for i, edges in enumerate(batch.column("edges")):
                sums = prefix_sums(symbols(data[off[i] : off[i + 1]], np.array([0, off[i + 1] - off[i]]), unit)[0])
                bucket, inner, at, low, high, alone = (edges.values.field(k).to_numpy(zero_copy_only=False) for k in ("bucket", "inner", "at", "low", "high", "alone"))
                n = high - low + 1
                row = np.repeat(np.arange(len(n)), n)
                start = (np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + low[row]).astype(np.int64)
                back = (at[row] - start).astype(np.int32)
                window = mix(span_hash(sums, start, start + length) + back.astype(np.uint64) * U(0x9E3779B97F4A7C15))
                yield pa.RecordBatch.from_arrays([pa.array(bucket[row]), pa.array(window.view(np.int64)), pa.array(inner[row]), pa.array(back), pa.array(alone[row])], ["bucket", "window", "inner", "back", "alone"])

    return run


def cut(text: bytes, low: np.ndarray, high: np.ndarray, length: int, unit: str = "bytes") -> tuple[bytes, int, int]:
    """(rest, bytes removed, runs removed): without the windows that start in any [low, high]; blanks around words stay."""
    data = np.frombuffer(text, np.uint8)
    _, _, first, end = symbols(data, np.array([0, len(data)]), unit)
    edge = np.zeros(len(first) + 2, np.int64)
    np.add.at(edge, low + 1, 1)
    np.add.at(edge, high + length + 1, -1)
    turns = np.diff((np.cumsum(edge) > 0).astype(np.int8))
    begin, stop = first[np.flatnonzero(turns == 1)], end[np.flatnonzero(turns == -1) - 1]
    gone = np.zeros(len(data) + 1, np.int64)
    np.add.at(gone, begin, 1)
    np.add.at(gone, stop, -1)
    gone = np.cumsum(gone[:-1]) > 0
    return data[~gone].tobytes(), int(gone.sum()), len(begin)


def _cut(length: int, unit: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, spans in zip(batch.column("text"), batch.column("spans")):
                out.append(cut(text.as_py().encode(), *(spans.values.field(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in ("low", "high")), length, unit))
            rest = [x[0] for x in out]
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), pa.array([x[1] for x in out], pa.int64()), pa.array([x[2] for x in out], pa.int64()),
                 pa.array([hashlib.sha256(x).hexdigest() for x in rest], pa.string()), pa.array([x.decode("utf-8", "ignore") for x in rest], pa.string())],
                ["key", "n_removed", "n_spans", "kept_sha256", "kept_text"])

    return run


def _removed(docs: DataFrame, length: int, unit: str, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """Copies (key, copies of two or more) that are long enough, and cut texts (key, n_removed, n_spans, kept_sha256, kept_text)."""
    if unit not in ("bytes", "words"):
        raise ValueError(f"unit must be bytes or words, not {unit!r}")
    least = length if unit == "bytes" else 2 * length - 1  # bytes of the shortest string that counts
    if int(length * WIDE) + GRAM > length:
        raise ValueError("length is too short for anchors")
    keyed = docs.select(_key().alias("key"), _text().alias("text"))
    wide = (keyed.select(_short(F.col("key")).alias("key"), "text").where(F.octet_length("text") >= least)
            .mapInArrow(_first_round(length, int(length * WIDE), unit), "bucket bigint, text_key bigint, twice boolean"))
    wide = scratch.keep(wide, "wide")
    shared = wide.groupBy("bucket").agg(F.min("text_key").alias("a"), F.max("text_key").alias("b")).where("a <> b").select("bucket")
    shared = scratch.keep(shared, "shared")  # as a table, so that the join may split a bucket that many texts share
    wanted = wide.join(shared.hint("merge"), "bucket").select("text_key").unionByName(wide.where("twice").select("text_key")).distinct()
    wanted = scratch.keep(wanted, "wanted")
    scratch.drop("wide", "shared")
    texts = keyed.withColumn("text_key", _short(F.col("key"))).join(wanted.hint("merge"), "text_key", "left_semi").groupBy("key").agg(F.first("text").alias("text"))
    texts = scratch.keep(texts, "texts")

    found = scratch.keep(texts.mapInArrow(_second_round(length, int(length * NEAR), unit), "bucket bigint, inner bigint, key binary, at int, low int, high int"), "near")
    groups = found.groupBy("bucket").agg(F.count("*").alias("m"), F.min("inner").alias("a"), F.max("inner").alias("b")).where("m > 1")
    groups = scratch.keep(groups.select("bucket", (F.col("a") != F.col("b")).alias("mixed")), "groups")
    members = scratch.keep(found.join(groups.hint("merge"), "bucket"), "members")
    scratch.drop("near", "groups")
    mixed = members.where("mixed")
    kinds = scratch.keep(mixed.groupBy("bucket", "inner").agg(F.count("*").alias("m"), F.min(F.struct("key", "at", "low", "high")).alias("one")), "kinds")
    edges = kinds.select(F.col("one.key").alias("key"), F.struct("bucket", "inner", "one.at", "one.low", "one.high", (F.col("m") == 1).alias("alone")).alias("edge"))
    windows = (texts.join(edges.groupBy("key").agg(F.collect_list("edge").alias("edges")), "key").select("text", "edges")
               .mapInArrow(_windows(length, unit), "bucket bigint, window bigint, inner bigint, back int, alone boolean"))
    windows = scratch.keep(windows, "windows")
    hits = scratch.keep(windows.groupBy("bucket", "window").count().where("count > 1").select("bucket", "window"), "hits")
    single = (windows.where("alone").join(hits.hint("merge"), ["bucket", "window"]).select("bucket", "inner", "back")
              .join(kinds.where("m = 1").select("bucket", "inner", "one.key", "one.at"), ["bucket", "inner"])
              .select("key", (F.col("at") - F.col("back")).alias("low"), (F.col("at") - F.col("back")).alias("high")))
    whole = members.where("not mixed").select("key", "low", "high")
    agreed = mixed.join(kinds.where("m > 1").select("bucket", "inner"), ["bucket", "inner"]).select("key", "low", "high")
    spans = whole.unionByName(agreed).unionByName(single).groupBy("key").agg(F.collect_list(F.struct("low", "high")).alias("spans"))
    out = scratch.keep(texts.join(spans, "key").mapInArrow(_cut(length, unit), "key binary, n_removed bigint, n_spans bigint, kept_sha256 string, kept_text string"), "cut")
    scratch.drop("texts", "members", "kinds", "windows", "hits", "wanted")
    copies = scratch.keep(keyed.where(F.octet_length("text") >= least).groupBy("key").agg(F.count("*").alias("copies")).where("copies > 1"), "copies")
    if unit == "words":  # few bytes may be many words
        held = keyed.join(copies.hint("merge"), "key").groupBy("key", "copies").agg(F.first("text").alias("text"))
        copies = scratch.keep(held.where(F.size(words_of(F.col("text"))) >= length).select("key", "copies"), "long_copies")
    return copies, out


def repeated_bytes(docs: DataFrame, *, length: int = LENGTH, passage: int | None = None) -> DataFrame:
    """What each row loses when every byte of a ``length``-byte string that starts anywhere else too goes.

    One row per input row: doc_id, n_bytes, n_removed, n_spans (maximal
    removed runs), kept_sha256 (of the bytes that are left). Strings are
    judged on the input, never across rows; overlaps count. Equal rows repeat
    each other, so both lose all if long enough. Null is empty text. Texts shorter than
    ``length`` lose nothing. doc_id may be null or repeated; other columns are ignored.
    With ``passage``, n_passages counts the row's maximal runs of words of which
    each lies in ``passage`` successive words that occur anywhere else too, in this row or another, whatever their bytes and blanks;
    a row that is a copy is one passage if it has so many words.

    A text that many rows hold is refined once. Bucket sizes are counted with
    map-side sums and found again by joins, so a string that a third of all
    rows hold is nobody's single task.
    """
    scratch = Scratch(docs.sparkSession, "substrings")
    copies, removed = _removed(docs, length, "bytes", scratch)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), _key().alias("key"), F.octet_length(_text()).cast("long").alias("n_bytes"), F.sha2(_text(), 256).alias("sha"))
    rows = rows.join(copies, "key", "left").join(removed.drop("kept_text"), "key", "left")
    twice, part = F.col("copies").isNotNull(), F.col("n_removed").isNotNull()
    pick = lambda whole, some, none: F.when(twice, whole).when(part, some).otherwise(none)
    more = []
    if passage:
        copies, removed = _removed(docs, passage, "words", Scratch(docs.sparkSession, "passages"))
        rows = rows.join(copies.select("key", F.lit(1).alias("whole")), "key", "left").join(removed.select("key", F.col("n_spans").alias("passages")), "key", "left")
        more = [F.coalesce("whole", "passages", F.lit(0)).cast("long").alias("n_passages")]
    return rows.select(
        "doc_id", "n_bytes", pick(F.col("n_bytes"), F.col("n_removed"), F.lit(0)).cast("long").alias("n_removed"),
        pick(F.lit(1), F.col("n_spans"), F.lit(0)).cast("long").alias("n_spans"), pick(F.lit(EMPTY), F.col("kept_sha256"), F.col("sha")).alias("kept_sha256"), *more)


def without_repeats(docs: DataFrame, *, length: int = LENGTH, unit: str = "bytes") -> DataFrame:
    """docs whose texts lost their repeated strings of ``length`` bytes or words; rows that have nothing left go, n_chars follows the text.

    Characters that lose some of their bytes go as a whole. Rows that lose nothing stay as they are, blank ones too.
    """
    scratch = Scratch(docs.sparkSession, "substrings")
    copies, removed = _removed(docs, length, unit, scratch)
    names = docs.columns
    key = "__substring_key"
    joined = (docs.withColumn(key, _key()).join(copies.select(F.col("key").alias(key), F.lit("").alias("__none")), key, "left")
              .join(removed.select(F.col("key").alias(key), F.col("kept_text").alias("__rest")), key, "left"))
    joined = joined.withColumn("__rest", F.coalesce("__none", "__rest")).where("__rest is null or __rest rlike '[^\\\\x20\\\\x09-\\\\x0D]'")
    cols = {x: F.col(f"`{x}`") for x in names} | {"text": F.coalesce("__rest", "text").alias("text")}
    if "n_chars" in names:
        cols["n_chars"] = F.when(F.col("__rest").isNull(), F.col("n_chars")).otherwise(F.length("__rest")).cast(docs.schema["n_chars"].dataType).alias("n_chars")
    return joined.select(*cols.values())
