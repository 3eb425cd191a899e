"""Conflict-constrained best-fit packing of documents into token windows."""

from __future__ import annotations

from bisect import bisect_left, insort
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .quality import words_of

CAPACITY = 2048  # tokens of a bin
SHARD_ROWS = 4096  # documents that one task packs, about
PLACED = "doc_id bigint, part int, parts int, start bigint, n_tokens bigint, bin_id bigint, bin_offset bigint, bin_tokens bigint"


def best_fit(sizes: list[int], sources: list[str | None], clusters: list[int | None], capacity: int) -> list[int]:
    """The bin of each item of at most ``capacity``, largest items first, ties by position.

    Open bins stand in order of residual space. The search starts at the first
    bin that is large enough and goes on to its successors until one holds
    neither the item's source nor its cluster; without one a bin is opened.
    A bin's sources and clusters are bitmaps. A null source or cluster conflicts with nothing.
    """
    order = sorted(range(len(sizes)), key=lambda i: (-sizes[i], i))
    bits = {x: 1 << k for k, x in enumerate(sorted({x for x in sources if x is not None}))}
    again = sorted(x for x, n in Counter(x for x in clusters if x is not None).items() if n > 1)
    marks = {x: 1 << k for k, x in enumerate(again)}  # a cluster with one item here can't conflict
    free: list[tuple[int, int]] = []
    held: list[list[int]] = []
    bins = [0] * len(sizes)
    for i in order:
        size, source, cluster = sizes[i], bits.get(sources[i], 0), marks.get(clusters[i], 0)
        at = bisect_left(free, (size, -1))
        while at < len(free) and (held[free[at][1]][0] & source or held[free[at][1]][1] & cluster):
            at += 1
        if at < len(free):
            room, b = free.pop(at)
        else:
            room, b = capacity, len(held)
            held.append([0, 0])
        held[b][0] |= source
        held[b][1] |= cluster
        bins[i] = b
        if room > size:
            insort(free, (room - size, b))
    return bins


def _pack(capacity: int):
    def run(key: tuple, table: pa.Table) -> pa.Table:
        shard = key[0].as_py()
        rows = sorted(table.to_pylist(), key=lambda r: (r["doc_id"] is None, r["doc_id"] or 0, r["cluster"]))
        rest = [(r["n_tokens"] - 1) % capacity + 1 for r in rows]
        bins = best_fit(rest, [r["source"] for r in rows], [r["cluster"] for r in rows], capacity)
        used, out = Counter(), []
        filled = max(bins, default=-1) + 1
        for r, size, b in zip(rows, rest, bins):
            parts = (r["n_tokens"] - 1) // capacity + 1
            for part in range(parts - 1):  # of a longer document each full piece has a bin of its own
                out.append([r["doc_id"], part, parts, part * capacity, capacity, filled, 0])
                used[filled] = capacity
                filled += 1
            out.append([r["doc_id"], parts - 1, parts, (parts - 1) * capacity, size, b, used[b]])
            used[b] += size
        names = ["doc_id", "part", "parts", "start", "n_tokens", "bin", "bin_offset"]
        cols = dict(zip(names, map(list, zip(*out)))) if out else {x: [] for x in names}
        bin_ids = cols.pop("bin")
        types = {"doc_id": pa.int64(), "part": pa.int32(), "parts": pa.int32()}
        arrays = {k: pa.array(v, types.get(k, pa.int64())) for k, v in cols.items()}
        arrays["bin_id"] = pa.array([shard << 32 | b for b in bin_ids], pa.int64())
        arrays["bin_tokens"] = pa.array([used[b] for b in bin_ids], pa.int64())
        return pa.table({x: arrays[x] for x in ("doc_id", "part", "parts", "start", "n_tokens", "bin_id", "bin_offset", "bin_tokens")})

    return run


def pack(docs: DataFrame, *, capacity: int = CAPACITY, shard_rows: int = SHARD_ROWS, cluster: str | None = None) -> DataFrame:
    """Where each document's tokens go: a row per piece, whole tables, nothing dropped.

    doc_id, part of parts, start (first token), n_tokens, bin_id, bin_offset
    and bin_tokens (the bin's fill). A document has its words and one end token, so a null or
    blank text has one. A document longer than ``capacity`` fills bins of its
    own but for its last piece. No bin holds two documents of one source or of one
    duplicate cluster: the column ``cluster``, or else equal words. A null source
    conflicts with none. Repeated rows are packed as often as they occur,
    in different bins. Other columns are ignored.

    Rows are dealt to tasks by a hash of the document, about ``shard_rows`` to
    each, so a source or cluster that holds a third of all rows spreads evenly; a
    shard leaves a few bins open at most, which is the price of packing in parallel.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    words = words_of(text)
    same = F.xxhash64(F.col(f"`{cluster}`")) if cluster else F.xxhash64(F.array_join(words, " "))
    source = F.col("source").cast("string") if "source" in docs.columns else F.lit(None).cast("string")
    items = docs.select(F.col("doc_id").cast("long").alias("doc_id"), source.alias("source"), (F.size(words) + 1).cast("long").alias("n_tokens"), same.alias("cluster"))
    shards = max(1, -(-docs.select("doc_id").count() // shard_rows))
    dealt = items.withColumn("shard", F.pmod(F.xxhash64("doc_id", "cluster", F.lit(11)), F.lit(shards)))
    return dealt.groupBy("shard").applyInArrow(_pack(capacity), PLACED)
