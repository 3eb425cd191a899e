"""Vectorised helpers on Arrow text columns: words, their hashes and word shingles.

Every function works on the UTF-8 bytes of whole texts, for many documents at
once. Words are the maximal runs of bytes other than 0x20 and 0x09-0x0D. Hashes
are 64-bit, the same in every process and on every machine.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U = np.uint64
BLANK = np.zeros(256, bool)
BLANK[[32, 9, 10, 11, 12, 13]] = True

_rng = np.random.default_rng(20240607)
_BYTE = _rng.integers(0, 2**64, 256, dtype=np.uint64)
_BASE = U(0x9E3779B97F4A7C15)
_BASE_INV = U(pow(0x9E3779B97F4A7C15, -1, 2**64))
_STEP = _rng.integers(1, 2**63, 8, dtype=np.uint64) * U(2) + U(1)
_powers: dict[str, np.ndarray] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """At least n powers of the hash base and of its inverse, modulo 2**64."""
    if len(_powers.get("up", ())) < n:
        size = 1 << max(16, int(n).bit_length())
        for name, base in (("up", _BASE), ("down", _BASE_INV)):
            x = np.full(size, base, np.uint64)
            x[0] = 1
            _powers[name] = np.cumprod(x, dtype=np.uint64)
    return _powers["up"], _powers["down"]


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (a bijection), so that all output bits depend on all input bits."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U(27))
    x = x * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def utf8(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets (one more than rows) of a text column; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not len(column):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return raw[off[0] : off[-1]], off - off[0]


def pieces(offsets: np.ndarray, most: int = 4 << 20) -> Iterator[tuple[int, int]]:
    """Ranges of rows that hold about ``most`` bytes, or one longer text."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + most, "right")) - 1)
        yield i, j
        i = j


def prefix_sums(values: np.ndarray) -> np.ndarray:
    """Running hash sums of symbols' hashes, one more than symbols; ``span_hash`` reads spans from them."""
    up, _ = powers(len(values) + 1)
    out = np.empty(len(values) + 1, np.uint64)
    out[0] = 0
    np.cumsum(values * up[: len(values)], out=out[1:])
    return out


def byte_hashes(data: np.ndarray) -> np.ndarray:
    return _BYTE[data]


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """``prefix_sums`` of bytes."""
    return prefix_sums(byte_hashes(data))


def span_hash(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of the byte strings [start, end): equal strings have equal hashes wherever they stand."""
    _, down = powers(len(sums))
    return mix((sums[end] - sums[start]) * down[start] + (end - start).astype(np.uint64))


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each word; no word crosses a text's end."""
    if not len(data):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    solid = ~BLANK[data]
    first, last = solid.copy(), solid.copy()
    first[1:] &= ~solid[:-1]
    last[:-1] &= ~solid[1:]
    inner = offsets[:-1][offsets[1:] > offsets[:-1]]
    first[inner] = solid[inner]
    tail = offsets[1:][offsets[1:] > offsets[:-1]] - 1
    last[tail] = solid[tail]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word, and per text the index of its first word (one more than texts)."""
    start, end = word_spans(data, offsets)
    return span_hash(prefix_hash(data), start, end), np.searchsorted(start, offsets)


def shingles(hashes: np.ndarray, first: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each text's runs of ``size`` words, and per text the index of its first run.

    A text of fewer words, but at least one, has a single run of all its words.
    """
    n = np.diff(first)
    short = np.flatnonzero((n > 0) & (n < size))
    count = np.where(n >= size, n - size + 1, (n > 0).astype(np.int64))
    at = np.concatenate([[0], np.cumsum(count)])
    total = len(hashes) - size + 1
    if total > 0:
        runs = np.zeros(total, np.uint64)
        for k in range(size):
            runs += hashes[k : k + total] * _STEP[k]
        inside = np.ones(total, bool)
        for k in range(1, size):
            cut = first[1:-1] - k
            inside[cut[(cut >= 0) & (cut < total)]] = False
        runs = mix(runs[inside])
    else:
        runs = np.empty(0, np.uint64)
    if not len(short):
        return runs, at
    out = np.empty(at[-1], np.uint64)
    single = np.zeros(at[-1], bool)
    single[at[short]] = True
    out[~single] = runs
    out[single] = mix(np.array([(hashes[first[i] : first[i + 1]] * _STEP[: n[i]]).sum() + U(n[i]) for i in short], np.uint64))
    return out, at
