"""Content-defined anchors of windows of bytes or words, found for many texts at once."""

from __future__ import annotations

import numpy as np

from .text import U, prefix_sums, span_hash

GRAM = 16  # symbols that are hashed at each position to choose anchors


def window_minima(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` consecutive values, by running minima of blocks from both sides."""
    n = len(values)
    padded = np.full(-(-n // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = values
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).reshape(-1)
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return np.minimum(behind[: n - width + 1], ahead[width - 1 : n])


def anchors(values: np.ndarray, offsets: np.ndarray, length: int, spread: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row, anchor, low, high, sums) of all windows of ``length`` symbols of the texts; values are the symbols' hashes.

    Windows that start in [low, high] have the same anchor, at most
    ``spread - 1`` bytes after the start: the last least-hashed gram among their first
    ``spread`` positions. So equal windows have their anchor at the same place,
    whatever surrounds them. sums is the prefix hash, for ``span_hash``.
    """
    sums = prefix_sums(values)
    empty = np.empty(0, np.int64)
    size = np.diff(offsets)
    if not (size >= length).any():
        return empty, empty, empty, empty, sums
    at = np.arange(len(values) - GRAM + 1)
    bits = U(int(len(values)).bit_length())
    grams = span_hash(sums, at, at + GRAM)
    last = U((1 << int(bits)) - 1)
    least = window_minima((grams >> bits << bits) | (last - at.astype(np.uint64)), spread)
    where = (last - (least & last)).astype(np.int64)
    rows = np.flatnonzero(size >= length)
    count = size[rows] - length + 1
    row = np.repeat(rows, count)
    start = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + offsets[row]
    anchor = where[start]
    new = np.r_[True, (anchor[1:] != anchor[:-1]) | (row[1:] != row[:-1])]
    first = np.flatnonzero(new)
    final = np.r_[first[1:], len(start)] - 1
    return row[first], anchor[first], start[first], start[final], sums
