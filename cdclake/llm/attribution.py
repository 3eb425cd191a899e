"""Token counts of fields and sections from one encoding of the whole document."""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .text import utf8

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: the pre-tokenisation pattern that belongs to this vocabulary.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# Fixed value: white space in the pattern's sense, in runs that are too long for the encoder's recursion.
LONG_BLANKS = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{1000,}")
SECTIONS = {"lines": rb"\n", "sentences": rb"[.!?]+[\"')\]]*\s+|\n+\s*"}  # a section ends with each match
RULES = ("start", "end", "largest")  # which section a token belongs to that lies in several
RESULT = "section int, start_char bigint, end_char bigint, n_tokens bigint, n_crossing bigint, token_share double"


def read_ranks(path: str) -> dict[bytes, int]:
    """A vocabulary file: a token in base64 and its rank on each line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}


def encode_whole(encoding, text: str, pattern: str = PATTERN) -> list[int]:
    """Token ids of a text with blanks of any length in a row.

    By ``PATTERN`` a run of blanks is one part up to its last blank, which goes with what follows; at the
    text's end all of it is. So the text can be cut around a long run without a change of its tokens. Texts for other patterns are not cut.
    """
    ids, at = [], 0
    for run in LONG_BLANKS.finditer(text) if pattern == PATTERN else ():
        stop = run.end() - (run.end() < len(text))
        ids += encoding.encode_ordinary(text[at : run.start()])
        ids += encoding._encode_single_piece(text[run.start() : stop])
        at = stop
    return ids + encoding.encode_ordinary(text[at:])


def spans_of(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte spans of consecutive tokens."""
    end = np.cumsum(lengths)
    return end - lengths, end


def allocate(start: np.ndarray, end: np.ndarray, cuts: np.ndarray, rule: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(tokens, crossing tokens, token share) of the sections [cuts[k], cuts[k + 1]).

    Both sides are sorted, so the interval join is a search of each token's two
    ends among the cuts. By ``rule`` a token counts for the section of its first byte,
    of its last byte, or of most of its bytes (the earlier one if equal). The share
    splits each token by bytes. So both columns add up to the number of tokens.
    """
    n = len(cuts) - 1
    first, last = np.searchsorted(cuts, start, "right") - 1, np.searchsorted(cuts, end, "left") - 1
    # Empty sections have no bytes: among equal cuts the search ends at the section that holds the byte.
    owner = (first if rule != "end" else last).copy()
    two = np.flatnonzero(last - first == 1)
    left, right = cuts[last[two]] - start[two], end[two] - cuts[last[two]]
    share = np.bincount(first[first == last], minlength=n).astype(np.float64)
    share += np.bincount(first[two], left / (left + right), n) + np.bincount(last[two], right / (left + right), n)
    crossing = np.bincount(first[two], minlength=n) + np.bincount(last[two], minlength=n)
    if rule == "largest":
        owner[two] = np.where(right > left, last[two], first[two])
    for t in np.flatnonzero(last - first > 1):
        k = np.arange(first[t], last[t] + 1)
        part = np.minimum(end[t], cuts[k + 1]) - np.maximum(start[t], cuts[k])
        share[k] += part / (end[t] - start[t])
        crossing[k[part > 0]] += 1
        if rule == "largest":
            owner[t] = k[part.argmax()]
    return np.bincount(owner, minlength=n), crossing, share


def _attribute(ranks, pattern: str, rule: str, ends: bytes, others: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import tiktoken

        section_end = re.compile(ends)
        table = ranks.value
        encoding = tiktoken.Encoding("attribution", pat_str=pattern, mergeable_ranks=table, special_tokens={})
        size = np.zeros(max(table.values()) + 1, np.int64)
        for token, rank in table.items():
            size[rank] = len(token)
        for batch in batches:
            data, off = utf8(batch.column("text"))
            given = batch.column("cuts")
            row, out = [], []
            for i in range(batch.num_rows):
                raw = data[off[i] : off[i + 1]]
                text = raw.tobytes()
                if given[i].is_valid:
                    cuts = np.r_[given[i].values.to_numpy(zero_copy_only=False).astype(np.int64), len(raw)]
                else:
                    breaks = np.array([m.end() for m in section_end.finditer(text)], np.int64)
                    cuts = np.r_[0, breaks[breaks < len(raw)], len(raw)]
                ids = np.array(encode_whole(encoding, text.decode(), pattern), np.int64)
                counts = allocate(*spans_of(size[ids]), cuts, rule)
                chars = np.r_[0, np.cumsum((raw & 0xC0) != 0x80)][cuts]
                n = len(cuts) - 1
                row.append(np.full(n, i))
                out.append((np.arange(n, dtype=np.int32), chars[:-1], chars[1:], *counts))
            if not out:
                continue
            cols = [np.concatenate(x) for x in zip(*out)]
            types = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.float64()]
            take = pa.array(np.concatenate(row))
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(x).take(take) for x in others], *[pa.array(c, t) for c, t in zip(cols, types)]],
                [*others, "section", "start_char", "end_char", "n_tokens", "n_crossing", "token_share"])

    return run


def _run(rows: DataFrame, vocabulary: str, pattern: str, rule: str, ends: bytes = b"\n") -> DataFrame:
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    others = [x for x in rows.columns if x not in ("text", "cuts")]
    fields = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in rows.schema.fields if f.name in others)
    ranks = rows.sparkSession.sparkContext.broadcast(read_ranks(vocabulary))  # a vocabulary's size doesn't follow the data
    return rows.mapInArrow(_attribute(ranks, pattern, rule, ends, others), fields + RESULT)


def section_tokens(docs: DataFrame, *, sections: str = "sentences", vocabulary: str = VOCABULARY, pattern: str = PATTERN, rule: str = "largest") -> DataFrame:
    """Tokens of each line or sentence of each whole text: a row per doc_id and section.

    section counts from 0; start_char and end_char are code points, the blanks
    after a section belong to it, so a word's token with a leading blank lies in
    two; n_tokens counts tokens by ``rule``, n_crossing those that lie in other
    sections too, token_share splits these by bytes. A null or empty text has one
    empty section. Repeated rows stay repeated; other columns are ignored. A document is one
    task's work, whatever its length.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.lit(None).cast("array<bigint>").alias("cuts"))
    return _run(rows, vocabulary, pattern, rule, SECTIONS[sections])


def field_tokens(table: DataFrame, key: str, fields: list[str], *, separator: str = "\n", vocabulary: str = VOCABULARY, pattern: str = PATTERN, rule: str = "largest") -> DataFrame:
    """Tokens of each of ``fields`` when their texts are encoded together, joined by ``separator``.

    Like ``section_tokens``, with the field's name in the column field; a separator belongs to the field before it. Null is empty.
    """
    parts = [F.coalesce(F.col(f"`{x}`").cast("string"), F.lit("")) for x in fields]
    parts = [F.concat(x, F.lit(separator)) if k < len(parts) - 1 else x for k, x in enumerate(parts)]
    cuts, at = [], F.lit(0).cast("long")
    for x in parts:
        cuts.append(at)
        at = at + F.octet_length(x)
    rows = table.select(F.col(f"`{key}`").alias(key), F.concat(*parts).alias("text"), F.array(*cuts).alias("cuts"))
    names = F.array(*[F.lit(x) for x in fields])
    return _run(rows, vocabulary, pattern, rule).withColumn("field", F.get(names, F.col("section")))
