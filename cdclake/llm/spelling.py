"""Spelling variants: words of a vocabulary that differ by one edit, found by search in FM-indexes.

A search scheme for one error: of two words that differ by one edit, one
half of the first stands unchanged at the second's start or end. So words
meet by their halves, and each task holds an index over the delimited words
that it got. It matches a word's half exactly and extends the match over the other half,
allowing one error, as intervals of suffix ranks: from the right end in the
words as they are, from the left end in the words reversed.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scratch import Scratch

LEAST_LENGTH = 7  # code points of a word
LEAST_COUNT = 2  # occurrences of a word
RATIO = 10  # how many times as frequent a form is
INDEX_WORDS = 50_000  # words of one index, about
QUERY_WORDS = 200_000  # words that one task searches for, about
BATCH = 20_000  # words that are searched together
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LETTERS = "A-Za-zÀ-ÿ"  # fixed value: what words are made of
NEAR = "word string, n bigint, near string, near_n bigint"


def _codes(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all words, one after another, and the words' lengths."""
    return np.frombuffer("".join(words).encode("utf-32-le"), "<u4").astype(np.int64), np.array([len(w) for w in words], np.int64)


def _ranks(key: np.ndarray) -> np.ndarray:
    return np.unique(key, return_inverse=True)[1].astype(np.int64)


class Index:
    """FM-index over the text ``#w1#w2#...#wV#`` of distinct words in ascending order; ``#`` is symbol 0.

    ``key`` holds (symbol before a suffix, the suffix's rank) of all suffixes in
    order. The number of keys below (c, r) is where suffixes that begin with c and go on with
    one of a rank from r begin, so a backward step is two binary searches.
    """

    def __init__(self, words: list[str]):
        codes, size = _codes(words)
        self.alphabet = np.unique(codes)
        self.words = len(words)
        ends = np.cumsum(size + 1)  # where the # after each word stands
        n = int(ends[-1]) + 1 if len(words) else 1
        text = np.zeros(n, np.int64)
        letter = np.ones(n, bool)
        letter[0] = False
        letter[ends] = False
        text[letter] = np.searchsorted(self.alphabet, codes) + 1
        # Suffixes up to their #, by doubling; equal ones go by the word that follows, which is the next in order.
        stop = np.concatenate([[0], np.repeat(ends, size + 1)])  # the # that ends each position's word
        rank, h = text.copy(), 1
        while h <= (size.max() if len(words) else 0):
            later = np.arange(n) + h
            second = np.where(later <= stop, rank[np.minimum(later, n - 1)] + 1, 0)
            rank = _ranks(rank * (n + 2) + second)
            h *= 2
        follows = np.searchsorted(ends, stop, "left") + 1
        follows[0] = 0
        follows = np.where(stop == n - 1, 0, follows)
        follows[0] = 1 if len(words) else 0
        order = np.argsort(rank * (self.words + 2) + follows, kind="stable")
        self.n, self.before = n, text[order - 1]
        by = np.argsort(self.before, kind="stable")
        self.key = self.before[by] * n + by

    def symbols(self, codes: np.ndarray) -> np.ndarray:
        """Symbols of code points; those that no word holds get one that matches nothing."""
        at = np.searchsorted(self.alphabet, codes)
        known = self.alphabet[np.minimum(at, len(self.alphabet) - 1)] == codes if len(self.alphabet) else np.zeros(len(codes), bool)
        return np.where(known, at + 1, len(self.alphabet) + 1)

    def step(self, low: np.ndarray, high: np.ndarray, symbol: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank intervals of the suffixes that put ``symbol`` before those of [low, high)."""
        return np.searchsorted(self.key, symbol * self.n + low), np.searchsorted(self.key, symbol * self.n + high)

    def extensions(self, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(interval, symbol, low, high) for every letter that stands before a suffix of an interval."""
        wide = high - low > len(self.alphabet)
        some, all_ = np.flatnonzero(~wide), np.flatnonzero(wide)
        n = (high - low)[some]
        at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(low[some], n)
        kinds = len(self.alphabet) + 1
        seen = np.unique(np.repeat(some, n) * kinds + self.before[at])
        seen = np.concatenate([seen[seen % kinds > 0], (all_[:, None] * kinds + np.arange(1, kinds)).ravel()])
        of, symbol = seen // kinds, seen % kinds
        lo, hi = self.step(low[of], high[of], symbol)
        live = hi > lo
        return of[live], symbol[live], lo[live], hi[live]


def one_error(index: Index, words: list[str], exact: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(i, k): the k-th word of the index is words[i] with one error left of its last ``exact[i]`` letters.

    Each pair once, whichever edits make it.
    """
    codes, size = _codes(words)
    pattern = np.concatenate([index.symbols(codes), [0]])
    first = np.cumsum(size) - size
    none = np.empty(0, np.int64)
    q = np.arange(len(words))
    low, high = np.zeros(len(words), np.int64), np.full(len(words), index.words + 1, np.int64)
    todo = size.copy()  # letters not yet matched
    errors = [none] * 4
    found: list[np.ndarray] = []
    steps = 0
    while len(q) or len(errors[0]):
        steps += 1
        if steps % 32 == 0 and len(errors[0]):  # in long words, different edits often make the same text
            kept = np.unique((errors[0] * (size.max() + 1) + errors[3]) * index.n + errors[1], return_index=True)[1]
            errors = [x[kept] for x in errors]
        # The match so far has one error: it goes on exactly, to the # before the word.
        eq, elow, ehigh, etodo = errors
        done = etodo == 0
        if done.any():
            a, b = index.step(elow[done], ehigh[done], np.zeros(done.sum(), np.int64))
            n = b - a
            at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(a, n)
            found.append(np.repeat(eq[done], n) * (index.words + 1) + at)
        eq, elow, ehigh, etodo = (x[~done] for x in errors)
        elow, ehigh = index.step(elow, ehigh, pattern[first[eq] + etodo - 1])
        live = ehigh > elow
        parts = [[x[live]] for x in (eq, elow, ehigh, etodo - 1)]
        # Without an error so far: from the inexact half on, one may stand here.
        may = todo <= (size - exact)[q]
        mq, mlow, mhigh, mtodo = q[may], low[may], high[may], todo[may]
        of, symbol, lo, hi = index.extensions(mlow, mhigh)
        _append(parts, mq[of], lo, hi, mtodo[of])  # a letter too many
        open_ = mtodo > 0
        _append(parts, mq[open_], mlow[open_], mhigh[open_], mtodo[open_] - 1)  # a letter too few
        other = (mtodo[of] > 0) & (symbol != pattern[first[mq[of]] + mtodo[of] - 1])
        _append(parts, mq[of][other], lo[other], hi[other], mtodo[of][other] - 1)  # another letter
        errors = [np.concatenate(x) for x in parts]
        on = todo > 0
        q, low, high, todo = q[on], low[on], high[on], todo[on]
        low, high = index.step(low, high, pattern[first[q] + todo - 1])
        live = high > low
        q, low, high, todo = q[live], low[live], high[live], todo[live] - 1
    hits = np.unique(np.concatenate(found)) if found else none
    return hits // (index.words + 1), hits % (index.words + 1) - 1


def _append(parts: list[list[np.ndarray]], *columns: np.ndarray) -> None:
    for part, column in zip(parts, columns):
        part.append(column)


def _search(key: tuple, table: pa.Table) -> pa.Table:
    """Near words of one task's queries among its index words; those that share the first half come from the reversed side only."""
    reverse = key[0].as_py() == "start"
    query = table.column("query").to_numpy(zero_copy_only=False).astype(bool)
    rows = table.to_pydict()
    held = sorted({w[::-1] if reverse else w: n for w, n, x in zip(rows["word"], rows["n"], query) if not x}.items())
    asked = [(w, n) for w, n, x in zip(rows["word"], rows["n"], query) if x]
    out: list[tuple[str, int, str, int]] = []
    if held:
        index = Index([w for w, _ in held])
        for begin in range(0, len(asked), BATCH):
            some = asked[begin : begin + BATCH]
            exact = np.array([len(w) // 2 if reverse else len(w) - len(w) // 2 for w, _ in some], np.int64)
            for i, k in zip(*(x.tolist() for x in one_error(index, [w[::-1] if reverse else w for w, _ in some], exact))):
                word, n = some[i]
                near, near_n = held[k]
                near = near[::-1] if reverse else near
                if near != word and (reverse or not near.startswith(word[: len(word) // 2])):
                    out.append((word, n, near, near_n))
    columns = list(zip(*out)) or [[], [], [], []]
    return pa.table({"word": pa.array(columns[0], pa.string()), "n": pa.array(columns[1], pa.int64()), "near": pa.array(columns[2], pa.string()), "near_n": pa.array(columns[3], pa.int64())})


def near_words(words: DataFrame, scratch: Scratch, *, index_words: int = INDEX_WORDS, query_words: int = QUERY_WORDS) -> DataFrame:
    """(word, n, near, near_n): all ordered pairs of ``words`` (word, n; distinct, two code points or more) that differ by one edit.

    A word is asked for by its first and by its second half, and indexed by the starts and
    ends that the halves of words with its length, one more or one less have. Halves are dealt to cells
    by hash; a cell with more words than one index should hold is split, also if
    one half fills it, and so are its queries.
    """
    size, half = F.length("word"), lambda n: F.floor(n / 2).cast("int")
    starts = F.array_distinct(F.array(half(size - 1), half(size), half(size + 1)))
    ends = F.array_distinct(F.array(size - 1 - half(size - 1), size - half(size), size + 1 - half(size + 1)))

    def keyed(side: str, lengths: Column, query: bool) -> DataFrame:
        part = F.substring("word", F.lit(1), F.col("k")) if side == "start" else F.substring(F.col("word"), size - F.col("k") + 1, F.col("k"))
        return words.withColumn("k", F.explode(lengths)).where("k > 0").select(F.lit(side).alias("side"), part.alias("part"), "word", "n", F.lit(query).alias("query"))

    routed = [keyed("start", F.array(half(size)), True), keyed("end", F.array(size - half(size)), True), keyed("start", starts, False), keyed("end", ends, False)]
    cells = max(1, -(-2 * words.count() // index_words))
    rows = routed[0].unionByName(routed[1]).unionByName(routed[2]).unionByName(routed[3])
    rows = rows.withColumn("cell", F.pmod(F.xxhash64("side", "part"), F.lit(cells))).select("side", "cell", "word", "n", "query").distinct()
    rows = scratch.keep(rows, "routed")
    over = rows.groupBy("side", "cell").agg(F.ceil(F.count_if(~F.col("query")) / index_words).cast("int").alias("indexes"), F.ceil(F.count_if("query") / query_words).cast("int").alias("batches"))
    split = rows.join(over, ["side", "cell"])
    drawn = lambda n: F.array(F.pmod(F.xxhash64("word"), F.greatest(n, F.lit(1))).cast("int"))
    every = lambda n: F.sequence(F.lit(0), F.greatest(n, F.lit(1)) - 1)
    split = split.withColumn("index", F.explode(F.when(F.col("query"), every(F.col("indexes"))).otherwise(drawn(F.col("indexes")))))
    split = split.withColumn("batch", F.explode(F.when(F.col("query"), drawn(F.col("batches"))).otherwise(every(F.col("batches")))))
    return split.groupBy("side", "cell", "index", "batch").applyInArrow(_search, NEAR)


def vocabulary(docs: DataFrame, *, drop_every: int = 0, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT) -> DataFrame:
    """(word, n) of all runs of letters, A-Z in lower case, that are long and frequent enough.

    With ``drop_every``, a run loses a letter if the checksum of ``<doc_id>:<run>`` is a
    multiple of it: the letter at the checksum modulo the run's length. A null doc_id counts as empty text there.
    """
    letters = F.regexp_extract_all(F.col("text").cast("string"), F.lit(f"[{LETTERS}]{{{least_length},}}"), F.lit(0))
    runs = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc"), F.explode(letters).alias("run"))
    plain = F.length("run") == F.octet_length("run")  # of such runs, only A-Z have a lower case
    runs = runs.select("doc", F.when(plain, F.lower("run")).otherwise(F.translate("run", UPPER, LOWER)).alias("word"))
    if drop_every:
        sum_ = F.crc32(F.concat("doc", F.lit(":"), "word"))
        runs = runs.select("word", sum_.alias("sum")).select(F.when(F.col("sum") % drop_every != 0, F.col("word")).otherwise(_without("word", F.col("sum") % F.length("word"))).alias("word"))
    return runs.where(F.length("word") >= least_length).groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least_count)


def _without(word: str, at: Column) -> Column:
    return F.concat(F.substring(word, F.lit(1), at.cast("int")), F.substring(F.col(word), (at + 2).cast("int"), F.length(word)))


def spelling_variants(docs: DataFrame, *, drop_every: int = 0, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT, ratio: int = RATIO) -> DataFrame:
    """Every word of the whole texts with the word that it is a variant of.

    word, n (occurrences), n_near (words that differ by one inserted, deleted or replaced code point),
    form (the near word with the most occurrences, the first in code-point order of equal
    ones, if it has ``ratio`` times the word's; else null), form_n, root (where forms lead to from the word; itself without one).
    Null and empty texts have no words, an empty table no rows. Repeated rows count as often as they occur. Columns other than doc_id and text are ignored.

    Occurrences are counted with map-side sums, so a word that makes up a third of
    the corpus is one row a task. A word has at most about two thousand near words, which their number bounds.
    """
    scratch = Scratch(docs.sparkSession, "spelling")
    words = scratch.keep(vocabulary(docs, drop_every=drop_every, least_length=least_length, least_count=least_count), "words")
    near = near_words(words, scratch)
    best = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("form"))).alias("best")
    found = near.groupBy("word").agg(F.count("*").alias("n_near"), best)
    known = words.join(found, "word", "left")
    has = -F.col("best.less") >= ratio * F.col("n")
    known = scratch.keep(known.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(has, F.col("best.form")).alias("form"), F.when(has, -F.col("best.less")).alias("form_n")), "known")
    scratch.drop("routed", "words")
    # A form has ratio times the occurrences, so a chain is short; each round doubles the way that is known.
    to = scratch.keep(known.where("form is not null").select("word", F.col("form").alias("root")), "root0")
    step = 0
    while to.join(to.select(F.col("word").alias("root")), "root", "left_semi").limit(1).count():
        further = to.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step += 1
        to = scratch.keep(to.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root")), f"root{step}")
        scratch.drop(f"root{step - 1}")
    return known.join(to, "word", "left").select("word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))
