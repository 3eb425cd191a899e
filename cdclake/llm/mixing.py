"""Mixing sources to target weights by iterative proportional fitting."""

from __future__ import annotations

import logging
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .quality import words_of
from .scratch import Scratch

DIMENSIONS = ("source", "lang", "topic")
SMOOTHING = 0.7  # a target share is a value's token share to this power, unless targets are given
KEPT = 0.8  # share of all tokens that the sample is to hold
TOLERANCE = 1e-4  # largest relative error of a marginal that ends the fitting
SWEEPS = 50  # most sweeps over the dimensions
SEED = 20240607
LOG = logging.getLogger(__name__)


def topic_of(text: Column) -> Column:
    """A topic by form, for tables without a topic column: what kind of text it is."""
    size = F.length(text)
    return (F.when(F.size(F.split(text, "[#*$%&|<>]")) - 1 > 0.02 * size, "symbols")
            .when(text.rlike("[A-Z]{3,}!* [A-Z]{3,}"), "shouting").when(text.rlike("[0-9]{4,}"), "records")
            .when(size >= 4000, "long").when(size < 600, "short").otherwise("article"))


def described(docs: DataFrame) -> DataFrame:
    """docs with __source, __lang, __topic, __tokens (words and one end) and __draw in [0, 1)."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    own = lambda x, other: F.col(f"`{x}`").cast("string") if x in docs.columns else other
    none = F.lit(None).cast("string")
    draw = F.pmod(F.xxhash64(F.lit(SEED), F.col("doc_id").cast("long"), text), F.lit(2**53)) / F.lit(float(2**53))
    return docs.withColumns({"__source": own("source", none), "__lang": own("lang", none), "__topic": own("topic", topic_of(text)),
                             "__tokens": (F.size(words_of(text)) + 1).cast("double"), "__draw": draw})


def _targets(cells: DataFrame, name: str, shares: dict | None, smoothing: float) -> DataFrame:
    """(name, target) with targets that sum to 1 over the values that occur."""
    sums = cells.groupBy(name).agg(F.sum("tokens").alias("sum"))
    if shares is None:
        raw = sums.select(name, F.pow(F.col("sum"), F.lit(smoothing)).alias("target"))
    else:
        given = F.create_map(*[F.lit(x) for pair in shares.items() for x in (pair[0], float(pair[1]))])
        raw = sums.select(name, F.coalesce(F.element_at(given, F.col(name)), F.lit(0.0)).alias("target"))
    whole = raw.agg(F.sum("target").alias("whole")).first()["whole"] or 1.0
    return raw.select(name, (F.col("target") / F.lit(whole)).alias("target"))


def fit(docs: DataFrame, scratch: Scratch, *, targets: dict[str, dict[str, float]] | None = None, smoothing: float = SMOOTHING, kept: float = KEPT,
        tolerance: float = TOLERANCE, sweeps: int = SWEEPS) -> DataFrame:
    """Cells (__source, __lang, __topic, tokens, weight, probability, expected) of ``described`` docs.

    Each sweep multiplies the cells' weights, dimension by dimension, by target
    over present share. Only cell tables are read after the one aggregation of
    the documents; the driver sees three sums a sweep. ``expected`` copies of a document are in proportion to
    its cell's weight, above 1 too, so tokens x expected meet the targets; ``probability`` is cut off at 1.
    Marginals that contradict each other are never met: fitting ends after ``sweeps``, the last dimension (topic)
    is met and the others stay off. The largest relative error of each dimension is then logged as a warning.
    """
    names = [f"__{x}" for x in DIMENSIONS]
    cells = docs.groupBy(*names).agg(F.sum("__tokens").alias("tokens")).withColumn("weight", F.lit(1.0))
    cells = scratch.keep(cells, "cells0")
    total = cells.agg(F.sum("tokens")).first()[0]
    if not total:
        return cells.withColumns({"probability": F.lit(1.0), "expected": F.lit(float(kept))})
    wanted = {x: scratch.keep(_targets(cells, f"__{x}", (targets or {}).get(x), smoothing), f"target_{x}") for x in DIMENSIONS}

    def factors(now: DataFrame, x: str) -> DataFrame:
        name = f"__{x}"
        shares = now.groupBy(name).agg((F.sum(F.col("tokens") * F.col("weight")) / F.lit(total)).alias("share"))
        aim = wanted[x].withColumnRenamed(name, "value")
        return shares.join(aim, F.col(name).eqNullSafe(F.col("value"))).select("value", F.when(F.col("share") > 0, F.col("target") / F.col("share")).otherwise(F.lit(0.0)).alias("factor"), F.abs(F.col("share") - F.col("target")).alias("off"), "target")

    for sweep in range(1, sweeps + 1):
        now = cells
        for x in DIMENSIONS:
            now = now.join(factors(now, x), F.col(f"__{x}").eqNullSafe(F.col("value"))).select(*names, "tokens", (F.col("weight") * F.col("factor")).alias("weight"))
        now = scratch.keep(now, f"cells{sweep}")
        scratch.drop(f"cells{sweep - 1}")
        cells = now
        errors = reduce(DataFrame.unionByName, [factors(cells, x).select(F.lit(x).alias("dimension"), F.when(F.col("target") > 0, F.col("off") / F.col("target")).otherwise(F.col("off")).alias("off")) for x in DIMENSIONS])
        off = {r["dimension"]: r["off"] or 0.0 for r in errors.groupBy("dimension").agg(F.max("off").alias("off")).collect()}
        if max(off.values(), default=0.0) <= tolerance:
            break
    else:
        if sweeps > 0:
            LOG.warning("marginals not met after %d sweeps; largest relative error: %s", sweeps, ", ".join(f"{x} {off.get(x, 0.0):.4g}" for x in DIMENSIONS))

    # The scale at which probabilities of at most 1 keep the wanted tokens: cells that reach 1 leave, the others share the rest.
    aim, scale = kept * total, 0.0
    while True:
        full = F.col("weight") * F.lit(scale) >= 1
        sums = cells.agg(F.sum(F.when(full, F.col("tokens"))).alias("full"), F.sum(F.when(~full, F.col("tokens") * F.col("weight"))).alias("rest")).first()
        rest = sums["rest"] or 0.0
        larger = (aim - (sums["full"] or 0.0)) / rest if rest > 0 else scale
        if larger <= scale * (1 + 1e-12):
            break
        scale = larger
    weighted = cells.agg(F.sum(F.col("tokens") * F.col("weight"))).first()[0]
    return cells.withColumns({"probability": F.least(F.lit(1.0), F.col("weight") * F.lit(scale)), "expected": F.col("weight") * F.lit(aim / weighted if weighted else 0.0)})


def mix(docs: DataFrame, *, column: str = "mix", **options) -> DataFrame:
    """docs with a struct column named ``column``: source, lang, topic, n_tokens, weight, probability, sampled, expected, copies.

    Options are those of ``fit``. Weights are raked so that token shares meet
    the marginals of source, language and topic. ``copies`` is how often a document is to be in a
    mixture that meets them and holds ``kept`` of the tokens: the whole part of its cell's ``expected`` copies, and one
    more if its draw, a hash of doc_id and text, is below the rest. A document is ``sampled`` if its draw is below its cell's
    probability: once at most, so values that lack tokens stay below their targets. The result is the
    same however often it is computed. Null source, language or topic is a
    value of its own; a null text has one token. Repeated rows share their draw.
    All columns of docs stay; one named ``column`` already is an error.
    """
    if column in docs.columns:
        raise ValueError(f"the rows have a column {column!r} already; name another one for the result")
    scratch = Scratch(docs.sparkSession, "mixing")
    rows = described(docs)
    cells = scratch.keep(fit(rows, scratch, **options), "fitted").withColumnsRenamed({f"__{x}": f"__cell_{x}" for x in DIMENSIONS} | {"weight": "__weight", "probability": "__probability", "expected": "__expected"}).drop("tokens")
    match = reduce(Column.__and__, (F.col(f"__{x}").eqNullSafe(F.col(f"__cell_{x}")) for x in DIMENSIONS))
    out = rows.join(cells, match).withColumn(column, F.struct(
        *[F.col(f"__{x}").alias(x) for x in DIMENSIONS], F.col("__tokens").cast("long").alias("n_tokens"), F.col("__weight").alias("weight"),
        F.col("__probability").alias("probability"), (F.col("__draw") < F.col("__probability")).alias("sampled"),
        F.col("__expected").alias("expected"), (F.floor("__expected") + (F.col("__draw") < F.col("__expected") - F.floor("__expected")).cast("long")).alias("copies")))
    return out.select(*[F.col(f"`{x}`") for x in docs.columns], column)


def sample(docs: DataFrame, *, repeats: bool = False, **options) -> DataFrame:
    """The sampled rows of ``mix``, with the columns of docs; with ``repeats``, every row as often as its copies say."""
    rows = mix(docs, column="__mix", **options)
    if not repeats:
        return rows.where("__mix.sampled").drop("__mix")
    return rows.select(*[F.col(f"`{x}`") for x in docs.columns], F.explode(F.array_repeat(F.lit(0), F.col("__mix.copies").cast("int"))).alias("__copy")).drop("__copy")
