"""Corpus figures from per-pair scores."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate
from math import exp, factorial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Cumulative probabilities of a Poisson(1) count, used to draw resampling weights.
POISSON_STEPS = list(accumulate(exp(-1) / factorial(k) for k in range(16)))


def mean_scores(pairs: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Mean of each per-pair score."""
    return pairs.groupBy(*by).agg(*[F.avg(c).alias(c) for c in columns])


def bootstrap_scores(
    pairs: DataFrame,
    columns: Sequence[str],
    by: Sequence[str] = (),
    resamples: int = 1000,
    seed: int = 0,
    confidence: float | None = None,
) -> DataFrame:
    """Median over resamples of each mean score; with ``confidence`` also the interval that holds this share of them.

    A resample weights every pair by a Poisson(1) count, drawn from 32 bits of an MD5 hash of the pair, the
    resample and ``seed``: the same weights on every run, retry and engine.  One hash serves four
    resamples.  Weighted sums are added map-side, so each task sends one row per resample.
    """
    hashed = F.md5(F.concat_ws(":", F.col("pair_id").cast("string"), F.col("_four").cast("string"), F.lit(str(seed))))
    drawn = pairs.select(*by, "pair_id", *columns, F.explode(F.sequence(F.lit(0), F.lit((resamples - 1) // 4))).alias("_four"))
    drawn = drawn.withColumn("_hash", hashed)
    bits = [F.conv(F.substring("_hash", 8 * k + 1, 8), 16, 10).cast("double") / float(1 << 32) for k in range(4)]
    each = F.array(*[F.struct((F.col("_four") * 4 + k).alias("_b"), unit.alias("_unit")) for k, unit in enumerate(bits)])
    drawn = drawn.select(*by, *columns, F.inline(each)).where(F.col("_b") < resamples)
    weight = sum((F.when(F.col("_unit") >= step, 1).otherwise(0) for step in POISSON_STEPS), F.lit(0))
    drawn = drawn.withColumn("_w", weight)
    sums = drawn.groupBy(*by, "_b").agg(
        *[(F.sum(F.col(c) * F.col("_w")) / F.nullif(F.sum("_w"), F.lit(0))).alias(c) for c in columns]
    )
    tail = (1 - confidence) / 2 if confidence else 0
    places = {"_low": tail, "": 0.5, "_high": 1 - tail} if confidence else {"": 0.5}
    return sums.groupBy(*by).agg(*[F.percentile(c, F.lit(place)).alias(c + name) for c in columns for name, place in places.items()])


def long_scores(wide: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """``(by..., metric, value)``; a value that is not a number becomes 0."""
    entries = F.array(
        *[
            F.struct(F.lit(c).alias("metric"), numeric_or_zero(F.col(c)).alias("value"))
            for c in columns
        ]
    )
    return wide.select(*by, F.inline(entries))


def numeric_or_zero(value: Column) -> Column:
    return F.coalesce(value.cast("string").try_cast("double"), F.lit(0.0))


def nested_metrics(columns: Sequence[str]) -> Column:
    """The flat metric columns present, as ``bleu``, ``rouge`` and ``bertscore`` structs."""
    parts = []
    if "bleu" in columns:
        precisions = [c for c in columns if c.startswith("precision_")]
        rest = ["brevity_penalty", "length_ratio", "translation_length", "reference_length"]
        parts.append(
            F.struct("bleu", F.array(*precisions).alias("precisions"), *rest).alias("bleu")
        )
    rouge = [c for c in columns if c.startswith("rouge")]
    if rouge:
        parts.append(F.struct(*rouge).alias("rouge"))
    if "bertscore" in columns:
        parts.append(F.struct(F.col("bertscore").alias("average_f1")).alias("bertscore"))
    return F.struct(*parts)
