"""Downsampling of log series and choice of metrics.

Positions come from ``with_position``, so a run of any length is spread over tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tunetables.operators.ordering import with_position

RUN_SERIES = ["run_id", "series"]
CURVE = ["run_id", "series", "metric"]
MAX_POINTS = 1000
EVAL_SHARE = 4  # evaluation series may keep a quarter of the points


def every_kth(df: DataFrame, k: int, keys: Sequence[str], order: str = "line_no") -> DataFrame:
    """Rows at positions 0, k, 2k, ... of each group."""
    return with_position(df, keys, order).where(F.col("pos") % k == 0).drop("pos", "n")


def auto_factor(n: Column, max_points: int) -> Column:
    """Step that brings ``n`` points down to about ``max_points``; NULL when few enough."""
    return F.when(n > max_points, F.greatest(F.lit(1), F.floor(n / max_points)))


def downsample_step(factor: int | None, max_points: int | None) -> Column:
    """Step of a row's series, from ``series``, its ``n`` and its run's ``train_n``.

    Training series use ``factor``, else the automatic step.  Evaluation series use
    half of the training step where there is one, else their own automatic step.
    """
    none = F.lit(None).cast("long")
    if factor:
        train = F.lit(factor).cast("long")
    else:
        train = auto_factor(F.col("train_n"), max_points) if max_points else none
    own = auto_factor(F.col("n"), max_points // EVAL_SHARE) if max_points else none
    half = F.when(train.isNotNull(), F.greatest(F.lit(1), F.floor(train / 2)))
    step = F.when(F.col("series") == "train", train).otherwise(F.coalesce(half, own))
    return F.coalesce(step, F.lit(1))


def downsampled(
    series: DataFrame, factor: int | None = None, max_points: int | None = None
) -> DataFrame:
    """Every k-th record of each series, with k from ``downsample_step``.

    Without ``factor`` and ``max_points`` (``MAX_POINTS`` is a usual one) all records stay.
    Sampling is by record, so all metrics of a kept record stay aligned on its step.
    """
    train_n = {"train_n": (["run_id"], F.col("series") == "train")}
    placed = with_position(series, RUN_SERIES, "line_no", wider=train_n)
    return placed.where(F.col("pos") % downsample_step(factor, max_points) == 0).drop(
        "pos", "n", "train_n"
    )


def resolved_metrics(
    available: DataFrame,
    requested: Sequence[str],
    dedup: bool = True,
    trained: DataFrame | None = None,
) -> DataFrame:
    """``(run_id, place, requested, series, metric)``: curves to draw for each run.

    A requested metric gives a training curve if the run has it, and an evaluation
    curve named ``eval_<metric>`` if present, else ``<metric>``.  Without ``dedup`` an
    evaluation curve asked for under both names comes twice.  Runs without training
    records have no curves: ``trained`` holds the ``run_id`` of those that have some; without
    it, runs with a training value in ``available`` count.
    """
    candidates = []
    for place, name in enumerate(requested):
        candidates.append((place, name, "train", name, 0))
        # evaluation metrics are best found under their own prefix
        names = dict.fromkeys(["eval_" + name.removeprefix("eval_"), name])
        candidates += [(place, name, "eval", found, choice) for choice, found in enumerate(names)]
    # three rows per requested name
    wanted = available.sparkSession.createDataFrame(
        candidates, "place long, requested string, series string, metric string, choice int"
    )
    if trained is None:
        trained = available.where(F.col("series") == "train").select("run_id").distinct()
    found = (
        available.select(*CURVE)
        .join(trained, "run_id", "left_semi")
        .join(F.broadcast(wanted), ["series", "metric"])
        .groupBy("run_id", "place", "requested", "series")
        .agg(F.min_by("metric", "choice").alias("metric"))
    )
    if not dedup:
        return found
    return (
        found.groupBy(*CURVE)
        .agg(F.min(F.struct("place", "requested")).alias("f"))
        .select("run_id", "f.place", "f.requested", "series", "metric")
    )


def curve_label(series: Column, metric: Column) -> Column:
    """Name shown for a curve: evaluation curves carry the ``eval_`` prefix."""
    unprefixed = (series == "eval") & ~F.startswith(metric, F.lit("eval_"))
    return F.when(unprefixed, F.concat(F.lit("eval_"), metric)).otherwise(metric)


def curve_title(label: Column) -> Column:
    return F.initcap(F.replace(F.replace(label, F.lit("/"), F.lit(" ")), F.lit("_"), F.lit(" ")))
