"""Training curves: chosen metrics, downsampled and smoothed, as a table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tunetables.operators import records, series, smoothing
from tunetables.session import lookup, written


def curve_table(
    log_lines: DataFrame,
    metrics: Sequence[str] = tuple(records.DEFAULT_METRICS),
    window: int | None = None,
    factor: int | None = None,
    max_points: int | None = None,
    method: str = "moving_average",
) -> DataFrame:
    """``(run_id, series, metric, label, step, x, raw, smoothed)``.

    Only training curves are smoothed; evaluation curves, and points before the
    first full window, have a NULL ``smoothed``.  The downsampled values are stored
    once: finding their places takes two passes, and the log itself is far larger.
    """
    parsed = records.series_records(records.good_records(log_lines))
    # by records: a run has trained also where only evaluation metrics are asked for
    trained = parsed.where(F.col("series") == "train").select("run_id").distinct()
    # other metrics need not travel through the shuffle that finds places
    names = {name for m in metrics for name in (m, f"eval_{m}")}
    parsed = records.with_metrics(parsed, sorted(names))
    values = written(records.unpivoted(series.downsampled(parsed, factor, max_points)), "curves")
    wanted = series.resolved_metrics(records.metric_sizes(values), metrics, trained=trained)
    wanted = written(wanted.select(*series.CURVE), "curve-list")
    chosen = lookup(values, wanted, series.CURVE, spread="line_no", how="left_semi").where(
        F.col("value").isNotNull()
    )
    train = chosen.where(F.col("series") == "train")
    if window and window > 1:
        train = smoothing.smoothed(train, method, window)
    else:
        train = train.withColumn("smoothed", F.lit(None).cast("double"))
    rest = chosen.where(F.col("series") == "eval").withColumn(
        "smoothed", F.lit(None).cast("double")
    )
    return train.unionByName(rest).select(
        *series.CURVE,
        series.curve_label(F.col("series"), F.col("metric")).alias("label"),
        "step",
        F.col("epoch").alias("x"),
        F.col("value").alias("raw"),
        "smoothed",
    )


def training_summary(log_lines: DataFrame) -> DataFrame:
    """One row per run: extent, best and final losses of both series."""
    parsed = records.series_records(records.good_records(log_lines))
    record = F.col("record")
    train, eval_ = F.col("series") == "train", F.col("series") == "eval"
    loss = F.when(train, records.number(record, "loss"))
    eval_loss = F.when(eval_, records.number(record, "eval_loss"))
    return parsed.groupBy("run_id").agg(
        F.max(F.when(train, F.col("epoch"))).alias("max_epoch"),
        F.max(F.when(train, F.col("step"))).alias("max_step"),
        F.min(loss).alias("best_loss"),
        F.max_by(loss, F.when(loss.isNotNull(), F.col("line_no"))).alias("final_loss"),
        F.min(eval_loss).alias("best_eval_loss"),
        F.max_by(eval_loss, F.when(eval_loss.isNotNull(), F.col("line_no"))).alias(
            "final_eval_loss"
        ),
    )
