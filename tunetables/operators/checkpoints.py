"""Checkpoint listings: catalogue, latest, best and retention."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

KEEP_NEWEST = 3


def checkpoints(listing: DataFrame) -> DataFrame:
    """Directories called ``checkpoint-<digits>...`` with their step number."""
    name = F.substring_index("path", "/", -1)
    digits = F.regexp_extract(name, r"^checkpoint-([0-9]+)", 1)
    return listing.where(F.col("is_dir") & (digits != "")).withColumn(
        "step", digits.cast("decimal(38,0)")
    )


def latest_checkpoint(listing: DataFrame) -> DataFrame:
    """Path with the largest step of each run; none where a run has no checkpoint."""
    newest = F.max(F.struct("step", "path"))
    return checkpoints(listing).groupBy("run_id").agg(newest.alias("c")).select("run_id", "c.path")


def best_checkpoint(listing: DataFrame, metric: str = "eval_loss") -> DataFrame:
    """Checkpoint with the smallest metric of each run, the earliest on ties.

    A checkpoint that was never evaluated (NULL metric) can't be the best.
    """
    return (
        checkpoints(listing)
        .where(F.col(metric).isNotNull())
        .groupBy("run_id")
        .agg(F.min(F.struct(metric, "step", "path")).alias("c"))
        .select("run_id", F.col("c.path").alias("path"))
    )


def retained(
    listing: DataFrame, keep: int = KEEP_NEWEST, metric: str = "eval_loss"
) -> DataFrame:
    """Checkpoints kept by rotation: the newest ``keep`` of each run and, beside them, its best one.

    The newest are found with a limit pushed below the shuffle, so a long run sends
    only ``keep`` rows per task.
    """
    found = checkpoints(listing)
    newest_first = Window.partitionBy("run_id").orderBy(F.col("step").desc(), "path")
    newest = (
        found.withColumn("_rn", F.row_number().over(newest_first))
        .where(F.col("_rn") <= keep)
        .select("run_id", "path")
    )
    return newest.union(best_checkpoint(listing, metric)).distinct()
