"""Named tables split into partitions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def save_splits(df: DataFrame, path: str) -> str:
    """Write a table with its ``split`` column as directories."""
    df.write.partitionBy("split").parquet(path)
    return path


def scan(spark: SparkSession, path: str, split: str | None = None) -> DataFrame:
    """Read a split table; a given split reads only that split's files."""
    table = spark.read.parquet(path)
    return table if split is None else table.where(F.col("split") == split)
