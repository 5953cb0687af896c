"""Shared folder, written tables, and joins that stay safe with hot keys."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence
from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """Folder that every executor sees, as named by ``spark.checkpoint.dir``.

    A machine-local folder is used only when the setting is absent *and* the
    session is a local one (tests); on a cluster the setting is required.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    return _local_folder(spark.sparkContext.applicationId)


@cache
def _local_folder(application: str) -> str:
    return tempfile.mkdtemp(prefix=f"tunetables-{application}-")


def new_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, label: str) -> DataFrame:
    """Cut lineage: write ``df`` as Parquet in the shared folder and read it back.

    Used where a result feeds several later passes, or holds values (such as
    sorted positions) that must not change when a lost executor is replaced.
    """
    spark = df.sparkSession
    path = new_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def removed(spark: SparkSession, path: str) -> None:
    """Removes a folder that the caller has stored and needs no more."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def is_small(df: DataFrame, max_rows: int = 1 << 20, max_bytes: int = 64 << 20) -> bool:
    """Whether a table is proven small enough to broadcast.

    The proof is a job that counts its rows and the bytes of their strings, map-side
    first; pass tables that are stored or cheap to derive.
    """
    strings = [f.name for f in df.schema.fields if f.dataType.simpleString() == "string"]
    row_bytes = sum((F.octet_length(c) for c in strings), F.lit(16 * len(df.columns)))
    size = df.agg(
        F.count("*").alias("rows"), F.coalesce(F.sum(row_bytes), F.lit(0)).alias("bytes")
    ).first()
    return size["rows"] <= max_rows and size["bytes"] <= max_bytes


SPREAD = 64


def lookup(
    rows: DataFrame, table: DataFrame, on: Sequence[str], spread: str, how: str = "left"
) -> DataFrame:
    """Join rows to a table with one row per key, where some keys may be very common.

    A table proven small is broadcast.  A larger one is copied ``SPREAD`` times, each
    copy serving the rows whose ``spread`` column hashes to it, so the rows of a hot
    key are joined by many tasks.
    """
    on = list(on)
    if is_small(table):
        return rows.join(F.broadcast(table), on, how)
    copies = table.withColumn("_way", F.explode(F.sequence(F.lit(0), F.lit(SPREAD - 1))))
    way = F.pmod(F.xxhash64(spread), F.lit(SPREAD)).cast("int")
    return rows.withColumn("_way", way).join(copies, [*on, "_way"], how).drop("_way")


def hot_keys(counted: DataFrame, rows: str = "rows", share: int = 1000) -> DataFrame:
    """Keys holding more than one ``share``-th of all rows: fewer than ``share`` of them.

    ``counted`` has a row per key with its row count; it is read twice, so store it.
    """
    total = counted.agg(F.sum(rows)).scalar()
    return counted.where(F.col(rows) * share > total)
