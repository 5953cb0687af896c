"""Checkpoint folders of training runs, listed from where they are stored."""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from itertools import batched

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A run's folder, an entry in it, and what lies below if the entry is a folder.
ENTRY = r"^(run_id=([^/]+)/[^/]+)(/.+)?$"
#: Names that Spark's file sources don't show.
HIDDEN = re.compile(r"\.|_(?!metadata|common_metadata)[^=]*$|.*\._COPYING_$", re.DOTALL)
HIDDEN_FILE = re.compile(r"\.|_[^=]*$", re.DOTALL)
PLACES = "path string, is_dir boolean"


def inside(folder: str) -> Iterator[tuple[str, bool]]:
    """What Spark's file sources would list in a local folder: its folders and its files that are not empty."""
    try:
        found = os.scandir(folder)
    except FileNotFoundError:  # gone since its own name was listed
        return
    with found:
        for entry in found:
            if HIDDEN.match(entry.name):
                continue
            if entry.is_dir():
                yield entry.path, True
                continue
            try:
                size = entry.stat().st_size
            except FileNotFoundError:  # gone, or a link to nothing
                continue
            if size and not HIDDEN_FILE.match(entry.name):
                yield entry.path, False


def _below(folder: str) -> Iterator[tuple[str, bool]]:
    for path, is_dir in inside(folder):
        if is_dir:
            yield from _below(path)
        else:
            yield path, False


def _opened(places: DataFrame, listed) -> DataFrame:
    """Files as they are, and in place of each folder what ``listed`` gives for it."""

    def found(frames):
        for frame in frames:
            for path, is_dir in zip(frame["path"], frame["is_dir"], strict=True):
                yield from listed(path) if is_dir else [(path, False)]

    def run(frames):
        import pandas as pd

        for rows in batched(found(frames), 10_000):
            yield pd.DataFrame(rows, columns=["path", "is_dir"])

    return places.mapInPandas(run, PLACES)


def local_files(spark: SparkSession, folder: str) -> DataFrame:
    """``path``: every file at any depth below a folder of the file system that the driver and all tasks share.

    Only the folder itself is listed by the driver.  The folders in it are listed by a task each, all that lies deeper
    by many tasks that get as many folders.
    """
    tasks = 2 * spark.sparkContext.defaultParallelism
    runs = spark.createDataFrame([*inside(folder)], PLACES)
    found = _opened(_opened(runs, inside).repartition(tasks), _below)
    return found.select(F.concat(F.lit("file:"), "path").alias("path"))


def checkpoint_folders(spark: SparkSession, path: str) -> DataFrame:
    """``(run_id, path, is_dir)``: every entry of the folders ``<path>/run_id=<run>/``, as ``checkpoints`` takes them.

    Files are listed by Spark in any store that it reads, and are not opened: those of a local (``file:``) folder by
    tasks, whenever the table is read, others by its file source, when it is made.  A folder is known by the files below
    it, at any depth, so an empty one is not listed, and neither are names that Spark hides (beginning with ``_`` or
    ``.``) and empty files.  Without a file there are no rows.
    """
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    place = store.makeQualified(folder)
    if place.toUri().getScheme() == "file" and store.isDirectory(place):
        files = local_files(spark, place.toUri().getPath())
    else:
        files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path")
    # a listed path is the qualified one: what was asked for stands in it without its scheme
    asked = F.lit(re.sub(r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", "", path).rstrip("/") + "/")
    start = F.instr("path", asked) + F.length(asked)
    below = F.substring("path", start, F.length("path"))
    entry, run, rest = (F.regexp_extract(below, ENTRY, group) for group in (1, 2, 3))
    return (
        files.where(entry != "")
        .select(run.cast("long").alias("run_id"), F.concat(F.substring("path", F.lit(1), start - 1), entry).alias("path"), (rest != "").alias("is_dir"))
        .distinct()
    )
