"""Training-log files: one JSON record per line, a folder per run."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tunetables.operators.ordering import ranked
from tunetables.operators.records import json_object, number, record_line
from tunetables.session import lookup, written


def log_lines(records: DataFrame) -> DataFrame:
    """``(run_id, value)``: each normalised record as one compact JSON line."""
    line = record_line(F.col("type"), F.col("step"), F.col("epoch"), F.col("metrics"))
    return records.select("run_id", line.alias("value"))


def append_log(records: DataFrame, path: str) -> str:
    """Append records to the log, one folder per run.

    A run that is resumed keeps its earlier lines.  Records are gathered by run and step, so that
    many runs give few files each, a long run many tasks, and its files follow each other by name.
    """
    ordered = records.repartitionByRange("run_id", "step").sortWithinPartitions("run_id", "step")
    log_lines(ordered).write.mode("append").partitionBy("run_id").text(path)
    return path


def append_raw_log(raw: DataFrame, path: str, logs: str = "logs", order: str | None = None) -> str:
    """Append trainer records as they are, one folder per run, by a column that says their ``order`` if given."""
    if order:
        raw = raw.repartitionByRange("run_id", order).sortWithinPartitions("run_id", order)
    raw.select("run_id", logs).write.mode("append").partitionBy("run_id").text(path)
    return path


def append_summaries(summaries: DataFrame, path: str) -> str:
    """Append the closing summary record of each finished run to its log."""
    finished = summaries.where("training_completed")
    record = F.to_json(
        F.struct(
            F.lit("summary").alias("type"),
            "total_steps",
            "total_epochs",
            "best_metric",
            "training_completed",
        ),
        {"ignoreNullFields": "false"},
    )
    lines = finished.select("run_id", record.alias("value"))
    lines.write.mode("append").partitionBy("run_id").text(path)
    return path


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """Lines of a log folder as ``(run_id, line)``, in no order; see ``numbered_log`` and ``log_by_step``."""
    lines = spark.read.text(path)
    return lines.select(F.col("run_id").cast("long"), F.col("value").alias("line"))


#: Files of one write carry its name; they follow each other by number, writes by their first file's time.
WRITE = r"^part-[0-9]+-([0-9a-f-]{36})"


def log_blocks(lines: DataFrame) -> DataFrame:
    """``run_id, _file, _block, _first, _start``: what each byte range that Spark reads holds of its run.

    ``_first`` is the id of its first line, ``_start`` the number of the run's lines before it.  A range is a
    row, however many lines it has.
    """
    name = F.substring_index("_file", "/", -1)
    write = F.regexp_extract(name, WRITE, 1)
    counted = lines.groupBy("run_id", "_file", "_block").agg(
        F.count("*").alias("_lines"), F.min("_row").alias("_first"), F.max("_written").alias("_written")
    )
    counted = written(counted, "log-blocks").withColumn("_write", F.when(write != "", write).otherwise(name))
    begun = F.min("_written").over(Window.partitionBy("run_id", "_write"))
    earlier = Window.partitionBy("run_id").orderBy("_begun", "_write", "_file", "_block").rowsBetween(Window.unboundedPreceding, -1)
    return counted.withColumn("_begun", begun).select(
        "run_id", "_file", "_block", "_first", F.coalesce(F.sum("_lines").over(earlier), F.lit(0)).alias("_start")
    )


def numbered_log(spark: SparkSession, path: str) -> DataFrame:
    """Lines of a log folder as ``(run_id, line_no, line)``, numbered from 0 in each run as they stand in its files.

    Files of one write come by name, later writes behind, so a resumed run's records, blank, broken and
    summary lines all keep their place.  Lines are counted in the byte ranges that Spark reads,
    the counts (a row a range) are added up, and each line is its range's start plus its place in it:
    no line is sorted or shuffled.  The table needs the files to stay as they were when it was made.
    """
    split = F.col("_metadata")
    lines = spark.read.text(path).select(
        F.col("run_id").cast("long").alias("run_id"),
        F.col("value").alias("line"),
        split["file_path"].alias("_file"),
        split["file_block_start"].alias("_block"),
        split["file_modification_time"].alias("_written"),
        F.monotonically_increasing_id().alias("_row"),
    )
    place = ["run_id", "_file", "_block"]
    found = lookup(lines, written(log_blocks(lines), "log-starts"), place, spread="_row", how="inner")
    return found.select("run_id", (F.col("_start") + F.col("_row") - F.col("_first")).alias("line_no"), "line")


def log_by_step(spark: SparkSession, path: str) -> DataFrame:
    """Lines of a log folder as ``(run_id, line_no, line)``, put in the order of their steps.

    Records of a run are numbered by step, those of one step in the order of their files
    (oldest first) and their place in the file; lines without a step come last.  Steps that
    a resumed run repeats thus stand together, the later record behind.  Numbers are stored
    with the lines, are unique in the whole log and rise within a run.
    """
    split = F.col("_metadata")
    lines = spark.read.text(path).select(
        F.col("run_id").cast("long"),
        F.col("value").alias("line"),
        split["file_modification_time"].alias("_written"),
        split["file_path"].alias("_file"),
        split["file_block_start"].alias("_block"),
        F.monotonically_increasing_id().alias("_row"),
    )
    lines = lines.withColumn("_step", number(json_object(F.col("line")), "step"))
    order = ["run_id", F.asc_nulls_last("_step"), "_written", "_file", "_block", "_row"]
    found = ranked(lines, *[F.col(o) if isinstance(o, str) else o for o in order], rank="line_no")
    return found.select("run_id", "line_no", "line")
