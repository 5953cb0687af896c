"""Live training logs with Structured Streaming.

The same record functions as for static tables, over a stream of trainer records.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tunetables.operators.records import normalised, number, with_record
from tunetables.sources.runlogs import log_lines


def start_log(raw: DataFrame, path: str, checkpoint: str, keep_all: bool = True, **options) -> StreamingQuery:
    """Normalise each incoming record and append it to the log folder, exactly once.

    ``raw`` is a streaming ``(run_id, step, logs)``.  No state is kept.  ``keep_all`` is
    that of ``normalised``.
    """
    lines = log_lines(normalised(raw, keep_all=keep_all))
    return (
        lines.writeStream.format("text")
        .partitionBy("run_id")
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(**(options or {"availableNow": True}))
        .start(path)
    )


def summary_columns(record: Column, step: Column) -> list[Column]:
    """Aggregates of a run so far: a few numbers of state per run, whatever its length."""
    eval_loss = number(record, "eval_loss")
    best = F.min(F.when(eval_loss.isNotNull(), F.struct(eval_loss.alias("v"), step.alias("step"))))
    return [
        F.max(step).alias("last_step"),
        F.max(number(record, "epoch", 0.0)).alias("last_epoch"),
        F.count("*").alias("records"),
        best.getField("v").alias("best_eval_loss"),
        best.getField("step").alias("best_step"),
        F.bool_or(F.map_contains_key(record, "train_runtime")).alias("training_completed"),
    ]


def running_summary(raw: DataFrame) -> DataFrame:
    """Summary per run of trainer records ``(run_id, step, logs)``, static or streaming."""
    return with_record(raw, "logs").groupBy("run_id").agg(*summary_columns(F.col("record"), F.col("step")))


#: Micro-batches between two bases.
EVERY = 16


def store_changes(changed: DataFrame, path: str, batch: int, every: int = EVERY) -> None:
    """Store the summaries that a micro-batch changed; every so often, also a base with the newest of each run.

    Places are used again: a micro-batch takes that of the one ``2 * every`` before it, and bases alternate between two.
    A base is made of the other base and the changes since that one, all of which still stand while
    it is written, so neither a repeated micro-batch nor a reader at that moment misses a run.  What
    is stored and read is thus bounded by the runs and ``2 * every`` micro-batches.  ``every`` must stay the same for a path.
    """
    spark = changed.sparkSession
    rows = changed.withColumn("_at", F.lit(batch).cast("long"))
    rows.write.mode("overwrite").parquet(f"{path}/batch=change-{batch % (2 * every)}")
    if batch % every == every - 1:
        turn = batch // every
        names = [f"change-{(batch - i) % (2 * every)}" for i in range(every)] + ([f"base-{(turn + 1) % 2}"] if turn else [])
        found = spark.read.schema(rows.schema).parquet(*[f"{path}/batch={name}" for name in names])
        _newest(found).write.mode("overwrite").parquet(f"{path}/batch=base-{turn % 2}")


def _newest(stored: DataFrame) -> DataFrame:
    """The row of each run's last micro-batch."""
    row = F.max_by(F.struct(*stored.columns), "_at")
    return stored.groupBy("run_id").agg(row.alias("s")).select("s.*")


def start_summary(raw: DataFrame, path: str, checkpoint: str, every: int = EVERY, **options) -> StreamingQuery:
    """Keep summaries up to date: each micro-batch stores the rows of the runs it changed, as ``store_changes`` says."""
    return (
        running_summary(raw)
        .writeStream.foreachBatch(lambda changed, batch: store_changes(changed, path, batch, every))
        .option("checkpointLocation", checkpoint)
        .outputMode("update")
        .trigger(**(options or {"availableNow": True}))
        .start()
    )


def current_summaries(spark: SparkSession, path: str) -> DataFrame:
    """Latest stored summary of each run, also while micro-batches are being stored."""
    stored = spark.read.option("ignoreMissingFiles", True).parquet(path).drop("batch")
    return _newest(stored).drop("_at")
