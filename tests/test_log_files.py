"""Log files numbered for curves."""

from __future__ import annotations

import time

from pyspark.sql import functions as F

from tunetables.operators import records
from tunetables.plans import curves
from tunetables.sources.runlogs import append_log, append_raw_log, log_by_step, numbered_log


def test_resumed_runs_are_numbered_by_step(spark, tmp_path):
    path = str(tmp_path / "log")

    def append(steps, loss):
        rows = [(run, f'{{"type":"step","step":{s},"epoch":0.0,"loss":{loss + s}.5}}') for run in (1, 2) for s in steps]
        append_raw_log(spark.createDataFrame([*rows, (1, "{broken")], "run_id long, line string"), path, logs="line")

    append(range(0, 30), 100)
    append(range(20, 40), 200)
    lines = log_by_step(spark, path).orderBy("line_no").collect()
    assert [r["line_no"] for r in lines] == list(range(102))
    for run in (1, 2):
        own = [r["line"] for r in lines if r["run_id"] == run and "loss" in r["line"]]
        steps = [int(line.split('"step":')[1].split(",")[0]) for line in own]
        assert steps == sorted([*range(30), *range(20, 40)])
        losses = [float(line.split('"loss":')[1][:-1]) for line in own]
        assert losses[20:24] == [120.5, 220.5, 121.5, 221.5]  # the later record stands behind
    assert curves.curve_table(log_by_step(spark, path), ["loss"]).count() == 100


def test_lines_keep_their_place(spark, tmp_path):
    path = str(tmp_path / "log")
    kinds = ['{{"type":"step","step":{0}}}', "", "{{broken {0}", '{{"type":"summary","total_steps":{0}}}']
    first = [(run, i, kinds[i % 4].format(i * 7 % 100)) for run in (1, 2) for i in range(500)]
    again = [(1, i, kinds[i % 3].format(i)) for i in range(90)]
    for rows, parts in ((first, 6), (again, 3)):
        df = spark.createDataFrame(rows, "run_id long, place long, line string").repartition(parts)
        append_raw_log(df, path, logs="line", order="place")
        time.sleep(0.01)
    want = {1: [line for run, _, line in first if run == 1] + [line for _, _, line in again], 2: [line for run, _, line in first if run == 2]}
    found = []
    try:
        # whole files, then byte ranges of some lines each
        for size in (1 << 27, 1 << 10):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            lines = numbered_log(spark, path)
            found.append(lines.rdd.getNumPartitions())
            for run, own in want.items():
                got = lines.where(F.col("run_id") == run).orderBy("line_no").collect()
                assert [r["line_no"] for r in got] == list(range(len(own)))
                assert [r["line"] for r in got] == own
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert found[1] > 10
    # the line after 499 is the resumed run's first
    bad = records.parsed_lines(numbered_log(spark, path)).where("run_id = 1 AND bad_line IS NOT NULL AND line_no >= 500")
    assert bad.orderBy("line_no").first()["bad_line"] == "{broken 2"


def test_no_line_is_sorted_or_shuffled(spark, tmp_path):
    path = str(tmp_path / "log")
    append_raw_log(spark.createDataFrame([(1, "a"), (2, "b")], "run_id long, line string"), path, logs="line")
    plan = numbered_log(spark, path)._jdf.queryExecution().executedPlan().toString()
    assert "Sort" not in plan and "Exchange hash" not in plan and "Exchange range" not in plan


def test_files_of_a_long_run_follow_its_steps(spark, tmp_path):
    path = str(tmp_path / "log")
    rows = spark.range(0, 3000).select(
        F.lit(1).cast("long").alias("run_id"), F.lit("step").alias("type"), F.col("id").alias("step"), F.lit(0.0).alias("epoch"), F.create_map(F.lit("loss"), F.lit("1.0")).alias("metrics")
    )
    append_log(rows.repartition(7), path)
    found = records.good_records(numbered_log(spark, path)).select("line_no", records.number(F.col("record"), "step").cast("long").alias("step"))
    assert found.where("line_no <> step").count() == 0 and found.count() == 3000
