"""What must not be lost or passed by default."""

from __future__ import annotations

import pytest
from pyspark import TaskContext

from tunetables.operators import checkpoints, generation, records
from tunetables.plans import curves


def log(spark, n_steps, n_evals):
    steps = [(1, i, f'{{"type":"step","step":{i},"epoch":{i}.0,"loss":{i}.5}}') for i in range(n_steps)]
    evals = [(1, n_steps + i, f'{{"type":"eval","step":{i},"epoch":{i}.0,"eval_loss":{i}.25}}') for i in range(n_evals)]
    return spark.createDataFrame(steps + evals, "run_id long, line_no long, line string")


def test_all_points_stay_unless_sampling_is_asked_for(spark):
    assert curves.curve_table(log(spark, 1500, 300), ["loss"]).count() == 1800


def test_evaluation_curves_alone(spark):
    lines = log(spark, 20, 5)
    assert {r["metric"] for r in curves.curve_table(lines, ["eval_loss"]).collect()} == {"eval_loss"}
    assert curves.curve_table(lines, ["eval_loss"]).count() == 5
    assert curves.curve_table(lines.where("line_no >= 20"), ["eval_loss"]).count() == 0


def test_strict_reading_fails_whatever_is_read(spark):
    for bad in ("{broken", None):
        lines = spark.createDataFrame([(1, "{}"), (2, bad)], "line_no long, line string")
        with pytest.raises(Exception, match="not a log record"):
            records.strict_records(lines).count()


def test_bad_lines_stay_whole(spark):
    line = " {broken " + "x" * 200
    [row] = records.parsed_lines(spark.createDataFrame([(1, line)], "line_no long, line string")).collect()
    assert (row["status"], row["bad_line"], len(row["preview"])) == ("bad", line, 50)


def test_checkpoints_without_a_metric_are_not_the_best(spark):
    rows = [(1, "r/checkpoint-10", True, None), (1, "r/checkpoint-20", True, 0.1), (1, "r/checkpoint-30", True, 0.5), (2, "s/checkpoint-1", True, None)]
    listing = spark.createDataFrame(rows, "run_id long, path string, is_dir boolean, eval_loss double")
    assert [tuple(r) for r in checkpoints.best_checkpoint(listing).collect()] == [(1, "r/checkpoint-20")]
    assert {r["path"] for r in checkpoints.retained(listing, keep=1).collect()} == {"r/checkpoint-20", "r/checkpoint-30", "s/checkpoint-1"}


def test_generation_is_spread(spark):
    def load():
        return lambda prompts: [str(TaskContext.get().partitionId()) for _ in prompts]

    prompts = spark.range(200).selectExpr("id AS idx", "'p' AS prompt").coalesce(1)
    assert len({r["prediction"] for r in generation.generated(prompts, load).collect()}) > 1
