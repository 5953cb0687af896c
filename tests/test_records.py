"""Log records: parsing, normalising, metric choice, downsampling, checkpoints."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from tunetables.functions.numbers import round4
from tunetables.operators import checkpoints, objectives, records, series
from tunetables.plans import curves
from tunetables.schema import LOG_LINE
from tunetables.sources.runlogs import append_log, append_raw_log, append_summaries, log_lines, read_log

LINES = [
    ('{"type":"step","step":1,"epoch":0.5,"loss":2.0,"grad_norm":null}', "good"),
    ("   ", "blank"),
    ("", "blank"),
    ('{"type":"step","st', "bad"),
    ('{"a":1} trailing', "bad"),
    ('{"a":1}{"b":2}', "bad"),
    ('{"a":1},{"b":2}', "bad"),
    ('{"a":1}]', "bad"),
    ("[1]", "bad"),
    ("x" * 80, "bad"),
    ('  {"type":"eval","step":2,"eval_loss":NaN}\t', "good"),
    ('{"type":"summary","total_steps":2,"training_completed":true}', "good"),
    ('{"note":"no type, so a training record","loss":1e-3}', "good"),
]


@pytest.fixture(scope="module")
def lines(spark):
    rows = [(7, i, text) for i, (text, _) in enumerate(LINES)]
    return spark.createDataFrame(rows, LOG_LINE)


def test_permissive_reading(lines):
    got = {r.line_no: r for r in records.parsed_lines(lines).collect()}
    assert [got[i].status for i in range(len(LINES))] == [s for _, s in LINES]
    assert got[9].preview == "x" * 50 and got[0].preview is None
    assert records.good_records(lines).count() == 4


def test_strict_reading_fails_on_a_bad_line(lines):
    assert records.strict_records(lines.where("line_no in (0, 11)")).count() == 2
    for bad in (2, 3, 4, 8):
        with pytest.raises(Exception, match="not a log record"):
            records.strict_records(lines.where(f"line_no = {bad}")).collect()


def test_series_and_values(lines):
    parsed = records.series_records(records.good_records(lines))
    assert {(r.line_no, r.series, r.step) for r in parsed.collect()} == {
        (0, "train", 1), (10, "eval", 2), (12, "train", 0),
    }
    values = {(r.line_no, r.metric): r.value for r in records.unpivoted(parsed).collect()}
    assert values.keys() == {(0, "loss"), (10, "eval_loss"), (12, "note"), (12, "loss")}
    assert values[10, "eval_loss"] != values[10, "eval_loss"] and values[12, "note"] is None
    assert values[12, "loss"] == 0.001


def test_summaries_alone_have_no_series(spark):
    df = spark.createDataFrame([(1, 0, LINES[11][0])], LOG_LINE)
    assert records.series_records(records.good_records(df)).count() == 0
    assert records.run_summaries(records.good_records(df)).first().training_completed is True
    assert curves.curve_table(df).count() == 0


def test_rounding_is_pythons(spark):
    values = [2.67555, 2.67545, 0.03125, 0.09375, 1.00005, -1.00005, 123456.78905, 5e-5, 1e300, 0.0]
    values += [(2 * k + 1) / 20000 for k in range(0, 4000, 7)]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    for r in df.select("x", round4(F.col("x")).alias("r")).collect():
        assert r.r == round(r.x, 4)


RAW = [
    (1, 10, {"loss": 1.23456, "learning_rate": 2e-05, "grad_norm": 0.0, "epoch": 0.123456, "num_tokens": 512.0, "x": 1.5}),
    (1, 11, {"loss": 2, "grad_norm": 3.14159265, "rewards/chosen": -0.00005}),
    (1, 12, {"eval_loss": 0.98765, "eval_runtime": 3, "eval_rewards/margins": 0.55555, "eval_nll_loss": 1.0}),
    (1, 13, {"train_runtime": 5.0, "train_loss": 1.0}),
]


@pytest.fixture(scope="module")
def raw(spark):
    rows = [(run, step, json.dumps(logs)) for run, step, logs in RAW]
    return spark.createDataFrame(rows, "run_id long, step long, logs string")


def expected():
    return [
        {"type": "step", "step": 10, "epoch": 0.1235, "loss": 1.2346, "learning_rate": 2e-05, "grad_norm": None, "num_tokens": 512.0},
        {"type": "step", "step": 11, "epoch": 0.0, "loss": 2.0, "learning_rate": 0.0, "grad_norm": 3.1416, "rewards/chosen": round(-0.00005, 4)},
        {"type": "eval", "step": 12, "epoch": 0.0, "eval_loss": 0.9877, "eval_runtime": 3, "rewards/margins": round(0.55555, 4)},
    ]


def test_normalised_lines(raw):
    got = [json.loads(r.value) for r in log_lines(records.normalised(raw, keep_all=False)).collect()]
    assert sorted(got, key=lambda r: r["step"]) == expected()


def test_all_metrics_are_kept(raw):
    kept = records.normalised(raw)
    names = {r.step: set(r.metrics) for r in kept.collect()}
    assert "x" in names[10] and {"eval_nll_loss", "rewards/margins"} <= names[12]


def test_repeated_keys_do_not_fail_the_job(spark):
    logs = [
        '{"loss":1.0,"loss":2.0,"epoch":0.5,"loss":3.0}',
        '{"eval_loss":1.0,"rewards/chosen":7.0,"eval_rewards/chosen":5.0}',
    ]
    df = spark.createDataFrame([(1, i, t) for i, t in enumerate(logs)], "run_id long, step long, logs string")
    for keep_all in (False, True):
        got = {r.step: r.metrics for r in records.normalised(df, keep_all=keep_all).collect()}
        assert got[0]["loss"] == "3.0" and got[1]["rewards/chosen"] == "5.0"


def test_steps_can_be_left_out(raw):
    assert [r.step for r in records.normalised(raw, log_steps=False).collect()] == [12]


def test_log_sink_appends(spark, raw, tmp_path):
    path = str(tmp_path / "log")
    for _ in range(2):
        append_log(records.normalised(raw), path)
    stored = read_log(spark, path)
    assert stored.count() == 6
    assert sorted({r.line for r in stored.collect()}) == sorted(
        {r.value for r in log_lines(records.normalised(raw)).collect()}
    )


def test_closing_summary_is_appended(spark, raw, tmp_path):
    path = str(tmp_path / "log")
    append_log(records.normalised(raw), path)
    rows = [(1, 12, 0.5, None, True), (2, 5, 0.1, 0.25, False)]
    names = "run_id long, total_steps long, total_epochs double, best_metric double, training_completed boolean"
    append_summaries(spark.createDataFrame(rows, names), path)
    stored = read_log(spark, path)
    (last,) = [json.loads(r.line) for r in stored.collect() if "summary" in r.line]
    assert last == {"type": "summary", "total_steps": 12, "total_epochs": 0.5, "best_metric": None, "training_completed": True}
    summary = records.run_summaries(records.good_records(stored)).first()
    assert (summary.run_id, summary.total_steps, summary.training_completed) == (1, 12, True)


def test_raw_log_is_kept_as_is(spark, raw, tmp_path):
    path = append_raw_log(raw, str(tmp_path / "raw"))
    assert sorted(r.line for r in read_log(spark, path).collect()) == sorted(json.dumps(logs) for _, _, logs in RAW)


def long_log(spark, n=57, runs=(1, 2)):
    lines = []
    for run in runs:
        for i in range(n):
            if i % 6 == 5:
                record = {"type": "eval", "step": i, "epoch": i / 10, "eval_loss": 1 / (i + 1), "loss": 3.0}
            else:
                record = {"type": "step", "step": i, "epoch": i / 10, "loss": float(i * run), "grad_norm": None if i % 2 else 0.5}
            lines.append((run, i, json.dumps(record)))
    return spark.createDataFrame(lines, LOG_LINE)


def plain_sample(n_train, n_eval, factor, max_points):
    k = factor or (max(1, n_train // max_points) if max_points and n_train > max_points else None)
    if k:
        e = max(1, k // 2)
    elif max_points and n_eval > max_points // 4:
        e = max(1, n_eval // (max_points // 4))
    else:
        e = 1
    return len(range(0, n_train, k or 1)), len(range(0, n_eval, e))


@pytest.mark.parametrize("factor,max_points", [(5, 1000), (None, 10), (None, 20), (None, 1000), (None, None), (1, 8), (None, 47)])
def test_downsampling(spark, factor, max_points):
    parsed = records.series_records(records.good_records(long_log(spark)))
    sizes = {(r.run_id, r.series): r.points for r in records.series_sizes(series.downsampled(parsed, factor, max_points)).collect()}
    train, eval_ = plain_sample(48, 9, factor, max_points)
    assert sizes == {(run, s): n for run in (1, 2) for s, n in (("train", train), ("eval", eval_))}


def test_metric_resolution(spark):
    sizes = records.metric_sizes(records.unpivoted(records.series_records(records.good_records(long_log(spark, runs=(1,))))))
    asked = ["loss", "eval_loss", "grad_norm", "absent"]
    every = series.resolved_metrics(sizes, asked, dedup=False).orderBy("place", "series").collect()
    assert [(r.requested, r.series, r.metric) for r in every] == [
        ("loss", "eval", "eval_loss"), ("loss", "train", "loss"), ("eval_loss", "eval", "eval_loss"),
        ("grad_norm", "train", "grad_norm"),
    ]
    assert series.resolved_metrics(sizes, asked).count() == 3


def test_eval_only_run_has_no_curves(spark):
    df = spark.createDataFrame([(1, 0, '{"type":"eval","step":1,"eval_loss":2.0}')], LOG_LINE)
    assert curves.curve_table(df, ["loss", "eval_loss"]).count() == 0


def test_curves_smooth_training_only(spark):
    table = curves.curve_table(long_log(spark), ["loss", "grad_norm"], window=4, factor=2).collect()
    eval_rows = [r for r in table if r.series == "eval"]
    assert eval_rows and all(r.smoothed is None and r.label == "eval_loss" for r in eval_rows)
    loss = sorted((r for r in table if r.run_id == 1 and r.metric == "loss"), key=lambda r: r.step)
    raw = [r.raw for r in loss]
    assert [r.smoothed for r in loss] == [None] * 3 + [pytest.approx(sum(raw[i - 3 : i + 1]) / 4) for i in range(3, len(raw))]


def test_training_summary(spark):
    got = curves.training_summary(long_log(spark)).orderBy("run_id").collect()[1]
    assert (got.max_step, got.max_epoch, got.best_loss, got.final_loss) == (56, 5.6, 0.0, 112.0)
    assert got.final_eval_loss == pytest.approx(1 / 54) and got.best_eval_loss == pytest.approx(1 / 54)


LISTING = [
    (1, "out/checkpoint-9", True, 0.1),
    (1, "out/checkpoint-10", True, 0.5),
    (1, "out/checkpoint-100-old", True, 0.4),
    (1, "out/checkpoint-200", False, 0.0),
    (1, "out/checkpoint-", True, 0.0),
    (1, "out/my-checkpoint-300", True, 0.0),
    (1, "out/checkpoint-99999999999999999999", True, 0.6),
    (2, "out/final", True, 0.0),
]


def test_checkpoints(spark):
    listing = spark.createDataFrame(LISTING, "run_id long, path string, is_dir boolean, eval_loss double")
    assert [tuple(r) for r in checkpoints.latest_checkpoint(listing).collect()] == [(1, LISTING[6][1])]
    assert checkpoints.best_checkpoint(listing).first().path == LISTING[0][1]
    kept = {r.path for r in checkpoints.retained(listing, keep=2).collect()}
    assert kept == {LISTING[6][1], LISTING[2][1], LISTING[0][1]}


def test_objectives_stay_finite(spark):
    rows = [(-1.0, -900.0, -1.0, -2.0, 3, 3), (-900.0, -1.0, -2.0, -1.0, 3, 3)]
    names = "policy_chosen_logp double, policy_rejected_logp double, ref_chosen_logp double, ref_rejected_logp double, n_chosen_tokens int, n_rejected_tokens int"
    df = spark.createDataFrame(rows, names)
    losses = [r.loss for r in objectives.dpo_pairs(df, beta=10.0).collect()]
    assert losses[0] == pytest.approx(0) and losses[1] > 1000
    assert objectives.means(objectives.orpo_pairs(df), objectives.ORPO_METRICS).first().loss > 0


def test_curve_titles(spark):
    rows = [("eval", "rewards/chosen"), ("eval", "eval_loss"), ("train", "grad_norm")]
    df = spark.createDataFrame(rows, "series string, metric string")
    label = series.curve_label(F.col("series"), F.col("metric"))
    got = [tuple(r) for r in df.select(label, series.curve_title(label)).collect()]
    assert got == [
        ("eval_rewards/chosen", "Eval Rewards Chosen"),
        ("eval_loss", "Eval Loss"),
        ("grad_norm", "Grad Norm"),
    ]


def test_side_means_with_logits(spark):
    df = spark.createDataFrame([(1, -1.0, -2.0, 0.5, 0.25), (1, -3.0, -4.0, 1.5, 0.75)],
        "step long, policy_chosen_logp double, policy_rejected_logp double, chosen_logit double, rejected_logit double")
    got = objectives.side_means(df, "step", logits=True).first()
    assert tuple(got) == (1, -2.0, -3.0, 1.0, 0.5)


def test_plot_lists():
    assert [len(records.METRICS_TO_PLOT[k]) for k in ("sft", "dpo", "orpo")] == [6, 10, 16]
    assert len(records.DEFAULT_METRICS) == 4
