"""Positions, running totals and smoothing against plain Python, with tiny chunks."""

from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

from tests import brute
from tunetables.operators import ordering, smoothing


@pytest.fixture
def small_ranges(monkeypatch):
    """Ranges of 8 values, so that a short series crosses many of them."""
    monkeypatch.setattr(ordering, "SPAN_BITS", 3)
    monkeypatch.setattr(ordering, "SPAN", 8)
    monkeypatch.setattr(smoothing, "SPAN", 8)
    monkeypatch.setattr(ordering.overlapping_chunks, "__defaults__", (0, 8))


def series(spark, lengths, step=1, seed=0):
    rng = random.Random(seed)
    data = {k: [rng.uniform(-5, 5) for _ in range(n)] for k, n in enumerate(lengths)}
    rows = [(k, "train", "loss", step * i + 3, v) for k, vs in data.items() for i, v in enumerate(vs)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "run_id long, series string, metric string, line_no long, value double")
    return data, df


@pytest.mark.parametrize("step", [1, 5])
def test_positions(spark, small_ranges, step):
    data, df = series(spark, [1, 40, 130], step)
    for r in ordering.with_position(df, ["run_id"], "line_no").collect():
        assert r.pos == (r.line_no - 3) // step and r.n == len(data[r.run_id])


def test_running_total_of_negative_keys(spark, small_ranges):
    df = spark.createDataFrame([(i, i % 7) for i in range(-50, 50)], "k long, v long")
    got = {r.k: (r.before, r.total) for r in ordering.running_total(df, [], "k", F.col("v")).collect()}
    for k in range(-50, 50):
        assert got[k] == (sum(i % 7 for i in range(-50, k)), sum(i % 7 for i in range(-50, 50)))


def test_ranked_follows_any_order(spark):
    words = [f"w{random.Random(i).randrange(10**6)}" for i in range(500)]
    df = spark.createDataFrame([(w, i) for i, w in enumerate(set(words))], "w string, i long")
    got = [r.w for r in ordering.ranked(df, F.col("w").desc(), rank="r").orderBy("r").collect()]
    assert got == sorted(set(words), reverse=True)


METHODS = {"moving_average": brute.moving_average, "exponential": brute.exponential, "savgol": brute.savgol}


@pytest.mark.parametrize("method", METHODS)
@pytest.mark.parametrize("window", [1, 2, 3, 6, 9, 40])
def test_smoothing(spark, small_ranges, method, window):
    data, df = series(spark, [1, 2, 6, 9, 41, 90])
    want = {k: METHODS[method](vs, window) for k, vs in data.items()}
    rows = smoothing.smoothed(df, method, window).collect()
    assert len(rows) == sum(map(len, data.values()))
    for r in rows:
        exact = want[r.run_id][r.line_no - 3]
        assert r.smoothed == (exact if exact is None else pytest.approx(exact, abs=1e-9))


def test_exponential_with_a_very_long_memory(spark, small_ranges):
    """Blocks of 8 whose ratio stays near 1: carries pass through several levels."""
    data, df = series(spark, [700])
    want = brute.exponential(data[0], 600)
    for r in smoothing.exponential_average(df, 600).collect():
        assert r.smoothed == pytest.approx(want[r.line_no - 3], abs=1e-9)


@pytest.mark.parametrize("bad", [{20: math.nan}, {20: math.inf}, {5: -math.inf, 60: math.inf}])
def test_values_that_are_not_finite_stay(spark, small_ranges, bad):
    values = [bad.get(i, math.sin(i)) for i in range(90)]
    rows = [(1, "train", "loss", i, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "run_id long, series string, metric string, line_no long, value double")
    want = brute.exponential(values, 4)
    for r in smoothing.exponential_average(df, 4).collect():
        assert r.smoothed == pytest.approx(want[r.line_no], abs=1e-9, nan_ok=True)


def test_sums_taken_along(spark, small_ranges):
    df = spark.range(60).select(F.col("id").alias("k"), (F.col("id") % 2).alias("odd"))
    got = ordering.with_position(df, [], "k", more={"odds": F.col("odd")}).collect()
    assert all((r.pos, r.n, r.odds) == (r.k, 60, r.k // 2) for r in got)


def test_unknown_method_changes_nothing(spark):
    _, df = series(spark, [20])
    assert all(r.smoothed == r.value for r in smoothing.smoothed(df, "other", 5).collect())


@pytest.mark.parametrize("n, window", [(1300, 7), (515, 101), (1025, 5), (4097, 511), (513, 512)])
def test_savgol_across_chunks(spark, n, window):
    """Series that end at, before and behind the borders of chunks, with values of a large mean."""
    rng = random.Random(n)
    values = [1e4 + rng.random() for _ in range(n)]
    df = spark.createDataFrame([(1, i * 3, v) for i, v in enumerate(values)], "run_id long, line_no long, value double").repartition(4)
    got = smoothing.savgol(df, window, ["run_id"]).orderBy("line_no").collect()
    assert [r.smoothed for r in got] == pytest.approx(brute.savgol(values, window), rel=1e-11)


def test_savgol_holds_no_arrays(spark):
    df = spark.createDataFrame([(1, 1, 1.0)], "run_id long, line_no long, value double")
    plan = smoothing.savgol(df, 11, ["run_id"])._jdf.queryExecution().executedPlan().toString()
    assert "collect_list" not in plan and "slice(" not in plan and "zip_with" not in plan


@pytest.mark.parametrize("window, passes", [(2, 1), (10, 1), (3000, 2)])
def test_exponential_blocks_are_stored_once(spark, window, passes):
    """One window pass over stored rows, and one over stored ends of blocks where decay is slow."""
    df = spark.createDataFrame([(1, i, float(i % 7)) for i in range(5000)], "run_id long, line_no long, value double")
    found = smoothing.exponential_average(df, window, ["run_id"])
    assert found._jdf.queryExecution().executedPlan().toString().count("Window [") == passes
    assert [r.smoothed for r in found.orderBy("line_no").collect()] == pytest.approx(brute.exponential([i % 7 for i in range(5000)], window))
