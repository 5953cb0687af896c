"""Positions and totals by keys of any spread."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tunetables.operators.ordering import SPAN, running_total, with_position


@pytest.mark.parametrize("keys", [[], ["run"]])
def test_positions_by_hashed_keys(spark, keys):
    rows = spark.range(3000).select((F.col("id") % 3).alias("run"), F.xxhash64("id").alias("k"))
    got = with_position(rows, keys, "k").collect()
    groups = {r["run"] if keys else 0 for r in got}
    for group in groups:
        own = sorted((r for r in got if not keys or r["run"] == group), key=lambda r: r["k"])
        assert [r["pos"] for r in own] == list(range(len(own)))
        assert {r["n"] for r in own} == {len(own)}


def test_totals_across_all_levels(spark):
    order = [-(1 << 62), -5, 0, 1, SPAN, SPAN**2 + 1, SPAN**3, SPAN**3 + 7, (1 << 62) + 3]
    rows = spark.createDataFrame([(k, i + 1) for i, k in enumerate(order)], "k long, v long")
    got = running_total(rows, [], "k", F.col("v")).orderBy("k").collect()
    assert [r["before"] for r in got] == [sum(range(1, i + 1)) for i in range(len(order))]
    assert {r["total"] for r in got} == {sum(range(1, len(order) + 1))}
