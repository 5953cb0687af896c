"""Shapes of physical plans: what must not happen at scale."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from catalog import QUERIES
from catalog.fixtures import text_pairs
from tunetables.operators import chats, checkpoints, ngrams, objectives, records
from tunetables.plans import training_sets
from tunetables.schema import PREFERENCE

FOLDER = "/root/testdata/sf0.001"


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cross_joins(spark, name):
    plan = plan_of(QUERIES[name](spark, FOLDER))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def preference_table(spark, tmp_path):
    path = str(tmp_path / "prefs")
    row = (0, "train", "p", [{"role": "user", "content": "p"}], [])
    spark.createDataFrame([row], PREFERENCE).write.partitionBy("split").parquet(path)
    return spark.read.parquet(path)


def test_training_sets_are_narrow(spark, tmp_path):
    rows = preference_table(spark, tmp_path)
    for df in (training_sets.orpo_set(rows, 100), training_sets.sft_set(rows, 100), training_sets.pair_reasons(rows, 100)):
        assert "Exchange" not in plan_of(df)


def test_sample_prefix_reaches_the_scan(spark, tmp_path):
    plan = plan_of(training_sets.orpo_set(preference_table(spark, tmp_path), 100, max_samples=5))
    assert "LessThan(idx,5)" in plan


def test_only_message_texts_are_read(spark, tmp_path):
    plan = plan_of(training_sets.orpo_set(preference_table(spark, tmp_path), 100))
    schema = re.search(r"ReadSchema: struct<(.*)", plan).group(1)
    assert "role" not in schema and "prompt" not in schema


def test_tokens_are_counted_once(spark, tmp_path):
    plan = plan_of(training_sets.orpo_set(preference_table(spark, tmp_path), 100))
    assert plan.count("regexp_extract_all") == 3


def test_records_are_parsed_once(spark):
    raw = spark.createDataFrame([(1, 1, "{}")], "run_id long, step long, logs string")
    assert plan_of(records.normalised(raw)).count("from_json") == 1


def test_scoring_distributed_pairs_shuffles_no_grams(spark):
    """From joined pairs, BLEU adds one exchange: the final sum of one row per task."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        pairs_only = plan_of(text_pairs(spark, FOLDER)).count("Exchange ")
        bleu = plan_of(ngrams.corpus_bleu(text_pairs(spark, FOLDER), clustered=True)).count("Exchange ")
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert bleu == pairs_only + 1


def test_means_are_summed_before_the_shuffle(spark):
    df = spark.createDataFrame([(1, -1.0)], "label_id long, label_logp double").withColumn("argmax_id", F.lit(1))
    plan = plan_of(objectives.token_metrics(df))
    assert "partial_avg" in plan and "partial_count" in plan


def test_retention_limits_before_the_shuffle(spark):
    rows = [(1, "out/checkpoint-1", True, 0.1)]
    listing = spark.createDataFrame(rows, "run_id long, path string, is_dir boolean, eval_loss double")
    assert "WindowGroupLimit" in plan_of(checkpoints.retained(listing))


def test_long_chats_are_dropped_before_gathering(spark):
    turns = spark.createDataFrame([(1, 0, "user", "x")], "conv_id long, turn long, role string, text string")
    plan = plan_of(training_sets.sft_set_from_turns(turns, 10))
    gathered = plan.index("collect_list")
    assert "LeftSemi" in plan[gathered:]
    assert "partial_sum" in plan_of(chats.chat_lengths(turns))
