"""Queries over chats and preference pairs: scans, filters, training sets, lengths."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.fixtures import (
    MAX_LENGTH,
    preference_rows,
    prefs,
    turns,
    with_views,
)
from catalog.registry import query
from tunetables.functions import text as tx
from tunetables.operators import chats, lengths, pairs
from tunetables.plans import training_sets
from tunetables.session import new_path
from tunetables.sources.sinks import write_training_text
from tunetables.sources.tables import save_splits, scan

SFT_LENGTH = 512


def first_messages(spark, folder):
    """Prompt and answer of each conversation, keyed for the row operators."""
    return chats.chat_rows(turns(spark, folder))


@query("a01_split_scan", with_views("fx_prefs", "SELECT * FROM fx_prefs WHERE split = 'test_prefs'"))
def a01(spark, folder):
    path = save_splits(prefs(spark, folder), new_path(spark, "prefs"))
    return scan(spark, path, "test_prefs").select("idx", "split", "prompt", "chosen", "rejected")


BEST_RESPONSE_SQL = with_views(
    "chat_first",
    """SELECT conv_id, 'USER: ' || prompt || chr(10) || 'ASSISTANT: ' || response AS text
       FROM chat_first""",
)


@query("a02_training_text_sink", BEST_RESPONSE_SQL.replace("SELECT conv_id, 'USER", "SELECT 'USER"))
def a02(spark, folder):
    path = write_training_text(b04(spark, folder), new_path(spark, "training-text"))
    return spark.read.schema("text string").json(path)


@query("b01_sample_prefix", with_views("fx_prefs", "SELECT * FROM fx_prefs WHERE idx < 50"))
def b01(spark, folder):
    return pairs.first_rows(prefs(spark, folder), 50)


@query(
    "b02_batches",
    with_views(
        "fx_prefs",
        """SELECT CAST(floor(idx / 4) AS BIGINT) AS batch, min(idx) AS first_idx, count(*) AS n
           FROM fx_prefs GROUP BY 1""",
    ),
)
def b02(spark, folder):
    batch = pairs.batch_number(F.col("idx"), 4)
    return (
        prefs(spark, folder)
        .groupBy(batch.alias("batch"))
        .agg(F.min("idx").alias("first_idx"), F.count("*").alias("n"))
    )


@query(
    "b03_message_extraction",
    with_views(
        "fx_prefs",
        "SELECT idx, prompt AS first_message, chosen AS chosen_answer, rejected AS rejected_answer FROM fx_prefs",
    ),
)
def b03(spark, folder):
    return preference_rows(spark, folder).select(
        "idx",
        pairs.message(F.col("chosen"), 0).alias("first_message"),
        pairs.message(F.col("chosen"), 1).alias("chosen_answer"),
        pairs.message(F.col("rejected"), 1).alias("rejected_answer"),
    )


@query("b04_best_response", BEST_RESPONSE_SQL)
def b04(spark, folder):
    text = tx.render_best_response(F.col("prompt"), F.col("response"))
    return first_messages(spark, folder).select("conv_id", text.alias("text"))


@query(
    "b05_sft_format",
    with_views(
        "chat_pieces",
        """SELECT conv_id, coalesce(string_agg(piece, '' ORDER BY turn), '') AS text
           FROM chat_pieces GROUP BY conv_id""",
    ),
)
def b05(spark, folder):
    return chats.rendered_chats(turns(spark, folder))


@query("b06_token_count", with_views("chat_lengths", "SELECT * FROM chat_lengths"))
def b06(spark, folder):
    return chats.chat_lengths(turns(spark, folder)).drop("rows")


@query("b07_length_filter", with_views("chat_lengths", "SELECT * FROM chat_lengths WHERE length <= 512"))
def b07(spark, folder):
    return chats.short_chats(b06(spark, folder), SFT_LENGTH)


@query(
    "b08_sft_table",
    with_views(
        "chat_pieces chat_lengths",
        """SELECT conv_id, coalesce(string_agg(piece, '' ORDER BY turn), '') AS text
           FROM chat_pieces JOIN chat_lengths USING (conv_id) WHERE length <= 512 GROUP BY conv_id""",
    ),
)
def b08(spark, folder):
    return training_sets.sft_set_from_turns(turns(spark, folder), SFT_LENGTH)


@query(
    "b08_sft_rows",
    with_views(
        "pair_lengths",
        r"""SELECT idx, '### User:' || chr(10) || prompt || chr(10) || '### Assistant:' || chr(10) || chosen || chr(10) AS text
            FROM pair_lengths WHERE prompt_len + chosen_len + 10 <= 256""",
    ),
)
def b08_rows(spark, folder):
    return training_sets.sft_set(preference_rows(spark, folder), MAX_LENGTH)


@query("b09_flat_pairs", with_views("fx_prefs", "SELECT idx, prompt, chosen, rejected FROM fx_prefs"))
def b09(spark, folder):
    return pairs.flat_pairs(preference_rows(spark, folder))


@query(
    "b10_joined_pair_text",
    with_views(
        "fx_prefs",
        "SELECT idx, prompt || chosen AS chosen_full, prompt || rejected AS rejected_full FROM fx_prefs",
    ),
)
def b10(spark, folder):
    return pairs.joined_texts(b09(spark, folder)).select("idx", "chosen_full", "rejected_full")


def rule_query(name, condition, rule):
    @query(name, with_views("pair_lengths", f"SELECT idx FROM pair_lengths WHERE {condition}"))
    def kept(spark, folder):
        return pairs.with_lengths(b09(spark, folder)).where(rule()).select("idx")


rule_query("b11_non_empty", "p <> '' AND c <> '' AND r <> ''", pairs.all_present)
rule_query("b12_distinct_pair", "c <> r", pairs.answers_differ)
rule_query(
    "b13_combined_length",
    "prompt_len + greatest(chosen_len, rejected_len) <= 256 * CAST(0.9 AS DOUBLE)",
    lambda: pairs.fits(MAX_LENGTH),
)
rule_query("b14_minimum_length", "chosen_len >= 5 AND rejected_len >= 5", pairs.long_enough)


@query(
    "b15_orpo_table",
    with_views("pair_reasons", "SELECT idx, prompt, chosen, rejected FROM pair_reasons WHERE reason IS NULL"),
)
def b15(spark, folder):
    return training_sets.orpo_set(preference_rows(spark, folder), MAX_LENGTH)


def reasons(spark, folder):
    rows = training_sets.pair_reasons(preference_rows(spark, folder), MAX_LENGTH)
    split = F.when(F.col("idx") % 5 == 0, "test_prefs").otherwise("train_prefs")
    return rows.withColumn("split", split)


@query(
    "b16_rejection_reason",
    with_views(
        "pair_reasons",
        "SELECT split, coalesce(reason, 'kept') AS reason, count(*) AS n FROM pair_reasons GROUP BY 1, 2",
    ),
)
def b16(spark, folder):
    reason = F.coalesce("reason", F.lit("kept"))
    return reasons(spark, folder).groupBy("split", reason.alias("reason")).agg(F.count("*").alias("n"))


@query("b17_column_pruning", with_views("fx_prefs", "SELECT prompt || chosen AS text FROM fx_prefs"))
def b17(spark, folder):
    return b10(spark, folder).select(F.col("chosen_full").alias("text"))


@query("b18_references", with_views("fx_prefs", "SELECT idx, chosen AS reference FROM fx_prefs"))
def b18(spark, folder):
    return pairs.references(preference_rows(spark, folder))


@query(
    "b18_reference_by_role",
    """SELECT conv_id, arg_min(text, turn) AS content FROM conversations
       WHERE role = 'assistant' GROUP BY conv_id""",
)
def b18_by_role(spark, folder):
    return chats.first_by_role(turns(spark, folder), "assistant")


@query(
    "e01_stage_counts",
    with_views(
        "pair_reasons",
        """SELECT split, count(*) AS before, count(*) FILTER (reason IS NULL) AS after,
                  count(reason) AS removed FROM pair_reasons GROUP BY split""",
    ),
)
def e01(spark, folder):
    return pairs.stage_counts(reasons(spark, folder), "split")


@query(
    "e02_length_summary",
    with_views(
        "chat_lengths",
        """SELECT max(length) AS max_length, round(quantile_cont(length, 0.95), 6) AS p95_length,
                  round(avg(length), 6) AS mean_length FROM chat_lengths""",
    ),
)
def e02(spark, folder):
    summary = lengths.length_summary(b06(spark, folder))
    return summary.select(
        "max_length",
        F.round("p95_length", 6).alias("p95_length"),
        F.round("mean_length", 6).alias("mean_length"),
    )


@query(
    "e03_length_histogram",
    with_views(
        "chat_lengths",
        """SELECT bin, round(lo + bin * (hi - lo) / 50, 6) AS low,
                  round(lo + (bin + 1) * (hi - lo) / 50, 6) AS high,
                  CAST((SELECT count(*) FROM chat_lengths
                        WHERE least(49, CAST(floor((length - lo) * 50.0::DOUBLE / (hi - lo)) AS INT)) = bin)
                    AS BIGINT) AS n
           FROM (SELECT CAST(min(length) AS DOUBLE) AS lo, CAST(max(length) AS DOUBLE) AS hi,
                        unnest(range(50)) AS bin FROM chat_lengths)""",
    ),
)
def e03(spark, folder):
    return lengths.length_histogram(b06(spark, folder)).select(
        "bin", F.round("low", 6).alias("low"), F.round("high", 6).alias("high"), "n"
    )
