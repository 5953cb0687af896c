"""Chats held one message per row.

For training sets a chat is gathered whole only once it is known to be small: lengths are summed map-side
first.  ``rendered_chats`` gathers parts of ``PART_TURNS`` turns and then joins them, so a rendered chat is one
string and must fit in a task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tunetables.functions import text as tx

PART_TURNS = 4096


def chat_rows(turns: DataFrame, key: str = "conv_id") -> DataFrame:
    """First two messages of each chat as ``prompt`` and ``response``."""
    return (
        turns.where(F.col("turn") <= 1)
        .groupBy(key)
        .agg(
            F.max(F.when(F.col("turn") == 0, F.col("text"))).alias("prompt"),
            F.max(F.when(F.col("turn") == 1, F.col("text"))).alias("response"),
        )
    )


def first_by_role(turns: DataFrame, role: str, key: str = "conv_id") -> DataFrame:
    """First message of a given role: the choice by role instead of by place."""
    return (
        turns.where(F.col("role") == role)
        .groupBy(key)
        .agg(F.min_by("text", "turn").alias("content"))
    )


def rendered_turns(turns: DataFrame) -> DataFrame:
    """Messages with their chat-template ``piece``; unrendered roles are dropped."""
    piece = tx.render_message(F.col("role"), F.col("text"))
    return turns.withColumn("piece", piece).where(F.col("piece").isNotNull())


def rendered_chats(
    turns: DataFrame, key: str = "conv_id", part_turns: int = PART_TURNS
) -> DataFrame:
    """One ``(key, text)`` row for each chat; turns are joined in parts, then parts in order."""
    return (
        rendered_parts(turns, key, part_turns)
        .groupBy(key)
        .agg(F.array_sort(F.collect_list(F.struct("part", "text"))).alias("parts"))
        .select(key, F.array_join(F.col("parts.text"), "").alias("text"))
    )


def rendered_parts(
    turns: DataFrame, key: str = "conv_id", part_turns: int = PART_TURNS
) -> DataFrame:
    """Chat text in ``(key, part, text)`` rows, ``part_turns`` turns to a part.

    The full text is a chat's parts in order.  For chats too long for one row's text.
    """
    # a chat with no rendered message still gives an (empty) text
    piece = F.coalesce(tx.render_message(F.col("role"), F.col("text")), F.lit(""))
    return (
        turns.select(
            key, F.floor(F.col("turn") / part_turns).alias("part"), "turn", piece.alias("piece")
        )
        .groupBy(key, "part")
        .agg(F.array_sort(F.collect_list(F.struct("turn", "piece"))).alias("pieces"))
        .select(key, "part", F.array_join(F.col("pieces.piece"), "").alias("text"))
    )


def chat_lengths(
    turns: DataFrame, key: str = "conv_id", tokenizer=None, n_special: int = 0
) -> DataFrame:
    """Token count of each rendered chat, as ``(key, length, rows)`` with its row count.

    Every rendered message ends in a newline, which no token crosses, so message
    counts add up to the count of the whole text.  With a ``tokenizer`` of your own
    the same must hold for it.
    """
    rendered = F.coalesce(tx.render_message(F.col("role"), F.col("text")), F.lit(""))
    return (
        turns.select(key, tx.token_count(rendered, tokenizer).alias("tokens"))
        .groupBy(key)
        .agg((F.sum("tokens") + n_special).alias("length"), F.count("*").alias("rows"))
    )


def short_chats(lengths: DataFrame, max_length: int) -> DataFrame:
    """Chats whose length does not exceed ``max_length``."""
    return lengths.where(F.col("length") <= max_length)
