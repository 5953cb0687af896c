"""Preference pairs: flattening, quality rules and rejection reasons.

Everything here is a narrow projection or filter over one row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tunetables.functions import text as tx
from tunetables.functions.rows import computed_once

MIN_TOKENS = 5  # shortest usable answer
LENGTH_SHARE = 0.9  # share of the length budget a prompt with answer may fill


def first_rows(df: DataFrame, max_samples: int | None, idx: str = "idx") -> DataFrame:
    """The first ``max_samples`` rows by key; all rows for ``None`` or 0."""
    return df.where(F.col(idx) < max_samples) if max_samples else df


def batch_rows(df: DataFrame, start: int, batch_size: int, idx: str = "idx") -> DataFrame:
    """The rows of the batch that begins at ``start``."""
    return df.where((F.col(idx) >= start) & (F.col(idx) < start + batch_size))


def batch_number(idx: Column, batch_size: int) -> Column:
    return F.floor(idx / batch_size).cast("long")


def message(chat: Column, place: int, strict: bool = False) -> Column:
    """Content of the message at a place; NULL when the chat is shorter.

    ``strict`` raises instead, through Spark's ANSI array access.
    """
    at = F.element_at(chat, place + 1) if strict else F.get(chat, F.lit(place))
    return at["content"]


def message_by_role(chat: Column, role: str) -> Column:
    """Content of the first message with the given role."""
    return F.get(F.filter(chat, lambda m: m["role"] == role), F.lit(0))["content"]


def flat_pairs(df: DataFrame, strict: bool = False, by_role: bool = False) -> DataFrame:
    """``(idx, prompt, chosen, rejected)`` texts from chat arrays.

    By place: message 0 of ``chosen`` is the prompt and message 1 of each chat its
    answer, whatever their roles.  ``by_role`` takes the first user and assistant
    messages instead, for chats that open with a system message.
    """
    if by_role:
        prompt = message_by_role(F.col("chosen"), "user")
        chosen = message_by_role(F.col("chosen"), "assistant")
        rejected = message_by_role(F.col("rejected"), "assistant")
    else:
        prompt = message(F.col("chosen"), 0, strict)
        chosen = message(F.col("chosen"), 1, strict)
        rejected = message(F.col("rejected"), 1, strict)
    return df.select(
        "idx", prompt.alias("prompt"), chosen.alias("chosen"), rejected.alias("rejected")
    )


def joined_texts(df: DataFrame) -> DataFrame:
    """Prompt joined to each answer, with nothing in between."""
    return df.select(
        "*",
        F.concat("prompt", "chosen").alias("chosen_full"),
        F.concat("prompt", "rejected").alias("rejected_full"),
    )


def all_present() -> Column:
    """All three texts have a visible character."""
    sides = [F.coalesce(tx.strip(F.col(c)), F.lit("")) != "" for c in ("prompt", "chosen", "rejected")]
    return sides[0] & sides[1] & sides[2]


def answers_differ() -> Column:
    return ~tx.strip(F.col("chosen")).eqNullSafe(tx.strip(F.col("rejected")))


def with_lengths(df: DataFrame, tokenizer=None, n_special: int = 0) -> DataFrame:
    """Add ``prompt_len``, ``chosen_len`` and ``rejected_len`` token counts."""
    counts = {
        f"{c}_len": tx.token_count(F.col(c), tokenizer, n_special)
        for c in ("prompt", "chosen", "rejected")
    }
    # a UDF cannot stand inside a generator, and is kept single by its own marking
    return df.withColumns(counts) if tokenizer else computed_once(df, **counts)


def fits(max_length: int) -> Column:
    """Prompt plus either answer stays within the share of ``max_length``."""
    longer = F.greatest("chosen_len", "rejected_len")
    return F.col("prompt_len") + longer <= F.lit(max_length * LENGTH_SHARE)


def long_enough() -> Column:
    return F.least("chosen_len", "rejected_len") >= MIN_TOKENS


def rejection_reason(max_length: int) -> Column:
    """First rule a pair breaks, NULL for a usable pair.

    Rules run in a fixed order, cheap text checks first; needs ``with_lengths``.
    """
    return (
        F.when(~all_present(), "empty")
        .when(~answers_differ(), "identical")
        .when(~fits(max_length), "too_long")
        .when(~long_enough(), "too_short")
    )


def stage_counts(with_reason: DataFrame, *by: str) -> DataFrame:
    """Rows before, after and removed, in one pass."""
    kept = F.count(F.when(F.col("reason").isNull(), 1))
    return with_reason.groupBy(*by).agg(
        F.count("*").alias("before"),
        kept.alias("after"),
        (F.count("*") - kept).alias("removed"),
    )


def references(df: DataFrame, by_role: bool = False) -> DataFrame:
    """Reference answer of each row."""
    chosen = F.col("chosen")
    answer = message_by_role(chosen, "assistant") if by_role else message(chosen, 1)
    return df.select("idx", answer.alias("reference"))
