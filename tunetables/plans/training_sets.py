"""Training sets: supervised, preference (tokenised) and odds-ratio preference."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tunetables.functions import text as tx
from tunetables.functions.rows import computed_once
from tunetables.operators import chats, pairs, vocab
from tunetables.session import hot_keys, written
from tunetables.sources.tables import scan

# Splits read for training and evaluation, and default length budgets.
SPLITS = {
    "sft": {"train": "train_sft", "test": "test_sft"},
    "dpo": {"train": "train_prefs", "test": "test_prefs"},
    "orpo": {"train": "train_prefs", "test": "test_prefs"},
}
DEFAULT_LENGTHS = {"sft": 512, "dpo": 512, "orpo": 512}


def training_set(
    spark: SparkSession,
    path: str,
    training_type: str,
    part: str = "train",
    max_length: int | None = None,
    max_samples: int | None = None,
    vocabulary: DataFrame | None = None,
    tokenizer=None,
    n_special: int = 0,
    **padding,
) -> DataFrame:
    """The table one kind of training reads, from a stored preference table.

    ``tokenizer`` and ``n_special`` count lengths for ``sft`` and ``orpo``.  ``vocabulary`` is
    needed for ``dpo``, whose rows come tokenised, and ``padding`` holds that table's options
    (``pad_id``, ``pad_side``, ``pad_token``, ``eos_token``).
    """
    if training_type not in SPLITS:
        raise ValueError(f"training type must be one of {sorted(SPLITS)}, not {training_type!r}")
    rows = scan(spark, path, SPLITS[training_type][part])
    length = max_length or DEFAULT_LENGTHS[training_type]
    if training_type == "sft":
        return sft_set(rows, length, max_samples, tokenizer, n_special)
    if training_type == "orpo":
        return orpo_set(rows, length, max_samples, tokenizer, n_special)
    if vocabulary is None:
        raise ValueError("a dpo training set needs a vocabulary")
    return dpo_set(rows, vocabulary, length, max_samples, **padding)


def sft_set(
    rows: DataFrame,
    max_length: int,
    max_samples: int | None = None,
    tokenizer=None,
    n_special: int = 0,
) -> DataFrame:
    """``(idx, text)`` of the chats that fit, from rows holding whole chats."""
    first = pairs.first_rows(rows, max_samples)
    rendered = computed_once(first.select("idx", "chosen"), text=tx.render_chat(F.col("chosen")))
    counted = rendered.withColumn("length", tx.token_count(F.col("text"), tokenizer, n_special))
    return chats.short_chats(counted, max_length).select("idx", "text")


def sft_set_from_turns(
    turns: DataFrame, max_length: int, key: str = "conv_id", tokenizer=None, n_special: int = 0
) -> DataFrame:
    """``(key, text)`` of the chats that fit, from one message per row.

    Lengths are added up map-side first; only chats within ``max_length`` are
    gathered, so no group gathers more than that many tokens.  Messages of a chat
    that is too long and holds a large share of the table are dropped before the
    shuffle, by a broadcast list that cannot have a thousand rows.
    """
    lengths = written(chats.chat_lengths(turns, key, tokenizer, n_special), "chat-lengths")
    hot = hot_keys(lengths).where(F.col("length") > max_length).select(key)
    short = chats.short_chats(lengths, max_length).select(key)
    pieces = (
        chats.rendered_turns(turns)
        .join(F.broadcast(hot), key, "left_anti")
        .join(short, key, "left_semi")
    )
    texts = pieces.groupBy(key).agg(
        F.array_sort(F.collect_list(F.struct("turn", "piece"))).alias("pieces")
    )
    # chats whose messages all render as nothing still give an empty text
    return short.join(texts, key, "left").select(
        key, F.coalesce(F.array_join("pieces.piece", ""), F.lit("")).alias("text")
    )


def pair_reasons(
    rows: DataFrame,
    max_length: int,
    max_samples: int | None = None,
    tokenizer=None,
    n_special: int = 0,
) -> DataFrame:
    """Flat pairs with lengths and the ``reason`` they are rejected (NULL if usable)."""
    flat = pairs.flat_pairs(pairs.first_rows(rows, max_samples))
    lengths = pairs.with_lengths(flat, tokenizer, n_special)
    return lengths.withColumn("reason", pairs.rejection_reason(max_length))


def orpo_set(
    rows: DataFrame,
    max_length: int,
    max_samples: int | None = None,
    tokenizer=None,
    n_special: int = 0,
) -> DataFrame:
    """``(idx, prompt, chosen, rejected)`` of usable pairs.

    The text checks come as a filter of their own, ahead of the token counts.
    """
    flat = pairs.flat_pairs(pairs.first_rows(rows, max_samples))
    readable = flat.where(pairs.all_present() & pairs.answers_differ())
    counted = pairs.with_lengths(readable, tokenizer, n_special)
    usable = counted.where(pairs.fits(max_length) & pairs.long_enough())
    return usable.select("idx", "prompt", "chosen", "rejected")


def dpo_set(
    rows: DataFrame,
    vocabulary: DataFrame,
    max_length: int,
    max_samples: int | None = None,
    pad_id: int | None = None,
    pad_side: str = "left",
    pad_token: str | None = None,
    eos_token: str | None = None,
) -> DataFrame:
    """Flat pairs with fixed-length ids and masks of prompt+chosen and prompt+rejected.

    No quality filter is applied.  Padding is ``pad_id`` or, without it, the id that the
    vocabulary has for ``pad_token``, else for ``eos_token``; a job fails where it has neither.
    """
    if pad_id is not None:
        pad = F.lit(pad_id)
    elif pad_token is None and eos_token is None:
        raise ValueError("padding needs a pad_id, a pad_token or an eos_token")
    else:
        found = vocab.pad_token_id(vocabulary, pad_token, eos_token).scalar()
        absent = F.raise_error(F.lit("the vocabulary has no padding or end token")).cast("long")
        pad = F.coalesce(found.cast("long"), absent)
    # stored, since encoding reads its texts three times
    flat = written(pairs.flat_pairs(pairs.first_rows(rows, max_samples)), "pairs")
    full = pairs.joined_texts(flat)
    coded = vocab.encode(full, vocabulary, ["chosen_full", "rejected_full"], max_length=max_length)
    named = coded.select(
        "idx",
        "prompt",
        "chosen",
        "rejected",
        F.col("chosen_full_ids").alias("chosen_ids"),
        F.col("rejected_full_ids").alias("rejected_ids"),
    )
    return vocab.fixed_length(named, ["chosen", "rejected"], max_length, pad, pad_side)
