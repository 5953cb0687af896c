"""One query for each operator, with production parameters, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tunetables.llm import byte_bpe, chat_format, decontaminate, hard_negatives, lexical_search, lm_score, mixing, near_dup, quality, secret_scan, substring_dup, token_counts, token_files
from tunetables.llm.common import table
from tunetables.llm.oracles import ORACLES  # noqa: F401  (read with the queries)
from tunetables.session import written

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """What every encoded length of ``documents`` answers as a context limit."""
    return token_counts.length_table(table(spark, folder, "documents"), tokenizer_path("word_bpe_49k.json"))


def op2_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """What is left of ``documents`` without strings of 400 bytes that occur twice."""
    return substring_dup.removal_digest(substring_dup.cut_documents(table(spark, folder, "documents")))


def op3_source_mix(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(table(spark, folder, "documents"))


def op4_token_files(spark: SparkSession, folder: str) -> DataFrame:
    return token_files.token_files(table(spark, folder, "documents"), tokenizer_path("word_bpe_49k.json"))


def op5_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    """Turns recovered from ``conversations`` written out as transcripts."""
    lines = written(chat_format.transcript_lines(table(spark, folder, "conversations")), "transcripts")
    return chat_format.formatted(lines.drop("state"), chat_format.learned(lines))


def op6_secrets(spark: SparkSession, folder: str) -> DataFrame:
    return secret_scan.secret_spans(table(spark, folder, "documents"))


def op9_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality.quality_verdicts(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op7_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """Documents that hold an item of ``benchmark``, with the item."""
    return decontaminate.leaks(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op8_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    """Near-duplicates at four words and a similarity of 0.8."""
    return near_dup.near_duplicates(table(spark, folder, "documents")).drop("cid")


def op10_lm_scores(spark: SparkSession, folder: str) -> DataFrame:
    return lm_score.lm_scores(table(spark, folder, "documents"))


def op11_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of ``embeddings`` that are near an anchor, yet not of its label."""
    return hard_negatives.hard_negatives(table(spark, folder, "embeddings"))


def op12_lexical_search(spark: SparkSession, folder: str) -> DataFrame:
    """The ten best of ``documents`` for each item of ``benchmark``."""
    return lexical_search.ranked_documents(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op13_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    """Every text of ``documents`` to byte-level tokens and back."""
    return byte_bpe.round_trip(table(spark, folder, "documents"), tokenizer_path("byte_bpe_50k.json"))


for _query in (op1_token_counts, op2_substring_dedup, op3_source_mix, op4_token_files, op5_chat_format, op6_secrets, op7_decontamination, op8_near_duplicates, op9_quality_rules, op10_lm_scores, op11_hard_negatives, op12_lexical_search, op13_byte_bpe):
    QUERIES[_query.__name__] = _query
