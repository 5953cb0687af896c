"""Exact histogram of encoded lengths, and what its suffix sums answer."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tunetables.llm.encoding import Encoder
from tunetables.session import written

#: Lengths of one range of the suffix sums.
RANGE = 4096


def encoded_lengths(docs: DataFrame, tokenizer: str, text: str = "text") -> DataFrame:
    """``docs`` with ``n_tokens`` in place of every other column but none else: one row a document.

    Null and empty texts have length 0.
    """

    def counted(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encoder = Encoder(tokenizer)
        for part in parts:
            yield pd.Series([len(ids) // encoder.dtype.itemsize for ids in encoder.encode(part.tolist())], dtype="int64")

    return docs.select(F.pandas_udf(counted, "long")(F.col(text)).alias("n_tokens"))


def length_histogram(docs: DataFrame, tokenizer: str, text: str = "text") -> DataFrame:
    """A row for every encoded length: ``n_tokens``, ``documents``.

    Repeated rows count as often as they stand; an empty table gives no rows.  Sums are
    taken before the shuffle, so a length shared by a third of all documents is a few rows.
    """
    return encoded_lengths(docs, tokenizer, text).groupBy("n_tokens").agg(F.count("*").alias("documents"))


def suffix_sums(histogram: DataFrame) -> DataFrame:
    """The histogram with what holds for a context limit of ``n_tokens``.

    ``documents_from`` and ``tokens_from``: documents at least that long and their tokens;
    ``tokens_cut``: tokens of all documents cut at that limit; ``share_below``: of documents
    that are shorter.  Lengths are summed in ranges of 4,096; the sums of whole ranges (one row
    for every 4,096 lengths of the longest document) are the only rows that meet in one task.
    """
    own = histogram.select(
        "n_tokens", "documents", (F.col("n_tokens") * F.col("documents")).alias("_tokens"), F.floor(F.col("n_tokens") / RANGE).alias("_range")
    )
    ranges = own.groupBy("_range").agg(F.sum("documents").alias("_rd"), F.sum("_tokens").alias("_rt"))
    later = Window.orderBy(F.desc("_range")).rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    ranges = ranges.select(
        "_range",
        F.coalesce(F.sum("_rd").over(later), zero).alias("_ad"),
        F.coalesce(F.sum("_rt").over(later), zero).alias("_at"),
        F.sum("_rd").over(Window.partitionBy()).alias("_all"),
        F.sum("_rt").over(Window.partitionBy()).alias("_allt"),
    )
    inside = Window.partitionBy("_range").orderBy(F.desc("n_tokens")).rowsBetween(Window.unboundedPreceding, 0)
    summed = own.withColumns({"_d": F.sum("documents").over(inside), "_t": F.sum("_tokens").over(inside)}).join(ranges, "_range")
    docs_from, tokens_from = F.col("_d") + F.col("_ad"), F.col("_t") + F.col("_at")
    return summed.select(
        "n_tokens",
        "documents",
        docs_from.alias("documents_from"),
        tokens_from.alias("tokens_from"),
        (F.col("_allt") - tokens_from + F.col("n_tokens") * docs_from).alias("tokens_cut"),
        ((F.col("_all") - docs_from) / F.col("_all")).alias("share_below"),
    )


def length_table(docs: DataFrame, tokenizer: str, text: str = "text") -> DataFrame:
    """``suffix_sums`` of the whole table; the histogram is stored, so texts are encoded once."""
    return suffix_sums(written(length_histogram(docs, tokenizer, text), "length-histogram"))


def quantiles(lengths: DataFrame, shares: Sequence[float]) -> DataFrame:
    """For each share, the smallest length that at least that share of documents doesn't exceed.

    ``lengths`` is the result of ``suffix_sums``; no rows when it has none.
    """
    upto = F.col("share_below") + F.col("documents") / F.col("_all")
    total = lengths.agg(F.sum("documents").alias("_all"))
    asked = F.explode(F.array(*[F.lit(float(s)) for s in shares])).alias("share")
    rows = lengths.join(F.broadcast(total)).select("n_tokens", upto.alias("_upto"), asked)
    return rows.where(F.col("_upto") >= F.col("share") - 1e-12).groupBy("share").agg(F.min("n_tokens").alias("n_tokens"))


def cut_totals(lengths: DataFrame, limits: Sequence[int]) -> DataFrame:
    """For each context limit: ``tokens_cut`` (kept tokens) and ``documents_over`` (longer ones)."""
    asked = F.explode(F.array(*[F.lit(int(x)).cast("long") for x in limits])).alias("max_tokens")
    rows = lengths.select("n_tokens", "documents", asked)
    kept = F.least("n_tokens", "max_tokens") * F.col("documents")
    over = F.when(F.col("n_tokens") > F.col("max_tokens"), F.col("documents")).otherwise(0)
    return rows.groupBy("max_tokens").agg(F.sum(kept).alias("tokens_cut"), F.sum(over).alias("documents_over"))
