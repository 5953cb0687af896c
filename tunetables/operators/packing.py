"""Sequence packing: one long token stream cut into blocks of equal length."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tunetables.operators.ordering import running_total
from tunetables.session import written


def pack(df: DataFrame, ids: str, block_length: int, order: str = "idx") -> DataFrame:
    """``(block, n_tokens, ids)``: token streams concatenated in ``order`` and cut.

    Encoded rows are stored once with their lengths, so the passes that add up lengths
    read no ids and nothing is encoded twice.  Each row's place in the stream is a
    running total of row lengths, computed over bounded ranges of ``order`` without the
    ids, which meet their place by key; rows that cross a block boundary are sliced.  A block gathers at most ``block_length`` tokens.
    The last block may be shorter; no token is dropped.
    """
    stored = written(df.select(order, F.col(ids).alias("ids"), F.size(ids).alias("n")), "encoded")
    lengths = stored.where(F.col("n") > 0).select(order, "n")
    starts = running_total(lengths, [], order, F.col("n"), before="start").select(order, "start")
    placed = stored.join(starts, order)
    start, end = F.col("start"), F.col("start") + F.col("n")

    def cut(block: Column) -> Column:
        low = F.greatest(start, block * block_length)
        high = F.least(end, (block + 1) * block_length)
        piece = F.slice("ids", (low - start + 1).cast("int"), (high - low).cast("int"))
        return F.struct(block.alias("block"), low.alias("low"), piece.alias("piece"))

    first, last = F.floor(start / block_length), F.floor((end - 1) / block_length)
    # cut inside the row: exploding block numbers first would copy long id lists
    pieces = placed.select(F.inline(F.transform(F.sequence(first, last), cut)))
    return (
        pieces.groupBy("block")
        .agg(F.array_sort(F.collect_list(F.struct("low", "piece"))).alias("_p"))
        .select("block", F.flatten(F.col("_p.piece")).alias("ids"))
        .select("block", F.size("ids").cast("long").alias("n_tokens"), "ids")
    )
