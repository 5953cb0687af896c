"""Running totals, row positions and overlapping chunks without a whole-group sort.

A window over one run, or over a whole table, sends that group to one task.
The functions here work on bounded pieces instead: the integer order key is cut
into ranges of ``SPAN`` values, ranges are summed map-side, the sums are added up
over ranges of ranges, and each piece is then numbered on its own.  A group that
holds a third of the table is spread over as many tasks as it has pieces.  Pieces
depend only on key values, so a recomputed task gives the same answer.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tunetables.session import written

SPAN_BITS = 16
SPAN = 1 << SPAN_BITS


def running_total(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    value: Column,
    before: str = "before",
    total: str = "total",
    wider: dict[str, tuple[Sequence[str], Column]] | None = None,
    more: dict[str, Column] | None = None,
) -> DataFrame:
    """Add the sum of ``value`` over earlier rows of the group, and the group sum.

    ``wider`` adds sums over several groups: a name, the part of ``keys`` that is
    shared, and a condition on ``keys`` saying which groups to add up.  ``more`` names
    further columns to sum over earlier rows on the way.

    ``order`` is an integer column, unique within a group; it and ``keys`` are never
    NULL.  Two passes over ``df``: one reads only keys, ``order`` and the summed columns
    and stores their sums per range (a row per ``SPAN`` order values), the other adds
    the sums to the rows.  Ranges are summed in ranges of ranges twice more, so for any
    64-bit ``order``, however sparse, no window of a group covers more than ``SPAN`` rows.
    """
    keys, wider = list(keys), wider or {}
    summed = {before: value, **(more or {})}
    count = range(len(summed))
    range1 = F.shiftright(F.col(order).cast("long"), SPAN_BITS)
    marked = df.withColumn("_r1", range1).withColumns(
        {f"_v{i}": column.cast("long") for i, column in enumerate(summed.values())}
    )
    sums1 = written(
        marked.groupBy(*keys, "_r1").agg(*[F.sum(f"_v{i}").alias(f"_s{i}") for i in count]),
        "range-sums",
    ).withColumn("_r2", F.shiftright("_r1", SPAN_BITS)).withColumn("_r3", F.shiftright("_r2", SPAN_BITS))
    again = [F.sum(f"_s{i}").alias(f"_s{i}") for i in count]
    sums2 = sums1.groupBy(*keys, "_r3", "_r2").agg(*again)
    sums3 = sums2.groupBy(*keys, "_r3").agg(*again)

    def earlier(column: str, by: list[str], along: str) -> Column:
        frame = Window.partitionBy(*by).orderBy(along).rowsBetween(Window.unboundedPreceding, -1)
        return F.coalesce(F.sum(column).over(frame), F.lit(0).cast("long"))

    def started(sums: DataFrame, inner: str, outer: str, starts: DataFrame) -> DataFrame:
        """Start of each ``inner`` range: what lies before it in its ``outer`` range, and that one's start."""
        inside = sums.select(
            *keys,
            inner,
            outer,
            *[earlier(f"_s{i}", [*keys, outer], inner).alias(f"_in{i}") for i in count],
        )
        return inside.join(starts, [*keys, outer]).select(
            *keys,
            inner,
            *[(F.col(f"_start{i}") + F.col(f"_in{i}")).alias(f"_start{i}") for i in count],
            "_all",
            *wider,
        )

    # order >> 48 has 65,536 values at most
    starts3 = sums3.select(
        *keys,
        "_r3",
        *[earlier(f"_s{i}", keys, "_r3").alias(f"_start{i}") for i in count],
        F.sum("_s0").over(Window.partitionBy(*keys)).alias("_all"),
        *[
            F.sum(F.when(chosen, F.col("_s0"))).over(Window.partitionBy(*shared)).alias(name)
            for name, (shared, chosen) in wider.items()
        ],
    )
    starts1 = started(sums1, "_r1", "_r2", started(sums2, "_r2", "_r3", starts3))
    inside = marked.select(
        *df.columns,
        "_r1",
        *[earlier(f"_v{i}", [*keys, "_r1"], order).alias(f"_local{i}") for i in count],
    )
    return inside.join(starts1, [*keys, "_r1"]).select(
        *[F.col(c) for c in df.columns],
        *[
            (F.col(f"_start{i}") + F.col(f"_local{i}")).alias(name)
            for i, name in enumerate(summed)
        ],
        F.col("_all").alias(total),
        *wider,
    )


def with_position(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    pos: str = "pos",
    n: str = "n",
    wider: dict[str, tuple[Sequence[str], Column]] | None = None,
    more: dict[str, Column] | None = None,
) -> DataFrame:
    """Add each row's 0-based position in its group and the group's row count."""
    return running_total(df, keys, order, F.lit(1), pos, n, wider, more)


def ranked(df: DataFrame, *order: Column, rank: str) -> DataFrame:
    """Add a dense 0-based rank by any sort order, for orders that are not integers.

    The table is range-sorted and written once with each row's place in its sorted
    part, so places are stored data; parts are then offset by earlier parts' sizes.
    ``order`` should break all ties.
    """
    place = F.monotonically_increasing_id()
    low_bits = 33  # monotonically_increasing_id puts the partition above bit 33
    stored = written(
        df.orderBy(*order)
        .withColumn("_id", place)
        .withColumn("_part", F.shiftright("_id", low_bits))
        .withColumn("_place", F.col("_id").bitwiseAND(F.lit((1 << low_bits) - 1)))
        .drop("_id"),
        "ranked",
    )
    sizes = stored.groupBy("_part").agg(F.count("*").alias("_size"))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # one row per sorted part: as many as there were sort tasks
    starts = sizes.select(
        "_part", F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_start")
    )
    return stored.join(F.broadcast(starts), "_part").select(
        *df.columns, (F.col("_start") + F.col("_place")).cast("long").alias(rank)
    )


def overlapping_chunks(
    df: DataFrame, pos: str, before: int, after: int = 0, size: int = SPAN
) -> DataFrame:
    """Cut positions into chunks that carry neighbours from the chunk on either side.

    Adds ``chunk`` and ``is_own``: rows within ``before`` of the next chunk are
    repeated there as context, and rows within ``after`` of the previous chunk
    likewise, marked ``is_own = false``.  A frame of that reach then sees the same
    rows in a chunk as in the whole series.
    """
    size = max(size, before, after, 1)
    p = F.col(pos)
    home = F.floor(p / size).cast("long")
    offset = p % size
    targets = [F.struct(home.alias("chunk"), F.lit(True).alias("is_own"))]
    if before:
        onward = F.struct((home + 1).alias("chunk"), F.lit(False).alias("is_own"))
        targets.append(F.when(offset >= size - before, onward))
    if after:
        back = F.struct((home - 1).alias("chunk"), F.lit(False).alias("is_own"))
        targets.append(F.when((offset < after) & (home > 0), back))
    return df.select("*", F.inline(F.array_compact(F.array(*targets))))
