"""Length statistics.

Lengths are first counted map-side into a ``(length, n)`` table, whose size is the
number of distinct lengths; percentiles and bins come from that table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tunetables.session import written


def length_counts(df: DataFrame, length: str = "length") -> DataFrame:
    return df.groupBy(F.col(length).alias("length")).agg(F.count("*").alias("n"))


def length_summary(df: DataFrame, length: str = "length", approximate: bool = False) -> DataFrame:
    """Largest, 95th percentile (linear interpolation) and mean length.

    ``approximate`` keeps the percentile's memory fixed when lengths have very many
    distinct values.
    """
    counted = length_counts(df, length)
    if approximate:
        p95 = F.percentile_approx("length", F.lit(0.95), F.lit(10000))
        return df.select(F.col(length).alias("length")).agg(
            F.max("length").alias("max_length"),
            p95.cast("double").alias("p95_length"),
            F.avg("length").alias("mean_length"),
        )
    return counted.agg(
        F.max("length").alias("max_length"),
        F.percentile("length", F.lit(0.95), F.col("n")).alias("p95_length"),
        (F.sum(F.col("length") * F.col("n")) / F.sum("n")).alias("mean_length"),
    )


def length_histogram(df: DataFrame, length: str = "length", bins: int = 50) -> DataFrame:
    """Equal-width bins over [min, max], last bin closed: ``(bin, low, high, n)``.

    All ``bins`` rows are present.  A single distinct value is given a range of one
    around it, as numeric libraries do.
    """
    # read twice, for the range and for the bins: count the lengths once
    counted = written(length_counts(df, length), "length-counts")
    ends = counted.agg(F.struct(F.min("length").alias("lo"), F.max("length").alias("hi"))).scalar()
    same = ends["lo"] == ends["hi"]
    lo = F.when(same, ends["lo"] - 0.5).otherwise(ends["lo"].cast("double"))
    hi = F.when(same, ends["hi"] + 0.5).otherwise(ends["hi"].cast("double"))
    counts = (
        counted.select(bin_of(F.col("length"), lo, hi, bins).alias("bin"), "n")
        .groupBy("bin")
        .agg(F.sum("n").alias("n"))
    )
    width = (hi - lo) / bins
    # the fixed list of bins is tiny
    bin_numbers = df.sparkSession.range(bins).select(F.col("id").alias("bin"))
    edges = bin_numbers.where(ends["lo"].isNotNull())
    return F.broadcast(counts).join(edges, "bin", "right").select(
        "bin",
        (lo + F.col("bin") * width).alias("low"),
        (lo + (F.col("bin") + 1) * width).alias("high"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )


def bin_of(value: Column, lo: Column, hi: Column, bins: int) -> Column:
    return F.least(
        F.lit(bins - 1).cast("long"), F.floor((value - lo) * F.lit(float(bins)) / (hi - lo)).cast("long")
    )
