"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tunetables.session import written


def _pointed(links: DataFrame) -> DataFrame:
    """Links with a > b, once each."""
    return links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def _to_least(rows: DataFrame) -> DataFrame:
    """``rows`` (u, v) with ``m``, the least of u and its neighbours, for each u."""
    least = rows.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
    return rows.join(least, "u")


def components(links: DataFrame) -> DataFrame:
    """``cid, component`` (the least id of its component) for every id in ``links`` (a, b).

    Alternates large stars and small stars: every node links its larger, then its smaller
    neighbours to the least one it knows, until nothing changes; the number of rounds grows with
    the logarithm of the longest path.  Each round is a written table, so nothing is computed
    twice, and the driver sees a count and a sum.
    """
    now, before = written(_pointed(links), "links"), None
    while True:
        state = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
        both = now.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(now.select(F.col("b").alias("u"), F.col("a").alias("v")))
        large = _pointed(_to_least(both).where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b")))
        down = large.select(F.col("a").alias("u"), F.col("b").alias("v"))
        small = _to_least(down)
        small = small.select(F.col("v").alias("a"), F.col("m").alias("b")).unionByName(small.select(F.col("u").alias("a"), F.col("m").alias("b")))
        now = written(_pointed(small), "links")
    stars = now.select(F.col("a").alias("cid"), F.col("b").alias("component"))
    return stars.unionByName(stars.select(F.col("component").alias("cid"), "component").distinct())
