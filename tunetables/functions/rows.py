"""Row-level helper for costly columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def computed_once(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns that are evaluated once per row, however often they are used.

    A plain projection may be merged with, or have a filter pushed through it, which
    repeats its expressions at each use.  A one-row generator is not rewritten so.
    """
    made = F.struct(*[column.alias(name) for name, column in columns.items()])
    return df.select("*", F.inline(F.array(made)))
