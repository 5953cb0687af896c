"""Number expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DIGITS = 4
_SCALE = float(10**DIGITS)
_SPLIT = float(2**27 + 1)
_EXACT_BELOW = float(2**52) / (4 * _SCALE)


def round4(x: Column) -> Column:
    """Round a double to four places by its exact binary value, ties to even.

    ``round``/``bround`` decide on the shortest decimal spelling, where 2.67555
    looks like a tie although the stored value lies below it.  Here the stored
    value is compared with the midpoint exactly: the product with 2*10^4 is
    formed from two half-width parts, each free of rounding error.
    """

    def rounded(v: Column) -> Column:
        low = F.floor(v * _SCALE).cast("double")
        high_part = v * _SPLIT - (v * _SPLIT - v)
        above = (high_part * (2 * _SCALE) - (2 * low + 1)) + (v - high_part) * (2 * _SCALE)
        up = (above > 0) | ((above == 0) & (F.pmod(low, F.lit(2.0)) == 1))
        nearest = (low + F.when(up, 1.0).otherwise(0.0)) / _SCALE
        return F.when(F.isnan(v) | (F.abs(v) >= _EXACT_BELOW), v).otherwise(nearest)

    # the one-element array binds x to a name, so it is evaluated once
    return F.get(F.transform(F.array(x), rounded), F.lit(0))


def neg_log_sigmoid(x: Column) -> Column:
    """``-log(sigmoid(x))`` without overflow."""
    return F.log1p(F.exp(-F.abs(x))) + F.greatest(-x, F.lit(0.0))


def f1(overlap: Column, n_prediction: Column, n_reference: Column) -> Column:
    """F1 of precision overlap/n_prediction and recall overlap/n_reference."""
    return F.when(overlap > 0, 2.0 * overlap / (n_prediction + n_reference)).otherwise(
        F.lit(0.0)
    )
