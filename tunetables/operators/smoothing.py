"""Series smoothing: moving average, exponential average, Savitzky-Golay.

Input is a long table with a series key, an integer order column and a ``value``
that is never NULL; each function adds ``smoothed``.  A window of 1 or less, or a series no longer than
the window, leaves values as they are.  Series are cut into chunks by position, so
the longest one is as parallel as many short ones.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tunetables.operators.ordering import SPAN, overlapping_chunks, with_position
from tunetables.operators.series import CURVE
from tunetables.session import written

METHODS = ("moving_average", "exponential", "savgol")


def smoothed(
    df: DataFrame,
    method: str,
    window: int | None,
    keys: Sequence[str] = CURVE,
    order: str = "line_no",
) -> DataFrame:
    """Dispatch by method name; an unknown method leaves values unchanged."""
    if window is None or window <= 1 or method not in METHODS:
        return df.withColumn("smoothed", F.col("value"))
    if method == "moving_average":
        return moving_average(df, window, keys, order)
    if method == "exponential":
        return exponential_average(df, window, keys, order)
    return savgol(df, window, keys, order)


def moving_average(
    df: DataFrame, window: int, keys: Sequence[str] = CURVE, order: str = "line_no"
) -> DataFrame:
    """Mean of the last ``window`` values; NULL before the first full window."""
    keys = list(keys)
    if window <= 1:
        return df.withColumn("smoothed", F.col("value"))
    chunks = overlapping_chunks(with_position(df, keys, order), "pos", before=window - 1)
    frame = Window.partitionBy(*keys, "chunk").orderBy("pos").rowsBetween(1 - window, 0)
    mean = F.avg("value").over(frame)
    return _own(
        chunks.withColumn(
            "smoothed",
            F.when(F.col("n") <= window, F.col("value")).when(F.col("pos") >= window - 1, mean),
        ),
        df,
    )


def _own(chunks: DataFrame, df: DataFrame) -> DataFrame:
    return chunks.where("is_own").select(*df.columns, "smoothed")


# Powers of the decay ratio in a block stay above 1e-174, so values up to 1e130 are safe.
_LOG_RANGE = 400.0
# A factor of e^-80 is lost in a double's rounding.
_NEGLIGIBLE = -80.0


def exponential_average(
    df: DataFrame, window: int, keys: Sequence[str] = CURVE, order: str = "line_no"
) -> DataFrame:
    """``s[0] = v[0]``, ``s[t] = a*v[t] + (1-a)*s[t-1]`` with ``a = 2/(window+1)``.

    As in the recurrence, a value that is not finite marks all later ones.
    """
    keys = list(keys)
    if window <= 1:
        return df.withColumn("smoothed", F.col("value"))
    alpha = 2.0 / (window + 1)
    value, infinity = F.col("value"), float("inf")
    tests = {
        "_nans": F.isnan(value),
        "_ups": value == infinity,
        "_downs": value == -infinity,
    }
    placed = written(
        with_position(df, keys, order, more={name: test.cast("int") for name, test in tests.items()}),
        "placed-values",
    )
    seen = {name: (F.col(name) > 0) | test for name, test in tests.items()}
    first_weight = F.when(F.col("pos") == 0, 1.0).otherwise(alpha)
    decayed = _decaying_sum(
        placed.withColumn("_x", value * first_weight), keys, "pos", "_x", math.log1p(-alpha), "_s"
    )
    average = (
        F.when(seen["_nans"] | (seen["_ups"] & seen["_downs"]), F.lit(float("nan")))
        .when(seen["_ups"], infinity)
        .when(seen["_downs"], -infinity)
        .otherwise(F.col("_s"))
    )
    return decayed.withColumn(
        "smoothed", F.when(F.col("n") <= window, value).otherwise(average)
    ).select(*df.columns, "smoothed")


def _decaying_sum(
    df: DataFrame, keys: list[str], pos: str, x: str, log_ratio: float, out: str, level: int = 0
) -> DataFrame:
    """``s[t] = x[t] + ratio * s[t-1]`` along dense 0-based positions; ``df`` is stored or cheap.

    A block maps the sum before it to the sum at its end: times the ratio of the whole block, plus what its own
    rows add, which is one aggregate over the rows, summed map-side, and one stored row a block.
    These maps are put together by the same recurrence over blocks; once a block's ratio is below any
    double's precision, only the block directly before matters and the recursion ends.  Within
    a block the recurrence is a running sum scaled by powers of the ratio.
    """
    block, carry = f"_block{level}", f"_carry{level}"
    size = max(1, min(SPAN, int(_LOG_RANGE / -log_ratio)))
    cut = df.withColumn(block, F.floor(F.col(pos) / size).cast("long"))
    place = (F.col(pos) % size).cast("double")
    added = F.sum(F.col(x) * F.exp((size - 1 - place) * log_ratio))
    ends = cut.groupBy(*keys, block).agg(F.count("*").alias("_rows"), added.alias(carry))
    ends = written(ends.where(F.col("_rows") == size).drop("_rows"), "block-ends")
    block_log_ratio = size * log_ratio
    if block_log_ratio > _NEGLIGIBLE:
        total = f"_total{level}"
        ends = _decaying_sum(ends, keys, block, carry, block_log_ratio, total, level + 1).select(
            *keys, block, F.col(total).alias(carry)
        )
    scale = F.exp(place * log_ratio)
    along = Window.partitionBy(*keys, block).orderBy(pos).rowsBetween(Window.unboundedPreceding, 0)
    inside = cut.withColumn(f"_local{level}", F.sum(F.col(x) / scale).over(along) * scale)
    carried = ends.withColumn(block, F.col(block) + 1)
    from_before = F.exp((place + 1) * log_ratio) * F.coalesce(carry, F.lit(0.0))
    return (
        inside.join(carried, [*keys, block], "left")
        .withColumn(out, F.col(f"_local{level}") + from_before)
        .select(*df.columns, out)
    )


def savgol_window(window: int) -> int:
    """Window actually used: odd, one less when even."""
    return window if window % 2 else window - 1


def savgol(
    df: DataFrame, window: int, keys: Sequence[str] = CURVE, order: str = "line_no"
) -> DataFrame:
    """Least-squares quadratic over a centred window; end points from the end windows.

    The fit at a place needs three moments of its window only: the sums of the values, of z times them and of z
    squared times them.  They are sums over a row frame, with z counted from the middle of a chunk of a
    few windows so that no digits are lost; rows at the ends take those of the first and the last whole window.
    """
    keys = list(keys)
    w = savgol_window(window)
    if window <= 1 or w < 3:
        return df.withColumn("smoothed", F.col("value"))
    half, size = w // 2, max(8 * w, 64)
    chunks = overlapping_chunks(with_position(df, keys, order), "pos", before=w - 1, after=w - 1, size=size)
    pos, n, value = F.col("pos"), F.col("n"), F.col("value")
    middle = F.col("chunk") * size + size // 2
    z = (pos - middle).cast("double")
    frame = Window.partitionBy(*keys, "chunk").orderBy("pos").rowsBetween(-half, half)
    moments = F.struct(F.sum(value).over(frame), F.sum(value * z).over(frame), F.sum(value * z * z).over(frame))
    centre = F.greatest(F.lit(half), F.least(pos, n - 1 - half))
    chunk = Window.partitionBy(*keys, "chunk")
    placed = chunks.withColumn("_moments", moments)
    # the windows that the ends share, each found in the chunk of the rows that need it
    first = F.max(F.when(pos == half, F.col("_moments"))).over(chunk)
    last = F.max(F.when(pos == n - 1 - half, F.col("_moments"))).over(chunk)
    own = F.when(pos < half, first).when(pos > n - 1 - half, last).otherwise(F.col("_moments"))
    fitted = quadratic_fit(own, (centre - middle).cast("double"), (pos - centre).cast("double"), w)
    return _own(placed.withColumn("smoothed", F.when(n <= window, value).otherwise(fitted)), df)


def quadratic_fit(moments: Column, centre: Column, x: Column, w: int) -> Column:
    """Value at offset ``x`` from its centre of the quadratic fitted to a window of ``w`` values.

    ``moments`` has the sums of the values times z to the powers 0, 1 and 2, and the window's centre is at z = ``centre``.
    The fit is by the orthogonal polynomials 1, z and z^2 - c.
    """
    c = (w * w - 1) / 12
    sum_z2 = w * (w * w - 1) / 12
    sum_q2 = w * (w * w - 1) * (w * w - 4) / 180
    m0, m1, m2 = (moments.getField(f"col{k}") for k in (1, 2, 3))
    about1 = m1 - centre * m0
    about2 = m2 - 2 * centre * m1 + centre * centre * m0
    return m0 / w + x * about1 / sum_z2 + (x * x - c) * (about2 - c * m0) / sum_q2
