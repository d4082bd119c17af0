"""Savitzky-Golay smoothing in partitioned blocks.

A window of length ``2h + 1`` smooths with order 2, a window of 3 with order 1.
The least-squares weights have a closed form with whole numerators, so every sum
is exact and there is one division per point::

    weight(k) = (3 (3h^2 + 3h - 1) - 15 k^2) / ((2h - 1)(2h + 1)(2h + 3))
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# The smallest requested window, and the orders of the polynomial.
SMALLEST_WINDOW = 5
HIGHEST_ORDER = 2

# Positions per block of running sums.
BLOCK = 1024
# Sums of counts times squared positions, in whole numbers of 38 digits: exact for any window.
EXACT = "decimal(38,0)"


def window_length(points: Column, requested: int) -> Column:
    """The odd window used for a series of ``points``; 0 where it is too short to smooth."""
    wished = max(SMALLEST_WINDOW, int(requested))
    wished += 1 - wished % 2
    longest = points - F.when(points % 2 == 0, 1).otherwise(0)
    return F.when(points < 3, F.lit(0).cast("bigint")).otherwise(F.least(F.lit(wished).cast("bigint"), longest))


def polynomial_order(window: Column) -> Column:
    return F.when(window == 0, F.lit(0).cast("bigint")).otherwise(
        F.least(F.lit(HIGHEST_ORDER).cast("bigint"), F.greatest(F.lit(1).cast("bigint"), window - 2))
    )


def savgol_params(series: DataFrame, requested: int) -> DataFrame:
    """One row (``points``, ``window_length``, ``polyorder``) for a series."""
    return with_params(series.agg(F.count(F.lit(1)).alias("points")), requested)


def with_params(lengths: DataFrame, requested: int) -> DataFrame:
    """Adds ``window_length`` and ``polyorder`` to rows with a number of ``points``."""
    return lengths.withColumn("window_length", window_length(F.col("points"), requested)).withColumn(
        "polyorder", polynomial_order(F.col("window_length"))
    )


def savgol_coefficients(params: DataFrame) -> DataFrame:
    """The weights (``k``, ``numerator``, ``denominator``, ``weight``) for the windows in ``params``."""
    half, square = F.col("half"), F.col("k") * F.col("k")
    curved = F.col("polyorder") >= 2
    return (
        params.filter("window_length > 0")
        .withColumn("half", F.expr("window_length div 2"))
        .withColumn("k", F.explode(F.sequence(-half, half)))
        .select(
            "window_length",
            "k",
            F.when(curved, 3 * (3 * half * half + 3 * half - 1) - 15 * square)
            .otherwise(F.lit(1))
            .alias("numerator"),
            F.when(curved, (2 * half - 1) * (2 * half + 1) * (2 * half + 3))
            .otherwise(F.col("window_length"))
            .alias("denominator"),
        )
        .withColumn("weight", F.col("numerator") / F.col("denominator"))
    )


def _column(number: int | Column) -> Column:
    return number if isinstance(number, Column) else F.lit(number).cast("bigint")


def reflect_pad(series: DataFrame, points: int | Column, half: int | Column, value: str, *columns: str) -> DataFrame:
    """The series with ``half`` mirrored positions before its start and after its end, and ``columns`` as they are.

    The edge points themselves are not repeated. A window never exceeds the
    series, so one reflection reaches far enough.
    """
    i, points, half = F.col("i"), _column(points), _column(half)
    places = F.array(
        i,
        F.when(i.between(1, half), -i),
        F.when(i.between(points - 1 - half, points - 2), 2 * (points - 1) - i),
    )
    return series.select(F.explode(places).alias("i"), value, *columns).filter("i IS NOT NULL")


def _weight_columns(half: Column, order: Column) -> tuple[Column, Column, Column]:
    """``(a, b, d)`` such that the weight at distance ``k`` is ``(a - b k^2) / d``."""
    curved, h = order >= 2, half.cast(EXACT)
    a = F.when(curved, 3 * (3 * h * h + 3 * h - 1)).otherwise(F.lit(1))
    b = F.when(curved, F.lit(15)).otherwise(F.lit(0))
    d = F.when(curved, (2 * h - 1) * (2 * h + 1) * (2 * h + 3)).otherwise(2 * h + 1)
    return a.cast(EXACT), b.cast(EXACT), d.cast("double")


def savgol_smooth(
    series: DataFrame,
    points: int | Column,
    window: int | Column,
    order: int | Column,
    value: str,
    name: str = "smoothed",
    by: Sequence[str] = (),
    wanted: Column | None = None,
) -> DataFrame:
    """Adds the smoothed ``value`` to a series with positions ``i`` from 0 to ``points - 1``, for each key in ``by``.

    Running sums of v, xv and x^2 v start anew in every block of positions, whatever the
    window. The sum over a window is the difference of two of them plus the totals of the blocks
    that it crosses. So each point costs the same for every window, and no task holds more than a block.

    Lengths, windows and orders may be columns that depend on the key only, and are then among ``by``. Rows of zeros may be left out of the
    series where no ``wanted`` row is within a window and one position of them; the result has the wanted rows.
    """
    if isinstance(window, int) and window == 0:
        return series.select(*by, "i", value, F.col(value).cast("double").alias(name))
    by, wanted = list(by), F.lit(True) if wanted is None else wanted
    points, window, order = _column(points), F.greatest(_column(window), F.lit(1).cast("bigint")), _column(order)
    half = F.floor(window / 2)
    i, v, x = F.col("i"), F.col(value).cast(EXACT), F.col("i").cast(EXACT)
    moments = {"s0": v, "s1": x * v, "s2": x * x * v}
    padded = reflect_pad(series.withColumn("wanted", wanted), points, half, value, "wanted", *by).select(
        *by,
        "i",
        value,
        "wanted",
        F.floor((i + half) / BLOCK).alias("block"),
        *[moment.cast(EXACT).alias(s) for s, moment in moments.items()],
    )
    so_far = Window.partitionBy(*by, "block").orderBy("i").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    running = padded.select(*by, "i", value, "wanted", *[F.sum(s).over(so_far).cast(EXACT).alias(s) for s in moments])
    # A position ends the window of one point, is the last before that of another, and the middle of its own.
    part = F.explode(
        F.array(
            F.struct((i - half).alias("at"), F.lit(1).alias("sign")),
            F.struct((i + half + 1).alias("at"), F.lit(-1).alias("sign")),
            F.struct(i.alias("at"), F.lit(0).alias("sign")),
        )
    )
    at, middle = F.col("part.at"), F.col("part.sign") == 0
    parts = running.select(*by, part.alias("part"), value, "wanted", *moments).filter(at.between(0, points - 1))
    signed = [F.sum(F.col(s) * F.col("part.sign").cast("decimal(1,0)")).cast(EXACT).alias(s) for s in moments]
    ends = (
        parts.groupBy(*by, at.alias("i"))
        .agg(F.max(F.when(middle, F.col(value))).alias(value), F.max(middle & F.col("wanted")).alias("wanted"), *signed)
        .filter("wanted")
        .withColumn("first_block", F.floor(F.greatest(i - 1, F.lit(0)) / BLOCK))
        .withColumn("crossed", F.floor((i + 2 * half) / BLOCK) - F.col("first_block"))
    )
    totals = padded.groupBy(*by, "block").agg(*[F.sum(s).cast(EXACT).alias(s) for s in moments])
    # How many blocks a window can cross; sums over that many are made for every block they may begin with.
    counts = F.array_distinct(F.array(F.floor(2 * half / BLOCK), F.floor(window / BLOCK), F.floor(window / BLOCK) + 1))
    runs = F.flatten(
        F.transform(
            F.filter(counts, lambda n: n > 0),
            lambda n: F.transform(
                F.sequence(F.lit(0).cast("bigint"), n - 1),
                lambda k: F.struct((F.col("block") - k).alias("first_block"), n.alias("crossed")),
            ),
        )
    )
    crossings = (
        totals.select(*by, F.explode(runs).alias("run"), *moments)
        .select(*by, "run.*", *moments)
        .groupBy(*by, "first_block", "crossed")
        .agg(*[F.sum(s).cast(EXACT).alias(f"c_{s}") for s in moments])
    )
    joined = ends.join(crossings, [*by, "first_block", "crossed"], "left")
    zero = F.lit(0).cast(EXACT)
    s0, s1, s2 = ((F.col(s) + F.coalesce(f"c_{s}", zero)).cast(EXACT) for s in moments)
    a, b, d = _weight_columns(half, order)
    second_moment = (s2 - 2 * x * s1 + x * x * s0).cast(EXACT)
    numerator = (a * s0).cast(EXACT) - (b * second_moment).cast(EXACT)
    return joined.select(*by, "i", value, (numerator.cast("double") / d).alias(name))
