"""Exact weighted median and robust scale of a distributed column, for a whole table or by key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallylog.session import cut_lineage

# Fixed value: makes the median absolute deviation comparable to a standard deviation.
MAD_FACTOR = 1.4826
# Parts of equal width that a bracket is cut into.
PARTS = 4096


def _weighted(df: DataFrame, value: Column, weight: Column | None, by: Sequence[str]) -> DataFrame:
    """``x`` and whole-number weight ``w``, a value weighing as much as that many copies of it."""
    w = F.lit(1) if weight is None else weight
    return df.select(*by, value.cast("double").alias("x"), w.cast("bigint").alias("w")).filter("x IS NOT NULL AND w > 0")


def _brackets(values: DataFrame, by: Sequence[str]) -> DataFrame:
    """Where the middle lies at first: between the least and the largest value."""
    return values.groupBy(*by).agg(
        F.min("x").alias("low"), F.max("x").alias("high"), F.sum("w").alias("total"), F.lit(0).cast("bigint").alias("below")
    )


def _narrowed(bracketed: DataFrame, by: Sequence[str]) -> DataFrame:
    """One round of rank selection: the parts of each bracket that hold the two middle ranks.

    ``bracketed`` has the values with ``low, high, total, below`` of their bracket. A bracket is cut into parts of equal width, whose
    weights are summed before the shuffle. The sums, at most ``PARTS`` for a key, tell which parts hold the ranks. If that is one part
    with different values, it is the next bracket; else the two middle values are known: ranks in two parts are neighbours, so
    they are the last value of one and the first of the next.
    """
    x, low, high = F.col("x"), F.col("low"), F.col("high")
    width = (high - low) / PARTS
    # Kept within the parts for values outside the bracket, too, which Spark may compute before it drops them.
    number = F.greatest(F.lit(0), F.least(F.floor((x - low) / width), F.lit(PARTS - 1)))
    part = F.when(width > 0, number).otherwise(F.when(x > low, 1).otherwise(0))
    kept = ["total", "below"]
    sums = (
        bracketed.filter(x.between(low, high))
        .groupBy(*by, *kept, part.cast("int").alias("part"))
        .agg(F.sum("w").alias("w"), F.min("x").alias("least"), F.max("x").alias("most"))
    )
    upto = F.col("below") + F.sum("w").over(Window.partitionBy(*by).orderBy("part"))
    ranked = sums.withColumn("upto", upto)
    total, before = F.col("total"), F.col("upto") - F.col("w")

    def holds(rank: Column) -> Column:
        return (before < rank) & (F.col("upto") >= rank)

    first, second = holds(F.expr("(total + 1) div 2")), holds(F.expr("total div 2 + 1"))
    return (
        ranked.filter(first | second)
        .groupBy(*by, total.alias("total"))
        .agg(
            F.count(F.lit(1)).alias("parts"),
            F.min("least").alias("low"),
            F.max("most").alias("high"),
            F.max(F.when(first, F.col("most"))).alias("lower"),
            F.min(F.when(second, F.col("least"))).alias("upper"),
            F.min(before).alias("below"),
        )
        .withColumn("found", (F.col("parts") > 1) | (F.col("low") == F.col("high")))
        .withColumn("median", F.when(F.col("found"), (F.col("lower") + F.col("upper")) / 2))
    )


def _finite(low: float, high: float) -> None:
    if not (abs(low) < float("inf") and abs(high) < float("inf")):
        raise ArithmeticError("values that are not finite have no median here")


def exact_median(df: DataFrame, value: Column, weight: Column | None = None) -> float | None:
    """The exact median, without any task ordering the values; None for no values.

    With an even number of values it is the mean of the two in the middle. Each round narrows a bracket around the middle to a
    four-thousandth at least, so few rounds suffice, and most data with repeated values need one.
    """
    values = _weighted(df, value, weight, ())
    row = _brackets(values, ()).first()
    if row["total"] is None:
        return None
    _finite(row["low"], row["high"])
    while True:
        bracket = [F.lit(row[name]).alias(name) for name in ("low", "high", "total", "below")]
        row = _narrowed(values.select("x", "w", *bracket), ()).first()
        if row["found"]:
            return row["median"]


def exact_medians(df: DataFrame, by: Sequence[str], value: Column, weight: Column | None = None) -> DataFrame:
    """``exact_median`` of every key: the columns ``by`` and ``median``; keys without values have no row.

    All keys are narrowed together; a key leaves the rounds when its median is known.
    """
    by = list(by)
    values = _weighted(df, value, weight, by)
    brackets = cut_lineage(_brackets(values, by))
    ends = brackets.agg(F.min("low").alias("low"), F.max("high").alias("high")).first()
    if ends["low"] is not None:
        _finite(ends["low"], ends["high"])
    done: DataFrame | None = None
    while True:
        round_ = cut_lineage(_narrowed(values.join(brackets, by), by))
        known = round_.filter("found").select(*by, "median")
        done = known if done is None else done.unionAll(known)
        brackets = round_.filter("NOT found").select(*by, "low", "high", "total", "below")
        if brackets.isEmpty():
            return done


def robust_scale(df: DataFrame, column: str, weight: Column | None = None) -> float:
    """1.4826 x MAD; the population standard deviation if that is 0; 0.0 for no values."""
    value = F.col(column)
    median = exact_median(df, value, weight)
    if median is None:
        return 0.0
    scale = MAD_FACTOR * exact_median(df, F.abs(value - median), weight)
    if scale > 0:
        return scale
    values = _weighted(df, value, weight, ())
    mean = values.agg(F.sum(F.col("x") * F.col("w")) / F.sum("w")).first()[0]
    return values.agg(F.sqrt(F.sum(F.col("w") * (F.col("x") - mean) * (F.col("x") - mean)) / F.sum("w"))).first()[0]


def robust_scales(df: DataFrame, by: Sequence[str], column: str, weight: Column | None = None) -> DataFrame:
    """``robust_scale`` of every key: the columns ``by`` and ``scale``; keys without values have no row."""
    by = list(by)
    values = _weighted(df, F.col(column), weight, by)
    x, w = F.col("x"), F.col("w")
    center = exact_medians(values, by, x, w).join(values.groupBy(*by).agg((F.sum(x * w) / F.sum(w)).alias("mean")), by)
    apart = values.join(cut_lineage(center), by)
    off = x - F.col("mean")
    spread = apart.groupBy(*by).agg(F.sqrt(F.sum(w * off * off) / F.sum(w)).alias("deviation"))
    mad = exact_medians(apart, by, F.abs(x - F.col("median")), w).withColumn("mad", MAD_FACTOR * F.col("median"))
    scale = F.when(F.col("mad") > 0, F.col("mad")).otherwise(F.col("deviation"))
    return mad.join(spread, by).select(*by, scale.alias("scale"))
