"""Minute spines: gap edges for the trends, runs for the detection, every minute where it is asked for."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallylog.functions.buckets import TRENDED_FAMILIES, minute_number, minute_start
from tallylog.operators.stretches import expand, value_runs

COUNTS = ["requests", *TRENDED_FAMILIES]


@dataclass(frozen=True)
class Span:
    """First minute number and length of the continuous minute series."""

    first: int
    points: int


def span_row(minutes: DataFrame) -> DataFrame:
    """One row (``first``, ``points``); ``first`` is NULL for an empty minute table."""
    return span_rows(minutes)


def span_rows(minutes: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """``first`` and ``points`` of every key."""
    number = minute_number(F.col("minute"))
    return minutes.groupBy(*by).agg(F.min(number).alias("first"), F.max(number).alias("last")).select(
        *by, "first", F.coalesce(F.col("last") - F.col("first") + 1, F.lit(0).cast("bigint")).alias("points")
    )


def minute_span(minutes: DataFrame) -> Span:
    """One small job over the minute table; later plans use both numbers as literals."""
    row = span_row(minutes).first()
    return Span(row["first"] or 0, row["points"])


def sparse_trend(minutes: DataFrame, span: Span | None = None) -> DataFrame:
    """Present minutes and the first and last missing minute of each gap, counts filled with 0.

    Every present minute also names its two neighbours with zero counts. Summing by
    minute merges a neighbour into its own row if it is present, and leaves a zero
    row if it is a gap edge: one aggregate instead of a lag over the whole series,
    a distinct union and a join.
    """
    span = span or minute_span(minutes)
    number = minute_number(F.col("minute"))
    own = F.col("step") == 0
    return (
        minutes.select(
            number.alias("number"), *COUNTS, F.explode(F.array(*map(F.lit, (-1, 0, 1)))).alias("step")
        )
        .groupBy((F.col("number") + F.col("step")).alias("number"))
        .agg(*[F.sum(F.when(own, F.col(name)).otherwise(0)).alias(name) for name in COUNTS])
        .filter(F.col("number").between(span.first, span.first + span.points - 1))
        .select(minute_start(F.col("number")).alias("minute"), *COUNTS)
    )


def family_trends(trend: DataFrame) -> DataFrame:
    """Long form of a trend: one row per status class and minute."""
    return trend.unpivot("minute", TRENDED_FAMILIES, "family", "requests")


def continuous_minutes(spark: SparkSession, span: Span) -> DataFrame:
    """Every minute of the span with its position ``i``, generated in parallel."""
    return spark.range(span.points).select(
        F.col("id").alias("i"), minute_start(F.col("id") + span.first).alias("minute")
    )


def error_points(minutes: DataFrame, span: Span) -> DataFrame:
    """The minutes with 5xx (``i``, ``errors``)."""
    number = minute_number(F.col("minute"))
    return minutes.filter(F.col("5xx") > 0).select((number - span.first).alias("i"), F.col("5xx").alias("errors"))


def error_runs(minutes: DataFrame, span: Span) -> DataFrame:
    """5xx per minute as runs (``start``, ``length``, ``errors``): minutes with errors, and what lies between as one run of 0."""
    return value_runs(error_points(minutes, span), span.points, "errors")


def error_series(minutes: DataFrame, span: Span) -> DataFrame:
    """5xx per minute on the continuous spine (``i``, ``errors``), 0 where nothing was logged: as long as the span is."""
    start = F.col("start")
    return expand(error_runs(minutes, span), start, start + F.col("length") - 1, "errors").select("i", "errors")
