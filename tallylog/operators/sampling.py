"""Downsampling of minute series for charts. The two step rules differ on purpose."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Point caps, rows of the first page, and reach around an anomaly.
SERIES_POINTS = 1200
PLOT_POINTS = 2000
FIRST_PAGE_ROWS = 25
NEIGHBOURS = 2

# Order values per numbering block. Log times have four-digit years, so there are at most
# 325,000 blocks of minutes: a bounded table, even where a window puts all of it in order.
NUMBERING_BLOCK = 16_384


def with_position(df: DataFrame, order: str, name: str = "position") -> DataFrame:
    """Adds the 0-based position in the order of a distinct whole-number column.

    Rows are numbered inside blocks of the order column, and each block starts
    where the counts of the blocks before it end.
    """
    blocked = df.withColumn("_block", F.floor(F.col(order) / NUMBERING_BLOCK))
    before = Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        blocked.groupBy("_block")
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select("_block", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"))
    )
    inside = F.row_number().over(Window.partitionBy("_block").orderBy(order)) - 1
    return blocked.join(starts, "_block").withColumn(name, F.col("_start") + inside).drop("_block", "_start")


def sample_anomaly_series(points: DataFrame, total: int, max_points: int = SERIES_POINTS) -> DataFrame:
    """Every ``ceil(total / max_points)``-th minute and the neighbours of every anomaly."""
    columns = points.columns
    if total <= max_points:
        return points
    step = -(-total // max_points)
    around = F.explode(F.sequence(F.col("i") - NEIGHBOURS, F.col("i") + NEIGHBOURS))
    near = points.filter("is_anomaly").select(around.alias("i")).distinct().withColumn("near", F.lit(True))
    return (
        points.join(near, "i", "left")
        .filter((F.col("i") % step == 0) | F.col("near"))
        .select(columns)
    )


def sample_evenly(
    df: DataFrame, order: str, total: int, max_points: int = PLOT_POINTS, keep: str | None = None
) -> DataFrame:
    """Every ``floor(total / max_points)``-th row, the last row, and rows flagged by ``keep``."""
    if total <= max_points:
        return df
    step = max(1, total // max_points)
    position = F.col("position")
    chosen = (position % step == 0) | (position == total - 1)
    if keep:
        chosen = chosen | F.col(keep)
    return with_position(df, order).filter(chosen).drop("position")


def first_page(anomalies: DataFrame, rows: int = FIRST_PAGE_ROWS) -> DataFrame:
    """The first anomalies in time order, each with the number of all of them."""
    total = anomalies.agg(F.count(F.lit(1)).alias("total"))
    return anomalies.orderBy("minute").limit(rows).withColumn("total", total.scalar())
