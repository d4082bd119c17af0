"""The data behind the report's charts, as tables; drawing them is left to other tools."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallylog.functions.buckets import TRENDED_FAMILIES, iso_minute
from tallylog.operators.ranking import with_rank
from tallylog.plans.report import Report


def bar_feed(table: DataFrame, key: str) -> DataFrame:
    """A top-N table from its last row to its first, numbered in that order.

    Horizontal bars are drawn upwards, so the most frequent key comes last. However many rows the table was asked
    for, they are numbered by ranges.
    """
    numbered = with_rank(table, F.asc("count"), F.desc(key))
    return numbered.select(F.col("place").cast("int").alias("place"), F.col(key).alias("key"), "count")


def share_feed(table: DataFrame, key: str) -> DataFrame:
    """Counts of a distribution with their share of all of them."""
    total = table.agg(F.sum("count")).scalar()
    return table.select(F.col(key).alias("key"), "count", (F.col("count") / total).alias("share"))


def trend_feed(sampled: DataFrame) -> DataFrame:
    """Trend lines: one row per line (``all`` or a status class) and minute."""
    lines = sampled.withColumnRenamed("requests", "all")
    return lines.unpivot("minute", ["all", *TRENDED_FAMILIES], "line", "requests")


def anomaly_feed(points: DataFrame) -> DataFrame:
    """Lines of the detection chart: errors, baseline and threshold per minute."""
    values = points.select("minute", F.col("errors").cast("double").alias("errors"), "baseline", "threshold")
    return values.unpivot("minute", ["errors", "baseline", "threshold"], "line", "value")


def chart_feeds(report: Report) -> dict[str, DataFrame]:
    """All chart tables by name, minutes as text."""
    feeds = {
        "top_ips": bar_feed(report.top_ips, "ip"),
        "top_endpoints": bar_feed(report.top_endpoints, "endpoint"),
        "top_error_endpoints": bar_feed(report.top_error_endpoints, "endpoint"),
        "status_share": share_feed(report.status_codes, "status"),
    }
    series = {
        "trend_lines": trend_feed(report.plot_trend()),
        "anomaly_lines": anomaly_feed(report.plot_anomalies()),
        "anomaly_marks": report.anomaly_overlay,
        "first_anomalies": report.first_anomalies,
    }
    return feeds | {name: feed.withColumn("minute", iso_minute(F.col("minute"))) for name, feed in series.items()}


def write_charts(report: Report, output_dir: str) -> None:
    for name, feed in chart_feeds(report).items():
        feed.write.mode("overwrite").json(f"{output_dir.rstrip('/')}/{name}")
