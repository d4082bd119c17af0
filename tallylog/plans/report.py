"""The whole report: one pass over the lines, then small tables, then files."""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from time import perf_counter

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tallylog.functions.buckets import iso_minute, minute_number
from tallylog.functions.parsing import parse_access_logs
from tallylog.operators.counts import (
    build_rollup,
    load_rollup,
    rollup_counts,
    rollup_minutes,
    rollup_totals,
    save_parts,
    save_rollup,
)
from tallylog.operators.detection import DEFAULT_SIGMA, DEFAULT_WINDOW, Detection, detect_anomalies
from tallylog.operators.sampling import (
    PLOT_POINTS,
    SERIES_POINTS,
    first_page,
    sample_evenly,
)
from tallylog.operators.spine import family_trends, sparse_trend
from tallylog.operators.topk import DISTRIBUTION_ROWS, top_n
from tallylog.session import cut_lineage, shared_path, use_utc
from tallylog.sources.files import read_lines, source_files

DEFAULT_TOP_N = 10
WRITES_AT_A_TIME = 4
# Tables with more rows than this are not repeated as lists in the summary.
SUMMARY_ROWS = 1000
# All a rollup needs; the other fields are not even cut out of the line.
ROLLUP_FIELDS = ["ip", "timestamp_utc", "method", "endpoint", "status", "response_bytes", "response_time_ms"]


@dataclass(frozen=True)
class Report:
    """The result tables with unrounded numbers; files get the rounded ones."""

    config: dict
    rollup: DataFrame
    metrics: DataFrame
    top_ips: DataFrame
    top_endpoints: DataFrame
    top_error_endpoints: DataFrame
    status_codes: DataFrame
    methods: DataFrame
    trend: DataFrame
    detection: Detection
    inputs: Sequence[str] | str | None = None
    duration_seconds: float | None = None

    @property
    def family_trends(self) -> DataFrame:
        return family_trends(self.trend)

    @property
    def anomaly_series(self) -> DataFrame:
        return self.detection.sampled()

    def plot_trend(self, max_points: int = PLOT_POINTS) -> DataFrame:
        """The trend and all its status classes at one shared set of minutes."""
        numbered = self.trend.withColumn("number", minute_number(F.col("minute")))
        return sample_evenly(numbered, "number", self.trend.count(), max_points).drop("number")

    def plot_anomalies(self, max_points: int = PLOT_POINTS, series_points: int = SERIES_POINTS) -> DataFrame:
        points = cut_lineage(self.detection.sampled(series_points))
        return sample_evenly(points, "i", points.count(), max_points, keep="is_anomaly")

    @property
    def anomaly_overlay(self) -> DataFrame:
        return self.plot_anomalies().filter("is_anomaly").select("minute", "errors")

    @property
    def first_anomalies(self) -> DataFrame:
        return first_page(self.detection.anomalies)


def report_from_rollup(
    rollup: DataFrame,
    top: int = DEFAULT_TOP_N,
    window: int = DEFAULT_WINDOW,
    sigma: float = DEFAULT_SIGMA,
    inputs: Sequence[str] | str | None = None,
    duration_seconds: float | None = None,
) -> Report:
    """All result tables from a stored rollup; the log lines are not touched again."""
    use_utc(rollup.sparkSession)
    if top < 0:
        raise ValueError(f"top_n must not be negative: {top}")
    minutes = cut_lineage(rollup_minutes(rollup))

    def first(key: str, rows: int, errors_only: bool = False) -> DataFrame:
        # Stored, since the tables and the summary both read it; the order is made anew.
        stored = cut_lineage(top_n(rollup_counts(rollup, key, errors_only), key, rows))
        return top_n(stored, key, rows)

    # The detection is a chain of small jobs; the tables don't depend on it and are stored meanwhile.
    with ThreadPoolExecutor(WRITES_AT_A_TIME) as pool:
        detecting = pool.submit(detect_anomalies, minutes, window, sigma)
        top_ips = pool.submit(first, "ip", top)
        top_endpoints = pool.submit(first, "endpoint", top)
        top_error_endpoints = pool.submit(first, "endpoint", top, errors_only=True)
        detection = detecting.result()
        trend = cut_lineage(sparse_trend(minutes, detection.span))
    return Report(
        config={"top_n": top, "anomaly_window": window, "anomaly_sigma": float(sigma)},
        rollup=rollup,
        metrics=rollup_totals(rollup),
        top_ips=top_ips.result(),
        top_endpoints=top_endpoints.result(),
        top_error_endpoints=top_error_endpoints.result(),
        status_codes=top_n(rollup_counts(rollup, "status"), "status", DISTRIBUTION_ROWS),
        methods=top_n(rollup_counts(rollup, "method"), "method", DISTRIBUTION_ROWS),
        trend=trend,
        detection=detection,
        inputs=inputs,
        duration_seconds=duration_seconds,
    )


def rollup_lines(lines: DataFrame, path: str | None = None, part: str | None = None) -> DataFrame:
    """Parses and counts the lines once and stores the rollup, in the shared folder by default.

    With ``part``, the name of these lines such as a day, they replace that part of the rollup at ``path``; the result has all its parts.
    """
    use_utc(lines.sparkSession)
    path = path or shared_path(lines.sparkSession, "rollup")
    rollup = build_rollup(parse_access_logs(lines, ROLLUP_FIELDS))
    if part is None:
        save_rollup(rollup, path)
    else:
        save_parts(rollup.withColumn("part", F.lit(part)), path, "part", [part])
    return load_rollup(lines.sparkSession, path)


def analyze(
    spark: SparkSession,
    inputs: str | Sequence[str],
    top: int = DEFAULT_TOP_N,
    window: int = DEFAULT_WINDOW,
    sigma: float = DEFAULT_SIGMA,
    rollup_path: str | None = None,
    part: str | None = None,
) -> Report:
    """The report over log files, directories and globs.

    With ``part`` and a ``rollup_path``, the files are one part of a growing rollup, and the report is over all of its parts.
    ``duration_seconds`` covers reading, parsing and counting, not the small tables.
    """
    start = perf_counter()
    rollup = rollup_lines(read_lines(spark, inputs), rollup_path, part)
    return report_from_rollup(rollup, top, window, sigma, inputs, perf_counter() - start)


def anomaly_rows(anomalies: DataFrame) -> DataFrame:
    return anomalies.select(
        iso_minute(F.col("minute")).alias("timestamp"),
        F.col("errors").alias("error_count"),
        F.round("baseline", 2).alias("savgol_baseline"),
        F.round("residual", 2).alias("residual"),
        F.round("score", 2).alias("residual_score"),
        F.round("threshold", 2).alias("threshold"),
    )


def series_rows(points: DataFrame) -> DataFrame:
    return points.select(
        iso_minute(F.col("minute")).alias("timestamp"),
        F.col("errors").alias("error_count"),
        F.round("baseline", 2).alias("savgol_baseline"),
        F.round("threshold", 2).alias("threshold"),
        "is_anomaly",
    )


def trend_rows(trend: DataFrame) -> DataFrame:
    return trend.select(iso_minute(F.col("minute")).alias("hour"), "requests")


def metrics_rows(metrics: DataFrame) -> DataFrame:
    return metrics.select(
        "processed_lines",
        "valid_lines",
        "invalid_lines",
        F.round("valid_ratio", 4).alias("valid_ratio"),
        F.round("average_response_time_ms", 2).alias("average_response_time_ms"),
        F.round("average_response_bytes", 2).alias("average_response_bytes"),
    )


def run_rows(runs: DataFrame) -> DataFrame:
    return runs.select(
        "workers",
        F.round("duration_seconds", 4).alias("duration_seconds"),
        "processed_lines",
        F.round("speedup_vs_first_run", 4).alias("speedup_vs_first_run"),
    )


def _ranked(table: DataFrame, key: str, rows: int = DISTRIBUTION_ROWS) -> Column:
    """A top-N table as one array in its order; null if it may have too many ``rows`` for a list."""
    if rows > SUMMARY_ROWS:
        return F.lit(None).cast("array<struct<key: string, count: bigint>>")
    item = F.struct((-F.col("count")).alias("rank"), F.col(key).alias("key"), "count")
    rows = table.agg(F.sort_array(F.collect_list(item)).alias("rows"))
    return rows.select(F.expr("transform(rows, row -> struct(row.key, row.count))")).scalar()


def summary_row(report: Report, rows: dict[str, int]) -> DataFrame:
    """The report as one nested row: configuration, metrics, short tables, detection, and the other datasets.

    Trends, anomalies and series grow with the logs' time range, and top tables with what was asked for, so they are
    datasets of their own, which ``datasets`` names with their number of ``rows``. Tables of at most ``SUMMARY_ROWS`` rows are lists here, too.
    """
    top = report.config["top_n"]
    datasets = [F.struct(F.lit(name).alias("name"), F.lit(n).cast("bigint").alias("rows")) for name, n in sorted(rows.items())]
    duration = F.round(F.lit(report.duration_seconds).cast("double"), 4).alias("duration_seconds")
    meta = report.detection.meta.withColumn("residual_scale", F.round("residual_scale", 4))
    return metrics_rows(report.metrics).select(
        F.current_timestamp().alias("generated_at_utc"),
        F.struct(*[F.lit(value).alias(name) for name, value in report.config.items()]).alias("config"),
        F.struct(duration, "*").alias("metrics"),
        F.struct(
            _ranked(report.top_ips, "ip", top).alias("top_ips"),
            _ranked(report.top_endpoints, "endpoint", top).alias("top_endpoints"),
            _ranked(report.top_error_endpoints, "endpoint", top).alias("top_error_endpoints"),
            _ranked(report.status_codes, "status").alias("status_codes"),
            _ranked(report.methods, "method").alias("methods"),
        ).alias("aggregations"),
        meta.select(F.struct("*").alias("meta")).scalar().alias("anomaly_detection"),
        F.array(*datasets).cast("array<struct<name: string, rows: bigint>>").alias("datasets"),
    )


def report_tables(report: Report, runs: DataFrame | None = None) -> dict[str, DataFrame]:
    """The CSV tables by name."""
    tables = {
        "top_ips": report.top_ips,
        "top_endpoints": report.top_endpoints,
        "top_error_endpoints": report.top_error_endpoints,
        "status_codes": report.status_codes.withColumnRenamed("status", "status_code"),
        "methods": report.methods,
        "hourly_trends": trend_rows(report.trend.orderBy("minute")),
        "anomalies": anomaly_rows(report.detection.anomalies.orderBy("minute")),
    }
    if runs is not None:
        tables["benchmark"] = run_rows(runs.orderBy("pos"))
    return tables


def json_parts(report: Report) -> dict[str, DataFrame]:
    """The JSON datasets by name, but for the summary, which is written last."""
    parts = {
        "status_family_trends": report.family_trends.orderBy("family", "minute").select(
            "family", iso_minute(F.col("minute")).alias("hour"), "requests"
        ),
        "anomaly_series": series_rows(report.anomaly_series.orderBy("minute")),
    }
    if report.inputs is not None:
        files = source_files(report.rollup.sparkSession, report.inputs)
        parts["input_files"] = files.select("position", "path").orderBy("position", "path")
    return parts


def write_report(report: Report, output_dir: str, runs: DataFrame | None = None) -> None:
    """Writes the CSV tables and the JSON datasets, each into a folder below ``output_dir``.

    The tables are small and independent, so a few are written at a time. Their rows are counted while they are
    written, for the summary, which comes last: where it is, everything that it names is.
    """
    base = output_dir.rstrip("/")

    def written(name: str, table: DataFrame, kind: str) -> tuple[str, int]:
        counted = Observation(f"rows-{name}")
        writer = table.observe(counted, F.count(F.lit(1)).alias("rows")).write.mode("overwrite")
        path = f"{base}/{name}"
        writer.option("header", "true").csv(path) if kind == "csv" else writer.json(path)
        # A table that Spark knows to be empty is not run, and so not counted.
        return name, counted.get.get("rows", 0)

    jobs = [(name, table, "csv") for name, table in report_tables(report, runs).items()]
    jobs += [(name, part, "json") for name, part in json_parts(report).items()]
    with ThreadPoolExecutor(WRITES_AT_A_TIME) as pool:
        rows = dict(pool.map(lambda job: written(*job), jobs))
    summary_row(report, rows).write.mode("overwrite").json(f"{base}/summary")
