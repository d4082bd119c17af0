"""The registered queries: every operator over the lines of a whole ``events`` table."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallylog.functions.buckets import (
    iso_minute,
    iso_number,
    minute_bucket,
    minute_number,
    status_family,
)
from tallylog.functions.parsing import (
    FIELDS,
    is_blank,
    parse_access_logs,
    strip_line,
    valid_records,
)
from tallylog.operators import counts, detection, robust, runs, sampling, smoothing, spine, topk
from tallylog.plans import charts, report
from tallylog.plans.event_logs import event_lines
from tallylog.session import cut_lineage, shared_path, use_utc
from tallylog.sources.files import read_lines, source_files
from tallylog.sources.synthetic import synthesize_lines

Query = Callable[[SparkSession, str], DataFrame]

# Parameters of the registered queries that differ from the defaults, so that the
# rule in question has an effect at the small scales too.
REQUESTED_WINDOWS = [1, 5, 6, 31, 99_999]
WIDE_WINDOW = 31
SAMPLE_POINTS = 300
LOW_SIGMA = 0.5


def _parsed(spark, sf_dir, fields=tuple(FIELDS)) -> DataFrame:
    return parse_access_logs(event_lines(spark, sf_dir), fields)


def _records(spark, sf_dir, fields) -> DataFrame:
    return valid_records(_parsed(spark, sf_dir, fields))


def _minutes(spark, sf_dir) -> DataFrame:
    records = _records(spark, sf_dir, ["timestamp_utc", "status"])
    return cut_lineage(counts.minute_table(records))


def _iso(df: DataFrame, column: str = "minute") -> DataFrame:
    return df.withColumn(column, iso_minute(F.col(column)))


# Sources


def _written_lines(spark, sf_dir) -> str:
    """The derived lines as text files in four folders below a fresh shared path."""
    path = shared_path(spark, "lines")
    lines = event_lines(spark, sf_dir)
    lines.select("value", (F.col("event_id") % 4).alias("shard")).write.partitionBy("shard").text(path)
    return path


def source_file_sizes(spark, sf_dir):
    path = _written_lines(spark, sf_dir)
    # Three ways to name the files, some of them twice, and a glob that matches none.
    inputs = [f"{path}/shard=1", f"{path}/none-*.log", f"{path}/shard=[123]/*.txt", path]
    shard = F.regexp_extract("path", r"shard=(\d+)", 1).cast("bigint")
    return source_files(spark, inputs).groupBy(shard.alias("shard"), "position").agg(F.sum("bytes").alias("bytes"))


def raw_line_count(spark, sf_dir):
    path = _written_lines(spark, sf_dir)
    return read_lines(spark, [path, f"{path}/shard=0"]).agg(
        F.count(F.lit(1)).alias("lines"), F.count_if(is_blank(F.col("value"))).alias("blank_lines")
    )


def synth_access_logs(spark, sf_dir):
    events = use_utc(spark).read.parquet(f"{sf_dir}/events.parquet")
    return synthesize_lines(events.select(F.col("event_id").alias("id")))


# Parsing


def reject_blank(spark, sf_dir):
    lines = event_lines(spark, sf_dir)
    return lines.select("event_id", strip_line(F.col("value")).alias("line")).filter(~is_blank(F.col("line")))


def parse_lines(spark, sf_dir):
    return _iso(_parsed(spark, sf_dir), "timestamp_utc").drop("is_valid")


def parse_timestamps(spark, sf_dir):
    records = _records(spark, sf_dir, ["timestamp_utc"])
    return records.select("event_id", F.unix_seconds("timestamp_utc").alias("epoch_seconds"))


def valid_methods(spark, sf_dir):
    return _records(spark, sf_dir, ["method"]).select("event_id", "method")


def valid_endpoints(spark, sf_dir):
    return _records(spark, sf_dir, ["endpoint"]).select("event_id", "endpoint")


def typed_fields(spark, sf_dir):
    fields = ["status", "response_bytes", "response_time_ms"]
    return _records(spark, sf_dir, fields).select("event_id", *fields)


def bytes_dash_to_zero(spark, sf_dir):
    records = _records(spark, sf_dir, ["response_bytes"])
    return records.agg(
        F.count_if(F.col("response_bytes") == 0).alias("empty_responses"),
        F.count_if(F.col("response_bytes") > 0).alias("sized_responses"),
    )


def valid_ranges(spark, sf_dir):
    parsed = _parsed(spark, sf_dir, ["status"])
    return parsed.filter(F.col("is_valid") | (F.col("reject_reason") == "range")).select(
        "event_id", "status", "is_valid"
    )


def dash_to_empty(spark, sf_dir):
    fields = ["remote_log_name", "user_id", "referrer", "user_agent"]
    return _records(spark, sf_dir, fields).groupBy(*fields).agg(F.count(F.lit(1)).alias("count"))


def reject_reasons(spark, sf_dir):
    rejected = _parsed(spark, sf_dir, []).filter(~F.col("is_valid"))
    return counts.count_by(rejected, "reject_reason")


# Derived columns and counts


def minute_buckets(spark, sf_dir):
    records = _records(spark, sf_dir, ["timestamp_utc"])
    return records.select("event_id", iso_minute(minute_bucket(F.col("timestamp_utc"))).alias("minute"))


def status_families(spark, sf_dir):
    return counts.count_by(_records(spark, sf_dir, ["status"]), status_family(F.col("status")), "family")


def _bigint_sums(df: DataFrame) -> DataFrame:
    """Sums are wide decimals; these tables' fit BIGINT, the type of the SQL side."""
    return df.withColumns({name: F.col(name).cast("bigint") for name in counts.ROLLUP_SUMS})


def _total(spark, sf_dir, *columns):
    totals = counts.totals(_parsed(spark, sf_dir, counts.ROLLUP_SUMS))
    return _bigint_sums(totals).select(*columns)


def _count(spark, sf_dir, key):
    return counts.count_by(_records(spark, sf_dir, [key]), key)


def _error_endpoints(spark, sf_dir):
    return counts.count_errors_by_endpoint(_records(spark, sf_dir, ["endpoint", "status"]))


def requests_per_minute(spark, sf_dir):
    records = _records(spark, sf_dir, ["timestamp_utc"])
    return _iso(counts.count_by(records, minute_bucket(F.col("timestamp_utc")), "minute"))


def status_family_per_minute(spark, sf_dir):
    table = counts.minute_table(_records(spark, sf_dir, ["timestamp_utc", "status"]))
    return _iso(table).withColumnsRenamed({name: f"requests_{name}" for name in spine.COUNTS[1:]})


def error_5xx_per_minute(spark, sf_dir):
    return _iso(counts.server_errors_by_minute(_records(spark, sf_dir, ["timestamp_utc", "status"])))


def multi_key_rollup(spark, sf_dir):
    return _bigint_sums(counts.build_rollup(_parsed(spark, sf_dir, report.ROLLUP_FIELDS)))


def merge_rollups(spark, sf_dir):
    parsed = _parsed(spark, sf_dir, report.ROLLUP_FIELDS).withColumn("part", F.col("event_id") % 4)
    path = shared_path(spark, "rollup-parts")
    rollup = cut_lineage(counts.build_rollup(parsed, part="part"))
    counts.save_parts(rollup, path, "part")
    # Saved again, a part replaces itself.
    counts.save_parts(rollup.filter("part % 2 = 1"), path, "part", [1, 3])
    parts = [counts.load_rollup(spark, f"{path}/part={k}") for k in (2, 0, 3, 1)]
    return _bigint_sums(counts.merge_rollups(*parts))


def _top(spark, sf_dir, key, n=report.DEFAULT_TOP_N):
    return topk.top_n(_count(spark, sf_dir, key), key, n)


def top_error_endpoints(spark, sf_dir):
    return topk.top_n(_error_endpoints(spark, sf_dir), "endpoint", report.DEFAULT_TOP_N)


# Spines and trends


def trend_buckets(spark, sf_dir):
    return _iso(spine.sparse_trend(_minutes(spark, sf_dir)).select("minute"))


def request_trend(spark, sf_dir):
    return report.trend_rows(spine.sparse_trend(_minutes(spark, sf_dir)))


def status_family_trends(spark, sf_dir):
    return _iso(spine.family_trends(spine.sparse_trend(_minutes(spark, sf_dir))))


def minute_spine(spark, sf_dir):
    return _iso(spine.continuous_minutes(spark, spine.minute_span(_minutes(spark, sf_dir))))


def _series(spark, sf_dir) -> tuple[DataFrame, spine.Span]:
    minutes = _minutes(spark, sf_dir)
    span = spine.minute_span(minutes)
    return spine.error_series(minutes, span), span


def error_series_zero_filled(spark, sf_dir):
    series, span = _series(spark, sf_dir)
    return series.select("i", iso_number(F.col("i") + span.first).alias("minute"), "errors")


# Smoothing and detection


def savgol_window_params(spark, sf_dir):
    lengths = spine.span_row(_minutes(spark, sf_dir)).select("points")
    rows = [
        smoothing.with_params(lengths, requested).withColumn("requested", F.lit(requested).cast("bigint"))
        for requested in REQUESTED_WINDOWS
    ]
    return reduce(DataFrame.unionByName, rows)


def savgol_coefficients(spark, sf_dir):
    series, _ = _series(spark, sf_dir)
    return smoothing.savgol_coefficients(smoothing.savgol_params(series, WIDE_WINDOW))


def reflect_pad(spark, sf_dir):
    minutes = _minutes(spark, sf_dir)
    span, length, _ = detection.smoothing_frame(minutes, WIDE_WINDOW)
    return smoothing.reflect_pad(spine.error_series(minutes, span), span.points, length // 2, "errors")


def savgol_smooth(spark, sf_dir):
    minutes = _minutes(spark, sf_dir)
    span, length, order = detection.smoothing_frame(minutes, WIDE_WINDOW)
    return smoothing.savgol_smooth(spine.error_series(minutes, span), span.points, length, order, "errors")


def error_runs(spark, sf_dir):
    minutes = _minutes(spark, sf_dir)
    return spine.error_runs(minutes, spine.minute_span(minutes))


def error_baseline(spark, sf_dir):
    return _detect(spark, sf_dir).points.select("i", "errors", "baseline")


def error_residuals(spark, sf_dir):
    return _detect(spark, sf_dir).points.select("i", "errors", "baseline", "residual")


def _weighted_residuals(spark, sf_dir) -> DataFrame:
    minutes = _minutes(spark, sf_dir)
    span, length, order = detection.smoothing_frame(minutes, detection.DEFAULT_WINDOW)
    residuals = cut_lineage(detection.error_residuals(detection.error_baseline(minutes, span, length, order)))
    return detection.with_rest(residuals, span.points)


def residual_median(spark, sf_dir):
    residuals = _weighted_residuals(spark, sf_dir)
    median = robust.exact_median(residuals, F.col("residual"), F.col("weight"))
    return residuals.agg(F.sum("weight").alias("points")).withColumn("median", F.lit(median).cast("double"))


def residual_scale(spark, sf_dir):
    residuals = _weighted_residuals(spark, sf_dir)
    scale = robust.robust_scale(residuals, "residual", F.col("weight"))
    return residuals.agg(F.sum("weight").alias("points")).select(
        "points",
        # The standard deviation, used where the MAD is 0, may differ in its last bits.
        F.round(F.lit(scale), 9).alias("robust_scale"),
        F.round(F.lit(max(scale, detection.SCALE_FLOOR)), 9).alias("residual_scale"),
    )


def _detect(spark, sf_dir, sigma=detection.DEFAULT_SIGMA) -> detection.Detection:
    return detection.detect_anomalies(_minutes(spark, sf_dir), sigma=sigma)


def _detect_by_endpoint(spark, sf_dir) -> detection.KeyedDetection:
    records = _records(spark, sf_dir, ["timestamp_utc", "status", "endpoint"])
    return detection.detect_anomalies_by(cut_lineage(counts.minute_table(records, ["endpoint"])), ["endpoint"], sigma=LOW_SIGMA)


def endpoint_frames(spark, sf_dir):
    frames = _detect_by_endpoint(spark, sf_dir).frames
    return frames.select(
        "endpoint", iso_number(F.col("first")).alias("first_minute"), "points", "window_length", "polyorder", F.round("residual_scale", 9).alias("residual_scale")
    )


def endpoint_detection(spark, sf_dir):
    """Every minute with errors of every endpoint, judged within its endpoint."""
    judged = _detect_by_endpoint(spark, sf_dir).stretches.filter("errors > 0")
    # A scale that is a standard deviation may differ in its last bits.
    return _iso(judged).withColumns({name: F.round(name, 9) for name in ("score", "threshold")}).drop("i")


def anomaly_thresholds(spark, sf_dir):
    return _detect(spark, sf_dir).points.select("i", "errors", "threshold", "is_anomaly")


def anomalies(spark, sf_dir):
    return _iso(_detect(spark, sf_dir).anomalies)


def anomaly_detection_meta(spark, sf_dir):
    return _detect(spark, sf_dir).meta


# Sampling


def _sampled(spark, sf_dir) -> DataFrame:
    return _detect(spark, sf_dir).sampled(SAMPLE_POINTS)


def anomaly_series_sampled(spark, sf_dir):
    return _iso(_sampled(spark, sf_dir)).select("minute", "errors", "baseline", "threshold", "is_anomaly")


def _trend_sample(spark, sf_dir) -> DataFrame:
    trend = spine.sparse_trend(_minutes(spark, sf_dir)).withColumn("number", minute_number(F.col("minute")))
    return sampling.sample_evenly(trend, "number", trend.count(), SAMPLE_POINTS).drop("number")


def trend_sampled(spark, sf_dir):
    return _iso(_trend_sample(spark, sf_dir)).withColumnsRenamed(
        {name: f"requests_{name}" for name in spine.COUNTS[1:]}
    )


def _plot_points(spark, sf_dir) -> DataFrame:
    points = cut_lineage(_sampled(spark, sf_dir))
    return sampling.sample_evenly(points, "i", points.count(), SAMPLE_POINTS // 2, keep="is_anomaly")


def anomaly_plot_points(spark, sf_dir):
    return _iso(_plot_points(spark, sf_dir)).select("minute", "errors", "baseline", "threshold", "is_anomaly")


def anomaly_overlay(spark, sf_dir):
    return _iso(_plot_points(spark, sf_dir).filter("is_anomaly").select("minute", "errors"))


def anomalies_first_page(spark, sf_dir):
    return _iso(sampling.first_page(_detect(spark, sf_dir, LOW_SIGMA).anomalies))


# Chart tables


def chart_bars(spark, sf_dir):
    return charts.bar_feed(top_error_endpoints(spark, sf_dir), "endpoint")


def chart_status_share(spark, sf_dir):
    return charts.share_feed(_top(spark, sf_dir, "status", topk.DISTRIBUTION_ROWS), "status")


def chart_trend_lines(spark, sf_dir):
    return _iso(charts.trend_feed(_trend_sample(spark, sf_dir)))


def chart_anomaly_lines(spark, sf_dir):
    return _iso(charts.anomaly_feed(_plot_points(spark, sf_dir)))


# Runs and reports


def run_speedup(spark, sf_dir):
    orders = use_utc(spark).read.parquet(f"{sf_dir}/orders.parquet")
    return runs.run_speedup(
        orders.select(
            F.col("o_orderkey").alias("pos"),
            (F.col("o_custkey") % 16).alias("workers"),
            F.col("o_totalprice").alias("duration_seconds"),
            F.col("o_orderkey").alias("processed_lines"),
        )
    )


def report_metrics(spark, sf_dir):
    rollup = counts.build_rollup(_parsed(spark, sf_dir, report.ROLLUP_FIELDS))
    return _bigint_sums(counts.rollup_totals(rollup))


def _written_report(spark, sf_dir, runs: DataFrame | None = None) -> str:
    path = shared_path(spark, "report")
    rollup = report.rollup_lines(event_lines(spark, sf_dir))
    report.write_report(report.report_from_rollup(rollup), path, runs)
    return path


# The nested summary as it is written, without the time of the run.
SUMMARY_SCHEMA = """
    config STRUCT<top_n: BIGINT, anomaly_window: BIGINT, anomaly_sigma: DOUBLE>,
    metrics STRUCT<processed_lines: BIGINT, valid_lines: BIGINT, invalid_lines: BIGINT, valid_ratio: DOUBLE,
        average_response_time_ms: DOUBLE, average_response_bytes: DOUBLE>,
    aggregations STRUCT<top_ips: ARRAY<STRUCT<key: STRING, count: BIGINT>>,
        top_endpoints: ARRAY<STRUCT<key: STRING, count: BIGINT>>,
        top_error_endpoints: ARRAY<STRUCT<key: STRING, count: BIGINT>>,
        status_codes: ARRAY<STRUCT<key: STRING, count: BIGINT>>,
        methods: ARRAY<STRUCT<key: STRING, count: BIGINT>>>,
    anomaly_detection STRUCT<window_length: BIGINT, polyorder: BIGINT, sigma: DOUBLE, residual_scale: DOUBLE,
        min_error_count: BIGINT, points: BIGINT, anomalies: BIGINT>,
    datasets ARRAY<STRUCT<name: STRING, rows: BIGINT>>
"""


def report_summary(spark, sf_dir):
    """The written summary read back, one row per number in it."""
    path = _written_report(spark, sf_dir)
    summary = spark.read.schema(SUMMARY_SCHEMA).json(f"{path}/summary")
    numbers = [
        F.struct(
            F.lit(part.name).alias("section"),
            F.lit(0).alias("place"),
            F.lit(field.name).alias("key"),
            F.col(f"{part.name}.{field.name}").cast("double").alias("value"),
        )
        for part in summary.schema.fields
        if part.name not in ("aggregations", "datasets")
        for field in part.dataType.fields
    ]
    scalars = summary.select(F.inline(F.array(*numbers)))
    lists = [
        summary.select(
            F.lit(field.name).alias("section"), F.posexplode(f"aggregations.{field.name}").alias("place", "item")
        ).select("section", (F.col("place") + 1).alias("place"), "item.key", F.col("item.count").cast("double").alias("value"))
        for field in summary.schema["aggregations"].dataType.fields
    ]
    datasets = summary.select(F.explode("datasets").alias("d")).select(
        F.lit("datasets").alias("section"), F.lit(0).alias("place"), F.col("d.name").alias("key"), F.col("d.rows").cast("double").alias("value")
    )
    return reduce(DataFrame.unionByName, [*lists, datasets], scalars)


def report_csv_tables(spark, sf_dir):
    """The written CSV tables read back: name, key, count, and the other numbers of those that have some."""
    path = _written_report(spark, sf_dir, run_speedup(spark, sf_dir))
    names = ["top_ips", "top_endpoints", "top_error_endpoints", "status_codes", "methods", "hourly_trends", "anomalies", "benchmark"]
    numbers = ["duration_seconds", "speedup_vs_first_run", "savgol_baseline", "residual", "residual_score", "threshold"]
    tables = []
    for name in names:
        table = spark.read.option("header", "true").csv(f"{path}/{name}")
        key, count = (table.columns[0], "processed_lines") if name == "benchmark" else table.columns[:2]
        others = [(F.col(c) if c in table.columns else F.lit(None)).cast("double").alias(c) for c in numbers]
        tables.append(table.select(F.lit(name).alias("table"), F.col(key).alias("key"), F.col(count).cast("bigint").alias("count"), *others))
    return reduce(DataFrame.unionByName, tables)


QUERIES: dict[str, Query] = {
    "source_files": source_file_sizes,
    "raw_line_count": raw_line_count,
    "synth_access_logs": synth_access_logs,
    "reject_blank": reject_blank,
    "parse_access_logs": parse_lines,
    "parse_timestamps": parse_timestamps,
    "valid_methods": valid_methods,
    "valid_endpoints": valid_endpoints,
    "typed_fields": typed_fields,
    "bytes_dash_to_zero": bytes_dash_to_zero,
    "valid_ranges": valid_ranges,
    "dash_to_empty": dash_to_empty,
    "protocol_counts": partial(_count, key="protocol"),
    "reject_reasons": reject_reasons,
    "minute_bucket": minute_buckets,
    "status_family": status_families,
    "line_counts": lambda s, d: _total(s, d, "processed_lines", "valid_lines", "invalid_lines"),
    "traffic_totals": lambda s, d: _total(s, d, "response_bytes", "response_time_ms"),
    "traffic_averages": lambda s, d: _total(s, d, "average_response_time_ms", "average_response_bytes"),
    "valid_ratio": lambda s, d: _total(s, d, "valid_ratio"),
    "method_counts": partial(_count, key="method"),
    "status_code_counts": partial(_count, key="status"),
    "endpoint_counts": partial(_count, key="endpoint"),
    "ip_counts": partial(_count, key="ip"),
    "error_endpoint_counts": _error_endpoints,
    "requests_per_minute": requests_per_minute,
    "status_family_per_minute": status_family_per_minute,
    "error_5xx_per_minute": error_5xx_per_minute,
    "merge_rollups": merge_rollups,
    "multi_key_rollup": multi_key_rollup,
    "top_ips": partial(_top, key="ip"),
    "top_endpoints": partial(_top, key="endpoint"),
    "top_error_endpoints": top_error_endpoints,
    "status_codes": partial(_top, key="status", n=topk.DISTRIBUTION_ROWS),
    "methods": partial(_top, key="method", n=topk.DISTRIBUTION_ROWS),
    "trend_buckets": trend_buckets,
    "request_trend": request_trend,
    "status_family_trends": status_family_trends,
    "minute_spine": minute_spine,
    "error_series_zero_filled": error_series_zero_filled,
    "savgol_window_params": savgol_window_params,
    "savgol_coefficients": savgol_coefficients,
    "reflect_pad": reflect_pad,
    "savgol_smooth": savgol_smooth,
    "error_runs": error_runs,
    "error_baseline": error_baseline,
    "error_residuals": error_residuals,
    "residual_median": residual_median,
    "residual_scale": residual_scale,
    "endpoint_frames": endpoint_frames,
    "endpoint_detection": endpoint_detection,
    "anomaly_thresholds": anomaly_thresholds,
    "anomalies": anomalies,
    "anomaly_detection_meta": anomaly_detection_meta,
    "anomaly_series_sampled": anomaly_series_sampled,
    "trend_sampled": trend_sampled,
    "anomaly_plot_points": anomaly_plot_points,
    "anomaly_overlay": anomaly_overlay,
    "anomalies_first_page": anomalies_first_page,
    "chart_bars": chart_bars,
    "chart_status_share": chart_status_share,
    "chart_trend_lines": chart_trend_lines,
    "chart_anomaly_lines": chart_anomaly_lines,
    "run_speedup": run_speedup,
    "report_metrics": report_metrics,
    "report_summary": report_summary,
    "report_csv_tables": report_csv_tables,
}
