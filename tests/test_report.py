from __future__ import annotations

import csv
import datetime as dt
import itertools
import json
import pathlib

import pytest
from pyspark.sql import functions as F

from tallylog import analyze, read_lines, write_report
from tallylog.functions.parsing import parse_access_logs, valid_records
from tallylog.operators import counts
from tallylog.operators.runs import run_speedup
from tallylog.operators.spine import sparse_trend
from tallylog.operators.topk import top_n
from tallylog.plans import report as reports
from tallylog.plans.charts import write_charts
from tallylog.session import shared_dir
from tallylog.sources.files import source_files
from tallylog.sources.synthetic import synthesize_lines
from tests.sample_log import GOLDEN_LINES


def read_csv(folder: pathlib.Path) -> list[list[str]]:
    """Header and rows of a written table, in the order of its part files."""
    parts = [list(csv.reader(path.open())) for path in sorted(folder.glob("part-*.csv"))]
    return parts[0][:1] + [row for part in parts for row in part[1:]]


def read_json(folder: pathlib.Path) -> list[dict]:
    return [json.loads(text) for path in sorted(folder.glob("part-*.json")) for text in path.read_text().splitlines()]


@pytest.fixture(scope="module")
def golden(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("golden")
    (folder / "sample.log").write_text("\n".join(GOLDEN_LINES) + "\n")
    report = analyze(spark, str(folder / "sample.log"))
    runs = spark.createDataFrame(
        [(1, 1, 0.0146, 6), (2, 2, 0.0129, 6)],
        "pos BIGINT, workers INT, duration_seconds DOUBLE, processed_lines BIGINT",
    )
    write_report(report, str(folder / "out"), run_speedup(runs).orderBy("workers"))
    return folder / "out"


def test_golden_tables(golden):
    assert read_csv(golden / "top_ips") == [["ip", "count"], ["10.0.0.1", "2"], ["10.0.0.2", "2"], ["10.0.0.3", "1"]]
    assert read_csv(golden / "top_endpoints") == [
        ["endpoint", "count"], ["/usr/register", "2"], ["/usr/admin", "1"], ["/usr/admin/developer", "1"], ["/usr/login", "1"],
    ]
    assert read_csv(golden / "top_error_endpoints") == [["endpoint", "count"], ["/usr/register", "2"], ["/usr/admin", "1"]]
    assert read_csv(golden / "status_codes") == [["status_code", "count"], ["200", "2"], ["404", "1"], ["500", "1"], ["502", "1"]]
    assert read_csv(golden / "methods") == [["method", "count"], ["GET", "2"], ["POST", "2"], ["DELETE", "1"]]
    day = "2020-01-01T"
    assert read_csv(golden / "hourly_trends") == [
        ["hour", "requests"], [f"{day}10:00:00+00:00", "2"], [f"{day}10:01:00+00:00", "1"], [f"{day}10:02:00+00:00", "1"],
        [f"{day}10:03:00+00:00", "0"], [f"{day}10:59:00+00:00", "0"], [f"{day}11:00:00+00:00", "1"],
    ]
    assert read_csv(golden / "benchmark") == [
        ["workers", "duration_seconds", "processed_lines", "speedup_vs_first_run"],
        ["1", "0.0146", "6", "1.0"], ["2", "0.0129", "6", "1.1318"],
    ]


def test_empty_table_keeps_its_header(golden):
    assert read_csv(golden / "anomalies") == [
        ["timestamp", "error_count", "savgol_baseline", "residual", "residual_score", "threshold"]
    ]


def test_golden_summary(golden):
    (summary,) = read_json(golden / "summary")
    assert summary["config"] == {"top_n": 10, "anomaly_window": 5, "anomaly_sigma": 2.0}
    assert summary["metrics"].pop("duration_seconds") > 0
    assert summary["metrics"] == {
        "processed_lines": 6, "valid_lines": 5, "invalid_lines": 1, "valid_ratio": 0.8333,
        "average_response_time_ms": 224.0, "average_response_bytes": 940.0,
    }
    assert summary["aggregations"]["methods"] == [
        {"key": "GET", "count": 2}, {"key": "POST", "count": 2}, {"key": "DELETE", "count": 1}
    ]
    assert [item["key"] for item in summary["aggregations"]["status_codes"]] == ["200", "404", "500", "502"]
    assert summary["anomaly_detection"] == {
        "method": "Savitzky-Golay", "metric": "5xx errors per minute", "window_length": 5, "polyorder": 2,
        "sigma": 2.0, "residual_scale": 1.0, "min_error_count": 3, "points": 61, "anomalies": 0,
    }


def test_golden_summary_names_its_datasets(golden):
    (summary,) = read_json(golden / "summary")
    rows = {item["name"]: item["rows"] for item in summary["datasets"]}
    assert rows == {
        "anomalies": 0, "anomaly_series": 61, "benchmark": 2, "hourly_trends": 6, "input_files": 1, "methods": 3,
        "status_codes": 4, "status_family_trends": 24, "top_endpoints": 4, "top_error_endpoints": 2, "top_ips": 3,
    }
    for name, n in rows.items():
        folder = golden / name
        found = read_csv(folder)[1:] if list(folder.glob("part-*.csv")) else read_json(folder)
        assert len(found) == n


def test_long_top_tables_are_datasets_only(spark, tmp_path):
    lines = spark.createDataFrame([(text,) for text in GOLDEN_LINES], "value STRING")
    rollup = counts.build_rollup(parse_access_logs(lines, reports.ROLLUP_FIELDS))
    write_report(reports.report_from_rollup(rollup, top=reports.SUMMARY_ROWS + 1), str(tmp_path))
    (summary,) = read_json(tmp_path / "summary")
    assert "top_ips" not in summary["aggregations"] and len(summary["aggregations"]["methods"]) == 3
    assert {"name": "top_ips", "rows": 3} in summary["datasets"] and len(read_csv(tmp_path / "top_ips")) == 4


def test_golden_series_and_families(golden):
    series = read_json(golden / "anomaly_series")
    assert len(series) == 61
    assert [row["error_count"] for row in series[:4]] == [1, 1, 0, 0]
    assert [row["savgol_baseline"] for row in series[:5]] == [1.17, 0.74, 0.26, 0.0, 0.0]
    assert [row["threshold"] for row in series[:3]] == [3.17, 3.0, 3.0]
    assert not any(row["is_anomaly"] for row in series)
    families = read_json(golden / "status_family_trends")
    assert [row["family"] for row in families] == sorted(["2xx", "3xx", "4xx", "5xx"] * 6)
    busy = {(row["family"], row["hour"][11:16]) for row in families if row["requests"]}
    assert busy == {("2xx", "10:00"), ("2xx", "11:00"), ("5xx", "10:00"), ("5xx", "10:01"), ("4xx", "10:02")}
    assert [pathlib.Path(row["path"]).name for row in read_json(golden / "input_files")] == ["sample.log"]


def lines_frame(spark, n=400):
    return synthesize_lines(spark.range(n)).select("id", "value").union(
        spark.range(20).select("id", F.lit("broken").alias("value"))
    )


def rows(frame):
    return sorted(map(tuple, frame.collect()), key=repr)


def test_rollup_tables_equal_direct_counts(spark):
    parsed = parse_access_logs(lines_frame(spark)).cache()
    records, rollup = valid_records(parsed), counts.build_rollup(parsed)
    assert rows(counts.rollup_totals(rollup)) == rows(counts.totals(parsed))
    for key in ("method", "status", "endpoint", "ip"):
        assert rows(counts.rollup_counts(rollup, key)) == rows(counts.count_by(records, key))
    errors = counts.rollup_counts(rollup, "endpoint", errors_only=True)
    assert rows(errors) == rows(counts.count_errors_by_endpoint(records))
    assert rows(counts.rollup_minutes(rollup)) == rows(counts.minute_table(records))
    family_sum = counts.minute_table(records).select((F.col("5xx") * 1).alias("n")).agg(F.sum("n")).first()[0]
    assert counts.server_errors_by_minute(records).agg(F.sum("count")).first()[0] == family_sum
    trend = sparse_trend(counts.minute_table(records))
    assert trend.agg(F.sum("requests")).first()[0] == records.count()
    parsed.unpersist()


def test_merging_parts_in_any_order_gives_the_whole(spark, tmp_path):
    parsed = parse_access_logs(lines_frame(spark), reports.ROLLUP_FIELDS)
    whole = rows(counts.build_rollup(parsed))
    for k in range(3):
        counts.save_rollup(counts.build_rollup(parsed.filter(F.col("id") % 3 == k)), str(tmp_path / f"{k}"))
    for order in itertools.permutations(range(3)):
        parts = [counts.load_rollup(spark, str(tmp_path / f"{k}")) for k in order]
        assert rows(counts.merge_rollups(*parts)) == whole
    first_two = counts.merge_rollups(*[counts.load_rollup(spark, str(tmp_path / f"{k}")) for k in (0, 1)])
    assert rows(counts.merge_rollups(first_two, counts.load_rollup(spark, str(tmp_path / "2")))) == whole
    by_part = counts.build_rollup(parsed.withColumn("part", F.col("id") % 3), part="part").drop("part")
    assert rows(counts.merge_rollups(by_part)) == whole


def test_partition_count_does_not_matter(spark):
    parsed = [parse_access_logs(lines_frame(spark).repartition(n), reports.ROLLUP_FIELDS) for n in (1, 7)]
    assert rows(counts.build_rollup(parsed[0])) == rows(counts.build_rollup(parsed[1]))


def test_one_key_with_most_lines(spark):
    lines = spark.range(3000).select(F.lit(GOLDEN_LINES[0]).alias("value")).union(
        spark.createDataFrame([(text,) for text in GOLDEN_LINES], "value STRING")
    )
    rollup = counts.build_rollup(parse_access_logs(lines, reports.ROLLUP_FIELDS))
    top = top_n(counts.rollup_counts(rollup, "ip"), "ip", 1).first()
    assert (top["ip"], top["count"]) == ("10.0.0.1", 3002)


def test_sums_beyond_64_bits(spark):
    largest = 2**63 - 1
    huge = GOLDEN_LINES[0].replace(" 1200 ", f" {largest} ")
    parsed = parse_access_logs(spark.createDataFrame([(huge,)] * 5, "value STRING"), reports.ROLLUP_FIELDS)
    rollup = counts.build_rollup(parsed)
    for frame in (counts.totals(parsed), counts.rollup_totals(counts.merge_rollups(rollup, rollup))):
        row = frame.first()
        assert row["response_bytes"] == largest * row["valid_lines"]
        assert row["average_response_bytes"] == float(largest)


def test_nothing_valid(spark):
    parsed = parse_access_logs(spark.createDataFrame([("x",), ("",)], "value STRING"), reports.ROLLUP_FIELDS)
    for frame in (counts.totals(parsed), counts.rollup_totals(counts.build_rollup(parsed))):
        row = frame.first()
        assert (row["processed_lines"], row["valid_lines"], row["invalid_lines"]) == (2, 0, 2)
        assert row["valid_ratio"] == row["average_response_bytes"] == row["average_response_time_ms"] == 0.0
    none = parsed.filter(F.lit(False))
    assert counts.totals(none).first()["valid_ratio"] == 0.0
    assert counts.rollup_totals(counts.build_rollup(none)).first()["processed_lines"] == 0


def test_top_n_order_and_limits(spark):
    frame = spark.createDataFrame([("b", 2), ("a", 2), ("c", 5), ("Z", 2)], "k STRING, count BIGINT")
    assert [r["k"] for r in top_n(frame, "k", 3).collect()] == ["c", "Z", "a"]
    assert len(top_n(frame, "k", 99).collect()) == 4
    assert top_n(frame, "k", 0).collect() == []
    with pytest.raises(ValueError):
        top_n(frame, "k", -1)
    numbers = spark.createDataFrame([(1000, 1), (200, 1), (30, 1)], "k INT, count BIGINT")
    assert [r["k"] for r in top_n(numbers, "k", 3).collect()] == ["1000", "200", "30"]


def test_run_speedup(spark):
    table = [(1, 0, 8.0, 5), (2, 2, 4.0, 5), (3, 1, 99.0, 5), (4, 4, 0.0, 5), (5, -3, 1.0, 5)]
    frame = spark.createDataFrame(table, "pos BIGINT, workers INT, duration_seconds DOUBLE, processed_lines BIGINT")
    found = {r["workers"]: (r["duration_seconds"], r["speedup_vs_first_run"]) for r in run_speedup(frame).collect()}
    assert found == {1: (8.0, 1.0), 2: (4.0, 2.0), 4: (0.0, 1.0)}


def test_reading_files_directories_and_globs(spark, tmp_path):
    for name, text in {"a.log": b"1\n\n2\r\n", "sub/b.log": b"3\r4", "sub/deep/c.txt": b"5 \xff\n"}.items():
        path = tmp_path / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(text)
    root = str(tmp_path)
    values = sorted(r["value"] for r in read_lines(spark, root).collect())
    assert values == ["", "1", "2", "3", "4", "5 �"]
    again = [root, f"{root}/a.log", f"{root}/*.log", f"{root}/sub", f"{root}/a.log", f"{root}/missing", f"{root}/no*"]
    assert read_lines(spark, again).count() == 6
    assert read_lines(spark, f"{root}/*.log").count() == 3
    names = [pathlib.Path(r["path"]).name for r in source_files(spark, again).orderBy("path").collect()]
    assert names == ["a.log", "b.log", "c.txt"]


def test_no_input_is_an_error(spark, tmp_path):
    (tmp_path / "empty").mkdir()
    for inputs in ([], str(tmp_path / "nothing"), [str(tmp_path / "no*"), str(tmp_path / "nothing")], str(tmp_path / "empty")):
        with pytest.raises(FileNotFoundError):
            read_lines(spark, inputs)


def test_synthetic_lines_are_valid_and_repeatable(spark):
    lines = synthesize_lines(spark.range(2000), seed=4)
    parsed = parse_access_logs(lines)
    assert counts.totals(parsed).first()["valid_ratio"] == 1.0
    assert rows(lines) == rows(synthesize_lines(spark.range(2000).repartition(5), seed=4))
    assert rows(lines) != rows(synthesize_lines(spark.range(2000), seed=5))
    stats = parsed.agg(
        F.avg("response_bytes").alias("mean"), F.stddev("response_bytes").alias("deviation"),
        F.countDistinct("method", "endpoint", "status").alias("mixes"), F.min("timestamp_utc").alias("first"),
        F.max("timestamp_utc").alias("last"), F.countDistinct("user_agent").alias("agents"),
    ).first()
    assert abs(stats["mean"] - 5000) < 5 and 45 < stats["deviation"] < 55
    assert stats["mixes"] == 4 * 5 * 7 and stats["agents"] == 10
    # Without AM/PM a time may be read up to 12 hours early.
    assert stats["first"] >= dt.datetime(2017, 12, 31, 18) and stats["last"] < dt.datetime(2020, 1, 1, 7)
    assert parsed.select("ip").distinct().count() > 1990


def test_chart_feeds(spark, tmp_path):
    lines = spark.createDataFrame([(text,) for text in GOLDEN_LINES], "value STRING")
    report = reports.report_from_rollup(counts.build_rollup(parse_access_logs(lines, reports.ROLLUP_FIELDS)))
    assert report.plot_trend(2).count() == 3
    assert report.plot_anomalies(10, 20).count() == 16  # every 4th of 61, then every 1st
    assert report.anomaly_overlay.count() == 0 and report.first_anomalies.count() == 0
    write_charts(report, str(tmp_path))
    bars = read_json(tmp_path / "top_endpoints")
    assert [row["key"] for row in sorted(bars, key=lambda row: row["place"])] == [
        "/usr/login", "/usr/admin/developer", "/usr/admin", "/usr/register"
    ]
    assert sum(row["share"] for row in read_json(tmp_path / "status_share")) == pytest.approx(1.0)
    assert len(read_json(tmp_path / "trend_lines")) == 5 * 6
    assert len(read_json(tmp_path / "anomaly_lines")) == 3 * 61
    assert read_json(tmp_path / "anomaly_marks") == []


class FakeSession:
    """Just the settings that choose the shared folder."""

    def __init__(self, configured=None):
        session = self
        self.used = None

        class Context:
            def getCheckpointDir(self):
                return session.used

            def setCheckpointDir(self, path):
                session.used = path

        class Conf:
            def get(self, name, default=None):
                return {"spark.checkpoint.dir": configured, "spark.sql.warehouse.dir": "hdfs:///warehouse/"}.get(name) or default

        self.sparkContext, self.conf = Context(), Conf()


def test_shared_folder():
    named = FakeSession("hdfs:///shared")
    assert shared_dir(named) == named.used == "hdfs:///shared"
    # Without the setting, a folder below the warehouse, on a cluster and elsewhere.
    plain = FakeSession()
    assert shared_dir(plain) == plain.used == "hdfs:///warehouse/tallylog-tables"
    assert shared_dir(plain) == plain.used


def test_rollups_of_parts_and_appended_ones_are_summed(spark, tmp_path):
    from tallylog.functions.parsing import parse_access_logs
    from tallylog.operators import counts
    from tallylog.operators.topk import top_n

    line = '10.0.0.{} - - [01/Jan/2020:00:00:00 +0000] "GET /x H" 500 5 "-" "UA" 7'
    lines = spark.createDataFrame([(line.format(k % 2), k % 3) for k in range(6)], "value STRING, part INT")
    parsed = parse_access_logs(lines)
    for path, part in (("whole", None), ("parts", "part")):
        for mode in ("error", "append"):
            counts.save_rollup(counts.build_rollup(parsed, part), str(tmp_path / path), mode)
        rollup = counts.load_rollup(spark, str(tmp_path / path))
        assert [tuple(r) for r in top_n(counts.rollup_counts(rollup, "ip"), "ip", 5).collect()] == [
            ("10.0.0.0", 6), ("10.0.0.1", 6)
        ]
        errors = counts.rollup_counts(rollup, "endpoint", errors_only=True)
        assert [tuple(r) for r in errors.collect()] == [("/x", 12)]


def test_saving_a_part_again_replaces_it(spark, tmp_path):
    path = str(tmp_path / "rollup")

    def save(day, texts):
        return reports.rollup_lines(spark.createDataFrame([(t,) for t in texts], "value STRING"), path, day)

    def top_ips():
        return [tuple(r) for r in top_n(counts.rollup_counts(counts.load_rollup(spark, path), "ip"), "ip", 5).collect()]

    save("2024-01-01", GOLDEN_LINES)
    once = top_ips()
    rollup = save("2024-01-02", GOLDEN_LINES[:1] * 3)
    both = top_ips()
    assert once == [("10.0.0.1", 2), ("10.0.0.2", 2), ("10.0.0.3", 1)] and both[0] == ("10.0.0.1", 5)
    for _ in range(2):
        rollup = save("2024-01-02", GOLDEN_LINES[:1] * 3)
        assert top_ips() == both
    whole = spark.createDataFrame([(t,) for t in GOLDEN_LINES + GOLDEN_LINES[:1] * 3], "value STRING")
    assert rows(counts.merge_rollups(rollup)) == rows(counts.build_rollup(parse_access_logs(whole, reports.ROLLUP_FIELDS)))
    # Fewer dimensions than before, then none at all.
    save("2024-01-02", ["broken", ""])
    assert top_ips() == once and counts.rollup_totals(counts.load_rollup(spark, path)).first()["invalid_lines"] == 3
    save("2024-01-02", [])
    assert counts.rollup_totals(counts.load_rollup(spark, path)).first()["processed_lines"] == 6
    minutes = counts.rollup_minutes(counts.load_rollup(spark, path))
    assert minutes.filter("minute IS NULL").count() == 0 and minutes.agg(F.sum("requests")).first()[0] == 5


@pytest.mark.parametrize("n", [0, 1, 7, 20_000])
def test_ranks_by_ranges(spark, n):
    from tallylog.operators.ranking import with_rank

    table = spark.range(n).select((F.col("id") * 7919 % 1000).alias("count"), F.col("id").cast("string").alias("key")).repartition(9)
    ranked = with_rank(table, F.asc("count"), F.desc("key"))
    expected = sorted(map(tuple, table.collect()), key=lambda r: r[1], reverse=True)
    expected = [(place, *r) for place, r in enumerate(sorted(expected, key=lambda r: r[0]), 1)]
    assert sorted(map(tuple, ranked.collect())) == expected
