"""What the physical plans must not contain, and the sf0.001 comparison with SQL."""

from __future__ import annotations

import pathlib

import pytest
from pyspark.sql import functions as F

from tallylog.functions.parsing import parse_access_logs, valid_records
from tallylog.operators import counts
from tallylog.operators.smoothing import savgol_smooth
from tallylog.operators.topk import top_n
from tallylog.plans import charts, report
from tallylog.plans.catalog import QUERIES
from tallylog.plans.oracle import ORACLE_SQL
from tests.oracle_check import connect, difference

FOLDER = "/root/testdata/sf0.001"
needs_data = pytest.mark.skipif(not pathlib.Path(FOLDER).exists(), reason="no test tables")


def plan(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


def test_every_query_has_sql():
    assert QUERIES.keys() == ORACLE_SQL.keys()


@needs_data
@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(spark, name):
    frame = QUERIES[name](spark, FOLDER)
    text = plan(frame)
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas"):
        assert node not in text
    assert difference(frame, connect(FOLDER), ORACLE_SQL[name]) is None


def test_pattern_is_matched_once_per_line(spark):
    lines = spark.createDataFrame([("x",)], "value STRING")
    records = valid_records(parse_access_logs(lines, ["status", "endpoint"])).filter(F.col("status") >= 500)
    text = plan(records.groupBy("endpoint").count())
    # Once in the projection that cuts the line; never in a filter.
    assert text.count("regexp_replace(") == 1


def test_rollup_is_one_scan_and_one_shuffle_with_partial_counts(spark, tmp_path):
    (tmp_path / "a.log").write_text("x\n")
    rollup = counts.build_rollup(parse_access_logs(spark.read.text(str(tmp_path)), report.ROLLUP_FIELDS))
    text = plan(rollup)
    assert text.count("FileScan") == 1 and text.count("Exchange") == 1 and "partial_count" in text


def test_long_bars_are_numbered_without_one_task(spark):
    table = spark.range(200_000).select(F.col("id").cast("string").alias("ip"), (F.col("id") % 1000).alias("count"))
    text = plan(charts.bar_feed(top_n(table, "ip", 1_000_000), "ip"))
    assert "SinglePartition" not in text and "Window" not in text


def test_smoothing_windows_are_partitioned(spark):
    series = spark.range(5000).select(F.col("id").alias("i"), F.col("id").alias("v"))
    text = plan(savgol_smooth(series, 5000, 5, 2, "v"))
    assert "windowspecdefinition(block" in text and "SinglePartition" not in text
