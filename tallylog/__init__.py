"""Batch analytics over web access logs, written as Spark DataFrame jobs."""

from tallylog.functions.parsing import parse_access_logs, valid_records
from tallylog.operators.detection import detect_anomalies, detect_anomalies_by
from tallylog.plans.charts import write_charts
from tallylog.plans.report import analyze, write_report
from tallylog.sources.files import read_lines

__all__ = [
    "analyze",
    "detect_anomalies",
    "detect_anomalies_by",
    "parse_access_logs",
    "read_lines",
    "valid_records",
    "write_charts",
    "write_report",
]
