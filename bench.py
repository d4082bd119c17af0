"""Times the headline queries and the line throughput; prints one JSON line.

BENCH_SF_DIR   folder of tables       (default /root/testdata/sf0.1)
BENCH_CPUS     local cores            (default 8)
BENCH_LINES    synthesised log lines  (default 1000000)
BENCH_RUNS     runs per query, median (default 3)
"""

from __future__ import annotations

import json
import os
import statistics
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tallylog.functions.parsing import parse_access_logs
from tallylog.operators.counts import build_rollup
from tallylog.plans import report
from tallylog.plans.catalog import QUERIES
from tallylog.session import shared_path
from tallylog.sources.files import read_lines
from tallylog.sources.synthetic import synthesize_lines

HEADLINE = [
    "parse_access_logs",
    "reject_reasons",
    "line_counts",
    "traffic_averages",
    "multi_key_rollup",
    "merge_rollups",
    "top_ips",
    "top_endpoints",
    "top_error_endpoints",
    "request_trend",
    "status_family_trends",
    "savgol_smooth",
    "residual_scale",
    "anomalies",
    "anomaly_series_sampled",
    "trend_sampled",
    "run_speedup",
    "report_metrics",
]


def drain(frame: DataFrame) -> None:
    """Computes every row and column without collecting them."""
    frame.write.format("noop").mode("overwrite").save()


def median_seconds(run: Callable[[], object], runs: int) -> float:
    run()  # warm-up
    times = []
    for _ in range(runs):
        start = time.perf_counter()
        run()
        times.append(time.perf_counter() - start)
    return round(statistics.median(times), 3)


def throughput(spark: SparkSession, lines: int, runs: int) -> dict[str, dict]:
    """Seconds and lines per second on synthesised log files."""
    source = shared_path(spark, "bench-log")
    synthesize_lines(spark.range(lines)).select("value").write.text(source)

    def full_report() -> None:
        report.write_report(report.analyze(spark, source), shared_path(spark, "bench-report"))

    jobs = {
        "parse": lambda: drain(parse_access_logs(read_lines(spark, source))),
        "parse_and_count": lambda: drain(build_rollup(parse_access_logs(read_lines(spark, source), report.ROLLUP_FIELDS))),
        "full_report": full_report,
    }
    result = {}
    for name, job in jobs.items():
        seconds = median_seconds(job, runs)
        result[name] = {"sec": seconds, "lines_per_sec": round(lines / seconds)}
    return result


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    lines = int(os.environ.get("BENCH_LINES", "1000000"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("tallylog-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = {name: median_seconds(lambda: drain(QUERIES[name](spark, folder)), runs) for name in HEADLINE}
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(queries.values()), 3),
                "unit": "sec",
                "queries": queries,
                "sf": folder.rstrip("/").rsplit("sf", 1)[-1],
                "cpus": int(cpus),
                "synthetic_lines": lines,
                "throughput": throughput(spark, lines, runs),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
