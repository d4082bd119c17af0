"""Log lines derived from an ``events`` table: the input of the registered queries.

Every event gives one line. Some lines are blank, broken or out of range, and a
stretch of minutes is an outage, so that every rule of the parser has work to do.
Time runs twenty times faster than in the table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallylog.session import use_utc

_DERIVED = {
    "m": "1704067200000000 + (unix_micros(CAST(ts AS TIMESTAMP)) - 1704067200000000) div 20",
    "mi": "(unix_micros(CAST(ts AS TIMESTAMP)) - 1704067200000000) div 1200000000",
    "method": """CASE WHEN event_id % 41 = 0 THEN 'TRACE' WHEN event_type = 'view' THEN 'get'
        WHEN event_type = 'click' THEN 'GET' WHEN event_type = 'purchase' THEN 'POST'
        WHEN event_type = 'signup' THEN 'PUT' ELSE 'DELETE' END""",
    "status": """CASE WHEN event_id % 47 = 0 THEN 600 WHEN event_id % 73 = 0 THEN 102
        WHEN event_type = 'error' THEN CASE event_id % 3 WHEN 0 THEN 500 WHEN 1 THEN 502 ELSE 503 END
        ELSE CASE event_id % 10 WHEN 0 THEN 404 WHEN 1 THEN 301 WHEN 2 THEN 403 ELSE 200 END END""",
    "size": "CASE WHEN event_id % 61 = 0 THEN 'many' WHEN event_id % 67 = 0 THEN '-5' WHEN event_id % 11 = 0 THEN '-' ELSE CAST(CAST(floor(value * 100) AS BIGINT) AS STRING) END",
}

_LINE = """CASE
    WHEN mi BETWEEN 600 AND 619 THEN concat('outage ', event_id)
    WHEN event_id % 53 = 0 THEN ''
    WHEN event_id % 37 = 0 THEN concat('garbage ', event_id)
    ELSE concat(
        '10.0.', user_id div 256, '.', user_id % 256, ' - ',
        CASE WHEN user_id % 3 = 0 THEN '-' ELSE concat('u', user_id) END, ' [',
        CASE WHEN event_id % 118 = 0 THEN '31/Feb/2024:10:00:00 +0530' WHEN event_id % 59 = 0 THEN '15/Foo/2024:10:00:00 +0530'
            WHEN event_id % 7 = 0 THEN concat(date_format(timestamp_micros(m) - INTERVAL '8 hours', 'dd/MMM/yyyy:HH:mm:ss'), ' -0800')
            ELSE concat(date_format(timestamp_micros(m) + INTERVAL '5 hours 30 minutes', 'dd/MMM/yyyy:HH:mm:ss'), ' +0530') END, '] "',
        method, ' ', CASE WHEN event_id % 43 = 0 THEN '' ELSE '/' END, event_type, '/', user_id % 20,
        ' http/1.0" ', status, ' ', size, ' "-" "UA/1.0" ',
        CASE WHEN event_id % 71 = 0 THEN '99999999999999999999' ELSE CAST(event_id % 5000 AS STRING) END)
    END"""


def event_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``event_id`` and the log line ``value`` of every event."""
    events = use_utc(spark).read.parquet(f"{sf_dir}/events.parquet")
    derived = [F.expr(rule).alias(name) for name, rule in _DERIVED.items()]
    columns = ["event_id", "user_id", "event_type"]
    return events.select(*columns, *derived).select("event_id", F.expr(_LINE).alias("value"))
