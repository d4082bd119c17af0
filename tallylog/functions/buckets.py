"""Columns derived from a parsed record."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The status classes that get a trend of their own; 1xx has none.
TRENDED_FAMILIES = ["2xx", "3xx", "4xx", "5xx"]


def minute_number(timestamp: Column) -> Column:
    """Whole minutes since 1970 in UTC, as BIGINT."""
    return F.floor(F.unix_seconds(timestamp) / 60)


def minute_start(number: Column) -> Column:
    """The TIMESTAMP at which a minute number begins."""
    return F.timestamp_seconds(number * 60)


def minute_bucket(timestamp: Column) -> Column:
    return F.date_trunc("minute", timestamp)


def iso_minute(timestamp: Column) -> Column:
    """ISO-8601 text with offset, such as ``2020-01-01T10:00:00+00:00``."""
    return F.date_format(timestamp, "yyyy-MM-dd'T'HH:mm:ssxxx")


def iso_number(number: Column) -> Column:
    return iso_minute(minute_start(number))


def status_family(status: Column) -> Column:
    return F.concat(F.floor(status / 100).cast("string"), F.lit("xx"))


def is_error(status: Column) -> Column:
    return status >= 400


def is_server_error(status: Column) -> Column:
    return status.between(500, 599)
