"""Totals and counts by key, and rollups that can be stored and merged."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallylog.functions.buckets import (
    TRENDED_FAMILIES,
    is_error,
    is_server_error,
    minute_bucket,
    minute_number,
    minute_start,
    status_family,
)
from tallylog.session import cut_lineage

# A rollup row: ``dim`` names what is counted, ``label`` and ``number`` are its key.
#   dim            label          number
#   method_status  method         status; both NULL for the rejected lines
#   endpoint       endpoint       1 for errors (status 400 and above), else 0
#   ip             address        0
#   minute         status class   minute number since 1970
ROLLUP_KEYS = ["dim", "label", "number"]
# Sums of sizes and times are kept with the totals only; other rows have 0.
ROLLUP_SUMS = ["response_bytes", "response_time_ms"]
ROLLUP_COLUMNS = [*ROLLUP_KEYS, "lines", *ROLLUP_SUMS]
DIMENSIONS = ["method_status", "endpoint", "ip", "minute"]


def _exact_sum(name: str) -> Column:
    """A sum that no set of BIGINT values can overflow; 0 for no values."""
    total = F.sum(F.col(name).cast("decimal(38,0)"))
    return F.coalesce(total, F.lit(0)).cast("decimal(38,0)").alias(name)


def _ratio(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part.cast("double") / whole).otherwise(F.lit(0.0))


def totals(parsed: DataFrame) -> DataFrame:
    """One row: line counts, sums, averages and the valid ratio; 0.0 where nothing was counted."""
    return parsed.agg(
        F.count(F.lit(1)).alias("processed_lines"),
        F.count_if("is_valid").alias("valid_lines"),
        *map(_exact_sum, ROLLUP_SUMS),
    ).select("*", *_derived_metrics())


def _derived_metrics() -> list[Column]:
    lines, valid = F.col("processed_lines"), F.col("valid_lines")
    return [
        (lines - valid).alias("invalid_lines"),
        _ratio(valid, lines).alias("valid_ratio"),
        _ratio(F.col("response_time_ms"), valid).alias("average_response_time_ms"),
        _ratio(F.col("response_bytes"), valid).alias("average_response_bytes"),
    ]


def count_by(records: DataFrame, key: str | Column, name: str | None = None) -> DataFrame:
    """Records per value of ``key``; partial counts before the shuffle make hot keys harmless."""
    key = F.col(key) if isinstance(key, str) else key
    return records.groupBy(key.alias(name) if name else key).agg(F.count(F.lit(1)).alias("count"))


def count_errors_by_endpoint(records: DataFrame) -> DataFrame:
    return count_by(records.filter(is_error(F.col("status"))), "endpoint")


def minute_table(records: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Per present minute, of each key in ``by``: ``requests`` and one count per trended status class."""
    family = status_family(F.col("status"))
    return records.groupBy(*by, minute_bucket(F.col("timestamp_utc")).alias("minute")).agg(
        F.count(F.lit(1)).alias("requests"),
        *[F.count_if(family == name).alias(name) for name in TRENDED_FAMILIES],
    )


def server_errors_by_minute(records: DataFrame) -> DataFrame:
    failed = records.filter(is_server_error(F.col("status")))
    return count_by(failed, minute_bucket(F.col("timestamp_utc")), "minute")


def build_rollup(parsed: DataFrame, part: str | None = None) -> DataFrame:
    """Every count of the report from one pass over the parsed lines.

    With ``part``, a column such as the day or the shard of a line, the pass gives one
    rollup per part; ``merge_rollups`` puts them together.

    Each line gives one short key per dimension, and one pair of partial and final
    aggregates counts them all. (method, status) also carries the totals and the
    rejected lines. A task hands on one partial row per key, whatever share of the
    lines that key holds. GROUPING SETS over the same columns is the same count, but
    hashes every key column for every dimension.
    """
    parts = [part] if part else []

    def key(dim: str, label: Column, number: Column, summed: bool = False) -> Column:
        return F.struct(
            F.lit(dim).alias("dim"),
            label.alias("label"),
            number.cast("bigint").alias("number"),
            *[(F.col(name) if summed else F.lit(None)).cast("bigint").alias(name) for name in ROLLUP_SUMS],
        )

    status, minute = F.col("status"), minute_number(F.col("timestamp_utc"))
    outcome = key("method_status", F.col("method"), status, summed=True)
    keys = F.when(
        F.col("is_valid"),
        F.array(
            outcome,
            key("endpoint", F.col("endpoint"), is_error(status)),
            key("ip", F.col("ip"), F.lit(0)),
            key("minute", status_family(status), minute),
        ),
    ).otherwise(F.array(outcome))
    return (
        parsed.select(*parts, F.explode(keys).alias("key"))
        .select(*parts, "key.*")
        .groupBy(*parts, *ROLLUP_KEYS)
        .agg(F.count(F.lit(1)).alias("lines"), *map(_exact_sum, ROLLUP_SUMS))
    )


def merge_rollups(*rollups: DataFrame) -> DataFrame:
    """The rollup of all parts together, whatever their order and split."""
    together = reduce(DataFrame.unionByName, rollups).filter("lines > 0")
    return together.groupBy(*ROLLUP_KEYS).agg(F.sum("lines").alias("lines"), *map(_exact_sum, ROLLUP_SUMS))


def save_rollup(rollup: DataFrame, path: str, mode: str = "error") -> None:
    """Parquet with one folder per dimension, so a reader touches only what it needs."""
    rollup.write.mode(mode).partitionBy("dim").parquet(path)


def save_parts(rollup: DataFrame, path: str, part: str, written: Sequence | None = None) -> None:
    """Stores a rollup of parts, such as days, so that saving a part again replaces it: a repeated job counts nothing twice.

    Each part has a folder per dimension, and a save replaces all folders of the parts that it writes and no others. So a part gets
    a row of no lines in every dimension, which also clears what an earlier save had there. ``written`` names
    the parts; by default they are those in the rollup, so a part that has become empty must be named.
    """
    spark = rollup.sparkSession
    if written is None:
        rollup = cut_lineage(rollup)
        parts = rollup.select(part).distinct()
    else:
        parts = spark.createDataFrame([(value,) for value in written], rollup.select(part).schema)
    dims = F.explode(F.array(*map(F.lit, DIMENSIONS))).alias("dim")
    nothing = parts.select(part, dims).select("*", *[F.lit(None).cast(rollup.schema[c].dataType).alias(c) for c in ("label", "number")])
    nothing = nothing.select("*", *[F.lit(0).cast(rollup.schema[c].dataType).alias(c) for c in ("lines", *ROLLUP_SUMS)])
    rows = rollup.select(part, *ROLLUP_COLUMNS).unionByName(nothing)
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(part, "dim").parquet(path)


def load_rollup(spark: SparkSession, path: str) -> DataFrame:
    """A saved rollup, of one save or of parts."""
    return spark.read.parquet(path).select(*ROLLUP_COLUMNS).filter("lines > 0")


def rollup_totals(rollup: DataFrame) -> DataFrame:
    """``totals`` from a rollup."""
    lines, valid = F.col("lines"), F.col("label").isNotNull()
    return (
        rollup.filter(F.col("dim") == "method_status")
        .agg(
            F.coalesce(F.sum(lines), F.lit(0)).alias("processed_lines"),
            F.coalesce(F.sum(F.when(valid, lines)), F.lit(0)).alias("valid_lines"),
            *map(_exact_sum, ROLLUP_SUMS),
        )
        .select("*", *_derived_metrics())
    )


def rollup_counts(rollup: DataFrame, key: str, errors_only: bool = False) -> DataFrame:
    """``count_by`` for method, status, endpoint or ip, from a rollup."""
    dim = "method_status" if key in ("method", "status") else key
    value = F.col("number").cast("int") if key == "status" else F.col("label")
    rows = rollup.filter((F.col("dim") == dim) & F.col("label").isNotNull())
    if errors_only:
        rows = rows.filter("number = 1")
    # Appended rollups and those of parts hold several rows of one key.
    return rows.groupBy(value.alias(key)).agg(F.sum("lines").alias("count"))


def rollup_minutes(rollup: DataFrame) -> DataFrame:
    """``minute_table`` from a rollup."""
    lines = F.col("lines")
    return (
        rollup.filter(F.col("dim") == "minute")
        .groupBy("number")
        .agg(
            F.sum(lines).alias("requests"),
            *[
                F.sum(F.when(F.col("label") == name, lines).otherwise(0)).alias(name)
                for name in TRENDED_FAMILIES
            ],
        )
        .select(minute_start(F.col("number")).alias("minute"), "requests", *TRENDED_FAMILIES)
    )
