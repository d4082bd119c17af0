"""Numbering the rows of a table in any order, without one task that holds them all."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallylog.session import cut_lineage

# The lower bits of ``monotonically_increasing_id`` number rows within a partition.
_ROW_BITS = 33


def with_rank(df: DataFrame, *order: Column, name: str = "place") -> DataFrame:
    """Adds the 1-based place of each row in ``order``, which must leave no ties.

    The rows are dealt to partitions by ranges of the order, sorted there, and stored with their number within the partition. A place is
    that number plus the rows of the ranges before; only the sizes of the ranges, one number a partition, reach the driver.
    """
    stored = cut_lineage(df.orderBy(*order).withColumn("_id", F.monotonically_increasing_id()))
    part = F.shiftright("_id", _ROW_BITS)
    sizes = {r["part"]: r["rows"] for r in stored.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("rows")).collect()}
    starts, before = [], 0
    for number in sorted(sizes):
        starts.append((number, before))
        before += sizes[number]
    offsets = df.sparkSession.createDataFrame(starts, "_part bigint, _before bigint")
    joined = stored.withColumn("_part", part).join(offsets, "_part")
    place = F.col("_before") + F.col("_id").bitwiseAND(F.lit((1 << _ROW_BITS) - 1)) + 1
    return joined.select(place.alias(name), *[F.col(column) for column in df.columns])
