"""Top-N tables with a fixed order."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed value: the cap of the status and method tables.
DISTRIBUTION_ROWS = 1000


def top_n(counts: DataFrame, key: str, n: int) -> DataFrame:
    """``key`` as text and ``count``: most frequent first, ties by text, at most ``n`` rows."""
    if n < 0:
        raise ValueError(f"top_n must not be negative: {n}")
    return (
        counts.select(F.col(key).cast("string").alias(key), "count")
        .orderBy(F.desc("count"), F.asc(key))
        .limit(n)
    )
