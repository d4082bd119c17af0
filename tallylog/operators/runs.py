"""Speed-up table of measured runs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def run_speedup(runs: DataFrame) -> DataFrame:
    """One row per worker count (at least 1, its first run) with the speed-up over the first run.

    ``pos`` is the place of that run; the rows in order of it are in order of the runs.

    ``runs`` has ``pos`` (order of the runs), ``workers``, ``duration_seconds`` and
    ``processed_lines``.
    """
    counted = runs.withColumn("workers", F.greatest(F.lit(1), F.col("workers").cast("int")))
    first = counted.groupBy("workers").agg(
        F.min("pos").alias("pos"),
        F.min_by("duration_seconds", "pos").alias("duration_seconds"),
        F.min_by("processed_lines", "pos").alias("processed_lines"),
    )
    reference = runs.agg(F.min_by("duration_seconds", "pos")).scalar()
    duration = F.col("duration_seconds")
    return first.withColumn(
        "speedup_vs_first_run", F.when(duration == 0, F.lit(1.0)).otherwise(reference / duration)
    )
