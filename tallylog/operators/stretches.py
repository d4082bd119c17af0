"""Sparse series: runs of equal values, neighbours in order, and stretches around the points that matter.

A series of minutes is mostly zeros, and one line with a year far off makes it billions of minutes long. So a series is
kept as its nonzero points, its rules are worked out on the stretches that these points can reach, and all
minutes in between are one value with a weight.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallylog.operators.sampling import NUMBERING_BLOCK, with_position

# Positions that one row is expanded to at a time; a longer run becomes several rows first.
CHUNK = 65_536


def with_beside(df: DataFrame, order: str, value: str, step: int, name: str, by: Sequence[str] = ()) -> DataFrame:
    """Adds the ``value`` of the row before (``step`` -1) or after (1) in the order of a distinct whole-number column.

    Rows are ordered inside blocks of the order column, as in ``with_position``. The first or last row of a block takes the value from the
    edge of the nearest block with rows; those edges are one row a block. ``value`` must not be null in a row that is asked for.
    """
    keys = [*by, "_block"]
    blocked = df.withColumn("_block", F.floor(F.col(order) / NUMBERING_BLOCK))
    shift, edge = (F.lag, F.max_by) if step < 0 else (F.lead, F.min_by)
    edges = blocked.groupBy(*keys).agg(edge(value, order).alias("_edge"))
    # Log times have four-digit years, so there are at most 325,000 blocks of minutes for a key.
    edges = edges.withColumn("_edge", shift("_edge").over(Window.partitionBy(*by).orderBy("_block")))
    inside = shift(value).over(Window.partitionBy(*keys).orderBy(order))
    return blocked.withColumn(name, inside).join(edges, keys).withColumn(name, F.coalesce(name, "_edge")).drop("_block", "_edge")


def stretches(points: DataFrame, reach: Column, by: Sequence[str] = ()) -> DataFrame:
    """Islands of positions ``i``: ``start`` and ``last`` of each run of points whose surroundings of ``reach`` positions touch.

    A point opens an island if the one before is too far off, and closes it where the next island's first point says so.
    """
    before = with_beside(points.select(*by, "i"), "i", "i", -1, "before", by)
    starts = before.filter(F.col("before").isNull() | (F.col("i") - F.col("before") > 2 * reach + 1))
    opened = with_beside(starts.select(*by, F.col("i").alias("start"), "before"), "start", "before", 1, "last", by)
    if by:
        ends = points.groupBy(*by).agg(F.max("i").alias("end"))
        return opened.join(ends, list(by)).select(*by, "start", F.coalesce("last", "end").alias("last"))
    end = points.agg(F.max("i")).scalar()
    return opened.select("start", F.coalesce("last", end).alias("last"))


def expand(runs: DataFrame, start: Column, last: Column, *columns: str | Column) -> DataFrame:
    """One row per position ``i`` from ``start`` to ``last`` of each run, with ``columns`` of the run.

    Long runs are cut into chunks, and the chunks spread over the tasks, before any task makes positions.
    """
    chunks = runs.filter(start <= last).select(
        F.explode(F.sequence(start, last, F.lit(CHUNK).cast("bigint"))).alias("from"), last.alias("to"), *columns
    )
    parts = int(runs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    names = [name for name in chunks.columns if name not in ("from", "to")]
    positions = F.explode(F.sequence("from", F.least("to", F.col("from") + CHUNK - 1))).alias("i")
    return chunks.repartition(parts, "from").select(positions, *names)


def value_runs(points: DataFrame, length: int, value: str) -> DataFrame:
    """The series of positions 0 to ``length - 1`` as runs ``start, length, value``, from its nonzero points ``i, value``.

    A nonzero point is a run of its own, a gap is one run of zeros. A gap's first and last position are numbered in their order, and
    those of one number belong together.
    """
    last = F.lit(length - 1).cast("bigint")
    # Both ends of the series count as points beside it.
    outside = points.sparkSession.range(2).select(F.when(F.col("id") == 0, -1).otherwise(length).cast("bigint").alias("i"))
    beside = points.select("i").unionAll(outside).select(
        F.explode(F.array(*[F.struct((F.col("i") + step).alias("i"), F.lit(step).alias("step")) for step in (-1, 0, 1)])).alias("s")
    )
    sides = beside.groupBy("s.i").agg(
        F.max(F.col("s.step") == 0).alias("present"), F.max(F.col("s.step") == 1).alias("first"), F.max(F.col("s.step") == -1).alias("last")
    )
    free = sides.filter(~F.col("present") & F.col("i").between(0, last))
    firsts = with_position(free.filter("first").select(F.col("i").alias("start")), "start")
    lasts = with_position(free.filter("last").select(F.col("i").alias("end")), "end")
    gaps = firsts.join(lasts, "position").select("start", (F.col("end") - F.col("start") + 1).alias("length"), F.lit(0).cast("bigint").alias(value))
    return points.select(F.col("i").alias("start"), F.lit(1).cast("bigint").alias("length"), F.col(value).cast("bigint").alias(value)).unionAll(gaps)
