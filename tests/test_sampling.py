from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tallylog.operators.sampling import first_page, sample_anomaly_series, sample_evenly, with_position
from tests import brute_force as rules


def points(spark, n, flagged=()):
    return spark.range(n).select(
        F.col("id").alias("i"), F.col("id").isin(list(flagged) or [-1]).alias("is_anomaly"),
        F.timestamp_seconds(F.col("id") * 60).alias("minute"),
    ).repartition(3)


@pytest.mark.parametrize("n", [0, 1, 10, 11, 19, 20, 21, 57])
def test_series_sampling(spark, n):
    flagged = {i for i in (0, 7, n - 1) if 0 <= i < n}
    found = {r["i"] for r in sample_anomaly_series(points(spark, n, flagged), n, 10).collect()}
    assert found == rules.around_anomalies(n, flagged, 10)


def test_series_sampling_does_not_force_the_last_point(spark):
    assert max(r["i"] for r in sample_anomaly_series(points(spark, 12), 12, 10).collect()) == 10


@pytest.mark.parametrize("n", [0, 1, 10, 11, 19, 20, 21, 57])
def test_even_sampling(spark, n):
    frame = points(spark, n).withColumn("order", F.col("i") * 40_000)  # one block per row
    found = {r["i"] for r in sample_evenly(frame, "order", n, 10).collect()}
    assert found == rules.evenly(n, 10)


def test_even_sampling_keeps_flagged_rows(spark):
    found = {r["i"] for r in sample_evenly(points(spark, 57, {3, 13}), "i", 57, 10, keep="is_anomaly").collect()}
    assert found == rules.evenly(57, 10) | {3, 13}


def test_positions_over_sparse_blocks(spark):
    numbers = [5, 6, 16_384, 16_385, 90_000, 1_000_000, 1_000_001]
    frame = spark.createDataFrame([(n,) for n in numbers], "n BIGINT").repartition(4)
    rows = with_position(frame, "n").orderBy("n").collect()
    assert [r["position"] for r in rows] == list(range(len(numbers)))


def test_first_page(spark):
    rows = first_page(points(spark, 40), 25).collect()
    assert sorted(r["i"] for r in rows) == list(range(25))
    assert {r["total"] for r in rows} == {40}
    assert first_page(points(spark, 0)).count() == 0
