from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from tallylog.functions.buckets import minute_number
from tallylog.operators.detection import detect_anomalies, detect_anomalies_by, judge
from tallylog.operators.robust import exact_median, exact_medians, robust_scale, robust_scales
from tallylog.operators.smoothing import (
    savgol_coefficients,
    savgol_smooth,
    window_length,
    with_params,
)
from tallylog.operators import stretches
from tallylog.operators.sampling import sample_anomaly_series
from tallylog.operators.spine import (
    COUNTS,
    Span,
    continuous_minutes,
    error_runs,
    error_series,
    minute_span,
    sparse_trend,
)
from tests import brute_force as rules

BASE = 26_297_880  # 2020-01-01 10:00 UTC as a minute number


def minute_frame(spark, errors: dict[int, int], others: dict[int, int] | None = None):
    """A minute table with the given 5xx counts and further 2xx requests per minute."""
    others = others or {}
    rows = [
        (BASE + m, errors.get(m, 0) + others.get(m, 0), others.get(m, 0), 0, 0, errors.get(m, 0))
        for m in sorted(errors.keys() | others.keys())
    ]
    frame = spark.createDataFrame(rows, "number BIGINT, requests BIGINT, a BIGINT, b BIGINT, c BIGINT, d BIGINT")
    return frame.select(F.timestamp_seconds(F.col("number") * 60).alias("minute"), "requests", *[
        F.col(old).alias(new) for old, new in zip("abcd", COUNTS[1:])
    ])


def series_frame(spark, values):
    return spark.createDataFrame(list(enumerate(values)), "i BIGINT, v BIGINT")


def smoothed(spark, values, requested):
    w, order = rules.window_of(len(values), requested)
    # Spread over several partitions: the result must not depend on them.
    frame = savgol_smooth(series_frame(spark, values).repartition(3), len(values), w, order, "v")
    return [row["smoothed"] for row in frame.orderBy("i").collect()]


@pytest.mark.parametrize("n", [0, 1, 2, 3, 4, 5, 6, 7, 40, 41])
@pytest.mark.parametrize("requested", [-3, 1, 4, 5, 6, 7, 99])
def test_window_and_order(spark, n, requested):
    row = with_params(spark.range(1).select(F.lit(n).cast("bigint").alias("points")), requested).first()
    assert (row["window_length"], row["polyorder"]) == rules.window_of(n, requested)


def test_coefficients_are_least_squares(spark):
    for w in (3, 5, 7, 31, 101):
        order = 1 if w == 3 else 2
        params = spark.range(1).select(F.lit(w).cast("bigint").alias("window_length"), F.lit(order).alias("polyorder"))
        rows = savgol_coefficients(params).orderBy("k").collect()
        assert [float(x) for x in rules.weights(w, order)] == pytest.approx([r["weight"] for r in rows], abs=1e-15)


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 6, 30])
@pytest.mark.parametrize("requested", [5, 7, 101])
def test_smoothing_short_series(spark, n, requested):
    values = [random.Random(n).randint(0, 50) for _ in range(n)]
    assert smoothed(spark, values, requested) == pytest.approx([float(x) for x in rules.smooth(values, requested)], abs=1e-12)


@pytest.mark.parametrize("requested", [5, 31, 1001, 1501])
def test_smoothing_across_blocks(spark, requested):
    rng = random.Random(requested)
    values = [rng.choice([0, 0, 0, 1, 5, 900]) for _ in range(3100)]
    expected = rules.smooth(values, requested) if requested < 100 else None
    found = smoothed(spark, values, requested)
    if expected is None:  # exact fractions at a few positions only
        w, order = rules.window_of(len(values), requested)
        c, h = rules.weights(w, order), w // 2
        spots = [0, 1, h, 1023, 1024, 1025, 2047, 2048, 3098, 3099]
        expected = [sum(c[k + h] * rules.mirrored(values, i + k) for k in range(-h, h + 1)) for i in spots]
        found = [found[i] for i in spots]
    assert found == pytest.approx([float(x) for x in expected], abs=1e-9)


def test_sparse_trend_matches_brute_force(spark):
    rng = random.Random(5)
    cases = [set(), {3}, {3, 4}, {3, 5}, {3, 6}, {3, 9}] + [
        set(rng.sample(range(60), rng.randint(2, 40))) for _ in range(12)
    ]
    for present in cases:
        counts = {m: m + 1 for m in present}
        trend = sparse_trend(minute_frame(spark, {}, counts))
        rows = {r["n"] - BASE: r["requests"] for r in trend.select(minute_number(F.col("minute")).alias("n"), "requests").collect()}
        assert rows == {m: counts.get(m, 0) for m in rules.sparse_minutes(present)}
        assert sum(rows.values()) == sum(counts.values())


def test_continuous_spine_spans_all_requests_not_only_errors(spark):
    minutes = minute_frame(spark, {10: 4}, {0: 1, 25: 1})
    span = minute_span(minutes)
    assert span == Span(BASE, 26)
    assert continuous_minutes(spark, span).count() == 26
    errors = {r["i"]: r["errors"] for r in error_series(minutes, span).collect()}
    assert errors == {i: 4 if i == 10 else 0 for i in range(26)}


@pytest.mark.parametrize("values", [[1], [1, 2], [5, 1, 3], [4, 4, 4, 4], [0, 0, 0, 9], list(range(1000)), [7] * 500 + list(range(501))])
def test_exact_median(spark, values):
    frame = spark.createDataFrame([(float(v),) for v in values], "x DOUBLE").repartition(4)
    assert exact_median(frame, F.col("x")) == rules.median([float(v) for v in values])


def test_exact_median_of_many_distinct_values(spark):
    rng = random.Random(3)
    values = [rng.gauss(0, 1) for _ in range(20_001)] + [0.25] * 9_000
    frame = spark.createDataFrame([(v,) for v in values], "x DOUBLE").repartition(8)
    assert exact_median(frame, F.col("x")) == rules.median(values)


def test_median_and_scale_of_nothing(spark):
    empty = spark.createDataFrame([], "x DOUBLE")
    assert exact_median(empty, F.col("x")) is None
    assert robust_scale(empty, "x") == 0.0


def test_scale_uses_mad_then_deviation(spark):
    spread = spark.createDataFrame([(float(v),) for v in (1, 2, 3, 4, 100)], "x DOUBLE")
    assert robust_scale(spread, "x") == pytest.approx(1.4826)
    spike = spark.createDataFrame([(0.0,)] * 9 + [(10.0,)], "x DOUBLE")
    assert robust_scale(spike, "x") == pytest.approx(3.0)


def test_detection_matches_brute_force(spark):
    rng = random.Random(11)
    for window, sigma in ((5, 2.0), (8, 0.0), (31, 1.0)):
        errors = {m: rng.choice([0, 0, 1, 2, 3, 30]) for m in range(200)}
        errors[0], errors[199] = 40, 40
        found = detect_anomalies(minute_frame(spark, errors), window, sigma)
        values = [errors[m] for m in range(200)]
        baseline = [max(0.0, float(x)) for x in rules.smooth(values, window)]
        residual = [v - b for v, b in zip(values, baseline)]
        middle = rules.median(residual)
        scale = max(1.4826 * rules.median([abs(r - middle) for r in residual]), 1.0)
        assert found.scale == pytest.approx(scale)
        expected = {
            i for i, (v, b, r) in enumerate(zip(values, baseline, residual))
            if v >= 3 and v >= max(b + sigma * scale, 3.0) and r > 1e-9
        }
        rows = found.points.collect()
        assert {r["i"] for r in rows if r["is_anomaly"]} == expected
        assert all(r["score"] == pytest.approx(r["residual"] / scale) for r in rows)


def test_detection_of_nothing_and_of_little(spark):
    none = detect_anomalies(minute_frame(spark, {}))
    assert (none.window, none.order, none.scale, none.points.count()) == (0, 0, 1.0, 0)
    assert none.anomalies.columns == ["minute", "errors", "baseline", "residual", "score", "threshold"]
    short = detect_anomalies(minute_frame(spark, {0: 9, 1: 2}))
    assert (short.window, short.order) == (0, 0)
    assert [r["baseline"] for r in short.points.orderBy("i").collect()] == [9.0, 2.0]
    assert short.anomalies.count() == 0


def test_verdict_edges(spark):
    rows = [(0, 3, 1.0), (1, 2, 0.0), (2, 3, 1.001), (3, 5, 5.0), (4, 5, 3.0)]
    frame = spark.createDataFrame(rows, "i BIGINT, errors BIGINT, baseline DOUBLE")
    frame = frame.withColumn("residual", F.col("errors") - F.col("baseline"))
    verdicts = {r["i"]: r["is_anomaly"] for r in judge(frame, Span(BASE, 5), 2.0, 1.0).collect()}
    # At the threshold counts; fewer than three errors and no rise never do.
    assert verdicts == {0: True, 1: False, 2: False, 3: False, 4: True}


def test_large_counts_keep_exact_sums(spark):
    values = [10**9 + i % 7 for i in range(2500)]
    found = smoothed(spark, values, 5)
    assert found == pytest.approx([float(x) for x in rules.smooth(values, 5)], rel=1e-15)


def test_median_rounds_hold_a_bounded_number_of_sums(spark, monkeypatch):
    from tallylog.operators import robust

    rounds = []
    original = robust._narrowed

    def counted(bracketed, by):
        rounds.append(1)
        return original(bracketed, by)

    monkeypatch.setattr(robust, "_narrowed", counted)
    monkeypatch.setattr(robust, "PARTS", 20)
    values = spark.range(99_999).select((F.col("id") * 7919 % 99_999).cast("double").alias("x"))
    assert exact_median(values, F.col("x")) == 49_999.0
    assert 2 <= len(rounds) <= 5
    # Equal values need no second look, far ends and tiny gaps few rounds.
    rounds.clear()
    assert exact_median(values.select(F.lit(3.0).alias("x")), F.col("x")) == 3.0 and len(rounds) == 1
    far = spark.createDataFrame([(x,) for x in (-1e300, 5e-324, 0.0, 1e-300, 1e300)], "x DOUBLE")
    assert exact_median(far, F.col("x")) == 5e-324
    for bad in (float("nan"), float("inf")):
        with pytest.raises(ArithmeticError):
            exact_median(spark.createDataFrame([(1.0,), (bad,)], "x DOUBLE"), F.col("x"))


@pytest.mark.parametrize("seed", range(4))
def test_weighted_median_equals_the_plain_one(spark, seed):
    rng = random.Random(seed)
    runs = [(rng.choice("abc"), rng.choice([0.0, -1.5, rng.gauss(0, 9), 1e9]), rng.randint(0, 40)) for _ in range(60)] + [("d", 2.0, 1)]
    frame = spark.createDataFrame(runs, "k STRING, x DOUBLE, w INT").repartition(4)
    plain = [x for _, x, w in runs for _ in range(w)]
    assert exact_median(frame, F.col("x"), F.col("w")) == rules.median(plain)
    by_key = {k: [x for own, x, w in runs if own == k for _ in range(w)] for k in "abcd"}
    found = {r["k"]: r["median"] for r in exact_medians(frame, ["k"], F.col("x"), F.col("w")).collect()}
    assert found == {k: rules.median(values) for k, values in by_key.items()}
    scales = {r["k"]: r["scale"] for r in robust_scales(frame, ["k"], "x", F.col("w")).collect()}
    for k, values in by_key.items():
        plain_scale = robust_scale(spark.createDataFrame([(v,) for v in values], "x DOUBLE"), "x")
        assert scales[k] == pytest.approx(plain_scale, rel=1e-12)


@pytest.mark.parametrize("ansi", ["true", "false"])
@pytest.mark.parametrize("requested", [5, 1001, 1003])
def test_smoothing_of_very_large_counts(spark, requested, ansi):
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        assert smoothed(spark, [10**10] * 1100, requested) == pytest.approx([1e10] * 1100, rel=1e-15)
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


@pytest.mark.parametrize("requested", [2047, 2049, 5001])
def test_smoothing_windows_wider_than_blocks(spark, requested):
    values = [(k * k) % 97 for k in range(6000)]
    found = smoothed(spark, values, requested)
    w, order = rules.window_of(len(values), requested)
    c, h = rules.weights(w, order), w // 2
    spots = [0, 1, 1023, 1024, 2999, 4096, 5998, 5999]
    expected = [sum(c[k + h] * rules.mirrored(values, i + k) for k in range(-h, h + 1)) for i in spots]
    assert [found[i] for i in spots] == pytest.approx([float(x) for x in expected], rel=1e-12)


def dense_detection(values, window, sigma):
    """Verdicts of every minute, worked out on the whole series."""
    baseline = [max(0.0, float(x)) for x in rules.smooth(values, window)]
    residual = [v - b for v, b in zip(values, baseline)]
    middle = rules.median(residual)
    scale = 1.4826 * rules.median([abs(r - middle) for r in residual])
    if scale == 0:
        mean = sum(residual) / len(residual)
        scale = (sum((r - mean) ** 2 for r in residual) / len(residual)) ** 0.5
    scale = max(scale, 1.0)
    return scale, [(v, b, r, max(b + sigma * scale, 3.0)) for v, b, r in zip(values, baseline, residual)]


@pytest.mark.parametrize("seed,window", [(1, 5), (2, 5), (3, 9), (4, 31), (5, 301)])
def test_stretches_equal_the_dense_path(spark, monkeypatch, seed, window):
    monkeypatch.setattr(stretches, "CHUNK", 7)
    monkeypatch.setattr(stretches, "NUMBERING_BLOCK", 16)
    rng = random.Random(seed)
    n = rng.choice([260, 601])
    spots = {0, n - 1, 3} | {min(n - 1, c + rng.randint(0, 12)) for c in rng.sample(range(n), 9) for _ in range(4)}
    errors = {m: rng.choice([1, 2, 9, 60]) for m in spots}
    found = detect_anomalies(minute_frame(spark, errors, {0: 1, n - 1: 1}), window, 1.0)
    scale, expected = dense_detection([errors.get(m, 0) for m in range(n)], window, 1.0)
    assert found.scale == pytest.approx(scale, rel=1e-12)
    rows = {r["i"]: r for r in found.points.collect()}
    assert sorted(rows) == list(range(n))
    for i, (v, b, r, threshold) in enumerate(expected):
        assert rows[i]["errors"] == v
        assert (rows[i]["baseline"], rows[i]["residual"], rows[i]["threshold"]) == pytest.approx((b, r, threshold), abs=1e-9)
    assert found.stretches.select("i").distinct().count() == found.stretches.count() <= n
    sampled = {r["i"] for r in found.sampled(50).collect()}
    assert sampled == {r["i"] for r in sample_anomaly_series(found.points, n, 50).collect()}


def test_a_far_off_year_costs_nothing(spark):
    far = 4_000_000_000
    errors = {0: 1, 5: 40, 6: 2, 1000: 9, far: 3}
    found = detect_anomalies(minute_frame(spark, errors, {1: 7}))
    assert found.span.points == far + 1 and found.stretches.count() < 60
    assert {r["minute"].year for r in found.anomalies.collect()} >= {2020} and found.meta.first()["points"] == far + 1
    # All but a few residuals are 0, so the deviation counts.
    assert found.scale == 1.0
    assert 1200 <= found.sampled().count() <= 1200 + 5 * 5
    runs = error_runs(minute_frame(spark, errors, {1: 7}), found.span).orderBy("start").collect()
    assert [tuple(r) for r in runs] == [(0, 1, 1), (1, 4, 0), (5, 1, 40), (6, 1, 2), (7, 993, 0), (1000, 1, 9), (1001, far - 1001, 0), (far, 1, 3)]


def test_runs_of_short_series(spark):
    for n, spots in ((1, set()), (1, {0}), (4, set()), (4, {0, 3}), (5, {2}), (6, {0, 1, 5}), (0, set())):
        points = spark.createDataFrame([(i, i + 1) for i in spots], "i BIGINT, v BIGINT")
        runs = sorted(tuple(r) for r in stretches.value_runs(points, n, "v").collect())
        assert [i + k for i, length, _ in runs for k in range(length)] == list(range(n))
        assert {i: v for i, length, v in runs if v} == {i: i + 1 for i in spots} and all(length == 1 for _, length, v in runs if v)


@pytest.mark.parametrize("window,sigma", [(5, 0.5), (40, 1.0)])
def test_keyed_detection_is_one_per_key(spark, window, sigma):
    rng = random.Random(window)
    tables, merged = {}, None
    for key, n in (("a", 300), ("b", 61), ("c", 4), ("d", 2), ("e", 30), (None, 9)):
        errors = {m: rng.choice([0, 0, 0, 1, 5, 30]) for m in range(n)} if key != "e" else {0: 0, 29: 0}
        tables[key] = minute_frame(spark, errors, {0: 1, n - 1: 1})
        own = tables[key].select(F.lit(key).cast("string").alias("k"), "*")
        merged = own if merged is None else merged.unionAll(own)
    found = detect_anomalies_by(merged, ["k"], window, sigma)
    frames = {r["k"]: r for r in found.frames.collect()}
    assert set(frames) == {"a", "b", "c", "d", "e"}  # a null key names no series
    rows = found.stretches.collect()
    for key in frames:
        alone = detect_anomalies(tables[key], window, sigma)
        own = frames[key]
        assert (own["first"], own["points"], own["window_length"], own["polyorder"]) == (alone.span.first, alone.span.points, alone.window, alone.order)
        assert own["residual_scale"] == pytest.approx(alone.scale, rel=1e-12)
        judged = {r["i"]: r for r in rows if r["k"] == key and r["errors"]}
        expected = {r["i"]: r for r in alone.points.filter("errors > 0").collect()}
        assert judged.keys() == expected.keys()
        for i, r in expected.items():
            assert judged[i]["is_anomaly"] == r["is_anomaly"] and judged[i]["minute"] == r["minute"]
            assert [judged[i][c] for c in ("baseline", "residual", "threshold", "score")] == pytest.approx([r[c] for c in ("baseline", "residual", "threshold", "score")])
    assert found.anomalies.count() == sum(r["is_anomaly"] for r in rows) > 0
