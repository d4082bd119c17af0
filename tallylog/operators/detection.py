"""Spikes of server errors per minute against a smoothed baseline.

The baseline of a minute depends on the minutes within half a window. So only stretches around minutes with errors are
smoothed and judged; every other minute has no errors, no baseline, and a residual of 0, and counts with its weight. A log's
span costs nothing, however far its first and last line lie apart.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallylog.functions.buckets import minute_number, minute_start
from tallylog.operators.robust import robust_scale, robust_scales
from tallylog.operators.sampling import NEIGHBOURS, SERIES_POINTS
from tallylog.operators.smoothing import savgol_smooth, with_params
from tallylog.operators.spine import Span, error_points, span_row, span_rows
from tallylog.operators.stretches import expand, stretches
from tallylog.session import cut_lineage

# Defaults and limits of the detection.
DEFAULT_WINDOW = 5
DEFAULT_SIGMA = 2.0
MIN_ERROR_COUNT = 3
SCALE_FLOOR = 1.0
METHOD = "Savitzky-Golay"
METRIC = "5xx errors per minute"


@dataclass(frozen=True)
class Detection:
    """Scalars of one detection, and ``stretches``: the minutes near errors with their verdicts.

    ``stretches`` and ``points`` have ``i, minute, errors, baseline, residual, threshold, score, is_anomaly``.
    """

    span: Span
    window: int
    order: int
    sigma: float
    scale: float
    stretches: DataFrame

    def _filled(self, positions: DataFrame) -> DataFrame:
        """The minutes at ``positions``; those outside the stretches have no errors and no baseline."""
        still = judge(
            positions.join(self.stretches.select("i", "errors", "baseline", "residual"), "i", "left").select(
                "i",
                F.coalesce("errors", F.lit(0).cast("bigint")).alias("errors"),
                F.coalesce("baseline", F.lit(0.0)).alias("baseline"),
                F.coalesce("residual", F.lit(0.0)).alias("residual"),
            ),
            self.span,
            self.sigma,
            self.scale,
        )
        return still

    @property
    def points(self) -> DataFrame:
        """Every minute of the span: as long as the span is."""
        return self._filled(self.stretches.sparkSession.range(self.span.points).select(F.col("id").alias("i")))

    def sampled(self, max_points: int = SERIES_POINTS) -> DataFrame:
        """``sample_anomaly_series`` of all points, made of the chosen minutes alone."""
        total = self.span.points
        if total <= max_points:
            return self.points
        step = -(-total // max_points)
        even = self.stretches.sparkSession.range(-(-total // step)).select((F.col("id") * step).alias("i"))
        around = F.explode(F.sequence(F.col("i") - NEIGHBOURS, F.col("i") + NEIGHBOURS)).alias("i")
        near = self.stretches.filter("is_anomaly").select(around).filter(F.col("i").between(0, total - 1))
        return self._filled(even.unionAll(near).distinct())

    @property
    def anomalies(self) -> DataFrame:
        return self.stretches.filter("is_anomaly").select(
            "minute", "errors", "baseline", "residual", "score", "threshold"
        )

    @property
    def meta(self) -> DataFrame:
        """One row with the parameters and what came out of them."""
        return self.stretches.agg(F.count_if("is_anomaly").alias("anomalies")).select(
            F.lit(METHOD).alias("method"),
            F.lit(METRIC).alias("metric"),
            F.lit(self.window).cast("bigint").alias("window_length"),
            F.lit(self.order).cast("bigint").alias("polyorder"),
            F.lit(float(self.sigma)).alias("sigma"),
            F.lit(float(self.scale)).alias("residual_scale"),
            F.lit(MIN_ERROR_COUNT).cast("bigint").alias("min_error_count"),
            F.lit(self.span.points).cast("bigint").alias("points"),
            "anomalies",
        )


def smoothing_frame(minutes: DataFrame, requested: int) -> tuple[Span, int, int]:
    """Span of the series, window length and polynomial order, from one small job."""
    row = with_params(span_row(minutes), requested).first()
    return Span(row["first"] or 0, row["points"]), row["window_length"], row["polyorder"]


def error_stretches(present: DataFrame, points: Column, half: Column, by: Sequence[str] = ()) -> DataFrame:
    """The minutes ``i, errors, wanted`` around the minutes with errors in ``present``.

    Wanted are those that a window with errors reaches; the others beside them are what running sums need.
    """
    reach = 2 * half + 1
    start, last = F.col("start"), F.col("last")
    around = expand(
        stretches(present, reach, by),
        F.greatest(F.lit(0).cast("bigint"), start - reach),
        F.least(points - 1, last + reach),
        *by,
        (start - half).alias("wanted_from"),
        (last + half).alias("wanted_to"),
    )
    wanted = F.col("i").between(F.col("wanted_from"), F.col("wanted_to")).alias("wanted")
    joined = around.join(present, [*by, "i"], "left")
    return joined.select(*by, "i", F.coalesce("errors", F.lit(0).cast("bigint")).alias("errors"), wanted)


def _baseline(present: DataFrame, points, window, order, half: Column, by: Sequence[str] = ()) -> DataFrame:
    points_column = points if isinstance(points, Column) else F.lit(points).cast("bigint")
    series = error_stretches(present, points_column, half, by)
    smooth = savgol_smooth(series, points, window, order, "errors", by=by, wanted=F.col("wanted"))
    return smooth.select(*by, "i", "errors", F.greatest(F.lit(0.0), "smoothed").alias("baseline"))


def error_baseline(minutes: DataFrame, span: Span, window: int, order: int) -> DataFrame:
    """``i, errors, baseline`` of the minutes near errors: the smoothed series, never below 0. It is 0 elsewhere."""
    return _baseline(error_points(minutes, span), span.points, window, order, F.lit(window // 2).cast("bigint"))


def error_residuals(baseline: DataFrame) -> DataFrame:
    return baseline.withColumn("residual", F.col("errors") - F.col("baseline"))


def with_rest(residuals: DataFrame, points: int) -> DataFrame:
    """``residual, weight`` of all minutes of a series: those given, and all others as one residual of 0."""
    rest = points - residuals.count()
    others = residuals.sparkSession.range(1).select(F.lit(0.0).alias("residual"), F.lit(rest).cast("bigint").alias("weight"))
    return residuals.select("residual", F.lit(1).cast("bigint").alias("weight")).unionAll(others.filter("weight > 0"))


def _judged(first: Column, sigma: float, scale: Column) -> list[Column]:
    errors, baseline, residual = F.col("errors"), F.col("baseline"), F.col("residual")
    threshold = F.greatest(baseline + F.lit(float(sigma)) * scale, F.lit(float(MIN_ERROR_COUNT)))
    return [
        F.col("i"),
        minute_start(F.col("i") + first).alias("minute"),
        errors,
        baseline,
        residual,
        threshold.alias("threshold"),
        (residual / scale).alias("score"),
        ((errors >= MIN_ERROR_COUNT) & (errors >= threshold) & (residual > 0)).alias("is_anomaly"),
    ]


def judge(residuals: DataFrame, span: Span, sigma: float, scale: float) -> DataFrame:
    """Threshold, score and verdict of every minute."""
    return residuals.select(*_judged(F.lit(span.first), sigma, F.lit(float(scale))))


def detect_anomalies(
    minutes: DataFrame, window: int = DEFAULT_WINDOW, sigma: float = DEFAULT_SIGMA
) -> Detection:
    """Detection over a minute table (``minute_table``), which should be a stored one.

    The residuals are stored once, since the median, the deviation and the verdict
    all read them. Only single numbers come to the driver.
    """
    span, length, order = smoothing_frame(minutes, window)
    residuals = cut_lineage(error_residuals(error_baseline(minutes, span, length, order)))
    scale = max(robust_scale(with_rest(residuals, span.points), "residual", F.col("weight")), SCALE_FLOOR)
    return Detection(span, length, order, sigma, scale, judge(residuals, span, sigma, scale))


@dataclass(frozen=True)
class KeyedDetection:
    """One detection for every key.

    ``frames`` has a row per key: ``first, points, window_length, polyorder, residual_scale``. ``stretches`` has the
    keys, and the minutes near errors as in ``Detection``; all other minutes of a key have no errors and no baseline.
    """

    by: tuple[str, ...]
    sigma: float
    frames: DataFrame
    stretches: DataFrame

    @property
    def anomalies(self) -> DataFrame:
        return self.stretches.filter("is_anomaly").drop("i", "is_anomaly")


def detect_anomalies_by(
    minutes: DataFrame, by: Sequence[str], window: int = DEFAULT_WINDOW, sigma: float = DEFAULT_SIGMA
) -> KeyedDetection:
    """Detection within each key over a stored table of ``by, minute, 5xx`` and further counts.

    A key's series spans its own first to last minute, and has its own window, residual scale and threshold. Spans and scales are tables
    joined to the series; nothing is collected, and all keys go through the same few jobs. Minutes of a hot key are
    dealt by block, as in one series.
    """
    by = list(by)
    frames = cut_lineage(with_params(span_rows(minutes, by), window))
    # What depends on the key alone goes along as a key.
    parameters = {"_first": "first", "_points": "points", "_window": "window_length", "_order": "polyorder"}
    keys = [*by, *parameters]
    known = frames.select(*by, *[F.col(old).alias(new) for new, old in parameters.items()])
    failed = minutes.filter(F.col("5xx") > 0).select(*by, minute_number(F.col("minute")).alias("number"), F.col("5xx").alias("errors"))
    present = cut_lineage(failed.join(known, by).select(*keys, (F.col("number") - F.col("_first")).alias("i"), "errors"))
    half = F.floor(F.col("_window") / 2)
    baseline = _baseline(present, F.col("_points"), F.col("_window"), F.col("_order"), half, keys)
    residuals = cut_lineage(error_residuals(baseline))
    near = residuals.groupBy(*by).agg(F.count(F.lit(1)).alias("near"))
    rest = frames.join(near, by, "left").select(
        *by, F.lit(0.0).alias("residual"), (F.col("points") - F.coalesce("near", F.lit(0))).alias("weight")
    )
    values = residuals.select(*by, "residual", F.lit(1).cast("bigint").alias("weight")).unionAll(rest)
    scales = robust_scales(values, by, "residual", F.col("weight"))
    scale = F.greatest("scale", F.lit(SCALE_FLOOR)).alias("residual_scale")
    frames = cut_lineage(frames.join(scales, by).select(*frames.columns, scale))
    judged = residuals.join(frames.select(*by, "residual_scale"), by)
    judged = judged.select(*by, *_judged(F.col("_first"), sigma, F.col("residual_scale")))
    return KeyedDetection(tuple(by), sigma, frames, judged)
