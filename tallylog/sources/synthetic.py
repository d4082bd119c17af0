"""Seeded synthetic access logs, one line per given id."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The value domains of the generated lines.
METHODS = ["GET", "POST", "PUT", "DELETE"]
ENDPOINTS = ["/usr", "/usr/admin", "/usr/admin/developer", "/usr/login", "/usr/register"]
STATUSES = ["303", "404", "500", "403", "502", "304", "200"]
REFERRERS = ["-", "https://www.example.org/start"]
AGENTS = [f"ExampleBrowser/{major}.0 (build {major * 17})" for major in range(1, 11)]
FIRST_SECOND = 1514788200  # 2018-01-01 12:00:00 +0530
LAST_SECOND = 1577860200  # 2020-01-01 12:00:00 +0530
MAX_MILLIS = 5000

# The independent draws behind a line. Twelve of them add up to its size.
BYTE_DRAWS = [f"byte{n}" for n in range(12)]
DRAWS = ["o1", "o2", "o3", "o4", "second", "method", "endpoint", "status", "referrer", "agent", "millis", *BYTE_DRAWS]

# Parameters of a 32-bit mixing function; BIGINT products cannot overflow.
MASK = 0xFFFFFFFF
STEP = 0x9E3779B9
FACTOR = 0x45D9F3B


def _folded(draw: str) -> Column:
    return F.col(draw).bitwiseXOR(F.shiftright(draw, 16))


def _draw_numbers(ids: DataFrame, seed: int) -> DataFrame:
    """Adds a repeatable number of 32 bits per draw; each mixing round is one projection."""
    start = F.col("id").bitwiseAND(F.lit(MASK)) + F.shiftright("id", 32) * 31
    drawn = ids.select(
        "id",
        *[
            (start + (seed * 31 + place) * STEP % (MASK + 1)).bitwiseAND(F.lit(MASK)).alias(draw)
            for place, draw in enumerate(DRAWS)
        ],
    )
    for _ in range(2):
        drawn = drawn.select("id", *[(_folded(draw) * FACTOR).bitwiseAND(F.lit(MASK)).alias(draw) for draw in DRAWS])
    return drawn.select("id", *[_folded(draw).alias(draw) for draw in DRAWS])


def _pick(values: list[str], draw: str) -> Column:
    return F.element_at(F.array(*map(F.lit, values)), (F.col(draw) % len(values) + 1).cast("int"))


def synthesize_lines(ids: DataFrame, seed: int = 1) -> DataFrame:
    """Log lines (``id``, ``value``) for a frame with a BIGINT column ``id``.

    ``synthesize_lines(spark.range(1_000_000)).select("value").write.text(path)``
    writes a log of a million lines, in parallel and the same on every run.
    """
    octets = [(F.col(draw) % 256).cast("string") for draw in DRAWS[:4]]
    second = FIRST_SECOND + F.col("second") % (LAST_SECOND - FIRST_SECOND)
    # The sum of twelve uniform draws stands in for a normal variate: mean 5000, deviation 50.
    sizes = sum((F.col(draw) % 1000 for draw in BYTE_DRAWS), F.lit(0))
    size = F.floor((5_000_000 + (sizes - 5994) * 50) / 1000)
    return _draw_numbers(ids, seed).select(
        "id",
        F.concat(
            F.concat_ws(".", *octets),
            F.lit(" - - ["),
            # A 12-hour clock without AM/PM, as the logs this imitates have it.
            F.date_format(F.timestamp_seconds(second + 19800), "dd/MMM/yyyy:hh:mm:ss"),
            F.lit(' +0530] "'),
            _pick(METHODS, "method"),
            F.lit(" "),
            _pick(ENDPOINTS, "endpoint"),
            F.lit(' HTTP/1.0" '),
            _pick(STATUSES, "status"),
            F.lit(" "),
            size.cast("string"),
            F.lit(' "'),
            _pick(REFERRERS, "referrer"),
            F.lit('" "'),
            _pick(AGENTS, "agent"),
            F.lit('" '),
            (F.col("millis") % MAX_MILLIS + 1).cast("string"),
        ).alias("value"),
    )
