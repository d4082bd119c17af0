"""Access-log lines to typed records, as one Spark expression job.

The pattern is matched once per line: the replacement text joins the wanted
groups, and ``split`` takes them apart again. Words, which hold no white space, come first and
end with a newline each; the quoted fields, which hold no quote, are the last part and are joined
by quotes. Single characters are split without a pattern. One ``regexp_extract`` per
field would match every line many times.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The accepted request methods.
METHODS = ["GET", "POST", "PUT", "DELETE", "PATCH", "HEAD", "OPTIONS"]

# The fields of a record.
FIELDS = [
    "ip",
    "remote_log_name",
    "user_id",
    "timestamp_utc",
    "method",
    "endpoint",
    "protocol",
    "status",
    "response_bytes",
    "referrer",
    "user_agent",
    "response_time_ms",
]

WORD_END, QUOTE = "\n", '"'

# The names of months, whose places tell their numbers.
MONTHS = "JAN FEB MAR APR MAY JUN JUL AUG SEP OCT NOV DEC"

# UTC instants from year 1 to year 9999; an offset must not lead out of them.
FIRST_SECOND, LAST_SECOND = -62_135_596_800, 253_402_300_799

# Unicode white space and the four information separators.
_SPACE = r"[\s\x1c-\x1f]"
_WORD = r"[^\s\x1c-\x1f]++"

# day/month/year:hour:minute:second offset. Inside the brackets any other text
# matches too, but leaves these groups empty: such a line has a bad timestamp.
_TIME = (
    r"(?: (?=[1-9]/))?+(?<day>[0-9]{1,2})/(?<month>[A-Za-z]{3})/(?<year>(?!0000)[0-9]{4})"
    r":(?<hour>[01]?[0-9]|2[0-3]):(?<minute>[0-5]?[0-9]):(?<second>[0-5]?[0-9])"
    rf"{_SPACE}++(?:Z|(?<sign>[+-])(?<eh>[01][0-9]|2[0-3])(?<colon>:?)(?<em>[0-5][0-9])"
    r"(?:\k<colon>(?<es>[0-5][0-9]))?)"
)
_LINE = (
    rf"(?U)^{_SPACE}*+(?<ip>{_WORD}) (?<logname>{_WORD}) (?<user>{_WORD}) "
    rf"\[(?:{_TIME}|[^\]]++)\] "
    rf'"(?<method>[A-Za-z]++) (?<endpoint>{_WORD}) (?<protocol>[^"]++)" '
    rf"(?<status>[0-9]{{3}}) (?<bytes>{_WORD}) "
    rf'"(?<referrer>[^"]*+)" "(?<agent>[^"]*+)" (?<millis>[0-9]++){_SPACE}*+$'
)

# Groups by number: looking up ``${name}`` for every group of every line costs a third more.
_GROUP = {name: f"${place}" for place, name in enumerate(re.findall(r"\(\?<(\w+)>", _LINE), 1)}

# What the pattern hands over for each line. The method comes first: see ``matches`` below.
_CHECKED = {
    "method": "{method}",
    "endpoint": "{endpoint}",
    "status": "{status}",
    "bytes": "{bytes}",
    "millis": "{millis}",
    "day": "{day}",
    "month": "{month}",
    "year": "{year}",
    "hour": "{hour}",
    "minute": "{minute}",
    "second": "{second}",
    "offset": "{sign}{eh}{em}{es}",
}
_WORDS = {"ip": "{ip}", "remote_log_name": "{logname}", "user_id": "{user}"}
_QUOTED = {"protocol": "{protocol}", "referrer": "{referrer}", "user_agent": "{agent}"}


def strip_line(line: Column) -> Column:
    """The line without white space at either end (``trim`` would drop spaces only)."""
    return F.regexp_replace(line, rf"(?U)^{_SPACE}++|{_SPACE}++$", "")


def is_blank(line: Column) -> Column:
    return ~F.coalesce(line.rlike(r"(?U)[^\s\x1c-\x1f]"), F.lit(False))


def whole_number(text: Column) -> Column:
    """BIGINT of decimal text with an optional sign and single underscores between digits."""
    grouped = text.rlike(r"^[+-]?[0-9]+(_[0-9]+)+$")
    plain = F.when(text.contains("_"), F.when(grouped, F.translate(text, "_", ""))).otherwise(text)
    return plain.try_cast("bigint")


def dash_to_empty(text: Column) -> Column:
    return F.when(text == "-", F.lit("")).otherwise(text)


def shift_number(offset: Column) -> Column:
    """The digits of ``+hhmm`` or ``+hhmmss`` as the signed number hhmmss; 0 for no text."""
    return F.rpad(offset, 7, "0").try_cast("int")


def utc_instant(text: dict[str, Column], shift: Column) -> Column:
    """TIMESTAMP of the parts of a local log time and its ``shift_number``; NULL if there is no such time.

    The pattern has checked the clock, the cast checks the date. A date parser with a format takes
    several times as long, and knows no offsets beyond 18 hours.
    """
    # No month of this name is month 0, and no date.
    month = F.floor((F.instr(F.lit(MONTHS), F.upper(text["month"])) + 3) / 4)
    date = F.concat_ws("-", text["year"], month.cast("string"), text["day"]).try_cast("date")
    clock = [text[name].try_cast("int") for name in ("hour", "minute", "second")]
    east = (
        (shift / 10000).cast("int") * 3600 + (shift % 10000 / 100).cast("int") * 60 + shift % 100
    )
    seconds = F.unix_date(date).cast("bigint") * 86400 + clock[0] * 3600 + clock[1] * 60 + clock[2] - east
    return F.when(seconds.between(FIRST_SECOND, LAST_SECOND), F.timestamp_seconds(seconds))


def parse_access_logs(
    lines: DataFrame, fields: Sequence[str] = tuple(FIELDS), column: str = "value"
) -> DataFrame:
    """Parse, validate and normalise log lines; bad lines are kept with a reason.

    Returns the other columns of ``lines``, the wanted ``fields`` (NULL where the
    line is rejected), ``reject_reason`` (NULL where it is valid) and ``is_valid``.
    Asking for fewer fields copies less text per line. Of two columns with one name, the
    parsed one stays.
    """
    made = {*fields, "reject_reason", "is_valid", column}
    kept = [F.col(f"`{name}`") for name in lines.columns if name not in made]
    # In a struct of their own, other columns can't be taken for a step's.
    kept = F.struct(*kept or [F.lit(None).cast("string").alias("nothing")]).alias("kept")
    words = _CHECKED | {field: cut for field, cut in _WORDS.items() if field in fields}
    quoted = {field: cut for field, cut in _QUOTED.items() if field in fields}
    line = F.col("line")
    text = {name: F.get(F.col("part"), F.lit(place)) for place, name in enumerate(words)}
    text |= {name: F.get(F.col("quoted"), F.lit(place)) for place, name in enumerate(quoted)}
    # Each step is a projection of its own: later ones use its columns several times,
    # and one huge expression would be too long for the JIT compiler.
    cuts = WORD_END.join([*words.values(), QUOTE.join(quoted.values())]).format_map(_GROUP)
    joined = F.regexp_replace(line, _LINE, cuts)
    matched = lines.select(kept, F.col(column).alias("line")).select("kept", "line", joined.alias("joined"))
    # A line that matches never equals its own joined fields: its first word ends with a space,
    # theirs (the method) with a newline.
    matched = matched.select(
        "kept", "line", (F.col("joined") != line).alias("matches"), F.split("joined", WORD_END, len(words) + 1).alias("part")
    )
    if quoted:
        matched = matched.withColumn("quoted", F.split(F.get(F.col("part"), F.lit(len(words))), QUOTE))
    typed = matched.select(
        "*",
        shift_number(text["offset"]).alias("shift"),
        F.upper(text["method"]).alias("method"),
        text["status"].try_cast("int").alias("status"),
        F.when(text["bytes"] == "-", F.lit(0)).otherwise(whole_number(text["bytes"])).alias("response_bytes"),
        text["millis"].try_cast("bigint").alias("response_time_ms"),
    ).withColumn("timestamp_utc", utc_instant(text, F.col("shift")))
    size, millis = F.col("response_bytes"), F.col("response_time_ms")
    judged = typed.withColumn(
        "reject_reason",
        F.when(line.isNull(), "blank")
        .when(~F.col("matches"), F.when(is_blank(line), "blank").otherwise("pattern"))
        .when(F.col("timestamp_utc").isNull(), "timestamp")
        .when(~F.col("method").isin(METHODS), "method")
        .when(~text["endpoint"].startswith("/"), "endpoint")
        .when(size.isNull() | millis.isNull(), "number")
        .when(~F.col("status").between(100, 599) | (size < 0) | (millis < 0), "range"),
    )
    values = {
        "timestamp_utc": F.col("timestamp_utc"),
        "method": F.col("method"),
        "endpoint": text["endpoint"],
        "status": F.col("status"),
        "response_bytes": size,
        "response_time_ms": millis,
    }
    values |= {field: text[field] for field in [*_WORDS, *_QUOTED] if field in text}
    for field in {"remote_log_name", "user_id", "referrer"} & values.keys():
        values[field] = dash_to_empty(values[field])
    if "protocol" in values:
        values["protocol"] = F.upper(values["protocol"])

    valid = F.col("reject_reason").isNull()
    record = F.struct(
        *[F.when(valid, values[field]).alias(field) for field in FIELDS if field in fields],
        F.col("reject_reason"),
        valid.alias("is_valid"),
    )
    # Later filters are not pushed below a generator. Below a plain projection they
    # are, with the whole pattern match copied into them and done twice per line.
    parsed = judged.select("kept", F.explode(F.array(record)).alias("record")).select("kept.*", "record.*")
    return parsed if len(lines.columns) > len(made.intersection(lines.columns)) else parsed.drop("nothing")


def valid_records(parsed: DataFrame) -> DataFrame:
    return parsed.filter("is_valid").drop("is_valid", "reject_reason")
