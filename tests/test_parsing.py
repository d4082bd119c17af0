from __future__ import annotations

import datetime as dt

import pytest

from tallylog.functions.parsing import FIELDS, parse_access_logs, strip_line, valid_records
from pyspark.sql import functions as F


def line(
    time="10/Oct/2020:13:55:36 +0530", request="GET /a HTTP/1.0", status="200", size="5", ip="1.2.3.4",
    who="- -", referrer="-", agent="UA/1.0", millis="7",
):
    return f'{ip} {who} [{time}] "{request}" {status} {size} "{referrer}" "{agent}" {millis}'


def utc(*parts):
    return dt.datetime(*parts)


VALID = {
    "plain": (line(), {"timestamp_utc": utc(2020, 10, 10, 8, 25, 36), "method": "GET", "endpoint": "/a"}),
    "padded": ("\t " + line() + " \r", {"ip": "1.2.3.4", "response_time_ms": 7}),
    "padded with wide and control space": ("  \x1c" + line() + "\x1f　", {"ip": "1.2.3.4"}),
    "protocol with a space": (line(request="GET /a b HTTP/1.0"), {"endpoint": "/a", "protocol": "B HTTP/1.0"}),
    "quote in the endpoint": (line(request='GET /a"b HTTP/1.0'), {"endpoint": '/a"b'}),
    "query string": (line(request="GET /a?x=1&y=%20 HTTP/1.0"), {"endpoint": "/a?x=1&y=%20"}),
    "lower case": (line(request="patch /a http/2"), {"method": "PATCH", "protocol": "HTTP/2"}),
    "head": (line(request="HEAD /a http/2"), {"method": "HEAD"}),
    "options": (line(request="OPTIONS / http/2"), {"method": "OPTIONS", "endpoint": "/"}),
    "offset with colon": (line(time="10/Oct/2020:13:55:36 +05:30"), {"timestamp_utc": utc(2020, 10, 10, 8, 25, 36)}),
    "offset Z": (line(time="10/Oct/2020:13:55:36 Z"), {"timestamp_utc": utc(2020, 10, 10, 13, 55, 36)}),
    "offset with seconds": (line(time="10/Oct/2020:13:55:36 -00:00:30"), {"timestamp_utc": utc(2020, 10, 10, 13, 56, 6)}),
    "offset beyond 18 hours": (line(time="10/Oct/2020:13:55:36 +2359"), {"timestamp_utc": utc(2020, 10, 9, 13, 56, 36)}),
    "wide gap before the offset": (line(time="10/Oct/2020:13:55:36 \t +0000"), {"timestamp_utc": utc(2020, 10, 10, 13, 55, 36)}),
    "one digit": (line(time="1/Oct/2020:3:5:6 +0000"), {"timestamp_utc": utc(2020, 10, 1, 3, 5, 6)}),
    "blank before one digit": (line(time=" 1/Oct/2020:3:5:6 +0000"), {"timestamp_utc": utc(2020, 10, 1, 3, 5, 6)}),
    "month case": (line(time="1/oCT/2020:03:05:06 +0000"), {"timestamp_utc": utc(2020, 10, 1, 3, 5, 6)}),
    "leap day": (line(time="29/Feb/2020:00:00:00 +0000"), {"timestamp_utc": utc(2020, 2, 29)}),
    "day changes": (line(time="01/Jan/2021:02:00:00 +0530"), {"timestamp_utc": utc(2020, 12, 31, 20, 30)}),
    **{
        f"month {n}": (line(time=f"2/{dt.date(2020, n, 1):%b}/2020:23:59:59 Z"), {"timestamp_utc": utc(2020, n, 2, 23, 59, 59)})
        for n in range(1, 13)
    },
    "newlines and commas in quoted fields": (
        line(request="GET /a h\nx", referrer="\na\n", agent=",\n"), {"protocol": "H\nX", "referrer": "\na\n", "user_agent": ",\n"},
    ),
    "status 100": (line(status="100"), {"status": 100}),
    "status 599": (line(status="599"), {"status": 599}),
    "no bytes": (line(size="-"), {"response_bytes": 0}),
    "zero bytes": (line(size="0"), {"response_bytes": 0}),
    "signed bytes": (line(size="+5"), {"response_bytes": 5}),
    "grouped bytes": (line(size="1_000"), {"response_bytes": 1000}),
    "many bytes": (line(size="9223372036854775807"), {"response_bytes": 9223372036854775807}),
    "dashes": (line(), {"remote_log_name": "", "user_id": "", "referrer": "", "user_agent": "UA/1.0"}),
    "agent dash stays": (line(agent="-"), {"user_agent": "-"}),
    "empty agent and referrer": (line(agent="", referrer=""), {"user_agent": "", "referrer": ""}),
    "names": (line(who="log bob", referrer="http://x"), {"remote_log_name": "log", "user_id": "bob", "referrer": "http://x"}),
    "any address": (line(ip="host.example"), {"ip": "host.example"}),
    "dollar and backslash": (line(request=r"GET /a$1\n HTTP/1.0", agent="$2"), {"endpoint": r"/a$1\n", "user_agent": "$2"}),
}

REJECTED = {
    "empty": ("", "blank"),
    "spaces": (" \t  \x1c", "blank"),
    "no value": (None, "blank"),
    "no response time": (line().rsplit(" ", 1)[0], "pattern"),
    "two spaces": (line().replace(" - - ", " -  - "), "pattern"),
    "wide space inside the address": (line(ip="1.2 3.4"), "pattern"),
    "quote in the agent": (line(agent='a"b'), "pattern"),
    "digits in the method": (line(request="G3T /a HTTP/1.0"), "pattern"),
    "no protocol": (line(request="GET /a"), "pattern"),
    "two-digit status": (line(status="99"), "pattern"),
    "negative time": (line(millis="-1"), "pattern"),
    "32 January": (line(time="32/Jan/2020:00:00:00 +0000"), "timestamp"),
    "31 April": (line(time="31/Apr/2020:00:00:00 +0000"), "timestamp"),
    "29 February 2021": (line(time="29/Feb/2021:00:00:00 +0000"), "timestamp"),
    "day 0": (line(time="00/Jan/2020:00:00:00 +0000"), "timestamp"),
    "year 0": (line(time="01/Jan/0000:00:00:00 +0000"), "timestamp"),
    "before year 1 in UTC": (line(time="01/Jan/0001:00:00:00 +0530"), "timestamp"),
    "after year 9999 in UTC": (line(time="31/Dec/9999:23:00:00 -0530"), "timestamp"),
    "hour 24": (line(time="01/Jan/2020:24:00:00 +0000"), "timestamp"),
    "minute 60": (line(time="01/Jan/2020:00:60:00 +0000"), "timestamp"),
    "second 60": (line(time="01/Jan/2020:00:00:60 +0000"), "timestamp"),
    "two-digit year": (line(time="01/Jan/20:00:00:00 +0000"), "timestamp"),
    "month number": (line(time="01/01/2020:00:00:00 +0000"), "timestamp"),
    "no such month": (line(time="01/Foo/2020:00:00:00 +0000"), "timestamp"),
    "letters of two months": (line(time="01/anF/2020:00:00:00 +0000"), "timestamp"),
    "no offset": (line(time="01/Jan/2020:00:00:00"), "timestamp"),
    "offset of a day": (line(time="01/Jan/2020:00:00:00 +2400"), "timestamp"),
    "offset minutes": (line(time="01/Jan/2020:00:00:00 +0060"), "timestamp"),
    "mixed colons": (line(time="01/Jan/2020:00:00:00 +05:3015"), "timestamp"),
    "lower-case z": (line(time="01/Jan/2020:00:00:00 z"), "timestamp"),
    "blank before two digits": (line(time=" 10/Jan/2020:00:00:00 +0000"), "timestamp"),
    "text after the offset": (line(time="01/Jan/2020:00:00:00 +0000 x"), "timestamp"),
    "trace": (line(request="TRACE /a HTTP/1.0"), "method"),
    "relative endpoint": (line(request="GET a HTTP/1.0"), "endpoint"),
    "full url": (line(request="GET http://x/ HTTP/1.0"), "endpoint"),
    "fractional bytes": (line(size="12.5"), "number"),
    "text bytes": (line(size="many"), "number"),
    "misplaced underscore": (line(size="1__0"), "number"),
    "20 digits": (line(size="9" * 20), "number"),
    "status 099": (line(status="099"), "range"),
    "status 600": (line(status="600"), "range"),
    "negative bytes": (line(size="-5"), "range"),
    "first rule wins": (line(time="x", request="TRACE a HTTP/1.0", status="600"), "timestamp"),
}


@pytest.fixture(scope="module")
def parsed(spark):
    cases = {f"ok {k}": v[0] for k, v in VALID.items()} | {f"bad {k}": v[0] for k, v in REJECTED.items()}
    lines = spark.createDataFrame(list(cases.items()), "name STRING, value STRING")
    return {row["name"]: row.asDict() for row in parse_access_logs(lines).collect()}


@pytest.mark.parametrize("name", VALID)
def test_valid_line(parsed, name):
    row = parsed[f"ok {name}"]
    assert row["is_valid"] and row["reject_reason"] is None
    assert {key: row[key] for key in VALID[name][1]} == VALID[name][1]


@pytest.mark.parametrize("name", REJECTED)
def test_rejected_line(parsed, name):
    row = parsed[f"bad {name}"]
    assert (row["is_valid"], row["reject_reason"]) == (False, REJECTED[name][1])
    assert all(row[field] is None for field in FIELDS)


def test_schema_and_field_selection(spark):
    lines = spark.createDataFrame([(line(),)], "value STRING")
    types = dict(valid_records(parse_access_logs(lines)).dtypes)
    assert list(types) == FIELDS
    assert types["timestamp_utc"] == "timestamp" and types["status"] == "int"
    assert types["response_bytes"] == types["response_time_ms"] == "bigint"
    slim = parse_access_logs(lines, ["method", "ip"])
    assert slim.columns == ["ip", "method", "reject_reason", "is_valid"]


def test_other_session_time_zone_gives_the_same_instant(spark):
    lines = spark.createDataFrame([(line(),)], "value STRING")
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        seconds = parse_access_logs(lines).select(F.unix_seconds("timestamp_utc")).first()[0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert seconds == int(dt.datetime(2020, 10, 10, 8, 25, 36, tzinfo=dt.timezone.utc).timestamp())


def test_strip_line(spark):
    frame = spark.createDataFrame([("\t a b  ",)], "value STRING")
    assert frame.select(strip_line(F.col("value"))).first()[0] == "a b"


NEWLINES = [
    ("foo\nbar", None),
    ("1/Jan/2020:00:00:00 +0000\n\nGET\n/x\n200\n5\n5\n9.9.9.9", None),
    ('1.1.1.1 - - [01/Jan/2020:00:00:00 +0000] "GET /x HTTP\n1.0" 200 5 "r\n" "UA\nX" 7', ("HTTP\n1.0", "r\n", "UA\nX")),
    ('1.1.1" - - [01/Jan/2020:00:00:00 +0000] "GET /x" H" 200 5 "-" "" 7', ("H", "", "")),
]


@pytest.mark.parametrize("line, expected", NEWLINES)
def test_values_with_newlines(spark, line, expected):
    row = parse_access_logs(spark.createDataFrame([(line,)], "value STRING")).first()
    if expected is None:
        assert row["reject_reason"] == "pattern"
    elif row["is_valid"]:
        assert (row["protocol"], row["referrer"], row["user_agent"]) == expected


def test_kept_columns_with_the_names_of_steps(spark):
    line = '1.1.1.1 - - [01/Jan/2020:00:00:00 +0000] "GET /x H" 200 5 "-" "UA" 7'
    names = ["part", "shift", "status", "record", "kept", "line", "joined", "matches", "nothing", "a.b"]
    frame = spark.createDataFrame([(line, *range(len(names)))], ["value", *names])
    parsed = parse_access_logs(frame, ["ip", "method"])
    assert parsed.columns == [*names, "ip", "method", "reject_reason", "is_valid"]
    row = parsed.first()
    assert list(row)[: len(names)] == list(range(len(names))) and row["ip"] == "1.1.1.1" and row["is_valid"]
    # A parsed field replaces a column of its name.
    assert parse_access_logs(frame, ["status"]).first()["status"] == 200
    assert parse_access_logs(frame.select("value"), ["ip"]).columns == ["ip", "reject_reason", "is_valid"]
