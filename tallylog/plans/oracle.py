"""DuckDB SQL for the registered queries, written independently of the Spark plans.

Each statement is a chain of common table expressions up to the one it needs:
log lines, parsed records, minutes, series, smoothing, verdicts.
"""

from __future__ import annotations

from tallylog.plans.catalog import LOW_SIGMA, REQUESTED_WINDOWS, SAMPLE_POINTS, WIDE_WINDOW

# Fixed value: the extended log format, in the syntax of DuckDB's patterns.
_PATTERN = (
    r'^(\S+) (\S+) (\S+) \[([^\]]+)\] "([A-Za-z]+) (\S+) ([^"]+)" '
    r'(\d{3}) (\S+) "([^"]*)" "([^"]*)" (\d+)$'
)

_ISO = "strftime({}, '%Y-%m-%dT%H:%M:%S') || '+00:00'"


def _iso(expression: str) -> str:
    return _ISO.format(expression)


def _iso_number(expression: str) -> str:
    return _iso(f"make_timestamp(({expression}) * 60000000)")


_STEPS: dict[str, str] = {
    "derived": """
        SELECT event_id, user_id, event_type,
            1704067200000000 + (epoch_us(ts) - 1704067200000000) // 20 AS m,
            (epoch_us(ts) - 1704067200000000) // 1200000000 AS mi,
            CASE WHEN event_id % 41 = 0 THEN 'TRACE' WHEN event_type = 'view' THEN 'get'
                WHEN event_type = 'click' THEN 'GET' WHEN event_type = 'purchase' THEN 'POST'
                WHEN event_type = 'signup' THEN 'PUT' ELSE 'DELETE' END AS method,
            CASE WHEN event_id % 47 = 0 THEN 600 WHEN event_id % 73 = 0 THEN 102
                WHEN event_type = 'error' THEN CASE event_id % 3 WHEN 0 THEN 500 WHEN 1 THEN 502 ELSE 503 END
                ELSE CASE event_id % 10 WHEN 0 THEN 404 WHEN 1 THEN 301 WHEN 2 THEN 403 ELSE 200 END
                END AS status,
            CASE WHEN event_id % 61 = 0 THEN 'many' WHEN event_id % 67 = 0 THEN '-5' WHEN event_id % 11 = 0 THEN '-'
                ELSE CAST(CAST(floor(value * 100) AS BIGINT) AS VARCHAR) END AS size
        FROM events""",
    "raw": """
        SELECT event_id, CASE
            WHEN mi BETWEEN 600 AND 619 THEN 'outage ' || event_id
            WHEN event_id % 53 = 0 THEN ''
            WHEN event_id % 37 = 0 THEN 'garbage ' || event_id
            ELSE '10.0.' || (user_id // 256) || '.' || (user_id % 256) || ' - '
                || CASE WHEN user_id % 3 = 0 THEN '-' ELSE 'u' || user_id END || ' ['
                || CASE WHEN event_id % 118 = 0 THEN '31/Feb/2024:10:00:00 +0530' WHEN event_id % 59 = 0 THEN '15/Foo/2024:10:00:00 +0530'
                    WHEN event_id % 7 = 0 THEN strftime(make_timestamp(m) - INTERVAL 480 MINUTE, '%d/%b/%Y:%H:%M:%S') || ' -0800'
                    ELSE strftime(make_timestamp(m) + INTERVAL 330 MINUTE, '%d/%b/%Y:%H:%M:%S') || ' +0530' END || '] "'
                || method || ' ' || CASE WHEN event_id % 43 = 0 THEN '' ELSE '/' END || event_type || '/'
                || (user_id % 20) || ' http/1.0" ' || status || ' ' || size || ' "-" "UA/1.0" '
                || CASE WHEN event_id % 71 = 0 THEN '99999999999999999999' ELSE CAST(event_id % 5000 AS VARCHAR) END
            END AS value
        FROM derived""",
    "cut": f"""
        SELECT event_id, trim(value) AS line,
            regexp_extract(trim(value), '{_PATTERN}', ['ip', 'logname', 'userid', 'ts', 'method', 'endpoint',
                'protocol', 'status', 'size', 'referrer', 'agent', 'millis']) AS g,
            regexp_matches(trim(value), '{_PATTERN}') AS matched
        FROM raw""",
    "typed": """
        SELECT event_id, line, matched, g.ip AS ip, g.logname AS logname, g.userid AS userid,
            try_strptime(g.ts, '%d/%b/%Y:%H:%M:%S %z') AT TIME ZONE 'UTC' AS ts,
            upper(g.method) AS method, g.endpoint AS endpoint, upper(g.protocol) AS protocol,
            TRY_CAST(g.status AS INTEGER) AS status,
            CASE WHEN g.size = '-' THEN 0 ELSE TRY_CAST(g.size AS BIGINT) END AS response_bytes,
            g.referrer AS referrer, g.agent AS user_agent, TRY_CAST(g.millis AS BIGINT) AS response_time_ms
        FROM cut""",
    "judged_lines": """
        SELECT *, CASE
            WHEN line = '' THEN 'blank'
            WHEN NOT matched THEN 'pattern'
            WHEN ts IS NULL THEN 'timestamp'
            WHEN method NOT IN ('GET', 'POST', 'PUT', 'DELETE', 'PATCH', 'HEAD', 'OPTIONS') THEN 'method'
            WHEN NOT starts_with(endpoint, '/') THEN 'endpoint'
            WHEN response_bytes IS NULL OR response_time_ms IS NULL THEN 'number'
            WHEN status NOT BETWEEN 100 AND 599 OR response_bytes < 0 OR response_time_ms < 0 THEN 'range'
            END AS reject_reason
        FROM typed""",
    "valid": """
        SELECT event_id, ip, ts, date_trunc('minute', ts) AS minute, method, endpoint, protocol, status,
            response_bytes, response_time_ms, user_agent,
            CASE WHEN logname = '-' THEN '' ELSE logname END AS remote_log_name,
            CASE WHEN userid = '-' THEN '' ELSE userid END AS user_id,
            CASE WHEN referrer = '-' THEN '' ELSE referrer END AS referrer,
            (status // 100) || 'xx' AS family
        FROM judged_lines WHERE reject_reason IS NULL""",
    "totals": """
        SELECT count(*) AS processed_lines, count(*) FILTER (reject_reason IS NULL) AS valid_lines,
            count(*) FILTER (reject_reason IS NOT NULL) AS invalid_lines,
            CAST(coalesce(sum(response_bytes) FILTER (reject_reason IS NULL), 0) AS BIGINT) AS response_bytes,
            CAST(coalesce(sum(response_time_ms) FILTER (reject_reason IS NULL), 0) AS BIGINT) AS response_time_ms
        FROM judged_lines""",
    "metrics": """
        SELECT *, CASE WHEN processed_lines > 0 THEN valid_lines / processed_lines ELSE 0.0 END AS valid_ratio,
            CASE WHEN valid_lines > 0 THEN response_time_ms / valid_lines ELSE 0.0 END AS average_response_time_ms,
            CASE WHEN valid_lines > 0 THEN response_bytes / valid_lines ELSE 0.0 END AS average_response_bytes
        FROM totals""",
    "minutes": """
        SELECT epoch_us(minute) // 60000000 AS m, count(*) AS requests,
            count(*) FILTER (family = '2xx') AS requests_2xx, count(*) FILTER (family = '3xx') AS requests_3xx,
            count(*) FILTER (family = '4xx') AS requests_4xx, count(*) FILTER (family = '5xx') AS requests_5xx
        FROM valid GROUP BY minute""",
    "gaps": "SELECT m, lead(m) OVER (ORDER BY m) AS next_m FROM minutes",
    "buckets": """
        SELECT m FROM minutes
        UNION SELECT m + 1 FROM gaps WHERE next_m > m + 1
        UNION SELECT next_m - 1 FROM gaps WHERE next_m > m + 1""",
    "trend": """
        SELECT b.m, coalesce(requests, 0) AS requests, coalesce(requests_2xx, 0) AS requests_2xx,
            coalesce(requests_3xx, 0) AS requests_3xx, coalesce(requests_4xx, 0) AS requests_4xx,
            coalesce(requests_5xx, 0) AS requests_5xx, row_number() OVER (ORDER BY b.m) - 1 AS place,
            count(*) OVER () AS places
        FROM buckets b LEFT JOIN minutes c ON b.m = c.m""",
    "bounds": "SELECT min(m) AS first_m, max(m) AS last_m, max(m) - min(m) + 1 AS n FROM minutes",
    "spine": "SELECT unnest(range(n)) AS i, first_m, n FROM bounds",
    "series": """
        SELECT s.i, s.first_m + s.i AS m, s.n, coalesce(c.requests_5xx, 0) AS errors
        FROM spine s LEFT JOIN minutes c ON c.m = s.first_m + s.i""",
}


def _window_sql(requested: str, n: str = "n") -> str:
    odd = f"greatest(5, {requested}) + CASE WHEN greatest(5, {requested}) % 2 = 0 THEN 1 ELSE 0 END"
    return f"CASE WHEN {n} < 3 THEN 0 ELSE least({odd}, CASE WHEN {n} % 2 = 0 THEN {n} - 1 ELSE {n} END) END"


def _smoothing(requested: int) -> dict[str, str]:
    """The steps from the series to the smoothed series, for one requested window."""
    return {
        "params": f"SELECT n, {_window_sql(str(requested))} AS w FROM bounds",
        "weights": """
            SELECT w, w // 2 AS h, k, CASE WHEN w = 3 THEN 1
                    ELSE 3 * (3 * (w // 2) * (w // 2) + 3 * (w // 2) - 1) - 15 * k * k END AS numerator,
                CASE WHEN w = 3 THEN 3 ELSE (w - 2) * w * (w + 2) END AS denominator
            FROM (SELECT w, unnest(range(-(w // 2), w // 2 + 1)) AS k FROM params WHERE w > 0)""",
        "padded": """
            SELECT i, errors FROM series
            UNION ALL SELECT -i, errors FROM series, params WHERE i BETWEEN 1 AND w // 2
            UNION ALL SELECT 2 * (series.n - 1) - i, errors FROM series, params
                WHERE i BETWEEN series.n - 1 - w // 2 AND series.n - 2""",
        "smoothed": """
            SELECT s.i, s.m, s.n, s.errors,
                CAST(sum(c.numerator * p.errors) AS DOUBLE) / CAST(min(c.denominator) AS DOUBLE) AS smoothed
            FROM series s, weights c JOIN padded p ON p.i = s.i + c.k GROUP BY ALL""",
        "residuals": """
            SELECT i, m, n, errors, greatest(0.0, smoothed) AS baseline,
                errors - greatest(0.0, smoothed) AS residual
            FROM smoothed""",
        "center": """
            SELECT (min(residual) + max(residual)) / 2 AS median FROM (
                SELECT residual, row_number() OVER (ORDER BY residual) AS place, count(*) OVER () AS total
                FROM residuals) WHERE place IN ((total + 1) // 2, total // 2 + 1)""",
        "spread": """
            SELECT (min(deviation) + max(deviation)) / 2 AS mad FROM (
                SELECT abs(residual - median) AS deviation,
                    row_number() OVER (ORDER BY abs(residual - median)) AS place, count(*) OVER () AS total
                FROM residuals, center) WHERE place IN ((total + 1) // 2, total // 2 + 1)""",
        "scales": """
            SELECT points, CASE WHEN 1.4826::DOUBLE * mad > 0 THEN 1.4826::DOUBLE * mad ELSE deviation END
                AS robust_scale
            FROM spread, (SELECT stddev_pop(residual) AS deviation, count(*) AS points FROM residuals)""",
    }


def _verdicts(sigma: float) -> dict[str, str]:
    return {
        "points": f"""
            SELECT i, m, n, errors, baseline, residual, residual / greatest(robust_scale, 1.0::DOUBLE) AS score,
                greatest(baseline + {sigma}::DOUBLE * greatest(robust_scale, 1.0::DOUBLE), 3.0::DOUBLE) AS threshold
            FROM residuals, scales""",
        "verdicts": "SELECT *, errors >= 3 AND errors >= threshold AND residual > 0 AS is_anomaly FROM points",
        "sampled": f"""
            SELECT *, row_number() OVER (ORDER BY i) - 1 AS place, count(*) OVER () AS places FROM verdicts v
            WHERE n <= {SAMPLE_POINTS} OR i % CAST(ceil(n / {SAMPLE_POINTS}) AS BIGINT) = 0
                OR EXISTS (SELECT 1 FROM verdicts a WHERE a.is_anomaly AND v.i BETWEEN a.i - 2 AND a.i + 2)""",
        "plotted": f"""
            SELECT * FROM sampled
            WHERE places <= {SAMPLE_POINTS // 2} OR place % greatest(1, places // {SAMPLE_POINTS // 2}) = 0
                OR place = places - 1 OR is_anomaly""",
    }


def _sql(query: str, window: int = 5, sigma: float = 2.0) -> str:
    steps = _STEPS | _smoothing(window) | _verdicts(sigma)
    shared = {"judged_lines", "minutes", "series", "padded", "residuals", "verdicts", "sampled"}
    chain = ",\n".join(
        f"{name} AS {'MATERIALIZED ' if name in shared else ''}({body})" for name, body in steps.items()
    )
    return f"WITH {chain}\n{query}"


def _by_endpoint(query: str) -> str:
    """A query over the detection within each endpoint, worked out on every minute of every endpoint."""
    steps = {
        "e_minutes": """SELECT endpoint, epoch_us(minute) // 60000000 AS m, count(*) FILTER (status BETWEEN 500 AND 599) AS errors
            FROM valid GROUP BY ALL""",
        "e_bounds": "SELECT endpoint, min(m) AS first_m, max(m) - min(m) + 1 AS n FROM e_minutes GROUP BY endpoint",
        "e_params": f"SELECT *, {_window_sql('5')} AS w FROM e_bounds",
        "e_series": """SELECT s.endpoint, s.i, s.first_m, s.n, s.w, coalesce(c.errors, 0) AS errors
            FROM (SELECT *, unnest(range(n)) AS i FROM e_params) s
            LEFT JOIN e_minutes c ON c.endpoint = s.endpoint AND c.m = s.first_m + s.i""",
        "e_weights": """SELECT w, k, CASE WHEN w = 3 THEN 1 ELSE 3 * (3 * (w // 2) * (w // 2) + 3 * (w // 2) - 1) - 15 * k * k END AS numerator,
                CASE WHEN w = 3 THEN 3 ELSE (w - 2) * w * (w + 2) END AS denominator
            FROM (SELECT w, unnest(range(-(w // 2), w // 2 + 1)) AS k FROM (SELECT DISTINCT w FROM e_params WHERE w > 0))""",
        "e_taps": """SELECT s.endpoint, s.i, s.first_m, s.n, s.errors, c.numerator, c.denominator,
                CASE WHEN s.i + c.k < 0 THEN -(s.i + c.k) WHEN s.i + c.k > s.n - 1 THEN 2 * (s.n - 1) - s.i - c.k ELSE s.i + c.k END AS j
            FROM e_series s JOIN e_weights c ON c.w = s.w""",
        "e_smoothed": """SELECT t.endpoint, t.i, t.first_m, t.n, t.errors,
                CAST(sum(t.numerator * p.errors) AS DOUBLE) / CAST(min(t.denominator) AS DOUBLE) AS smoothed
            FROM e_taps t JOIN e_series p ON p.endpoint = t.endpoint AND p.i = t.j GROUP BY ALL
            UNION ALL SELECT endpoint, i, first_m, n, errors, errors FROM e_series WHERE w = 0""",
        "e_residuals": """SELECT *, greatest(0.0, smoothed) AS baseline, errors - greatest(0.0, smoothed) AS residual FROM e_smoothed""",
        "e_center": "SELECT endpoint, median(residual) AS middle, stddev_pop(residual) AS deviation FROM e_residuals GROUP BY endpoint",
        "e_scales": """SELECT endpoint, greatest(1.0::DOUBLE, CASE WHEN median(abs(residual - middle)) > 0
                THEN 1.4826::DOUBLE * median(abs(residual - middle)) ELSE min(deviation) END) AS scale
            FROM e_residuals JOIN e_center USING (endpoint) GROUP BY endpoint""",
        "e_points": f"""SELECT *, residual / scale AS score, greatest(baseline + {LOW_SIGMA}::DOUBLE * scale, 3.0::DOUBLE) AS threshold
            FROM e_residuals JOIN e_scales USING (endpoint)""",
    }
    shared = {"judged_lines", "e_minutes", "e_params", "e_series", "e_taps", "e_residuals"}
    chain = ",\n".join(
        f"{name} AS {'MATERIALIZED ' if name in shared else ''}({body})" for name, body in (_STEPS | steps).items()
    )
    return f"WITH {chain}\n{query}"


def _count(key: str, where: str = "true") -> str:
    return f"SELECT {key}, count(*) AS count FROM valid WHERE {where} GROUP BY {key}"


def _top(key: str, n: int, where: str = "true") -> str:
    return (
        f"SELECT CAST({key} AS VARCHAR) AS {key}, count(*) AS count FROM valid WHERE {where} "
        f"GROUP BY {key} ORDER BY count DESC, CAST({key} AS VARCHAR) LIMIT {n}"
    )


_POINT_COLUMNS = f"{_iso_number('m')} AS minute, errors, baseline, threshold, is_anomaly"
_SUMS = (
    "count(*) AS lines, CAST(sum(response_bytes) AS BIGINT) AS response_bytes, "
    "CAST(sum(response_time_ms) AS BIGINT) AS response_time_ms"
)
_ROLLUP = f"""
    SELECT 'method_status' AS dim, method AS label, CAST(status AS BIGINT) AS number, {_SUMS} FROM valid GROUP BY ALL
    UNION ALL SELECT 'method_status', NULL, NULL, count(*), 0, 0
        FROM judged_lines WHERE reject_reason IS NOT NULL HAVING count(*) > 0
    UNION ALL SELECT 'endpoint', endpoint, CAST(status >= 400 AS BIGINT) AS number, count(*), 0, 0 FROM valid GROUP BY ALL
    UNION ALL SELECT 'ip', ip, 0, count(*), 0, 0 FROM valid GROUP BY ip
    UNION ALL SELECT 'minute', family, epoch_us(minute) // 60000000 AS number, count(*), 0, 0 FROM valid GROUP BY ALL"""

_TOP_TABLES = {
    "top_ips": ("ip", _top("ip", 10)),
    "top_endpoints": ("endpoint", _top("endpoint", 10)),
    "top_error_endpoints": ("endpoint", _top("endpoint", 10, "status >= 400")),
    "status_codes": ("status", _top("status", 1000)),
    "methods": ("method", _top("method", 1000)),
}


_RUN_SPEEDUP = """
        WITH runs AS (SELECT o_orderkey AS pos, greatest(1, o_custkey % 16) AS workers,
                o_totalprice AS duration_seconds, o_orderkey AS processed_lines FROM orders),
            firsts AS (SELECT * FROM runs
                QUALIFY row_number() OVER (PARTITION BY workers ORDER BY pos) = 1),
            base AS (SELECT duration_seconds AS d FROM runs ORDER BY pos LIMIT 1)
        SELECT CAST(workers AS INTEGER) AS workers, pos, duration_seconds, processed_lines,
            CASE WHEN duration_seconds = 0 THEN 1.0 ELSE d / duration_seconds END AS speedup_vs_first_run
        FROM firsts, base"""


def _csv_tables() -> str:
    parts = []
    numbers = ["duration_seconds", "speedup_vs_first_run", "savgol_baseline", "residual", "residual_score", "threshold"]
    none = ", ".join(f"CAST(NULL AS DOUBLE) AS {name}" for name in numbers)
    for name, (key, query) in _TOP_TABLES.items():
        parts.append(f'SELECT \'{name}\' AS "table", {key} AS key, count, {none} FROM ({query})')
    parts.append(f"SELECT 'hourly_trends', {_iso_number('m')}, requests, {none} FROM trend")
    parts.append(
        f"SELECT 'anomalies', {_iso_number('m')}, errors, NULL, NULL, round(baseline, 2), round(residual, 2), round(score, 2), "
        "round(threshold, 2) FROM verdicts WHERE is_anomaly"
    )
    parts.append(
        "SELECT 'benchmark', CAST(workers AS VARCHAR), processed_lines, round(duration_seconds, 4), round(speedup_vs_first_run, 4), "
        f"NULL, NULL, NULL, NULL FROM ({_RUN_SPEEDUP})"
    )
    return "\nUNION ALL ".join(parts)


def _summary() -> str:
    scalars = {
        "config": {"top_n": "10", "anomaly_window": "5", "anomaly_sigma": "2.0"},
        "metrics": {
            "processed_lines": "processed_lines",
            "valid_lines": "valid_lines",
            "invalid_lines": "invalid_lines",
            "valid_ratio": "round(valid_ratio, 4)",
            "average_response_time_ms": "round(average_response_time_ms, 2)",
            "average_response_bytes": "round(average_response_bytes, 2)",
        },
        "anomaly_detection": {
            "window_length": "(SELECT w FROM params)",
            "polyorder": "(SELECT CASE w WHEN 0 THEN 0 WHEN 3 THEN 1 ELSE 2 END FROM params)",
            "sigma": "2.0",
            "residual_scale": "(SELECT round(greatest(robust_scale, 1.0), 4) FROM scales)",
            "min_error_count": "3",
            "points": "(SELECT count(*) FROM verdicts)",
            "anomalies": "(SELECT count(*) FROM verdicts WHERE is_anomaly)",
        },
    }
    parts = [
        f"SELECT '{section}' AS section, 0 AS place, '{key}' AS key, CAST({value} AS DOUBLE) AS value FROM metrics"
        for section, entries in scalars.items()
        for key, value in entries.items()
    ]
    for name, (key, query) in _TOP_TABLES.items():
        parts.append(
            f"SELECT '{name}', CAST(row_number() OVER (ORDER BY count DESC, {key}) AS INTEGER), {key}, "
            f"CAST(count AS DOUBLE) FROM ({query})"
        )
    datasets = {name: f"({query})" for name, (_, query) in _TOP_TABLES.items()}
    datasets |= {
        "hourly_trends": "trend",
        "status_family_trends": "(SELECT 1 FROM trend, range(4))",
        "anomalies": "(SELECT 1 FROM verdicts WHERE is_anomaly)",
        "anomaly_series": """(SELECT 1 FROM verdicts v WHERE n <= 1200 OR i % CAST(ceil(n / 1200) AS BIGINT) = 0
            OR EXISTS (SELECT 1 FROM verdicts a WHERE a.is_anomaly AND v.i BETWEEN a.i - 2 AND a.i + 2))""",
    }
    for name, rows in datasets.items():
        parts.append(f"SELECT 'datasets', 0, '{name}', CAST(count(*) AS DOUBLE) FROM {rows}")
    return "\nUNION ALL ".join(parts)


def _synthetic() -> str:
    names = ["o1", "o2", "o3", "o4", "second", "method", "endpoint", "status", "referrer", "agent", "millis"]
    names += [f"byte{n}" for n in range(12)]
    mask = 2**32 - 1

    def stage(expression: str) -> str:
        return ", ".join(f"{expression.replace('#', name)} AS {name}" for name in names)

    start = ", ".join(
        f"((id & {mask}) + (id >> 32) * 31 + {(31 + place) * 2654435769 % 2**32}) & {mask} AS {name}"
        for place, name in enumerate(names)
    )
    mixed = stage(f"(xor(#, # >> 16) * 73244475) & {mask}")

    def pick(values: list[str], name: str) -> str:
        listed = ", ".join(f"'{value}'" for value in values)
        return f"[{listed}][{name} % {len(values)} + 1]"

    second = "1514788200 + second % 63072000"
    sizes = " + ".join(f"byte{n} % 1000" for n in range(12))
    agent = "(agent % 10 + 1)"
    parts = [
        "(o1 % 256) || '.' || (o2 % 256) || '.' || (o3 % 256) || '.' || (o4 % 256)",
        "' - - ['",
        f"strftime(make_timestamp(({second} + 19800) * 1000000), '%d/%b/%Y:%I:%M:%S')",
        "' +0530] \"'",
        pick(["GET", "POST", "PUT", "DELETE"], "method"),
        "' '",
        pick(["/usr", "/usr/admin", "/usr/admin/developer", "/usr/login", "/usr/register"], "endpoint"),
        "' HTTP/1.0\" '",
        pick(["303", "404", "500", "403", "502", "304", "200"], "status"),
        "' '",
        f"CAST((5000000 + ({sizes} - 5994) * 50) // 1000 AS VARCHAR)",
        "' \"'",
        pick(["-", "https://www.example.org/start"], "referrer"),
        "'\" \"'",
        f"'ExampleBrowser/' || {agent} || '.0 (build ' || ({agent} * 17) || ')'",
        "'\" '",
        "CAST(millis % 5000 + 1 AS VARCHAR)",
    ]
    return (
        f"WITH s0 AS (SELECT id, {start} FROM (SELECT event_id AS id FROM events)), "
        f"s1 AS (SELECT id, {mixed} FROM s0), s2 AS (SELECT id, {mixed} FROM s1), "
        f"s3 AS (SELECT id, {stage('xor(#, # >> 16)')} FROM s2) "
        f"SELECT id, {' || '.join(parts)} AS value FROM s3"
    )


_TREND_SAMPLE = (
    f"(places <= {SAMPLE_POINTS} OR place % greatest(1, places // {SAMPLE_POINTS}) = 0 OR place = places - 1)"
)
_TREND_LINES = {"all": "requests"} | {family: f"requests_{family}" for family in ("2xx", "3xx", "4xx", "5xx")}

_FIELDS = """ip, remote_log_name, user_id, {ts} AS timestamp_utc, method, endpoint, protocol, status,
    response_bytes, referrer, user_agent, response_time_ms"""
_NULL_FIELDS = ", ".join(["NULL"] * 12)

ORACLE_SQL: dict[str, str] = {
    "source_files": _sql(
        "SELECT event_id % 4 AS shard, CASE event_id % 4 WHEN 1 THEN 0 WHEN 0 THEN 3 ELSE 2 END AS position, "
        "CAST(sum(strlen(value) + 1) AS BIGINT) AS bytes FROM raw GROUP BY ALL"
    ),
    "raw_line_count": _sql(
        "SELECT count(*) AS lines, count(*) FILTER (trim(value) = '') AS blank_lines FROM raw"
    ),
    "synth_access_logs": _synthetic(),
    "reject_blank": _sql("SELECT event_id, trim(value) AS line FROM raw WHERE trim(value) <> ''"),
    "parse_access_logs": _sql(
        f"SELECT event_id, {_FIELDS.format(ts=_iso('ts'))}, NULL AS reject_reason FROM valid "
        f"UNION ALL SELECT event_id, {_NULL_FIELDS}, reject_reason FROM judged_lines WHERE reject_reason IS NOT NULL"
    ),
    "parse_timestamps": _sql("SELECT event_id, epoch_us(ts) // 1000000 AS epoch_seconds FROM valid"),
    "valid_methods": _sql("SELECT event_id, method FROM valid"),
    "valid_endpoints": _sql("SELECT event_id, endpoint FROM valid"),
    "typed_fields": _sql("SELECT event_id, status, response_bytes, response_time_ms FROM valid"),
    "bytes_dash_to_zero": _sql(
        "SELECT count(*) FILTER (response_bytes = 0) AS empty_responses, "
        "count(*) FILTER (response_bytes > 0) AS sized_responses FROM valid"
    ),
    "valid_ranges": _sql(
        "SELECT event_id, CASE WHEN reject_reason IS NULL THEN status END AS status, "
        "reject_reason IS NULL AS is_valid FROM judged_lines WHERE coalesce(reject_reason, 'range') = 'range'"
    ),
    "dash_to_empty": _sql(
        "SELECT remote_log_name, user_id, referrer, user_agent, count(*) AS count FROM valid GROUP BY ALL"
    ),
    "protocol_counts": _sql(_count("protocol")),
    "reject_reasons": _sql(
        "SELECT reject_reason, count(*) AS count FROM judged_lines WHERE reject_reason IS NOT NULL GROUP BY ALL"
    ),
    "minute_bucket": _sql(f"SELECT event_id, {_iso('minute')} AS minute FROM valid"),
    "status_family": _sql(_count("family")),
    "line_counts": _sql("SELECT processed_lines, valid_lines, invalid_lines FROM totals"),
    "traffic_totals": _sql("SELECT response_bytes, response_time_ms FROM totals"),
    "traffic_averages": _sql("SELECT average_response_time_ms, average_response_bytes FROM metrics"),
    "valid_ratio": _sql("SELECT valid_ratio FROM metrics"),
    "method_counts": _sql(_count("method")),
    "status_code_counts": _sql(_count("status")),
    "endpoint_counts": _sql(_count("endpoint")),
    "ip_counts": _sql(_count("ip")),
    "error_endpoint_counts": _sql(_count("endpoint", "status >= 400")),
    "requests_per_minute": _sql(f"SELECT {_iso_number('m')} AS minute, requests AS count FROM minutes"),
    "status_family_per_minute": _sql(
        f"SELECT {_iso_number('m')} AS minute, requests, requests_2xx, requests_3xx, requests_4xx, requests_5xx "
        "FROM minutes"
    ),
    "error_5xx_per_minute": _sql(
        f"SELECT {_iso('minute')} AS minute, count(*) AS count FROM valid "
        "WHERE status BETWEEN 500 AND 599 GROUP BY valid.minute"
    ),
    "merge_rollups": _sql(_ROLLUP),
    "multi_key_rollup": _sql(_ROLLUP),
    **{name: _sql(query) for name, (_, query) in _TOP_TABLES.items()},
    "trend_buckets": _sql(f"SELECT {_iso_number('m')} AS minute FROM trend"),
    "request_trend": _sql(f"SELECT {_iso_number('m')} AS hour, requests FROM trend"),
    "status_family_trends": _sql(
        "\nUNION ALL ".join(
            f"SELECT {_iso_number('m')} AS minute, '{family}' AS family, requests_{family} AS requests FROM trend"
            for family in ("2xx", "3xx", "4xx", "5xx")
        )
    ),
    "minute_spine": _sql(f"SELECT i, {_iso_number('first_m + i')} AS minute FROM spine"),
    "error_series_zero_filled": _sql(f"SELECT i, {_iso_number('m')} AS minute, errors FROM series"),
    "savgol_window_params": _sql(
        "SELECT n AS points, window_length, CAST(CASE window_length WHEN 0 THEN 0 WHEN 3 THEN 1 ELSE 2 END AS BIGINT) AS polyorder, "
        f"requested FROM (SELECT n, requested, {_window_sql('requested')} AS window_length "
        f"FROM bounds, (SELECT unnest({REQUESTED_WINDOWS}::BIGINT[]) AS requested))"
    ),
    "savgol_coefficients": _sql(
        "SELECT w AS window_length, k, numerator, denominator, numerator / denominator AS weight FROM weights",
        WIDE_WINDOW,
    ),
    "reflect_pad": _sql("SELECT i, errors FROM padded", WIDE_WINDOW),
    "savgol_smooth": _sql("SELECT i, errors, smoothed FROM smoothed", WIDE_WINDOW),
    "error_runs": _sql(
        "SELECT i AS start, 1::BIGINT AS length, errors FROM series WHERE errors > 0 UNION ALL "
        "SELECT min(i), count(*), 0 FROM (SELECT i, i - row_number() OVER (ORDER BY i) AS gap FROM series WHERE errors = 0) GROUP BY gap"
    ),
    "endpoint_frames": _by_endpoint(
        f"SELECT endpoint, {_iso_number('first_m')} AS first_minute, n AS points, w AS window_length, "
        "CAST(CASE w WHEN 0 THEN 0 WHEN 3 THEN 1 ELSE 2 END AS BIGINT) AS polyorder, round(scale, 9) AS residual_scale "
        "FROM e_params JOIN e_scales USING (endpoint)"
    ),
    "endpoint_detection": _by_endpoint(
        f"SELECT endpoint, {_iso_number('first_m + i')} AS minute, errors, baseline, residual, round(threshold, 9) AS threshold, "
        "round(score, 9) AS score, errors >= 3 AND errors >= threshold AND residual > 0 AS is_anomaly FROM e_points WHERE errors > 0"
    ),
    "error_baseline": _sql("SELECT i, errors, baseline FROM residuals"),
    "error_residuals": _sql("SELECT i, errors, baseline, residual FROM residuals"),
    "residual_median": _sql("SELECT (SELECT count(*) FROM residuals) AS points, median FROM center"),
    "residual_scale": _sql(
        "SELECT points, round(robust_scale, 9) AS robust_scale, "
        "round(greatest(robust_scale, 1.0::DOUBLE), 9) AS residual_scale FROM scales"
    ),
    "anomaly_thresholds": _sql("SELECT i, errors, threshold, is_anomaly FROM verdicts"),
    "anomalies": _sql(
        f"SELECT {_iso_number('m')} AS minute, errors, baseline, residual, score, threshold "
        "FROM verdicts WHERE is_anomaly"
    ),
    "anomaly_detection_meta": _sql(
        "SELECT 'Savitzky-Golay' AS method, '5xx errors per minute' AS metric, w AS window_length, "
        "CAST(CASE w WHEN 0 THEN 0 WHEN 3 THEN 1 ELSE 2 END AS BIGINT) AS polyorder, 2.0::DOUBLE AS sigma, "
        "greatest(robust_scale, 1.0::DOUBLE) AS residual_scale, 3::BIGINT AS min_error_count, points, "
        "(SELECT count(*) FROM verdicts WHERE is_anomaly) AS anomalies FROM params, scales"
    ),
    "anomaly_series_sampled": _sql(f"SELECT {_POINT_COLUMNS} FROM sampled"),
    "trend_sampled": _sql(
        f"SELECT {_iso_number('m')} AS minute, requests, requests_2xx, requests_3xx, requests_4xx, requests_5xx "
        f"FROM trend WHERE {_TREND_SAMPLE}"
    ),
    "anomaly_plot_points": _sql(f"SELECT {_POINT_COLUMNS} FROM plotted"),
    "anomaly_overlay": _sql(f"SELECT {_iso_number('m')} AS minute, errors FROM plotted WHERE is_anomaly"),
    "anomalies_first_page": _sql(
        f"SELECT {_iso_number('m')} AS minute, errors, baseline, residual, score, threshold, "
        "count(*) OVER () AS total FROM verdicts WHERE is_anomaly ORDER BY m LIMIT 25",
        sigma=LOW_SIGMA,
    ),
    "chart_bars": _sql(
        "SELECT CAST(row_number() OVER (ORDER BY count, endpoint DESC) AS INTEGER) AS place, endpoint AS key, count "
        f"FROM ({_TOP_TABLES['top_error_endpoints'][1]})"
    ),
    "chart_status_share": _sql(
        f"SELECT status AS key, count, count / sum(count) OVER () AS share FROM ({_TOP_TABLES['status_codes'][1]})"
    ),
    "chart_trend_lines": _sql(
        "\nUNION ALL ".join(
            f"SELECT {_iso_number('m')} AS minute, '{line}' AS line, {column} AS requests FROM trend WHERE {_TREND_SAMPLE}"
            for line, column in _TREND_LINES.items()
        )
    ),
    "chart_anomaly_lines": _sql(
        "\nUNION ALL ".join(
            f"SELECT {_iso_number('m')} AS minute, '{line}' AS line, CAST({line} AS DOUBLE) AS value FROM plotted"
            for line in ("errors", "baseline", "threshold")
        )
    ),
    "run_speedup": _RUN_SPEEDUP,
    "report_metrics": _sql("SELECT * FROM metrics"),
    "report_summary": _sql(_summary()),
    "report_csv_tables": _sql(_csv_tables()),
}
