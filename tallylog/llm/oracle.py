"""DuckDB SQL for the queries of this package that SQL can express."""

from __future__ import annotations

from tallylog.llm.chat import FRAMES
from tallylog.llm.licenses import KNOWN, SENTENCE, SPELLINGS

_OP2 = r"""
WITH docs AS (
    SELECT row_number() OVER () AS rid, doc_id, lang, source, coalesce(text, '') AS text,
        regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
    FROM documents
), windows AS (
    SELECT rid, k, words[k] || ' ' || words[k + 1] || ' ' || words[k + 2] AS w
    FROM (SELECT rid, words, unnest(range(1, len(words) - 1)) AS k FROM docs)
), twice AS (
    SELECT rid, k FROM windows QUALIFY count(*) OVER (PARTITION BY rid, w) > 1
), repeats AS (
    SELECT rid, count(DISTINCT k + d) AS n FROM twice, (VALUES (0), (1), (2)) AS t(d) GROUP BY rid
), lines AS (
    SELECT rid, count(*) AS n, count(DISTINCT line) AS n_distinct
    FROM (SELECT rid, unnest(string_split(text, chr(10))) AS line FROM docs)
    WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY rid
), measures AS (
    SELECT doc_id, lang, source, CAST(len(words) AS BIGINT) AS n_words,
        CAST(length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
        CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
        coalesce(lines.n - lines.n_distinct, 0) AS n_dup_lines, coalesce(repeats.n, 0) AS n_repeat_words,
        coalesce(lines.n, 0) AS n_lines, length(text) - length(regexp_replace(text, '[A-Z]', '', 'g')) AS n_upper
    FROM docs LEFT JOIN repeats USING (rid) LEFT JOIN lines USING (rid)
), judged AS (
    SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
        CASE WHEN n_words > 0 THEN {
            'word_length': 1000 * word_chars // n_words, 'symbols': 1000 * n_symbols // n_words,
            'dup_lines': 1000 * n_dup_lines // n_lines, 'repeats': 1000 * n_repeat_words // n_words,
            'capitals': 1000 * n_upper // n_words} END AS m
    FROM measures
), long AS (
    SELECT lang, source, unnest([
        {'rule': 'word_length', 'value': m.word_length}, {'rule': 'symbols', 'value': m.symbols},
        {'rule': 'dup_lines', 'value': m.dup_lines}, {'rule': 'repeats', 'value': m.repeats},
        {'rule': 'capitals', 'value': m.capitals}], recursive := true)
    FROM judged WHERE NOT base_failed
), levels AS (
    SELECT 0 AS level, lang, source, rule, value FROM long
    UNION ALL SELECT 1, lang, NULL, rule, value FROM long
    UNION ALL SELECT 2, NULL, NULL, rule, value FROM long
), floors AS (
    SELECT level, lang, source, rule, CASE WHEN value < 64 THEN value
        ELSE (value >> (length(bin(value)) - 6)) << (length(bin(value)) - 6) END AS value FROM levels
), ranked AS (
    SELECT *, row_number() OVER w AS r, count(*) OVER (PARTITION BY level, lang, source, rule) AS docs
    FROM floors WINDOW w AS (PARTITION BY level, lang, source, rule ORDER BY value)
), quartiles AS (
    SELECT level, lang, source, rule, docs, min(value) FILTER (4 * r >= docs) AS q1,
        min(value) FILTER (4 * r >= 3 * docs) AS q3
    FROM ranked GROUP BY ALL
), bounds AS (
    SELECT g.lang, g.source, q.rule, arg_min(q.q1, q.level) AS q1, arg_min(q.q3, q.level) AS q3
    FROM (SELECT DISTINCT lang, source FROM quartiles WHERE level = 0) g JOIN quartiles q
        ON q.level = 2 OR q.docs >= 200 AND g.lang IS NOT DISTINCT FROM q.lang
            AND (q.level = 1 OR g.source IS NOT DISTINCT FROM q.source)
    GROUP BY ALL
), fences AS (
    SELECT lang, source, rule, q3 + 3 * greatest(q3 - q1, width) AS high,
        CASE WHEN rule = 'word_length' THEN q1 - 3 * greatest(q3 - q1, width) ELSE -1 END AS low
    FROM bounds JOIN (VALUES ('word_length', 200), ('symbols', 30), ('dup_lines', 150), ('repeats', 120),
        ('capitals', 300)) AS t(rule, width) USING (rule)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    CASE WHEN base_failed THEN FALSE ELSE
        m.word_length BETWEEN f.word_length.low - 40000 // n_words AND f.word_length.high + 40000 // n_words
        AND m.symbols <= f.symbols.high + 2000 // n_words
        AND m.dup_lines <= f.dup_lines.high
        AND m.repeats <= f.repeats.high + 12000 // n_words
        AND m.capitals <= f.capitals.high + 20000 // n_words
    END AS kept
FROM judged j LEFT JOIN (
    PIVOT (SELECT lang, source, rule, {'low': low, 'high': high} AS f FROM fences)
    ON rule IN ('word_length', 'symbols', 'dup_lines', 'repeats', 'capitals') USING first(f) GROUP BY lang, source
) f ON j.lang IS NOT DISTINCT FROM f.lang AND j.source IS NOT DISTINCT FROM f.source
"""


_OP6 = r"""
WITH RECURSIVE docs AS (
    SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS n_tokens
    FROM documents
), totals AS (
    SELECT source, CAST(sum(n_tokens) AS DOUBLE) AS tokens, count(*) AS docs, CAST(ceil(count(*) / 1024.0) AS BIGINT) AS blocks
    FROM docs GROUP BY source
), rel AS (
    SELECT tokens / max(tokens) OVER () AS t, count(*) OVER () AS k, max(tokens) OVER () / min(tokens) OVER () AS r
    FROM totals WHERE tokens > 0
), spread(step, a) AS (  -- the largest exponent whose weights reach 0.95 of the largest entropy, in 2^-24
    SELECT 24, 0
    UNION ALL
    SELECT step - 1, CASE WHEN ln(sum(pow(t, (a + (1 << (step - 1))) / 16777216.0::DOUBLE)))
        - (a + (1 << (step - 1))) / 16777216.0::DOUBLE * sum(pow(t, (a + (1 << (step - 1))) / 16777216.0::DOUBLE) * ln(t))
            / sum(pow(t, (a + (1 << (step - 1))) / 16777216.0::DOUBLE)) >= 0.95 * ln(any_value(k))
        THEN a + (1 << (step - 1)) ELSE a END
    FROM spread, rel WHERE step > 0 GROUP BY step, a
), few(step, a) AS (  -- the largest one that repeats the smallest source more than 4 times
    SELECT 24, 0
    UNION ALL
    SELECT step - 1, CASE WHEN pow(any_value(r), 1 - (a + (1 << (step - 1))) / 16777216.0::DOUBLE) > 4
        THEN a + (1 << (step - 1)) ELSE a END
    FROM few, rel WHERE step > 0 GROUP BY step, a
), whole AS (
    SELECT -sum(t / z * ln(t / z)) >= 0.95 * ln(any_value(k)) AS flat, any_value(r) <= 4 AS fine
    FROM rel, (SELECT sum(t) AS z FROM rel)
), exponent AS (
    SELECT greatest(CASE WHEN (SELECT flat FROM whole) THEN 16777216 ELSE (SELECT a FROM spread WHERE step = 0) END,
        CASE WHEN pow((SELECT any_value(r) FROM rel), 1) <= 4 THEN 0 ELSE (SELECT a FROM few WHERE step = 0) + 1 END)
        / 16777216.0::DOUBLE AS a
), sources AS (
    SELECT source, blocks, tokens, CASE WHEN tokens > 0 THEN
        CAST(floor((pow(tokens / max(tokens) OVER (), a - 1) - 1) * tokens + 0.001) AS BIGINT) ELSE 0 END AS extra
    FROM totals, exponent
), epochs AS (
    SELECT source, blocks, CASE WHEN tokens > 0 THEN extra // CAST(tokens AS BIGINT) ELSE 0 END AS epochs,
        CASE WHEN tokens > 0 THEN extra % CAST(tokens AS BIGINT) ELSE 0 END AS rest FROM sources
), shuffled AS (
    SELECT *, md5('7|block|' || coalesce(source, '') || '|' || block) AS by_block FROM (
        SELECT d.doc_id, d.source, n_tokens, epochs, rest,
            md5('7|' || coalesce(d.source, '') || '|' || coalesce(CAST(doc_id AS VARCHAR), '')) AS by_doc,
            CAST('0x' || substr(md5('7|' || coalesce(d.source, '') || '|' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT)
                % blocks AS block
        FROM docs d JOIN epochs e ON d.source IS NOT DISTINCT FROM e.source)
), placed AS (
    SELECT *, sum(n_tokens) OVER (PARTITION BY source ORDER BY by_block, by_doc) AS upto FROM shuffled
)
SELECT doc_id, source, n_tokens, block, CAST(1 + epochs + CASE WHEN upto <= rest THEN 1 ELSE 0 END AS BIGINT) AS copies
FROM placed
"""


def _canonical(text: str) -> str:
    start = "^[^\\p{L}\\p{N}]*"
    mark = f"regexp_matches(x, '{start}(copyright|\\(c\\)|©)')"
    goes_on = f"regexp_matches(x, '{start}copyright[^\\p{{L}}\\p{{N}}]*({'|'.join(SENTENCE)})([^\\p{{L}}\\p{{N}}]|$)')"
    lines = f"list_transform(string_split(lower({text}), chr(10)), lambda x: CASE WHEN {mark} AND NOT {goes_on} THEN '' ELSE x END)"
    out = f"array_to_string({lines}, chr(10))"
    out = f"regexp_replace({out}, '[^\\p{{L}}\\p{{N}}\\n]+', ' ', 'g')"
    for old, new in SPELLINGS:
        if " " not in old:
            out = f"replace({out}, '{old}', '{new}')"
    return out


def _joined(line: str) -> str:
    for old, new in SPELLINGS:
        if " " in old:
            line = f"replace({line}, '{old}', '{new}')"
    return line


def _flat(text: str) -> str:
    return _joined(f"trim(regexp_replace({text}, '[ \\n]+', ' ', 'g'))")


_KNOWN = ", ".join("('{}', '{}')".format(name, text.replace("'", "''")) for name, text in KNOWN)
_OP8 = f"""
WITH known AS (
    SELECT DISTINCT license, {_flat(_canonical("text"))} AS c FROM (VALUES {_KNOWN}) AS t(license, text)
), docs AS (
    SELECT row_number() OVER () AS rid, doc_id, {_canonical("text")} AS c FROM documents WHERE text IS NOT NULL
), paragraphs AS (
    SELECT rid, doc_id, n, unnest(range(n))::INT AS paragraph, unnest(parts) AS p
    FROM (SELECT rid, doc_id, parts, len(parts) AS n FROM (
        SELECT rid, doc_id, string_split_regex(c, '\\n[ \\n]*\\n') AS parts FROM docs))
), lines AS (
    SELECT doc_id, paragraph, unnest(range(len(parts)))::INT AS line, unnest(parts) AS p
    FROM (SELECT doc_id, paragraph, string_split(p, chr(10)) AS parts FROM paragraphs WHERE contains(p, chr(10)))
), units AS (
    SELECT doc_id, 'text' AS unit, CAST(NULL AS INT) AS paragraph, CAST(NULL AS INT) AS line, {_flat("c")} AS c FROM docs
    UNION ALL SELECT doc_id, 'paragraph', paragraph, NULL, {_flat("p")} FROM paragraphs WHERE n > 1
    UNION ALL SELECT doc_id, 'line', paragraph, line, {_joined('trim(p)')} FROM lines
)
SELECT doc_id, license, unit, paragraph, line FROM units JOIN known USING (c)
"""

_SUM97 = (
    "list_reduce(list_prepend(0, list_transform(string_split(substr(replace(x, ' ', ''), 5) || substr(replace(x, ' ', ''), 1, 4), ''), "
    "lambda c: CASE WHEN c >= 'A' THEN 100 + ascii(c) - 55 ELSE CAST(c AS INT) END)), "
    "lambda a, v: CASE WHEN v >= 100 THEN (100 * a + v - 100) % 97 ELSE (10 * a + v) % 97 END)"
)
_LUHN = (
    "list_sum(list_transform(range(1, length({d}) + 1), lambda i: CASE WHEN i % 2 = 1 THEN CAST({d}[length({d}) + 1 - i] AS INT) "
    "ELSE (2 * CAST({d}[length({d}) + 1 - i] AS INT)) // 10 + (2 * CAST({d}[length({d}) + 1 - i] AS INT)) % 10 END)) % 10 = 0"
).format(d="regexp_replace(x, '[^0-9]', '', 'g')")
_NEAR = "lower(substr(t, greatest(1, s - 47), least(s, 48)) || ' ' || substr(t, s + length(x) + 1, 48))"
# kind: (pattern, condition on the match x that starts at s of the text t)
_PII = {
    "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", "TRUE"),
    "ip": (
        r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+",
        "len(list_filter(string_split(x, '.'), lambda p: length(ltrim(p, '0')) > 3 OR CAST(right(p, 3) AS INT) > 255)) = 0",
    ),
    "card": (r"[0-9](?:[\x20-]?[0-9])+", f"length(regexp_replace(x, '[^0-9]', '', 'g')) BETWEEN 14 AND 19 AND {_LUHN}"),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", "length(regexp_replace(x, '[^0-9]', '', 'g')) BETWEEN 10 AND 15"),
    "iban": (
        r"[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?",
        f"length(replace(x, ' ', '')) BETWEEN 15 AND 34 AND {_SUM97} = 1",
    ),
    "national_id": (
        r"[0-9]+(?:-[0-9]+)+",
        r"regexp_matches(x, '^[0-9]{3}-[0-9]{2}-[0-9]{4}$') AND NOT regexp_matches(x, '^(?:000|666|9)|-00-|-0000$') "
        f"AND regexp_matches({_NEAR}, 'ssn|social|security|tax|national') AND NOT regexp_matches({_NEAR}, 'order|invoice|version|model')",
    ),
    "local_phone": (
        r"[0-9]+(?:[\x20.-][0-9]+)+",
        r"regexp_matches(x, '^[2-9][0-9]{2}[ .-][0-9]{3}[ .-][0-9]{4}$') "
        f"AND regexp_matches({_NEAR}, 'phone|tel|call|mobile|fax|contact') "
        f"AND NOT regexp_matches({_NEAR}, 'order|invoice|version|model|serial')",
    ),
    "secret": (
        r"""AKIA[A-Z0-9]{16}|(?i:password|passwd|api_key|secret|token)["'']?[\x20\x09]*[:=][\x20\x09]*(?:"[^"\r\n]*"|''[^''\r\n]*''|[^\x20\x09-\x0D]+)""",
        r"""(x LIKE 'AKIA%' OR length(regexp_replace(x, '^[^:=]*[:=][\x20\x09]*["'']?|["'']$', '', 'g')) >= 16
            OR length(regexp_replace(x, '^[^:=]*[:=][\x20\x09]*["'']?|["'']$', '', 'g')) >= 8 AND (regexp_matches(x, '[:=].*[0-9]')
                OR regexp_matches(x, '[:=][\x20\x09]*(?:".*"|''.*'')$') OR regexp_matches(x, '^[A-Za-z_]+=[^\x20\x09]')))
            AND (s = 0 OR NOT regexp_matches(substr(t, s, 1), '[A-Za-z0-9]')) AND NOT regexp_matches("""
        + _NEAR
        + ", 'example|placeholder|dummy')",
    ),
}
_PII_ROWS = " UNION ALL ".join(
    f"""
    SELECT rid, s, s + length(x) AS e, {k} AS k, '{kind}' AS kind FROM (
        SELECT rid, t, unnest(m) AS x, unnest(list_transform(range(1, len(m) + 1), lambda i:
            CAST(list_sum(list_transform(g[1:i], lambda v: length(v))) + coalesce(list_sum(list_transform(m[1:i - 1], lambda v: length(v))), 0) AS BIGINT))) AS s
        FROM (SELECT rid, t, regexp_extract_all(t, '{pattern}') AS m, string_split_regex(t, '{pattern}') AS g FROM docs)
        WHERE len(m) > 0
    ) WHERE {condition}"""
    for k, (kind, (pattern, condition)) in enumerate(_PII.items())
)
_OP10 = f"""
WITH docs AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
found AS ({_PII_ROWS}),
listed AS (
    SELECT rid, count(*) FILTER (kind = 'email') AS n_email, count(*) FILTER (kind = 'ip') AS n_ip,
        count(*) FILTER (kind = 'card') AS n_card, count(*) FILTER (kind = 'phone') AS n_phone,
        string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, k) FILTER (k < 4) AS base,
        string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, k) AS spans
    FROM found GROUP BY rid
)
SELECT doc_id, coalesce(n_email, 0) AS n_email, coalesce(n_ip, 0) AS n_ip, coalesce(n_card, 0) AS n_card,
    coalesce(n_phone, 0) AS n_phone, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM docs LEFT JOIN listed USING (rid)
"""

_OP4 = """
WITH p AS (
    SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages
), w AS (
    SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS last FROM p
)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
    CASE WHEN payload_bytes >= 1000 AND page_id < last THEN 'revisit' ELSE 'response' END AS record_type,
    CASE WHEN payload_bytes >= 1000 AND page_id < last THEN last END AS refers_to
FROM w
"""

_FRAMES = " ".join(f"WHEN '{role}' THEN {len(a) + len(b)}" for role, (a, b) in FRAMES.items())
_OP7 = rf"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')
), each AS (
    SELECT *, length(text) + length(text) - length(replace(text, '\', ''))
        + len(regexp_extract_all(text, '</?s>|\[/?INST\]|<</?SYS>>|\[ROLE=|\[/ROLE\]'))
        + CASE role {_FRAMES} ELSE {len("<s>[ROLE=] ") + len(" [/ROLE]")} + length(url_encode(role)) END AS chars
    FROM turns
)
SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
    CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY turn, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
    CAST(sum(chars) AS BIGINT) AS formatted_chars
FROM each GROUP BY conv_id
"""

_OP11 = r"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents
), cut AS (
    SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces
), places AS (
    SELECT lang, unnest(list_zip(w, w[2:], w[3:])) AS p FROM cut
), counts AS MATERIALIZED (
    SELECT lang, 1 AS size, p[1] AS phrase, count(*) AS f FROM places WHERE p[1] IS NOT NULL GROUP BY ALL
    UNION ALL SELECT lang, 2, p[1] || ' ' || p[2] AS phrase, count(*) FROM places WHERE p[2] IS NOT NULL GROUP BY ALL
    UNION ALL SELECT lang, 3, p[1] || ' ' || p[2] || ' ' || p[3] AS phrase, count(*) FROM places WHERE p[3] IS NOT NULL GROUP BY ALL
), candidates AS (
    SELECT lang, size, phrase, f AS a, string_split(phrase, ' ') AS w FROM counts WHERE size > 1 AND f >= 10
), cuts AS (
    SELECT lang, size, phrase, a, k, array_to_string(w[:k], ' ') AS head, array_to_string(w[k + 1:], ' ') AS tail
    FROM (SELECT *, unnest(range(1, size)) AS k FROM candidates)
), scored AS (
    SELECT c.lang, c.size, c.phrase, c.a, c.k, l.f AS l, r.f AS r,
        CAST(1000000::HUGEINT * c.a * c.a // (l.f::HUGEINT * r.f) AS BIGINT) AS score
    FROM cuts c JOIN counts l ON l.lang = c.lang AND l.phrase = c.head JOIN counts r ON r.lang = c.lang AND r.phrase = c.tail
), lowest AS (
    SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), inside AS (
    SELECT lang, unnest([w[1] || ' ' || w[2], w[2] || ' ' || w[3]]) AS phrase, a AS longer FROM candidates WHERE size = 3
), dropped AS (
    SELECT DISTINCT c.lang, c.phrase FROM candidates c JOIN inside i ON i.lang = c.lang AND i.phrase = c.phrase AND 100 * longer >= 50 * a
), totals AS (
    SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM cut GROUP BY lang
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM lowest ANTI JOIN dropped USING (lang, phrase) JOIN totals USING (lang)
QUALIFY row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) <= 2000
"""

ORACLE_SQL = {
    "op2_quality_rules": _OP2,
    "op4_warc_archives": _OP4,
    "op6_source_mixture": _OP6,
    "op7_chat_prefix_trees": _OP7,
    "op8_license_scan": _OP8,
    "op10_pii": _OP10,
    "op11_collocations": _OP11,
}
