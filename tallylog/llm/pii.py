"""Personal data in texts: patterns propose spans, checksums confirm them, nearby words adjust the score.

Everything is a DataFrame expression over one row, so nothing is shuffled and a text of any
length stays in its own task. A pattern's matches and the pieces between them come from
``regexp_extract_all`` and ``split``, which walk a text alike; running sums of their lengths are
the positions, in code points. Sums run in blocks of 256 matches, so that a text with very many
matches doesn't cost their square.

The first four kinds are the base: their checks alone decide. The others need a score of
``THRESHOLD``; each kind starts with its own score, a failed check ends it, words near the span
that speak for or against it add or take ``CONTEXT``.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallylog.llm.common import boxed

THRESHOLD = 0.6
CONTEXT = 0.4
# Code points before and after a span in which context words count.
NEAR = 48


class Kind(NamedTuple):
    name: str
    pattern: str  # Java
    hint: str  # cheap SQL test that holds for every text t with a match
    valid: str  # SQL over the match x
    score: float = 1.0
    speaks_for: str = ""  # pattern of lower-case words
    against: str = ""
    whole_word: bool = False  # no letter or digit may stand before the span


# Possessive quantifiers and look-behinds change no match; they keep the time linear in texts
# such as one endless run of digits or letters.
KINDS = (
    Kind(
        "email",
        r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
        "contains(t, '@')",
        "true",
    ),
    Kind(
        "ip",
        r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
        "contains(t, '.')",
        r"forall(split(x, '\\.'), p -> length(ltrim('0', p)) <= 3 AND cast(right(p, 3) AS int) <= 255)",
    ),
    Kind(
        "card",
        r"[0-9](?:[\x20-]?[0-9])++",
        "true",
        "length(translate(x, ' -', '')) BETWEEN 14 AND 19 AND luhn_check(translate(x, ' -', ''))",
    ),
    Kind(
        "phone",
        r"\+[0-9][\x20().0-9-]+[0-9]",
        "contains(t, '+')",
        "length(translate(x, '+ ().-', '')) BETWEEN 10 AND 15",
    ),
    Kind(
        "iban",
        r"[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?",
        "true",
        # Letters count 10 to 35; the first four characters move to the end; the remainder by 97 is 1.
        "length(translate(x, ' ', '')) BETWEEN 15 AND 34 AND aggregate("
        "split(concat(substr(translate(x, ' ', ''), 5), substr(translate(x, ' ', ''), 1, 4)), ''), 0, (a, c) -> "
        "CASE WHEN c >= 'A' THEN (100 * a + ascii(c) - 55) % 97 ELSE (10 * a + cast(c AS int)) % 97 END) = 1",
        0.8,
    ),
    Kind(
        "national_id",
        r"(?<![0-9])[0-9]++(?:-[0-9]++)++",
        "contains(t, '-')",
        "x RLIKE '^(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}$'",
        0.3,
        "ssn|social|security|tax|national",
        "order|invoice|version|model",
    ),
    Kind(
        "local_phone",
        r"(?<![0-9])[0-9]++(?:[\x20.-][0-9]++)++",
        "true",
        "x RLIKE '^[2-9][0-9]{2}[ .-][0-9]{3}[ .-][0-9]{4}$'",
        0.3,
        "phone|tel|call|mobile|fax|contact",
        "order|invoice|version|model|serial",
    ),
    # As they are assigned in code and settings: any case, white space, ``:`` or ``=``, quotes. What is neither quoted nor right
    # after ``=`` may be prose, so it must look like a key: with a digit, or long.
    Kind(
        "secret",
        r"""AKIA[A-Z0-9]{16}|(?i:password|passwd|api_key|secret|token)["']?[\x20\x09]*+[:=][\x20\x09]*+(?:"[^"\r\n]*+"|'[^'\r\n]*+'|[^\x20\x09-\x0D]++)""",
        "contains(t, 'AKIA') OR contains(t, '=') OR contains(t, ':')",
        r"""x LIKE 'AKIA%' OR exists(array(regexp_replace(x, '^[^:=]*+[:=][\\x20\\x09]*+["\']?|["\']$', '')), v -> length(v) >= 8 AND (
            length(v) >= 16 OR v RLIKE '[0-9]' OR x RLIKE '[:=][\\x20\\x09]*(?:".*"|\'.*\')$' OR x RLIKE '^[A-Za-z_]+=[^\\x20\\x09]'))""",
        0.8,
        "",
        "example|placeholder|dummy",
        True,
    ),
)
BASE = ("email", "ip", "card", "phone")
_BLOCK = 256


def _sql_text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _ends(steps: str, both: str = "{} + {}") -> str:
    """SQL of the running sums (or what else puts ``both`` together) of an array of positive whole numbers, block by block."""
    more, sum_ = both.format("element_at(a, -1)", "v"), both.format("s", "v")
    blocks = f"sequence(0, (size({steps}) - 1) div {_BLOCK})"
    block = f"slice({steps}, b * {_BLOCK} + 1, {_BLOCK})"
    grow = f"(a, v) -> concat(a, array({more}))"
    totals = f"transform({blocks}, b -> aggregate({block}, 0, (s, v) -> {sum_}))"
    before = f"aggregate({totals}, array(0), {grow})"
    inner = f"transform({blocks}, b -> slice(aggregate({block}, array(before[b]), {grow}), 2, {_BLOCK}))"
    # A one-element array carries the block offsets into the lambda, so that they are computed once.
    return (
        f"CASE WHEN size({steps}) = 0 THEN array() "
        f"ELSE flatten(flatten(transform(array({before}), before -> {inner}))) END"
    )


def _score(kind: Kind) -> str:
    near = (
        f"lower(concat(substr(t, greatest(1, start - {NEAR} + 1), least(start, {NEAR})), ' ', "
        f"substr(t, end + 1, {NEAR})))"
    )
    near = near.replace("start", "s.start").replace("end", "s.end")
    score = str(kind.score)
    if kind.speaks_for:
        score += f" + CASE WHEN {near} RLIKE '{kind.speaks_for}' THEN {CONTEXT} ELSE 0 END"
    if kind.against:
        score += f" - CASE WHEN {near} RLIKE '{kind.against}' THEN {CONTEXT} ELSE 0 END"
    if kind.whole_word:
        score += " - CASE WHEN s.start > 0 AND substr(t, s.start, 1) RLIKE '[A-Za-z0-9]' THEN 1 ELSE 0 END"
    return score


def find_spans(docs: DataFrame, text: str = "text", kinds: tuple[Kind, ...] = KINDS) -> DataFrame:
    """``row`` (the document as it came), ``t`` (its text) and ``spans``, in order.

    A span is ``(start, k, end, kind, score)``: code points from 0, ``end`` exclusive, ``k`` the
    number of the kind. Spans of one kind don't overlap, those of different kinds may. A null or
    empty text has none. Repeated rows give the same spans each; an empty table gives no rows.
    """
    each = docs.select(boxed(docs), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("t"))
    raw = []
    for k, kind in enumerate(kinds):
        pattern = _sql_text(kind.pattern)
        raw.append(
            f"CASE WHEN {kind.hint} THEN regexp_extract_all(t, {pattern}, 0) ELSE array() END AS m_{k}"
        )
        raw.append(f"CASE WHEN {kind.hint} THEN split(t, {pattern}, -1) ELSE array() END AS g_{k}")
    each = each.selectExpr("row", "t", *raw)
    steps = [
        expr
        for k in range(len(kinds))
        for expr in (
            f"m_{k}",
            # One step more than matches: the rest of the text. Outside a lambda each array is made once.
            f"zip_with(g_{k}, m_{k}, (g, x) -> length(g) + coalesce(length(x), 0)) AS s_{k}",
        )
    ]
    each = each.selectExpr("row", "t", *steps)
    ends = [expr for k in range(len(kinds)) for expr in (f"m_{k}", f"{_ends(f's_{k}')} AS e_{k}")]
    each = each.selectExpr("row", "t", *ends)
    found = []
    for k, kind in enumerate(kinds):
        e = f"e_{k}[i]"
        span = f"named_struct('start', {e} - length(x), 'k', {k}, 'end', {e}, 'kind', '{kind.name}', 'x', x)"
        valid = f"filter(transform(m_{k}, (x, i) -> {span}), s -> exists(array(s.x), x -> {kind.valid}))"
        scored = (
            f"transform({valid}, s -> named_struct('start', s.start, 'k', s.k, 'end', s.end, 'kind', s.kind, "
            f"'score', cast({_score(kind)} AS double)))"
        )
        found.append(scored if kind.name in BASE else f"filter({scored}, s -> s.score >= {THRESHOLD - 1e-9})")
    return each.selectExpr("row", "t", f"array_sort(concat({', '.join(found)})) AS spans")


def _listed(spans: str) -> Column:
    return F.expr(f"array_join(transform({spans}, s -> concat(s.kind, ':', s.start, ':', s.end)), ',')")


def span_report(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document the counts of the base kinds, the digest of the base spans, and all spans as text."""
    found = find_spans(docs, text).select(
        F.col("row")[key].alias(key), "spans", F.expr(f"filter(spans, s -> s.k < {len(BASE)})").alias("base")
    )
    counts = [F.expr(f"cast(size(filter(base, s -> s.kind = '{kind}')) AS bigint)").alias(f"n_{kind}") for kind in BASE]
    return found.select(key, *counts, F.sha2(_listed("base"), 256).alias("base_sha256"), _listed("spans").alias("spans"))


def redact(docs: DataFrame, text: str = "text") -> DataFrame:
    """The documents with every span replaced by its kind, such as ``[EMAIL]``; other columns stay.

    Overlapping spans are replaced as one, named by the first. A text without spans, null
    included, stays as it is. Edge cases as in :func:`find_spans`.
    """
    found = find_spans(docs, text).selectExpr(
        "row", "t", "spans", f"{_ends('transform(spans, s -> s.end)', 'greatest({}, {})')} AS upto"
    )
    # A span that begins before an earlier one ends is part of the same cut.
    found = found.selectExpr(
        "row", "t", "spans", "upto",
        "filter(transform(spans, (s, i) -> i), i -> i = 0 OR spans[i].start >= upto[i - 1]) AS firsts",
    )
    found = found.selectExpr(
        "row",
        "t",
        "transform(firsts, f -> spans[f]) AS cuts",
        "transform(firsts, (f, j) -> upto[if(j + 1 < size(firsts), firsts[j + 1], size(spans)) - 1]) AS stops",
    )
    # The text is cut into the stretches of a block of cuts first: finding a place in a text takes the length before it.
    stop = "if({0} = 0, 0, stops[{0} - 1])"
    begin, last = f"b * {_BLOCK}", f"least((b + 1) * {_BLOCK}, size(cuts)) - 1"
    piece = f"substr(t, {stop.format(begin)} + 1, stops[{last}] - {stop.format(begin)})"
    before = f"substr(p, {stop.format('j')} - {stop.format(begin)} + 1, cuts[j].start - {stop.format('j')})"
    replaced = f"array_join(transform(sequence({begin}, {last}), j -> concat({before}, '[', upper(cuts[j].kind), ']')), '')"
    blocks = f"transform(sequence(0, (size(cuts) - 1) div {_BLOCK}), b -> transform(array({piece}), p -> {replaced})[0])"
    redacted = F.expr(f"concat(array_join({blocks}, ''), substr(t, element_at(stops, -1) + 1))")
    columns = []
    for name in docs.columns:
        column = F.col("row")[name]
        new = F.when(F.size("cuts") > 0, redacted).otherwise(column) if name == text else column
        columns.append(new.alias(name))
    # The generator keeps a later filter on the text from working all of this out a second time.
    return found.select(F.inline(F.array(F.struct(*columns))))
