"""Quality rules whose thresholds come from quantile sketches of each language and source.

A document is measured once: words, symbols, repeated lines and word windows, capitals.
Fixed base rules (too short, mostly repeated) come first. Every other rule is an outlier
rule: the documents that pass the base rules are sketched per (lang, source), and a
document is rejected where a measure lies far outside the middle half of its own group.

The sketch is a count per bucket of a log-linear scale (32 buckets for each doubling, so a
quantile is off by 1/32 of its value at most). Adding up counts merges two sketches: sketches
of sources merge to that of their language and those to that of the corpus, which judge
the groups too small to have quartiles of their own. It holds some 2,000 buckets at
most for a group, however many documents the group has, and partial sums come before the
shuffle, so a hot source costs a row per bucket and task.
"""

from __future__ import annotations

from collections import Counter

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallylog.llm.common import ASCII_SPACE, boxed, cut_lineage, hold, small_batches

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper")
MIN_WORDS = 50
# Groups of fewer documents are judged by the merged sketch of the next level.
MIN_DOCS = 200
# Distance from the quartiles, in widths of the middle half, at which a document is an outlier.
REACH = 3
SYMBOLS = b"#*$%&|<>"
UPPER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
# name: (SQL of the measure in thousandths, least width of the middle half, also a lower bound,
# what is added to the reach of a text of one word: the means of short texts scatter more)
RULES = {
    "word_length": ("1000 * word_chars div n_words", 200, True, 40_000),
    "symbols": ("1000 * n_symbols div n_words", 30, False, 2_000),
    "dup_lines": ("1000 * n_dup_lines div n_lines", 150, False, 0),
    "repeats": ("1000 * n_repeat_words div n_words", 120, False, 12_000),
    "capitals": ("1000 * n_upper div n_words", 300, False, 20_000),
}


def _repeated(words: list[bytes]) -> int:
    """Words that lie in a window of three that occurs twice or more."""
    windows = list(zip(words, words[1:], words[2:]))
    if len(set(windows)) == len(windows):
        return 0
    seen, covered, end = Counter(windows), 0, 0
    for at, window in enumerate(windows):
        if seen[window] > 1:
            covered += at + 3 - max(at, end)
            end = at + 3
    return covered


def _deleted(text: bytes, characters: bytes) -> int:
    return len(text) - len(text.translate(None, characters))


@F.arrow_udf(T.StructType([T.StructField(name, T.LongType()) for name in MEASURES]))
def _measures(texts: pa.Array) -> pa.Array:
    hold("quality", lambda: None)
    chars = pc.fill_null(pc.utf8_length(texts), 0).to_pylist()
    rows = []
    for n_chars, text in zip(chars, texts.cast(pa.binary())):
        text = text.as_py() or b""
        words = text.split()
        lines = [line for line in text.split(b"\n") if line.strip()]
        rows.append(
            (
                len(words),
                n_chars - _deleted(text, ASCII_SPACE),
                _deleted(text, SYMBOLS),
                len(lines) - len(set(lines)),
                _repeated(words),
                len(lines),
                _deleted(text, UPPER),
            )
        )
    columns = list(zip(*rows)) or [[] for _ in MEASURES]
    return pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in columns], names=list(MEASURES))


# Or else each use of a measure would be a pass of its own over the text.
_measures = _measures.asNondeterministic()


def measured(docs: DataFrame, text: str = "text") -> DataFrame:
    """``row`` (the document as it came) and ``m``, its measures; a null text measures as empty."""
    return small_batches(docs).select(boxed(docs), _measures(F.col(text).cast("string")).alias("m"))


def base_failed(n_words: Column, n_repeat_words: Column) -> Column:
    """Too short, or more than half of the words lie in repeated windows."""
    return (n_words < MIN_WORDS) | (100 * n_repeat_words > 50 * n_words)


def bucket(value: str) -> str:
    """SQL of the bucket of a whole number from 0."""
    shift = f"(length(bin({value})) - 6)"
    return f"CASE WHEN {value} < 64 THEN {value} ELSE 32 * {shift} + shiftright({value}, {shift}) END"


def sketches(measures: DataFrame) -> DataFrame:
    """Counts by (lang, source, rule, bucket) of ``lang, source`` and the measures of documents."""
    rules = ", ".join(f"'{name}', {sql}" for name, (sql, _, _, _) in RULES.items())
    long = measures.filter(~base_failed(F.col("n_words"), F.col("n_repeat_words"))).select(
        "lang", "source", F.expr(f"stack({len(RULES)}, {rules}) AS (rule, value)")
    )
    keys = ["lang", "source", "rule", F.expr(bucket("value")).cast("int").alias("bucket")]
    return long.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def quartiles(counts: DataFrame) -> DataFrame:
    """The first and third quartile by (level, lang, source, rule), of sketches merged at three levels.

    Level 0 is (lang, source), level 1 the language, level 2 the corpus.
    """
    merged = [
        counts.select(F.lit(level).alias("level"), *keys, "rule", "bucket", "n")
        for level, keys in enumerate(
            (
                ("lang", "source"),
                ("lang", F.lit(None).cast("string").alias("source")),
                (F.lit(None).cast("string").alias("lang"), F.lit(None).cast("string").alias("source")),
            )
        )
    ]
    keys = ["level", "lang", "source", "rule"]
    each = merged[0].unionAll(merged[1]).unionAll(merged[2])
    each = each.groupBy(*keys, "bucket").agg(F.sum("n").alias("n"))
    # A window holds the buckets of one sketch, about 2,000 at most.
    each = each.select(
        *keys,
        F.expr("CASE WHEN bucket < 64 THEN bucket ELSE shiftleft(pmod(bucket, 32) + 32L, bucket div 32 - 1) END").alias(
            "value"
        ),
        F.expr("sum(n) OVER (PARTITION BY level, lang, source, rule ORDER BY bucket)").alias("upto"),
        F.expr("sum(n) OVER (PARTITION BY level, lang, source, rule)").alias("docs"),
    )
    return each.groupBy(*keys).agg(
        F.max("docs").alias("docs"),
        F.min(F.expr("CASE WHEN 4 * upto >= docs THEN value END")).alias("q1"),
        F.min(F.expr("CASE WHEN 4 * upto >= 3 * docs THEN value END")).alias("q3"),
    )


def thresholds(counts: DataFrame, min_docs: int = MIN_DOCS, reach: int = REACH) -> DataFrame:
    """``lang, source`` and the bounds ``low_<rule>``, ``high_<rule>`` of each group."""
    found = cut_lineage(quartiles(counts))
    groups = found.filter("level = 0").select("lang", "source").distinct()
    coarse = found.select("level", F.col("lang").alias("l"), F.col("source").alias("s"), "rule", "docs", "q1", "q3")
    fits = [
        F.col("lang").eqNullSafe(F.col("l")) & F.col("source").eqNullSafe(F.col("s")),
        F.col("lang").eqNullSafe(F.col("l")),
    ]
    by_level = [groups.join(coarse.filter(F.col("level") == k), fit) for k, fit in enumerate(fits)]
    rules = [F.lit(name).alias("rule") for name in RULES]
    corpus = coarse.filter("level = 2").select(F.col("rule").alias("r"), "level", "docs", "q1", "q3")
    each_rule = groups.select("lang", "source", F.explode(F.array(*rules)).alias("rule"))
    by_level.append(each_rule.join(corpus, F.col("rule") == F.col("r")))
    keys = ["lang", "source", "rule"]
    columns = [*keys, "level", "docs", "q1", "q3"]
    chosen = by_level[0].select(*columns).unionAll(by_level[1].select(*columns)).unionAll(by_level[2].select(*columns))
    best = F.struct("level", "q1", "q3")
    chosen = chosen.filter((F.col("docs") >= min_docs) | (F.col("level") == 2)).groupBy(*keys).agg(F.min(best).alias("b"))
    bounds = []
    for name, (_, width, two_sided, _) in RULES.items():
        here = F.when(F.col("rule") == name, F.col("b"))
        spread = reach * F.greatest(here["q3"] - here["q1"], F.lit(width))
        bounds.append(F.max(here["q3"] + spread).alias(f"high_{name}"))
        if two_sided:
            bounds.append(F.max(here["q1"] - spread).alias(f"low_{name}"))
    return chosen.groupBy("lang", "source").agg(*bounds)


def judged(docs: DataFrame, bounds: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """``row``, ``m``, ``base_failed`` and ``kept`` of every document; bounds as of :func:`thresholds`."""
    bounds = bounds.select(F.col("lang").alias("_l"), F.col("source").alias("_s"), F.struct("*").alias("b"))
    each = measured(docs, text)
    same = each["row"][lang].cast("string").eqNullSafe(F.col("_l")) & each["row"][source].cast("string").eqNullSafe(
        F.col("_s")
    )
    return _verdicts(each.join(bounds, same, "left"), "row", "m")


def _verdicts(joined: DataFrame, *carried: str) -> DataFrame:
    failed = base_failed(F.col("m.n_words"), F.col("m.n_repeat_words"))
    fine = F.lit(True)
    with_measures = joined.select("*", "m.*")
    for name, (sql, _, two_sided, noise) in RULES.items():
        fine = fine & F.expr(f"{sql} <= b.high_{name} + {noise} div n_words")
        if two_sided:
            fine = fine & F.expr(f"{sql} >= b.low_{name} - {noise} div n_words")
    # n_words is 0 only where the base rules fail, and the measures are not evaluated there.
    kept = F.when(failed, F.lit(False)).otherwise(F.coalesce(fine, F.lit(True)))
    return with_measures.select(*carried, failed.alias("base_failed"), kept.alias("kept"))


def narrow(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """``lang, source`` and the measures of every document."""
    each = measured(docs, text)
    group = [each["row"][c].cast("string").alias(name) for c, name in ((lang, "lang"), (source, "source"))]
    return each.select(*group, "m.*")


def filter_documents(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """The documents that pass, with their columns as they came.

    A null text counts as empty and fails, as every text of fewer than 50 words. Null languages
    and sources form groups of their own. Repeated rows are judged alike; extra columns pass through
    whatever their names. An empty table gives an empty table. Texts are read twice, once for the
    sketches and once for the verdicts, rather than shuffled.
    """
    bounds = cut_lineage(thresholds(sketches(narrow(docs, text, lang, source))))
    return judged(docs, bounds, text, lang, source).filter("kept").select("row.*")


def quality_report(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """``doc_id``, the measures, ``base_failed`` and ``kept`` of every document (same rules and edge cases)."""
    each = measured(docs)
    kept_columns = [each["row"][key].alias(key)] + [each["row"][c].cast("string").alias(c) for c in ("lang", "source")]
    each = cut_lineage(each.select(*kept_columns, "m"))
    bounds = cut_lineage(thresholds(sketches(each.select("lang", "source", "m.*"))))
    bounds = bounds.select(F.col("lang").alias("_l"), F.col("source").alias("_s"), F.struct("*").alias("b"))
    same = F.col("lang").eqNullSafe(F.col("_l")) & F.col("source").eqNullSafe(F.col("_s"))
    return _verdicts(each.join(bounds, same, "left"), key, "m").select(key, "m.*", "base_failed", "kept")
