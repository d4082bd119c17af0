"""Temperature mixing: source shares raised to an exponent that is found by bisection.

Let ``T`` be the words of a source. Its weight is ``T ** a`` over the sum of those. With ``a = 1`` sources
keep their shares, with ``a = 0`` all weigh the same. The exponent is the largest one whose weights
reach the target entropy; if that repeated the smallest source more often than allowed, it is the smallest
one within that limit. Both are monotonous in ``a``, so they are bisected: each round asks 63 exponents
at once in one small aggregate, which is six halvings, and four rounds give 2^-24.

Weights become epochs: the largest source is read once, every other one ``(T / max T) ** (a - 1)`` times. No
document is lost. Whole epochs repeat a source; the rest of its budget goes to the first
documents of a permutation, blocks in the order of their hashes and documents of a block in the order of
theirs, as long as the words fit. The place in the permutation is a function of source and key, so the
rest is one cut per source, found among 4,096 regions of blocks, then among the blocks of one region, then in a block of
about a thousand documents: a source of any size is never put in order as a whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallylog.llm.common import boxed, cut_lineage

# Share of the largest possible entropy that the weights are to reach.
TARGET_ENTROPY = 0.95
MAX_REPEATS = 4.0
BLOCK = 1024
# Blocks whose hashes begin with the same digits are a region.
REGION_DIGITS = 3
SEED = 7
STEPS = 24
_WORD = r"[^\\x20\\x09-\\x0D]+"


def _sized(docs: DataFrame, key: str, text: str, source: str) -> DataFrame:
    words = F.expr(f"CAST(regexp_count(coalesce(CAST(`{text}` AS STRING), ''), '{_WORD}') AS BIGINT)")
    return docs.select(
        F.col(key).alias("doc_id"), F.col(source).cast("string").alias("source"), words.alias("n_tokens")
    )


def exponent(totals: DataFrame, target_entropy: float = TARGET_ENTROPY, max_repeats: float = MAX_REPEATS) -> int:
    """The exponent, in parts of 2^24, for the words ``tokens`` of each source."""
    found = totals.filter("tokens > 0")
    extremes = found.agg(F.max("tokens"), F.min("tokens"), F.count(F.lit(1))).first()
    most, least, sources = extremes
    if not sources:
        return 1 << STEPS
    relative = found.select((F.col("tokens") / F.lit(float(most))).alias("t"))
    entropy = 0  # the largest exponent known to reach the entropy; 0 always does
    repeats = 1 << STEPS  # the smallest one known to keep within the repeats; 1 always does
    for width in range(STEPS - 6, -1, -6):
        step = 1 << width
        low = max(0, repeats - (step << 6)) if repeats else 0
        asked = sorted({entropy + k * step for k in range(65)} | {low + k * step for k in range(65)})
        asked = [a for a in asked if a <= 1 << STEPS]
        grid = relative.select("t", F.explode(F.array(*[F.lit(a).cast("bigint") for a in asked])).alias("a"))
        power = F.expr(f"pow(t, a / {float(1 << STEPS)}D)")
        sums = grid.groupBy("a").agg(F.sum(power).alias("z"), F.sum(power * F.log("t")).alias("l"))
        reached = sums.select(
            "a",
            F.expr(f"ln(z) - a / {float(1 << STEPS)}D * l / z >= {target_entropy}D * ln({sources}D)").alias("spread"),
            F.expr(f"pow({float(most)}D / {float(least)}D, 1 - a / {float(1 << STEPS)}D) <= {max_repeats}D").alias("few"),
        ).collect()
        entropy = max([entropy, *(r["a"] for r in reached if r["spread"])])
        repeats = min([repeats, *(r["a"] for r in reached if r["few"])])
    return max(entropy, repeats)


def shares(sized: DataFrame, target_entropy: float = TARGET_ENTROPY, max_repeats: float = MAX_REPEATS) -> DataFrame:
    """Per source its words, documents, blocks, weight, whole extra epochs and what is left for a part of one."""
    totals = sized.groupBy("source").agg(F.sum("n_tokens").alias("tokens"), F.count(F.lit(1)).alias("docs"))
    totals = cut_lineage(totals)
    a = exponent(totals, target_entropy, max_repeats) / float(1 << STEPS)
    most, mass = totals.agg(F.max("tokens"), F.sum(F.expr(f"CASE WHEN tokens > 0 THEN pow(tokens, {a}D) END"))).first()
    # A thousandth of a word guards the whole numbers against the last bit of the power.
    extra = f"CASE WHEN tokens > 0 THEN CAST(floor((pow(tokens / {float(most or 1)}D, {a - 1}D) - 1) * tokens + 0.001D) AS BIGINT) ELSE 0L END"
    each = totals.withColumn("extra", F.expr(extra))
    return each.select(
        "source",
        "tokens",
        "docs",
        F.expr(f"CAST(ceil(docs / {BLOCK}.0D) AS BIGINT)").alias("blocks"),
        F.expr(f"CASE WHEN tokens > 0 THEN pow(tokens, {a}D) / {float(mass or 1)}D ELSE 0D END").alias("weight"),
        F.expr("CASE WHEN tokens > 0 THEN extra div tokens ELSE 0L END").alias("epochs"),
        F.expr("CASE WHEN tokens > 0 THEN extra % tokens ELSE 0L END").alias("rest"),
    )


def _shuffled(sized: DataFrame, by_source: DataFrame) -> DataFrame:
    """Documents with block, block order and document order of the permutation."""
    sources = by_source.select(F.col("source").alias("_s"), "blocks", "epochs", "rest")
    each = sized.join(sources, F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
    name = "coalesce(source, '')"
    each = each.withColumn("by_doc", F.expr(f"md5(concat('{SEED}|', {name}, '|', coalesce(CAST(doc_id AS STRING), '')))"))
    each = each.withColumn("block", F.expr("CAST(conv(substr(by_doc, 1, 8), 16, 10) AS BIGINT) % blocks"))
    return each.withColumn("by_block", F.expr(f"md5(concat('{SEED}|block|', {name}, '|', block))"))


def _ending(rows: DataFrame, place: str) -> DataFrame:
    """Per source the row in which the budget ends, with the words ``before`` it; the rows before it fit whole."""
    upto = rows.withColumn("before", F.expr(f"start + sum(tokens) OVER (PARTITION BY source ORDER BY {place}) - tokens"))
    return upto.filter("before <= rest AND before + tokens > rest").select("source", place, "before")


def _within(rows: DataFrame, ending: DataFrame, place: str) -> DataFrame:
    """The rows at the place of their source's ``ending``, whose words before are their ``start``."""
    ending = ending.select(F.col("source").alias("_s"), F.col(place).alias("_p"), F.col("before").alias("start"))
    return rows.join(ending, F.col("source").eqNullSafe(F.col("_s")) & (F.col(place) == F.col("_p"))).drop("_s", "_p")


def cuts(sized: DataFrame, by_source: DataFrame) -> DataFrame:
    """Per source the place ``cut`` in its permutation up to which documents are read once more."""
    each = _shuffled(sized, by_source).filter("rest > 0")
    blocks = each.groupBy("source", "by_block", "rest").agg(F.sum("n_tokens").alias("tokens"))
    # Regions of blocks first, at most ``16 ** REGION_DIGITS`` of a source, then the blocks of the region in which the budget ends.
    regions = blocks.groupBy("source", F.expr(f"substring(by_block, 1, {REGION_DIGITS})").alias("region"), "rest").agg(F.sum("tokens").alias("tokens"))
    regions = _ending(regions.withColumn("start", F.lit(0)), "region")
    blocks = blocks.withColumn("region", F.expr(f"substring(by_block, 1, {REGION_DIGITS})"))
    blocks = _ending(_within(blocks, regions, "region"), "by_block")
    # Repeated keys tie, and go in or stay out together, so they are one row.
    docs = _within(each, blocks, "by_block").groupBy("source", "by_block", "by_doc", "rest", "start").agg(F.sum("n_tokens").alias("tokens"))
    upto = F.expr("start + sum(tokens) OVER (PARTITION BY source ORDER BY by_doc)")
    inside = docs.withColumn("upto", upto).groupBy("source", "by_block").agg(F.max(F.expr("CASE WHEN upto <= rest THEN by_doc END")).alias("d"))
    return inside.select("source", F.struct("by_block", F.coalesce("d", F.lit("")).alias("by_doc")).alias("cut"))


def _copies(shuffled: DataFrame, found: DataFrame) -> DataFrame:
    found = found.select(F.col("source").alias("_s"), "cut")
    joined = shuffled.join(found, F.col("source").eqNullSafe(F.col("_s")), "left").drop("_s")
    once_more = (F.col("cut").isNotNull()) & (F.struct("by_block", "by_doc") <= F.col("cut"))
    return joined.withColumn("copies", 1 + F.col("epochs") + F.when(once_more, 1).otherwise(0))


def mixture(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
    target_entropy: float = TARGET_ENTROPY,
    max_repeats: float = MAX_REPEATS,
) -> DataFrame:
    """``doc_id, source, n_tokens, block, copies`` of every document: how often the mixture reads it.

    A null source is a source like any other. Documents without words, null included, cost nothing and are
    read as often as their source's whole epochs, and sources without words once. Repeated keys of a source share
    their place. An empty table gives no rows.
    """
    sized = cut_lineage(_sized(docs, key, text, source))
    by_source = cut_lineage(shares(sized, target_entropy, max_repeats))
    mixed = _copies(_shuffled(sized, by_source), cut_lineage(cuts(sized, by_source)))
    return mixed.select("doc_id", "source", "n_tokens", "block", F.col("copies").cast("bigint").alias("copies"))


def mixed_documents(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
    target_entropy: float = TARGET_ENTROPY,
    max_repeats: float = MAX_REPEATS,
) -> DataFrame:
    """The documents as often as :func:`mixture` reads them; columns as they came, also those that clash with its own.

    Null sources, empty texts and repeated keys are treated as there, and an empty table gives no rows.
    """
    sized = cut_lineage(_sized(docs, key, text, source))
    by_source = cut_lineage(shares(sized, target_entropy, max_repeats))
    found = cut_lineage(cuts(sized, by_source))
    rows = docs.select(
        boxed(docs), F.col(key).alias("doc_id"), F.col(source).cast("string").alias("source"), F.lit(0).alias("n_tokens")
    )
    mixed = _copies(_shuffled(rows, by_source), found)
    return mixed.select("row", F.explode(F.expr("sequence(1L, copies)")).alias("_")).select("row.*")
