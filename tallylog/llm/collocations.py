"""Phrase collocations of each language by best-first branch-and-bound growth of prefixes.

A phrase of words scores ``floor(1000000 a^2 / (l r))`` for its count ``a`` and the counts of its two parts, at the lowest-scoring cut.
A phrase is grown from its prefixes, and a prefix bounds what grows from it: a phrase is no more frequent than its prefix or its rest, so

* with one word no phrase is bounded below the best score, as its rest may be that word's only one: all frequent words are grown at once,
* with two words of count ``b`` no longer phrase scores more than ``floor(1000000 b / f(first word))`` at its first cut.

So a pass counts words, and one the pairs of frequent words. Then, for a score that is lowered round by round for each language, the prefixes are opened
that may lead to this score: those whose bound reaches it, and those on which it depends whether a pair with this score survives, that is
the pair itself, and frequent pairs that end with its first word. A pass over the texts counts the phrases grown from newly
opened prefixes. A language is settled once as many phrases as asked for survive with the score reached, or nothing is left to
open. All phrases with that score are known then, ties included.

A pass counts the phrases of ``BLOCK_BYTES`` of text at a time before they are shuffled, so a frequent phrase costs a row a block. Which
prefixes are open is told to it by a bit set of fixed size; a prefix that it holds by chance is counted in full, too, and changes no result.
Scores per language are histograms of whole numbers up to 1,000,000. Nothing else reaches the driver but how many languages are open.
"""

from __future__ import annotations

from collections import defaultdict
from itertools import count

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallylog.llm.common import cut_lineage, small_batches

TOP = 2000
LEAST = 10
# A shorter phrase goes if a longer one that holds it has this share of its count, in hundredths.
ABSORBED = 50
BLOCK_BYTES = 4 << 20
# Pairs with the score of a round, as a multiple of the rows asked for; four times as many in each round.
AHEAD = 2
# Shares of a language that are ranked apart before its best are.
SHARES = 64
# Bits of the set of open prefixes: 4 MB.
FILTER_BITS = 1 << 25
# Fixed value: seed of Spark's xxhash64.
SPARK_SEED = 42

_BREAK = b"\xff"  # never in UTF-8
_CUT = bytes.maketrans(b".,;:!?\n\x0b\x0c\r", _BREAK * 10)


class Words:
    """The words of a block of texts of one language as numbers, with a break between pieces."""

    def __init__(self, lang: str, texts: list[bytes]):
        self.lang = lang
        numbers: defaultdict[bytes, int] = defaultdict(count().__next__)
        mark = numbers[_BREAK]
        whole = _BREAK.join(texts).lower().translate(_CUT).replace(_BREAK, b" \xff ")
        # All white space that is left is the blank and the tab.
        self.at = np.fromiter(map(numbers.__getitem__, whole.split()), np.int64)
        self.words = list(numbers)
        self.is_word = self.at != mark

    def phrases(self, places: np.ndarray, size: int, heads: np.ndarray | None = None) -> tuple[list[bytes], np.ndarray, np.ndarray]:
        """The distinct phrases that begin at ``places``, their counts, and which of them each place has.

        ``heads`` numbers what a phrase has before its last word, if that is more than a word.
        """
        key = self.at[places]
        if size > 1:
            key = (key if heads is None else heads) * len(self.words) + self.at[places + size - 1]
        _, first, which, n = np.unique(key, return_index=True, return_inverse=True, return_counts=True)
        words, begins = self.words, places[first]
        columns = [[words[w] for w in self.at[begins + k].tolist()] for k in range(size)]
        return [b" ".join(parts) for parts in zip(*columns)], n, which

    def begins(self, size: int) -> np.ndarray:
        """Where phrases of ``size`` words begin."""
        good = self.is_word[: max(0, len(self.at) - size + 1)].copy()
        for k in range(1, size):
            good &= self.is_word[k : k + len(good)]
        return np.flatnonzero(good)


def _counted(docs: DataFrame, grown, block_bytes: int) -> DataFrame:
    """``lang, size, phrase, a`` of what ``grown`` gives for each block of ``lang, t``."""

    def count_blocks(batches):
        texts: dict[str, list[bytes]] = {}
        held = 0

        def rows():
            for lang, parts in texts.items():
                for size, phrases, n in grown(Words(lang, parts)):
                    for k in range(0, len(phrases), 50_000):
                        part = phrases[k : k + 50_000]
                        columns = [pa.array([lang] * len(part)), pa.array([size] * len(part), pa.int32()), pa.array(part, pa.binary())]
                        columns[2] = columns[2].cast(pa.string())
                        yield pa.RecordBatch.from_arrays([*columns, pa.array(n[k : k + 50_000], pa.int64())], names=["lang", "size", "phrase", "a"])

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary())):
                texts.setdefault(lang, []).append(text := text.as_py())
                held += len(text)
                if held >= block_bytes:
                    yield from rows()
                    texts, held = {}, 0
        yield from rows()

    found = docs.mapInArrow(count_blocks, "lang string, size int, phrase string, a bigint")
    return found.groupBy("lang", "size", "phrase").agg(F.sum("a").alias("a"))


def _pass(docs: DataFrame, lang: str, text: str) -> DataFrame:
    texts = F.make_valid_utf8(F.coalesce(F.col(text).cast("string"), F.lit("")))
    return small_batches(docs).select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), texts.alias("t"))


def _words(block: Words):
    """One row of size 0 for all words, then the words."""
    places = block.begins(1)
    yield 0, [b""], np.array([len(places)])
    phrases, n, _ = block.phrases(places, 1)
    yield 1, phrases, n


def _held(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    return ((bits[hashes >> 6] >> (hashes & 63).astype(np.uint64)) & np.uint64(1)).astype(bool)


def _grown(size: int, heads: np.ndarray, tails: np.ndarray):
    """Counts the phrases of ``size`` words that begin with an open prefix and end with a frequent rest, both given as bit sets."""

    def grown(block: Words):
        shorter = block.begins(size - 1)
        parts, _, which = block.phrases(shorter, size - 1)
        seed = xxhash.xxh64_intdigest(block.lang.encode(), SPARK_SEED)
        hashes = np.fromiter((xxhash.xxh64_intdigest(p, seed) & (FILTER_BITS - 1) for p in parts), np.int64, len(parts))
        part_at = np.zeros(len(block.at), np.int64)
        part_at[shorter] = which
        places = block.begins(size)
        if len(places):
            places = places[_held(heads, hashes)[part_at[places]] & _held(tails, hashes)[part_at[places + 1]]]
        phrases, n, _ = block.phrases(places, size, part_at[places])
        yield size, phrases, n

    return grown


def _bit_set(prefixes: DataFrame) -> np.ndarray:
    """The set of ``lang, phrase`` as bits; at most ``FILTER_BITS`` of them, however many prefixes there are."""
    at = F.expr(f"xxhash64(lang, phrase) & {FILTER_BITS - 1}L").alias("at")
    slots = prefixes.select(at).groupBy(F.expr("at div 64").alias("slot")).agg(F.expr("bit_or(shiftleft(1L, CAST(at % 64 AS INT)))").alias("bits"))
    found = slots.toArrow()
    bits = np.zeros(FILTER_BITS >> 6, np.int64)
    bits[found["slot"].to_numpy()] = found["bits"].to_numpy()
    return bits.view(np.uint64)


def _score(a: str, left: str, right: str) -> Column:
    """Exact: products of counts below 10^16 have at most 38 digits."""
    wide = "CAST({} AS DECIMAL(38, 0))"
    return F.expr(f"{wide.format(1000000)} * {wide.format(a)} * {wide.format(a)} div ({wide.format(left)} * {wide.format(right)})")


def _score_rank(scores: DataFrame, rank: int) -> DataFrame:
    """``lang, reached``: the score of the phrase at ``rank``, 0 where there are fewer."""
    histogram = scores.groupBy("lang", "score").agg(F.count(F.lit(1)).alias("n"))
    # At most 1,000,001 rows a language.
    above = histogram.withColumn("above", F.expr("sum(n) OVER (PARTITION BY lang ORDER BY score DESC)"))
    return above.groupBy("lang").agg(F.coalesce(F.max(F.when(F.col("above") >= rank, F.col("score"))), F.lit(0)).alias("reached"))


def scored_pairs(counts: DataFrame, grown: DataFrame) -> DataFrame:
    """Pairs ``lang, phrase, a, first, second, l, r, score, bound`` with the counts of their words."""
    words = counts.filter("size = 1").select("lang", F.col("phrase").alias("word"), F.col("a").alias("f"))
    pairs = grown.select(
        "lang", "phrase", "a", F.split_part("phrase", F.lit(" "), F.lit(1)).alias("first"), F.split_part("phrase", F.lit(" "), F.lit(2)).alias("second")
    )
    pairs = pairs.join(words.select("lang", F.col("word").alias("first"), F.col("f").alias("l")), ["lang", "first"])
    pairs = pairs.join(words.select("lang", F.col("word").alias("second"), F.col("f").alias("r")), ["lang", "second"])
    bound = F.expr("CAST(1000000 AS DECIMAL(38, 0)) * a div CAST(l AS DECIMAL(38, 0))")
    return pairs.select("lang", "phrase", "a", "first", "second", "l", "r", _score("a", "l", "r").alias("score"), bound.alias("bound"))


def scored_triples(triples: DataFrame, pairs: DataFrame) -> DataFrame:
    """``lang, phrase, a, l, r, score`` of phrases of three words at their lowest-scoring cut."""
    each = triples.select(
        "lang",
        "phrase",
        "a",
        F.expr("concat(split_part(phrase, ' ', 1), ' ', split_part(phrase, ' ', 2))").alias("head"),
        F.expr("concat(split_part(phrase, ' ', 2), ' ', split_part(phrase, ' ', 3))").alias("tail"),
    )
    heads = pairs.select("lang", F.col("phrase").alias("head"), F.col("l").alias("l1"), F.col("a").alias("l2"))
    tails = pairs.select("lang", F.col("phrase").alias("tail"), F.col("a").alias("r1"), F.col("r").alias("r2"))
    both = each.join(heads, ["lang", "head"]).join(tails, ["lang", "tail"])
    both = both.withColumn("s1", _score("a", "l1", "r1")).withColumn("s2", _score("a", "l2", "r2"))
    first = F.col("s1") <= F.col("s2")
    cut = [F.when(first, F.col(f"{c}1")).otherwise(F.col(f"{c}2")).alias(name) for c, name in (("l", "l"), ("r", "r"), ("s", "score"))]
    return both.select("lang", "phrase", "a", *cut)


def _surviving(pairs: DataFrame, triples: DataFrame, scored: DataFrame) -> DataFrame:
    """Pairs that no triple absorbs, and all triples."""
    parts = F.expr(
        "explode(array(concat(split_part(phrase, ' ', 1), ' ', split_part(phrase, ' ', 2)), concat(split_part(phrase, ' ', 2), ' ', split_part(phrase, ' ', 3))))"
    )
    longest = triples.select("lang", parts.alias("phrase"), F.col("a").alias("longer")).groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    kept = pairs.join(longest, ["lang", "phrase"], "left").filter(f"longer IS NULL OR 100 * longer < {ABSORBED} * a")
    columns = ["lang", "phrase", "a", "l", "r", "score"]
    return kept.select(columns).unionAll(scored.select(columns))


def _to_open(pairs: DataFrame, reached: DataFrame) -> DataFrame:
    """``lang, phrase`` of the prefixes that a score of ``reached`` asks for; a prefix may appear more than once."""
    at = pairs.join(reached, "lang")
    likely = at.filter("bound >= reached OR score >= reached").select("lang", "phrase")
    # Before a pair, a triple with enough of its count begins with a frequent pair that ends where the pair begins.
    wanted = at.filter("score >= reached").groupBy("lang", F.col("first").alias("second")).agg(F.min("a").alias("least"))
    before = pairs.join(wanted, ["lang", "second"]).filter(f"100 * a >= {ABSORBED} * least").select("lang", "phrase")
    return likely.unionAll(before)


def collocations(
    docs: DataFrame, lang: str = "lang", text: str = "text", top: int = TOP, least: int = LEAST, ahead: int = AHEAD, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: each language's ``top`` phrases of two and three words by score, count and text.

    Texts are lower-cased in A-Z, cut into pieces at ``[.,;:!?\\x0A-\\x0D]`` and into words at blanks and tabs. ``n`` counts a language's words,
    ``a`` a phrase's occurrences, at least ``least``, ``l`` and ``r`` those of its parts at the cut. A phrase goes if a longer one that holds
    it has at least half its count. A null language is ``und``, a null text empty; repeated rows count as often as they are there; an
    empty table gives no rows, and other columns play no part.
    """
    each = _pass(docs, lang, text)
    counts = cut_lineage(_counted(each, _words, block_bytes).filter(f"size = 0 OR a >= {least}"))
    frequent = _bit_set(counts.filter("size = 1"))
    grown = _counted(each, _grown(2, frequent, frequent), block_bytes).filter(f"a >= {least}")
    pairs = cut_lineage(scored_pairs(counts, grown))
    frequent = _bit_set(pairs)
    opened = triples = scored = None
    waiting, settled = pairs.select("lang").distinct(), []
    rank = top * ahead
    while True:
        # A language whose pairs run out before the rank opens everything.
        reached = cut_lineage(_score_rank(pairs.join(waiting, "lang", "left_semi"), rank))
        wanted = _to_open(pairs, reached).distinct()
        wanted = cut_lineage(wanted.join(opened, ["lang", "phrase"], "left_anti") if opened else wanted)
        bits = _bit_set(wanted)
        if bits.any():
            found = _counted(each, _grown(3, bits, frequent), block_bytes)
            found = found.filter(f"a >= {least}").select("lang", "phrase", "a")
            # A prefix that the bit set held by chance may be counted twice, with the same result.
            triples = cut_lineage(found.unionAll(triples).distinct() if triples else found)
            scored = cut_lineage(scored_triples(triples, pairs))
            opened = wanted.unionAll(opened) if opened else wanted
        if triples is None:
            triples, scored = (pairs.select("lang", "phrase", "a").limit(0), pairs.select("lang", "phrase", "a", "l", "r", "score").limit(0))
        good = cut_lineage(_surviving(pairs, triples, scored).join(reached, "lang").filter("score >= reached"))
        enough = good.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
        state = cut_lineage(reached.join(enough, "lang", "left").select("lang", F.expr(f"reached = 0 OR coalesce(n, 0) >= {top}").alias("done")))
        settled.append(good.join(state.filter("done"), "lang", "left_semi").drop("reached"))
        waiting = state.filter("NOT done").select("lang")
        if waiting.isEmpty():
            break
        rank *= 4
    found = settled[0]
    for part in settled[1:]:
        found = found.unionAll(part)
    # The best of each share of a language first, so that no task orders all of it.
    ranked = "row_number() OVER (PARTITION BY lang{} ORDER BY score DESC, a DESC, phrase)"
    found = found.withColumn("share", F.expr(f"pmod(xxhash64(phrase), {SHARES})"))
    found = found.withColumn("place", F.expr(ranked.format(", share"))).filter(F.col("place") <= top)
    place = F.expr(ranked.format("")).cast("bigint")
    totals = counts.filter("size = 0").select("lang", F.col("a").alias("n"))
    best = found.withColumn("rank", place).filter(F.col("rank") <= top).join(totals, "lang")
    return best.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
