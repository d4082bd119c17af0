"""Exact Jaccard join of word n-gram sets: regions around pivots, joined within distance windows.

Distances between sets are symmetric differences ``D(x, y)``. Two sets of ``m`` and ``n`` shingles
have a Jaccard similarity of at least 9/10 exactly if ``19 * D <= m + n``; other similarities likewise.

1. *Pivots of regions.* The distance to the empty set, the size, cuts the sets into bands; a set so
   close to the next band that a partner may lie there is replicated to it. Within a band
   the shingles are dealt into one slice more than the largest distance of two linked sets, so linked
   sets agree on one slice at least. The distinct contents of a slice are the pivots of that slice, and
   a region holds the sets at distance 0 from a pivot. A slice that is empty in a set says nothing,
   so such a region is cut again by a second dealing, unless spare slices outnumber the empty ones.
2. *Stars.* The smallest set of a region is its centre, and every other one is compared with it
   exactly. All sets compared with one centre ``p`` form its cluster.
3. *Windows.* Two linked sets of one cluster that aren't both linked to ``p`` share a part of their
   differences from ``p``, because ``D(x, y) = D(x, p) + D(y, p) - 2 |xp & yp|``, where ``xp`` is
   the difference of ``x`` and ``p``. Only members within the triangle inequality's window
   ``|D(x, p) - D(y, p)| <= D(x, y)`` that share enough are linked; nothing else is looked at.
   A cluster of more than ``BLOCK`` members is cut, and its parts meet pairwise in tasks of their own.

A pair linked in no other way than through ``p`` needs no link of its own, so links are fewer than
pairs: a component of ``k`` different sets gives about ``k`` of them. Equal sets are one
class from the start. Sets are compared as 64-bit hashes of shingles, and 64-bit hashes of whole sets name
the classes (two of a billion different sets share a name with a chance of three in a hundred).
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallylog.llm.common import boxed, cut_lineage, discard, free_shuffles, hold, small_batches
from tallylog.llm.components import components

BLOCK = 1024
# Words whose hashes a task remembers.
_CACHE = 100_000
_U = np.uint64


class Rule(NamedTuple):
    """Shingles of ``words`` words; sets link at a similarity of ``num / den`` or more.

    ``spare`` is the share of slices, in percent, beyond those needed. It changes no result: at low similarities
    slices are small and some are empty, and a set that has no more empty slices than spare ones needs no second dealing.
    """

    words: int = 3
    num: int = 90
    den: int = 100
    spare: int = 0

    def distance(self, total):
        """The largest distance of linked sets whose sizes add up to ``total``."""
        return total * (self.den - self.num) // (self.den + self.num)


def _mix(h: np.ndarray) -> np.ndarray:
    """A bijective mixer of 64-bit numbers (the finaliser of a public hash, constants fixed)."""
    h = h ^ (h >> _U(33))
    h = h * _U(0xFF51AFD7ED558CCD)
    h = h ^ (h >> _U(33))
    h = h * _U(0xC4CEB9FE1A85EC53)
    return h ^ (h >> _U(33))


class _Vocabulary(dict):
    """Numbers of words in the order they are met; ``hashes`` has the hash of each number."""

    def __init__(self):
        self.hashes = np.empty(_CACHE, _U)
        self.used = 0

    def __missing__(self, word: bytes) -> int:
        if self.used == len(self.hashes):
            self.hashes = np.concatenate([self.hashes, np.empty_like(self.hashes)])
        number = self.used
        self.hashes[number] = xxhash.xxh3_64_intdigest(word)
        self.used += 1
        if len(word) <= 64:
            self[word] = number
        return number

    def forget(self) -> None:
        self.clear()
        self.__init__()

    def hash_all(self, words: list[bytes]) -> np.ndarray:
        if self.used > _CACHE:
            self.forget()
        numbers = np.fromiter(map(self.__getitem__, words), np.int64, len(words))
        return self.hashes[numbers]


_vocabulary = _Vocabulary()


def shingles(text: bytes | None, words: int) -> np.ndarray:
    """The sorted distinct hashes of a text's shingles; A-Z count as lower case."""
    found = (text or b"").lower().split()
    if not found:
        return np.zeros(0, _U)
    width = min(words, len(found))
    h = _vocabulary.hash_all(found)
    count = len(found) - width + 1
    out = _mix(h[:count] + _U(width))
    for k in range(1, width):
        out = _mix(out * _U(3) + h[k : k + count])
    return np.unique(out)


def _edges(limit: int) -> list[int]:
    """Where the size bands begin: each is half as large again as the one before."""
    edges = [1]
    while edges[-1] <= limit:
        edges.append(max(edges[-1] + 1, -(-edges[-1] * 3 // 2)))
    return edges


_EDGES = np.array(_edges(1 << 40))


def _dealt(sets: np.ndarray, slices: int, prefix: np.ndarray, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """For each slice the hash of its content with ``prefix``, and whether it is empty."""
    where = _mix(sets + _U(seed))
    order = np.argsort(where)
    # High half of the hash, scaled to the slices: monotonous, so slices are runs of the order.
    number = ((where[order] >> _U(32)) * _U(slices)) >> _U(32)
    sums = np.concatenate([np.zeros(1, _U), np.cumsum(_mix(sets[order] + _U(seed + 1)))])
    cuts = np.searchsorted(number, np.arange(slices + 1, dtype=_U))
    content = sums[cuts[1:]] - sums[cuts[:-1]]
    names = _mix(prefix + np.arange(slices, dtype=_U))
    return _mix(content + names), cuts[1:] == cuts[:-1]


def region_keys(sets: np.ndarray, rule: Rule) -> np.ndarray:
    """The regions of a set."""
    n, keys = len(sets), []
    if n == 0:
        return np.zeros(0, np.int64)
    first = int(np.searchsorted(_EDGES, n, side="right")) - 1
    last = int(np.searchsorted(_EDGES, n * rule.den // rule.num, side="right")) - 1
    for band in range(first, last + 1):
        slices = int(rule.distance(2 * (int(_EDGES[band + 1]) - 1))) + 1
        if slices == 1:  # only equal sets link
            continue
        spare = slices * rule.spare // 100
        slices += spare
        prefix = _mix(np.array([band], _U))
        found, empty = _dealt(sets, slices, prefix, 101)
        keys.append(found[~empty])
        # Linked sets agree on more slices than the spare ones, so on one with content if fewer are empty.
        for at in np.flatnonzero(empty) if empty.sum() > spare else ():
            keys.append(_dealt(sets, slices, _mix(found[at : at + 1]), 202)[0])
    return np.unique(np.concatenate(keys)).view(np.int64) if keys else np.zeros(0, np.int64)


def _name(sets: np.ndarray) -> int:
    return int(np.array([xxhash.xxh3_64_intdigest(sets.tobytes())], _U).view(np.int64)[0])


def _texts(column: pa.Array) -> Iterator[bytes | None]:
    for text in column.cast(pa.binary()):
        yield text.as_py()


_NAMED = T.StructType([T.StructField("n", T.LongType()), T.StructField("node", T.LongType())])
_KEYED = T.StructType([*_NAMED.fields, T.StructField("keys", T.ArrayType(T.LongType()))])


def _described(rule: Rule, with_keys: bool):
    """A column function: size and name of a text's set (null name if empty), and its regions."""

    @F.arrow_udf(_KEYED if with_keys else _NAMED)
    def described(column: pa.Array) -> pa.Array:
        hold("jaccard_join", _vocabulary.forget)
        sizes, names, keys, ends = [], [], [], [0]
        for text in _texts(column):
            sets = shingles(text, rule.words)
            sizes.append(len(sets))
            names.append(_name(sets) if len(sets) else None)
            if with_keys:
                keys.append(region_keys(sets, rule))
                ends.append(ends[-1] + len(keys[-1]))
        out = [pa.array(sizes, pa.int64()), pa.array(names, pa.int64())]
        if with_keys:
            flat = np.concatenate([np.zeros(0, np.int64), *keys])
            out.append(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat)))
        return pa.StructArray.from_arrays(out, names=["n", "node", "keys"][: len(out)])

    return described.asNondeterministic()  # evaluated once, however often its fields are used


def _compared(rule: Rule):
    """A column function of two texts: whether their sets link."""

    @F.arrow_udf("boolean")
    def compared(left: pa.Array, right: pa.Array) -> pa.Array:
        hold("jaccard_join", _vocabulary.forget)
        linked = []
        last_text, last = None, None
        for text, centre in zip(_texts(left), _texts(right)):
            if last is None or centre != last_text:
                last_text, last = centre, shingles(centre, rule.words)
            sets = shingles(text, rule.words)
            apart = len(sets) + len(last) - 2 * len(np.intersect1d(sets, last, assume_unique=True))
            linked.append(apart <= rule.distance(len(sets) + len(last)))
        return pa.array(linked, pa.bool_())

    return compared.asNondeterministic()


def _joined(rule: Rule):
    """The links within one cluster, or between two parts of it, that no path of links makes needless.

    A cluster comes with its members' texts, which take less than their differences from the centre; its centre has part -1.
    """

    def joined(cluster: pa.Table) -> pa.Table:
        hold("jaccard_join", _vocabulary.forget)
        parts = cluster["part"].to_numpy()
        members = parts >= 0
        at_centre = int(np.flatnonzero(~members)[0])
        sets = [shingles(text.as_py(), rule.words) for text in cluster["t"].cast(pa.binary())]
        deltas = [np.setxor1d(own, sets[at_centre], assume_unique=True) for own, member in zip(sets, members) if member]
        sizes = np.array([len(own) for own, member in zip(sets, members) if member])
        del sets
        parts = parts[members]
        nodes = cluster["x"].to_numpy()[members]
        linked = cluster["linked"].to_numpy()[members]
        far = np.array([len(d) for d in deltas])
        order = np.argsort(far, kind="stable")
        across = len(np.unique(parts)) > 1
        parent = list(range(len(nodes)))

        def root(k: int) -> int:
            while parent[k] != k:
                parent[k] = parent[parent[k]]
                k = parent[k]
            return k

        # Postings of difference elements over members, in order of distance from the centre.
        flat = np.concatenate([deltas[k] for k in order])
        owner = np.repeat(np.arange(len(order)), far[order])
        by = np.argsort(flat, kind="stable")
        flat, owner = flat[by], owner[by]
        starts = np.searchsorted(flat, flat, side="left")
        rank_of = np.empty(len(by), np.int64)
        rank_of[by] = np.arange(len(by))
        bounds = np.concatenate([[0], np.cumsum(far[order])])
        far_sorted, size_sorted = far[order], sizes[order]
        links = []
        for at, k in enumerate(order):
            mine = rank_of[bounds[at] : bounds[at + 1]]
            # Postings of my elements before my own place are those of nearer members.
            before = starts[mine]
            lengths = mine - before
            total = int(lengths.sum())
            if not total:
                continue
            offsets = np.repeat(before - np.concatenate([[0], np.cumsum(lengths)[:-1]]), lengths)
            shared = np.bincount(owner[offsets + np.arange(total)], minlength=at)
            distance = far_sorted[:at] + far_sorted[at] - 2 * shared[:at]
            near = distance <= rule.distance(size_sorted[:at] + size_sorted[at])
            for other in np.flatnonzero(near):
                j = order[other]
                if linked[k] and linked[j] or across and parts[k] == parts[j]:
                    continue
                a, b = root(int(k)), root(int(j))
                if a != b:
                    parent[a] = b
                    links.append((nodes[k], nodes[j]))
        ends = list(zip(*links)) or [[], []]
        return pa.table({"a": pa.array(ends[0], pa.int64()), "b": pa.array(ends[1], pa.int64())})

    return joined


def described(texts: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """``doc_id, text_hash, n, node, keys`` of ``doc_id, t``."""
    each = texts.select("doc_id", F.xxhash64("t").alias("text_hash"), _described(rule, True)("t").alias("d"))
    return each.select("doc_id", "text_hash", "d.*")


def stars_of(known: DataFrame) -> DataFrame:
    """Pairs ``p, x`` of a region's centre and another set in it.

    The keys of all regions are shuffled once: the centres are found where the regions lie, and both sides of the join read that shuffle.
    """
    regions = known.filter("node IS NOT NULL").select("node", F.explode("keys").alias("key")).repartition("key")
    shared = regions.groupBy("key").agg(F.min("node").alias("p"), F.max("node").alias("q")).filter("p != q")
    # The hint keeps one plan at every size: no side of these joins has a bound.
    stars = regions.join(shared.select("key", "p").hint("merge"), "key").filter("node != p")
    return stars.select("p", F.col("node").alias("x")).distinct()


def links(docs: DataFrame, known: DataFrame, stars: DataFrame, text: str, rule: Rule, block: int = BLOCK) -> DataFrame:
    """Links ``(a, b)`` between classes that hold every component together."""
    wanted = stars.select(F.col("x").alias("node")).unionAll(stars.select(F.col("p").alias("node"))).distinct()
    # One text of each class, found by the hash of the text; equal texts meet before the shuffle.
    by_hash = known.groupBy("node").agg(F.min("text_hash").alias("text_hash")).join(wanted, "node", "left_semi")
    texts = docs.select(F.col(text).cast("string").alias("t")).select(F.xxhash64("t").alias("text_hash"), "t")
    texts = texts.groupBy("text_hash").agg(F.first("t").alias("t")).join(by_hash.hint("merge"), "text_hash")
    texts = free_shuffles(cut_lineage(texts.select("node", "t")))

    pairs = stars.join(texts.select(F.col("node").alias("x"), F.col("t").alias("t_x")), "x")
    pairs = pairs.join(texts.select(F.col("node").alias("p"), F.col("t").alias("t_p")), "p")
    compared = pairs.select("p", "x", _compared(rule)("t_x", "t_p").alias("linked"))
    compared = free_shuffles(cut_lineage(compared))

    # Clusters whose members are all linked to the centre need nothing more.
    clusters = compared.groupBy("p").agg(F.count(F.lit(1)).alias("m"), F.count_if(~F.col("linked")).alias("far"))
    parts = clusters.filter("far > 0 AND m > 1").select("p", F.ceil(F.col("m") / block).cast("int").alias("n_parts"))
    members = compared.join(parts, "p").withColumn("part", F.expr("CAST(pmod(xxhash64(x), n_parts) AS INT)"))
    members = members.select("p", "x", "linked", "part", F.explode(F.expr("sequence(0, n_parts - 1)")).alias("other"))
    members = members.select("p", "x", "linked", "part", F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"))
    # The centre is in every pair of parts.
    centres = parts.select("p", "n_parts", F.explode(F.expr("sequence(0, n_parts - 1)")).alias("i"))
    centres = centres.select("p", "i", F.explode(F.expr("sequence(i, n_parts - 1)")).alias("j"))
    centres = centres.select("p", F.col("p").alias("x"), F.lit(True).alias("linked"), F.lit(-1).alias("part"), "i", "j")
    met = members.unionAll(centres).join(texts.withColumnRenamed("node", "x").hint("merge"), "x")
    # Dealt anew by all three: rows that lie together by centre already would leave a large cluster in one task.
    found = met.repartition("p", "i", "j").groupBy("p", "i", "j").applyInArrow(_joined(rule), "a bigint, b bigint")
    found = cut_lineage(compared.filter("linked").select(F.col("p").alias("a"), F.col("x").alias("b")).unionAll(found))
    discard(texts)
    return free_shuffles(found)


def _rooted(docs: DataFrame, key: str, text: str, rule: Rule) -> tuple[DataFrame, DataFrame]:
    """``doc_id, n, node, root`` of the documents with words, and the others, which have no class.

    The root names a component by its smallest class, whatever its keys are.
    """
    each = small_batches(docs).select(F.col(key).alias("doc_id"), F.col(text).cast("string").alias("t"))
    keyed = cut_lineage(described(each, rule))
    stars = free_shuffles(cut_lineage(stars_of(keyed)))
    each = cut_lineage(keyed.drop("keys"))
    discard(keyed)
    found = cut_lineage(components(links(docs, each, stars, text, rule)))
    # Documents without words have no class and must not meet in one task: they go round the joins.
    rooted = each.filter("node IS NOT NULL").select("doc_id", "n", "node").join(found, "node", "left")
    rooted = rooted.select("doc_id", "n", "node", F.coalesce("root", "node").alias("root"))
    return rooted, each.filter("node IS NULL")


def classes(docs: DataFrame, key: str = "doc_id", text: str = "text", rule: Rule = Rule()) -> DataFrame:
    """``doc_id, n_shingles, node, component_id`` of every document.

    ``node`` names the set (null if empty), ``component_id`` is the smallest key reachable by links. A
    document without words, null included, is linked with nothing: its component is its own key. One with fewer
    words than a shingle has its whole sequence as its only shingle. Equal texts and repeated rows are one
    class. Null keys never become a component's name unless all its keys are null. An empty table gives no rows;
    other columns play no part.
    """
    rooted, empty = _rooted(docs, key, text, rule)
    least = rooted.groupBy("root").agg(F.min("doc_id").alias("least"))
    named = rooted.join(least, "root")
    named = named.select("doc_id", F.col("n").alias("n_shingles"), "node", F.col("least").alias("component_id"))
    return named.unionAll(empty.select("doc_id", F.col("n").alias("n_shingles"), "node", F.col("doc_id").alias("component_id")))


def one_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text", rule: Rule = Rule()) -> DataFrame:
    """The documents without those linked to another with a smaller key; columns as they came.

    Of each component one document stays, that with the smallest key (of repeated keys, one row); a null key counts as
    the largest. Components that share their smallest key, null included, keep one each. All documents without words
    stay. Edge cases as in :func:`classes`.
    """
    rooted, _ = _rooted(docs, key, text, rule)
    # The smallest key of each component, and a class that has it.
    first = F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "node")).alias("first")
    chosen = rooted.groupBy("root").agg(first).select("first.node", F.col("first.doc_id").alias("least"))
    each = docs.select(boxed(docs), F.col(text).cast("string").alias("t"))
    with_words = F.coalesce(F.col("t").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    # One row of each class and key, chosen before the shuffle wherever they meet in a task.
    rows = each.filter(with_words).select("row", _described(rule, False)("t").alias("d")).groupBy(F.col("d.node").alias("node"), F.col("row")[key].alias("k"))
    rows = rows.agg(F.first("row").alias("row"))
    kept = rows.join(chosen, (rows["node"] == chosen["node"]) & rows["k"].eqNullSafe(chosen["least"]), "left_semi")
    empty = each.filter(~with_words)
    return kept.select("row.*").unionAll(empty.select("row.*"))
