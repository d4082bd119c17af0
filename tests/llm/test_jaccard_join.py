from __future__ import annotations

import random

import numpy as np
import pytest

from tallylog.llm import jaccard_join
from tallylog.llm.components import components

SCHEMA = "doc_id bigint, text string, node string"


def words(text):
    return bytes((text or "").encode()).lower().split()


def shingle_set(text, width=3):
    found = words(text)
    if not found:
        return frozenset()
    width = min(width, len(found))
    return frozenset(tuple(found[k : k + width]) for k in range(len(found) - width + 1))


def brute_groups(rows, words=3, percent=90):
    """The sets of every (doc_id, text) and the groups of row numbers that links join, by all pairs."""
    sets = [shingle_set(text, words) for _, text in rows]
    group = list(range(len(rows)))

    def root(k):
        while group[k] != k:
            k = group[k]
        return k

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                group[root(a)] = root(b)
    groups = {}
    for k in range(len(rows)):
        groups.setdefault(root(k), []).append(k)
    return sets, list(groups.values())


def brute_force(rows):
    """(doc_id, n_shingles, component) of every (doc_id, text)."""
    sets, groups = brute_groups(rows)
    out = []
    for members in groups:
        least = min((rows[k][0] for k in members if rows[k][0] is not None), default=None)
        out += [(rows[k][0], len(sets[k]), least) for k in members]
    return sorted(out, key=repr)


def found(spark, rows, **options):
    docs = spark.createDataFrame([(k, t, "x") for k, t in rows], SCHEMA)
    out = jaccard_join.classes(docs, **options).select("doc_id", "n_shingles", "component_id")
    return sorted((tuple(r) for r in out.collect()), key=repr)


def family(seed, base_words, members, most_edits):
    """Copies of one text with some words replaced or dropped."""
    draw = random.Random(seed)
    base = [f"w{draw.randrange(400)}" for _ in range(base_words)]
    out = []
    for _ in range(members):
        copy = list(base)
        for _ in range(draw.randrange(most_edits + 1)):
            at = draw.randrange(len(copy))
            copy[at] = draw.choice(["", f"w{draw.randrange(400)}", "Edit"])
        out.append(" ".join(copy))
    return out


def test_edge_cases(spark):
    rows = [
        (1, None), (2, ""), (3, " \n\t"), (4, "one"), (5, "ONE"), (6, "one two"), (7, "One  Two"), (8, "a b c"),
        (9, "a b c"), (9, "a b c"), (None, "a b c"), (None, "alone here now then"), (10, "É x y z"), (11, "é x y z"),
        (12, "a b c"), (5, "another text with some more words"),
    ]
    assert found(spark, rows) == brute_force(rows)


def test_empty_table(spark):
    assert found(spark, []) == []


@pytest.mark.parametrize("seed", range(3))
def test_families_against_all_pairs(spark, seed):
    texts = family(seed, 180, 60, 8) + family(seed + 10, 40, 40, 3) + family(seed + 20, 900, 25, 60) + family(seed, 12, 20, 1)
    rows = list(enumerate(texts))
    random.Random(seed).shuffle(rows)
    assert found(spark, rows) == brute_force(rows)


def test_parts_of_a_large_cluster(spark):
    rows = list(enumerate(family(5, 150, 120, 7)))
    docs = spark.createDataFrame([(k, t, "x") for k, t in rows], SCHEMA)
    whole = jaccard_join.cut_lineage(jaccard_join.described(docs.withColumnRenamed("text", "t")))
    roots = []
    for block in (16, 10_000):
        links = jaccard_join.links(docs, whole, jaccard_join.stars_of(whole), "text", jaccard_join.Rule(), block)
        roots.append(sorted(tuple(r) for r in components(links).collect()))
    assert roots[0] == roots[1]


def test_one_of_each_keeps_the_smallest_key(spark):
    rows = [(3, "a b c d"), (1, "a b c d"), (1, "a b c d"), (2, "x y z"), (4, None), (5, None), (4, None)]
    docs = spark.createDataFrame([(k, t, "extra") for k, t in rows], SCHEMA)
    kept = jaccard_join.one_of_each(docs)
    assert kept.columns == ["doc_id", "text", "node"]
    assert sorted(tuple(r) for r in kept.collect() if r.text) == [(1, "a b c d", "extra"), (2, "x y z", "extra")]
    assert sum(r.text is None for r in kept.collect()) == 3


def test_linked_sets_share_a_region():
    rule = jaccard_join.Rule(5, 80, 100, spare=25)
    draw = np.random.default_rng(4)
    for _ in range(600):
        n = int(draw.choice([3, 9, 20, 60, 200, 900]))
        both = draw.integers(0, 1 << 63, n, np.uint64)
        cut = np.unique(both)
        most = rule.distance(2 * n)
        gone = int(draw.integers(0, most + 1))
        x, y = np.unique(cut[gone // 2 :]), np.unique(np.concatenate([cut[: n - (gone + 1) // 2]]))
        if len(np.setxor1d(x, y)) <= rule.distance(len(x) + len(y)) and len(np.setxor1d(x, y)):
            assert len(np.intersect1d(jaccard_join.region_keys(x, rule), jaccard_join.region_keys(y, rule)))
    large = np.unique(draw.integers(0, 1 << 63, 20_000, np.uint64))
    assert len(jaccard_join.region_keys(large, rule)) < 20_000 < len(jaccard_join.region_keys(large, rule._replace(spare=0)))


def test_one_of_each_keeps_unlinked_texts_of_one_key(spark):
    rows = [
        (None, "a b c d"), (None, "e f g h"), (None, "e f g h"), (None, "i j k l"), (7, "m n o p"), (7, "q r s t"),
        (7, "Q r s t"), (9, "q r s t"), (None, "m n o p"), (8, "i j  k l"), (8, "u v w x"),
    ]
    docs = spark.createDataFrame([(k, t, "extra") for k, t in rows], SCHEMA)
    kept = sorted(((r.doc_id, r.text.lower().split()[0]) for r in jaccard_join.one_of_each(docs).collect()), key=repr)
    assert kept == [(7, "m"), (7, "q"), (8, "i"), (8, "u"), (None, "a"), (None, "e")]


def test_components_of_chains_and_stars(spark):
    links = [(k, k + 1) for k in range(1, 40)] + [(100, k) for k in range(101, 160)] + [(7, 7), (None, 3)]
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert got == {k: 1 for k in range(1, 41)} | {k: 100 for k in range(100, 160)}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0
