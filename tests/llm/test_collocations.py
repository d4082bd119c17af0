"""Collocations against counting every phrase, with every order of opening prefixes."""

from __future__ import annotations

import random
import re
from collections import Counter

import pytest

from tallylog.llm.collocations import collocations

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_force(rows, top, least):
    counts, out = {}, []
    for lang, text in rows:
        f = counts.setdefault("und" if lang is None else lang, Counter())
        for piece in re.split(r"[.,;:!?\n-\r]", (text or "").translate(LOWER)):
            words = re.findall(r"[^ \t]+", piece)
            f.update(tuple(words[k : k + s]) for s in (1, 2, 3) for k in range(len(words) - s + 1))
    for lang, f in counts.items():
        n = sum(c for p, c in f.items() if len(p) == 1)
        found = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        absorbed = {part for p, a in found.items() if len(p) == 3 for part in (p[:2], p[1:]) if 100 * a >= 50 * f[part]}
        scored = []
        for p, a in found.items():
            if p not in absorbed:
                cuts = [(1_000_000 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p))]
                score, k = min(cuts)
                scored.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n, -score))
    return sorted(out)


def texts(seed):
    draw = random.Random(seed)
    words = ["é", "Ab", "ab", "x-y", " ", "😀", "cd", "\x1f", "a'b"] + [f"w{k}" for k in range(30)]
    phrases = [[draw.choice(words) for _ in range(draw.randint(2, 5))] for _ in range(12)]
    rows = []
    for k in range(160):
        out = []
        for _ in range(draw.randint(0, 30)):
            out += draw.choice(phrases) if draw.random() < 0.6 else [draw.choice(words)]
            out.append(draw.choice(["", "", "", ".", ",", "\n", "!?", "\t", "\x0b"]))
        rows.append((draw.choice(["en", "en", "en", "de", None, ""]), draw.choice([" ", "  "]).join(out)))
    return rows + [("en", None), (None, None), ("xx", ""), ("yy", "a a a a a a a a a a a a a a"), ("yy", "b. b c. " * 20), ("und", "p q " * 12)]


@pytest.mark.parametrize("seed,top,ahead,block", [(1, 2000, 2, 1 << 22), (2, 5, 1, 300), (3, 12, 1, 1), (4, 3, 2, 5000), (5, 40, 1, 1 << 22)])
def test_equal_to_counting_everything(spark, seed, top, ahead, block):
    rows = texts(seed)
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "lang string, text string, phrase string, a int").repartition(4)
    found = collocations(docs, top=top, ahead=ahead, block_bytes=block)
    assert found.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(map(tuple, found.collect())) == brute_force(rows, top, 10)


def test_empty_table(spark):
    assert collocations(spark.createDataFrame([], "lang string, text string")).collect() == []
