from __future__ import annotations

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tallylog.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")
TEXTS = [None, "", " \n", "Hello, World's end", "é É <|endoftext|> x<|startoftext|>y", "a b c\x85d\x1ce", "Word " * 9_000,
         "x" * 9_000, "same text", "same text", "it's. we'll,. 3.14., a|b | || c", "<|STARTOFTEXT|> <|ENDOFTEXT|>x", "K… x….,", "ÄÖÜ ǅ İ ß ΑΣ é ́a"]


def frame(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")


def check(rows, capacity):
    """Every sequence is filled without gaps from 0 to the capacity at most."""
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by)


def test_ids_and_pieces(spark):
    docs = frame(spark, TEXTS)
    docs = docs.withColumn("piece", docs.doc_id).withColumn("ids", docs.text)  # clashing names play no part
    pieces, places = packing.pack(docs, PATH)
    rows = sorted(places.collect(), key=lambda r: (r.doc_id, r.piece))
    tokenizer = Tokenizer.from_file(PATH)
    expected = []
    for key, text in enumerate(TEXTS):
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [1]
        for k in range(0, len(ids), 4096):
            part = ids[k : k + 4096]
            expected.append((key, k // 4096, k, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
    assert [(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows] == expected
    check(rows, 4096)
    whole = packing.sequences(pieces, places)
    assert sorted(len(r.ids) // 4 for r in whole.collect()) == sorted(
        sum(r.length for r in rows if r.sequence_id == s) for s in {r.sequence_id for r in rows}
    )


@pytest.mark.parametrize("seed", range(30))
def test_plan_uses_every_piece_once_and_few_sequences(seed):
    draw = random.Random(seed)
    capacity = draw.choice([10, 64, 4096])
    counts = {draw.randint(1, capacity): draw.choice([1, 2, 7, 1000, 10**6]) for _ in range(draw.randint(1, 60))}
    slots, sequences = packing.plan(counts, capacity)
    taken = {}
    for length, first, run, _, _ in sorted(slots):
        assert taken.get(length, 0) == first
        taken[length] = first + run
    assert taken == counts
    total = sum(n * c for n, c in counts.items())
    # Between the tokens' and first-fit decreasing's bounds: 11/9 of the best, which holds all tokens.
    assert -(-total // capacity) <= sequences
    large = sum(c for n, c in counts.items() if 2 * n > capacity)
    assert sequences <= max(large, -(-total * 3 // (2 * capacity))) + sum(2 * n > capacity for n in counts) + len(counts)


@pytest.mark.parametrize("seed", range(8))
def test_plan_against_best_fit_one_by_one(seed):
    draw = random.Random(seed)
    pieces = [draw.randint(1, 100) for _ in range(300)]
    bins = []
    for piece in sorted(pieces, reverse=True):
        fitting = [b for b in range(len(bins)) if bins[b] >= piece]
        if fitting:
            bins[min(fitting, key=lambda b: bins[b])] -= piece
        else:
            bins.append(100 - piece)
    counts = {n: pieces.count(n) for n in set(pieces)}
    assert packing.plan(counts, 100)[1] <= len(bins) + 3


def test_places_of_random_pieces(spark):
    draw = random.Random(3)
    rows = [(k // 3, k % 2, 0, draw.choice([1, 5, 500, 1366, 1365, 4096, draw.randint(1, 4096)]), k) for k in range(3000)]
    pieces = spark.createDataFrame(rows, "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint")
    placed = packing.placed(pieces).collect()
    assert sorted(tuple(r)[:5] for r in placed) == sorted(rows)
    total = sum(r[3] for r in rows)
    assert check(placed, 4096) <= total / 4096 * 1.1 + 1


def test_empty_table(spark):
    pieces, places = packing.pack(frame(spark, []), PATH)
    assert places.collect() == [] and packing.sequences(pieces, places).collect() == []
