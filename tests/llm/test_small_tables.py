"""Odd tables for the operators whose queries SQL checks: empty ones, clashing names, repeated rows."""

from __future__ import annotations

import math
import textwrap

import pytest

from tallylog.llm import licenses, mixing, quality

SCHEMA = "doc_id bigint, text string, lang string, source string, row string, m string, kept string, copies string, unit string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "r", "m", "k", "c", "u") for r in rows], SCHEMA)


def test_empty_tables(spark):
    docs = frame(spark, [])
    assert quality.filter_documents(docs).collect() == [] and quality.quality_report(docs).collect() == []
    assert mixing.mixture(docs).collect() == [] and mixing.mixed_documents(docs).collect() == []
    assert licenses.scan(docs).collect() == []


def test_quality_keeps_rows_as_they_came(spark):
    good = " ".join(f"word{k} of text" for k in range(60))
    rows = [(1, good, None, None), (1, good, None, None), (None, good, "en", "a"), (2, None, "en", "a"), (3, "short", "en", None)]
    docs = frame(spark, rows)
    kept = quality.filter_documents(docs)
    assert kept.columns == docs.columns
    assert sorted((tuple(r) for r in kept.collect()), key=repr) == sorted(
        ((*r, "r", "m", "k", "c", "u") for r in rows[:3]), key=repr
    )


def test_mixture_meets_its_targets(spark):
    words = {"a": 4000, "b": 400, "c": 100}
    rows = [(k * 10 + i, "w " * (n // 20), "en", s) for k, (s, n) in enumerate(words.items()) for i in range(20)]
    rows = [(100 * k + r[0], *r[1:]) for k, r in enumerate(rows)] + [(-1, None, "en", "empty"), (-2, "", None, None)]
    docs = frame(spark, rows)
    for entropy, repeats in ((0.95, 100.0), (0.99, 3.0), (0.2, 1.0)):
        totals = {}
        for r in mixing.mixture(docs, target_entropy=entropy, max_repeats=repeats).collect():
            assert r.copies >= 1
            totals[r.source] = totals.get(r.source, 0) + r.copies * r.n_tokens
        assert all(totals[s] <= repeats * n + 1e-6 for s, n in words.items())
        shares = [totals[s] / sum(totals.values()) for s in words]
        reached = -sum(p * math.log(p) for p in shares) / math.log(3)
        # A document is never cut, so a share falls short by one document at most.
        assert repeats < 100 or abs(reached - entropy) < 0.02
        assert totals["empty"] == 0 and totals[None] == 0
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns and mixed.select("doc_id").distinct().count() == len(rows)


@pytest.mark.parametrize("sizes", [1000, 1])
def test_whole_license_texts(spark, monkeypatch, sizes):
    monkeypatch.setattr(licenses, "SIZES", sizes)
    isc = dict(licenses.KNOWN[:10])["ISC"]
    text = "Copyright (c) 2019 Someone\n\n" + licenses.KNOWN[0][1].upper().replace(",", " ;") + "\n"
    rows = [
        (1, text, "en", "a"), (2, "Intro.\n\n" + text, "en", "a"), (3, "x\nLicenced under the  ISC Licence!\ny", "en", "a"),
        (4, "not Released under the MIT License", "en", "a"), (5, None, "en", "a"), (6, isc[:-3], "en", "a"),
    ]
    found = sorted((tuple(r) for r in licenses.scan(frame(spark, rows)).collect()), key=repr)
    # The emptied copyright line of the first is a paragraph of its own, so its second one matches too.
    assert found == [
        (1, "MIT", "paragraph", 1, None), (1, "MIT", "text", None, None), (2, "MIT", "paragraph", 1, None), (3, "ISC", "line", 0, 1)
    ]
    own = licenses.known_licenses(spark, [("X", "Some text of mine"), ("Y", "some TEXT, of mine.")])
    assert sorted(r.license for r in licenses.scan(frame(spark, [(7, "Some text of mine", None, None)]), own).collect()) == ["X", "Y"]


def wrapped(text, width):
    return "\n".join(textwrap.wrap(text, width, break_long_words=False))


def test_license_texts_at_any_width(spark):
    texts = [(name, text) for name, text in licenses.KNOWN if len(text) > 400]
    rows, expected = [], set()
    for k, (name, text) in enumerate(texts):
        for width in (40, 60, 61, 62, 63, 64, 65, 70, 72, 75, 76, 77, 78, 79, 80, 100, 10_000):
            rows.append((1000 * k + width, "Copyright (c) 2020 A\n  © B\nCopyright 2019, C\nCopyright D Inc\n" + wrapped(text, width), None, None))
            expected.add((1000 * k + width, name))
    found = licenses.scan(frame(spark, rows)).filter("unit = 'text'").collect()
    assert {(r.doc_id, r.license) for r in found} == expected
    assert {"MIT", "ISC", "BSD-2-Clause", "BSD-3-Clause", "0BSD", "Unlicense", "Zlib"} <= {name for name, _ in texts}


@pytest.mark.parametrize("digits", [1, 3])
def test_mixture_cut_in_many_blocks_and_regions(spark, monkeypatch, digits):
    monkeypatch.setattr(mixing, "BLOCK", 3)
    monkeypatch.setattr(mixing, "REGION_DIGITS", digits)
    # Repeated and null keys share their place; documents without words have one, too.
    rows = [(None if k % 41 == 0 else k // 2 if k % 7 == 0 else k, "w " * (k * 13 % 29), ("a", "b", None)[min(k % 9, 2)]) for k in range(900)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    sized = mixing._sized(docs, "doc_id", "text", "source").cache()
    by_source = mixing.shares(sized).cache()
    budget = {r.source: (r.epochs, r.rest) for r in by_source.collect()}
    assert any(rest for _, rest in budget.values())
    ordered = sorted(mixing._shuffled(sized, by_source).collect(), key=lambda r: (r.source or "", r.by_block, r.by_doc))
    expected = []
    for source, (epochs, rest) in budget.items():
        spent, places = 0, {}
        for r in (r for r in ordered if r.source == source):
            places.setdefault((r.by_block, r.by_doc), []).append(r)
        for group in places.values():
            spent += sum(r.n_tokens for r in group)
            expected += [(r.doc_id, source, r.n_tokens, 1 + epochs + (spent <= rest and rest > 0)) for r in group]
    found = [(r.doc_id, r.source, r.n_tokens, r.copies) for r in mixing.mixture(docs).collect()]
    assert sorted(found, key=repr) == sorted(expected, key=repr)
