"""Whitening against a plain fit with exact sums and a general eigensolver."""

from __future__ import annotations

import math
from fractions import Fraction

import numpy as np
import pytest

from tallylog.llm.queries import QUERIES
from tallylog.llm.whitening import polar_factor, spectral_split, whitened

SCHEMA = "vec_id bigint, embedding array<float>, label int, x string, k string"


def plain(rows, components=16):
    """By key: (deviation, whitened), with n, explained and the whitened covariance of the fit list."""
    good = [(k, [math.floor(64 * c) + 1_000_000 for c in v]) for k, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    fit = sorted({tuple(x) for _, x in good})
    n, sums = len(fit), [sum(column) for column in zip(*fit)]
    y = np.array([[float(Fraction(n * a - s, n)) for a, s in zip(x, sums)] for x in fit])
    values, vectors = np.linalg.eigh(y.T @ y / n)
    values, vectors = values[::-1][:components], vectors[:, ::-1][:, :components]
    out = []
    for k, x in good:
        whole = [n * a - s for a, s in zip(x, sums)]
        out.append((k, sum(w * w for w in whole), (np.array(whole) / n) @ vectors / np.sqrt(values)))
    return n, out, values / np.trace(y.T @ y / n)


def compare(found, rows, components=16):
    n, expected, explained = plain(rows, components)
    by_key = {}
    for r in found:
        assert r.n == n and abs(r.explained - explained[r.component - 1]) < 1e-9 and 0 <= r.identity_error < 1e-9
        by_key.setdefault(r.vec_id, {})[r.component] = r
    assert len(by_key) == len({k for k, _, _ in expected}) and len(found) == components * len(expected)
    whole = np.array([[by_key[k][c + 1].whitened for c in range(components)] for k, _, _ in expected])
    for k, deviation, _ in expected:
        assert {r.deviation for r in by_key[k].values()} == {deviation}
    right = np.array([w for _, _, w in expected])
    signs = np.sign((whole * right).sum(axis=0))
    assert np.abs(whole - right * signs).max() < 1e-6


def frame(spark, rows):
    return spark.createDataFrame([(k, v, 0, "x", "k") for k, v in rows], SCHEMA)


def vectors(seed, n, d):
    draw = np.random.default_rng(seed)
    spread = draw.standard_normal((d, d)) * np.linspace(0.1, 2, d)
    return [(k, [float(np.float32(c)) for c in v]) for k, v in enumerate(draw.standard_normal((n, d)) @ spread + draw.standard_normal(d) * 50)]


def test_whitening_of_odd_rows(spark):
    rows = vectors(1, 300, 20)
    rows += [(1000 + k, rows[k % 5][1]) for k in range(200)]  # a hot group of copies counts once
    bad = [(-1, None), (-2, [None] * 20), (-3, [1.0] * 19 + [float("nan")]), (-4, [float("inf")] + [0.0] * 19), (-5, [])]
    other = [(-6, [1.0, 2.0])]
    found = whitened(frame(spark, rows + bad + other).repartition(5)).collect()
    compare(found, rows)


def test_far_entries_stay_exact(spark):
    rows = vectors(2, 40, 3) + [(100, [1e13, -1e12, 3.5]), (101, [-1e13, 5.0, 1e10])]
    _, expected, _ = plain(rows, 3)
    found = {r.vec_id: r.deviation for r in whitened(frame(spark, rows), 3).collect()}
    assert found == {k: d if d < 2**63 else None for k, d, _ in expected}
    assert found[100] is None and found[0] is None


def test_without_variance(spark):
    assert whitened(frame(spark, [])).collect() == []
    empty = whitened(frame(spark, [(1, None)]))
    assert empty.collect() == [] and empty.columns[:3] == ["vec_id", "component", "n"]
    assert whitened(frame(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).collect() == []
    flat = whitened(frame(spark, [(k, [float(k), 3.0, 2.0 * k]) for k in range(9)])).collect()
    assert {r.component for r in flat} == {1} and abs(flat[0].explained - 1) < 1e-12


@pytest.mark.parametrize("seed", range(12))
def test_split_equals_a_general_solver(seed):
    draw = np.random.default_rng(seed)
    n = int(draw.integers(1, 70))
    q = np.linalg.qr(draw.standard_normal((n, n)))[0]
    values = [draw.random(n), np.round(draw.random(n) * 3), 10.0 ** -draw.integers(0, 12, n), np.ones(n)][seed % 4]
    v = q @ np.diag(values) @ q.T
    v = (v + v.T) / 2
    found, basis = spectral_split(v)
    assert np.abs(found - np.sort(values)[::-1]).max() < 1e-12
    assert np.abs(basis.T @ basis - np.eye(n)).max() < 1e-12
    assert np.abs(v @ basis - basis * found).max() < 1e-11
    top, columns = spectral_split(v, 3)
    assert np.abs(top - np.sort(values)[::-1][:3]).max() < 1e-12 and columns.shape == (n, min(3, n))


def test_polar_factor():
    draw = np.random.default_rng(3)
    a = draw.standard_normal((30, 30))
    a = a + a.T
    u = polar_factor(a)
    assert np.abs(u @ u - np.eye(30)).max() < 1e-12 and np.linalg.eigvalsh(u @ a).min() > -1e-12


def test_query_over_a_whole_table(spark):
    folder = "/root/testdata/sf0.01"
    table = spark.read.parquet(f"{folder}/embeddings.parquet").select("vec_id", "embedding").collect()
    compare(QUERIES["op13_whitening"](spark, folder).collect(), [tuple(r) for r in table])
