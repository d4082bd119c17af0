"""Whitening of embeddings along the eigenvectors of their covariance, found by spectral divide and conquer.

Entries become whole numbers, so repeated vectors are recognised exactly and the fit, over each distinct vector once, has exact sums. Three
passes over the distinct vectors give those sums, the covariance and a check of the result; each task adds up its rows and
hands on one number for each pair of dimensions. What reaches the driver has the square of the dimensions as size, never that of the table.

The covariance ``V`` is then split without a general eigensolver: the orthogonal polar factor ``U`` of ``V - s I``, from QR-based
dynamically weighted Halley steps (QDWH), has eigenvalue 1 where ``V`` is above the shift ``s`` and -1 below. So ``(U + I) / 2`` projects on one
invariant subspace and ``(I - U) / 2`` on the other, whose bases turn ``V`` into two smaller matrices, which are split in turn until
they are diagonal. What the whitening broadcasts is a mean and at most ``components`` vectors.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallylog.llm.common import cut_lineage, quoted, small_batches

COMPONENTS = 16
# Steps of the grid, and the number added to it.
GRID, OFFSET = 64, 1_000_000
# Whole numbers beyond this can't be told apart as doubles.
LARGEST = 2**53 // GRID
# Vectors longer than this would make the driver's matrices too large: 128 MB each.
MOST_DIMENSIONS = 4096
_EPS = np.finfo(np.float64).eps


def polar_factor(a: np.ndarray) -> np.ndarray:
    """The orthogonal polar factor of a symmetric matrix, by QDWH steps; each is one QR factorisation."""
    n = len(a)
    x = a / np.linalg.norm(a)
    # A lower bound of the smallest singular value; a bound too low costs steps, not accuracy.
    low = max(np.linalg.norm(np.linalg.qr(x)[1].diagonal(), -np.inf) / (10 * n), _EPS)
    for _ in range(60):
        square = low * low
        d = np.cbrt(4 * (1 - square) / (square * square))
        h = np.sqrt(1 + d) + 0.5 * np.sqrt(8 - 4 * d + 8 * (2 - square) / (square * np.sqrt(1 + d)))
        b = (h - 1) ** 2 / 4
        c = h + b - 1
        q, _ = np.linalg.qr(np.vstack([np.sqrt(c) * x, np.eye(n)]))
        after = b / c * x + (h - b / c) / np.sqrt(c) * q[:n] @ q[n:].T
        after = (after + after.T) / 2
        change = np.linalg.norm(after - x)
        x, low = after, min(1.0, low * (h + b * square) / (1 + c * square))
        if change <= np.sqrt(n) * 1e-15 or (low >= 1 - 10 * _EPS and change <= np.cbrt(_EPS) * 1e-2):
            break
    return x


def _shift(diagonal: np.ndarray) -> float:
    """Inside the widest gap in the middle half of the diagonal. Between its ends, so eigenvalues lie on both sides."""
    values = np.sort(diagonal)
    first = (len(values) - 1) // 4
    k = first + int(np.argmax(np.diff(values)[first : len(values) - 1 - first]))
    return float((values[k] + values[k + 1]) / 2)


def _basis(projector: np.ndarray, rank: int) -> np.ndarray:
    """Orthonormal columns that span the range of a projector: a pivoted QR of ``rank`` steps, and one step of iteration."""
    left, columns = projector.copy(), []
    for _ in range(rank):
        norms = np.linalg.norm(left, axis=0)
        k = int(np.argmax(norms))
        q = left[:, k] / norms[k]
        columns.append(q)
        left -= np.outer(q, q @ left)
    return np.linalg.qr(projector @ np.stack(columns, axis=1))[0]


def _halves(a: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
    """Bases of the subspaces above and below a shift, or None if all eigenvalues are equal to rounding."""
    n, mean = len(a), a.diagonal().mean()
    size = np.linalg.norm(a - mean * np.eye(n))
    if size <= n * _EPS * abs(mean):
        return None
    # A shift that happens to be an eigenvalue leaves no clean projector, so the next one is tried.
    for shift in (_shift(a.diagonal()), mean, mean + size * 1e-3 / n, mean - size * 1e-3 / n, mean + size * 1e-9):
        u = polar_factor(a - shift * np.eye(n))
        rank = int(round((np.trace(u) + n) / 2))
        if not 0 < rank < n:
            continue
        above, below = _basis((np.eye(n) + u) / 2, rank), _basis((np.eye(n) - u) / 2, n - rank)
        mixed = np.linalg.norm(below.T @ (a - mean * np.eye(n)) @ above)
        if np.linalg.norm(below.T @ above) <= 1e-11 and mixed <= 1e-12 * size + 8 * n * _EPS * abs(mean):
            return above, below
    raise ArithmeticError("no shift splits the covariance")


def spectral_split(v: np.ndarray, wanted: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` largest eigenvalues (all by default), falling, and their eigenvectors as columns, of a symmetric matrix."""
    wanted, scale = len(v) if wanted is None else wanted, np.linalg.norm(v)
    values, vectors = np.zeros(0), np.zeros((len(v), 0))
    waiting = [np.eye(len(v))] if len(v) else []
    while waiting and len(values) < wanted:  # the topmost subspace comes first
        basis = waiting.pop()
        a = basis.T @ v @ basis
        a = (a + a.T) / 2
        diagonal = a.diagonal()
        parts = None
        if np.linalg.norm(a - np.diag(diagonal)) > 2 * len(a) * _EPS * scale:
            parts = _halves(a)
        if parts is None:
            order = np.argsort(-diagonal, kind="stable")
            values, vectors = np.concatenate([values, diagonal[order]]), np.hstack([vectors, basis[:, order]])
        else:
            waiting += [np.linalg.qr(basis @ part)[0] for part in reversed(parts)]
    order = np.argsort(-values, kind="stable")[:wanted]
    return values[order], vectors[:, order]


@dataclass(frozen=True)
class Fit:
    """Number of distinct vectors, their sums, eigenvalues, eigenvectors (columns), trace, and the check of the whitening."""

    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    identity_error: float


def deviations(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """``n x - S``, exact: as 64-bit numbers, or as Python's where those are too short."""
    rough = np.abs(n * x.astype(np.float64) - np.array(sums, np.float64))
    if rough.max(initial=0) < 2**62:  # what overflows on the way cancels out
        return x * np.int64(n) - np.array([(s + 2**63) % 2**64 - 2**63 for s in sums], np.int64)
    return x.astype(object) * n - np.array(sums, object)


def _projected(x: np.ndarray, n: int, sums: list[int], vectors: np.ndarray, values: np.ndarray) -> np.ndarray:
    return (deviations(x, n, sums) / n).astype(np.float64) @ vectors / np.sqrt(values)


def _stacked(vectors: pa.Array) -> np.ndarray:
    return vectors.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(vectors), -1)


def _totals(fit: DataFrame, measure, kind: str) -> np.ndarray:
    """The sum over all vectors of what ``measure`` gives for a batch of them: one row a task and place is shuffled."""

    def add(batches):
        total = 0
        for batch in batches:
            total = total + measure(_stacked(batch.column(0)))
        if not np.isscalar(total):
            flat = total.ravel()
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(flat))), pa.array(flat)], names=["place", "part"])

    parts = small_batches(fit).select("x").mapInArrow(add, f"place bigint, part {kind}")
    found = parts.groupBy("place").agg(F.sum("part").alias("total")).toArrow()
    out = np.zeros(found.num_rows, found["total"].to_numpy().dtype)
    out[found["place"].to_numpy()] = found["total"].to_numpy()
    return out


def on_grid(vector: Column) -> Column:
    """``floor(64 c) + 1000000`` of every entry; null for vectors that are null, empty, or hold null, non-finite or huge entries."""
    bad = F.exists(vector, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) >= LARGEST))
    whole = F.transform(vector, lambda c: F.floor(F.lit(float(GRID)) * c) + F.lit(OFFSET).cast("bigint"))
    return F.when((F.size(vector) > 0) & ~bad, whole)


def fit_whitening(fit: DataFrame, components: int = COMPONENTS) -> Fit:
    """Fits on ``x``, a stored table of distinct whole-number vectors of one length."""
    low = (1 << 26) - 1
    counted = _totals(fit, lambda x: np.concatenate([[len(x)], (x >> 26).sum(axis=0), (x & low).sum(axis=0)]), "bigint")
    n, d = int(counted[0]), len(counted) // 2
    sums = [(int(a) << 26) + int(b) for a, b in zip(counted[1 : d + 1], counted[d + 1 :])]

    def squares(x: np.ndarray) -> np.ndarray:
        y = (deviations(x, n, sums) / n).astype(np.float64)
        return y.T @ y

    v = _totals(fit, squares, "double").reshape(d, d) / n
    v = (v + v.T) / 2
    values, vectors = spectral_split(v, components)
    # A direction without any variance can't be whitened.
    real = values > d * _EPS * np.trace(v)
    values, vectors = values[real], vectors[:, real]
    error = 0.0
    if len(values):

        def moments(x: np.ndarray) -> np.ndarray:
            w = _projected(x, n, sums, vectors, values)
            return np.concatenate([w.sum(axis=0), (w.T @ w).ravel()])

        total = _totals(fit, moments, "double") / n
        mean, second = total[: len(values)], total[len(values) :].reshape(len(values), -1)
        error = float(np.abs(second - np.outer(mean, mean) - np.eye(len(values))).max())
    return Fit(n, sums, values, vectors, float(np.trace(v)), error)


def whitened(table: DataFrame, components: int = COMPONENTS, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error``: every vector along the first ``components`` eigenvectors.

    Left out are vectors that are null, empty, or hold null, non-finite or huge entries (2^47 and more), and those of another length than
    most have (of lengths equally frequent, the smaller counts). Repeated rows and null keys are rows of the result like all others. Components
    without variance are left out, so equal vectors only, or an empty table, give no rows. ``deviation`` is null where it passes 64 bits.
    Other columns play no part.
    """
    rows = table.select(quoted(key).alias("vec_id"), on_grid(quoted(vector).cast("array<double>")).alias("x")).filter("x IS NOT NULL")
    lengths = rows.groupBy(F.size("x").alias("d")).agg(F.count(F.lit(1)).alias("rows"))
    most = lengths.orderBy(F.desc("rows"), "d").first()
    d = most["d"] if most else 0
    if d > MOST_DIMENSIONS:
        raise ValueError(f"vectors of {d} dimensions, at most {MOST_DIMENSIONS} can be whitened")
    rows = rows.filter(F.size("x") == d)
    found = Fit(0, [], np.zeros(0), np.zeros((0, 0)), 0.0, 0.0)
    if most:
        found = fit_whitening(cut_lineage(rows.select("x").distinct()), components)
    n, sums, values, vectors = found.n, found.sums, found.values, found.vectors

    @F.arrow_udf("struct<deviation: bigint, whitened: array<double>>")
    def measured(x: pa.Array) -> pa.Array:
        whole = deviations(_stacked(x), n, sums)
        if np.abs(whole).max(initial=0) >= 2**31 // max(1, d):
            whole = whole.astype(object)
        square = [s if s < 2**63 else None for s in (whole * whole).sum(axis=1).tolist()]
        w = _projected(_stacked(x), n, sums, vectors, values)
        lists = pa.ListArray.from_arrays(pa.array(np.arange(len(w) + 1) * w.shape[1], pa.int32()), pa.array(w.ravel()))
        return pa.StructArray.from_arrays([pa.array(square, pa.int64()), lists], names=["deviation", "whitened"])

    if not len(values):
        return rows.select("vec_id", *[F.lit(None).cast(kind).alias(name) for name, kind in _MEASURES.items()]).limit(0)
    shares = F.array(*[F.lit(float(value / found.trace)) for value in values])
    each = small_batches(rows).select("vec_id", measured("x").alias("m"))
    each = each.select("vec_id", "m.deviation", F.posexplode("m.whitened").alias("k", "whitened"))
    return each.select(
        "vec_id",
        (F.col("k") + 1).alias("component"),
        F.lit(n).cast("bigint").alias("n"),
        "deviation",
        "whitened",
        shares[F.col("k")].alias("explained"),
        F.lit(found.identity_error).alias("identity_error"),
    )


_MEASURES = {"component": "int", "n": "bigint", "deviation": "bigint", "whitened": "double", "explained": "double", "identity_error": "double"}
