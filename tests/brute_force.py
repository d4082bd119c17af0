"""Plain-Python statements of the rules, for brute-force comparison on small inputs."""

from __future__ import annotations

from fractions import Fraction


def window_of(n: int, requested: int) -> tuple[int, int]:
    if n < 3:
        return 0, 0
    w = max(5, requested) | 1
    w = min(w, n if n % 2 else n - 1)
    return w, 1 if w == 3 else 2


def weights(w: int, order: int) -> list[Fraction]:
    """Least squares at the centre, from the power sums of the positions."""
    h = w // 2
    ks = range(-h, h + 1)
    s0, s2, s4 = (sum(Fraction(k) ** p for k in ks) for p in (0, 2, 4))
    if order == 1:
        return [1 / s0 for _ in ks]
    det = s0 * s4 - s2 * s2
    return [(s4 - s2 * k * k) / det for k in ks]


def mirrored(values: list[int], i: int) -> int:
    last = len(values) - 1
    return values[-i] if i < 0 else values[2 * last - i] if i > last else values[i]


def smooth(values: list[int], requested: int) -> list[Fraction]:
    w, order = window_of(len(values), requested)
    if not w:
        return [Fraction(v) for v in values]
    c, h = weights(w, order), w // 2
    return [sum(c[k + h] * mirrored(values, i + k) for k in range(-h, h + 1)) for i in range(len(values))]


def median(values: list) -> float:
    ordered, n = sorted(values), len(values)
    return (ordered[(n - 1) // 2] + ordered[n // 2]) / 2


def sparse_minutes(present: set[int]) -> set[int]:
    ordered = sorted(present)
    edges = set()
    for a, b in zip(ordered, ordered[1:]):
        if b - a > 1:
            edges |= {a + 1, b - 1}
    return present | edges


def evenly(n: int, cap: int) -> set[int]:
    if n <= cap:
        return set(range(n))
    return set(range(0, n, max(1, n // cap))) | {n - 1}


def around_anomalies(n: int, flagged: set[int], cap: int) -> set[int]:
    if n <= cap:
        return set(range(n))
    near = {i + d for i in flagged for d in range(-2, 3)}
    return set(range(0, n, -(-n // cap))) | {i for i in near if 0 <= i < n}
