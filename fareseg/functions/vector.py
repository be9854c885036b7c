"""SQL expressions for small dense vectors held in flat DOUBLE columns.

Models (k centroids, k Gaussians) are driver-side literals of size k x d;
every per-row computation is an unrolled expression that stays inside
whole-stage codegen. Expressions are generated as SQL text: one JVM call per
output column instead of one per operator node, which matters for loops that
rebuild them every round.
"""

from __future__ import annotations

import math
from collections.abc import Sequence


def lit(v: float) -> str:
    """Exact DOUBLE literal (shortest round-trip text)."""
    v = float(v)
    if math.isnan(v):
        return "double('NaN')"
    if math.isinf(v):
        return "double('Infinity')" if v > 0 else "double('-Infinity')"
    return f"({v!r}D)"


def q(name: str) -> str:
    return f"`{name}`"


def sum_sql(terms: Sequence[str]) -> str:
    """Left-to-right sum (same association as the SQL oracles)."""
    return " + ".join(terms) if len(terms) > 1 else terms[0]


def sq_distance(cols: Sequence[str], center: Sequence[float]) -> str:
    terms = []
    for c, v in zip(cols, center):
        d = f"({q(c)} - {lit(v)})"
        terms.append(f"({d} * {d})")
    return sum_sql(terms)


def sq_norm(cols: Sequence[str]) -> str:
    return sum_sql([f"({q(c)} * {q(c)})" for c in cols])


def first_argmin(names: Sequence[str]) -> str:
    """0-based index of the smallest column, first index on ties."""
    m = "least(" + ", ".join(q(n) for n in names) + ")"
    return "cast(case " + " ".join(f"when {q(n)} = {m} then {i}" for i, n in enumerate(names)) + " end as int)"


def first_argmax(names: Sequence[str]) -> str:
    """0-based index of the largest column, first index on ties."""
    m = "greatest(" + ", ".join(q(n) for n in names) + ")"
    return "cast(case " + " ".join(f"when {q(n)} = {m} then {i}" for i, n in enumerate(names)) + " end as int)"
