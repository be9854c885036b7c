"""Exact discrete quantiles without gathering a column into one task.

The value returned for probability q is the one at 1-based rank ceil(q * n)
in ascending order (``percentile_disc``; equal to ``approxQuantile`` with
relative error 0). Spark's exact aggregates merge every distinct value in a
single task, which does not scale. Here each quantile is narrowed to a value
bracket with ``percentile_approx`` (bounded sketch) plus exact counts, and
only when a bracket holds at most ``final_rows`` rows is the value picked by
a sort limited to that bracket.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _in(col: str, lo, hi):
    """Inside the open bracket (lo, hi)."""
    c = F.col(col)
    cond = F.lit(True)
    if lo is not None:
        cond = cond & (c > F.lit(lo))
    if hi is not None:
        cond = cond & (c < F.lit(hi))
    return cond


def exact_quantiles(df: DataFrame, cols: list[str], qs: list[float], accuracy: int = 10000,
                    final_rows: int = 100_000, n: int | None = None) -> dict[tuple[str, float], float]:
    """``{(col, q): value}``; NULLs are ignored (as percentile_disc does).

    Every pass counts the rows below and up to both edges of each open target:
    a rank inside an edge's run of equal values is answered there and then, so
    ties cost nothing, and a bracket always loses its edges, so passes end.
    """
    if n is None:
        r = df.agg(*[F.count(c).alias(c) for c in cols]).first()
        counts = {c: int(r[c]) for c in cols}
    else:
        counts = {c: n for c in cols}
    # state per target: open bracket (lo, hi), rows at or below lo, rows inside
    state, out = {}, {}
    for c in cols:
        for q in qs:
            if counts[c]:
                state[(c, q)] = {"rank": max(1, math.ceil(q * counts[c])), "lo": None, "hi": None,
                                 "below": 0, "inside": counts[c]}
    delta = 2.0 / accuracy
    while open_ := [t for t, s in state.items() if t not in out and s["inside"] > final_rows]:
        # 1) approximate values around the target rank inside each bracket
        aggs = []
        for i, (c, q) in enumerate(open_):
            s = state[(c, q)]
            p = (s["rank"] - s["below"]) / s["inside"]
            probs = [max(0.0, p - delta), min(1.0, p + delta)]
            x = F.when(_in(c, s["lo"], s["hi"]), F.col(c))
            aggs.append(F.percentile_approx(x, probs, accuracy).alias(f"a{i}"))
        approx = df.agg(*aggs).first()
        # 2) exact counts below and up to the candidate edges
        cnt = []
        for i, (c, q) in enumerate(open_):
            for j, v in enumerate(approx[f"a{i}"]):
                cnt += [F.count_if(F.col(c) < F.lit(v)).alias(f"l{i}_{j}"), F.count_if(F.col(c) <= F.lit(v)).alias(f"u{i}_{j}")]
        edges = df.agg(*cnt).first()
        for i, t in enumerate(open_):
            s = state[t]
            for j, v in enumerate(approx[f"a{i}"]):
                less, upto = edges[f"l{i}_{j}"], edges[f"u{i}_{j}"]
                top = s["below"] + s["inside"]
                if less < s["rank"] <= upto:
                    out[t] = float(v)
                    break
                if s["rank"] > upto and upto >= s["below"]:
                    s.update(lo=v, below=upto, inside=top - upto)
                elif s["rank"] <= less and less <= top:
                    s.update(hi=v, inside=less - s["below"])
    for (c, q), s in state.items():
        if (c, q) not in out:
            pos = s["rank"] - s["below"]  # 1-based inside the bracket
            row = (df.where(_in(c, s["lo"], s["hi"]) & F.col(c).isNotNull()).select(c)
                   .orderBy(c).offset(pos - 1).limit(1).first())
            out[(c, q)] = float(row[0])
    return out
