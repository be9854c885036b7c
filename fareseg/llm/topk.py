"""Exact top-k inner products: norm-sorted scan with rotated partial sums.

Integer vectors are rotated onto the eigenvectors of their Gram matrix (one
bounded partial per task), so the first coordinates carry most of every product.
Candidates are dealt by descending length into stripes, one a task; queries travel
to stripes, never rows to queries, and stream past the stripe. A chunk stops a
query when length times length can't reach its k-th best; otherwise a partial
product plus the Cauchy-Schwarz bound of both remainders prunes, and only the
pairs left get their exact integer product. All queries meet the longest stripe
first. That gives each its starting bound and, by the longest row of every other
stripe, the stripes that can still win: to the rest it isn't sent at all. Bounds
are compared with a margin above rounding, and equal scores are never pruned, so
results are exact.

Null vectors and those with null or non-finite numbers take no part; vectors of
different length aren't compared; a query never meets its own row, but repeated
rows do meet. Null ids are no queries and rank last among equal scores.
Coordinates and scores beyond a 64-bit integer saturate at its limits.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fareseg.llm.common import written

STRIPE = 8192
#: Queries compared with a stripe at once.
GROUP = 512
CHUNK = 1024
_LAST = np.iinfo(np.int64).max
_RANK = "query long, rid long, vec_id long, score long"


def integers(emb: DataFrame, scale: int = 256) -> DataFrame:
    """``rid, vec_id, v`` (long coordinates), ``dim, norm`` of the rows that take part."""
    x = F.col("embedding")
    fit = F.coalesce(F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))), F.lit(False))
    rows = emb.select(F.monotonically_increasing_id().alias("rid"), F.col("vec_id").cast("long").alias("vec_id"), "embedding").where(fit)
    v = F.transform(x, lambda a: F.floor(a.cast("double") * scale).cast("long"))
    rows = rows.select("rid", "vec_id", v.alias("v"))
    square = F.aggregate("v", F.lit(0.0), lambda a, b: a + b.cast("double") * b.cast("double"))
    return rows.select("*", F.size("v").alias("dim"), F.sqrt(square).alias("norm"))


def rotations(rows: DataFrame) -> dict[int, np.ndarray]:
    """Per vector length, the Gram matrix's eigenvectors, strongest first."""
    def partials(batches):
        sums: dict[int, np.ndarray] = {}
        for b in batches:
            size = b.column(0).value_lengths().to_numpy()
            flat = b.column(0).flatten().to_numpy().astype(float)
            cut = np.concatenate([[0], np.cumsum(size)])
            for d in np.unique(size[size > 0]):
                x = flat[cut[:-1][size == d][:, None] + np.arange(d)]
                sums[int(d)] = sums.get(int(d), 0.0) + x.T @ x
        if sums:
            yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([s.ravel() for s in sums.values()],
                                                                                         pa.list_(pa.float64()))], ["dim", "g"])

    parts = rows.select("v").mapInArrow(partials, "dim int, g array<double>").select("dim", F.posexplode("g").alias("i", "x"))
    out: dict[int, np.ndarray] = {}
    for r in parts.groupBy("dim", "i").agg(F.sum("x").alias("x")).collect():
        out.setdefault(r["dim"], np.zeros(r["dim"] ** 2))[r["i"]] = r["x"]
    return {d: np.linalg.eigh(g.reshape(d, d))[1][:, ::-1] for d, g in out.items()}


def _matrix(t: pa.Table, d: int) -> np.ndarray:
    return t["v"].combine_chunks().flatten().to_numpy().reshape(t.num_rows, d) if t.num_rows else np.zeros((0, d), np.int64)


class Stripe:
    """Candidate rows of one vector length, longest first, rotated."""

    def __init__(self, rows: pa.Table, rotation: np.ndarray | None) -> None:
        rows = rows.sort_by([("norm", "descending")])
        self.d = d = rows["dim"][0].as_py()
        self.rotation = np.eye(d) if rotation is None else rotation
        self.head = max(1, d // 2) if d else 0
        self.c = _matrix(rows, d)
        self.cr = self.c @ self.rotation
        self.rest = np.linalg.norm(self.cr[:, self.head:], axis=1)
        self.norm, self.rid, self.vid = rows["norm"].to_numpy(), rows["rid"].to_numpy(), rows["vec_id"].to_pylist()

    def products(self, q: np.ndarray, i: np.ndarray, j: np.ndarray, wide: bool) -> np.ndarray:
        """Exact products of the pairs, saturating where they could pass 64 bits (``wide``)."""
        out = np.empty(len(i), np.int64)
        for s in range(0, len(i), 1 << 16):
            a, b = q[i[s:s + (1 << 16)]], self.c[j[s:s + (1 << 16)]]
            out[s:s + (1 << 16)] = ([min(max(int(x), -_LAST - 1), _LAST) for x in (a.astype(object) * b).sum(axis=1)] if wide and self.d
                                    else np.einsum("ij,ij->i", a, b))
        return out

    def scan(self, queries: pa.Table, k: int) -> list[tuple]:
        """Each query's best k of these rows as (query, rid, vec_id, score)."""
        q, head = _matrix(queries, self.d), self.head
        qr = q @ self.rotation
        rest_q, norm_q, qid = np.linalg.norm(qr[:, head:], axis=1), queries["norm"].to_numpy(), queries["rid"].to_numpy()
        wide = float(norm_q.max()) * float(self.norm[0]) >= 2.0 ** 62
        best: list[list] = [[] for _ in qid]
        bound = np.array([-np.inf if x is None else float(x) for x in queries["least"].to_pylist()])
        for lo in range(0, len(self.rid), CHUNK):
            hi = min(lo + CHUNK, len(self.rid))
            live = np.flatnonzero(norm_q * self.norm[lo] * (1 + 1e-9) + 1 >= bound)
            if not len(live):
                break
            most = qr[live, :head] @ self.cr[lo:hi, :head].T + rest_q[live][:, None] * self.rest[None, lo:hi]
            slack = 1 + 1e-9 * norm_q[live][:, None] * self.norm[None, lo:hi]
            i, j = np.nonzero(most + slack >= bound[live][:, None])
            exact = self.products(q, live[i], lo + j, wide)
            good = exact >= bound[live[i]]
            i, j, exact = live[i[good]], lo + j[good], exact[good]
            cuts = np.searchsorted(i, np.arange(len(qid) + 1))
            for x in np.unique(i):
                a, b = cuts[x], cuts[x + 1]
                s, at = exact[a:b], j[a:b]
                if len(s) > 4 * k + 4:  # only what reaches the k-th best of these, one more for the query itself
                    top = s >= np.partition(s, len(s) - k - 1)[len(s) - k - 1]
                    s, at = s[top], at[top]
                new = [(-int(v), self.vid[p] is None, self.vid[p] if self.vid[p] is not None else 0, int(self.rid[p]))
                       for v, p in zip(s, at) if self.rid[p] != qid[x]]
                best[x] = sorted(best[x] + new)[:k]
                if len(best[x]) == k:
                    bound[x] = max(bound[x], -best[x][-1][0])
        return [(int(qid[x]), r, None if none else v, -s) for x, b in enumerate(best) for s, none, v, r in b]


def _visit(rows: DataFrame, queries: DataFrame, stripes: int, k: int, turn: dict[int, np.ndarray]) -> DataFrame:
    """Each query's best k in every stripe it is sent to; ``queries`` has ``stripe, rid, dim, norm, v, least``."""
    columns = ["stripe", "rid", "vec_id", "dim", "norm", "v"]
    met = rows.select(*columns, F.lit(False).alias("asks"), F.lit(None).cast("long").alias("least")).unionByName(
        queries.select(*columns, F.lit(True).alias("asks"), "least"))
    met = met.repartitionById(stripes, F.col("stripe")).sortWithinPartitions("asks", "dim", F.desc("norm"), "rid")

    def run(batches):
        held: list[pa.RecordBatch] = []
        of: dict[int, Stripe] | None = None
        for b in batches:
            cut = int(np.searchsorted(b.column("asks").to_numpy(zero_copy_only=False), True))
            if cut:
                held.append(b.slice(0, cut))
            if cut == b.num_rows or not held:
                continue
            if of is None:
                t = pa.Table.from_batches(held)
                dim = t["dim"].to_numpy()
                of = {int(d): Stripe(t.take(np.flatnonzero(dim == d)), turn.get(int(d))) for d in np.unique(dim)}
            asked = pa.Table.from_batches([b.slice(cut)])
            dim = asked["dim"].to_numpy()
            for d in np.unique(dim).tolist():
                at = np.flatnonzero(dim == d)
                for s in range(0, len(at) if d in of else 0, GROUP):
                    out = of[d].scan(asked.take(at[s:s + GROUP]), k)
                    if out:
                        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], ["query", "rid", "vec_id", "score"])

    return met.mapInArrow(run, _RANK)


def still_open(queries: DataFrame, tops: DataFrame, first: int, stripes: int) -> DataFrame:
    """Each query (``norm``, ``least``: its k-th best so far, or null) once for every other stripe whose longest row may still win."""
    reach = F.col("norm") * F.col("top") * (1 + 1e-9) + 1
    every = F.explode(F.sequence(F.lit(0), F.lit(stripes - 1)))
    sent = queries.select("rid", "norm", "least").withColumn("stripe", every).where(F.col("stripe") != first)
    sent = sent.join(tops, "stripe").where(F.col("least").isNull() | (reach >= F.col("least"))).select("rid", "stripe")
    return sent.join(queries, "rid")


def top_inner_products(emb: DataFrame, k: int = 5, every: int = 50, scale: int = 256) -> DataFrame:
    """``query_id, rank, vec_id, score``: each query's k best other rows, ties to the smaller vec_id."""
    n = emb.count()  # from the file footers; rows that take no part only make stripes a little shorter
    stripes = max(1, math.ceil(n / STRIPE))
    rows = (integers(emb, scale).repartitionByRange(stripes, F.col("norm").desc(), F.xxhash64("rid"))
            .withColumn("stripe", F.spark_partition_id()))
    rows = written(rows, "stripes")
    turn = rotations(rows)
    asked = rows.where(F.pmod("vec_id", F.lit(every)) == 0)
    tops = rows.groupBy("stripe").agg(F.max("norm").alias("top"))
    first = rows.agg(F.min("stripe")).first()[0] or 0  # a stripe may be empty
    start = written(_visit(rows.where(F.col("stripe") == first), asked.withColumns({"stripe": F.lit(first), "least": F.lit(None).cast("long")}),
                           stripes, k, turn), "longest")
    least = start.groupBy("query").agg(F.min("score").alias("least"), F.count("*").alias("n")).where(F.col("n") == k)
    later = asked.drop("stripe").join(least.select(F.col("query").alias("rid"), "least"), "rid", "left")
    found = start
    if stripes > 1:
        found = start.unionByName(_visit(rows.where(F.col("stripe") != first), still_open(later, tops, first, stripes), stripes, k, turn))
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "rid")
    best = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    names = asked.select(F.col("rid").alias("query"), F.col("vec_id").alias("query_id"))
    return best.join(names, "query").select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
