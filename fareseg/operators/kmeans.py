"""Lloyd k-means: the model, its assignment columns, its seeds and its loop input.

The rounds themselves are in ``sweep.py``, which advances any number of models
in the same scan; a single fit is a sweep of one. Only model-sized vectors
come back to the driver, the same bits however the rows are partitioned (see
``scan.py``).

Stopping follows the reference: a round compares the assignment under the
centroids it just produced with the one before; round 1 counts every row.
That comparison is known one scan later, so a fit of t rounds costs t + 1
scans and one more for the cost and the silhouette statistics.
Empty clusters keep their previous centroid (and report n = 0).
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

import numpy as np
from pyspark import RDD, StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareseg.functions.vector import first_argmin, lit, q, sq_distance, sq_norm, sum_sql
from fareseg.operators.sampling import seed_rows
from fareseg.operators.scan import Extent, blocked, extent, held


@dataclass
class ClusterStats:
    """Per-cluster sufficient statistics under one assignment."""
    n: np.ndarray          # (k,)
    sums: np.ndarray       # (k, d)
    sqnorm: np.ndarray     # (k,)
    changed: int = 0
    sum_distance: float = 0.0
    wssse: float = 0.0


@dataclass
class KMeansModel:
    cols: list[str]
    centroids: np.ndarray               # (k, d)
    stats: ClusterStats                 # under the final assignment
    rounds: int
    converged: bool
    reassigned: list[int] = field(default_factory=list)  # per round; round 1 = N
    distances: int = 0                  # row-centroid distances the rounds computed, without those of tables of near rows ...
    unpruned: int = 0                   # ... and how many they would have without bounds

    @property
    def k(self) -> int:
        return self.centroids.shape[0]

    @property
    def sum_distance(self) -> float:
        return self.stats.sum_distance

    @property
    def wssse(self) -> float:
        return self.stats.wssse


# Above this many centroid coordinates (k x d) unrolled per-row expressions outgrow
# the JVM method-size limit; ``assign`` then labels rows with NumPy.
WIDE_MODEL = 256


def distance_exprs(cols, centroids, prefix="_d") -> list[str]:
    return [f"{sq_distance(cols, c)} as {prefix}{j}" for j, c in enumerate(centroids)]


def assign(df: DataFrame, cols, centroids, keep=("trip_id",), name="cluster", with_distance=False) -> DataFrame:
    """Nearest centroid (first index on ties) as a computed column.

    The k distances are projected once, then reduced to the argmin, so each
    distance is computed once per row.
    """
    k = len(centroids)
    names = [f"_d{j}" for j in range(k)]
    keep = list(keep)
    if np.asarray(centroids).size > WIDE_MODEL:
        return _assign_batched(df, list(cols), np.asarray(centroids, float), keep, name, with_distance)
    step = df.selectExpr(*[q(c) for c in keep], *distance_exprs(cols, centroids))
    out = [*[q(c) for c in keep], f"{first_argmin(names)} as {q(name)}"]
    if with_distance:
        out.append("sqrt(least(" + ", ".join(names) + ")) as distance")
    return step.selectExpr(*out)


def _assign_batched(df, cols, centroids, keep, name, with_distance):
    """Wide models: nearest centroid per Arrow batch (same kernel as the sweep)."""
    from fareseg.operators.sweep import _sq_dist

    fields = [f for f in df.select(*keep).schema.fields]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields) + f", `{name}` int"
    if with_distance:
        schema += ", distance double"
    need = list(dict.fromkeys([*keep, *cols]))

    def run(batches):
        for pdf in batches:
            d = _sq_dist(pdf[cols].to_numpy(dtype=float), centroids)
            lab = d.argmin(axis=1)
            out = pdf[keep].copy()
            out[name] = lab.astype("int32")
            if with_distance:
                out["distance"] = np.sqrt(d[np.arange(len(d)), lab])
            yield out

    return df.select(*need).mapInPandas(run, schema)


def point_centroid_distances(df: DataFrame, cols, centroids, key="trip_id") -> DataFrame:
    """Long form (key, cluster, distance): each row against every centroid.

    k is a model size, so the theta join is a generator over k literal
    centroids instead of a cross join.
    """
    rows = ", ".join(f"struct({j} as cluster, sqrt({sq_distance(cols, c)}) as distance)"
                     for j, c in enumerate(centroids))
    return df.selectExpr(q(key), f"inline(array({rows}))")


def loop_input(df: DataFrame, cols, rows_per_task: int = 25_000) -> tuple[RDD, Extent]:
    """The persisted input of an iterative fit as blocks of rows (see ``scan.py``), and its extent.

    A small sample read from few files would run every round in one task; it
    is spread to about ``rows_per_task`` rows per task, up to the default
    parallelism. Inputs that already have enough partitions are left as they are.
    Null and non-finite features are an error here, not a silent NaN model.
    """
    data = df.select(*[F.col(c).cast("double").alias(c) for c in cols]).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        size = extent(data, cols)
        want = min(df.sparkSession.sparkContext.defaultParallelism, max(1, math.ceil(size.rows / rows_per_task)))
        spread = data.repartition(want) if data.rdd.getNumPartitions() < want else data
        blocks = held(blocked(spread, cols))
        blocks.count()
    finally:
        data.unpersist()
    return blocks, size


def update_centroids(stats: ClusterStats, previous: np.ndarray) -> np.ndarray:
    new = previous.copy()
    for j in range(previous.shape[0]):
        if stats.n[j] > 0:
            new[j] = stats.sums[j] / stats.n[j]
    return new


def kmeans_fit(df: DataFrame, cols, k: int | None = None, seed: int = 42, max_iter: int | None = None,
               init: np.ndarray | None = None, key: str = "trip_id", persist: bool = True) -> KMeansModel:
    """Lloyd iterations from k seed rows until no row changes cluster.

    ``max_iter=None`` means no cap (as the reference); the result says whether
    it converged. ``init`` replaces the seeds (k is then its row count).
    """
    from fareseg.operators.sweep import kmeans_many

    cols = list(cols)
    if init is None:
        init = seed_rows(df, k, seed, cols, key)
    return kmeans_many(df, cols, {0: np.array(init, dtype=float)}, max_iter=max_iter, persist=persist)[0]


def kmeans_update(df: DataFrame, cols, centroids: np.ndarray) -> tuple[np.ndarray, ClusterStats]:
    """One centroid update from ``centroids`` (A6)."""
    from fareseg.operators.sweep import multi_round_scan

    st = multi_round_scan(df, list(cols), {0: np.asarray(centroids, float)})[0]
    return update_centroids(st, np.asarray(centroids, float)), st


def centroids_frame(spark, model_centroids: np.ndarray, cols, counts=None, id_col="cluster") -> DataFrame:
    """k-row model table ``(cluster, [n,] cols...)``."""
    rows = []
    for j, c in enumerate(model_centroids):
        row = [j] + ([int(counts[j])] if counts is not None else []) + [float(v) for v in c]
        rows.append(tuple(row))
    schema = f"{id_col} int" + (", n long" if counts is not None else "") + "".join(f", {c} double" for c in cols)
    return spark.createDataFrame(rows, schema)


def silhouette_from_stats(df: DataFrame, cols, pred: str, n: np.ndarray, sums: np.ndarray,
                          sqnorm: np.ndarray) -> float:
    """Mean silhouette with squared Euclidean distance, closed form.

    For a row x and cluster c: mean squared distance to c's rows =
    |x|^2 + Q_c / n_c - 2 x.S_c / n_c. The own cluster's mean is rescaled to
    exclude x itself; rows alone in their cluster score 0. One scan; the
    cluster statistics (k rows) are literals.
    """
    live = [j for j in range(len(n)) if n[j] > 0]
    if len(live) < 2:
        raise ValueError("silhouette needs at least two non-empty clusters")
    step = df.selectExpr(f"{q(pred)} as _pred", f"{sq_norm(cols)} as _xx", *[q(c) for c in cols])
    avg = [f"((_xx + {lit(sqnorm[j] / n[j])}) - (2.0D * ({sum_sql([f'({q(c)} * {lit(v)})' for c, v in zip(cols, sums[j])])})) / {lit(n[j])}) as _a{j}"
           for j in live]
    step = step.selectExpr("_pred", *avg)
    own = "case " + " ".join(f"when _pred = {j} then _a{j}" for j in live) + " end"
    n_own = "case " + " ".join(f"when _pred = {j} then {lit(n[j])}" for j in live) + " end"
    other = "least(" + ", ".join(f"case when _pred <> {j} then _a{j} end" for j in live) + ")"
    step = step.selectExpr(f"({own}) * ({n_own}) / nullif(({n_own}) - 1.0D, 0.0D) as _a", f"{other} as _b", f"{n_own} as _n")
    s = ("case when _n = 1.0D then 0.0D when _a < _b then 1.0D - _a / _b "
         "when _a > _b then _b / _a - 1.0D else 0.0D end")
    return float(step.agg(F.expr(f"avg({s})")).first()[0])


def silhouette(df: DataFrame, cols, pred: str = "prediction") -> float:
    """Silhouette of any labelled rows: one pass for the statistics, one for
    the mean (same result as MLlib's ClusteringEvaluator, squared Euclidean)."""
    cols = list(cols)
    aggs = ["count(1) as n", *[f"sum({q(c)}) as s{i}" for i, c in enumerate(cols)], f"sum({sq_norm(cols)}) as q"]
    rows = df.groupBy(pred).agg(*[F.expr(a) for a in aggs]).collect()
    ids = sorted(int(r[pred]) for r in rows)
    k = max(ids) + 1 if ids else 0
    n, sums, qn = np.zeros(k), np.zeros((k, len(cols))), np.zeros(k)
    for r in rows:
        j = int(r[pred])
        n[j], qn[j] = r["n"], r["q"]
        sums[j] = [r[f"s{i}"] for i in range(len(cols))]
    return silhouette_from_stats(df, cols, pred, n, sums, qn)


def model_silhouette(df: DataFrame, model: KMeansModel) -> float:
    from fareseg.operators.sweep import multi_silhouette

    if (model.stats.n > 0).sum() < 2:
        raise ValueError("silhouette needs at least two non-empty clusters")
    return multi_silhouette(df, model.cols, {0: model})[0]


def cluster_means(df: DataFrame, key: str, cols) -> DataFrame:
    """Per-cluster mean of (unscaled) columns (A10)."""
    return df.groupBy(key).agg(*[F.avg(c).alias(c) for c in cols])
