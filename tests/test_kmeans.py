"""Lloyd k-means, sweep and silhouette against NumPy brute force and MLlib."""

import numpy as np
import pytest

from fareseg.operators import kmeans as K
from fareseg.operators import sweep as SW

COLS = ["a", "b", "c"]


def blobs(n=600, k=4, seed=0):
    rng = np.random.RandomState(seed)
    centers = rng.uniform(-6, 6, size=(k, 3))
    x = np.concatenate([c + rng.normal(scale=1.2, size=(n // k, 3)) for c in centers])
    return x


def frame(spark, x):
    return spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(x)],
                                 "trip_id long, a double, b double, c double")


def dist2(x, c):
    return ((x[:, None, :] - c[None, :, :]) ** 2).sum(-1)


def brute_lloyd(x, c0):
    """The reference loop: update, then compare the new labels with the old."""
    c = c0.copy()
    lab = dist2(x, c).argmin(1)
    rounds, re = 0, []
    while True:
        new = c.copy()
        for j in range(len(c)):
            if (lab == j).any():
                new[j] = x[lab == j].mean(0)
        rounds += 1
        new_lab = dist2(x, new).argmin(1)
        re.append(len(x) if rounds == 1 else int((new_lab != lab).sum()))
        c, lab = new, new_lab
        if rounds >= 2 and re[-1] == 0:
            return c, lab, rounds, re


def test_kmeans_matches_brute_force(spark):
    x = blobs()
    df = frame(spark, x)
    c0 = x[[5, 200, 400, 590]]
    m = K.kmeans_fit(df, COLS, init=c0)
    c, lab, rounds, re = brute_lloyd(x, c0)
    assert m.converged and m.rounds == rounds and m.reassigned == re
    assert np.allclose(m.centroids, c, atol=1e-9)
    assert list(m.stats.n) == list(np.bincount(lab, minlength=4))
    d = np.sqrt(dist2(x, c)[np.arange(len(x)), lab])
    assert m.sum_distance == pytest.approx(d.sum(), rel=1e-9)
    assert m.wssse == pytest.approx((d ** 2).sum(), rel=1e-9)
    got = {r.trip_id: r.cluster for r in K.assign(df, COLS, m.centroids).collect()}
    assert [got[i] for i in range(len(x))] == list(lab)


def test_empty_cluster_keeps_centroid(spark):
    x = blobs(200, 2, seed=3)
    far = np.array([1e6, 1e6, 1e6])
    m = K.kmeans_fit(frame(spark, x), COLS, init=np.vstack([x[0], x[150], far]))
    assert m.stats.n[2] == 0 and np.array_equal(m.centroids[2], far)


def test_max_iter_and_cost_never_rises(spark):
    x = blobs(400, 4, seed=5)
    df = frame(spark, x)
    c0 = x[:4]
    costs = [K.kmeans_fit(df, COLS, init=c0, max_iter=t).wssse for t in range(1, 5)]
    assert all(b <= a + 1e-9 for a, b in zip(costs, costs[1:]))
    assert K.kmeans_fit(df, COLS, init=c0, max_iter=1).rounds == 1


def test_silhouette_matches_mllib(spark):
    from pyspark.ml.evaluation import ClusteringEvaluator
    from pyspark.ml.feature import VectorAssembler

    x = blobs(500, 5, seed=7)
    df = frame(spark, x)
    m = K.kmeans_fit(df, COLS, init=x[[0, 100, 200, 300, 400]])
    lab = K.assign(df, COLS, m.centroids, keep=("trip_id", *COLS), name="prediction")
    vec = VectorAssembler(inputCols=COLS, outputCol="features").transform(lab)
    want = ClusteringEvaluator().evaluate(vec)
    assert K.silhouette(lab, COLS, "prediction") == pytest.approx(want, abs=1e-10)
    assert K.model_silhouette(df, m) == pytest.approx(want, abs=1e-10)
    assert SW.multi_silhouette(df, COLS, {5: m})[5] == pytest.approx(want, abs=1e-10)


def brute_silhouette(x, lab):
    d = dist2(x, x)
    out = []
    for i in range(len(x)):
        own = lab == lab[i]
        if own.sum() == 1:
            out.append(0.0)
            continue
        a = d[i, own].sum() / (own.sum() - 1)
        b = min(d[i, lab == c].mean() for c in set(lab) if c != lab[i])
        out.append(0.0 if a == b else (1 - a / b if a < b else b / a - 1))
    return float(np.mean(out))


def test_singleton_cluster_scores_zero(spark):
    from pyspark.sql import functions as F

    x = np.array([[0.0, 0, 0], [0.1, 0, 0], [10, 10, 10], [0.3, 0.2, 0.1]])
    lab = np.array([0, 0, 1, 0])
    df = frame(spark, x).withColumn("prediction", F.when(F.col("trip_id") == 2, 1).otherwise(0))
    assert K.silhouette(df, COLS, "prediction") == pytest.approx(brute_silhouette(x, lab), abs=1e-12)


def test_sweep_equals_single_fits(spark):
    x = blobs(480, 4, seed=11)
    df = frame(spark, x)
    fits = SW.k_sweep(df, COLS, range(2, 7), seed=1)
    seeds = K.seed_rows(df, 6, 1, COLS)
    for k, f in fits.items():
        single = K.kmeans_fit(df, COLS, init=seeds[:k])
        assert f.rounds == single.rounds and f.reassigned == single.reassigned
        assert list(f.stats.n) == list(single.stats.n)
        assert np.allclose(f.centroids, single.centroids, atol=1e-9)
        assert f.sum_distance == pytest.approx(single.sum_distance, rel=1e-9)
