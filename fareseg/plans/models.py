"""Shared training state for the registered queries.

A fit is a driver loop of Spark jobs; the queries that report different
views of the same fit (centroids, labels, cost, summaries) share it through a
small in-process memo keyed by data folder and parameters. Only model-sized
values (k rows) are memoized; DataFrames are rebuilt on demand, those that read
the training rows more than once from a table of them (:func:`stored_train`).
"""

from __future__ import annotations

from typing import Any

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fareseg.functions.vector import first_argmin, q
from fareseg.operators import kmeans as K
from fareseg.operators import sampling as S
from fareseg.operators import segments as G
from fareseg.operators import stats as ST
from fareseg.operators.clean import trips_from_raw
from fareseg.schema import DEFAULT_K, FARES, FEATURES
from fareseg.session import exists, scratch
from fareseg.sources.fixtures import raw_trips

SEED = 42
_memo: dict[tuple, Any] = {}


def stamp(sf_dir: str) -> tuple:
    """Size and change time of the tables that fits read, so that new data in a folder gets new models."""
    spark, out = SparkSession.active(), []
    for name in ("events", "embeddings"):
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{sf_dir}/{name}.parquet")
        fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
        if fs.exists(path):
            out.append((name, fs.getContentSummary(path).getLength(), fs.getFileStatus(path).getModificationTime()))
    return tuple(out)


def memo(key: tuple, fn):
    """``fn()``, kept by ``key`` (what it is, the data folder, parameters) as long as the folder's tables stay the same."""
    now = stamp(key[1])
    if _memo.get(key, (None,))[0] != now:
        _memo[key] = now, fn()
    return _memo[key][1]


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trips_from_raw(raw_trips(spark, sf_dir))


def train(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trips(spark, sf_dir)


def stored_train(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All training rows, written once a session as a table beside the checkpoints.

    Parsing a line costs far more than reading its row again, and fits,
    thresholds and statistics read the rows ten times and more.
    """
    key = ("train", sf_dir, spark.sparkContext.applicationId)

    def write():
        path = scratch(spark, "train")
        train(spark, sf_dir).write.parquet(path)
        return path
    path = memo(key, write)
    if not exists(spark, f"{path}/_SUCCESS"):
        del _memo[key]
        path = memo(key, write)
    return spark.read.schema(trips(spark, sf_dir).schema).parquet(path)


def feature_stats(spark, sf_dir, scaling: str = "zscore") -> ST.FeatureStats:
    return memo(("stats", sf_dir, scaling), lambda: ST.feature_stats_row(stored_train(spark, sf_dir), FEATURES, scaling))


def thresholds(spark, sf_dir) -> dict:
    return memo(("thr", sf_dir), lambda: G.fare_thresholds(stored_train(spark, sf_dir)))


def scaled(spark, sf_dir, scaling: str = "zscore") -> DataFrame:
    return ST.scaled_features(stored_train(spark, sf_dir), FEATURES, stats=feature_stats(spark, sf_dir, scaling))


def seeds(spark, sf_dir, k: int = DEFAULT_K) -> np.ndarray:
    return memo(("seeds", sf_dir, k), lambda: S.seed_rows(scaled(spark, sf_dir), k, SEED, FEATURES))


def kmeans(spark, sf_dir, k: int = DEFAULT_K, max_iter: int | None = None) -> K.KMeansModel:
    def fit():
        z = scaled(spark, sf_dir)
        return K.kmeans_fit(z, FEATURES, init=seeds(spark, sf_dir, k), max_iter=max_iter)
    return memo(("kmeans", sf_dir, k, max_iter), fit)


def clustered(df: DataFrame, stats: ST.FeatureStats, centroids: np.ndarray, name: str = "cluster") -> DataFrame:
    """``df`` plus its nearest-centroid id, computed from the scaled features
    in the same projection (a column, not a join)."""
    zc = [f"z_{c}" for c in FEATURES]
    step = df.select("*", *ST.scale_columns(stats, FEATURES, prefix="z_"))
    step = step.selectExpr(*[q(c) for c in df.columns], *K.distance_exprs(zc, centroids))
    names = [f"_d{j}" for j in range(len(centroids))]
    return step.selectExpr(*[q(c) for c in df.columns], f"{first_argmin(names)} as {q(name)}")


def labelled(spark, sf_dir) -> DataFrame:
    t = stored_train(spark, sf_dir)
    return t.select("*", *G.label_columns(thresholds(spark, sf_dir)))


def kmeans_labelled(spark, sf_dir, k: int = DEFAULT_K) -> DataFrame:
    m = kmeans(spark, sf_dir, k)
    return clustered(labelled(spark, sf_dir), feature_stats(spark, sf_dir), m.centroids)


def covariance_long(df: DataFrame, key: str, cols=FEATURES) -> DataFrame:
    """``(key, a, b, cov)``: population covariance of every pair a <= b per group."""
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i:]]
    wide = df.groupBy(key).agg(*[F.covar_pop(a, b).alias(f"c_{a}__{b}") for a, b in pairs])
    rows = F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"c_{a}__{b}").alias("cov"))
                     for a, b in pairs])
    return wide.select(key, F.inline(rows))


__all__ = ["FARES", "FEATURES", "clustered", "covariance_long", "feature_stats", "kmeans", "kmeans_labelled",
           "labelled", "memo", "scaled", "seeds", "stored_train", "thresholds", "train", "trips"]


def gmm_init(spark, sf_dir, k: int = DEFAULT_K):
    from fareseg.operators import mixture as X

    def run():
        st = feature_stats(spark, sf_dir)
        center = np.array([st.mean[c] for c in FEATURES])
        return X.init_from_clusters(kmeans_labelled(spark, sf_dir, k), FEATURES, "cluster", k, center)
    return memo(("gmm_init", sf_dir, k), run)


def gmm(spark, sf_dir, k: int = DEFAULT_K, em_schedule: str = "two_phase"):
    """(final model, lagged model) of EM seeded from the k-means clusters."""
    from fareseg.operators import mixture as X

    def run():
        st = feature_stats(spark, sf_dir)
        center = np.array([st.mean[c] for c in FEATURES])
        return X.gmm_fit(stored_train(spark, sf_dir), FEATURES, gmm_init(spark, sf_dir, k),
                         em_schedule=em_schedule, center=center)
    return memo(("gmm", sf_dir, k, em_schedule), run)


def sweep(spark, sf_dir, ks=None):
    """Scores of the k sweep (k = 2..20) on the training sample."""
    from fareseg.operators import sweep as SW
    from fareseg.schema import SWEEP_KS

    ks = tuple(ks or SWEEP_KS)

    def run():
        z = scaled(spark, sf_dir)
        fits = SW.k_sweep(z, FEATURES, ks, SEED)
        sil = SW.multi_silhouette(z, FEATURES, fits)
        return [(k, float(f.sum_distance), float(f.wssse), float(sil[k]), f.rounds, f.converged)
                for k, f in sorted(fits.items())]
    return memo(("sweep", sf_dir, ks), run)
