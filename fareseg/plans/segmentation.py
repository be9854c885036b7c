"""End-to-end segmentation: raw trip lines to cluster and component summaries.

The three reference scripts (clean + sample, sweep over k, cluster + mixture)
as one composition of the operators. Only model-sized results reach the
driver; the training sample is cut from its lineage with a reliable
checkpoint in the cluster's checkpoint folder, so a lost executor recomputes
from the checkpoint, not from the raw scan.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fareseg.operators import kmeans as K
from fareseg.operators import mixture as X
from fareseg.operators import sampling as S
from fareseg.operators import segments as G
from fareseg.operators import stats as ST
from fareseg.operators import sweep as SW
from fareseg.operators.clean import trips_from_raw
from fareseg.plans.model import Parts, SegmentationModel
from fareseg.plans.models import clustered
from fareseg.schema import DEFAULT_K, FEATURES, SWEEP_KS
from fareseg.session import ensure_checkpoint_dir


@dataclass
class SegmentResult:
    train: DataFrame
    thresholds: dict
    stats: ST.FeatureStats
    kmeans: K.KMeansModel
    silhouette: float
    centroids: DataFrame          # cluster, unscaled feature means
    cluster_summary: DataFrame
    mixture: X.Mixture | None = None
    component_summary: DataFrame | None = None

    def model(self) -> SegmentationModel:
        """What scoring needs, to save and load (see ``model.py``)."""
        return SegmentationModel(Parts(self.stats, self.kmeans.centroids, self.mixture, self.thresholds))


def training_sample(raw: DataFrame, n: int | None = None, seed: int = 42, require: str = "any",
                    checkpoint: bool = True) -> DataFrame:
    """Clean and derive features of all rows, or of an exact-size sample of ``n`` (checkpointed)."""
    sample = trips_from_raw(raw, require)
    if n is not None:
        sample = S.sample_exact(sample, n, seed)
    if checkpoint:
        ensure_checkpoint_dir(raw.sparkSession)
        sample = sample.checkpoint(eager=True)
    return sample


def scores_frame(spark: SparkSession, fits: dict[int, K.KMeansModel], sil: dict[int, float]) -> DataFrame:
    rows = [(k, float(f.sum_distance), float(f.wssse), sil.get(k), f.rounds, f.converged)
            for k, f in sorted(fits.items())]
    return spark.createDataFrame(
        rows, "k int, sum_distance double, wssse double, silhouette double, rounds int, converged boolean")


def k_sweep_scores(train: DataFrame, ks=SWEEP_KS, seed: int = 42, scaling: str = "zscore",
                   max_iter: int | None = None) -> DataFrame:
    """``(k, sum_distance, wssse, silhouette, rounds, converged)`` for every k."""
    stats = ST.feature_stats_row(train, FEATURES, scaling)
    z = ST.scaled_features(train, FEATURES, stats=stats, keep=["trip_id"])
    fits = SW.k_sweep(z, FEATURES, ks, seed, max_iter=max_iter)
    sil = SW.multi_silhouette(z, FEATURES, fits)
    return scores_frame(train.sparkSession, fits, sil)


def elbow(scores: DataFrame, cost: str = "sum_distance") -> DataFrame:
    """``(k, gap)``: how far each k's cost lies below the chord from the first to the last k.

    Both axes are scaled to 0..1. The knee is the k with the largest gap.
    Fewer than three k, or a cost that doesn't fall from the first to the last k, have no gaps.
    """
    one = Window.partitionBy(F.lit(0))  # a row per k
    curve = scores.select("k", F.col(cost).alias("_c"), F.min("k").over(one).alias("_k0"), F.max("k").over(one).alias("_k1"),
                          F.min_by(cost, "k").over(one).alias("_c0"), F.max_by(cost, "k").over(one).alias("_c1"),
                          F.count("k").over(one).alias("_n")).where("_n >= 3 and _c0 > _c1")
    x = (F.col("k") - F.col("_k0")) / (F.col("_k1") - F.col("_k0"))
    y = (F.col("_c") - F.col("_c1")) / (F.col("_c0") - F.col("_c1"))
    return curve.select("k", ((1.0 - x - y) / F.sqrt(F.lit(2.0))).alias("gap"))


def pick_k(scores: DataFrame, by: str = "silhouette", least_gap: float = 0.05) -> DataFrame:
    """One row with the chosen ``k``.

    ``by="silhouette"`` (or another score): the highest, smallest k on ties.
    ``by="elbow"``: the knee of the cost curve; null when no k lies ``least_gap``
    below the chord, that is when the curve has no knee.
    """
    if by == "elbow":
        best = elbow(scores).agg(F.max(F.struct("gap", (-F.col("k")).alias("k"))).alias("b"))
        return best.select(F.when(F.col("b.gap") >= least_gap, -F.col("b.k")).cast("int").alias("k"))
    return scores.orderBy(F.desc(by), F.asc("k")).limit(1).select("k")


def segment_trips(raw: DataFrame, k: int = DEFAULT_K, seed: int = 42, n: int | None = None,
                  scaling: str = "zscore", max_iter: int | None = None, mixture: bool = True,
                  em_schedule: str = "two_phase", em_max_iter: int | None = None, labels: str = "final",
                  checkpoint: bool = True, underflow: str = "exact", covariance: str = "weighted") -> SegmentResult:
    train = training_sample(raw, n, seed, checkpoint=checkpoint)
    thresholds = G.fare_thresholds(train)
    stats = ST.feature_stats_row(train, FEATURES, scaling)
    z = ST.scaled_features(train, FEATURES, stats=stats, keep=["trip_id"])
    seeds = S.seed_rows(z, k, seed, FEATURES)
    model = K.kmeans_fit(z, FEATURES, init=seeds, max_iter=max_iter)
    sil = K.model_silhouette(z, model)
    labelled = train.select("*", *G.label_columns(thresholds))
    kl = clustered(labelled, stats, model.centroids)
    centroids = K.cluster_means(kl, "cluster", FEATURES)
    summary = G.segment_summary(kl, "cluster")
    res = SegmentResult(train, thresholds, stats, model, sil, centroids, summary)
    if mixture:
        center = np.array([stats.mean[c] for c in FEATURES])
        init = X.init_from_clusters(kl, FEATURES, "cluster", k, center)
        final, lagged = X.gmm_fit(train, FEATURES, init, max_iter=em_max_iter, em_schedule=em_schedule,
                                  center=center, underflow=underflow, covariance=covariance)
        res.mixture = final
        use = lagged if labels == "lagged" else final
        comp = X.predict(labelled, FEATURES, use, keep=labelled.columns)
        res.component_summary = G.segment_summary(comp, "component")
    return res


# -- sinks ------------------------------------------------------------------------
def write_table(df: DataFrame, path: str, fmt: str = "parquet", single_file: bool = False,
                mode: str = "overwrite") -> None:
    """Write a result. ``single_file`` only for model-sized tables (k rows)."""
    out = df.coalesce(1) if single_file else df
    w = out.write.mode(mode)
    if fmt == "csv":
        w.option("header", "true").csv(path)
    else:
        w.format(fmt).save(path)


def write_trips(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    write_table(df, path, fmt)


def write_scores(scores: DataFrame, path: str, fmt: str = "parquet") -> None:
    write_table(scores, path, fmt, single_file=True)


def write_centroids(centroids: DataFrame, path: str, fmt: str = "parquet") -> None:
    write_table(centroids.orderBy("cluster"), path, fmt, single_file=True)


def write_summary(summary: DataFrame, path: str, fmt: str = "parquet") -> None:
    key = "cluster" if "cluster" in summary.columns else "component"
    write_table(summary.orderBy(key), path, fmt, single_file=True)


def write_mixture(spark: SparkSession, model: X.Mixture, path: str) -> None:
    """Components with phi, mu (array) and sigma (nested array)."""
    write_table(X.mixture_frame(spark, model, FEATURES), path, "parquet", single_file=True)
