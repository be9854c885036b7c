"""Registered queries: one per operator of the blueprint, each ``(spark, sf_dir)
-> DataFrame`` over the given tables (or data Spark derives from them)."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fareseg.functions.numeric import is_finite
from fareseg.operators import clean as C
from fareseg.sources.fixtures import raw_trips

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

SEED = 42
SAMPLE_ROWS = 5000


def query(name: str):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn
    return deco


def load_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_trips(spark, sf_dir)


def load_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.trips_from_raw(load_raw(spark, sf_dir))


# -- scans, parsing, rules ---------------------------------------------------
@query("raw_scan")
def q_raw_scan(spark, sf_dir):
    return load_raw(spark, sf_dir)


@query("split_fields")
def q_split_fields(spark, sf_dir):
    s = C.split_fields(load_raw(spark, sf_dir))
    return s.select("trip_id", "n_fields", F.get("p", 2).alias("f2"), F.get("p", 4).alias("f4"),
                    F.get("p", 11).alias("f11"))


@query("numeric_validity")
def q_numeric_validity(spark, sf_dir):
    p = C.parse_fields(load_raw(spark, sf_dir))
    return p.select("trip_id", is_finite("secs").alias("ok_time"), is_finite("distance").alias("ok_distance"),
                    is_finite("fare").alias("ok_fare"), is_finite("tip").alias("ok_tip"))


@query("filter_any_key")
def q_filter_any_key(spark, sf_dir):
    return C.parse_fields(load_raw(spark, sf_dir)).where(C.has_key("any")).select("trip_id")


@query("geo_box_filter")
def q_geo_box_filter(spark, sf_dir):
    p = C.parse_fields(load_raw(spark, sf_dir))
    return p.where(C.in_box("pu_lon", "pu_lat") & C.in_box("do_lon", "do_lat")).select("trip_id")


@query("clean_trips")
def q_clean_trips(spark, sf_dir):
    return C.clean_trips(load_raw(spark, sf_dir)).select(
        "trip_id", "pickup_datetime", "secs", "distance", "pu_lon", "pu_lat", "do_lon", "do_lat",
        "fare", "surcharge", "tip", "toll")


@query("reject_counts")
def q_reject_counts(spark, sf_dir):
    return C.reject_counts(load_raw(spark, sf_dir))


@query("trip_features")
def q_trip_features(spark, sf_dir):
    return load_trips(spark, sf_dir)


# -- sampling, statistics, segments ------------------------------------------
from fareseg.functions.numeric import rounded  # noqa: E402
from fareseg.operators import audit as A  # noqa: E402
from fareseg.operators import sampling as S  # noqa: E402
from fareseg.operators import joins as JN  # noqa: E402
from fareseg.operators import segments as G  # noqa: E402
from fareseg.operators import sketches as SK  # noqa: E402
from fareseg.operators import stats as ST  # noqa: E402
from fareseg.schema import FARES, FEATURES  # noqa: E402
from fareseg.session import scratch  # noqa: E402
from fareseg.sources import text as TX  # noqa: E402


def load_train(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The training rows: every cleaned trip (``sample_trips`` shows the exact-size sample)."""
    return load_trips(spark, sf_dir)


def stored_train(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rows for queries that read them several times: parsed once, then read from a table."""
    return M.stored_train(spark, sf_dir)


def r6(cols):
    return [rounded(c).alias(c) for c in cols]


@query("training_text_parse")
def q_training_text_parse(spark, sf_dir):
    text = TX.format_training_text(load_train(spark, sf_dir))
    return TX.parse_training_text(text, "line")


@query("sample_trips")
def q_sample_trips(spark, sf_dir):
    return S.sample_exact(stored_train(spark, sf_dir), SAMPLE_ROWS, SEED)


SMALL_SAMPLE = 40


@query("sample_small")
def q_sample_small(spark, sf_dir):
    """A sample far below half of the rows: the bound is found by narrowing."""
    return S.sample_exact(stored_train(spark, sf_dir), SMALL_SAMPLE, SEED)


@query("clean_audit")
def q_clean_audit(spark, sf_dir):
    """Counts per rule observed while the trips and the rejected lines are written, in one pass."""
    return A.counts_frame(spark, A.clean_to(load_raw(spark, sf_dir), scratch(spark, "audit")))


@query("quarantine")
def q_quarantine(spark, sf_dir):
    path = scratch(spark, "audit")
    A.clean_to(load_raw(spark, sf_dir), path)
    return A.read_quarantine(spark, path)


def text_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw lines written as text files in trip order and read again by ``read_raw_trips``."""
    path = scratch(spark, "text")
    raw = load_raw(spark, sf_dir)
    raw.repartitionByRange(4, "trip_id").sortWithinPartitions("trip_id").select("line").write.text(path)
    return TX.read_raw_trips(spark, path)


@query("text_scan")
def q_text_scan(spark, sf_dir):
    return text_trips(spark, sf_dir).select("trip_id", "line")


@query("text_sample")
def q_text_sample(spark, sf_dir):
    """A sample of lines read from text, keyed by their position."""
    return S.sample_exact(text_trips(spark, sf_dir).select("trip_id", "line"), SMALL_SAMPLE, SEED)


@query("trip_index")
def q_trip_index(spark, sf_dir):
    return S.with_index(load_trips(spark, sf_dir).select("trip_id"), "trip_id").select("idx", "trip_id")


@query("trip_index_buckets")
def q_trip_index_buckets(spark, sf_dir):
    """The same index, numbered bucket by bucket."""
    return S.with_index(load_trips(spark, sf_dir).select("trip_id"), "trip_id", rows_per_bucket=700).select("idx", "trip_id")


@query("fare_quantiles_narrowed")
def q_fare_quantiles_narrowed(spark, sf_dir):
    """The same quantiles with brackets narrowed until few rows are left."""
    train = stored_train(spark, sf_dir)
    return G.thresholds_frame(train, G.fare_thresholds(train, final_rows=100, accuracy=50))


@query("feature_stats")
def q_feature_stats(spark, sf_dir):
    return ST.feature_stats(load_train(spark, sf_dir)).select("feature", "n", *r6(["mean", "var", "std"]))


@query("feature_var_as_written")
def q_feature_var_as_written(spark, sf_dir):
    return ST.feature_var_as_written(load_train(spark, sf_dir)).select("feature", *r6(["var"]))


@query("scaled_features")
def q_scaled_features(spark, sf_dir):
    return ST.scaled_features(stored_train(spark, sf_dir)).select("trip_id", *r6(FEATURES))


@query("fare_per_mile")
def q_fare_per_mile(spark, sf_dir):
    return G.fare_per_mile(load_train(spark, sf_dir)).select("trip_id", *r6(["driver_rate", "passenger_rate"]))


@query("fare_quantiles")
def q_fare_quantiles(spark, sf_dir):
    train = stored_train(spark, sf_dir)
    return G.thresholds_frame(train, G.fare_thresholds(train))


def labelled_train(spark, sf_dir):
    train = stored_train(spark, sf_dir)
    return train, G.fare_thresholds(train)


@query("trip_labels")
def q_trip_labels(spark, sf_dir):
    train, th = labelled_train(spark, sf_dir)
    return G.trip_labels(train, th)


@query("label_onehot")
def q_label_onehot(spark, sf_dir):
    train, th = labelled_train(spark, sf_dir)
    return G.label_onehot(G.trip_labels(train, th))


@query("attach_labels")
def q_attach_labels(spark, sf_dir):
    train, th = labelled_train(spark, sf_dir)
    labels = G.trip_labels(train, th)
    return G.attach_labels(train.select("trip_id", *FARES), labels).select(
        "trip_id", "d_label", "p_label", *FARES)


# -- k-means -----------------------------------------------------------------
import numpy as np  # noqa: E402

from fareseg.operators import kmeans as K  # noqa: E402
from fareseg.plans import models as M  # noqa: E402


def _centroid_rows(spark, centroids, counts=None):
    df = K.centroids_frame(spark, centroids, FEATURES, counts)
    lead = ["cluster"] + (["n"] if counts is not None else [])
    return df.select(*lead, *r6(FEATURES))


@query("kmeans_seeds")
def q_kmeans_seeds(spark, sf_dir):
    return _centroid_rows(spark, M.seeds(spark, sf_dir))


@query("point_centroid_distances")
def q_point_centroid_distances(spark, sf_dir):
    d = K.point_centroid_distances(M.scaled(spark, sf_dir), FEATURES, M.seeds(spark, sf_dir))
    return d.select("trip_id", "cluster", rounded("distance").alias("distance"))


@query("kmeans_update")
def q_kmeans_update(spark, sf_dir):
    c1, st = K.kmeans_update(M.scaled(spark, sf_dir), FEATURES, M.seeds(spark, sf_dir))
    return _centroid_rows(spark, c1, st.n)


@query("kmeans_fit")
def q_kmeans_fit(spark, sf_dir):
    m = M.kmeans(spark, sf_dir)
    return _centroid_rows(spark, m.centroids, m.stats.n)


@query("kmeans_assign")
def q_kmeans_assign(spark, sf_dir):
    return K.assign(M.scaled(spark, sf_dir), FEATURES, M.kmeans(spark, sf_dir).centroids)


@query("kmeans_reassigned")
def q_kmeans_reassigned(spark, sf_dir):
    m = M.kmeans(spark, sf_dir)
    return spark.createDataFrame([(i + 1, int(n)) for i, n in enumerate(m.reassigned)], "round int, n long")


@query("kmeans_cost")
def q_kmeans_cost(spark, sf_dir):
    m = M.kmeans(spark, sf_dir)
    return spark.createDataFrame([(float(m.sum_distance), float(m.wssse))], "sum_distance double, wssse double").select(
        *r6(["sum_distance", "wssse"]))


@query("silhouette")
def q_silhouette(spark, sf_dir):
    m = M.kmeans(spark, sf_dir)
    s = K.model_silhouette(M.scaled(spark, sf_dir), m)
    return spark.createDataFrame([(s,)], "silhouette double").select(*r6(["silhouette"]))


@query("cluster_centroids")
def q_cluster_centroids(spark, sf_dir):
    return K.cluster_means(M.kmeans_labelled(spark, sf_dir), "cluster", FEATURES).select("cluster", *r6(FEATURES))


SUMMARY_COLS = ["d2", "d1", "d0", "p2", "p1", "p0"] + FARES


@query("cluster_summary")
def q_cluster_summary(spark, sf_dir):
    s = G.segment_summary(M.kmeans_labelled(spark, sf_dir), "cluster")
    return s.select("cluster", "n", *r6(SUMMARY_COLS))


@query("cluster_covariance")
def q_cluster_covariance(spark, sf_dir):
    cov = M.covariance_long(M.kmeans_labelled(spark, sf_dir), "cluster")
    return cov.select("cluster", "a", "b", *r6(["cov"]))


# -- Gaussian mixture ----------------------------------------------------------
from fareseg.operators import mixture as X  # noqa: E402
from fareseg.plans.fixed_model import fixed_mixture  # noqa: E402


def _long(df, k, value, name):
    """(trip_id, component, value) from wide per-component columns."""
    rows = ", ".join(f"struct({j} as component, {value.format(j=j)} as {name})" for j in range(k))
    return df.selectExpr("trip_id", f"inline(array({rows}))").select(
        "trip_id", "component", rounded(name).alias(name))


def _fixed_resp(spark, sf_dir):
    return X.responsibilities(M.train(spark, sf_dir), FEATURES, fixed_mixture(), keep=("trip_id",))


@query("gmm_init")
def q_gmm_init(spark, sf_dir):
    m = M.gmm_init(spark, sf_dir)
    pairs = [(a, b) for a in range(len(FEATURES)) for b in range(a, len(FEATURES))]
    names = ["phi", *FEATURES, *[f"cov_{FEATURES[a]}_{FEATURES[b]}" for a, b in pairs]]
    rows = [(j, *map(float, [m.phi[j], *m.mu[j], *[m.sigma[j][p] for p in pairs]])) for j in range(m.k)]
    df = spark.createDataFrame(rows, "component int, " + ", ".join(f"{c} double" for c in names))
    return df.select("component", *r6(names))


@query("gmm_density")
def q_gmm_density(spark, sf_dir):
    fm = fixed_mixture()
    d = X.log_density(M.train(spark, sf_dir), FEATURES, fm, keep=("trip_id",))
    return _long(d, fm.k, "_ld{j}", "log_density")


@query("gmm_e_step")
def q_gmm_e_step(spark, sf_dir):
    return _long(_fixed_resp(spark, sf_dir), fixed_mixture().k, "_r{j}", "r")


@query("join_features_resp")
def q_join_features_resp(spark, sf_dir):
    resp = _long(_fixed_resp(spark, sf_dir), fixed_mixture().k, "_r{j}", "r")
    feats = M.train(spark, sf_dir).select("trip_id", *FEATURES)
    return JN.join_on_key(feats, resp).select("trip_id", "component", "r", *FEATURES)


@query("join_bucketed_resp")
def q_join_bucketed_resp(spark, sf_dir):
    """The same join of two stored tables, bucket by bucket, without an exchange."""
    name = uuid.uuid4().hex
    resp = _long(_fixed_resp(spark, sf_dir), fixed_mixture().k, "_r{j}", "r")
    feats = M.train(spark, sf_dir).select("trip_id", *FEATURES)
    buckets = spark.sparkContext.defaultParallelism
    JN.store_bucketed(feats, f"feats_{name}", scratch(spark, "feats"), buckets)
    JN.store_bucketed(resp, f"resp_{name}", scratch(spark, "resp"), buckets)
    return JN.join_bucketed(spark, f"feats_{name}", f"resp_{name}").select("trip_id", "component", "r", *FEATURES)


def day_sketches(spark, sf_dir):
    """Fare sketches of the clean trips by pickup day, stored and read again."""
    path = scratch(spark, "sketches")
    trips = C.trip_features(C.clean_trips(load_raw(spark, sf_dir)), ("trip_id", "ts"))
    SK.store_sketches(SK.day_sketches(trips, F.to_date("ts")), path)
    return SK.read_sketches(spark, path)


@query("sketch_days")
def q_sketch_days(spark, sf_dir):
    """Rows per day and rate that the stored sketches stand for."""
    return day_sketches(spark, sf_dir).select("day", "rate", F.kll_sketch_get_n_double("sketch").alias("n"))


@query("sketch_quantiles")
def q_sketch_quantiles(spark, sf_dir):
    """Quantiles of the merged day sketches, each held against its true rank (twice the 99 % bound)."""
    ranks = SK.true_ranks(load_trips(spark, sf_dir), SK.sketch_quantiles(day_sketches(spark, sf_dir)))
    room = F.lit(2 * SK.rank_error()) * F.col("n")
    near = (F.col("below") <= F.col("q") * F.col("n") + room) & (F.col("up_to") >= F.col("q") * F.col("n") - room)
    return ranks.select("rate", "q", "n", near.alias("within_bound"))


def _fixed_moments(spark, sf_dir):
    fm = fixed_mixture()
    st = M.feature_stats(spark, sf_dir)
    center = np.array([st.mean[c] for c in FEATURES])
    W, S, Q = X.weighted_moments(_fixed_resp(spark, sf_dir), FEATURES, [f"_r{j}" for j in range(fm.k)], center)
    return fm, W, S, Q, center


@query("gmm_phi_update")
def q_gmm_phi_update(spark, sf_dir):
    fm = fixed_mixture()
    r = _fixed_resp(spark, sf_dir)
    rows = ", ".join(f"struct({j} as component, _r{j} as r)" for j in range(fm.k))
    return (r.selectExpr(f"inline(array({rows}))").groupBy("component").agg(F.avg("r").alias("phi"))
            .select("component", rounded("phi").alias("phi")))


@query("gmm_m_step_mu")
def q_gmm_m_step_mu(spark, sf_dir):
    fm, W, S, Q, center = _fixed_moments(spark, sf_dir)
    mu, _ = X.moments_to_params(W, S, Q, center)
    rows = [(j, float(W[j]), *[float(v) for v in mu[j]]) for j in range(fm.k)]
    df = spark.createDataFrame(rows, "component int, weight double, " + ", ".join(f"{c} double" for c in FEATURES))
    return df.select("component", *r6(["weight"] + FEATURES))


def _sigma_long(spark, sigma):
    rows = [(j, FEATURES[a], FEATURES[b], float(sigma[j, a, b]))
            for j in range(sigma.shape[0]) for a in range(len(FEATURES)) for b in range(a, len(FEATURES))]
    return spark.createDataFrame(rows, "component int, a string, b string, cov double").select(
        "component", "a", "b", rounded("cov").alias("cov"))


@query("gmm_m_step_sigma")
def q_gmm_m_step_sigma(spark, sf_dir):
    fm, W, S, Q, center = _fixed_moments(spark, sf_dir)
    return _sigma_long(spark, X.moments_to_params(W, S, Q, center)[1])


@query("gmm_sigma_as_written")
def q_gmm_sigma_as_written(spark, sf_dir):
    fm, W, S, Q, center = _fixed_moments(spark, sf_dir)
    return _sigma_long(spark, X.sigma_as_written(W, S, Q, center))


@query("gmm_predict")
def q_gmm_predict(spark, sf_dir):
    return X.predict(M.train(spark, sf_dir), FEATURES, fixed_mixture(), keep=("trip_id",))


@query("gmm_fit")
def q_gmm_fit(spark, sf_dir):
    m, _ = M.gmm(spark, sf_dir)
    rows = [(j, float(m.phi[j]), *[float(v) for v in m.mu[j]]) for j in range(m.k)]
    df = spark.createDataFrame(rows, "component int, phi double, " + ", ".join(f"{c} double" for c in FEATURES))
    return df.select("component", *r6(["phi"] + FEATURES))


@query("gmm_component_summary")
def q_gmm_component_summary(spark, sf_dir):
    m, _ = M.gmm(spark, sf_dir)
    lab = M.labelled(spark, sf_dir)
    comp = X.predict(lab, FEATURES, m, keep=lab.columns)
    return G.segment_summary(comp, "component").select("component", "n", *r6(SUMMARY_COLS))


# -- sweep, choice of k, end to end ---------------------------------------------------
from fareseg.plans import segmentation as P  # noqa: E402


def _scores(spark, sf_dir):
    return spark.createDataFrame(M.sweep(spark, sf_dir),
                                 "k int, sum_distance double, wssse double, silhouette double, rounds int, "
                                 "converged boolean")


@query("k_sweep")
def q_k_sweep(spark, sf_dir):
    return _scores(spark, sf_dir).select("k", *r6(["sum_distance", "wssse", "silhouette"]))


@query("elbow_gaps")
def q_elbow_gaps(spark, sf_dir):
    return P.elbow(_scores(spark, sf_dir)).select("k", *r6(["gap"]))


@query("pick_k_elbow")
def q_pick_k_elbow(spark, sf_dir):
    return P.pick_k(_scores(spark, sf_dir), by="elbow")


@query("pick_k")
def q_pick_k(spark, sf_dir):
    return P.pick_k(_scores(spark, sf_dir))


@query("segment_trips")
def q_segment_trips(spark, sf_dir):
    """Both summaries, of the clusters and of the mixture's components."""
    res = P.segment_trips(load_raw(spark, sf_dir))
    parts = [df.select(F.lit(kind).alias("kind"), F.col(kind).cast("int").alias("segment"), "n", *r6(SUMMARY_COLS))
             for kind, df in (("cluster", res.cluster_summary), ("component", res.component_summary))]
    return parts[0].unionByName(parts[1])


# -- the same fit on 64-dimensional embeddings ------------------------------------------
EMB_DIM, EMB_K = 64, 10
EMB_COLS = [f"e{i}" for i in range(EMB_DIM)]


def load_embeddings(spark, sf_dir):
    """Vectors of the right length and finite numbers; others take no part."""
    e = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    x = F.col("embedding")
    fit = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return e.where((F.size(x) == EMB_DIM) & F.coalesce(fit, F.lit(False))).select("vec_id", "label", *[F.col("embedding")[i].cast("double").alias(f"e{i}") for i in range(EMB_DIM)])


def _emb_model(spark, sf_dir):
    def fit():
        emb = load_embeddings(spark, sf_dir)
        seeds = S.seed_rows(emb, EMB_K, SEED, EMB_COLS, key="vec_id")
        return K.kmeans_fit(emb, EMB_COLS, init=seeds)
    return M.memo(("emb_kmeans", sf_dir), fit)


@query("embedding_kmeans")
def q_embedding_kmeans(spark, sf_dir):
    """Cluster x true label counts: how well k-means recovers the labels."""
    m = _emb_model(spark, sf_dir)
    lab = K.assign(load_embeddings(spark, sf_dir), EMB_COLS, m.centroids, keep=("vec_id", "label"))
    return lab.groupBy("cluster", "label").agg(F.count(F.lit(1)).alias("n"))


@query("embedding_silhouette")
def q_embedding_silhouette(spark, sf_dir):
    m = _emb_model(spark, sf_dir)
    s = K.model_silhouette(load_embeddings(spark, sf_dir), m)
    return spark.createDataFrame([(s,)], "silhouette double").select(*r6(["silhouette"]))


# -- the EM loop end to end on two features (SQL-checkable: closed-form 2x2) --------------
GMM2_COLS, GMM2_K, GMM2_TOL = ["hour", "trip_min"], 3, 1e-3


def _gmm2(spark, sf_dir):
    def run():
        train = M.stored_train(spark, sf_dir).select("trip_id", *[F.col(c).cast("double").alias(c) for c in GMM2_COLS])
        st = ST.feature_stats_row(train, GMM2_COLS)
        zc = [f"z_{c}" for c in GMM2_COLS]
        z = train.select("trip_id", *GMM2_COLS, *ST.scale_columns(st, GMM2_COLS, prefix="z_"))
        seeds = S.seed_rows(z, GMM2_K, SEED, zc)
        km = K.kmeans_fit(z, zc, init=seeds)
        kl = K.assign(z, zc, km.centroids, keep=("trip_id", *GMM2_COLS))
        center = np.array([st.mean[c] for c in GMM2_COLS])
        init = X.init_from_clusters(kl, GMM2_COLS, "cluster", GMM2_K, center)
        model, _ = X.gmm_fit(train, GMM2_COLS, init, tol=GMM2_TOL, center=center)
        return model
    return M.memo(("gmm2", sf_dir), run)


@query("gmm_fit_2d")
def q_gmm_fit_2d(spark, sf_dir):
    m = _gmm2(spark, sf_dir)
    rows = [(j, float(m.phi[j]), float(m.mu[j, 0]), float(m.mu[j, 1])) for j in range(m.k)]
    df = spark.createDataFrame(rows, "component int, phi double, mu_hour double, mu_trip_min double")
    return df.select("component", *r6(["phi", "mu_hour", "mu_trip_min"]))
