"""End to end on sf0.001: pipeline invariants, sinks, text round trip, streaming."""

import os
import tempfile

import numpy as np
import pytest
from conftest import SF_SMALL

from fareseg.operators import segments as G
from fareseg.plans import segmentation as P
from fareseg.schema import FARES, FEATURES
from fareseg.sources import text as TX
from fareseg.sources.fixtures import raw_trips
from fareseg.streaming import score as STREAM


@pytest.fixture(scope="module")
def result(spark):
    return P.segment_trips(raw_trips(spark, SF_SMALL), em_max_iter=40)


def test_summary_invariants(result):
    n = result.train.count()
    rows = result.cluster_summary.collect()
    assert sum(r.n for r in rows) == n
    for r in rows:
        assert r.d2 + r.d1 + r.d0 == pytest.approx(1.0) and r.p2 + r.p1 + r.p0 == pytest.approx(1.0)
    comp = result.component_summary.collect()
    assert sum(r.n for r in comp) == n
    assert abs(result.mixture.phi.sum() - 1) < 1e-9
    assert -1.0 <= result.silhouette <= 1.0
    assert result.kmeans.converged


def test_label_shares_follow_quantiles(result):
    lab = result.train.select(*G.label_columns(result.thresholds)).groupBy("d_label").count().collect()
    share = {r.d_label: r["count"] for r in lab}
    total = sum(share.values())
    assert 0.15 < share["D2"] / total < 0.35 and 0.15 < share["D0"] / total < 0.35


def test_sinks_round_trip(spark, result):
    out = tempfile.mkdtemp(prefix="fareseg-sink-")
    P.write_centroids(result.centroids, os.path.join(out, "centroids"))
    P.write_summary(result.cluster_summary, os.path.join(out, "summary"), fmt="csv")
    P.write_summary(result.component_summary, os.path.join(out, "components"))
    back = spark.read.parquet(os.path.join(out, "components"))
    assert "component" in back.columns and back.count() == result.component_summary.count()
    scores = P.k_sweep_scores(result.train, ks=(2, 3))
    P.write_scores(scores, os.path.join(out, "scores"))
    back = spark.read.parquet(os.path.join(out, "scores")).orderBy("k").collect()
    assert [r.k for r in back] == [2, 3] and all(r.converged for r in back)
    P.write_mixture(spark, result.mixture, os.path.join(out, "mixture"))
    P.write_trips(result.train, os.path.join(out, "train"))
    back = spark.read.parquet(os.path.join(out, "mixture")).orderBy("component").collect()
    assert np.allclose(np.array(back[0].sigma), result.mixture.sigma[0])
    assert spark.read.parquet(os.path.join(out, "train")).count() == result.train.count()
    assert len([f for f in os.listdir(os.path.join(out, "centroids")) if f.endswith(".parquet")]) == 1
    csv = spark.read.option("header", "true").csv(os.path.join(out, "summary"))
    assert csv.count() == result.cluster_summary.count()


def test_training_text_round_trip(spark, result):
    text = TX.format_training_text(result.train)
    out = tempfile.mkdtemp(prefix="fareseg-text-")
    text.select("line").write.text(os.path.join(out, "t"))
    back = TX.read_training_text(spark, os.path.join(out, "t"))
    assert back.count() == result.train.count()
    assert set(back.columns) == set(FEATURES + FARES)
    assert back.where("trip_min is null").count() == 0


def test_streaming_scores_equal_batch(spark, result):
    src = tempfile.mkdtemp(prefix="fareseg-stream-")
    raw = raw_trips(spark, SF_SMALL)
    raw.repartition(3).write.mode("overwrite").parquet(os.path.join(src, "in"))
    stream = STREAM.read_raw_stream(spark, os.path.join(src, "in"), max_files_per_trigger=1)
    scored = STREAM.score_trips(stream, result.thresholds, result.stats, result.kmeans.centroids)
    q = (STREAM.segment_counts(scored).writeStream.outputMode("complete").format("memory")
         .queryName("fareseg_counts").option("checkpointLocation", os.path.join(src, "ckpt")).start())
    q.processAllAvailable()
    q.stop()
    got = {(r.cluster, r.d_label, r.p_label): r.n for r in spark.sql("select * from fareseg_counts").collect()}
    batch = STREAM.segment_counts(STREAM.score_trips(raw, result.thresholds, result.stats, result.kmeans.centroids))
    want = {(r.cluster, r.d_label, r.p_label): r.n for r in batch.collect()}
    assert got == want


def test_pick_k(spark):
    scores = spark.createDataFrame([(2, 0.1), (3, 0.4), (4, 0.4), (5, 0.2)], "k int, silhouette double")
    assert P.pick_k(scores).first().k == 3


def test_read_raw_text_bz2(spark):
    from fareseg.operators.clean import clean_trips

    out = tempfile.mkdtemp(prefix="fareseg-raw-")
    raw = raw_trips(spark, SF_SMALL)
    raw.select("line").write.option("compression", "bzip2").text(os.path.join(out, "raw"))
    assert any(f.endswith(".bz2") for f in os.listdir(os.path.join(out, "raw")))
    back = TX.read_raw_trips(spark, os.path.join(out, "raw"))
    assert back.count() == raw.count()
    assert back.select("trip_id").distinct().count() == raw.count()
    assert clean_trips(back).count() == clean_trips(raw).count()
