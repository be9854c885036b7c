"""Registered queries against their DuckDB oracles on sf0.001 (fast subset;
the full set runs with ``python tests/oracle_compare.py`` at sf0.01)."""

import subprocess
import sys

import pytest
from conftest import ROOT, SF_SMALL
from oracle_compare import compare, duck

import __spark_entry__ as E
from fareseg.plans import registry as R
from fareseg.plans.registry import QUERIES

FAST = ["raw_scan", "split_fields", "numeric_validity", "filter_any_key", "geo_box_filter", "clean_trips",
        "reject_counts", "clean_audit", "quarantine", "trip_features", "training_text_parse", "text_scan", "text_sample",
        "sample_trips", "sample_small", "sketch_days", "sketch_quantiles", "join_bucketed_resp", "trip_index", "feature_stats",
        "feature_var_as_written", "scaled_features", "fare_per_mile", "fare_quantiles", "trip_labels",
        "label_onehot", "attach_labels", "kmeans_seeds", "point_centroid_distances", "kmeans_update",
        "kmeans_fit", "kmeans_reassigned", "kmeans_cost", "silhouette", "gmm_init",
        "gmm_density", "gmm_e_step", "join_features_resp", "gmm_phi_update", "gmm_m_step_mu",
        "gmm_m_step_sigma", "gmm_sigma_as_written", "gmm_predict"]


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_a_callable_and_known_oracle_status():
    qs, sql = E.queries(), E.oracle_sql()
    assert set(sql) <= set(qs)
    assert set(QUERIES) <= set(sql)


@pytest.mark.parametrize("name", FAST)
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    res = con.execute(E.oracle_sql()[name])
    ok, msg = compare(rows, df.columns, res.fetchall(), [d[0] for d in res.description])
    assert ok, msg


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns[:2] == ["cluster", "n"] and df.count() == 5


def test_entry_without_a_library_of_the_training_data_operators():
    code = "import sys; sys.modules['xxhash'] = None; import __spark_entry__ as E; print(sorted(E.queries()) == sorted(E.QUERIES), len(E.queries()))"
    r = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True)
    assert r.returncode == 0 and r.stdout.split() == ["True", str(len(QUERIES))] and "xxhash" in r.stderr


def test_embeddings_that_cannot_be_compared_take_no_part(spark, tmp_path):
    good = [(i, [float(i % 7)] * R.EMB_DIM, i % 3) for i in range(40)]
    bad = [(90, None, 0), (91, [1.0, 2.0], 0), (92, [float("nan")] + [1.0] * (R.EMB_DIM - 1), 0), (93, [None] + [1.0] * (R.EMB_DIM - 1), 0),
           (94, [float("inf")] * R.EMB_DIM, 0)]
    spark.createDataFrame(good + bad, "vec_id long, embedding array<float>, label int").coalesce(1).write.parquet(str(tmp_path / "embeddings.parquet"))
    assert sorted(r["vec_id"] for r in R.load_embeddings(spark, str(tmp_path)).collect()) == list(range(40))
