"""Feature statistics: population variance, the as-written variance, z-scores."""

import numpy as np
from conftest import SF_SMALL

from fareseg.operators import stats as ST


def test_stats_and_as_written_variance(spark):
    rng = np.random.RandomState(4)
    x = np.column_stack([rng.randint(1, 8, 200), rng.normal(-74, 0.05, 200), rng.normal(12, 5, 200)])
    cols = ["a", "b", "c"]
    df = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(x)], "trip_id long, a double, b double, c double")
    st = ST.feature_stats_row(df, cols)
    assert np.allclose([st.var[c] for c in cols], x.var(0))
    # the reference subtracts every column mean from the row's first value
    want = ((x[:, 0][:, None] - x.mean(0)[None, :]) ** 2).mean(0)
    aw = ST.feature_stats_row(df, cols, "as_written")
    assert np.allclose([aw.var[c] for c in cols], want)
    z = np.array([[r[c] for c in cols] for r in ST.scaled_features(df, cols, stats=st).orderBy("trip_id").collect()])
    assert np.allclose(z, (x - x.mean(0)) / x.std(0))


def test_constant_column_scales_to_zero(spark):
    df = spark.createDataFrame([(i, 3.0, float(i)) for i in range(10)], "trip_id long, a double, b double")
    rows = ST.scaled_features(df, ["a", "b"]).collect()
    assert all(r.a == 0.0 for r in rows)


def test_new_data_in_a_folder_gets_new_statistics(spark, tmp_path):
    from fareseg.plans import models as M

    events = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    seen = []
    for part in (events, events.where("event_id % 2 = 0"), events):
        part.coalesce(1).write.mode("overwrite").parquet(str(tmp_path / "events.parquet"))
        seen += [M.feature_stats(spark, str(tmp_path)), M.feature_stats(spark, str(tmp_path))]
    assert seen[0] is seen[1] and seen[2] is seen[3] and seen[0].n > seen[2].n and seen[4] == seen[0]


def test_lines_are_parsed_once_for_queries_that_read_the_rows_often(spark, tmp_path, monkeypatch):
    import shutil

    from fareseg.plans import models as M
    from fareseg.plans import registry as R

    spark.read.parquet(f"{SF_SMALL}/events.parquet").coalesce(1).write.parquet(str(tmp_path / "events.parquet"))
    parses, parse = [], M.train
    monkeypatch.setattr(M, "train", lambda *a: parses.append(a) or parse(*a))
    sf = str(tmp_path)
    rows = sorted(R.QUERIES["label_onehot"](spark, sf).collect())
    assert len(parses) == 1 and len(rows) == M.trips(spark, sf).count()
    assert sorted(M.stored_train(spark, sf).collect()) == sorted(M.trips(spark, sf).collect())
    M.feature_stats(spark, sf), M.seeds(spark, sf)
    assert len(parses) == 1
    # a table that is gone is written again
    shutil.rmtree(M._memo["train", sf, spark.sparkContext.applicationId][1].replace("file:", ""))
    assert sorted(R.QUERIES["label_onehot"](spark, sf).collect()) == rows and len(parses) == 2
