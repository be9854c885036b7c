"""Exact sample, dense index and exact quantiles against brute force."""

import hashlib
import math

import numpy as np

from fareseg.operators.quantiles import exact_quantiles
from fareseg.operators.sampling import sample_exact, seed_rows, with_index
from fareseg.operators.segments import round_half_up


def brute_sample(ids, n, seed):
    return sorted(ids, key=lambda i: (hashlib.md5(f"{seed}:{i}".encode()).hexdigest(), i))[:n]


def test_sample_exact_matches_brute_force(spark):
    ids = list(range(0, 30000, 3))
    df = spark.createDataFrame([(i, float(i)) for i in ids], "trip_id long, v double")
    for n in (1, 17, 999, 5000):
        got = [r.trip_id for r in sample_exact(df, n, 42).collect()]
        assert sorted(got) == sorted(brute_sample(ids, n, 42))
    assert sample_exact(df, 10**6, 42).count() == len(ids)


def test_sample_independent_of_partitioning(spark):
    df = spark.range(5000).withColumnRenamed("id", "trip_id")
    a = sorted(r.trip_id for r in sample_exact(df.repartition(1), 300, 9).collect())
    b = sorted(r.trip_id for r in sample_exact(df.repartition(7), 300, 9).collect())
    assert a == b


def test_seed_rows_nested(spark):
    df = spark.createDataFrame([(i, float(i), float(-i)) for i in range(100)], "trip_id long, x double, y double")
    s5 = seed_rows(df, 5, 3, ["x", "y"])
    s3 = seed_rows(df, 3, 3, ["x", "y"])
    assert np.array_equal(s5[:3], s3)
    want = brute_sample(range(100), 5, 3)
    assert list(s5[:, 0].astype(int)) == want


def test_with_index_dense_in_key_order(spark):
    ids = sorted(set(np.random.RandomState(1).randint(0, 10**7, 3000).tolist()))
    df = spark.createDataFrame([(i,) for i in ids], "trip_id long").repartition(5)
    got = sorted((r.idx, r.trip_id) for r in with_index(df, "trip_id", rows_per_bucket=400).collect())
    assert got == list(enumerate(ids))


def test_exact_quantiles_ceil_rank(spark):
    rng = np.random.RandomState(0)
    vals = np.concatenate([rng.lognormal(size=4000), np.full(300, 2.5), rng.normal(size=700)])
    df = spark.createDataFrame([(float(v),) for v in vals], "x double")
    s = np.sort(vals)
    qs = [0.25, 0.5, 0.75, 0.01, 1.0]
    # small final_rows / accuracy force several narrowing rounds
    for kw in ({}, {"final_rows": 50, "accuracy": 100}):
        got = exact_quantiles(df, ["x"], qs, **kw)
        for q in qs:
            assert got[("x", q)] == s[max(1, math.ceil(q * len(s))) - 1], (q, kw)


def test_round_half_up():
    assert round_half_up(2.675) == 2.68 and round_half_up(1.005) == 1.01 and round_half_up(-1.005) == -1.01


def test_quantiles_on_ties_take_few_passes(spark, monkeypatch):
    from fareseg.operators.quantiles import exact_quantiles

    rows = [(float(i % 977),) if i % 20 == 0 else (7.5,) for i in range(20000)]
    df = spark.createDataFrame(rows, "x double")
    passes, agg = [], type(df).agg
    monkeypatch.setattr(type(df), "agg", lambda self, *a: (passes.append(1), agg(self, *a))[1])
    got = exact_quantiles(df, ["x"], [0.25, 0.5, 0.99], final_rows=100)
    values = sorted(r[0] for r in rows)
    assert got == {("x", q): values[-(-int(q * 100) * len(rows) // 100) - 1] for q in (0.25, 0.5, 0.99)}
    assert len(passes) <= 9
