"""Sums and fits have the same bits however the rows are dealt; bounds spare distances and change nothing."""

import math

import numpy as np
import pytest

from fareseg.operators import kmeans as K
from fareseg.operators import mixture as X
from fareseg.operators import scan as SC
from fareseg.operators import stats as ST
from fareseg.operators import sweep as SW

COLS = ["a", "b", "c"]


def rows(n=3000, seed=0):
    rng = np.random.default_rng(seed)
    centers = rng.uniform(-5, 5, size=(6, 3))
    x = centers[rng.integers(0, 6, n)] + rng.normal(size=(n, 3)) * [1.0, 1.7, 0.4]
    return x * [1.0, 1e3, 1e-5] + [0.0, -74e3, 0.0]


def dealt(spark, x, parts, seed):
    """The same rows in another order and another number of partitions."""
    order = np.random.default_rng(seed).permutation(len(x))
    df = spark.createDataFrame([(int(i), *map(float, x[i])) for i in order], "trip_id long, a double, b double, c double")
    return df.coalesce(1) if parts == 1 else df.repartition(parts)


def test_folds_are_exact_in_any_order():
    rng = np.random.default_rng(1)
    v = rng.normal(size=20_000) * 10.0 ** rng.integers(-12, 3, 20_000)
    folds, bound = SC.Folds(len(v)), float(np.abs(v).max())
    assert folds.count * folds.bits >= SC.KEPT_BITS
    results = set()
    for s in range(6):
        w = rng.permutation(v)
        parts = [folds.sums(p, bound) for p in np.array_split(w, rng.integers(1, 50))]
        results.add(float(SC.Folds.joined(sum(parts)[:, None])[0]))
    assert len(results) == 1
    assert results.pop() == pytest.approx(math.fsum(v), abs=len(v) * bound * 2.0 ** -SC.KEPT_BITS)
    zero = folds.split(np.zeros(3), 0.0)
    assert not zero.any() and SC.Folds(10 ** 12).count > folds.count
    with pytest.raises(ValueError):
        SC.Folds(1 << 60)


def test_statistics_have_the_same_bits(spark):
    x = rows()
    got = [ST.feature_stats_row(dealt(spark, x, p, s), COLS) for s, p in enumerate((1, 4, 16))]
    assert got[0] == got[1] == got[2]
    for i, c in enumerate(COLS):
        assert got[0].mean[c] == pytest.approx(math.fsum(x[:, i]) / len(x), rel=1e-14)
        assert got[0].var[c] == pytest.approx(x[:, i].var(), rel=1e-12)


def same_model(a, b):
    return (a.rounds == b.rounds and a.reassigned == b.reassigned and (a.centroids == b.centroids).all() and (a.stats.sums == b.stats.sums).all()
            and (a.stats.n == b.stats.n).all() and a.sum_distance == b.sum_distance and a.wssse == b.wssse)


def test_fits_have_the_same_bits(spark, monkeypatch):
    monkeypatch.setattr(SC, "DIRECT_TASKS", 8)  # so that both ways of adding the tasks' vectors run
    x = rows()
    models, sweeps, mixtures, scores = [], [], [], []
    for s, p in enumerate((1, 4, 16)):
        df = dealt(spark, x, p, s)
        z = ST.scaled_features(df, COLS)
        models.append(K.kmeans_fit(z, COLS, k=5))
        sweeps.append(SW.k_sweep(z, COLS, (2, 3, 7)))
        scores.append(SW.multi_silhouette(z, COLS, sweeps[-1]))
        labelled = K.assign(z, COLS, models[-1].centroids, keep=("trip_id", *COLS))
        init = X.init_from_clusters(labelled, COLS, "cluster", 5, np.zeros(3))
        mixtures.append(X.gmm_fit(z, COLS, init, max_iter=8)[0])
    assert all(same_model(models[0], m) for m in models[1:]) and models[0].converged
    assert all(same_model(sweeps[0][k], t[k]) for t in sweeps[1:] for k in t)
    assert scores[0] == scores[1] == scores[2]
    for m in mixtures[1:]:
        assert (m.phi == mixtures[0].phi).all() and (m.mu == mixtures[0].mu).all() and (m.sigma == mixtures[0].sigma).all()
        assert m.deltas == mixtures[0].deltas


def test_bounds_spare_distances_and_keep_the_result(spark, monkeypatch):
    x = np.round(rows(4000, 3) / [1.0, 1e3, 1e-5] * 4) / 4  # many ties
    df = dealt(spark, x, 4, 0)
    pruned = SW.k_sweep(df, COLS, (1, 2, 5, 9))
    monkeypatch.setattr(SW, "FIRST_ROUNDS", 10 ** 9)
    plain = SW.k_sweep(df, COLS, (1, 2, 5, 9))
    assert all(same_model(pruned[k], plain[k]) for k in plain)
    assert sum(m.distances for m in pruned.values()) < 0.5 * sum(m.unpruned for m in pruned.values())
    for k, m in pruned.items():
        lab = np.stack([((x - c) ** 2).sum(axis=1) for c in m.centroids]).argmin(axis=0)
        assert m.converged and (np.bincount(lab, minlength=k) == m.stats.n).all()


def test_bad_features_are_an_error(spark):
    df = spark.createDataFrame([(1, 1.0, 2.0), (2, None, 1.0), (3, float("nan"), 0.0), (4, 1.0, float("inf"))], "trip_id long, a double, b double")
    with pytest.raises(ValueError, match="3 of 4 rows"):
        K.kmeans_fit(df, ["a", "b"], init=np.zeros((1, 2)))
    with pytest.raises(ValueError, match="3 of 4 rows"):
        ST.feature_stats_row(df, ["a", "b"])


def test_the_least_rows(spark):
    df = spark.createDataFrame([(1, 1.0, 2.0)], "trip_id long, a double, b double")
    m = K.kmeans_fit(df, ["a", "b"], k=1)
    assert m.converged and m.centroids.tolist() == [[1.0, 2.0]] and m.wssse == 0.0
    empty = df.limit(0)
    assert SC.extent(empty, ["a", "b"]).rows == 0 and SC.column_sums(empty, {"a": "a"}, {"a": 0.0}, 0) == {"a": 0.0}


def test_rounds_of_few_near_rows_scan_a_table_of_them(spark, monkeypatch):
    x = rows(4000, 5)
    df = dealt(spark, x, 4, 1)
    tables, seen = [], []
    make, scan = SW.near_rows, SW.round_scan
    monkeypatch.setattr(SW, "near_rows", lambda blocks, models: tables.append(len(models)) or make(blocks, models))
    monkeypatch.setattr(SW, "round_scan", lambda *a: seen.append((set(a[2]) - set(a[3]), a)) or scan(*a))
    z = ST.scaled_features(df, COLS)
    pruned = SW.k_sweep(z, COLS, (2, 6, 8))
    assert tables and any(not full for full, _ in seen)  # rounds that read no block of all rows
    monkeypatch.setattr(SW, "FIRST_ROUNDS", 10 ** 9)
    plain = SW.k_sweep(z, COLS, (2, 6, 8))
    assert all(same_model(pruned[k], plain[k]) for k in plain)


def test_moments_are_exact_in_any_order_and_chunking(monkeypatch):
    rng = np.random.default_rng(3)
    x, r = rng.normal(size=(5000, 3)) * [1.0, 1e3, 1e-5], rng.random((5000, 2))
    reach = np.abs(x).max(axis=0)
    results = set()
    for chunk in (2048, 100, 1500):
        monkeypatch.setattr(X, "CHUNK", chunk)
        order = rng.permutation(len(x))
        parts = [X._moment_pieces(r[p], x[p], reach) for p in np.array_split(order, 7)]
        results.add(SC.Folds.joined(sum(parts)).tobytes())
    assert len(results) == 1
    W, S, Q = X._moments(np.frombuffer(results.pop()), 2, 3)
    for j in range(2):
        assert W[j] == pytest.approx(math.fsum(r[:, j]), rel=1e-14)
        for a in range(3):
            assert S[j, a] == pytest.approx(math.fsum(r[:, j] * x[:, a]), abs=1e-13 * len(x) * reach[a])
            for b in range(3):
                assert Q[j, a, b] == pytest.approx(math.fsum(r[:, j] * x[:, a] * x[:, b]), rel=1e-12, abs=1e-13 * len(x) * reach[a] * reach[b])


def test_a_job_per_scan_adds_many_tasks_and_two_tables(spark, monkeypatch):
    df = spark.range(1000).selectExpr("cast(id as double) as a").repartition(12)
    folds = SC.Folds(1000)

    def kernel(x, *more):
        return folds.sums(x[:, 0], 1000.0)[:, None]

    blocks = SC.blocked(df, ["a"])
    for direct in (32, 4):
        monkeypatch.setattr(SC, "DIRECT_TASKS", direct)
        assert SC.Folds.joined(SC.summed(df, ["a"], kernel, 1, folds.count))[0] == 499500.0
        assert SC.Folds.joined(SC.summed([blocks, blocks], (), kernel, 1, folds.count))[0] == 999000.0
        assert not SC.summed(df.limit(0), ["a"], kernel, 1, folds.count).any()


def test_a_scan_of_all_rows_adds_only_the_changed_ones_to_the_sums_before(spark):
    cols, x = ["a", "b", "c"], rows(3000, 7)
    df = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(x)], "trip_id long, a double, b double, c double").repartition(5)
    data, size = K.loop_input(df, cols)
    try:
        n, values = data.first()  # blocks are kept as Python bytes, not as rows
        assert type(values) is bytes and len(values) == n * 3 * 8
        prev = x[:4].copy()
        first, *_ = SW.round_scan(data, size, {0: (prev, None)}, {})[0]
        cur = K.update_centroids(SW._stats(first, 4, 3), prev)
        whole = SW.round_scan(data, size, {0: (cur, prev)}, {})[0]
        shifted = SW.round_scan(data, size, {0: (cur, prev)}, {}, None, {0: first})[0]
        assert (whole[0] == shifted[0]).all() and whole[1:] == shifted[1:] and 0 < whole[1] < len(x)
        change = SW.round_scan(data, size, {0: (cur, prev)}, {}, None, {0: np.zeros_like(first)})[0][0]
        assert (change + first == whole[0]).all() and (change != whole[0]).any()
        same = SW.round_scan(data, size, {0: (cur, cur)}, {}, None, {0: whole[0]})[0]
        assert same[1] == 0 and (same[0] == whole[0]).all()
    finally:
        data.unpersist()


def test_several_models_some_in_a_table_keep_the_bits_of_full_sums(spark, monkeypatch):
    x = np.round(rows(4000, 11) / [1.0, 1e3, 1e-5] * 8) / 8
    df = dealt(spark, x, 6, 2)
    scan = SW.round_scan
    ours = SW.k_sweep(df, COLS, (1, 3, 6))
    monkeypatch.setattr(SW, "round_scan", lambda *a: scan(*a[:5]))  # all sums anew in every scan of all rows
    plain = SW.k_sweep(df, COLS, (1, 3, 6))
    assert all(same_model(ours[k], plain[k]) for k in plain)


def test_the_sieve_finds_the_nearest_and_computes_few_distances(monkeypatch):
    rng, exact, count = np.random.default_rng(5), SW._nearest, [0]
    monkeypatch.setattr(SW, "_nearest", lambda x, c: count.__setitem__(0, count[0] + len(x)) or exact(x, c))
    x = rows(20_000, 13) / [1.0, 1e3, 1e-5]
    grid = np.round(x * 4) / 4  # many ties
    for at, few in ((x, 0.02), (grid, 1.0), (x + 1e5, 0.02), (x * 1e12, 0.02), (x * 1e-18, 1.0), (x * 1e140, 1.0), (x[:1], 1.0), (x[:0], 1.0), (x * 0, 1.0)):
        at = np.asfortranarray(at)
        for k in (1, 2, 9, 20, 300):
            cents = (at if len(at) else x)[rng.integers(0, len(at) or 9, k)]
            count[0] = 0
            lab, lead = SW._Sieve(at, SW._middle([cents])).assigned(cents)
            assert k > 256 or count[0] <= few * len(at)
            want, near, second = exact(at, cents)
            assert (lab == want).all() and (lead <= SW._leads(near, second)).all()
            assert (SW._own_sq_dist(at, cents, lab) == near).all()


def test_a_scan_of_all_rows_computes_few_rows_exactly(monkeypatch):
    x = np.asfortranarray(rows(20_000, 17) / [1.0, 1e3, 1e-5])
    exact, count = SW._nearest, [0]
    monkeypatch.setattr(SW, "_nearest", lambda x, c: count.__setitem__(0, count[0] + len(x)) or exact(x, c))
    monkeypatch.setattr(SW, "summed", lambda data, cols, kernel, size, folds: kernel(x))
    size = SC.Extent(len(x), np.abs(x).max(axis=0))
    cur = {k: x[:k] + 1e-3 for k in (2, 5, 9)}
    found = SW.round_scan([], size, {k: (c, x[:k]) for k, c in cur.items()}, {})
    assert count[0] < 0.05 * len(x) * len(cur)
    for k, c in cur.items():
        now, was = exact(x, c)[0], exact(x, x[:k])[0]
        assert found[k][1] == (now != was).sum() and (SW._stats(found[k][0], k, 3).n == np.bincount(now, minlength=k)).all()


def test_tables_of_models_whose_allowance_lasts_stay(spark, monkeypatch):
    z = ST.scaled_features(dealt(spark, rows(4000, 5), 4, 1), COLS)
    made, seen, make, scan = [], [], SW.near_rows, SW.round_scan
    monkeypatch.setattr(SW, "near_rows", lambda blocks, models: made.append([m[2] for m in models]) or make(blocks, models))
    monkeypatch.setattr(SW, "round_scan", lambda *a: seen.append((set(a[3]), len(a[4]))) or scan(*a))
    several = SW.k_sweep(z, COLS, (2, 4, 6, 8))
    assert max(tables for _, tables in seen) > 1  # a model got a new table beside one that stays
    assert all(tables <= SW.MOST_TABLES for _, tables in seen)
    assert len({n for ms in made for n in ms}) == sum(map(len, made))
    monkeypatch.setattr(SW, "MOST_TABLES", 1)
    one = SW.k_sweep(z, COLS, (2, 4, 6, 8))
    monkeypatch.setattr(SW, "FIRST_ROUNDS", 10 ** 9)
    plain = SW.k_sweep(z, COLS, (2, 4, 6, 8))
    assert all(same_model(several[k], plain[k]) and same_model(one[k], plain[k]) for k in plain)


def test_blocks_hold_many_batches(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "100")
    try:
        df = spark.range(0, 1000, 1, 1).selectExpr("cast(id as double) as a", "cast(-id as double) as b")
        blocks = SC.blocked(df, ["a", "b"]).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert [b["_n"] for b in blocks] == [1000]  # ten batches, one block
    x = SC.matrix(1000, bytes(blocks[0]["_x"]))
    assert x[:, 0].tolist() == list(range(1000)) and (x[:, 1] == -x[:, 0]).all()


def test_models_whose_table_goes_get_a_new_one(monkeypatch):
    """A model that moved to a new table isn't taken from an old one that stays; the loop alone, without Spark."""
    class Blocks(list):
        def mapPartitions(self, f):
            return Blocks(f(iter(self)))

        def persist(self, level):
            return self

        def unpersist(self):
            self.clear()

    def summed(data, cols, kernel, size, count):
        parts = [kernel(SC.matrix(n, b), *more) for t in (data if type(data) is list else [data]) for n, b, *more in t]
        return sum(parts, np.zeros((count, size)))

    x = np.random.default_rng(0).uniform(-1, 1, (6000, 7))
    x[:, 0] = np.round(3 * x[:, 0]) / 3
    monkeypatch.setattr(SW, "summed", summed)
    monkeypatch.setattr(SW, "loop_input", lambda df, cols: (Blocks((2000, x[i:i + 2000].tobytes("F")) for i in range(0, 6000, 2000)),
                                                            SC.Extent(6000, np.abs(x).max(axis=0))))

    def fits():
        return SW.kmeans_many(None, range(7), {k: x[:k] for k in range(2, 21)})

    got = []
    for most in (1, 2, 3, 4, 6):
        monkeypatch.setattr(SW, "MOST_TABLES", most)
        got.append(fits())
    monkeypatch.setattr(SW, "FIRST_ROUNDS", 10 ** 9)
    plain = fits()
    assert [k for models in got for k in plain if not same_model(models[k], plain[k])] == []
