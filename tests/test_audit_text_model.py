"""One-pass audit, row identity of text files, sampling bounds, elbow choice, saved models."""

import hashlib
import os
import re

import numpy as np
import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F
from test_sampling_quantiles import brute_sample

from fareseg.operators import audit as A
from fareseg.operators import sampling as S
from fareseg.operators.clean import RULES, clean_trips, reject_counts, trips_from_raw
from fareseg.plans import model as MO
from fareseg.plans import segmentation as P
from fareseg.sources import text as TX
from fareseg.sources.fixtures import raw_trips


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


# -- one-pass audit ------------------------------------------------------------
def test_audit_counts_and_both_outcomes_from_one_scan(spark, tmp_path):
    raw = raw_trips(spark, SF_SMALL)
    seen = spark.sparkContext.accumulator(0)

    def touch(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b
    path = str(tmp_path / "audit")
    counts = A.clean_to(raw.mapInArrow(touch, "trip_id long, line string"), path)
    n = raw.count()
    assert seen.value == n  # every line read once
    assert {r: c for r, c in counts.items() if c} == {r["rule"]: r["n"] for r in reject_counts(raw).collect()}
    assert sum(counts.values()) == n and set(counts) == {*RULES, "kept"}
    kept, bad = A.read_kept(spark, path), A.read_quarantine(spark, path)
    want = clean_trips(raw)
    assert sorted(map(tuple, kept.select(want.drop("n_fields").columns).collect())) == sorted(map(tuple, want.drop("n_fields").collect()))
    assert sorted(map(tuple, A.read_trips(spark, path).collect())) == sorted(map(tuple, trips_from_raw(raw).collect()))
    lines = {r["trip_id"]: r["line"] for r in raw.collect()}
    assert all(lines[r["trip_id"]] == r["line"] for r in bad.collect()) and bad.count() + kept.count() == n
    assert "PartitionFilters: [isnotnull(rule" in plan_of(kept)


def test_audit_written_again_and_of_nothing(spark, tmp_path):
    raw = raw_trips(spark, SF_SMALL).repartition(4)
    a, b = A.clean_to(raw, str(tmp_path / "a")), A.clean_to(raw, str(tmp_path / "a"))
    assert a == b  # writing again counts anew, not on top
    empty = A.clean_to(raw.limit(0), str(tmp_path / "b"))
    assert set(empty.values()) == {0} and A.counts_frame(spark, empty).count() == 0


def test_stream_reports_the_same_counts(spark, tmp_path):
    raw = raw_trips(spark, SF_SMALL)
    source = str(tmp_path / "in")
    raw.repartition(3).write.parquet(source)
    told = []
    listener = A.AuditListener(lambda batch, counts: told.append(batch))
    spark.streams.addListener(listener)
    try:
        stream = spark.readStream.schema("trip_id bigint, line string").option("maxFilesPerTrigger", "1").parquet(source)
        q = (A.audited_stream(stream).writeStream.partitionBy("rule").option("checkpointLocation", str(tmp_path / "cp"))
             .trigger(availableNow=True).start(str(tmp_path / "out")))
        q.awaitTermination()
        for _ in range(100):
            if sum(listener.totals.values()) == raw.count():
                break
            import time
            time.sleep(0.1)
    finally:
        spark.streams.removeListener(listener)
    assert {r: n for r, n in listener.totals.items() if n} == {r["rule"]: r["n"] for r in reject_counts(raw).collect()}
    assert len(set(told)) == 3


# -- identity of text rows -------------------------------------------------------
def write_files(folder, compress=None):
    import bz2
    import gzip

    os.makedirs(folder)
    rng = np.random.default_rng(2)
    files = {}
    for name in ("b.csv", "a.csv", "c.csv"):
        lines = ["".join(rng.choice(list("abcé,漢0"), rng.integers(0, 60))) for _ in range(400)]
        end = "\r\n" if name == "b.csv" else "\n"
        data = end.join(lines).encode() + (b"" if name == "c.csv" else end.encode())
        files[name] = data
        kind = {"bz2": bz2.compress, "gz": gzip.compress, None: lambda x: x}[compress]
        with open(os.path.join(folder, name + (f".{compress}" if compress else "")), "wb") as f:
            f.write(kind(data))
    return files


@pytest.mark.parametrize("compress", [None, "bz2", "gz"])
def test_rows_of_text_are_known_by_file_and_byte(spark, tmp_path, compress):
    folder = str(tmp_path / "t")
    files = write_files(folder, compress)
    want, base = [], 0
    for name in sorted(files):
        at = 0
        for line in files[name].split(b"\n")[:-1] if files[name].endswith(b"\n") else files[name].split(b"\n"):
            want.append((base + at, line.decode().removesuffix("\r"), at))
            at += len(line) + 1
        base += at
    seen, samples = [], []
    for size in ("1000", "4000", "1g"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        try:
            df = TX.read_raw_trips(spark, folder)
            seen.append(sorted((r["trip_id"], r["line"], r["offset"]) for r in df.collect()))
            samples.append(sorted(r["trip_id"] for r in S.sample_exact(df, 50, 7).collect()))
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
            spark.conf.unset("spark.sql.files.openCostInBytes")
    assert seen[0] == seen[1] == seen[2] == want
    assert samples[0] == samples[1] == samples[2]


def test_text_joins_when_there_are_many_splits(spark, tmp_path, monkeypatch):
    folder = str(tmp_path / "t")
    write_files(folder)
    a = TX.read_raw_trips(spark, folder)
    monkeypatch.setattr(TX, "MAX_SENT", 0)
    b = TX.read_raw_trips(spark, folder)
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))
    os.makedirs(str(tmp_path / "none"))
    open(str(tmp_path / "none" / "x.csv"), "w").close()
    assert TX.read_raw_trips(spark, str(tmp_path / "none")).collect() == []


# -- sampling ---------------------------------------------------------------------
def test_sample_is_a_filter_found_by_narrowing(spark, monkeypatch):
    ids = list(range(0, 60000, 3))
    df = spark.createDataFrame([(i, float(i)) for i in ids], "trip_id long, v double")
    for last, digits in ((1000, 4), (3, 1), (1, 2)):
        monkeypatch.setattr(S, "LAST_ROWS", last)
        monkeypatch.setattr(S, "DIGITS", digits)
        for n in (1, 40, 7000, 19_999):
            out = S.sample_exact(df, n, 42)
            assert sorted(r.trip_id for r in out.collect()) == sorted(brute_sample(ids, n, 42))
            assert not re.search("TakeOrdered|SinglePartition|Exchange|Limit", plan_of(out))


def test_sample_of_repeated_and_missing_keys(spark):
    keys = [1, 1, 1, 1, 2, 2, 3, None, None]
    df = spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "trip_id long, v int")
    order = sorted((k for k in keys if k is not None), key=lambda k: (hashlib.md5(f"5:{k}".encode()).hexdigest(), k))
    for n in range(0, 10):
        assert sorted(r.trip_id for r in S.sample_exact(df, n, 5).collect()) == sorted(order[:n])
    assert S.sample_exact(df.limit(0), 3, 5).count() == 0


# -- elbow ---------------------------------------------------------------------------
def scores(spark, costs, first=2):
    return spark.createDataFrame([(first + i, float(c)) for i, c in enumerate(costs)], "k int, sum_distance double")


def test_elbow_is_the_farthest_from_the_chord(spark):
    assert P.pick_k(scores(spark, [100, 60, 30, 27, 25, 24]), by="elbow").first().k == 4
    gaps = {r.k: r.gap for r in P.elbow(scores(spark, [100, 60, 30, 27, 25, 24])).collect()}
    assert gaps[2] == pytest.approx(0) and gaps[7] == pytest.approx(0)
    assert gaps[4] == pytest.approx((1 - 2 / 5 - (30 - 24) / 76) / 2 ** 0.5)
    for none in ([100, 80, 60, 40, 20], [10, 20, 30], [5, 5, 5], [9, 1], [7], []):  # straight, rising, flat, too short
        assert P.pick_k(scores(spark, none), by="elbow").first().k is None
    assert P.pick_k(scores(spark, [100, 20, 20.0, 20]), by="elbow").first().k == 3


# -- saved models -------------------------------------------------------------------------
def test_model_round_trip_in_a_new_session(spark, tmp_path):
    raw = raw_trips(spark, SF_SMALL)
    res = P.segment_trips(raw, k=4, em_max_iter=5, checkpoint=False)
    path, model = str(tmp_path / "m"), res.model()
    model.write().save(path)
    model.save(path)
    assert MO.versions(spark, path) == [1, 2] and sorted(os.listdir(path)) == ["version=1", "version=2"]
    trips = trips_from_raw(raw)
    want = sorted(map(tuple, model.transform(trips).select("trip_id", "cluster", "component", "d_label", "p_label").collect()))
    back = MO.SegmentationModel.read().load(path, version=1)
    assert (back.parts.mixture.sigma == model.parts.mixture.sigma).all() and back.parts.stats == model.parts.stats
    for loaded in (back, MO.SegmentationModel.load(path)):
        got = loaded.transform(spark.newSession().createDataFrame(trips.collect(), trips.schema))
        assert sorted(map(tuple, got.select("trip_id", "cluster", "component", "d_label", "p_label").collect())) == want
    plain = MO.SegmentationModel(MO.Parts(res.stats, res.kmeans.centroids))
    plain.save(str(tmp_path / "p"))
    out = MO.SegmentationModel.load(str(tmp_path / "p")).transform(trips)
    assert "component" not in out.columns and out.groupBy("cluster").agg(F.count("*")).count() == 4


def test_readers_see_whole_versions_only(spark, tmp_path):
    path = str(tmp_path / "m")
    with pytest.raises(FileNotFoundError):
        MO.SegmentationModel.load(path)
    os.makedirs(os.path.join(path, "_staging-x"))
    with pytest.raises(FileNotFoundError):
        MO.SegmentationModel.load(path)


def test_a_version_that_is_there_is_neither_replaced_nor_entered(spark, tmp_path):
    for name in ("staged", "version=1"):
        spark.range(3).write.parquet(str(tmp_path / name))
    before = sorted(os.listdir(tmp_path / "version=1"))
    assert not MO._renamed(spark, str(tmp_path / "staged"), str(tmp_path / "version=1"))
    assert sorted(os.listdir(tmp_path / "version=1")) == before and os.path.isdir(tmp_path / "staged")
    assert MO._renamed(spark, str(tmp_path / "staged"), str(tmp_path / "version=2")) and not os.path.exists(tmp_path / "staged")
