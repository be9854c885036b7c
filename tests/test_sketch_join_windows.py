"""Stored sketches, bucketed joins, event-time windows and repeated trips on streams."""

import re

import numpy as np
import pytest
from conftest import SF_SMALL, line_with
from pyspark.sql import functions as F
from test_audit_text_model import plan_of

from fareseg.operators import joins as JN
from fareseg.operators import segments as G
from fareseg.operators import sketches as SK
from fareseg.operators.clean import clean_trips, trip_features
from fareseg.operators.stats import FeatureStats
from fareseg.schema import FEATURES
from fareseg.session import scratch
from fareseg.sources.fixtures import raw_trips
from fareseg.streaming import windows as W


# -- sketches ---------------------------------------------------------------------
def day_trips(spark, days=5, n=4000):
    rng = np.random.default_rng(4)
    rows = [(int(d), float(10 + rng.gamma(2.0) * (d + 1)), 1.0, 0.5, 0.0, float(rng.uniform(0.5, 9))) for d in range(days) for _ in range(n)]
    return spark.createDataFrame(rows, "day int, fare double, surcharge double, tip double, toll double, distance double")


def test_merged_day_sketches_are_within_their_bound(spark, tmp_path):
    trips = day_trips(spark)
    path = str(tmp_path / "s")
    SK.store_sketches(SK.day_sketches(trips.where("day < 4")), path)
    SK.store_sketches(SK.day_sketches(trips.where("day >= 3")), path)  # day 3 again, day 4 new
    stored = SK.read_sketches(spark, path)
    assert {(r["day"], r["rate"]): r["n"] for r in stored.collect()} == {(d, r): 4000 for d in range(5) for r in G.RATES}
    found = SK.sketch_quantiles(stored, (0.9, 0.75, 0.5, 0.25, 0.01))
    rates = {name: np.sort(np.array(G.fare_per_mile(trips, keep=[]).select(c).toPandas()[c])) for name, c in G.RATES.items()}
    ranks = {(r["rate"], r["q"]): r for r in SK.true_ranks(trips, found).collect()}
    assert len(ranks) == 10
    for (rate, q), r in ranks.items():
        v = rates[rate]
        assert r["n"] == len(v) and r["below"] == np.searchsorted(v, r["value"]) and r["up_to"] == np.searchsorted(v, r["value"], "right")
        assert r["below"] / len(v) - 2 * SK.rank_error() <= q <= r["up_to"] / len(v) + 2 * SK.rank_error()
    part = stored.where("day in (1, 2)")
    assert {r["n"] for r in SK.merged(part).collect()} == {8000}
    assert "Scan parquet" in plan_of(part) and "PartitionFilters: [day" in plan_of(part)


def test_labels_by_sketch_agree_with_exact_ones_away_from_the_thresholds(spark):
    trips = trip_features(clean_trips(raw_trips(spark, SF_SMALL)), ("trip_id", "ts"))
    exact = G.fare_thresholds(trips)
    rough = SK.sketch_thresholds(SK.day_sketches(trips, F.to_date("ts")))
    assert rough.keys() == exact.keys() and all(rough[r].keys() == exact[r].keys() for r in rough)
    n = trips.count()
    a, b = (trips.select("trip_id", *G.label_columns(t)) for t in (exact, rough))
    differ = a.join(b.select("trip_id", F.col("d_label").alias("x"), F.col("p_label").alias("y")), "trip_id").where("x <> d_label or y <> p_label").count()
    assert differ <= 4 * n * (2 * SK.rank_error() + 0.01)  # two thresholds a rate, and their rounding


def test_sketches_of_nothing_and_of_rows_without_a_rate(spark):
    trips = day_trips(spark, 1, 5).withColumn("fare", F.when(F.rand(1) < 2, F.lit(None).cast("double")))
    assert SK.day_sketches(trips).collect() == [] and SK.sketch_thresholds(SK.day_sketches(trips)) == {r: {} for r in G.RATES}


# -- joins --------------------------------------------------------------------------
def test_bucketed_join_has_no_exchange_and_no_sort(spark):
    a = spark.range(5000).selectExpr("id * 3 as trip_id", "id as x")
    b = spark.range(9000).selectExpr("id * 2 as trip_id", "cast(id as double) as y")
    for name, df in (("bucketed_a", a), ("bucketed_b", b)):
        JN.store_bucketed(df, name, scratch(spark, name), 6)
    joined = JN.join_bucketed(spark, "bucketed_a", "bucketed_b")
    assert not re.search("Exchange|Broadcast", plan_of(joined)) and "SortMergeJoin" in plan_of(joined)
    want = JN.join_on_key(a, b)
    assert sorted(map(tuple, joined.collect())) == sorted(map(tuple, want.collect())) and joined.count() == 2500
    left = JN.join_bucketed(spark, "bucketed_a", "bucketed_b", how="left")
    assert left.count() == 5000 and not re.search("Exchange", plan_of(left))
    for name in ("bucketed_a", "bucketed_b"):
        spark.sql(f"drop table {name}")


# -- event time -----------------------------------------------------------------------
STATS = FeatureStats(1, dict.fromkeys(FEATURES, 0.0), dict.fromkeys(FEATURES, 1.0))
CENTROIDS = np.array([[0, 8, -73.98, 40.75, -73.95, 40.77, 15.0], [0, 20, -73.98, 40.75, -73.95, 40.77, 15.0]])
LIMITS = {"driver": {0.75: 5.0, 0.5: 4.0, 0.25: 3.0}, "passenger": {0.75: 5.0, 0.5: 4.0, 0.25: 3.0}}


def trip(medallion, hour, minute=0, day=7):
    return line_with(2, f"2013-01-{day:02d} {hour:02d}:{minute:02d}:00", line_with(0, medallion))


def stream_counts(spark, tmp_path, batches, name):
    folder = tmp_path / "in"
    folder.mkdir()
    schema = "trip_id bigint, line string"
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", "1").json(str(folder))
    rows = W.scored(W.without_repeats(W.timed_trips(stream, "2 hours")), LIMITS, STATS, CENTROIDS)
    q = (W.windowed_counts(rows).writeStream.outputMode("append").format("memory").queryName(name)
         .option("checkpointLocation", str(tmp_path / "cp")).start())
    progress, n = [], 0
    try:
        for i, lines in enumerate(batches):
            import json
            (tmp_path / f"{i}.json").write_text("\n".join(json.dumps({"trip_id": n + j, "line": x}) for j, x in enumerate(lines)))
            (tmp_path / f"{i}.json").rename(folder / f"{i}.json")
            n += len(lines)
            q.processAllAvailable()
            progress.append(q.lastProgress)
        progress = q.recentProgress
    finally:
        q.stop()
    got = {(str(r["start"]), r["cluster"]): r["n"] for r in spark.sql(f"select start, cluster, sum(n) as n from {name} group by all").collect()}
    return got, progress


def test_windows_late_rows_and_repeats(spark, tmp_path):
    batches = [
        [trip("a", 8), trip("b", 8, 30), trip("a", 8), trip("c", 9)],         # a twice
        [trip("b", 8, 30), trip("d", 8, 45), trip("e", 12)],                   # b again, within the delay; d late but in time
        [trip("f", 8, 50), trip("g", 13)],                                     # f later than the watermark (12:00 - 2 h)
        [trip("h", 20)],
        [trip("i", 23)],
    ]
    got, progress = stream_counts(spark, tmp_path, batches, "segment_windows")
    assert got == {("2013-01-07 08:00:00", 0): 3, ("2013-01-07 09:00:00", 0): 1, ("2013-01-07 12:00:00", 0): 1,
                   ("2013-01-07 13:00:00", 0): 1, ("2013-01-07 20:00:00", 1): 1}
    dropped = sum(s["numRowsDroppedByWatermark"] for p in progress for s in p["stateOperators"])
    assert dropped >= 1
    lines = [x for b in batches for x in b]
    raw = spark.createDataFrame(list(enumerate(lines)), "trip_id long, line string")
    batch = W.windowed_counts(W.scored(W.without_repeats(W.timed_trips(raw)), LIMITS, STATS, CENTROIDS))
    want = {(str(r["start"]), r["cluster"]): r["n"] for r in batch.groupBy("start", "cluster").agg(F.sum("n").alias("n")).collect()}
    want[("2013-01-07 08:00:00", 0)] -= 1                       # the late trip
    assert got == {k: n for k, n in want.items() if k[0] < "2013-01-07 21"}  # the last window is still open


def test_state_stays_bounded(spark, tmp_path):
    batches = [[trip(f"m{d}-{h}-{i}", h, i, d) for h in range(24) for i in range(0, 60, 20)] for d in range(1, 8)]
    got, progress = stream_counts(spark, tmp_path, batches, "bounded_windows")
    held = [sum(s["numRowsTotal"] for s in p["stateOperators"]) for p in progress]
    assert max(held) <= 2 * len(batches[0]) + 40 and sum(got.values()) >= 6 * len(batches[0])


@pytest.mark.parametrize("slide", [None, "30 minutes"])
def test_sliding_windows_count_a_trip_in_each(spark, slide):
    raw = spark.createDataFrame([(0, trip("a", 8, 40)), (1, trip("b", 9, 10))], "trip_id long, line string")
    out = W.windowed_counts(W.scored(W.timed_trips(raw), LIMITS, STATS, CENTROIDS), "1 hour", slide)
    assert out.agg(F.sum("n")).first()[0] == (4 if slide else 2)
