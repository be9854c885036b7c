"""Cleaning rules on hand-written lines: one line per rule and edge case."""

from conftest import GOOD, line_with, raw_frame

from fareseg.operators.clean import clean_trips, reject_counts, trip_features


def first_rule(spark, lines, require="any"):
    rows = reject_counts(raw_frame(spark, lines), require).collect()
    return {r["rule"]: r["n"] for r in rows}


def test_good_line_features(spark):
    rows = trip_features(clean_trips(raw_frame(spark, [GOOD]))).collect()
    assert len(rows) == 1
    r = rows[0]
    assert r.weekday == 1 and r.hour == 8  # 2013-01-07 is a Monday
    assert r.trip_min == 15.0 and r.distance == 2.5
    assert (r.fare, r.surcharge, r.tip, r.toll) == (10.5, 0.5, 2.0, 0.0)


def test_sunday_is_seven(spark):
    r = trip_features(clean_trips(raw_frame(spark, [line_with(2, "2013-01-06 23:59:59")]))).first()
    assert r.weekday == 7 and r.hour == 23


CASES = {
    "arity": [GOOD + ",0", ",".join(GOOD.split(",")[:16])],          # 18 and 16 fields
    "key": [line_with(0, "", line_with(1, "", line_with(2, "")))],
    "number": [line_with(4, "abc"), line_with(5, "nan"), line_with(11, "inf"), line_with(14, "1.0d"),
               line_with(4, "1e999")],
    "time_zero": [line_with(4, "0"), line_with(4, "0.0")],
    "distance_zero": [line_with(5, "-0")],
    "fare_range": [line_with(11, "0.99"), line_with(11, "600.01")],
    "surcharge": [line_with(12, "-0.5"), line_with(12, "x")],
    "tip": [line_with(14, "-1")],
    "toll": [line_with(15, "-2"), line_with(15, "")],
    "longitude": [line_with(6, "-70.9"), line_with(8, "-80.1"), line_with(6, "0")],
    "latitude": [line_with(7, "39.99"), line_with(9, "45.01"), line_with(9, "lat")],
    "datetime": [line_with(2, "2013-02-30 10:00:00"), line_with(2, "2013-01-07"), line_with(2, "")],
}


def test_each_rule_rejects(spark):
    for rule, lines in CASES.items():
        got = first_rule(spark, lines)
        assert got == {rule: len(lines)}, (rule, got)


def test_boundaries_pass(spark):
    lines = [line_with(11, "1"), line_with(11, "600"), line_with(6, "-80"), line_with(8, "-71"),
             line_with(7, "40"), line_with(9, "45"), line_with(4, "-60"), line_with(14, " 2.5 "),
             line_with(5, "1e-3"), line_with(12, "0")]
    assert first_rule(spark, lines) == {"kept": len(lines)}


def test_any_key_vs_all_keys(spark):
    lines = [line_with(0, ""), line_with(1, "")]
    assert first_rule(spark, lines, "any") == {"kept": 2}
    assert first_rule(spark, lines, "all") == {"key": 2}


def test_counts_sum_to_input(spark):
    lines = [GOOD] + [ln for v in CASES.values() for ln in v]
    got = first_rule(spark, lines)
    assert sum(got.values()) == len(lines) and got["kept"] == 1


def test_short_and_fractional_datetimes_are_kept(spark):
    from pyspark.sql import functions as F

    from fareseg.functions.numeric import to_datetime

    df = spark.createDataFrame([("2013-1-7 08:15:00",), ("2013-01-07 08:15:00.0",), ("2013-01-07 08:15",), ("x",), ("2013-13-01 00:00:00",)], "s string")
    got = [r[0] for r in df.select(F.hour(to_datetime("s"))).collect()]
    assert got == [8, 8, 8, None, None]
