"""Stored quantile sketches: thresholds of any span of days without reading its trips again.

Each day partition keeps one KLL sketch per fare rate, made by Spark's own
sketch aggregate (partial sketches are merged map-side, so a day's rows never
meet in one task). Sketches of days merge into one of the whole span with the
same error bound, so new days only add their own rows.

A KLL sketch is random: a quantile read from it has a true rank within
:func:`rank_error` of the one asked for, in 99 of 100 sketches.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fareseg.operators.segments import RATES, fare_per_mile, round_half_up
from fareseg.schema import LABEL_QUANTILES

#: Size parameter of the sketches (a few thousand bytes each).
SIZE = 400


def rank_error(size: int = SIZE) -> float:
    """The published 99 % bound on a KLL sketch's normalised rank error, as a share of the rows."""
    return 2.296 / size ** 0.9021


def day_sketches(trips: DataFrame, day: Column | str = "day", size: int = SIZE) -> DataFrame:
    """``(day, rate, n, sketch)`` of the fare rates; rows without a rate (null or NaN) aren't counted."""
    day = F.col(day) if isinstance(day, str) else day
    rates = fare_per_mile(trips.withColumn("_day", day), keep=["_day"])
    long = rates.select(F.col("_day").alias("day"), F.inline(F.array(*[
        F.struct(F.lit(name).alias("rate"), F.col(col).alias("_v")) for name, col in RATES.items()])))
    long = long.where(F.col("_v").isNotNull() & ~F.isnan("_v"))
    return long.groupBy("day", "rate").agg(F.count(F.lit(1)).alias("n"), F.kll_sketch_agg_double("_v", F.lit(size)).alias("sketch"))


def store_sketches(sketches: DataFrame, path: str) -> None:
    """Writes day partitions; a day that is there already is replaced, other days stay as they are."""
    (sketches.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day").parquet(path))


def read_sketches(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def merged(sketches: DataFrame, by: tuple[str, ...] = ("rate",)) -> DataFrame:
    """``(by..., n, sketch)`` over all days, merged by a partial aggregate."""
    return sketches.groupBy(*by).agg(F.sum("n").alias("n"), F.kll_merge_agg_double("sketch").alias("sketch"))


def sketch_quantiles(sketches: DataFrame, qs=LABEL_QUANTILES) -> DataFrame:
    """``(rate, q, value, n)`` of the merged days."""
    rows = F.array(*[F.struct(F.lit(float(q)).alias("q"), F.kll_sketch_get_quantile_double("sketch", F.lit(float(q))).alias("value"))
                     for q in qs])
    return merged(sketches).select("rate", "n", F.inline(rows)).select("rate", "q", "value", "n")


def sketch_thresholds(sketches: DataFrame, qs=LABEL_QUANTILES, digits: int = 2) -> dict[str, dict[float, float]]:
    """Like ``fare_thresholds``, from stored sketches: at most one row per rate and quantile to the driver."""
    out: dict[str, dict[float, float]] = {name: {} for name in RATES}
    for r in sketch_quantiles(sketches, qs).collect():
        out[r["rate"]][r["q"]] = round_half_up(r["value"], digits)
    return out


def true_ranks(trips: DataFrame, quantiles: DataFrame) -> DataFrame:
    """``(rate, q, value, n, below, up_to)``: exact counts of rows below and up to each value, for checking sketches."""
    found = quantiles.collect()  # one row per rate and quantile
    rates = fare_per_mile(trips, keep=[])
    counts = rates.agg(*[f(F.col(RATES[r["rate"]]) < r["value"] if kind == "b" else F.col(RATES[r["rate"]]) <= r["value"]).alias(f"{kind}{i}")
                         for i, r in enumerate(found) for kind, f in (("b", F.count_if), ("u", F.count_if))])
    rows = F.array(*[F.struct(F.lit(r["rate"]).alias("rate"), F.lit(r["q"]).alias("q"), F.lit(r["value"]).alias("value"),
                              F.lit(r["n"]).alias("n"), F.col(f"b{i}").alias("below"), F.col(f"u{i}").alias("up_to"))
                     for i, r in enumerate(found)])
    return counts.select(F.inline(rows))
