"""Fare-per-mile segments: rates, quantile thresholds, labels and summaries.

Labels are a function of the row and two thresholds per rate, so they are a
computed column (no join, no driver map). Summaries are one ``groupBy`` with
map-side partial aggregation: the shuffle carries k rows per partition.
"""

from __future__ import annotations

from decimal import ROUND_HALF_UP, Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fareseg.operators.quantiles import exact_quantiles
from fareseg.schema import FARES, LABEL_QUANTILES

RATES = {"driver": "driver_rate", "passenger": "passenger_rate"}
LEVELS = (2, 1, 0)


def driver_rate() -> Column:
    """(fare + surcharge + tip) / distance."""
    return (F.col("fare") + F.col("surcharge") + F.col("tip")) / F.col("distance")


def passenger_rate() -> Column:
    """(fare + surcharge + toll) / distance."""
    return (F.col("fare") + F.col("surcharge") + F.col("toll")) / F.col("distance")


def fare_per_mile(df: DataFrame, keep: list[str] = ("trip_id",)) -> DataFrame:
    return df.select(*keep, driver_rate().alias("driver_rate"), passenger_rate().alias("passenger_rate"))


def round_half_up(v: float, digits: int = 2) -> float:
    """Round on the shortest decimal text of v, ties away from zero."""
    q = Decimal(1).scaleb(-digits)
    return float(Decimal(repr(v)).quantize(q, rounding=ROUND_HALF_UP))


def fare_thresholds(df: DataFrame, qs=LABEL_QUANTILES, digits: int = 2, **how) -> dict[str, dict[float, float]]:
    """``{'driver': {0.75: t, 0.5: t, 0.25: t}, 'passenger': {...}}``, exact
    discrete quantiles of each rate, rounded to ``digits`` as the labels use.
    ``how`` goes to :func:`exact_quantiles`."""
    rates = fare_per_mile(df)
    vals = exact_quantiles(rates, list(RATES.values()), list(qs), **how)
    return {name: {q: round_half_up(vals[(col, q)], digits) for q in qs} for name, col in RATES.items()}


def thresholds_frame(df: DataFrame, thresholds: dict) -> DataFrame:
    spark = df.sparkSession
    rows = [(name, thresholds[name][0.75], thresholds[name][0.5], thresholds[name][0.25]) for name in RATES]
    return spark.createDataFrame(rows, "rate string, q75 double, q50 double, q25 double")


def _level(rate: Column, t: dict, prefix: str) -> Column:
    return (F.when(rate >= F.lit(t[0.75]), F.lit(prefix + "2"))
            .when(rate >= F.lit(t[0.25]), F.lit(prefix + "1"))
            .otherwise(F.lit(prefix + "0")))


def label_columns(thresholds: dict) -> list[Column]:
    """``d_label`` / ``p_label``: 2 at or above q75, 1 at or above q25, else 0."""
    return [_level(driver_rate(), thresholds["driver"], "D").alias("d_label"),
            _level(passenger_rate(), thresholds["passenger"], "P").alias("p_label")]


def trip_labels(df: DataFrame, thresholds: dict, keep: list[str] = ("trip_id",)) -> DataFrame:
    return df.select(*keep, *label_columns(thresholds))


def onehot_columns(d: str = "d_label", p: str = "p_label") -> list[Column]:
    """One-hot code per label in the order [level 2, level 1, level 0]."""
    out = []
    for col, pre in ((d, "d"), (p, "p")):
        for lv in LEVELS:
            out.append((F.substring(F.col(col), 2, 1) == F.lit(str(lv))).cast("int").alias(f"{pre}{lv}"))
    return out


def label_onehot(labelled: DataFrame, keep: list[str] = ("trip_id",)) -> DataFrame:
    return labelled.select(*keep, *onehot_columns())


def attach_labels(df: DataFrame, labels: DataFrame, key: str = "trip_id") -> DataFrame:
    """General join form of the label lookup: left join on the trip key
    (a missing label stays NULL, as a dictionary ``get`` does)."""
    return df.join(labels, key, "left")


def segment_summary(df: DataFrame, key: str) -> DataFrame:
    """Per group: n, label rates (d2 d1 d0 p2 p1 p0) and mean fare columns.

    ``df`` needs ``key``, ``d_label``, ``p_label`` and the fare columns.
    """
    hot = df.select(key, *onehot_columns(), *FARES)
    aggs = [F.count(F.lit(1)).alias("n")]
    aggs += [F.avg(f"{pre}{lv}").alias(f"{pre}{lv}") for pre in ("d", "p") for lv in LEVELS]
    aggs += [F.avg(c).alias(c) for c in FARES]
    return hot.groupBy(key).agg(*aggs)
