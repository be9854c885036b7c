"""Structured Streaming over trip time: repeated trips dropped, segments counted per time window.

Both steps hold state only for what lies within the watermark: a trip key is
remembered until the watermark passes its pickup, a window's counts until the
watermark passes its end. Rows later than the watermark are dropped and show in
the progress as ``numRowsDroppedByWatermark``.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareseg.operators import segments as G
from fareseg.operators.clean import clean_trips, trip_features
from fareseg.operators.stats import FeatureStats
from fareseg.plans.models import clustered

#: What makes two trips the same one (the source has no trip number of its own).
TRIP_KEY = ("medallion", "hack_license", "pickup_datetime")


def timed_trips(raw: DataFrame, late: str = "2 hours", require: str = "any") -> DataFrame:
    """Cleaned trips with ``pickup`` (event time, watermarked by ``late``) and their key columns."""
    clean = clean_trips(raw, require).withColumn("pickup", F.col("ts").cast("timestamp"))
    return clean.withWatermark("pickup", late)


def without_repeats(trips: DataFrame, key: tuple[str, ...] = TRIP_KEY) -> DataFrame:
    """The first of the trips with one key, as long as they come within the watermark's delay of each other."""
    if trips.isStreaming:
        return trips.dropDuplicatesWithinWatermark(list(key))
    return trips.dropDuplicates(list(key))


def scored(trips: DataFrame, thresholds: dict, stats: FeatureStats, centroids: np.ndarray) -> DataFrame:
    """Trip features, fare labels and cluster, with the event time kept."""
    rows = trip_features(trips, ("trip_id", "pickup"))
    return clustered(rows.select("*", *G.label_columns(thresholds)), stats, centroids)


def windowed_counts(rows: DataFrame, size: str = "1 hour", slide: str | None = None) -> DataFrame:
    """``(start, cluster, d_label, p_label, n, fare)`` per event-time window; append mode emits a window once, when it has closed."""
    w = F.window("pickup", size, slide) if slide else F.window("pickup", size)
    counts = rows.groupBy(w.alias("w"), "cluster", "d_label", "p_label").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("fare").cast("decimal(18,2)")).alias("fare"))
    return counts.select(F.col("w.start").alias("start"), "cluster", "d_label", "p_label", "n", "fare")
