"""Structured Streaming: score new trip lines against a fitted segmentation.

Cleaning, fare labels (fixed thresholds) and nearest-centroid assignment are
stateless column expressions, so the batch operators run unchanged on a
``readStream`` source. ``segment_counts`` adds the one stateful piece: a
running count per (cluster, driver label, passenger label) — a bounded state
of k x 9 keys.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareseg.operators import segments as G
from fareseg.operators.clean import trips_from_raw
from fareseg.operators.stats import FeatureStats
from fareseg.plans.models import clustered

RAW_SCHEMA = "trip_id bigint, line string"


def read_raw_stream(spark, path: str, fmt: str = "parquet", max_files_per_trigger: int | None = None) -> DataFrame:
    """Stream of ``(trip_id, line)`` from files landing in ``path``."""
    r = spark.readStream.schema(RAW_SCHEMA).format(fmt)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.load(path)


def score_trips(raw: DataFrame, thresholds: dict, stats: FeatureStats, centroids: np.ndarray,
                require: str = "any") -> DataFrame:
    """Works on batch and streaming frames alike: trip features, labels, cluster."""
    trips = trips_from_raw(raw, require)
    labelled = trips.select("*", *G.label_columns(thresholds))
    return clustered(labelled, stats, centroids)


def segment_counts(scored: DataFrame) -> DataFrame:
    """Running counts per (cluster, d_label, p_label); use output mode complete/update."""
    return scored.groupBy("cluster", "d_label", "p_label").agg(F.count(F.lit(1)).alias("n"))
