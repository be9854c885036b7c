"""Reproducible exact-size sampling, centroid seeds and a dense row index.

A row's sample rank is ``md5('<seed>:<key>')`` (then the key), so the sample
does not depend on partitioning or on how often a task is retried, and the
same order can be written in SQL.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Hex digits of the hash that one counting pass tells apart (at most 16^4 counts to the driver).
DIGITS = 4
#: The pass that reads hashes and keys themselves, to cut inside a bucket, has at most this many.
LAST_ROWS = 1000


def sample_hash(seed: int, key: str = "trip_id") -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")))


def sample_bound(df: DataFrame, n: int, seed: int, key: str = "trip_id") -> tuple[str, object, int, int] | None:
    """``(hash, key, copies, of)`` of the n-th smallest row by ``(md5(seed:key), key)``; None when ``df`` has no more than n rows.

    ``copies``: how many ``of`` the rows with exactly this key belong to the n smallest.
    Every pass counts rows by the next hash digits of one bucket, the one in
    which the n-th row lies, until few enough rows are left to read.
    """
    hashed = df.select(sample_hash(seed, key).alias("_h"), F.col(key).alias("_key"))
    head, before, width = "", 0, len("d41d8cd98f00b204e9800998ecf8427e")
    while True:
        rows = hashed.where(F.col("_h").startswith(head)) if head else hashed
        digits = min(DIGITS, width - len(head))
        counts = sorted((r["d"], r["n"]) for r in rows.groupBy(F.substring("_h", len(head) + 1, digits).alias("d"))
                        .agg(F.count(F.lit(1)).alias("n")).collect())
        if not head and sum(c for _, c in counts) <= n:
            return None
        for d, c in counts:
            if before + c >= n:
                head += d
                break
            before += c
        if c <= LAST_ROWS or len(head) == width:
            break
    last = hashed.where(F.col("_h").startswith(head)).groupBy("_h", "_key").agg(F.count(F.lit(1)).alias("n")).collect()
    for r in sorted(last, key=lambda r: (r["_h"], r["_key"] is not None, r["_key"])):
        if before + r["n"] >= n:
            return r["_h"], r["_key"], n - before, r["n"]
        before += r["n"]


def sample_exact(df: DataFrame, n: int, seed: int, key: str = "trip_id") -> DataFrame:
    """Exactly ``min(n, count)`` rows without replacement: the n smallest by
    ``(md5(seed:key), key)``.

    The bound of the sample is found first (see :func:`sample_bound`: two
    counting passes up to about 65 million rows, one more for every 65,536
    times as many); the sample itself is a filter, without a sort, a shuffle
    or a merge, so its size is no one task's load. Rows with a null key have
    no hash and are never drawn. Only if a key occurs more than once and its
    copies straddle the bound is a limit taken, over the copies of that key.
    """
    if n <= 0:
        return df.limit(0)
    df = df.where(F.col(key).isNotNull())
    bound = sample_bound(df, n, seed, key)
    if bound is None:
        return df
    h, k, copies, of = bound
    below = (sample_hash(seed, key) < F.lit(h)) | ((sample_hash(seed, key) == F.lit(h)) & (F.col(key) < F.lit(k)))
    own = F.col(key) == F.lit(k)
    if copies == of:
        return df.where(below | own)
    return df.where(below).unionByName(df.where(own).limit(copies))


def seed_rows(df: DataFrame, k: int, seed: int, cols: list[str], key: str = "trip_id") -> np.ndarray:
    """First k rows in sample order as a (k, len(cols)) array: k-means seeds.

    Seeds are nested (the k=3 seeds start with the k=2 seeds), so a sweep over
    k reads them once.
    """
    h = sample_hash(seed, key)
    rows = df.select(h.alias("_h"), F.col(key), *cols).orderBy("_h", key).limit(k).collect()
    if len(rows) < k:
        raise ValueError(f"need {k} rows to seed k-means, have {len(rows)}")
    return np.array([[float(r[c]) for c in cols] for r in rows], dtype=float)


def with_index(df: DataFrame, key: str = "trip_id", rows_per_bucket: int = 1_000_000,
               broadcast_rows: int = 1_000_000) -> DataFrame:
    """Add ``idx``: dense 0-based position in ``key`` order (``key`` unique).

    Distributed: approximate quantiles of the key cut it into buckets of about
    ``rows_per_bucket`` rows, a per-bucket count gives each bucket's offset
    (one row per bucket to the driver), and ``row_number`` runs per bucket.
    """
    from pyspark.ml.feature import Bucketizer

    n = df.count()
    buckets = max(1, math.ceil(n / rows_per_bucket))
    keyed = df.withColumn("_k", F.col(key).cast("double"))
    if buckets == 1:
        keyed = keyed.withColumn("_bucket", F.lit(0.0))
    else:
        probs = [i / buckets for i in range(1, buckets)]
        cuts = sorted(set(keyed.approxQuantile("_k", probs, 1.0 / (4 * buckets))))
        splits = [-math.inf] + cuts + [math.inf]
        keyed = Bucketizer(splits=splits, inputCol="_k", outputCol="_bucket").transform(keyed)
    counts = sorted((r["_bucket"], r["count"]) for r in keyed.groupBy("_bucket").count().collect())
    offsets, acc = [], 0
    for b, c in counts:
        offsets.append((float(b), acc))
        acc += c
    spark = df.sparkSession
    off = spark.createDataFrame(offsets, "_bucket double, _offset long")
    if len(offsets) <= broadcast_rows:
        off = F.broadcast(off)
    w = Window.partitionBy("_bucket").orderBy(F.col(key))
    out = keyed.join(off, "_bucket").withColumn(
        "idx", (F.col("_offset") + F.row_number().over(w) - 1).cast("long"))
    return out.drop("_k", "_bucket", "_offset")
