"""Sharding by a two-pass external shuffle, DataFrame operations only.

Pass one scatters whole rows into buckets of about ``bucket_bytes`` by a seeded
hash of key and text. Pass two Fisher-Yates-shuffles every bucket (``shuffle``
over the bucket's array, its rows sorted first so that a re-run task gives the
same order) and writes it. Positions run through the buckets in order; row p
goes to shard ``p % shards`` at slot ``p // shards``, so shard counts are at
most one apart (law ``rows``) and every shard is a uniform sample.

The number of buckets follows the input's bytes, and a task holds one bucket
however large the table is. Only rows equal in key and text share a bucket by
force. Null keys and texts hash like any value; a null text has no bytes. An
empty table gives an empty result. Columns named ``shard`` or ``slot`` are
replaced; other extra columns are carried along.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fareseg.llm.common import written

BUCKET_BYTES = 16 << 20
_GROUP = 1024


def _offsets(counts: DataFrame) -> DataFrame:
    """``_b, _before``: rows in earlier buckets, summed in groups so that no window spans all buckets."""
    counts = counts.withColumn("_g", F.floor(F.col("_b") / _GROUP))
    inner = Window.partitionBy("_g").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    outer = Window.orderBy("_g").rowsBetween(Window.unboundedPreceding, -1)
    groups = counts.groupBy("_g").agg(F.sum("_n").alias("_n")).select("_g", F.sum("_n").over(outer).alias("_start"))
    return (counts.select("_b", "_g", F.sum("_n").over(inner).alias("_in")).join(groups, "_g")
            .select("_b", (F.coalesce("_in", F.lit(0)) + F.coalesce("_start", F.lit(0))).alias("_before")))


def shuffle_shards(docs: DataFrame, shards: int = 16, seed: int = 17, key: str = "doc_id", text: str = "text",
                   bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """The rows of ``docs`` in shuffled order with ``shard int`` and ``slot long``."""
    total = docs.agg(F.sum(F.coalesce(F.octet_length(text), F.lit(0)) + 64).alias("n")).first()["n"] or 0
    buckets = max(1, math.ceil(total / bucket_bytes))
    row = F.struct(*[F.col(c) for c in docs.columns])
    scattered = (docs.select(F.xxhash64(F.lit(seed), F.col(key), F.col(text)).alias("_h"), row.alias("_row"))
                 .select(F.pmod("_h", F.lit(buckets)).cast("int").alias("_b"), "_h", "_row")
                 .repartitionById(buckets, F.col("_b")).sortWithinPartitions("_b", "_h"))
    order = F.shuffle(F.collect_list("_row"), seed)
    permuted = written(scattered.groupBy("_b").agg(order.alias("_rows")).select("_b", F.posexplode("_rows").alias("_i", "_row")),
                       "buckets")
    # written first: its size is then known when the join is planned, so the rows aren't dealt out again for it
    before = written(_offsets(permuted.groupBy("_b").agg(F.count("*").alias("_n"))), "offsets")
    at = permuted.join(before, "_b")
    p = F.col("_before") + F.col("_i")
    return at.select(*[F.col(f"_row.{c}").alias(c) for c in docs.columns if c not in ("shard", "slot")],
                     (p % shards).cast("int").alias("shard"), F.floor(p / shards).cast("long").alias("slot"))


def shard_digests(docs: DataFrame, shards: int = 16) -> DataFrame:
    """One row per document with size, checksum, law, shard and slot."""
    out = shuffle_shards(docs.select("doc_id", "text"), shards)
    return out.select(
        "doc_id", (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"), F.lit("rows").alias("law"),
        "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
