"""Joins on the trip key, with and without an exchange.

:func:`join_on_key` leaves the strategy to Spark. Tables that are joined again
and again on the same key are better stored once in buckets of it:
:func:`store_bucketed` writes a table hashed and sorted by its key, and the join of
two such tables with the same number of buckets reads bucket against bucket,
without a shuffle or a sort.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def join_on_key(left: DataFrame, right: DataFrame, key: str = "trip_id", how: str = "inner") -> DataFrame:
    return left.join(right, key, how)


def store_bucketed(df: DataFrame, name: str, path: str, buckets: int, key: str = "trip_id") -> DataFrame:
    """``df`` stored as table ``name`` at ``path``, one sorted file per bucket of ``key``; the table.

    Rows are dealt to the buckets before the write, so each bucket is one file
    and needs no sort when it is read.
    """
    (df.repartition(buckets, key).write.mode("overwrite").option("path", path).bucketBy(buckets, key).sortBy(key)
     .format("parquet").saveAsTable(name))
    return df.sparkSession.table(name)


def join_bucketed(spark: SparkSession, left: str, right: str, key: str = "trip_id", how: str = "inner") -> DataFrame:
    """Two bucketed tables joined on their key as a merge of sorted buckets."""
    return spark.table(left).hint("merge").join(spark.table(right), key, how)
