"""Connected components of a link table by alternating large and small stars.

Every round hangs each vertex's larger neighbours on its smallest one, then each
vertex and its smaller neighbours on the smallest of those. Neighbourhood
minima are partial aggregates and the joins probe a table that is unique in the
key, so a vertex with very many links is neither gathered nor a hot task. Each
round is written to the shared folder; only a count and a checksum come back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareseg.llm.common import written


def _mark(e: DataFrame) -> tuple:
    r = e.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
    return r["n"], r["h"]


def components(links: DataFrame) -> DataFrame:
    """``(v, root)`` for every vertex of ``links (a, b)`` that isn't its component's smallest; root is that smallest."""
    e = written(links.where("a is not null and b is not null and a <> b")
                .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    mark = _mark(e)
    while mark[0]:
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = written(both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct(), "large")
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        e = written(small.unionByName(low.select("a", F.col("m").alias("b"))).distinct(), "small")
        before, mark = mark, _mark(e)
        if mark == before:
            break
    return e.select(F.col("a").alias("v"), F.col("b").alias("root"))
