"""Embedding near-dedup: random-hyperplane sign hashing, exact cosines, distributed components.

Each vector gets a ``bits``-bit sign code in each of ``tables`` tables. Vectors
of one label, length and code meet in a bucket and are compared by exact
double-precision cosine. The code length follows the largest label, so that
unrelated vectors spread as the data grow; the number of tables follows from it
so that a pair at the threshold meets with probability ``recall``. A bucket
beyond ``BLOCK`` vectors is dealt into blocks and all pairs of its blocks are
compared in tasks of their own, so nothing is capped. A pair counts in the
first table it meets in. Tasks return one row per linked vector (its number of
links and the smallest vector it hangs together with), not the pairs.

Equal vectors of one label are one class, compared once and counted as often as
it has rows, so any number of copies costs no more than one vector.

Vectors that are null, zero, or hold null or non-finite numbers, and those with
a null label, link with nothing. Repeated rows are vectors of their own and link
with each other; null ids take part but can't be a component's id.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareseg.llm.common import by_batch, written
from fareseg.llm.components import components

THRESHOLD = 0.93
RECALL = 0.99999
BLOCK = 1024


def plan(largest: int, threshold: float, recall: float) -> tuple[int, int]:
    """``(bits, tables)`` for the number of vectors of the largest label."""
    bits = min(30, max(4, math.ceil(math.log2(max(largest, 1) / 64))))
    meet = (1 - math.acos(threshold) / math.pi) ** bits
    return bits, math.ceil(math.log(1 - recall) / math.log(1 - meet))


def usable(vector: str = "embedding"):
    """True for vectors of finite numbers that aren't all zero."""
    x = F.col(vector)
    return F.coalesce(F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))) & F.exists(x, lambda v: v != 0),
                      F.lit(False))


def sign_codes(rows: DataFrame, bits: int, tables: int, seed: int) -> DataFrame:
    """Adds ``codes``, one int per table, to ``(rid, label, embedding)``."""
    def kernel(b):
        lists = b.column("embedding")
        size = np.asarray(lists.value_lengths())
        flat = lists.flatten().to_numpy().astype(float)
        cut = np.concatenate([[0], np.cumsum(size)])
        codes = np.zeros((b.num_rows, tables), np.int32)
        for d in np.unique(size):  # one set of planes per vector length
            at = np.flatnonzero(size == d)
            x = flat[cut[at][:, None] + np.arange(d)]
            planes = np.random.default_rng([seed, int(d)]).normal(size=(d, tables * bits))
            codes[at] = ((x @ planes) > 0).reshape(len(at), tables, bits) @ (1 << np.arange(bits))
        out = pa.ListArray.from_arrays(pa.array(np.arange(0, codes.size + 1, tables, dtype=np.int32)), pa.array(codes.ravel()))
        return pa.RecordBatch.from_arrays([*b.columns, out], [*b.schema.names, "codes"])

    return rows.mapInArrow(by_batch(kernel), rows.withColumn("codes", F.array(F.lit(0))).schema)


def _hang(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The smallest position each of n vertices hangs together with."""
    low = np.arange(n)
    while True:
        new = low.copy()
        np.minimum.at(new, i, low[j])
        np.minimum.at(new, j, low[i])
        new = new[new]
        if (new == low).all():
            return low
        low = new


def linked(rows: DataFrame, tables: int, threshold: float) -> DataFrame:
    """``(rid, n, low)`` per table and block pair: rows linked first met there and the smallest rid connected there.

    ``rows``: ``rid, copies, label, embedding, codes``, one per class of equal vectors.
    """
    met = rows.select("rid", "copies", "label", F.size("embedding").alias("dim"), "embedding", "codes", F.posexplode("codes").alias("t", "code"))
    bucket = ["label", "dim", "t", "code"]
    sizes = met.groupBy(*bucket).agg(F.count("*").alias("n")).where("n > 1").withColumn("nb", F.ceil(F.col("n") / BLOCK).cast("int"))
    dealt = met.join(sizes.drop("n"), bucket).withColumn("blk", F.pmod(F.xxhash64("rid"), "nb").cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("nb") - 1)))
    dealt = dealt.withColumns({"b1": F.least("blk", "other"), "b2": F.greatest("blk", "other")})

    def compare(g: pa.Table) -> pa.Table:
        n, t = g.num_rows, g["t"][0].as_py()
        g = g.combine_chunks()
        rid, blk = g["rid"].to_numpy(), g["blk"].to_numpy()
        x = g["embedding"].combine_chunks().flatten().to_numpy().astype(float).reshape(n, -1)
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        codes = g["codes"].combine_chunks().flatten().to_numpy().reshape(n, tables)
        b1, b2 = g["b1"][0].as_py(), g["b2"][0].as_py()
        left, right = np.flatnonzero(blk == b1), np.flatnonzero(blk == b2)
        i, j = np.nonzero(x[left] @ x[right].T >= threshold)
        i, j = left[i], right[j]
        if b1 == b2:
            i, j = i[i < j], j[i < j]
        new = ~(codes[i, :t] == codes[j, :t]).any(1) if t else np.ones(len(i), bool)
        copies = g["copies"].to_numpy().astype(float)
        count = np.bincount(i[new], weights=copies[j[new]], minlength=n) + np.bincount(j[new], weights=copies[i[new]], minlength=n)
        order = np.argsort(rid, kind="stable")  # positions in rid order, so the smallest position has the smallest rid
        place = np.empty(n, np.int64)
        place[order] = np.arange(n)
        low = rid[order][_hang(n, place[i], place[j])[place]]
        keep = (count > 0) | (low != rid)
        return pa.table({"rid": rid[keep], "n": count[keep].astype(np.int64), "low": low[keep]})

    return dealt.groupBy(*bucket, "b1", "b2").applyInArrow(compare, "rid long, n long, low long")


def near_duplicates(emb: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL, seed: int = 11) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every row."""
    base = written(emb.select(F.monotonically_increasing_id().alias("rid"), "vec_id", "label", "embedding"), "vectors")
    rows = base.where(F.col("label").isNotNull() & usable())
    # a map-side aggregate folds copies before they meet; a class goes by the smallest rid among its rows
    classes = written(rows.groupBy("label", "embedding").agg(F.min("rid").alias("rid"), F.count("*").alias("copies")), "classes")
    largest = classes.groupBy("label").count().agg(F.max("count")).first()[0] or 1
    bits, tables = plan(largest, threshold, recall)
    found = written(linked(sign_codes(classes.select("rid", "copies", "label", "embedding"), bits, tables, seed), tables, threshold), "found")
    roots = components(found.select(F.col("rid").alias("a"), F.col("low").alias("b")))
    counts = found.groupBy("rid").agg(F.sum("n").alias("n_links"))
    known = (classes.join(counts, "rid", "left").join(roots.withColumnRenamed("v", "rid"), "rid", "left")
             .select("label", "embedding", F.coalesce("root", "rid").alias("root"),
                     (F.coalesce("n_links", F.lit(0)) + F.col("copies") - 1).alias("n_links")))
    rows = rows.join(known, ["label", "embedding"]).select("rid", "root", "n_links")
    rows = base.select("rid", "vec_id").join(rows, "rid", "left").withColumn("root", F.coalesce("root", "rid"))
    smallest = rows.where("n_links > 0").groupBy("root").agg(F.min("vec_id").alias("_first"))
    return rows.join(smallest, "root", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("_first", "vec_id").alias("component_id"),
        F.coalesce(F.col("vec_id") == F.coalesce("_first", "vec_id"), F.lit(False)).alias("kept"))
