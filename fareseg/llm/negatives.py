"""Hard-negative mining by a vertical scan (branch-and-bound on decomposed vectors).

Rows are dealt by vector length and label into lanes of at most about ``LANE``
rows; a task holds one lane as blocks of columns (one array a dimension, with
the block's least and largest value) and its anchors stream past. For an anchor
the dimensions are read in descending magnitude of its own coordinates. After
each few dimensions, what the unread ones can still add lies between sums of
their least and largest products; rows whose interval can't reach the anchor's
best positives, or no open window of scores, leave the block's bitmap. Rows that
stay to the last dimension have their exact integer score.

Two passes: the first finds each anchor's positives (its best rows of the same
label; it only visits lanes that hold the label), the second the best rows of
other labels inside every positive's window. Anchors travel to lanes, never rows
to anchors, and each lane answers with at most ``k`` rows an anchor and window.

Vectors are turned into floor(scale * x). Rows with a null label, a null vector
or a null or non-finite component take no part; vectors of different length
aren't compared. Zero vectors take part. Coordinates and scores beyond a 64-bit
integer saturate at its limits. Repeated rows are rows of their own: each is an
anchor or a candidate, only an anchor's own row is left out. Null ids are never
anchors and rank last among equal scores. Extra columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fareseg.llm.common import written

#: Rows a task holds at most (about; lanes are ranges), and fewest that make a lane of their own.
LANE = 65_536
LEAST_LANE = 4096
#: Rows of a block of columns, and dimensions read between two looks at the bitmap.
BLOCK = 8192
STEP = 8
_LAST = np.iinfo(np.int64).max
_NO_WINDOWS = lambda: F.lit(None).cast("array<struct<least:long,most:long>>")
_FOUND = "anchor long, goal int, rid long, vec_id long, score long"


def integer_rows(emb: DataFrame, scale: int = 256) -> DataFrame:
    """``rid, vec_id, label, dim, v`` of the rows that take part; ``v``: the coordinates as longs."""
    x = F.col("embedding")
    fit = F.coalesce(F.forall(x, lambda a: a.isNotNull() & ~F.isnan(a) & (F.abs(a) < float("inf"))), F.lit(False))
    rows = (emb.select(F.monotonically_increasing_id().alias("rid"), F.col("vec_id").cast("long").alias("vec_id"),
                       F.col("label").cast("long").alias("label"), "embedding")
            .where(fit & F.col("label").isNotNull()))
    v = F.transform(x, lambda a: F.floor(a.cast("double") * scale).cast("long"))
    return rows.select("rid", "vec_id", "label", F.size(x).alias("dim"), v.alias("v"))


class Block:
    """Up to ``BLOCK`` rows of one vector length as columns."""

    def __init__(self, rid: np.ndarray, vec_id: np.ndarray, named: np.ndarray, label: np.ndarray, v: np.ndarray) -> None:
        self.rid, self.vec_id, self.named, self.label = rid, vec_id, named, label
        self.least, self.most = v.min(axis=0), v.max(axis=0)
        #: largest magnitude, as a float: decides whether products are exact in doubles
        self.reach = max(abs(float(self.least.min(initial=0))), abs(float(self.most.max(initial=0))))
        self.exact = v
        self.columns = np.ascontiguousarray(v.T.astype(float))

    def scores(self, q: np.ndarray, start: np.ndarray, still) -> tuple[np.ndarray, np.ndarray]:
        """``(at, score)`` of the rows of ``start`` that ``still(lower, upper)`` never gives up."""
        d = len(q)
        if self.reach * float(np.abs(q.astype(float)).max(initial=0)) * max(d, 1) >= 2.0 ** 52:
            s = self.exact[start].astype(object) @ q.astype(object) if d else np.zeros(len(start), object)
            return start, np.array([min(max(int(x), -_LAST - 1), _LAST) for x in s], np.int64)
        f = q.astype(float)
        order = np.argsort(-np.abs(f), kind="stable")
        ends = np.sort([f * self.least, f * self.most], axis=0)[:, order]
        rest = np.zeros((2, d + 1))
        rest[:, :-1] = ends[:, ::-1].cumsum(axis=1)[:, ::-1]
        at, s = start, np.zeros(len(start))
        for lo in range(0, d, STEP):
            stay = still(s + rest[0, lo], s + rest[1, lo])
            if not stay.all():
                at, s = at[stay], s[stay]
            if not len(at):
                break
            dims = order[lo:lo + STEP]
            part = self.columns[dims] if len(at) == self.columns.shape[1] else self.columns[np.ix_(dims, at)]
            s = s + f[dims] @ part
        stay = still(s, s)
        return at[stay], s[stay].astype(np.int64)


class Best:
    """The k best (score, then smaller id, unnamed last) rows met so far."""

    def __init__(self, k: int) -> None:
        self.k, self.rows = k, []

    @property
    def bound(self) -> float:
        return self.rows[-1][0] * -1.0 if len(self.rows) == self.k else -math.inf

    def add(self, block: Block, at: np.ndarray, s: np.ndarray) -> None:
        if len(s) > self.k:
            top = s >= np.partition(s, len(s) - self.k)[len(s) - self.k]
            at, s = at[top], s[top]
            first = np.lexsort((block.rid[at], block.vec_id[at], ~block.named[at], ~s))[:self.k] if len(s) > self.k else slice(None)
            at, s = at[first], s[first]
        new = [(-int(x), not block.named[p], int(block.vec_id[p]), int(block.rid[p])) for x, p in zip(s, at)]
        self.rows = sorted(self.rows + new)[:self.k]


def _kth(values: np.ndarray, k: int) -> float:
    return np.partition(values, len(values) - k)[len(values) - k] if len(values) >= k else -math.inf


def positives_of(blocks: list[Block], anchor: dict, k: int) -> list[tuple]:
    """An anchor's k best other rows of its label among these blocks."""
    q, best = anchor["v"], Best(k)
    for b in blocks:
        start = np.flatnonzero((b.label == anchor["label"]) & (b.rid != anchor["rid"]))
        if len(start):
            best.add(b, *b.scores(q, start, lambda low, up: up >= max(best.bound, _kth(low, k))))
    return [(anchor["rid"], 0, rid, None if none else vid, -s) for s, none, vid, rid in best.rows]


def negatives_of(blocks: list[Block], anchor: dict, k: int) -> list[tuple]:
    """The k best rows of other labels inside each window of an anchor among these blocks."""
    q, windows = anchor["v"], anchor["windows"]
    found = [Best(k) for _ in windows]

    def still(low, up):
        stay = np.zeros(len(low), bool)
        for (least, most), best in zip(windows, found):
            inside = low[(low >= least) & (up <= most)]
            stay |= (low <= most) & (up >= max(least, best.bound, _kth(inside, k)))
        return stay

    for b in blocks:
        start = np.flatnonzero(b.label != anchor["label"])
        if len(start):
            at, s = b.scores(q, start, still)
            for (least, most), best in zip(windows, found):
                fit = (s >= least) & (s <= most)
                if fit.any():
                    best.add(b, at[fit], s[fit])
    return [(anchor["rid"], g, rid, None if none else vid, -s) for g, best in enumerate(found) for s, none, vid, rid in best.rows]


def _blocks(held: list[pa.RecordBatch]) -> dict[int, list[Block]]:
    """A lane's rows as blocks by vector length, rows in (length, label, rid) order."""
    t = pa.Table.from_batches(held)
    dim, out = t["dim"].to_numpy(), {}
    for d in np.unique(dim):
        part = t.take(np.flatnonzero(dim == d))
        v = part["v"].combine_chunks().flatten().to_numpy().reshape(part.num_rows, d)
        ids = part["vec_id"].combine_chunks()
        columns = part["rid"].to_numpy(), ids.fill_null(0).to_numpy(), ids.is_valid().to_numpy(zero_copy_only=False), part["label"].to_numpy()
        out[int(d)] = [Block(*(c[lo:lo + BLOCK] for c in columns), v[lo:lo + BLOCK]) for lo in range(0, part.num_rows, BLOCK)]
    return out


def _visit(rows: DataFrame, anchors: DataFrame, lanes: int, find, k: int) -> DataFrame:
    """``find`` for every anchor in every lane it names; ``anchors`` has ``lane, rid, label, dim, v, windows``."""
    met = rows.select("lane", F.lit(False).alias("asks"), "rid", "vec_id", "label", "dim", "v", _NO_WINDOWS().alias("windows")).unionByName(
        anchors.select("lane", F.lit(True).alias("asks"), "rid", F.lit(None).cast("long").alias("vec_id"), "label", "dim", "v", "windows"))
    met = met.repartitionById(lanes, F.col("lane")).sortWithinPartitions("asks", "dim", "label", "rid")

    def run(batches):
        held: list[pa.RecordBatch] = []
        blocks: dict[int, list[Block]] | None = None
        for b in batches:
            asks = b.column("asks").to_numpy(zero_copy_only=False)
            cut = int(np.searchsorted(asks, True))
            if cut:
                held.append(b.slice(0, cut))
            if cut == b.num_rows or not held:
                continue
            blocks = _blocks(held) if blocks is None else blocks
            out = []
            for r in b.slice(cut).select(["rid", "label", "dim", "v", "windows"]).to_pylist():
                r["v"] = np.array(r["v"], np.int64)
                r["windows"] = [(w["least"], w["most"]) for w in r["windows"] or []]
                out += find(blocks.get(r["dim"], []), r, k)
            if out:
                kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], ["anchor", "goal", "rid", "vec_id", "score"])

    best = Window.partitionBy("anchor", "goal").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "rid")
    return met.mapInArrow(run, _FOUND).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


def _sent(asked: DataFrame, rows: DataFrame, keys: list[str], lanes: int) -> DataFrame:
    """Each anchor once for every lane that may hold rows with its ``keys``.

    Lanes are ranges of (dim, label), so those of a key follow each other. The
    join is salted: a label or length held by most anchors is spread over tasks.
    """
    salts = F.sequence(F.lit(0).cast("long"), F.lit(lanes - 1).cast("long"))
    spans = rows.groupBy(*keys).agg(F.min("lane").alias("from"), F.max("lane").alias("to")).withColumn("salt", F.explode(salts))
    return (asked.withColumn("salt", F.pmod(F.xxhash64("rid"), F.lit(lanes))).join(spans, [*keys, "salt"])
            .withColumn("lane", F.explode(F.sequence("from", "to"))).drop("salt", "from", "to"))


def hard_negatives(emb: DataFrame, every: int = 100, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90,
                   scale: int = 256) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    Anchors are rows whose vec_id is divisible by ``every``. A negative's score
    lies between ``low`` and ``high`` percent of its positive's.
    """
    spark = emb.sparkSession
    n = emb.count()  # from the file footers; rows that take no part only make lanes a little shorter
    lanes = max(1, math.ceil(n / LANE), min(spark.sparkContext.defaultParallelism, math.ceil(n / LEAST_LANE)))
    rows = written(integer_rows(emb, scale).repartitionByRange(lanes, "dim", "label", F.xxhash64("rid"))
                   .withColumn("lane", F.spark_partition_id()), "lanes")
    asked = rows.where(F.pmod("vec_id", F.lit(every)) == 0).drop("lane")
    own = _sent(asked, rows, ["dim", "label"], lanes).withColumn("windows", _NO_WINDOWS())
    first = written(_visit(rows, own, lanes, positives_of, positives), "positives")
    least, most = -F.floor(-low * F.col("score").cast("decimal(38,0)") / 100), F.floor(high * F.col("score").cast("decimal(38,0)") / 100)
    goals = (first.select("anchor", "score").distinct()
             .select("anchor", "score", least.cast("long").alias("least"), most.cast("long").alias("most")).where("least <= most")
             .withColumn("goal", F.row_number().over(Window.partitionBy("anchor").orderBy("score")) - 1))
    windows = goals.groupBy("anchor").agg(F.transform(F.array_sort(F.collect_list(F.struct("goal", "least", "most"))),
                                                      lambda w: F.struct(w["least"].alias("least"), w["most"].alias("most"))).alias("windows"))
    open_ = _sent(asked.join(windows.withColumnRenamed("anchor", "rid"), "rid"), rows, ["dim"], lanes)
    second = _visit(rows, open_, lanes, negatives_of, negatives)
    found = (goals.select("anchor", "goal", F.col("score").alias("positive_score"))
             .join(second.select("anchor", "goal", "rank", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score")),
                   ["anchor", "goal"]))
    of = first.select("anchor", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    names = asked.select(F.col("rid").alias("anchor"), F.col("vec_id").alias("anchor_id"))
    return (of.join(found, ["anchor", "positive_score"]).join(names, "anchor")
            .select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score"))
