"""One scan that sums a model-sized vector over all rows, to the same bits however the rows are dealt.

The iterative fits reduce their rows to sums whose length follows the model,
never the data. Each task adds up its Arrow batches and emits one such vector;
the tasks' vectors are then added. Adding doubles in another order gives other
last bits, and a stop test may turn on them. So every number is first cut into
pieces on fixed grids (:class:`Folds`): a sum of pieces of one grid needs no
rounding, whatever its order, and the few sums are put together at the end.
The grids follow from a bound on the numbers and from the row count, which
:func:`extent` reads in one aggregate (least and largest values don't depend on
the order either).
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareseg.functions.vector import q

#: Up to this many tasks their vectors come to the driver as they are; more are added by a shuffle first.
DIRECT_TASKS = 64
#: Bytes of a block of rows: enough that what a scan does per block costs little beside what it does per row.
BLOCK_BYTES = 2 << 20
#: Bits kept of a number, below its bound.
KEPT_BITS = 58


@dataclass(frozen=True)
class Extent:
    """Row count and each column's largest magnitude."""
    rows: int
    reach: np.ndarray


def extent(data: DataFrame, cols) -> Extent:
    """One aggregate; a null, NaN or infinite value in any column is an error that says how many rows hold one."""
    bad = " or ".join(f"{q(c)} is null or isnan({q(c)}) or abs({q(c)}) = double('Infinity')" for c in cols)
    r = data.selectExpr(*[f"cast({q(c)} as double) as {q(c)}" for c in cols]).agg(
        F.count(F.lit(1)).alias("_n"), F.count_if(F.expr(bad)).alias("_bad"),
        *[F.max(F.abs(F.col(q(c)))).alias(f"_m{i}") for i, c in enumerate(cols)]).first()
    if r["_bad"]:
        raise ValueError(f"{r['_bad']} of {r['_n']} rows have a null or non-finite value in {list(cols)}")
    return Extent(r["_n"], np.array([r[f"_m{i}"] or 0.0 for i in range(len(cols))]))


class Folds:
    """Cuts numbers into pieces whose sums over ``rows`` rows (each counted at most four times) are exact.

    The first piece is the number rounded to a multiple of the first grid, the
    next what is left rounded to a finer one, and so on. A piece has ``bits``
    bits, so that many of them added stay below the 53 bits of a double.
    """

    def __init__(self, rows: int) -> None:
        self.bits = 50 - max(rows, 1).bit_length()
        if self.bits < 4:
            raise ValueError(f"too many rows to sum: {rows}")
        self.count = math.ceil(KEPT_BITS / self.bits)

    def grids(self, bound: float) -> list[float]:
        """The grids for numbers of magnitude ``bound`` at most; ``bound`` must be finite."""
        e = min(max(math.frexp(bound)[1], -900), 1000)
        return [2.0 ** max(e - self.bits * (i + 1), -1000) for i in range(self.count)]

    def split(self, values: np.ndarray, bound: float) -> np.ndarray:
        """``(count, *values.shape)`` pieces; what is beyond the last grid is dropped, the same for equal numbers."""
        out, rest = np.empty((self.count, *np.shape(values))), values
        for piece, g in zip(out, self.grids(bound)):
            np.multiply(rest, 1.0 / g, out=piece)  # exact: grids are powers of two
            np.rint(piece, out=piece)
            piece *= g
            rest = rest - piece
        return out

    def sums(self, values: np.ndarray, bound: float) -> np.ndarray:
        """Each piece summed over the first axis of ``values``."""
        return self.split(values, bound).sum(axis=1)

    @staticmethod
    def joined(pieces: np.ndarray) -> np.ndarray:
        """The numbers that summed pieces stand for: finest first, always in this order."""
        total = pieces[-1].copy()
        for p in pieces[-2::-1]:
            total = total + p
        return total


def blocked(data: DataFrame, cols) -> DataFrame:
    """``data`` as blocks of about ``BLOCK_BYTES`` (whole Arrow batches): ``_n`` and the rows' values as one binary ``_x``.

    What a loop scans again and again is then handed to Python as a few byte
    strings, a column after the other, instead of a value at a time.
    """
    def block(parts):
        x = np.concatenate(parts)
        return pa.RecordBatch.from_arrays([pa.array([len(x)], pa.int32()), pa.array([x.tobytes("F")], pa.binary())], ["_n", "_x"])

    def run(batches):
        parts = []
        for b in batches:
            if b.num_rows:
                parts.append(_matrix(b))
                if sum(x.nbytes for x in parts) >= BLOCK_BYTES:
                    yield block(parts)
                    parts = []
        if parts:
            yield block(parts)

    return data.select(*cols).mapInArrow(run, "_n int, _x binary")


def _matrix(b: pa.RecordBatch) -> np.ndarray:
    """``(rows, columns)``, each column contiguous."""
    return np.array([c.to_numpy(zero_copy_only=False) for c in b.columns], dtype=float).T


def matrix(rows: int, data) -> np.ndarray:
    """The matrix of a block of ``rows`` rows."""
    return np.frombuffer(data, float).reshape(-1, rows).T


def held(blocks: DataFrame) -> RDD:
    """``blocks``, persisted as Python tuples ``(rows, values)``.

    Cached as DataFrame rows, every scan would turn each block's bytes into text and back (which is how Spark
    hands binary columns of a DataFrame to an RDD); cached as tuples, they are read as the bytes they are.
    """
    return blocks.rdd.map(lambda r: (r[0], bytes(r[1]))).persist(StorageLevel.MEMORY_AND_DISK)


def summed(data: DataFrame | RDD | list, cols, kernel: Callable[..., np.ndarray], size: int, count: int) -> np.ndarray:
    """The sum over all rows of ``kernel(rows x cols) -> (count, size)`` exact pieces; zeros for an empty table.

    ``data`` may be blocks (see :func:`blocked` and :func:`held`), or several tables of them, scanned by one job;
    ``cols`` then doesn't count and the kernel also gets the values that follow ``_x``. A loop calls this every round
    on the same held blocks: as an RDD they are planned only once.
    """
    def run(blocks):
        total = None
        for n, x, *more in blocks:
            part = kernel(matrix(n, x), *more)
            total = part if total is None else total + part
        if total is not None:
            yield total

    def run_batches(batches):
        total = None
        for b in batches:
            if b.num_rows:
                part = kernel(_matrix(b))
                total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["_s"])

    if isinstance(data, DataFrame) and data.columns[0] != "_n":
        rdd = data.select(*cols).mapInArrow(run_batches, "_s binary").rdd
        parts = rdd.map(lambda r: np.frombuffer(r[0], float).reshape(count, size))
    else:
        rdds = [t if isinstance(t, RDD) else t.rdd for t in (data if isinstance(data, list) else [data])]
        rdd = rdds[0] if len(rdds) == 1 else rdds[0].context.union(rdds)
        parts = rdd.mapPartitions(run)
    if rdd.getNumPartitions() > DIRECT_TASKS:
        return np.zeros((count, size)) + parts.treeAggregate(0.0, np.add, np.add)
    out = np.zeros((count, size))
    for part in parts.collect():
        out += part
    return out


def column_sums(data: DataFrame, exprs: dict[str, str], bounds: dict[str, float], rows: int) -> dict[str, float]:
    """Exact sums of SQL number expressions in one aggregate, without leaving the JVM. ``bounds``: each one's magnitude."""
    folds = Folds(rows)
    step = data.selectExpr(*[f"cast({e} as double) as `_r{i}_0`" for i, e in enumerate(exprs.values())])
    aggs = []
    for f in range(folds.count):
        keep, names = [], []
        for i, name in enumerate(exprs):
            g = folds.grids(bounds[name])[f]
            keep += [f"_p{i}_{h}" for h in range(f)] + [f"_r{i}_{f}", f"rint(_r{i}_{f} / {g!r}D) * {g!r}D as _p{i}_{f}"]
            names += [f"_p{i}_{h}" for h in range(f + 1)] + [f"_r{i}_{f} - _p{i}_{f} as _r{i}_{f + 1}"]
        step = step.selectExpr(*keep).selectExpr(*names)
    for i in range(len(exprs)):
        aggs += [F.sum(f"_p{i}_{f}").alias(f"s{i}_{f}") for f in range(folds.count)]
    r = step.agg(*aggs).first()
    return {name: float(Folds.joined(np.array([[r[f"s{i}_{f}"] or 0.0] for f in range(folds.count)]))[0])
            for i, name in enumerate(exprs)}
