"""Shared pieces: table reads, written intermediate tables, Arrow batch slicing."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fareseg.session import ensure_checkpoint_dir

#: Text bytes a kernel turns into NumPy temporaries at once (one longer text is a slice of its own).
SLICE_BYTES = 1 << 18


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the folder. Texts are long, so Arrow batches of the default 10,000 rows are made smaller."""
    if spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == "10000":
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the cluster's shared folder and read back.

    Cuts the lineage: a lost executor costs a re-read, not a re-run. The folder
    goes when the session ends.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/llm-{uuid.uuid4().hex}/{name}"
    df.write.option("compression", "zstd").parquet(path)
    hpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    hpath.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(hpath.getParent())
    return spark.read.schema(df.schema).parquet(path)


def held_out(key: str = "doc_id"):
    """True where crc32 of the key's text is divisible by 5; null keys are never held out."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def slices(col: pa.Array, size: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``(lo, hi, bytes, offsets)`` for consecutive rows of a string column, nulls as empty.

    A slice holds about ``size`` bytes; a longer text comes alone and whole.
    """
    col = pa.concat_arrays(col.chunks) if isinstance(col, pa.ChunkedArray) else col
    if col.null_count:
        col = col.fill_null("")
    n = len(col)
    if not n:
        return
    wide = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    _, offs, data = col.buffers()
    offs = np.frombuffer(offs, np.int64 if wide else np.int32)[col.offset:col.offset + n + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    lo = 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offs, offs[lo] + size, "right")) - 1)
        hi = min(hi, n)
        yield lo, hi, data[offs[lo]:offs[hi]], offs[lo:hi + 1] - offs[lo]
        lo = hi


def by_batch(fn):
    """A mapInArrow kernel from ``fn(batch) -> batch or None``."""
    def run(batches):
        for b in batches:
            if b.num_rows:
                out = fn(b)
                if out is not None and out.num_rows:
                    yield out
    return run
