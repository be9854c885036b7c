"""Text sources: raw trip CSV lines and the bracketed training-row text."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fareseg.functions.numeric import to_number
from fareseg.schema import FARES, FEATURES
from fareseg.session import ensure_checkpoint_dir


#: Splits of which every task gets a copy (about 100 bytes each); beyond it they are joined by a shuffle.
MAX_SENT = 200_000


def _split_offsets(batches):
    """Adds ``at``: bytes of the lines before, in the same split. Rows come in file order within a split."""
    split, at = None, 0
    for b in batches:
        if not b.num_rows:
            continue
        size = pc.binary_length(b.column("line")).cast(pa.int64()).to_numpy(zero_copy_only=False) + 1
        start = b.column("start").to_numpy()
        names = b.column("file").dictionary_encode()
        name = names.indices.to_numpy()
        new = np.flatnonzero((name[1:] != name[:-1]) | (start[1:] != start[:-1])) + 1
        first = names.dictionary[int(name[0])].as_py(), int(start[0])
        end = np.cumsum(size)
        begin = end - size
        runs = np.concatenate([[0], new, [b.num_rows]])
        base = np.repeat(begin[runs[:-1]], np.diff(runs))
        out = begin - base
        if first == split:
            out[:runs[1]] += at
        split = names.dictionary[int(name[-1])].as_py(), int(start[-1])
        at = int(out[-1] + size[-1])
        yield pa.RecordBatch.from_arrays([*b.columns, pa.array(out)], [*b.schema.names, "at"])


def read_raw_trips(spark: SparkSession, path: str) -> DataFrame:
    """One row per raw CSV line: ``(trip_id, line, file, offset)``.

    Compression follows the file suffix (``.bz2`` and ``.gz`` handled by the
    Hadoop codecs; bz2 stays splittable). A line is known by its file and the
    offset of its first byte in the uncompressed text, however the file was
    split. ``trip_id`` counts these bytes through all files in name order
    (one more a file), so it is unique, ascending, and the same on every read
    of the same files; when files come and go, ``(file, offset)`` stays.

    A first pass adds up the lines' bytes per split, a row each; the running
    offset inside a split is then added in file order, without a shuffle.
    Lines end with a line feed; a carriage return before it is taken off.
    """
    text = spark.read.option("lineSep", "\n").text(path).select(
        F.col("value").alias("line"), F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"))
    # the splits of all files in order: each begins where the one before ends
    ensure_checkpoint_dir(spark)
    splits = text.groupBy("file", "start").agg(F.sum(F.octet_length("line").cast("long") + 1).alias("n")).checkpoint()
    by_file = splits.groupBy("file").agg(F.sum("n").alias("size"))
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    in_file = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    files = by_file.select("file", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("first"))
    begins = splits.select("file", "start", F.coalesce(F.sum("n").over(in_file), F.lit(0)).alias("begin")).join(files, "file")
    if splits.count() <= MAX_SENT:
        begins = F.broadcast(begins)
    rows = text.mapInArrow(_split_offsets, "line string, file string, start long, at long")
    offset = F.col("begin") + F.col("at")
    return rows.join(begins, ["file", "start"]).select(
        (F.col("first") + offset).alias("trip_id"), F.regexp_replace("line", "\\r$", "").alias("line"),
        "file", offset.alias("offset"))


def parse_training_text(lines: DataFrame, text_col: str = "line") -> DataFrame:
    """Parse ``(2, 13, -73.9, ...)`` rows: drop the first and last character,
    split on ``', '`` and convert all twelve values to numbers.

    Weekday and hour are kept as INT, the rest DOUBLE; a row whose values do
    not parse comes back with NULLs instead of failing the job.
    """
    parts = F.split(F.expr(f"substr({text_col}, 2, length({text_col}) - 2)"), ", ", -1)
    cols = FEATURES + FARES
    parsed = lines.select(*[c for c in lines.columns if c != text_col], parts.alias("_p"))
    out = []
    for i, c in enumerate(cols):
        v = to_number(F.get(F.col("_p"), i))
        out.append((v.cast("int") if c in ("weekday", "hour") else v).alias(c))
    keep = [c for c in parsed.columns if c != "_p"]
    return parsed.select(*keep, *out)


def read_training_text(spark: SparkSession, path: str) -> DataFrame:
    """Read training rows written as bracketed text, one per line."""
    return parse_training_text(spark.read.text(path), "value")


def format_training_text(trips: DataFrame, digits: int = 6) -> DataFrame:
    """Write-side twin of :func:`parse_training_text` (numbers at fixed scale;
    one too large for it is written as the double's own text)."""
    vals = [F.col(c).cast("string") if c in ("weekday", "hour")
            else F.coalesce(F.col(c).try_cast(f"decimal(18,{digits})").cast("string"), F.col(c).cast("string"))
            for c in FEATURES + FARES]
    return trips.select("trip_id", F.concat(F.lit("("), F.concat_ws(", ", *vals), F.lit(")")).alias("line"))
