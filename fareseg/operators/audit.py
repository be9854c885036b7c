"""Cleaning with its audit in one pass over the raw lines.

Every line is parsed once and charged to the first rule it fails (or ``kept``).
The counts per rule are observed metrics of the very job that writes the rows,
so they need no second scan; Spark takes a task's metrics once, when the task
has succeeded, so retries and speculative copies don't count twice.

Kept trips and rejected lines go to one folder, partitioned by ``rule``:
:func:`read_kept` reads the trips, :func:`read_quarantine` the rejected lines as
they came, each from its own partitions only.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from fareseg.operators.clean import RULES, first_failed_rule, parse_fields, trip_features

KEPT = "kept"
METRICS = "clean_audit"
_OUTCOMES = [*RULES, KEPT]


def judged(raw: DataFrame, require: str = "any", bounds: dict | None = None) -> DataFrame:
    """Typed columns, the raw ``line`` and ``rule``, the first one failed or ``kept``."""
    return parse_fields(raw, ("trip_id", "line")).withColumn("rule", first_failed_rule(require, bounds))


def _rows(rows: DataFrame) -> DataFrame:
    """One schema for both kinds: a kept trip without its line, a rejected line without typed values."""
    kept = F.col("rule") == KEPT
    typed = [F.when(kept, F.col(c)).alias(c) for c in rows.columns if c not in ("trip_id", "line", "rule", "n_fields")]
    return rows.select("trip_id", *typed, F.when(~kept, F.col("line")).alias("line"), "rule")


def _counts() -> list:
    return [F.count_if(F.col("rule") == r).alias(r) for r in _OUTCOMES]


def clean_to(raw: DataFrame, path: str, require: str = "any", bounds: dict | None = None, mode: str = "overwrite") -> dict[str, int]:
    """Writes kept trips and rejected lines to ``path`` in one job; the rows per outcome."""
    seen = Observation(METRICS)
    _rows(judged(raw, require, bounds).observe(seen, *_counts())).write.mode(mode).partitionBy("rule").parquet(path)
    return {r: int(n) for r, n in seen.get.items()}


def read_kept(spark: SparkSession, path: str) -> DataFrame:
    """The typed kept trips."""
    return spark.read.parquet(path).where(F.col("rule") == KEPT).drop("line", "rule")


def read_trips(spark: SparkSession, path: str) -> DataFrame:
    """Training rows of the kept trips."""
    return trip_features(read_kept(spark, path))


def read_quarantine(spark: SparkSession, path: str) -> DataFrame:
    """``(trip_id, line, rule)`` of the rejected lines."""
    return spark.read.parquet(path).where(F.col("rule") != KEPT).select("trip_id", "line", "rule")


def counts_frame(spark: SparkSession, counts: dict[str, int]) -> DataFrame:
    """``(rule, n)`` of the outcomes that occurred, as ``reject_counts`` gives them."""
    return spark.createDataFrame([(r, n) for r, n in counts.items() if n], "rule string, n long")


def audited_stream(raw: DataFrame, require: str = "any", bounds: dict | None = None) -> DataFrame:
    """The same rows on a stream; each micro-batch reports its counts under ``clean_audit``."""
    return _rows(judged(raw, require, bounds).observe(METRICS, *_counts()))


class AuditListener(StreamingQueryListener):
    """Adds up the counts of a stream's micro-batches; a batch run again after a failure replaces its earlier report."""

    def __init__(self, tell: Callable[[int, dict[str, int]], None] | None = None) -> None:
        self._batches: dict[tuple, dict[str, int]] = {}
        self._tell = tell

    @property
    def totals(self) -> dict[str, int]:
        out = dict.fromkeys(_OUTCOMES, 0)
        for counts in self._batches.values():
            for r, n in counts.items():
                out[r] += n
        return out

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        row = event.progress.observedMetrics.get(METRICS)
        if row is not None:
            counts = self._batches[str(event.progress.id), event.progress.batchId] = {r: int(row[r]) for r in _OUTCOMES}
            if self._tell:
                self._tell(event.progress.batchId, counts)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass
