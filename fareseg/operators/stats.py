"""Column statistics and feature scaling (one global aggregate each)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareseg.functions.vector import lit, q
from fareseg.operators.scan import column_sums, extent
from fareseg.schema import FEATURES


@dataclass(frozen=True)
class FeatureStats:
    n: int
    mean: dict[str, float]
    var: dict[str, float]

    def std(self, c: str) -> float:
        return max(self.var[c], 0.0) ** 0.5


def feature_stats_row(df: DataFrame, cols: list[str] = FEATURES, scaling: str = "zscore") -> FeatureStats:
    """Count, mean and population variance per column, the same bits however the rows are partitioned.

    Three aggregates of one row each: extent, exact sums, exact sums of squared deviations.

    ``scaling="as_written"`` reproduces the reference variance, which
    subtracts each column's mean from the *first* feature of the row:
    ``var_pop(first) + (mean(first) - mean(c))^2``.
    """
    cols = list(cols)
    size = extent(df, cols)
    if not size.rows:
        raise ValueError("no rows to take statistics of")
    reach = dict(zip(cols, size.reach))
    sums = column_sums(df, {c: q(c) for c in cols}, reach, size.rows)
    mean = {c: sums[c] / size.rows for c in cols}
    squares = column_sums(df, {c: f"({q(c)} - {lit(mean[c])}) * ({q(c)} - {lit(mean[c])})" for c in cols},
                          {c: (reach[c] + abs(mean[c])) ** 2 for c in cols}, size.rows)
    pop = {c: squares[c] / size.rows for c in cols}
    if scaling == "zscore":
        var = pop
    elif scaling == "as_written":
        first = cols[0]
        var = {c: pop[first] + (mean[first] - mean[c]) ** 2 for c in cols}
    else:
        raise ValueError(f"scaling must be 'zscore' or 'as_written', not {scaling!r}")
    return FeatureStats(size.rows, mean, var)


def feature_stats(df: DataFrame, cols: list[str] = FEATURES) -> DataFrame:
    """Long form ``(feature, n, mean, var, std)`` without leaving Spark."""
    aggs = [F.count(F.lit(1)).alias("n")]
    for c in cols:
        aggs += [F.avg(c).alias(f"m_{c}"), F.var_pop(c).alias(f"v_{c}"), F.stddev_pop(c).alias(f"s_{c}")]
    wide = df.agg(*aggs)
    rows = F.array(*[F.struct(F.lit(c).alias("feature"), F.col("n").alias("n"), F.col(f"m_{c}").alias("mean"),
                              F.col(f"v_{c}").alias("var"), F.col(f"s_{c}").alias("std")) for c in cols])
    return wide.select(F.inline(rows))


def feature_var_as_written(df: DataFrame, cols: list[str] = FEATURES) -> DataFrame:
    """``(feature, var)`` with the reference's variance formula (see above)."""
    first = cols[0]
    aggs = [F.var_pop(first).alias("_v0"), F.avg(first).alias("_m0")] + [F.avg(c).alias(f"m_{c}") for c in cols]
    wide = df.agg(*aggs)
    rows = F.array(*[F.struct(F.lit(c).alias("feature"),
                              (F.col("_v0") + (F.col("_m0") - F.col(f"m_{c}")) * (F.col("_m0") - F.col(f"m_{c}")))
                              .alias("var")) for c in cols])
    return wide.select(F.inline(rows))


def scale_columns(stats: FeatureStats, cols: list[str] = FEATURES, prefix: str = "") -> list:
    """z-score expressions with the statistics as literals; 0 where std is 0."""
    out = []
    for c in cols:
        s = stats.std(c)
        z = (F.col(c) - F.lit(stats.mean[c])) / F.lit(s) if s > 0 else F.lit(0.0)
        out.append(z.alias(prefix + c))
    return out


def scaled_features(df: DataFrame, cols: list[str] = FEATURES, scaling: str = "zscore",
                    stats: FeatureStats | None = None, keep: list[str] = ("trip_id",)) -> DataFrame:
    stats = stats or feature_stats_row(df, cols, scaling)
    return df.select(*keep, *scale_columns(stats, cols))
