"""Cleaning rules and feature derivation for raw trip lines.

All steps are narrow column expressions over ``(trip_id, line)``; Catalyst
fuses them into the scan stage. Each field is split and converted once in
its own projection, the rules are evaluated on the typed columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fareseg.functions.numeric import is_finite, iso_weekday, to_datetime, to_number
from fareseg.schema import DEFAULT_BOUNDS, RAW_ARITY, RAW_POSITIONS

NUMERIC_FIELDS = ["secs", "distance", "pu_lon", "pu_lat", "do_lon", "do_lat",
                  "fare", "surcharge", "tip", "toll"]

# Rules in the order a row is tested; a rejected row is charged to the first
# rule it fails (reject_counts).
RULES = ["arity", "key", "number", "time_zero", "distance_zero", "fare_range",
         "surcharge", "tip", "toll", "longitude", "latitude", "datetime"]


def split_fields(raw: DataFrame, keep: tuple[str, ...] = ("trip_id",)) -> DataFrame:
    """``(trip_id, p ARRAY<STRING>, n_fields)``: comma split, trailing blanks kept."""
    p = F.split(F.col("line"), ",", -1)
    return raw.select(*keep, p.alias("p")).withColumn("n_fields", F.size("p"))


def parse_fields(raw: DataFrame, keep: tuple[str, ...] = ("trip_id",)) -> DataFrame:
    """Typed view of a raw line: key strings, numbers (NULL if not a finite
    number), the parsed pickup datetime and the field count."""
    s = split_fields(raw, keep)
    field = {name: F.get(F.col("p"), pos) for name, pos in RAW_POSITIONS.items()}
    # The typed row is produced by a generator over a one-element array: a
    # Generate node is a barrier for predicate pushdown, so each field is
    # split and converted once per line instead of once per rule reference.
    typed = F.struct(
        F.col("n_fields").alias("n_fields"),
        field["medallion"].alias("medallion"),
        field["hack_license"].alias("hack_license"),
        field["pickup_datetime"].alias("pickup_datetime"),
        to_datetime(field["pickup_datetime"]).alias("ts"),
        *[to_number(field[c]).alias(c) for c in NUMERIC_FIELDS],
    )
    return s.select(*keep, F.inline(F.array(typed)))


def has_key(require: str = "any") -> Column:
    """Medallion / licence / datetime present: any of them (as the reference
    code does) or all three (as its comment says)."""
    present = [F.coalesce(F.col(c), F.lit("")) != "" for c in ("medallion", "hack_license", "pickup_datetime")]
    if require == "all":
        return present[0] & present[1] & present[2]
    if require == "any":
        return present[0] | present[1] | present[2]
    raise ValueError(f"require must be 'any' or 'all', not {require!r}")


def in_box(lon: str, lat: str, bounds: dict | None = None) -> Column:
    b = bounds or DEFAULT_BOUNDS
    return (F.col(lon).between(*b["lon"])) & (F.col(lat).between(*b["lat"]))


def rule_columns(require: str = "any", bounds: dict | None = None) -> dict[str, Column]:
    """Pass condition of every rule (NULL counts as a failure)."""
    b = bounds or DEFAULT_BOUNDS
    nn = lambda c: (F.col(c) >= 0) & is_finite(c)  # noqa: E731  (NULL -> not passed)
    rules = {
        "arity": F.col("n_fields") == RAW_ARITY,
        "key": has_key(require),
        "number": is_finite("secs") & is_finite("distance") & is_finite("fare") & is_finite("tip"),
        "time_zero": F.col("secs") != 0,
        "distance_zero": F.col("distance") != 0,
        "fare_range": F.col("fare").between(*b["fare"]),
        "surcharge": nn("surcharge"),
        "tip": nn("tip"),
        "toll": nn("toll"),
        "longitude": F.col("pu_lon").between(*b["lon"]) & F.col("do_lon").between(*b["lon"]),
        "latitude": F.col("pu_lat").between(*b["lat"]) & F.col("do_lat").between(*b["lat"]),
        "datetime": F.col("ts").isNotNull(),
    }
    return {k: F.coalesce(v, F.lit(False)) for k, v in rules.items()}


def passes_all(require: str = "any", bounds: dict | None = None) -> Column:
    cond = None
    for c in rule_columns(require, bounds).values():
        cond = c if cond is None else cond & c
    return cond


def clean_trips(raw: DataFrame, require: str = "any", bounds: dict | None = None) -> DataFrame:
    """Rows of ``raw`` that pass every rule, with typed columns."""
    return parse_fields(raw).where(passes_all(require, bounds))


def first_failed_rule(require: str = "any", bounds: dict | None = None) -> Column:
    rules = rule_columns(require, bounds)
    expr = None
    for name in RULES:
        cond = ~rules[name]
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return expr.otherwise(F.lit("kept"))


def reject_counts(raw: DataFrame, require: str = "any", bounds: dict | None = None) -> DataFrame:
    """``(rule, n)``: rows charged to the first rule they fail, plus ``kept``.

    A handful of groups: the partial aggregate runs map-side, so the shuffle
    is a few rows per partition.
    """
    return (parse_fields(raw)
            .select(first_failed_rule(require, bounds).alias("rule"))
            .groupBy("rule").agg(F.count(F.lit(1)).alias("n")))


def trip_features(clean: DataFrame, keep: tuple[str, ...] = ("trip_id",)) -> DataFrame:
    """Training row: ``trip_id, weekday, hour, 4 coordinates, trip_min,
    fare, surcharge, tip, toll, distance``."""
    return clean.select(
        *keep,
        iso_weekday("ts").alias("weekday"),
        F.hour("ts").cast("int").alias("hour"),
        "pu_lon", "pu_lat", "do_lon", "do_lat",
        (F.col("secs") / 60.0).alias("trip_min"),
        "fare", "surcharge", "tip", "toll", "distance",
    )


def trips_from_raw(raw: DataFrame, require: str = "any", bounds: dict | None = None) -> DataFrame:
    return trip_features(clean_trips(raw, require, bounds))
