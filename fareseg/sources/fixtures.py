"""Raw trip lines derived from the ``events`` table.

The same SQL text runs in Spark (``{S}`` = ``string``) and in DuckDB
(``{S}`` = ``varchar``), so both engines see byte-identical lines. Numbers go
through DECIMAL so their text is equal. ``event_type = 'error'`` rows are
broken on purpose (by ``event_id % 7``): 1 zero time, 2 zero distance,
3 zero longitude, 4 text fare, 5 sixteen fields, 6 NaN fare.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

RAW_TRIPS_SQL = """
with b as (
 select event_id, user_id, event_type, cast(value as decimal(9,2)) as v, hour(ts) as h,
        substr(cast(date_trunc('second', ts) as {S}),1,19) as dt
 from {events}),
f as (
 select event_id, user_id, dt, event_type, h,
  cast(case when event_type='error' and event_id % 7 = 1 then 0 else 60 + (event_id*7919) % 3000 end as {S}) as secs,
  cast(cast(case when event_type='error' and event_id % 7 = 2 then 0 else v * 0.1 end as decimal(9,3)) as {S}) as dist,
  cast(cast((case when event_type='error' and event_id % 7 = 3 then 0 else -74050000 + ((user_id*37) % 100)*2000 end) * 0.000001 as decimal(9,6)) as {S}) as plon,
  cast(cast((40600000 + ((user_id*53) % 100)*2500) * 0.000001 as decimal(9,6)) as {S}) as plat,
  cast(cast((-74050000 + ((event_id*61) % 100)*2000) * 0.000001 as decimal(9,6)) as {S}) as dlon,
  cast(cast((40600000 + ((event_id*29) % 100)*2500) * 0.000001 as decimal(9,6)) as {S}) as dlat,
  case when event_type='error' and event_id % 7 = 4 then 'bad'
       when event_type='error' and event_id % 7 = 6 then 'nan'
       else cast(cast(2.5 + v * 0.25 as decimal(9,2)) as {S}) end as fare,
  case when h >= 16 and h < 20 then '1.0' when h >= 20 or h < 6 then '0.5' else '0' end as sur,
  cast(cast(((event_id*13) % 50) * 0.1 as decimal(9,2)) as {S}) as tip,
  case when event_id % 17 = 0 then '5.33' else '0' end as toll
 from b)
select event_id as trip_id,
 concat('m', cast(user_id as {S}), ',h', cast(user_id as {S}), ',', dt, ',', dt, ',', secs, ',', dist, ',',
        plon, ',', plat, ',', dlon, ',', dlat, ',CSH,', fare, ',', sur, ',0.5,', tip, ',', toll,
        case when event_type='error' and event_id % 7 = 5 then '' else ',0' end) as line
from f
"""


def raw_trips_sql(dialect: str = "duckdb", events: str = "events") -> str:
    """The fixture query text for one engine."""
    s = "varchar" if dialect == "duckdb" else "string"
    return RAW_TRIPS_SQL.replace("{S}", s).replace("{events}", events)


def raw_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``raw_trips(trip_id BIGINT, line STRING)`` derived by Spark from ``events``."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    text = RAW_TRIPS_SQL.replace("{S}", "string")
    return spark.sql(text, events=events)
