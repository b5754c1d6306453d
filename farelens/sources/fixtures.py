"""Ride table derived from the driver's ``events`` table.

The derivation text is portable: it runs unchanged in Spark SQL and DuckDB
and yields equal rows (types: string, float, timestamp_ntz, float x4, int).
It derives every ride from every event; nothing is filtered out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Portable derivation; ``{events}`` is a DataFrame parameter in Spark and the
# ``events`` view in DuckDB. The e0/e1 literals keep constants double in both.
RIDES_FROM_EVENTS_SQL = """
SELECT CAST(event_id AS VARCHAR(32)) AS key,
 CAST(CASE WHEN event_id % 53 = 0 THEN -value WHEN event_id % 211 = 0 THEN 5e0
           WHEN event_id % 223 = 0 THEN NULL ELSE value END AS FLOAT) AS fare_amount,
 CASE WHEN event_id % 227 <> 0 THEN ts - INTERVAL '1' DAY * ((event_id * 37) % 2190) END AS pickup_datetime,
 CAST(CASE WHEN event_id % 97 = 0 THEN 0e0 WHEN event_id % 101 = 0 THEN NULL
           WHEN event_id % 89 = 0 THEN plat ELSE plon END AS FLOAT) AS pickup_longitude,
 CAST(CASE WHEN event_id % 97 = 0 THEN 0e0
           WHEN event_id % 89 = 0 THEN plon ELSE plat END AS FLOAT) AS pickup_latitude,
 CAST(CASE WHEN event_id % 103 = 0 THEN 0e0
           WHEN event_id % 89 = 0 THEN dlat ELSE dlon END AS FLOAT) AS dropoff_longitude,
 CAST(CASE WHEN event_id % 103 = 0 THEN 0e0
           WHEN event_id % 89 = 0 THEN dlon ELSE dlat END AS FLOAT) AS dropoff_latitude,
 CAST(event_id % 7 AS INT) AS passenger_count
FROM (SELECT event_id, ts, value,
  -743e-1 + CAST((event_id * 7919) % 6000 AS DOUBLE) / 1e4 AS plon,
  405e-1 + CAST((event_id * 104729) % 4001 AS DOUBLE) / 1e4 AS plat,
  -743e-1 + CAST((event_id * 611953 + user_id * 31) % 6000 AS DOUBLE) / 1e4 AS dlon,
  405e-1 + CAST((event_id * 746773 + user_id * 17) % 4001 AS DOUBLE) / 1e4 AS dlat
 FROM {events}) g
"""


def rides_sql_for_duckdb() -> str:
    return RIDES_FROM_EVENTS_SQL.replace("{events}", "events")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the folder; every call lists its files anew."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def rides_from_events(spark: SparkSession, events: DataFrame) -> DataFrame:
    """Every event becomes one ride; a pure projection (no shuffle)."""
    return spark.sql(RIDES_FROM_EVENTS_SQL, events=events)


def load_rides(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rides_from_events(spark, read_table(spark, sf_dir, "events"))
