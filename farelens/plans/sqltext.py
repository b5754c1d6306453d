"""DuckDB SQL fragments for the oracle side of the query catalog.

These strings restate each operator's semantics in plain SQL so the driver
can run them on the same Parquet tables. Double constants are written with
17 significant digits in exponent form, which both engines read as the
same double.
"""

from __future__ import annotations

from ..constants import (COLOR_HIGH, COLOR_LOW, DAY_HOURS, EARTH_RADIUS_KM, INSIDE_NYC_DROPOFF,
                         INSIDE_NYC_PICKUP, MIN_FARE, RUSH_HOURS, SNOW_MONTHS, ZONES)
from ..sources.fixtures import rides_sql_for_duckdb


def d(v: float) -> str:
    return f"{float(v):.17e}"


def between(col: str, lo: float, hi: float) -> str:
    return f"{col} BETWEEN {d(lo)} AND {d(hi)}"


def box(bb, side: str = "pickup") -> str:
    return (f"({between(f'{side}_longitude', bb[0], bb[1])} AND "
            f"{between(f'{side}_latitude', bb[2], bb[3])})")


def box_both(bb) -> str:
    return f"({box(bb, 'pickup')} AND {box(bb, 'dropoff')})"


INSIDE_NYC = f"({box(INSIDE_NYC_PICKUP, 'pickup')} AND {box(INSIDE_NYC_DROPOFF, 'dropoff')})"

RIDE_FLOATS = ("fare_amount", "pickup_longitude", "pickup_latitude", "dropoff_longitude", "dropoff_latitude")
RIDE_ALL = ("key", "fare_amount", "pickup_datetime", "pickup_longitude", "pickup_latitude",
            "dropoff_longitude", "dropoff_latitude", "passenger_count")

FARE_FLOOR = f"fare_amount >= {d(MIN_FARE)}"
NOT_MISSING = "(" + " AND ".join(
    f"{c} IS NOT NULL" + (f" AND NOT isnan({c})" if c in RIDE_FLOATS else "") for c in RIDE_ALL) + ")"
NO_ZEROS = ("(pickup_longitude <> 0 AND dropoff_longitude <> 0 AND dropoff_latitude <> 0 "
            "AND pickup_latitude <> 0 AND passenger_count <> 0)")

FEATURES = ("CAST(year(pickup_datetime) AS VARCHAR) AS year, "
            "CAST(month(pickup_datetime) AS VARCHAR) AS month, "
            "strftime(pickup_datetime, '%a') AS day_of_week, "
            "strftime(pickup_datetime, '%H') AS hour, "
            "strftime(pickup_datetime, '%H:%M:%S') AS time")

HOUR = "hour(pickup_datetime)"
MONTH = "month(pickup_datetime)"
RUSH = f"({HOUR} BETWEEN {RUSH_HOURS[0]} AND {RUSH_HOURS[1]})"
MIDNIGHT = f"(NOT {HOUR} BETWEEN {DAY_HOURS[0]} AND {DAY_HOURS[1]})"
SNOW = f"({MONTH} BETWEEN {SNOW_MONTHS[0]} AND {SNOW_MONTHS[1]})"

COLOR = (f"CASE WHEN fare_amount IS NULL THEN NULL WHEN fare_amount < {d(COLOR_LOW)} THEN 'r' "
         f"WHEN fare_amount > {d(COLOR_LOW)} AND fare_amount < {d(COLOR_HIGH)} THEN 'y' ELSE 'b' END")

RIDES = f"rides AS ({rides_sql_for_duckdb()})"
CLEAN = (f"clean AS (SELECT *, {FEATURES} FROM rides "
         f"WHERE {FARE_FLOOR} AND {NOT_MISSING} AND {NO_ZEROS})")


def distance_ctes(src: str, name: str) -> str:
    """CTE chain adding ``distance_km`` to ``src`` (same operation order as
    the Spark expression)."""
    return (
        f"{name}_r AS (SELECT *, radians(pickup_latitude) AS _p1, radians(pickup_longitude) AS _l1, "
        f"radians(dropoff_latitude) AS _p2, radians(dropoff_longitude) AS _l2 FROM {src}), "
        f"{name}_s AS (SELECT *, sin((_p2 - _p1) / 2) AS _sl, sin((_l2 - _l1) / 2) AS _so FROM {name}_r), "
        f"{name}_a AS (SELECT *, _sl * _sl + cos(_p1) * cos(_p2) * _so * _so AS _a FROM {name}_s), "
        f"{name} AS (SELECT * EXCLUDE (_p1, _l1, _p2, _l2, _sl, _so, _a), "
        f"2e0 * asin(sqrt(CASE WHEN _a > 1 AND NOT isnan(_a) THEN 1e0 ELSE _a END)) * {d(EARTH_RADIUS_KM)} "
        f"AS distance_km FROM {name}_a)")


DIST = distance_ctes("clean", "dist")


def with_(*ctes: str) -> str:
    return "WITH " + ", ".join(ctes) + " "


def digitize(x: str, lo: float, step: float, n: int) -> str:
    xd = f"CAST({x} AS DOUBLE)"
    e0 = f"(floor(({xd} - {d(lo)}) / {d(step)}) + 1)"
    est = f"(CASE WHEN isnan({xd}) THEN {n + 1} WHEN {e0} < 0 THEN 0 WHEN {e0} > {n + 1} THEN {n + 1} ELSE {e0} END)"

    def edge(k: str) -> str:
        return f"({d(lo)} + CAST({k} AS DOUBLE) * {d(step)})"
    too_high = f"(CASE WHEN {est} >= 1 AND {edge(est + ' - 1')} > {xd} THEN 1 ELSE 0 END)"
    too_low = f"(CASE WHEN {est} <= {n} AND {edge(est)} <= {xd} THEN 1 ELSE 0 END)"
    return f"CAST(CASE WHEN {xd} IS NULL THEN NULL ELSE {est} - {too_high} + {too_low} END AS INTEGER)"


def bin_of(v: str, lo: str, hi: str, step: str, bins: int) -> str:
    def edge(k: str) -> str:
        return f"(CASE WHEN {k} >= {bins} THEN {hi} ELSE CAST({k} AS DOUBLE) * {step} + {lo} END)"
    est0 = f"CAST(floor(({v} - {lo}) / ({hi} - {lo}) * {bins}) AS BIGINT)"
    est = f"(CASE WHEN {est0} >= {bins} THEN {bins - 1} WHEN {est0} < 0 THEN 0 ELSE {est0} END)"
    down = f"(CASE WHEN {v} < {edge(est)} THEN 1 ELSE 0 END)"
    up = f"(CASE WHEN {est} <= {bins - 2} AND {v} >= {edge(est + ' + 1')} THEN 1 ELSE 0 END)"
    return f"CAST({est} - {down} + {up} AS INTEGER)"


def zone_union(src: str, cols: str, side: str = "pickup") -> str:
    """One row per (ride, zone containing its ``side`` end)."""
    return " UNION ALL ".join(
        f"SELECT '{z}' AS zone, {cols} FROM {src} WHERE {box(bb, side)}" for z, bb in ZONES.items())
