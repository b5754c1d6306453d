"""Named queries over the driver tables, each paired with DuckDB oracle SQL.

Every query reads whole tables (rides are derived from all of ``events``,
the keyed table is all of ``customer``) and returns a DataFrame. Doubles
that come out of floating-point arithmetic are rounded to 6 decimals on
both sides so results compare by value.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..constants import (GRID_N_LAT, GRID_N_LON, HIST_BINS, HIST_BINS_NOTEBOOK, NYC_BB, NYC_BB_ZOOM, PYRAMID_CELLS, PYRAMID_ZOOMS,
                         ZONES, grid_constants)
from ..functions.calendar import add_calendar_features, midnight_rides, rush_hour_rides, snow_season_rides
from ..functions.color import fare_color
from ..functions.geo import with_distance, with_grid_cells, zoom_distance_fare
from ..operators import aggregates as agg
from ..operators import changes as chg
from ..operators.clean import (clean_rides, cleaning_report, drop_missing, drop_zeros, fare_floor,
                               nyc_box_clean, swap_repair)
from ..operators.zones import (area_sql, box_filter, extent_clip, inside_nyc, outside_nyc, tag_zones, tag_zones_with,
                               zone_rides, zones_frame)
from ..session import scratch_path
from ..sources.clustered import write_rides_clustered
from ..sources.fixtures import load_rides, read_table
from ..sources.keyed_store import KeyedStore
from ..sources.rides import (CSV_TS_FORMAT, RIDE_COLUMNS, cap_rows, cap_rows_spread, count_rows, drop_columns, good_rides, parse_rides,
                             preview_rows, project, quarantined, read_rides_csv, register_view, subset_rows, write_rides_csv)
from ..streaming import epochs as ep
from ..streaming import rides_stream as rs
from . import plotsets as ps
from . import sqltext as q

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def r6(df: DataFrame, *cols: str) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c), 6) for c in cols})


def rides(spark: SparkSession, sf: str) -> DataFrame:
    return load_rides(spark, sf)


def cleaned(spark: SparkSession, sf: str) -> DataFrame:
    return clean_rides(rides(spark, sf))


def cleaned_dist(spark: SparkSession, sf: str) -> DataFrame:
    return with_distance(cleaned(spark, sf))


W_RIDES = q.with_(q.RIDES)
W_CLEAN = q.with_(q.RIDES, q.CLEAN)
W_DIST = q.with_(q.RIDES, q.CLEAN, q.DIST)
CLEAN_COLS = ", ".join(RIDE_COLUMNS + ["year", "month", "day_of_week", "hour", "time"])

# ---------------------------------------------------------------- sources (S)


@register("scan_rides", W_RIDES + "SELECT * FROM rides")
def scan_rides(spark, sf):
    return rides(spark, sf)


@register("count_rides", W_RIDES + "SELECT count(*) AS n_rides FROM rides")
def count_rides(spark, sf):
    return count_rows(rides(spark, sf), "n_rides")


@register("cap_rides", W_RIDES + "SELECT * FROM rides ORDER BY key LIMIT 400")
def cap_rides(spark, sf):
    return cap_rows(rides(spark, sf), 400)


CAP_SHARE = 5_000


@register("cap_rides_spread", W_RIDES + f"SELECT * FROM rides ORDER BY key LIMIT {CAP_SHARE}")
def cap_rides_spread(spark, sf):
    """A cap that no task gathers; half of the rides at scale factor 0.01."""
    return cap_rows_spread(rides(spark, sf), CAP_SHARE)


@register("subset_400", W_RIDES + "SELECT * EXCLUDE (pickup_datetime) FROM rides ORDER BY key LIMIT 400")
def subset_400(spark, sf):
    return subset_rows(rides(spark, sf), 400)


@register("preview_rows", W_CLEAN + "SELECT * FROM clean ORDER BY key LIMIT 5")
def preview(spark, sf):
    return preview_rows(cleaned(spark, sf), 5)


@register("preview_colors", W_CLEAN + f"SELECT key, {q.COLOR} AS color FROM clean "
          f"WHERE {q.box(ZONES['manhattan'])} ORDER BY key LIMIT 2")
def preview_colors(spark, sf):
    """``take(2)`` of a scalar expression (fare colour of Manhattan rides)."""
    return preview_rows(zone_rides(cleaned(spark, sf), "manhattan").select("key", fare_color().alias("color")), 2)


@register("project_columns", W_RIDES + "SELECT key, fare_amount, passenger_count FROM rides")
def project_columns(spark, sf):
    return project(drop_columns(rides(spark, sf), "pickup_datetime"), "key", "fare_amount", "passenger_count")


@register("csv_roundtrip", W_RIDES + "SELECT * FROM rides")
def csv_roundtrip(spark, sf):
    path = scratch_path(spark, "rides-csv")
    write_rides_csv(rides(spark, sf), path)
    return read_rides_csv(spark, path, ntz=True)


@register("csv_utc_scan", W_RIDES + "SELECT * REPLACE (date_trunc('second', pickup_datetime) AS pickup_datetime) FROM rides")
def csv_utc_scan(spark, sf):
    """S1 with ``TimestampType`` over text such as ``2009-06-15 17:26:21 UTC``."""
    path = scratch_path(spark, "rides-csv-utc")
    text = F.date_format("pickup_datetime", "yyyy-MM-dd HH:mm:ss 'UTC'")
    write_rides_csv(rides(spark, sf).withColumn("pickup_datetime", text), path)
    back = read_rides_csv(spark, path)
    # As wall-clock time at UTC, whatever the session's zone.
    utc = F.convert_timezone(F.current_timezone(), F.lit("UTC"), F.col("pickup_datetime").cast("timestamp_ntz"))
    return back.withColumn("pickup_datetime", utc)


@register("view_sql", W_RIDES + f"SELECT * FROM rides WHERE {q.box(ZONES['brooklyn'])}")
def view_sql(spark, sf):
    register_view(rides(spark, sf), "rides_view")
    return spark.sql(f"SELECT * FROM rides_view WHERE {area_sql('brooklyn')}")

# ---------------------------------------------------------------- cleaning (C)


@register("fare_floor", W_RIDES + f"SELECT * FROM rides WHERE {q.FARE_FLOOR}")
def q_fare_floor(spark, sf):
    return fare_floor(rides(spark, sf))


@register("drop_missing", W_RIDES + f"SELECT * FROM rides WHERE {q.NOT_MISSING}")
def q_drop_missing(spark, sf):
    return drop_missing(rides(spark, sf))


@register("drop_zeros", W_RIDES + f"SELECT * FROM rides WHERE {q.NO_ZEROS}")
def q_drop_zeros(spark, sf):
    return drop_zeros(rides(spark, sf))


@register("cleaned_rides", W_CLEAN + "SELECT * FROM clean")
def q_cleaned(spark, sf):
    return cleaned(spark, sf)


def _report_sql() -> str:
    p1 = f"coalesce({q.FARE_FLOOR}, false)"
    p2 = f"coalesce({q.NOT_MISSING}, false)"
    p3 = f"coalesce({q.NO_ZEROS}, false)"
    p4 = f"coalesce({q.box_both(NYC_BB)}, false)"
    sizes = (f"sizes AS (SELECT count(*) AS n0, count(*) FILTER (WHERE {p1}) AS n1, "
             f"count(*) FILTER (WHERE {p1} AND {p2}) AS n2, "
             f"count(*) FILTER (WHERE {p1} AND {p2} AND {p3}) AS n3, "
             f"count(*) FILTER (WHERE {p1} AND {p2} AND {p3} AND {p4}) AS n4 FROM rides)")
    names = ["fare_floor", "drop_missing", "drop_zeros", "nyc_box"]
    rows = " UNION ALL ".join(
        f"SELECT CAST({i} AS INTEGER) AS step, '{n}' AS step_name, n{i - 1} AS old_size, n{i} AS new_size "
        f"FROM sizes" for i, n in enumerate(names, start=1))
    return (q.with_(q.RIDES, sizes, f"steps AS ({rows})") +
            "SELECT step, step_name, old_size, new_size, old_size - new_size AS dropped, "
            "round(CASE WHEN old_size = 0 THEN NULL ELSE "
            "CAST(old_size - new_size AS DOUBLE) / CAST(old_size AS DOUBLE) * 100e0 END, 2) AS dropped_pct "
            "FROM steps")


@register("cleaning_report", _report_sql())
def q_cleaning_report(spark, sf):
    return cleaning_report(rides(spark, sf))


@register("nyc_box_clean", W_CLEAN + f"SELECT * FROM clean WHERE {q.box_both(NYC_BB)}")
def q_nyc_box_clean(spark, sf):
    return nyc_box_clean(cleaned(spark, sf))


def _swap_sql() -> str:
    def sw(side):
        lon, lat = f"{side}_longitude", f"{side}_latitude"
        return (f"coalesce({q.between(lon, 40.5, 41.8)} AND {q.between(lat, -74.5, -72.8)}, false)")
    return (W_RIDES + "SELECT key, fare_amount, pickup_datetime, "
            f"CASE WHEN {sw('pickup')} THEN pickup_latitude ELSE pickup_longitude END AS pickup_longitude, "
            f"CASE WHEN {sw('pickup')} THEN pickup_longitude ELSE pickup_latitude END AS pickup_latitude, "
            f"CASE WHEN {sw('dropoff')} THEN dropoff_latitude ELSE dropoff_longitude END AS dropoff_longitude, "
            f"CASE WHEN {sw('dropoff')} THEN dropoff_longitude ELSE dropoff_latitude END AS dropoff_latitude, "
            f"passenger_count, {sw('pickup')} AS pickup_swapped, {sw('dropoff')} AS dropoff_swapped FROM rides")


@register("swap_repair", _swap_sql())
def q_swap_repair(spark, sf):
    return swap_repair(rides(spark, sf))

# ---------------------------------------------------------------- filters (F)


def _zone_query(zone: str):
    @register(f"zone_{zone}", W_RIDES + f"SELECT * FROM rides WHERE {q.box(ZONES[zone])}")
    def fn(spark, sf):
        return zone_rides(rides(spark, sf), zone)
    return fn


for _z in ZONES:
    _zone_query(_z)


@register("zone_dropoff", W_RIDES + "SELECT * EXCLUDE (zone), zone FROM (" +
          q.zone_union("rides", "*", "dropoff") + ")")
def q_zone_dropoff(spark, sf):
    return tag_zones(rides(spark, sf), "dropoff")


@register("zone_tags", W_RIDES + "SELECT key, zone FROM (" + q.zone_union("rides", "key") + ")")
def q_zone_tags(spark, sf):
    return tag_zones(rides(spark, sf), "pickup").select("key", "zone")


@register("zone_tags_join", W_RIDES + "SELECT key, zone FROM (" + q.zone_union("rides", "key") + ")")
def q_zone_tags_join(spark, sf):
    """F7 against the zone dimension table (join on grid cells of the boxes' own sizes)."""
    return tag_zones_with(rides(spark, sf), zones_frame(spark), "pickup").select("key", "zone")


@register("box_filter", W_RIDES + f"SELECT * FROM rides WHERE {q.box_both(NYC_BB_ZOOM)}")
def q_box_filter(spark, sf):
    return box_filter(rides(spark, sf), NYC_BB_ZOOM)


@register("inside_nyc", W_RIDES + f"SELECT * FROM rides WHERE {q.INSIDE_NYC}")
def q_inside(spark, sf):
    return inside_nyc(rides(spark, sf))


@register("outside_nyc", W_RIDES + f"SELECT * FROM rides WHERE NOT {q.INSIDE_NYC}")
def q_outside(spark, sf):
    return outside_nyc(rides(spark, sf))


@register("rush_hour", W_CLEAN + f"SELECT * FROM clean WHERE {q.RUSH}")
def q_rush(spark, sf):
    return rush_hour_rides(cleaned(spark, sf))


@register("midnight", W_CLEAN + f"SELECT * FROM clean WHERE {q.MIDNIGHT}")
def q_midnight(spark, sf):
    return midnight_rides(cleaned(spark, sf))


@register("snow_season", W_CLEAN + f"SELECT * FROM clean WHERE {q.SNOW}")
def q_snow(spark, sf):
    return snow_season_rides(cleaned(spark, sf))


@register("zoom_distance_fare", W_DIST + "SELECT key, round(distance_km, 6) AS distance_km, fare_amount "
          "FROM dist WHERE distance_km < 30e0 AND fare_amount < 100e0")
def q_zoom(spark, sf):
    return r6(zoom_distance_fare(cleaned_dist(spark, sf)).select("key", "distance_km", "fare_amount"),
              "distance_km")


@register("extent_clip", W_RIDES + "SELECT key, pickup_longitude AS longitude, pickup_latitude AS latitude "
          f"FROM rides WHERE {q.box(NYC_BB_ZOOM, 'pickup')}")
def q_extent_clip(spark, sf):
    return extent_clip(rides(spark, sf), NYC_BB_ZOOM, "pickup")

# ---------------------------------------------------------------- projections (P)


@register("calendar_features", W_RIDES + f"SELECT key, {q.FEATURES} FROM rides")
def q_calendar(spark, sf):
    return add_calendar_features(rides(spark, sf)).select("key", "year", "month", "day_of_week", "hour", "time")


@register("distance_km", q.with_(q.RIDES, q.distance_ctes("rides", "rd")) +
          "SELECT key, round(distance_km, 6) AS distance_km FROM rd")
def q_distance(spark, sf):
    return r6(with_distance(rides(spark, sf)).select("key", "distance_km"), "distance_km")


def _slice_sql() -> str:
    preds = {"midnight": q.MIDNIGHT, "snow": q.SNOW, "rush": q.RUSH, "new_york": q.INSIDE_NYC}
    preds.update({z: q.box(ZONES[z]) for z in ("bronx", "brooklyn", "manhattan", "jfk")})
    return W_DIST + " UNION ALL ".join(
        f"SELECT '{n}' AS slice, key, round(distance_km, 6) AS distance_km FROM dist WHERE {preds[n]}"
        for n in ps.SLICE_NAMES)


@register("slice_distances", _slice_sql())
def q_slice_distances(spark, sf):
    return r6(ps.slice_distances(cleaned_dist(spark, sf)), "distance_km")


@register("fare_color", W_RIDES + f"SELECT key, fare_amount, {q.COLOR} AS color FROM rides")
def q_color(spark, sf):
    return rides(spark, sf).select("key", "fare_amount", fare_color().alias("color"))


def _grid_sql() -> str:
    g = grid_constants()
    cols = []
    for side in ("pickup", "dropoff"):
        cols.append(q.digitize(f"{side}_longitude", g["lon0"], g["dlon"], GRID_N_LON) + f" AS {side}_ix")
        cols.append(q.digitize(f"{side}_latitude", g["lat0"], g["dlat"], GRID_N_LAT) + f" AS {side}_iy")
    return W_RIDES + "SELECT key, " + ", ".join(cols) + " FROM rides"


@register("grid_index", _grid_sql())
def q_grid_index(spark, sf):
    return with_grid_cells(rides(spark, sf)).select("key", "pickup_ix", "pickup_iy", "dropoff_ix", "dropoff_iy")

# ---------------------------------------------------------------- aggregations (A)


def _avg_query(dim: str, name: str):
    @register(name, W_CLEAN + f"SELECT {dim}, round(avg(fare_amount), 6) AS avg_fare FROM clean GROUP BY {dim}")
    def fn(spark, sf):
        return r6(agg.avg_fare_by(cleaned(spark, sf), dim), "avg_fare")
    return fn


for _dim, _name in (("month", "avg_fare_month"), ("hour", "avg_fare_hour"),
                    ("day_of_week", "avg_fare_weekday"), ("year", "avg_fare_year")):
    _avg_query(_dim, _name)

DIMS = ("month", "day_of_week", "hour", "year")
AVG_ALL = (
    "SELECT " + "CASE " + " ".join(f"WHEN grouping({x}) = 0 THEN '{x}'" for x in DIMS) + " END AS dimension, "
    "CASE " + " ".join(f"WHEN grouping({x}) = 0 THEN {x}" for x in DIMS) + " END AS bucket, "
    "avg(fare_amount) AS avg_fare, count(*) AS n_rides FROM clean "
    "GROUP BY GROUPING SETS (" + ", ".join(f"({x})" for x in DIMS) + ")")


@register("avg_fare_all", W_CLEAN + "SELECT dimension, bucket, round(avg_fare, 6) AS avg_fare, n_rides "
          f"FROM ({AVG_ALL})")
def q_avg_all(spark, sf):
    return r6(agg.avg_fare_all(cleaned(spark, sf)), "avg_fare")


def _density_cte(n_lon: int = GRID_N_LON, n_lat: int = GRID_N_LAT, name: str = "grid") -> str:
    g = grid_constants(NYC_BB, n_lon, n_lat)
    pts = ("SELECT 'pickup' AS side, pickup_longitude AS lon, pickup_latitude AS lat FROM clean "
           "UNION ALL SELECT 'dropoff', dropoff_longitude, dropoff_latitude FROM clean")
    idx = (f"SELECT side, {q.digitize('lon', g['lon0'], g['dlon'], n_lon)} AS ix, "
           f"{q.digitize('lat', g['lat0'], g['dlat'], n_lat)} AS iy FROM ({pts})")
    return (f"{name} AS (SELECT side, CAST({n_lat} - iy AS INTEGER) AS row, CAST(ix - 1 AS INTEGER) AS col, "
            f"count(*) AS cnt, count(*) / {q.d(g['cell_area_km2'])} AS density FROM ({idx}) "
            f"WHERE ix BETWEEN 1 AND {n_lon} AND iy BETWEEN 1 AND {n_lat} GROUP BY side, ix, iy)")


def _density_sql() -> str:
    g = grid_constants()
    return (q.with_(q.RIDES, q.CLEAN, _density_cte()) +
            "SELECT side, row, col, cnt, round(density, 6) AS density, round(ln(1 + density), 6) AS log_density, "
            f"round({q.d(g['cell_width_km'])}, 6) AS cell_width_km, "
            f"round({q.d(g['cell_height_km'])}, 6) AS cell_height_km, "
            f"round({q.d(g['cell_area_km2'])}, 6) AS cell_area_km2 FROM grid")


@register("density_grid", _density_sql())
def q_density(spark, sf):
    return r6(agg.density_grid(cleaned(spark, sf)), "density", "log_density", "cell_width_km",
              "cell_height_km", "cell_area_km2")


def _hist_sql(bins: int) -> str:
    vals = ("vals AS (SELECT CAST(distance_km AS DOUBLE) AS v FROM dist "
            "WHERE distance_km IS NOT NULL AND NOT isnan(distance_km))")
    p = ("p AS (SELECT lo, hi, (hi - lo) / " + q.d(bins) + " AS step FROM ("
         "SELECT CASE WHEN mn = mx THEN mn - 0.5e0 ELSE mn END AS lo, "
         "CASE WHEN mn = mx THEN mx + 0.5e0 ELSE mx END AS hi "
         "FROM (SELECT min(v) AS mn, max(v) AS mx FROM vals) WHERE mn IS NOT NULL))")
    counts = (f"counts AS (SELECT {q.bin_of('v', 'lo', 'hi', 'step', bins)} AS bin, count(*) AS cnt "
              "FROM vals CROSS JOIN p GROUP BY 1)")
    return (q.with_(q.RIDES, q.CLEAN, q.DIST, vals, p, counts) +
            "SELECT r.bin, round(CAST(r.bin AS DOUBLE) * step + lo, 6) AS bin_lo, "
            f"round(CASE WHEN r.bin = {bins - 1} THEN hi ELSE CAST(r.bin + 1 AS DOUBLE) * step + lo END, 6) "
            "AS bin_hi, coalesce(c.cnt, 0) AS cnt "
            f"FROM p CROSS JOIN (SELECT CAST(range AS INTEGER) AS bin FROM range({bins})) r "
            "LEFT JOIN counts c ON c.bin = r.bin")


def _hist_query(name: str, bins: int):
    @register(name, _hist_sql(bins))
    def fn(spark, sf):
        return r6(agg.distance_histogram(cleaned_dist(spark, sf), "distance_km", bins), "bin_lo", "bin_hi")
    return fn


_hist_query("distance_hist_50", HIST_BINS)
_hist_query("distance_hist_2", HIST_BINS_NOTEBOOK)

NO_NAN_D = "CASE WHEN NOT isnan(distance_km) THEN distance_km END"
NO_NAN_F = "CASE WHEN NOT isnan(fare_amount) THEN CAST(fare_amount AS DOUBLE) END"


@register("mean_by_passengers", W_DIST + f"SELECT passenger_count, round(avg({NO_NAN_D}), 6) AS avg_distance_km, "
          f"round(avg({NO_NAN_F}), 6) AS avg_fare FROM dist WHERE passenger_count IS NOT NULL "
          "GROUP BY passenger_count")
def q_mean_by_passengers(spark, sf):
    return r6(agg.mean_by_passengers(cleaned_dist(spark, sf)), "avg_distance_km", "avg_fare")


@register("usd_per_km", W_DIST + "SELECT round(sf, 6) AS sum_fare, round(sd, 6) AS sum_distance_km, "
          "round(CASE WHEN sd = 0 THEN NULL ELSE sf / sd END, 6) AS usd_per_km, "
          "round(CASE WHEN sd = 0 THEN NULL ELSE sf / sd END, 2) AS usd_per_km_2dp "
          f"FROM (SELECT sum({NO_NAN_F}) AS sf, sum({NO_NAN_D}) AS sd FROM dist)")
def q_usd_per_km(spark, sf):
    out = agg.usd_per_km(cleaned_dist(spark, sf))
    return r6(out.withColumn("usd_per_km_2dp", F.round("usd_per_km", 2)), "sum_fare", "sum_distance_km",
              "usd_per_km")


def _describe_sql() -> str:
    st = ("st AS (SELECT CAST(count(*) AS DOUBLE) AS c, avg(v) AS m, stddev_samp(v) AS s, min(v) AS mn, "
          "quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.5) AS q2, quantile_cont(v, 0.75) AS q3, "
          "max(v) AS mx FROM (SELECT CAST(distance_km AS DOUBLE) AS v FROM dist "
          "WHERE distance_km IS NOT NULL AND NOT isnan(distance_km)))")
    stats = [("count", "c"), ("mean", "m"), ("std", "s"), ("min", "mn"), ("25%", "q1"), ("50%", "q2"),
             ("75%", "q3"), ("max", "mx")]
    rows = " UNION ALL ".join(f"SELECT CAST({i} AS INTEGER) AS ord, '{n}' AS stat, round({c}, 6) AS value FROM st"
                              for i, (n, c) in enumerate(stats))
    return q.with_(q.RIDES, q.CLEAN, q.DIST, st) + rows


@register("describe_distance", _describe_sql())
def q_describe(spark, sf):
    return r6(agg.describe_distance(cleaned_dist(spark, sf)), "value")


def _zone_details_sql() -> str:
    cols = "passenger_count, distance_km, fare_amount"
    tagged = f"tagged AS ({q.zone_union('dist', cols)})"
    nd = "CASE WHEN NOT isnan(distance_km) THEN distance_km END"
    nf = "CASE WHEN NOT isnan(fare_amount) THEN CAST(fare_amount AS DOUBLE) END"
    return (q.with_(q.RIDES, q.CLEAN, q.DIST, tagged) +
            "SELECT zone, CASE WHEN grouping(passenger_count) = 1 THEN 'zone' ELSE 'zone_passengers' END AS level, "
            "passenger_count, count(*) AS n_rides, "
            f"round(avg({nd}), 6) AS avg_distance_km, round(avg({nf}), 6) AS avg_fare, "
            f"round(CASE WHEN sum({nd}) = 0 THEN NULL ELSE sum({nf}) / sum({nd}) END, 6) AS usd_per_km "
            "FROM tagged WHERE passenger_count IS NOT NULL "
            "GROUP BY GROUPING SETS ((zone, passenger_count), (zone))")


@register("zone_details", _zone_details_sql())
def q_zone_details(spark, sf):
    return r6(agg.zone_details(cleaned_dist(spark, sf)), "avg_distance_km", "avg_fare", "usd_per_km")

# ---------------------------------------------------------------- plot datasets (D)


def _area_pred(a: str) -> str:
    return q.INSIDE_NYC if a == "new_york" else q.box(ZONES[a])


@register("area_map", W_CLEAN + " UNION ALL ".join(
    f"SELECT '{a}' AS area, key, pickup_longitude, pickup_latitude, fare_amount, {q.COLOR} AS color "
    f"FROM clean WHERE {_area_pred(a)}" for a in ps.AREAS))
def q_area_map(spark, sf):
    return ps.area_map(cleaned(spark, sf))


@register("special_map", W_CLEAN + " UNION ALL ".join(
    f"SELECT '{n}' AS slice, key, pickup_longitude, pickup_latitude, fare_amount, {q.COLOR} AS color "
    f"FROM clean WHERE {p}" for n, p in (("snow", q.SNOW), ("midnight", q.MIDNIGHT), ("rush", q.RUSH))))
def q_special_map(spark, sf):
    return ps.special_map(cleaned(spark, sf))


@register("street_map", W_RIDES + "SELECT zone, series, key, longitude, latitude FROM ("
          "SELECT zone, 'pickup' AS series, key, pickup_longitude AS longitude, pickup_latitude AS latitude "
          "FROM z UNION ALL SELECT zone, 'dropoff', key, dropoff_longitude, dropoff_latitude FROM z)"
          .replace("FROM z", "FROM (" + q.zone_union("rides", "key, pickup_longitude, pickup_latitude, "
                                                     "dropoff_longitude, dropoff_latitude") + ")"))
def q_street_map(spark, sf):
    return ps.street_map(rides(spark, sf))


@register("pickup_dropoff_map", W_CLEAN + " UNION ALL ".join(
    f"SELECT '{fr}' AS frame, '{side}' AS side, key, {side}_longitude AS longitude, {side}_latitude AS latitude "
    f"FROM clean WHERE {q.box(bb, side)}"
    for fr, bb in (("wide", NYC_BB), ("zoom", NYC_BB_ZOOM)) for side in ("pickup", "dropoff")))
def q_pickup_dropoff_map(spark, sf):
    return ps.pickup_dropoff_map(cleaned(spark, sf))


def _density_map_sql() -> str:
    frame = (f"SELECT s.side, CAST(r.range // {GRID_N_LON} AS INTEGER) AS row, "
             f"CAST(r.range % {GRID_N_LON} AS INTEGER) AS col FROM range({GRID_N_LAT * GRID_N_LON}) r "
             "CROSS JOIN (SELECT 'pickup' AS side UNION ALL SELECT 'dropoff') s")
    return (q.with_(q.RIDES, q.CLEAN, _density_cte()) +
            "SELECT f.side, f.row, f.col, coalesce(g.cnt, 0) AS cnt, round(coalesce(g.density, 0e0), 6) AS density, "
            "round(ln(1 + coalesce(g.density, 0e0)), 6) AS log_density "
            f"FROM ({frame}) f LEFT JOIN grid g ON g.side = f.side AND g.row = f.row AND g.col = f.col")


@register("density_map", _density_map_sql())
def q_density_map(spark, sf):
    return r6(ps.density_map(cleaned(spark, sf)), "density", "log_density")


@register("distance_fare_scatter", W_DIST + "SELECT key, round(distance_km, 6) AS distance_km, fare_amount, "
          "coalesce(distance_km < 30e0 AND fare_amount < 100e0, false) AS zoomed FROM dist")
def q_scatter(spark, sf):
    return r6(ps.distance_fare_scatter(cleaned_dist(spark, sf)), "distance_km")


@register("distance_fare_scatter_jfk", W_DIST + "SELECT key, round(distance_km, 6) AS distance_km, fare_amount, "
          f"coalesce(distance_km < 30e0 AND fare_amount < 100e0, false) AS zoomed FROM dist WHERE {q.box(ZONES['jfk'])}")
def q_scatter_jfk(spark, sf):
    return r6(ps.distance_fare_scatter(cleaned_dist(spark, sf), "jfk"), "distance_km")


def _bundle_sql(bins: int = HIST_BINS) -> str:
    vals = ("vals AS (SELECT zone, CAST(distance_km AS DOUBLE) AS v FROM ("
            + q.zone_union("dist", "distance_km") + ") WHERE distance_km IS NOT NULL AND NOT isnan(distance_km))")
    p = ("p AS (SELECT zone, lo, hi, (hi - lo) / " + q.d(bins) + " AS step FROM ("
         "SELECT zone, CASE WHEN mn = mx THEN mn - 0.5e0 ELSE mn END AS lo, "
         "CASE WHEN mn = mx THEN mx + 0.5e0 ELSE mx END AS hi "
         "FROM (SELECT zone, min(v) AS mn, max(v) AS mx FROM vals GROUP BY zone)))")
    counts = (f"counts AS (SELECT vals.zone, {q.bin_of('v', 'lo', 'hi', 'step', bins)} AS bin, count(*) AS cnt "
              "FROM vals JOIN p ON p.zone = vals.zone GROUP BY 1, 2)")
    return (q.with_(q.RIDES, q.CLEAN, q.DIST, vals, p, counts) +
            "SELECT p.zone, r.bin, round(CAST(r.bin AS DOUBLE) * step + lo, 6) AS bin_lo, "
            f"round(CASE WHEN r.bin = {bins - 1} THEN hi ELSE CAST(r.bin + 1 AS DOUBLE) * step + lo END, 6) "
            "AS bin_hi, coalesce(c.cnt, 0) AS cnt "
            f"FROM p CROSS JOIN (SELECT CAST(range AS INTEGER) AS bin FROM range({bins})) r "
            "LEFT JOIN counts c ON c.zone = p.zone AND c.bin = r.bin")


@register("distance_bundle", _bundle_sql())
def q_bundle(spark, sf):
    return r6(ps.distance_bundle(cleaned_dist(spark, sf), HIST_BINS), "bin_lo", "bin_hi")


@register("distance_bundle_scatter", W_DIST + "SELECT zone, key, round(distance_km, 6) AS distance_km, fare_amount FROM ("
          + q.zone_union("dist", "key, distance_km, fare_amount") + ") WHERE distance_km < 30e0 AND fare_amount < 100e0")
def q_bundle_scatter(spark, sf):
    return r6(ps.distance_bundle_scatter(cleaned_dist(spark, sf)), "distance_km")


@register("distance_bundle_details", _zone_details_sql())
def q_bundle_details(spark, sf):
    return r6(ps.distance_bundle_details(cleaned_dist(spark, sf)), "avg_distance_km", "avg_fare", "usd_per_km")


@register("fare_vs_passengers", W_RIDES + "SELECT key, passenger_count, fare_amount FROM rides")
def q_fare_vs_passengers(spark, sf):
    return ps.fare_vs_passengers(rides(spark, sf))


@register("fare_vs_time", W_RIDES + "SELECT key, pickup_datetime, fare_amount FROM rides")
def q_fare_vs_time(spark, sf):
    return ps.fare_vs_time(rides(spark, sf))


@register("fare_vs_coords", W_CLEAN + "SELECT fare_amount, 'pickup' AS side, key, pickup_longitude AS longitude, "
          "pickup_latitude AS latitude FROM clean UNION ALL SELECT fare_amount, 'dropoff', key, dropoff_longitude, "
          "dropoff_latitude FROM clean")
def q_fare_vs_coords(spark, sf):
    return ps.fare_vs_coords(cleaned(spark, sf))


WEEKDAY_LIST = "[" + ", ".join(f"'{w}'" for w in ps.WEEKDAYS) + "]"


@register("fare_series", W_CLEAN + "SELECT dimension, bucket, CASE WHEN dimension = 'day_of_week' THEN "
          f"CAST(list_position({WEEKDAY_LIST}, bucket) AS INTEGER) ELSE CAST(bucket AS INTEGER) END AS ordinal, "
          f"round(avg_fare, 6) AS avg_fare FROM ({AVG_ALL})")
def q_fare_series(spark, sf):
    return r6(ps.fare_series(cleaned(spark, sf)), "avg_fare")

# ---------------------------------------------------------------- streaming (T)


@register("stream_ingest", W_RIDES + "SELECT * FROM rides")
def q_stream_ingest(spark, sf):
    src = scratch_path(spark, "ride-files")
    write_rides_csv(rides(spark, sf), src)  # one file per input partition
    out = rs.run_to_parquet(rs.read_rides_stream(spark, src, ntz=True))
    return spark.read.parquet(out)


@register("stream_handover", W_RIDES + f"SELECT * FROM rides WHERE {q.FARE_FLOOR}")
def q_stream_handover(spark, sf):
    out = rs.handover_batches(fare_floor(rs.ride_stream_from_events(spark, sf)))
    return spark.read.parquet(out).drop("epoch")


def _stream_zone_query(name: str, area: str, where: str):
    @register(name, W_RIDES + f"SELECT * FROM rides WHERE {where}")
    def fn(spark, sf):
        stream = rs.stream_zone_sql(rs.ride_stream_from_events(spark, sf), area_sql(area), view=f"{name}_view")
        return spark.read.parquet(rs.run_to_parquet(stream))
    return fn


_stream_zone_query("stream_zone_sql", "bronx", q.box(ZONES["bronx"]))
for _z in ("jfk", "manhattan", "brooklyn", "staten_island"):
    _stream_zone_query(f"stream_zone_{_z}", _z, q.box(ZONES[_z]))
_stream_zone_query("stream_zone_inside", "inside", q.INSIDE_NYC)
_stream_zone_query("stream_zone_outside", "outside", f"NOT {q.INSIDE_NYC}")


@register("stream_clean_features", W_DIST + f"SELECT {CLEAN_COLS}, round(distance_km, 6) AS distance_km, "
          f"{q.COLOR} AS color FROM dist")
def q_stream_clean(spark, sf):
    out = rs.run_to_parquet(rs.stream_clean_features(rs.ride_stream_from_events(spark, sf)))
    return r6(spark.read.parquet(out), "distance_km")


@register("stream_avg_fare", W_CLEAN + "SELECT hour, round(avg(fare_amount), 6) AS avg_fare FROM clean GROUP BY hour")
def q_stream_avg(spark, sf):
    stream = clean_rides(rs.ride_stream_from_events(spark, sf))
    return r6(spark.read.parquet(rs.stream_avg_fare(stream, "hour")), "avg_fare")

@register("stream_avg_fare_all", W_CLEAN + "SELECT dimension, bucket, round(avg_fare, 6) AS avg_fare, n_rides "
          f"FROM ({AVG_ALL})")
def q_stream_avg_all(spark, sf):
    stream = clean_rides(rs.ride_stream_from_events(spark, sf))
    return r6(spark.read.parquet(rs.stream_avg_fare_all(stream)), "avg_fare")


@register("stream_slices", W_CLEAN + " UNION ALL ".join(
    f"SELECT '{n}' AS slice, key, pickup_longitude, pickup_latitude, fare_amount, {q.COLOR} AS color "
    f"FROM clean WHERE {p}" for n, p in (("snow", q.SNOW), ("midnight", q.MIDNIGHT), ("rush", q.RUSH))))
def q_stream_slices(spark, sf):
    """T5 slices: snow / midnight / rush tagging of the cleaned stream."""
    stream = clean_rides(rs.ride_stream_from_events(spark, sf))
    return spark.read.parquet(rs.run_to_parquet(ps.special_map(stream)))

# ---------------------------------------------------------------- keyed table (R)

# Change batch over the whole customer table (oracle text; Spark builds the
# same rows in one scan with ``change_batch``).
CHANGES_SQL = """
SELECT c_custkey, upper(c_name) AS c_name, c_acctbal + 100e0 AS c_acctbal, 'update' AS op, 1 AS seq
FROM {customer} WHERE c_mktsegment IN ('AUTOMOBILE', 'MACHINERY')
UNION ALL
SELECT c_custkey, c_name, c_acctbal, 'delete' AS op, 2 AS seq
FROM {customer} WHERE c_mktsegment = 'BUILDING' OR (c_mktsegment = 'MACHINERY' AND c_nationkey < 5)
UNION ALL
SELECT c_custkey + 1000000000 AS c_custkey, lower(c_name) AS c_name, c_acctbal, 'insert' AS op, 1 AS seq
FROM {customer} WHERE c_mktsegment = 'HOUSEHOLD'
UNION ALL
SELECT c_custkey, concat('dup ', c_name) AS c_name, c_acctbal, 'insert' AS op, 3 AS seq
FROM {customer} WHERE c_mktsegment = 'FURNITURE' AND c_nationkey < 3
"""
KEY = "c_custkey"
BASE_COLS = "c_custkey, c_name, c_acctbal"


def _customers(spark, sf) -> DataFrame:
    return read_table(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal")


def change_batch(customer: DataFrame) -> DataFrame:
    """The change batch of ``CHANGES_SQL`` in one scan: every customer row
    yields 0..n changes through ``explode`` of conditional structs."""
    seg, nation = F.col("c_mktsegment"), F.col("c_nationkey")

    def change(key, name, bal, op, seq):
        return F.struct(key.alias("c_custkey"), name.alias("c_name"), bal.alias("c_acctbal"),
                        F.lit(op).alias("op"), F.lit(seq).alias("seq"))
    k, n, b = F.col("c_custkey"), F.col("c_name"), F.col("c_acctbal")
    entries = F.array_compact(F.array(
        F.when(seg.isin("AUTOMOBILE", "MACHINERY"), change(k, F.upper(n), b + 100.0, "update", 1)),
        F.when((seg == "BUILDING") | ((seg == "MACHINERY") & (nation < 5)), change(k, n, b, "delete", 2)),
        F.when(seg == "HOUSEHOLD", change(k + 1000000000, F.lower(n), b, "insert", 1)),
        F.when((seg == "FURNITURE") & (nation < 3), change(k, F.concat(F.lit("dup "), n), b, "insert", 3))))
    return customer.select(F.explode(entries).alias("ch")).select("ch.*")


def _changes(spark, sf) -> DataFrame:
    return change_batch(read_table(spark, sf, "customer"))


KEYED_CTES = (f"base AS (SELECT {BASE_COLS} FROM customer)",
              "changes AS (" + CHANGES_SQL.replace("{customer}", "customer") + ")")
W_KEYED = q.with_(*KEYED_CTES)
LAST_SQL = ("last AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY c_custkey "
            "ORDER BY seq DESC, op DESC, c_name DESC, c_acctbal DESC) AS rn FROM changes) WHERE rn = 1)")


@register("keyed_scan", W_KEYED + "SELECT * FROM base")
def q_keyed_scan(spark, sf):
    return chg.keyed_scan(_customers(spark, sf))


@register("keyed_lookup", W_KEYED + "SELECT * FROM base WHERE c_custkey IN "
          "(SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')")
def q_keyed_lookup(spark, sf):
    keys = (read_table(spark, sf, "orders").filter(F.col("o_orderpriority") == "1-URGENT")
            .select(F.col("o_custkey").alias(KEY)))
    return chg.lookup_keys(_customers(spark, sf), keys, KEY)


@register("insert_new", W_KEYED + "SELECT * FROM base UNION ALL SELECT c.c_custkey, c.c_name, c.c_acctbal "
          "FROM (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY c_custkey ORDER BY c_name DESC, c_acctbal DESC) AS rn "
          "FROM changes WHERE op = 'insert') WHERE rn = 1) c WHERE c.c_custkey NOT IN (SELECT c_custkey FROM base)")
def q_insert_new(spark, sf):
    rows = _changes(spark, sf).filter(F.col("op") == "insert")
    return chg.insert_new(_customers(spark, sf), rows, KEY)


@register("update_matching", q.with_(*KEYED_CTES, LAST_SQL.replace(
    "FROM changes", "FROM changes WHERE op = 'update'")) +
    "SELECT b.c_custkey, CASE WHEN l.c_custkey IS NOT NULL THEN l.c_name ELSE b.c_name END AS c_name, "
    "CASE WHEN l.c_custkey IS NOT NULL THEN l.c_acctbal ELSE b.c_acctbal END AS c_acctbal "
    "FROM base b LEFT JOIN last l ON l.c_custkey = b.c_custkey")
def q_update_matching(spark, sf):
    rows = chg.latest_changes(_changes(spark, sf).filter(F.col("op") == "update"), KEY)
    return chg.update_matching(_customers(spark, sf), rows.select(KEY, "c_name", "c_acctbal"), KEY)


@register("delete_keys", W_KEYED + "SELECT * FROM base WHERE c_custkey NOT IN "
          "(SELECT c_custkey FROM changes WHERE op = 'delete')")
def q_delete_keys(spark, sf):
    keys = _changes(spark, sf).filter(F.col("op") == "delete")
    return chg.delete_keys(_customers(spark, sf), keys, KEY)


@register("apply_changes", q.with_(*KEYED_CTES, LAST_SQL) +
          "SELECT coalesce(b.c_custkey, l.c_custkey) AS c_custkey, "
          "CASE WHEN (b.c_custkey IS NOT NULL AND l.op = 'update') OR (b.c_custkey IS NULL AND l.op = 'insert') "
          "THEN l.c_name ELSE b.c_name END AS c_name, "
          "CASE WHEN (b.c_custkey IS NOT NULL AND l.op = 'update') OR (b.c_custkey IS NULL AND l.op = 'insert') "
          "THEN l.c_acctbal ELSE b.c_acctbal END AS c_acctbal "
          "FROM base b FULL OUTER JOIN last l ON l.c_custkey = b.c_custkey "
          "WHERE (b.c_custkey IS NOT NULL AND coalesce(l.op, '') <> 'delete') "
          "OR (b.c_custkey IS NULL AND l.op = 'insert')")
def q_apply_changes(spark, sf):
    return chg.apply_changes(_customers(spark, sf), _changes(spark, sf), KEY)


# ---------------------------------------------------------------- maps at many zooms


def _pyramid_sql() -> str:
    """Every zoom counted by itself."""
    sizes = [PYRAMID_CELLS << z for z in range(PYRAMID_ZOOMS)]
    counts = [f"SELECT {z} AS zoom, side, row, col, cnt FROM grid{z}" for z in range(PYRAMID_ZOOMS)]
    return q.with_(q.RIDES, q.CLEAN, *[_density_cte(n, n, f"grid{z}") for z, n in enumerate(sizes)]) + " UNION ALL ".join(counts)


@register("density_pyramid", _pyramid_sql())
def q_density_pyramid(spark, sf):
    return agg.density_pyramid(cleaned(spark, sf))


@register("density_pyramid_view", q.with_(q.RIDES, q.CLEAN, _density_cte()) +
          "SELECT side, row, col, cnt, round(density, 6) AS density, round(ln(1 + density), 6) AS log_density FROM grid")
def q_density_pyramid_view(spark, sf):
    """The 200 x 200 grid read from the merged pyramids of the rides of even and odd hours."""
    halves = [agg.density_pyramid(cleaned(spark, sf).filter(F.col("hour") % 2 == k)) for k in (0, 1)]
    return r6(agg.pyramid_view(agg.merge_pyramids(*halves), zoom=3), "density", "log_density")


# ---------------------------------------------------------------- stored results


def _clustered_rides(spark, sf, side: str) -> DataFrame:
    path = scratch_path(spark, "clustered")
    write_rides_clustered(rides(spark, sf), path, side)
    return spark.read.parquet(path)


@register("clustered_zone_manhattan", ORACLE["zone_manhattan"])
def q_clustered_zone(spark, sf):
    return zone_rides(_clustered_rides(spark, sf, "pickup"), "manhattan")


@register("clustered_box_filter", ORACLE["box_filter"])
def q_clustered_box(spark, sf):
    return box_filter(_clustered_rides(spark, sf, "dropoff"), NYC_BB_ZOOM)


def _stored_customers(spark, sf) -> KeyedStore:
    return KeyedStore.create(_customers(spark, sf), scratch_path(spark, "customers"), KEY, buckets=16)


@register("stored_apply_changes", ORACLE["apply_changes"])
def q_stored_apply_changes(spark, sf):
    """R3-R5 on a bucketed store: only touched buckets are rewritten."""
    store = _stored_customers(spark, sf)
    store.apply(_changes(spark, sf))
    return store.read()


@register("stored_lookup", W_KEYED + "SELECT * FROM base WHERE c_custkey IN (SELECT c_custkey FROM changes WHERE op = 'delete')")
def q_stored_lookup(spark, sf):
    return _stored_customers(spark, sf).lookup(_changes(spark, sf).filter(F.col("op") == "delete"))


@register("stream_epoch_log", ORACLE["stream_handover"])
def q_stream_epoch_log(spark, sf):
    stream = fare_floor(rs.ride_stream_from_events(spark, sf))
    log = ep.hand_over(stream, ep.EpochLog(spark, stream.schema))
    log.compact()
    return log.read()


def _delivered(spark, sf, times: int) -> str:
    """Rides as CSV files, each delivered ``times`` times."""
    src = scratch_path(spark, "deliveries")
    for _ in range(times):
        rides(spark, sf).repartition(3, "key").write.mode("append").option("header", True).option("timestampNTZFormat", CSV_TS_FORMAT).csv(src)
    return src


@register("stream_avg_fare_update", ORACLE["stream_avg_fare"])
def q_stream_avg_update(spark, sf):
    """T5 in update mode over several micro-batches."""
    stream = clean_rides(rs.read_rides_stream(spark, _delivered(spark, sf, 1), max_files_per_trigger=1, ntz=True))
    hourly = stream.groupBy("hour").agg(F.avg("fare_amount").alias("avg_fare"))
    return r6(ep.merge_updates(hourly, ["hour"], ep.EpochLog(spark, hourly.schema)).read(), "avg_fare")


@register("stream_zone_tags", ORACLE["zone_tags_join"])
def q_stream_zone_tags(spark, sf):
    """T3 against a stored zone table, reread for each of several micro-batches."""
    path = scratch_path(spark, "zones")
    zones_frame(spark).write.parquet(path)
    stream = rs.read_rides_stream(spark, _delivered(spark, sf, 1), max_files_per_trigger=1, ntz=True)
    log = ep.tag_with_zone_table(stream, lambda s: s.read.parquet(path), ep.EpochLog(spark, ep.tagged_schema(stream)))
    return log.read().select("key", "zone")


@register("stream_once_per_key", ORACLE["stream_ingest"])
def q_stream_once(spark, sf):
    """Every file delivered twice; a time span that holds the whole table."""
    stream = rs.read_rides_stream(spark, _delivered(spark, sf, 2), max_files_per_trigger=2, ntz=True)
    return spark.read.parquet(rs.run_to_parquet(ep.once_per_key(stream, late="36500 days")))


@register("stream_cleaning_report", ORACLE["cleaning_report"])
def q_stream_report(spark, sf):
    """C4 on a stream, over several micro-batches."""
    stream = rs.read_rides_stream(spark, _delivered(spark, sf, 1), max_files_per_trigger=1, ntz=True)
    kept, report = ep.EpochLog(spark, stream.schema), ep.EpochLog(spark, ep.report_schema(stream))
    ep.clean_and_report(stream, kept, report)
    return ep.summed_report(report, stream)


@register("csv_quarantine", W_RIDES + "SELECT CASE WHEN passenger_count IN (2, 3) THEN 'quarantined' ELSE 'good' END AS kind, count(*) AS n "
          "FROM rides GROUP BY 1")
def q_csv_quarantine(spark, sf):
    """Lines whose fare is no number, or that have a field too many, beside good ones."""
    src = scratch_path(spark, "lines")
    fields = [F.coalesce(F.date_format(c, CSV_TS_FORMAT) if c == "pickup_datetime" else F.col(c).cast("string"), F.lit("")) for c in RIDE_COLUMNS]
    pax = F.coalesce("passenger_count", F.lit(0))
    broken = [F.when(pax == 2, "n/a").otherwise(f) if c == "fare_amount" else f for c, f in zip(RIDE_COLUMNS, fields, strict=True)]
    rides(spark, sf).select(F.concat(F.concat_ws(",", *broken), F.when(pax == 3, ",extra").otherwise("")).alias("value")).write.text(src)
    parsed = parse_rides(spark.read.text(src), ntz=True)
    kinds = good_rides(parsed).select(F.lit("good").alias("kind")).unionByName(quarantined(parsed).select(F.lit("quarantined").alias("kind")))
    return kinds.groupBy("kind").agg(F.count(F.lit(1)).alias("n"))


def flagship(spark: SparkSession, sf: str) -> DataFrame:
    """rides -> clean -> features -> average fare by hour."""
    return QUERIES["avg_fare_hour"](spark, sf)

