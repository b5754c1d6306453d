"""Plot datasets (D1-D11): the query behind every picture, drawing excluded.

Each returns a distributed DataFrame (points, series, cells) instead of
collecting columns to the driver; a plotting client reads it, sampled or
aggregated as it sees fit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import (GRID_N_LAT, GRID_N_LON, NYC_BB, NYC_BB_ZOOM, ZONES, ZOOM_MAX_DISTANCE_KM,
                         ZOOM_MAX_FARE)
from ..functions.calendar import SLICES, WEEKDAY_LABELS as WEEKDAYS
from ..functions.color import fare_color
from ..functions.geo import zoom_distance_fare
from ..operators.aggregates import avg_fare_all, density_grid, grouped_histogram, zone_details
from ..operators.zones import box_predicate, inside_nyc_predicate, tag_zones

AREAS = ("new_york", "brooklyn", "bronx", "manhattan", "jfk")


def _area_predicate(area: str) -> Column:
    return inside_nyc_predicate() if area == "new_york" else box_predicate(ZONES[area], "pickup")


def _explode_labels(df: DataFrame, labels: dict[str, Column], name: str) -> DataFrame:
    hits = F.array_compact(F.array(*[F.when(p, F.lit(k)) for k, p in labels.items()]))
    return df.withColumn(name, F.explode(hits))


def area_map(df: DataFrame, areas=AREAS) -> DataFrame:
    """Pickup points with fare colour per area (New York = F9, others
    F1-F5); a ride in overlapping areas appears once per area."""
    tagged = _explode_labels(df, {a: _area_predicate(a) for a in areas}, "area")
    return tagged.select("area", "key", "pickup_longitude", "pickup_latitude", "fare_amount",
                         fare_color().alias("color"))


def special_map(df: DataFrame) -> DataFrame:
    """Pickup points with colour for the snow / midnight / rush slices."""
    tagged = _explode_labels(df, {k: f(df) for k, f in SLICES.items()}, "slice")
    return tagged.select("slice", "key", "pickup_longitude", "pickup_latitude", "fare_amount",
                         fare_color().alias("color"))


def _two_series(df: DataFrame, *lead: str) -> DataFrame:
    ends = F.explode(F.array(*[
        F.struct(F.lit(side).alias("series"), F.col(f"{side}_longitude").alias("longitude"),
                 F.col(f"{side}_latitude").alias("latitude"))
        for side in ("pickup", "dropoff")]))
    return df.select(*lead, "key", ends.alias("p")).select(*lead, "p.series", "key", "p.longitude", "p.latitude")


def street_map(df: DataFrame) -> DataFrame:
    """D3: per pickup zone, the pickup series and the dropoff series."""
    return _two_series(tag_zones(df, "pickup"), "zone")


def pickup_dropoff_map(df: DataFrame) -> DataFrame:
    """Points of each side clipped to the wide and to the zoomed frame."""
    frames = {"wide": NYC_BB, "zoom": NYC_BB_ZOOM}
    panels = F.array_compact(F.array(*[
        F.when(box_predicate(bb, side),
               F.struct(F.lit(name).alias("frame"), F.lit(side).alias("side"),
                        F.col(f"{side}_longitude").alias("longitude"),
                        F.col(f"{side}_latitude").alias("latitude")))
        for name, bb in frames.items() for side in ("pickup", "dropoff")]))
    return df.select("key", F.explode(panels).alias("p")).select(
        "p.frame", "p.side", "key", "p.longitude", "p.latitude")


def density_map(df: DataFrame, n_lon: int = GRID_N_LON, n_lat: int = GRID_N_LAT) -> DataFrame:
    """Dense grid (every cell, zeros included) with log(1 + density).

    The dense frame has a fixed 2 x n_lat x n_lon rows; the sparse counts
    are joined onto it, both sides bounded by the grid size.
    """
    spark = df.sparkSession
    sparse = density_grid(df, NYC_BB, n_lon, n_lat).select("side", "row", "col", "cnt", "density")
    frame = (spark.range(n_lat * n_lon)
                  .select((F.col("id") / n_lon).cast("int").alias("row"),
                          (F.col("id") % n_lon).cast("int").alias("col"))
                  .withColumn("side", F.explode(F.array(F.lit("pickup"), F.lit("dropoff")))))
    joined = frame.join(sparse, ["side", "row", "col"], "left")
    density = F.coalesce(F.col("density"), F.lit(0.0))
    return joined.select("side", "row", "col",
                         F.coalesce(F.col("cnt"), F.lit(0).cast("bigint")).alias("cnt"),
                         density.alias("density"), F.log1p(density).alias("log_density"))


def distance_fare_scatter(df: DataFrame, zone: str | None = None) -> DataFrame:
    """Distance vs fare points, flagged when inside the zoom window
    (distance < 30 km and fare < 100). Expects ``distance_km``."""
    src = df.filter(box_predicate(ZONES[zone], "pickup")) if zone else df
    zoomed = F.coalesce((F.col("distance_km") < ZOOM_MAX_DISTANCE_KM) & (F.col("fare_amount") < ZOOM_MAX_FARE), F.lit(False))
    return src.select("key", "distance_km", "fare_amount", zoomed.alias("zoomed"))


def distance_bundle(df: DataFrame, bins: int = 50) -> DataFrame:
    """Per pickup zone, the distance histogram with the zone's own bins."""
    return grouped_histogram(tag_zones(df, "pickup"), "zone", list(ZONES), "distance_km", bins)


def distance_bundle_scatter(df: DataFrame) -> DataFrame:
    """Per pickup zone, the points of the zoomed scatter."""
    return tag_zones(zoom_distance_fare(df), "pickup").select("zone", "key", "distance_km", "fare_amount")


def distance_bundle_details(df: DataFrame) -> DataFrame:
    """Per pickup zone, the means by passenger count and USD per km."""
    return zone_details(df, "pickup")


SLICE_NAMES = ("midnight", "snow", "rush", "bronx", "brooklyn", "new_york", "manhattan", "jfk")


def slice_distances(df: DataFrame) -> DataFrame:
    """P3 per slice: the distance of every ride in each time slice and pickup
    area it belongs to, one scan for all slices (expects ``distance_km``)."""
    labels = {"midnight": SLICES["midnight"](df), "snow": SLICES["snow"](df), "rush": SLICES["rush"](df)}
    labels.update({a: _area_predicate(a) for a in ("bronx", "brooklyn", "new_york", "manhattan", "jfk")})
    return _explode_labels(df, labels, "slice").select("slice", "key", "distance_km")


def fare_vs_passengers(df: DataFrame) -> DataFrame:
    """One row per ride, aligned (one select, not one job per column)."""
    return df.select("key", "passenger_count", "fare_amount")


def fare_vs_time(df: DataFrame) -> DataFrame:
    """D9."""
    return df.select("key", "pickup_datetime", "fare_amount")


def fare_vs_coords(df: DataFrame) -> DataFrame:
    """Fare against the coordinates of each ride end."""
    return _two_series(df.select("key", "fare_amount", *[f"{s}_{c}" for s in ("pickup", "dropoff")
                                                         for c in ("longitude", "latitude")]),
                       "fare_amount").withColumnRenamed("series", "side")


def fare_series(df: DataFrame) -> DataFrame:
    """The four average-fare series with a calendar ordinal for the x axis."""
    a = avg_fare_all(df)
    weekday_pos = F.array_position(F.array(*[F.lit(w) for w in WEEKDAYS]), F.col("bucket")).cast("int")
    ordinal = (F.when(F.col("dimension") == "day_of_week", weekday_pos)
                .otherwise(F.col("bucket").cast("int")))
    return a.select("dimension", "bucket", ordinal.alias("ordinal"), "avg_fare")
