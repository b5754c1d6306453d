"""Zone boxes and geographic filters (F1-F10, F15) and zone tagging.

Coordinates stay float32 and are compared with double literals, so a box
edge is decided by float32 rounding exactly as in the published queries.
Filters are plain comparisons, so Parquet scans receive them as
``PushedFilters``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..constants import INSIDE_NYC_DROPOFF, INSIDE_NYC_PICKUP, ZONES

SIDES = ("pickup", "dropoff")


def _lonlat(side: str) -> tuple[str, str]:
    if side not in SIDES:
        raise ValueError(f"side must be one of {SIDES}, got {side!r}")
    return f"{side}_longitude", f"{side}_latitude"


def box_predicate(bb, side: str = "pickup") -> Column:
    """Closed box on one ride end."""
    lon, lat = _lonlat(side)
    return F.col(lon).between(bb[0], bb[1]) & F.col(lat).between(bb[2], bb[3])


def box_predicate_both_ends(bb) -> Column:
    return box_predicate(bb, "pickup") & box_predicate(bb, "dropoff")


def zone_box(zone: str):
    try:
        return ZONES[zone]
    except KeyError:
        raise ValueError(f"unknown zone {zone!r}; known: {sorted(ZONES)}") from None


def zone_rides(df: DataFrame, zone: str, side: str = "pickup") -> DataFrame:
    """Rides whose pickup (or dropoff) lies in the named box."""
    return df.filter(box_predicate(zone_box(zone), side))


def box_filter(df: DataFrame, bb) -> DataFrame:
    """F8: both ends inside ``bb``."""
    return df.filter(box_predicate_both_ends(bb))


def inside_nyc_predicate() -> Column:
    return box_predicate(INSIDE_NYC_PICKUP, "pickup") & box_predicate(INSIDE_NYC_DROPOFF, "dropoff")


def inside_nyc(df: DataFrame) -> DataFrame:
    """pickup and dropoff in their (different) New York boxes."""
    return df.filter(inside_nyc_predicate())


def outside_nyc(df: DataFrame) -> DataFrame:
    """NOT F9 under three-valued logic. A ride with a NULL coordinate is
    outside when another coordinate already rules it out, and in neither set
    otherwise; a NaN coordinate lies above every bound, hence outside."""
    return df.filter(~inside_nyc_predicate())


def extent_clip(df: DataFrame, bb, side: str = "pickup") -> DataFrame:
    """one side's points inside a plot frame, as (key, lon, lat)."""
    lon, lat = _lonlat(side)
    return (df.filter(box_predicate(bb, side))
              .select("key", F.col(lon).alias("longitude"), F.col(lat).alias("latitude")))


def box_sql(bb, side: str = "pickup") -> str:
    """``box_predicate`` as SQL text, for filters on views."""
    lon, lat = _lonlat(side)
    return f"{lon} BETWEEN {bb[0]!r}D AND {bb[1]!r}D AND {lat} BETWEEN {bb[2]!r}D AND {bb[3]!r}D"


def area_sql(area: str) -> str:
    """A named zone, ``inside`` or ``outside`` New York, as SQL text."""
    if area in ("inside", "outside"):
        inside = f"({box_sql(INSIDE_NYC_PICKUP)} AND {box_sql(INSIDE_NYC_DROPOFF, 'dropoff')})"
        return inside if area == "inside" else f"NOT {inside}"
    return box_sql(zone_box(area))


def zones_frame(spark: SparkSession) -> DataFrame:
    """The zone dimension as a DataFrame (5 rows)."""
    rows = [(z, *bb) for z, bb in ZONES.items()]
    return spark.createDataFrame(rows, "zone string, lon_min double, lon_max double, "
                                       "lat_min double, lat_max double")


def zone_names(side: str = "pickup") -> Column:
    """Array of the built-in zones containing the ride end (0..n names).

    The built-in dimension is a fixed handful of boxes, so tagging is a
    projection: no join and no shuffle.
    """
    hits = [F.when(box_predicate(bb, side), F.lit(z)) for z, bb in ZONES.items()]
    return F.array_compact(F.array(*hits))


def tag_zones(df: DataFrame, side: str = "pickup", keep_untagged: bool = False) -> DataFrame:
    """one output row per (ride, zone containing it); boxes overlap, so a
    ride can get several rows. ``keep_untagged`` keeps zone-less rides with
    a NULL zone."""
    explode = F.explode_outer if keep_untagged else F.explode
    return df.withColumn("zone", explode(zone_names(side)))


def _cell(x: Column, level: Column) -> Column:
    return F.floor(x.cast("double") / F.pow(F.lit(2.0), level)).cast("long")


def tag_zones_with(df: DataFrame, zones: DataFrame, side: str = "pickup") -> DataFrame:
    """F7 against any zone table (zone, lon_min, lon_max, lat_min, lat_max).

    Every box gets the grid whose cells (of 2 ** level degrees) are just not
    smaller than itself, so it covers at most two cells by two, however wide
    it is. Rides are laid on the grids that some box uses (a few dozen levels
    at most, one array from a scalar subquery) and joined on the cell; the
    exact box test decides. A zone table small enough is broadcast by the
    planner; otherwise the join is shuffled and AQE splits crowded cells.
    """
    lon, lat = _lonlat(side)
    # Bounds beyond any coordinate stand for infinite ones.
    held = lambda c: F.greatest(F.lit(-1e6), F.least(F.lit(1e6), F.col(c).cast("double")))
    z = zones.select("zone", "lon_min", "lon_max", "lat_min", "lat_max").filter("lon_min <= lon_max AND lat_min <= lat_max")
    width = F.greatest(held("lon_max") - held("lon_min"), held("lat_max") - held("lat_min"), F.lit(2.0 ** -20))
    z = z.withColumn("_level", F.ceil(F.log2(width)).cast("int"))
    cells = (z.withColumn("_cx", F.explode(F.sequence(_cell(held("lon_min"), F.col("_level")), _cell(held("lon_max"), F.col("_level")))))
              .withColumn("_cy", F.explode(F.sequence(_cell(held("lat_min"), F.col("_level")), _cell(held("lat_max"), F.col("_level"))))))
    levels = z.agg(F.collect_set("_level").alias("l")).scalar()
    known = F.col(lon).isNotNull() & F.col(lat).isNotNull() & ~F.isnan(lon) & ~F.isnan(lat)
    r = df.filter(known).withColumn("_level", F.explode(levels))
    r = r.withColumn("_cx", _cell(F.col(lon), F.col("_level"))).withColumn("_cy", _cell(F.col(lat), F.col("_level")))
    exact = (F.col(lon).between(F.col("lon_min"), F.col("lon_max"))
             & F.col(lat).between(F.col("lat_min"), F.col("lat_max")))
    return (r.join(cells, ["_level", "_cx", "_cy"]).filter(exact)
             .drop("_level", "_cx", "_cy", "lon_min", "lon_max", "lat_min", "lat_max"))
