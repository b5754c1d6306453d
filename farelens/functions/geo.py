"""Geometry as native column expressions.

Everything here stays inside whole-stage codegen: no Python UDF, NULL in
gives NULL out, NaN in gives NaN out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import (EARTH_RADIUS_KM, GRID_N_LAT, GRID_N_LON, NYC_BB,
                         ZOOM_MAX_DISTANCE_KM, ZOOM_MAX_FARE, grid_constants)


def _c(x: str | Column) -> Column:
    return F.col(x) if isinstance(x, str) else x


def haversine_km(lat1, lon1, lat2, lon2) -> Column:
    """Great-circle distance in km, degrees in, double out.

    ``a`` is clamped to 1 so antipodal points give pi*R instead of NaN; the
    clamp leaves NULL and NaN alone (``least`` would not).
    """
    p1, l1, p2, l2 = (F.radians(_c(v)) for v in (lat1, lon1, lat2, lon2))
    s_lat = F.sin((p2 - p1) / 2)
    s_lon = F.sin((l2 - l1) / 2)
    a = s_lat * s_lat + F.cos(p1) * F.cos(p2) * s_lon * s_lon
    a = F.when((a > 1) & ~F.isnan(a), F.lit(1.0)).otherwise(a)
    return F.lit(2.0) * F.asin(F.sqrt(a)) * F.lit(EARTH_RADIUS_KM)


def ride_distance_km() -> Column:
    return haversine_km("pickup_latitude", "pickup_longitude",
                        "dropoff_latitude", "dropoff_longitude")


def with_distance(df: DataFrame, name: str = "distance_km") -> DataFrame:
    """Add the ride distance."""
    return df.withColumn(name, ride_distance_km())


def zoom_distance_fare(df: DataFrame) -> DataFrame:
    """distance < 30 km and fare < 100 (expects ``distance_km``)."""
    return df.filter((F.col("distance_km") < ZOOM_MAX_DISTANCE_KM)
                     & (F.col("fare_amount") < ZOOM_MAX_FARE))


def digitize(x: str | Column, lo: float, step: float, n: int) -> Column:
    """P5: index of ``x`` among the edges ``lo + k*step`` (k = 0..n).

    Returns the number of edges <= x, i.e. 0 below the grid, n+1 at or above
    the last edge and for NaN, NULL for NULL. One division gives an estimate
    that is off by at most one near an edge; it is corrected against the
    edges themselves, so points on an edge land exactly where the edge
    arithmetic puts them. The expression stays linear in size so it fits in
    one generated method.
    """
    x = _c(x).cast("double")

    def edge(k: Column) -> Column:
        return F.lit(lo) + k.cast("double") * F.lit(step)

    est = F.floor((x - F.lit(lo)) / F.lit(step)) + 1
    est = F.when(F.isnan(x), F.lit(n + 1)).when(est < 0, F.lit(0)).when(est > n + 1, F.lit(n + 1)).otherwise(est)
    too_high = F.when((est >= 1) & (edge(est - 1) > x), F.lit(1)).otherwise(F.lit(0))
    too_low = F.when((est <= n) & (edge(est) <= x), F.lit(1)).otherwise(F.lit(0))
    return F.when(x.isNull(), F.lit(None)).otherwise(est - too_high + too_low).cast("int")


def grid_cells(lon: str | Column, lat: str | Column, bb=NYC_BB,
               n_lon: int = GRID_N_LON, n_lat: int = GRID_N_LAT) -> tuple[Column, Column]:
    """(lon index, lat index), 1-based inside the grid, 0 / n+1 outside."""
    g = grid_constants(bb, n_lon, n_lat)
    return (digitize(lon, g["lon0"], g["dlon"], n_lon),
            digitize(lat, g["lat0"], g["dlat"], n_lat))


def log_density(x: str | Column) -> Column:
    """log(1 + d)."""
    return F.log1p(_c(x))


def with_grid_cells(df: DataFrame, bb=NYC_BB, n_lon: int = GRID_N_LON, n_lat: int = GRID_N_LAT) -> DataFrame:
    """P5 on both ride ends: ``{side}_ix`` / ``{side}_iy`` (1-based inside)."""
    cols = {}
    for side in ("pickup", "dropoff"):
        ix, iy = grid_cells(f"{side}_longitude", f"{side}_latitude", bb, n_lon, n_lat)
        cols[f"{side}_ix"], cols[f"{side}_iy"] = ix, iy
    return df.withColumns(cols)
