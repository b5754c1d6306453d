"""Fixed values shared by every operator.

All numbers here must stay exactly as written: result parity depends on them
(box edges are compared against float32 coordinates, grid edges are rebuilt
from them bit for bit).
"""

from __future__ import annotations

import math

# --- fixed values: zone boxes as (lon_min, lon_max, lat_min, lat_max) ---------
ZONES: dict[str, tuple[float, float, float, float]] = {
    "jfk": (-73.81, -73.77, 40.63, 40.67),
    "manhattan": (-74.02, -73.93, 40.70, 40.85),
    "brooklyn": (-74.01, -73.96, 40.62, 40.70),
    "bronx": (-73.935, -73.88, 40.79, 40.89),
    "staten_island": (-74.20, -74.10, 40.50, 40.62),
}

# --- fixed values: map frames (not tagged zones) -----------------------------
NYC_BB = (-74.5, -72.8, 40.5, 41.8)
NYC_BB_ZOOM = (-74.3, -73.7, 40.5, 40.9)

# --- fixed values: "inside New York" test, pickup and dropoff boxes differ ----
INSIDE_NYC_PICKUP = (-74.5, -72.8, 40.573143, 41.709555)
INSIDE_NYC_DROPOFF = (-74.252193, -72.986532, 40.5, 41.8)

# --- fixed values: cleaning, time slices, colours, sizes ---------------------
MIN_FARE = 2.5
RUSH_HOURS = (16, 20)          # inclusive
DAY_HOURS = (7, 22)            # "midnight" is everything outside, inclusive
SNOW_MONTHS = (1, 2)           # inclusive
COLOR_LOW, COLOR_HIGH = 5.0, 10.0   # < 5 'r', strictly between 'y', else 'b'
ZOOM_MAX_DISTANCE_KM, ZOOM_MAX_FARE = 30.0, 100.0
EARTH_RADIUS_KM = 6371.0
GRID_N_LON, GRID_N_LAT = 200, 200
DEFAULT_ROW_CAP = 400
# Own choice: zoom 3 of the pyramid is the 200 x 200 grid, zoom 6 has cells of 1/1600.
PYRAMID_CELLS, PYRAMID_ZOOMS = 25, 7
HIST_BINS = 50
HIST_BINS_NOTEBOOK = 2

RIDE_COORDS = ("pickup_longitude", "pickup_latitude", "dropoff_longitude", "dropoff_latitude")


def haversine_py(lat1: float, lon1: float, lat2: float, lon2: float) -> float:
    """Scalar great-circle distance in km, used only to fold grid constants."""
    p1, l1, p2, l2 = (math.radians(v) for v in (lat1, lon1, lat2, lon2))
    s_lat, s_lon = math.sin((p2 - p1) / 2), math.sin((l2 - l1) / 2)
    a = s_lat * s_lat + math.cos(p1) * math.cos(p2) * s_lon * s_lon
    return 2 * math.asin(math.sqrt(min(a, 1.0))) * EARTH_RADIUS_KM


def grid_constants(bb=NYC_BB, n_lon: int = GRID_N_LON, n_lat: int = GRID_N_LAT) -> dict[str, float]:
    """Edge steps and the (constant) cell size of the density grid.

    Cell width is measured along the south edge, height along the west edge.
    """
    lon0, lon1, lat0, lat1 = bb
    width = haversine_py(lat0, lon1, lat0, lon0) / n_lon
    height = haversine_py(lat1, lon0, lat0, lon0) / n_lat
    return {
        "lon0": lon0,
        "lat0": lat0,
        "dlon": (lon1 - lon0) / n_lon,
        "dlat": (lat1 - lat0) / n_lat,
        "cell_width_km": width,
        "cell_height_km": height,
        "cell_area_km2": width * height,
    }
