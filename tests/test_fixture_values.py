"""Values published for the derived ride table (FIXTURES.md section 2),
recomputed with the library operators."""

import pytest
from pyspark.sql import functions as F

from conftest import SF0001, SF001
from farelens.constants import ZONES
from farelens.functions.geo import with_distance
from farelens.operators import aggregates as agg
from farelens.operators.clean import fare_floor, swap_repair
from farelens.operators.zones import zone_rides
from farelens.functions.calendar import snow_season_rides
from farelens.sources.fixtures import load_rides

EXPECTED = {
    SF0001: dict(rows=1000, floor=937, five=4, snow=156, swapped=11,
                 pickup=(9, 55, 17, 22, 44), dropoff=(6, 59, 15, 17, 53), cells=(645, 3),
                 dist=168037.051495),
    SF001: dict(rows=10000, floor=9294, five=50, snow=1614, swapped=109,
                pickup=(97, 533, 162, 225, 460), dropoff=(67, 564, 161, 227, 495), cells=(1927, 9),
                dist=1687114.905667),
}
ORDER = ("jfk", "manhattan", "brooklyn", "bronx", "staten_island")


@pytest.mark.parametrize("sf", [SF0001, SF001])
def test_published_fixture_values(spark, sf):
    e = EXPECTED[sf]
    rides = load_rides(spark, sf)
    assert rides.count() == e["rows"]
    assert fare_floor(rides).count() == e["floor"]
    assert rides.filter(F.col("fare_amount") == 5.0).count() == e["five"]
    assert snow_season_rides(rides).count() == e["snow"]
    sw = swap_repair(rides).filter(F.col("pickup_swapped") & F.col("dropoff_swapped"))
    assert sw.count() == e["swapped"]
    assert tuple(zone_rides(rides, z, "pickup").count() for z in ORDER) == e["pickup"]
    assert tuple(zone_rides(rides, z, "dropoff").count() for z in ORDER) == e["dropoff"]
    grid = agg.density_grid(rides).filter(F.col("side") == "pickup")
    assert (grid.count(), grid.agg(F.max("cnt")).first()[0]) == e["cells"]
    dist = with_distance(rides.filter(F.col("passenger_count") != 0)).agg(F.sum("distance_km")).first()[0]
    assert round(dist, 6) == pytest.approx(e["dist"], abs=2e-6)
    assert set(ORDER) == set(ZONES)
