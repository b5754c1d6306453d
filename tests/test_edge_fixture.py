"""Hand-made rides with the expected values of FIXTURES.md section 3."""

import math

import pytest
from pyspark.sql import functions as F

from conftest import EDGE, keys
from farelens.functions.calendar import add_calendar_features, midnight_rides, rush_hour_rides, snow_season_rides
from farelens.functions.color import fare_color
from farelens.functions.geo import with_distance, with_grid_cells
from farelens.operators.clean import drop_missing, drop_zeros, fare_floor, swap_repair
from farelens.operators.zones import inside_nyc, outside_nyc, tag_zones, zone_rides

ALL = sorted(EDGE)


def test_fare_floor(edge):
    dropped = set(ALL) - set(keys(fare_floor(edge)))
    assert dropped == {"e02", "e03", "e08"}  # NaN (e04) passes


def test_drop_missing(edge):
    dropped = set(ALL) - set(keys(drop_missing(edge)))
    assert dropped == {"e03", "e04", "e14", "e15"}


def test_drop_zeros(edge):
    dropped = set(ALL) - set(keys(drop_zeros(edge)))
    assert dropped == {"e12", "e13", "e14"}  # NaN (e15) passes


def test_fare_color(edge):
    got = {r["key"]: r["c"] for r in edge.select("key", fare_color().alias("c")).collect()}
    assert got["e01"] == "r" and got["e08"] == "r"
    assert got["e03"] is None
    assert got["e04"] == "b" and got["e05"] == "b" and got["e06"] == "b"
    assert got["e07"] == "y"
    assert got["e00"] == "y"  # 6.0


def test_zone_float32_edges(edge):
    tags = {}
    for r in tag_zones(edge, "pickup").select("key", "zone").collect():
        tags.setdefault(r["key"], set()).add(r["zone"])
    assert "e09" not in tags
    assert tags["e10"] == {"manhattan", "bronx"}
    assert tags["e11"] == {"manhattan"}
    assert "e16" not in tags
    assert tags["e00"] == {"manhattan"}
    assert "e09" not in keys(zone_rides(edge, "brooklyn"))


def test_zone_tags_equal_union_of_filters(edge):
    from farelens.constants import ZONES
    tagged = {(r["key"], r["zone"]) for r in tag_zones(edge).select("key", "zone").collect()}
    union = {(k, z) for z in ZONES for k in keys(zone_rides(edge, z))}
    assert tagged == union


def test_inside_outside(edge):
    ins, outs = set(keys(inside_nyc(edge))), set(keys(outside_nyc(edge)))
    assert not ins & outs
    assert "e14" not in ins | outs  # NULL coordinate: neither
    assert "e16" in outs and "e22" in outs and "e00" in ins


def test_distance(edge):
    d = {r["key"]: r["distance_km"] for r in with_distance(edge).select("key", "distance_km").collect()}
    assert d["e00"] == pytest.approx(4.184873, abs=1e-6)
    assert d["e12"] == pytest.approx(6026.79771, abs=1e-5)
    assert d["e14"] is None
    assert math.isnan(d["e15"])
    assert d["e22"] == pytest.approx(202.860471, abs=1e-6)
    assert d["e23"] == 0.0
    assert d["e24"] == pytest.approx(20015.086796, abs=1e-6)


def test_distance_symmetric(edge):
    swapped = edge.select("key", F.col("dropoff_longitude").alias("pickup_longitude"),
                          F.col("dropoff_latitude").alias("pickup_latitude"),
                          F.col("pickup_longitude").alias("dropoff_longitude"),
                          F.col("pickup_latitude").alias("dropoff_latitude"))
    a = {r[0]: r[1] for r in with_distance(edge).select("key", "distance_km").collect()}
    b = {r[0]: r[1] for r in with_distance(swapped).select("key", "distance_km").collect()}
    for k in a:
        if a[k] is None or math.isnan(a[k]):
            continue
        assert a[k] == pytest.approx(b[k], rel=1e-12, abs=1e-9)


def test_grid_cells(edge):
    g = {r["key"]: r for r in with_grid_cells(edge).collect()}
    assert (g["e00"]["pickup_ix"], g["e00"]["pickup_iy"]) == (62, 39)
    assert (g["e00"]["dropoff_ix"], g["e00"]["dropoff_iy"]) == (65, 44)
    assert g["e12"]["pickup_ix"] == 201
    assert g["e15"]["pickup_ix"] == 201
    assert g["e14"]["pickup_ix"] is None
    assert (g["e22"]["pickup_ix"], g["e22"]["pickup_iy"]) == (1, 1)
    assert (g["e22"]["dropoff_ix"], g["e22"]["dropoff_iy"]) == (200, 200)
    assert (g["e23"]["dropoff_ix"], g["e23"]["dropoff_iy"]) == (62, 39)


def test_calendar_slices(edge):
    mid, snow, rush = (set(keys(f(edge))) for f in (midnight_rides, snow_season_rides, rush_hour_rides))
    assert {"e17"} <= mid and "e18" not in mid and "e19" not in mid
    assert {"e17", "e19"} <= snow and "e18" not in snow
    assert {"e20", "e21"} <= rush
    dow = {r["key"]: r["day_of_week"] for r in add_calendar_features(edge).collect()}
    assert dow["e17"] == "Sun" and dow["e18"] == "Mon"
    feats = add_calendar_features(edge).filter(F.col("key") == "e19").first()
    assert (feats["year"], feats["month"], feats["hour"], feats["time"]) == ("2010", "2", "22", "22:59:59")


def test_calendar_features_stateless(edge):
    once = add_calendar_features(edge)
    twice = add_calendar_features(once)
    assert once.columns == twice.columns
    assert sorted(once.collect()) == sorted(twice.collect()) or once.exceptAll(twice).count() == 0


def test_swap_repair(edge):
    fixed = swap_repair(edge)
    assert "e16" in keys(zone_rides(fixed, "manhattan"))
    flags = {r["key"]: (r["pickup_swapped"], r["dropoff_swapped"]) for r in fixed.collect()}
    assert flags["e16"] == (True, True) and flags["e00"] == (False, False)
    cols = [c for c in edge.columns]
    again = swap_repair(fixed.select(*cols)).select(*cols)
    assert again.exceptAll(fixed.select(*cols)).count() == 0


def test_zone_dimension_join(spark, edge):
    from farelens.operators.zones import tag_zones_with, zones_frame
    expected = sorted((r["key"], r["zone"]) for r in tag_zones(edge).select("key", "zone").collect())
    got = tag_zones_with(edge, zones_frame(spark), "pickup")
    assert sorted((r["key"], r["zone"]) for r in got.select("key", "zone").collect()) == expected


def test_zone_join_wide_boxes_points_and_a_crowded_cell(spark, edge):
    """Boxes from a point to the whole world against every ride, one by one;
    most rides stand in one place."""
    from farelens.operators.zones import tag_zones_with
    boxes = [("world", -180.0, 180.0, -90.0, 90.0), ("all", float("-inf"), float("inf"), float("-inf"), float("inf")), ("point", 0.5, 0.5, 0.5, 0.5),
             ("strip", -75.0, -73.0, -90.0, 90.0), ("inverted", 1.0, -1.0, 0.0, 1.0), ("tiny", -73.9801, -73.9799, 40.7499, 40.7501)]
    zones = spark.createDataFrame(boxes, "zone string, lon_min double, lon_max double, lat_min double, lat_max double")
    df = edge.unionByName(edge.filter("key = 'e00'").withColumn("n", F.explode(F.sequence(F.lit(1), F.lit(500)))).drop("n"))
    want = sorted((r["key"], z) for r in df.collect() for z, a, b, c, d in boxes
                  if r["pickup_longitude"] is not None and r["pickup_latitude"] is not None
                  and a <= r["pickup_longitude"] <= b and c <= r["pickup_latitude"] <= d)
    got = tag_zones_with(df, zones)
    assert sorted((r["key"], r["zone"]) for r in got.select("key", "zone").collect()) == want
    assert "NestedLoop" not in got._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_calendar_features_of_a_missing_time_are_missing(spark, kind):
    df = spark.createDataFrame([(None,)], f"pickup_datetime {kind}")
    assert set(add_calendar_features(df).first()[1:]) == {None}


def test_outside_with_missing_coordinates(spark, edge):
    """A NULL leaves the answer to the other coordinates; NaN is above all."""
    import conftest
    rows = [("null, far north", {"plon": None, "plat": 60.0}), ("null, inside", {"plon": None}), ("nan", {"plon": float("nan")})]
    made = [(k, *[{**conftest.BASE, **d}[c] for c in ("fare", "ts", "plon", "plat", "dlon", "dlat", "pax")]) for k, d in rows]
    df = spark.createDataFrame(made, edge.schema)
    assert keys(outside_nyc(df)) == ["nan", "null, far north"] and keys(inside_nyc(df)) == []


def test_calendar_features_ignore_session_zone_for_ntz(spark):
    import datetime as dt
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        # 02:30 on 2012-03-11 does not exist in New York (clocks jump 02:00 -> 03:00)
        df = spark.createDataFrame([(dt.datetime(2012, 3, 11, 2, 30, 5),)], "pickup_datetime timestamp_ntz")
        r = add_calendar_features(df).first()
        assert (r["year"], r["month"], r["day_of_week"], r["hour"], r["time"]) == \
            ("2012", "3", "Sun", "02", "02:30:05")
        assert keys(rush_hour_rides(df.withColumn("key", F.lit("x")))) == []
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
