"""Degenerate inputs (FIXTURES.md section 5): empty table, one row, all rows
dropped, all-equal distances. Every ride operator must run and give the
documented answer."""

import datetime as dt

import pytest

from farelens.functions.calendar import add_calendar_features
from farelens.functions.geo import with_distance, with_grid_cells
from farelens.operators import aggregates as agg
from farelens.operators.clean import clean_rides, cleaning_report, swap_repair
from farelens.operators.zones import inside_nyc, outside_nyc, tag_zones
from farelens.plans import plotsets as ps
from farelens.sources.rides import RIDE_SCHEMA

ONE = [("k1", 6.0, dt.datetime(2012, 6, 13, 12, 0), -73.98, 40.75, -73.95, 40.78, 1)]
DROPPED = [("k1", 1.0, dt.datetime(2012, 6, 13, 12, 0), -73.98, 40.75, -73.95, 40.78, 1)]


def _frames(spark, rows):
    raw = spark.createDataFrame(rows, RIDE_SCHEMA)
    cleaned = clean_rides(raw)
    return raw, cleaned, with_distance(cleaned)


OPERATORS = {
    "features": lambda raw, c, d: add_calendar_features(raw),
    "grid": lambda raw, c, d: with_grid_cells(raw),
    "swap": lambda raw, c, d: swap_repair(raw),
    "tags": lambda raw, c, d: tag_zones(raw),
    "inside": lambda raw, c, d: inside_nyc(raw),
    "outside": lambda raw, c, d: outside_nyc(raw),
    "avg_all": lambda raw, c, d: agg.avg_fare_all(c),
    "density": lambda raw, c, d: agg.density_grid(c),
    "hist": lambda raw, c, d: agg.distance_histogram(d),
    "bundle": lambda raw, c, d: ps.distance_bundle(d),
    "means": lambda raw, c, d: agg.mean_by_passengers(d),
    "usd": lambda raw, c, d: agg.usd_per_km(d),
    "describe": lambda raw, c, d: agg.describe_distance(d),
    "details": lambda raw, c, d: agg.zone_details(d),
    "area_map": lambda raw, c, d: ps.area_map(c),
    "special_map": lambda raw, c, d: ps.special_map(c),
    "street_map": lambda raw, c, d: ps.street_map(raw),
    "pd_map": lambda raw, c, d: ps.pickup_dropoff_map(c),
    "scatter": lambda raw, c, d: ps.distance_fare_scatter(d),
    "series": lambda raw, c, d: ps.fare_series(c),
    "slices": lambda raw, c, d: ps.slice_distances(d),
}


@pytest.mark.parametrize("case", ["empty", "one", "all_dropped"])
@pytest.mark.parametrize("op", sorted(OPERATORS))
def test_operators_run(spark, case, op):
    rows = {"empty": [], "one": ONE, "all_dropped": DROPPED}[case]
    out = OPERATORS[op](*_frames(spark, rows)).collect()
    if case != "one" and op in ("avg_all", "density", "hist", "bundle", "means", "details",
                                "area_map", "series", "slices", "scatter"):
        assert out == []


def test_describe_empty_and_one(spark):
    _, _, d = _frames(spark, [])
    vals = {r["stat"]: r["value"] for r in agg.describe_distance(d).collect()}
    assert vals["count"] == 0 and vals["50%"] is None
    _, _, d = _frames(spark, ONE)
    vals = {r["stat"]: r["value"] for r in agg.describe_distance(d).collect()}
    assert vals["count"] == 1 and vals["std"] is None and vals["25%"] == vals["75%"] == vals["max"]


def test_report_all_dropped(spark):
    raw, _, _ = _frames(spark, DROPPED)
    rep = {r["step_name"]: r for r in cleaning_report(raw).collect()}
    assert rep["fare_floor"]["dropped"] == 1 and rep["fare_floor"]["dropped_pct"] == 100.0
    assert rep["drop_missing"]["old_size"] == 0 and rep["drop_missing"]["dropped_pct"] is None


def test_density_map_empty_is_all_zero(spark):
    _, c, _ = _frames(spark, [])
    rows = ps.density_map(c).collect()
    assert len(rows) == 80_000 and all(r["cnt"] == 0 for r in rows)
