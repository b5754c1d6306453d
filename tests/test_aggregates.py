"""Aggregations against brute force on small inputs, plus degenerate cases."""

import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF0001
from farelens.constants import NYC_BB, grid_constants
from farelens.functions.geo import with_distance
from farelens.operators import aggregates as agg
from farelens.operators.clean import clean_rides, cleaning_report
from farelens.sources.fixtures import load_rides
from farelens.sources.rides import RIDE_SCHEMA


def _hist_numpy(values, bins):
    vals = np.array([v for v in values if v is not None and not math.isnan(v)], dtype=float)
    if len(vals) == 0:
        return []
    counts, edges = np.histogram(vals, bins=bins)
    return list(zip(range(bins), edges[:-1], edges[1:], counts))


@pytest.mark.parametrize("bins", [2, 50, 7])
def test_histogram_matches_numpy(spark, bins):
    rnd = random.Random(bins)
    vals = [rnd.uniform(0, 30) for _ in range(3000)] + [0.0, 30.0, float("nan"), None] + [12.5] * 1000
    df = spark.createDataFrame([(v,) for v in vals], "distance_km double")
    got = sorted(tuple(r) for r in agg.distance_histogram(df, bins=bins).collect())
    exp = _hist_numpy(vals, bins)
    assert [g[0] for g in got] == [e[0] for e in exp]
    assert [g[3] for g in got] == [int(e[3]) for e in exp]
    for g, e in zip(got, exp):
        assert g[1] == pytest.approx(e[1], abs=1e-12) and g[2] == pytest.approx(e[2], abs=1e-12)


def test_histogram_on_edges_matches_numpy(spark):
    # values exactly on the numpy edges
    edges = np.linspace(1.0, 11.0, 51)
    vals = list(edges) * 3
    df = spark.createDataFrame([(float(v),) for v in vals], "distance_km double")
    got = [r["cnt"] for r in agg.distance_histogram(df, bins=50).orderBy("bin").collect()]
    assert got == list(np.histogram(vals, bins=50)[0])


def test_histogram_constant_and_empty(spark):
    df = spark.createDataFrame([(4.0,)] * 5, "distance_km double")
    rows = agg.distance_histogram(df, bins=2).orderBy("bin").collect()
    assert [(r["bin_lo"], r["bin_hi"], r["cnt"]) for r in rows] == [(3.5, 4.0, 0), (4.0, 4.5, 5)]
    empty = spark.createDataFrame([], "distance_km double")
    assert agg.distance_histogram(empty, bins=50).count() == 0


def test_grouped_histogram_matches_per_group(spark):
    rnd = random.Random(7)
    data = [("a", rnd.uniform(0, 5)) for _ in range(500)] + [("b", 2.0)] * 10 + [("c", float("nan"))]
    df = spark.createDataFrame(data, "zone string, distance_km double")
    got = agg.grouped_histogram(df, "zone", ["a", "b", "c", "absent"], bins=5).collect()
    by = {}
    for r in got:
        by.setdefault(r["zone"], []).append((r["bin"], r["cnt"]))
    assert "c" not in by
    assert [c for _, c in sorted(by["a"])] == list(np.histogram([v for z, v in data if z == "a"], bins=5)[0])
    assert [c for _, c in sorted(by["b"])] == [0, 0, 10, 0, 0]


def test_density_grid_matches_digitize(spark):
    rides = clean_rides(load_rides(spark, SF0001))
    pdf = rides.select("pickup_longitude", "pickup_latitude", "dropoff_longitude", "dropoff_latitude").toPandas()
    g = grid_constants()
    bins_lon = np.array([NYC_BB[0] + i * g["dlon"] for i in range(201)])
    bins_lat = np.array([NYC_BB[2] + j * g["dlat"] for j in range(201)])
    expected = {}
    for side in ("pickup", "dropoff"):
        ix = np.digitize(pdf[f"{side}_longitude"].to_numpy(), bins_lon)
        iy = np.digitize(pdf[f"{side}_latitude"].to_numpy(), bins_lat)
        for i, j in zip(ix, iy):
            if 1 <= i <= 200 and 1 <= j <= 200:
                key = (side, 200 - j, i - 1)
                expected[key] = expected.get(key, 0) + 1
    got = {(r["side"], r["row"], r["col"]): r["cnt"] for r in agg.density_grid(rides).collect()}
    assert got == expected
    one = agg.density_grid(rides).first()
    assert one["density"] == pytest.approx(one["cnt"] / (0.7186918074 * 0.7227670232), rel=1e-9)


def _described(spark, vals, **how):
    df = spark.createDataFrame([(v,) for v in vals], "distance_km double").repartition(4)
    return {r["stat"]: r["value"] for r in agg.describe_distance(df, **how).collect()}


CASES = {
    "hot value": lambda r: [r.lognormvariate(1, 1) for _ in range(4000)] + [2.0] * 2000 + [float("nan"), None],
    "heavy tail": lambda r: [r.paretovariate(1.1) for _ in range(20000)] + [1e6],
    "infinity": lambda r: [r.random() for _ in range(200)] + [math.inf],
    "mostly infinite": lambda r: [r.random() for _ in range(50)] + [math.inf] * 100,
    "all alike": lambda r: [3.5] * 1000,
    "two": lambda r: [1.0, 2.0],
    "one": lambda r: [7.0],
}


@pytest.mark.parametrize("accuracy", [50, 10_000])
@pytest.mark.parametrize("case", sorted(CASES))
def test_quartiles_match_numpy(spark, case, accuracy):
    vals = CASES[case](random.Random(3))
    got = _described(spark, vals, accuracy=accuracy)
    clean = sorted(v for v in vals if v is not None and not math.isnan(v))
    assert got["count"] == len(clean)
    for p in (25, 50, 75):
        place = (len(clean) - 1) * p / 100
        low, high = clean[math.floor(place)], clean[math.ceil(place)]
        want = low if low == high else low + (high - low) * (place - math.floor(place))
        assert got[f"{p}%"] == pytest.approx(want, rel=1e-12)


def test_describe_is_one_lazy_plan(spark):
    sc = spark.sparkContext
    df = with_distance(clean_rides(load_rides(spark, SF0001)))
    sc.setJobGroup("describe-plan", "nothing should run here")
    try:
        agg.describe_distance(df)
        assert not sc.statusTracker().getJobIdsForGroup("describe-plan")
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)


def test_grouped_histogram_has_no_join_and_no_exchange_on_the_group(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1")
    try:
        df = spark.createDataFrame([("a", 1.0), ("b", 2.0)] * 50, "zone string, distance_km double")
        plan = agg.grouped_histogram(df, "zone", ["a", "b"])._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "Join" not in plan
    assert all(re.search(r"bin#", x) for x in re.findall(r"hashpartitioning\(([^)]*)\)", plan)), plan


def test_describe_distance(spark):
    rides = with_distance(clean_rides(load_rides(spark, SF0001)))
    d = {r["stat"]: r["value"] for r in agg.describe_distance(rides).collect()}
    vals = np.array([r[0] for r in rides.select("distance_km").collect()])
    assert d["count"] == len(vals)
    assert d["mean"] == pytest.approx(vals.mean(), rel=1e-9)
    assert d["std"] == pytest.approx(vals.std(ddof=1), rel=1e-9)
    for name, p in (("25%", 25), ("50%", 50), ("75%", 75)):
        assert d[name] == pytest.approx(np.percentile(vals, p), rel=1e-12)
    approx = {r["stat"]: r["value"] for r in agg.describe_distance(rides, approx=True).collect()}
    assert approx["count"] == d["count"]


def test_cleaning_report_chains(spark):
    rep = cleaning_report(load_rides(spark, SF0001)).orderBy("step").collect()
    assert rep[0]["old_size"] == 1000
    for a, b in zip(rep, rep[1:]):
        assert a["new_size"] == b["old_size"]
    for r in rep:
        assert r["dropped"] == r["old_size"] - r["new_size"]
    assert rep[0]["new_size"] == 937  # FIXTURES: fare >= 2.5 at sf0.001


def test_cleaning_report_empty(spark):
    empty = spark.createDataFrame([], RIDE_SCHEMA)
    rep = cleaning_report(empty).collect()
    assert all(r["old_size"] == 0 and r["dropped_pct"] is None for r in rep)


def test_avg_fare_all_equals_single_dimension(spark):
    rides = clean_rides(load_rides(spark, SF0001))
    allg = agg.avg_fare_all(rides)
    for dim in ("month", "hour", "day_of_week", "year"):
        one = {r[0]: r[1] for r in agg.avg_fare_by(rides, dim).collect()}
        got = {r["bucket"]: r["avg_fare"] for r in allg.filter(F.col("dimension") == dim).collect()}
        assert got.keys() == one.keys()
        for k in one:
            assert got[k] == pytest.approx(one[k], rel=1e-12)


def test_mean_by_passengers_skips_nan(spark):
    df = spark.createDataFrame([(1, 2.0, 10.0), (1, float("nan"), 20.0), (2, 4.0, float("nan")), (None, 1.0, 1.0)],
                               "passenger_count int, distance_km double, fare_amount double")
    got = {r[0]: (r[1], r[2]) for r in agg.mean_by_passengers(df).collect()}
    assert got == {1: (2.0, 15.0), 2: (4.0, None)}


def test_usd_per_km_zero_distance(spark):
    df = spark.createDataFrame([(5.0, 0.0)], "fare_amount double, distance_km double")
    assert agg.usd_per_km(df).first()["usd_per_km"] is None
