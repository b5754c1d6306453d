"""Clustered store, zone table on a stream, grid pyramid."""

import glob

import pyarrow.parquet as pq
import pytest
from conftest import SF001, edge_rows, keys
from pyspark.sql import functions as F

from farelens.constants import NYC_BB, NYC_BB_ZOOM, ZONES
from farelens.operators import aggregates as agg
from farelens.operators.zones import tag_zones_with, zone_rides, zones_frame
from farelens.plans import catalog
from farelens.session import scratch_path
from farelens.sources.clustered import KEY_BITS, write_rides_clustered, z_order_key
from farelens.sources.rides import RIDE_SCHEMA
from farelens.streaming import epochs as ep
from farelens.streaming import rides_stream as rs


def plain_key(lon, lat):
    if lon is None or lat is None or not (NYC_BB[0] <= lon <= NYC_BB[1] and NYC_BB[2] <= lat <= NYC_BB[3]):
        return -1
    steps = 1 << KEY_BITS
    x = min(int((lon - NYC_BB[0]) / (NYC_BB[1] - NYC_BB[0]) * steps), steps - 1)
    y = min(int((lat - NYC_BB[2]) / (NYC_BB[3] - NYC_BB[2]) * steps), steps - 1)
    return int("".join(b + a for a, b in zip(f"{x:0{KEY_BITS}b}", f"{y:0{KEY_BITS}b}", strict=True)), 2)


def test_z_order_key(spark, edge):
    got = {r.key: r.z for r in edge.withColumn("z", z_order_key("pickup_longitude", "pickup_latitude")).collect()}
    assert got == {r.key: plain_key(r.pickup_longitude, r.pickup_latitude) for r in edge.collect()}
    corners = spark.createDataFrame([(NYC_BB[0], NYC_BB[2]), (NYC_BB[1], NYC_BB[3]), (None, 40.7), (float("nan"), 40.7)], "x double, y double")
    assert [r[0] for r in corners.select(z_order_key("x", "y")).collect()] == [0, (1 << 2 * KEY_BITS) - 1, -1, -1]


def row_groups(path):
    for name in glob.glob(f"{path}/*.parquet"):
        meta = pq.ParquetFile(name).metadata
        at = {meta.row_group(0).column(c).path_in_schema: c for c in range(meta.num_columns)}
        for g in range(meta.num_row_groups):
            yield [meta.row_group(g).column(at[f"pickup_{c}"]).statistics for c in ("longitude", "latitude")]


def test_a_zone_reads_few_row_groups(spark):
    """Rides all over the frame, some of them without a place."""
    u = lambda seed, lo, hi: (F.rand(seed) * (hi - lo) + lo).cast("float")
    rides = spark.range(40_000).repartition(4).select(
        F.col("id").cast("string").alias("key"), F.when(F.col("id") % 50 == 0, F.lit(0.0).cast("float")).otherwise(u(1, *NYC_BB[:2])).alias("pickup_longitude"),
        F.when(F.col("id") % 77 != 0, u(2, *NYC_BB[2:])).alias("pickup_latitude"))
    path, plain = scratch_path(spark, "t-clustered"), scratch_path(spark, "t-plain")
    rides.write.parquet(plain)
    rides = spark.read.parquet(plain)
    write_rides_clustered(rides, path, files=64)
    stored = spark.read.parquet(path)
    assert stored.schema == rides.schema and sorted(map(str, stored.collect())) == sorted(map(str, rides.collect()))
    meets = lambda s, lo, hi: s is None or not s.has_min_max or (s.min <= hi and s.max >= lo)
    groups = list(row_groups(path))
    assert len(groups) >= 60
    for zone, bb in ZONES.items():
        read = sum(meets(lon, *bb[:2]) and meets(lat, *bb[2:]) for lon, lat in groups)
        assert read * 4 < len(groups), (zone, read)
        assert keys(zone_rides(stored, zone)) == keys(zone_rides(rides, zone))
    plan = zone_rides(stored, "jfk")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(pickup_longitude), IsNotNull(pickup_latitude), GreaterThanOrEqual(pickup_longitude" in plan


def test_one_place_holds_most_rides(spark):
    """Rides at one place are spread over files; empty tables are written too."""
    rides = spark.range(8000).select(F.col("id").cast("string").alias("key"), F.lit(-73.98).cast("float").alias("pickup_longitude"),
                                     F.lit(40.75).cast("float").alias("pickup_latitude"))
    path, empty = scratch_path(spark, "t-hot"), scratch_path(spark, "t-none")
    write_rides_clustered(rides, path, files=8)
    sizes = [pq.ParquetFile(f).metadata.num_rows for f in glob.glob(f"{path}/*.parquet")]
    assert sum(sizes) == 8000 and max(sizes) < 2000
    write_rides_clustered(rides.limit(0), empty)
    assert spark.read.parquet(empty).count() == 0
    with pytest.raises(ValueError):
        write_rides_clustered(rides, path, side="middle")


def test_zone_table_on_a_stream(spark):
    src, table, ckpt = (scratch_path(spark, f"t-{x}") for x in ("rides", "zones", "ckpt"))
    rows, zones = edge_rows(), zones_frame(spark)
    deliver = lambda part: spark.createDataFrame(part, RIDE_SCHEMA).coalesce(1).write.mode("append").option("header", True).csv(src)
    zones.filter("zone <> 'manhattan'").write.parquet(table)
    deliver(rows[::2])
    stream = rs.read_rides_stream(spark, src, max_files_per_trigger=1)
    log = ep.EpochLog(spark, ep.tagged_schema(stream))
    read = lambda s: s.read.parquet(table)
    pairs = lambda df: sorted((r.key, r.zone) for r in df.select("key", "zone").collect())
    want = lambda part, z: pairs(tag_zones_with(spark.createDataFrame(part, RIDE_SCHEMA), z))
    ep.tag_with_zone_table(stream, read, log, checkpoint=ckpt)
    first = want(rows[::2], zones.filter("zone <> 'manhattan'"))
    assert pairs(log.read()) == first and first
    zones.filter("zone = 'manhattan'").write.mode("append").parquet(table)
    deliver(rows[1::2])
    ep.tag_with_zone_table(stream, read, log, checkpoint=ckpt)
    assert pairs(log.read()) == sorted(first + want(rows[1::2], zones))  # what was tagged before stays


def cells(df):
    return sorted(map(tuple, df.select("side", "row", "col", "cnt").collect()))


@pytest.fixture(scope="module")
def pyramid(spark):
    return agg.density_pyramid(catalog.rides(spark, SF001), zooms=4).persist()


def test_every_zoom_is_a_count_of_its_own(spark, pyramid, edge):
    rides = catalog.rides(spark, SF001)
    for zoom in range(4):
        n = 25 << zoom
        assert cells(pyramid.filter(F.col("zoom") == zoom)) == cells(agg.density_grid(rides, NYC_BB, n, n))
    small = agg.density_pyramid(edge, zooms=6, coarsest=3)
    for zoom in range(6):  # points on edges and outside
        assert cells(small.filter(F.col("zoom") == zoom)) == cells(agg.density_grid(edge, NYC_BB, 3 << zoom, 3 << zoom))
    assert agg.density_pyramid(edge.limit(0)).count() == 0
    with pytest.raises(ValueError):
        agg.density_pyramid(edge, zooms=0)


def test_pyramids_merge(spark, pyramid):
    rides = catalog.rides(spark, SF001)
    parts = [agg.density_pyramid(rides.filter(F.pmod(F.hash("key"), F.lit(3)) == k), zooms=4) for k in range(3)]
    assert sorted(map(tuple, agg.merge_pyramids(*parts).collect())) == sorted(map(tuple, pyramid.collect()))


def test_a_view_of_a_pyramid(spark, pyramid):
    whole = agg.density_grid(catalog.rides(spark, SF001), NYC_BB, 200, 200)
    rows = lambda df: sorted((r.side, r.row, r.col, r.cnt, round(r.density, 9), round(r.log_density, 9)) for r in df.collect())
    assert rows(agg.pyramid_view(pyramid, 3)) == rows(whole)
    step_lon, step_lat = (NYC_BB[1] - NYC_BB[0]) / 200, (NYC_BB[3] - NYC_BB[2]) / 200
    near = [r for r in rows(whole) if NYC_BB[0] + r[2] * step_lon <= NYC_BB_ZOOM[1] and NYC_BB[0] + (r[2] + 1) * step_lon > NYC_BB_ZOOM[0]
            and NYC_BB[3] - (r[1] + 1) * step_lat <= NYC_BB_ZOOM[3]]
    assert rows(agg.pyramid_view(pyramid, 3, NYC_BB_ZOOM)) == near


def test_the_pyramid_scans_once(spark):
    plan = agg.density_pyramid(catalog.rides(spark, SF001))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") + plan.count("Relation[") == 1
