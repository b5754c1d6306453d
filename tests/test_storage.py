"""Where intermediate data may go, what reads see, and caps that spread."""

import datetime as dt
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from conftest import SF0001, edge_rows
from farelens import constants
from farelens.session import ensure_checkpoint_dir
from farelens.sources.fixtures import load_rides, read_table
from farelens.sources.rides import RIDE_SCHEMA, cap_rows, cap_rows_spread, read_rides_csv


def _session(master, folder=None):
    conf = SimpleNamespace(get=lambda key, default=None: folder or default)
    return SimpleNamespace(sparkContext=SimpleNamespace(
        master=master, getConf=lambda: conf, getCheckpointDir=lambda: None, setCheckpointDir=lambda d: None))


@pytest.mark.parametrize("master", ["spark://host:7077", "yarn", "k8s://https://host", "local-cluster[2,1,1024]"])
def test_a_cluster_must_name_shared_storage(master):
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(_session(master))
    assert ensure_checkpoint_dir(_session(master, "s3a://bucket/x")) == "s3a://bucket/x"


def test_files_added_later_are_read(spark, tmp_path):
    rows = spark.read.parquet(f"{SF0001}/events.parquet")
    rows.write.parquet(str(tmp_path / "events.parquet"))
    before = load_rides(spark, str(tmp_path)).count()
    rows.write.mode("append").parquet(str(tmp_path / "events.parquet"))
    assert load_rides(spark, str(tmp_path)).count() == 2 * before == 2 * read_table(spark, SF0001, "events").count()


@pytest.mark.parametrize("n", [0, 1, 17, 399, 999, 1000, 5000])
def test_spread_cap_keeps_the_rows_of_the_plain_one(spark, n):
    rides = load_rides(spark, SF0001).withColumn("key", F.expr("cast(cast(key as int) div 7 as string)"))  # ties
    want = sorted(map(str, cap_rows(rides, n).collect()))
    assert sorted(map(str, cap_rows_spread(rides, n).collect())) == want and len(want) == min(n, rides.count())


def test_spread_cap_of_equal_rows_and_nulls(spark):
    df = spark.createDataFrame([("a", 1)] * 50 + [(None, 2)] * 3 + [("b", 3)], "key string, v int")
    got = cap_rows_spread(df, 20).groupBy("key").count().collect()
    assert {r["key"]: r["count"] for r in got} == {None: 3, "a": 17}
    assert cap_rows_spread(df.limit(0), 5).count() == 0


def test_spread_cap_has_no_merging_task(spark):
    plan = cap_rows_spread(load_rides(spark, SF0001), 600)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" not in plan and "Sort" not in plan


def test_csv_with_zone_text(spark, tmp_path):
    (tmp_path / "rides.csv").write_text(
        ",".join(RIDE_SCHEMA.names) + "\nk1,4.5,2009-06-15 17:26:21 UTC,-73.84,40.72,-73.84,40.71,1\nk2,x,,,,,,\n")
    rows = {r["key"]: r for r in read_rides_csv(spark, str(tmp_path)).withColumn("unix", F.unix_timestamp("pickup_datetime")).collect()}
    assert rows["k1"]["unix"] == int(dt.datetime(2009, 6, 15, 17, 26, 21, tzinfo=dt.timezone.utc).timestamp())
    assert rows["k2"]["pickup_datetime"] is None and rows["k2"]["fare_amount"] is None


def test_frames_as_published():
    assert constants.INSIDE_NYC_PICKUP == (-74.5, -72.8, 40.573143, 41.709555)
    assert constants.INSIDE_NYC_DROPOFF == (-74.252193, -72.986532, 40.5, 41.8)
    assert (constants.NYC_BB, constants.NYC_BB_ZOOM) == ((-74.5, -72.8, 40.5, 41.8), (-74.3, -73.7, 40.5, 40.9))
    assert len(edge_rows()) == 25
