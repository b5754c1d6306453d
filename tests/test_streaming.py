"""Stream = batch for the stateless chain, split into 1 and n files, and
a restart from the checkpoint adds nothing twice."""

import pytest
from pyspark.sql import functions as F

from conftest import SF0001
from farelens.operators.clean import clean_rides, fare_floor
from farelens.session import scratch_path
from farelens.sources.fixtures import load_rides
from farelens.sources.rides import RIDE_COLUMNS, write_rides_csv
from farelens.streaming import rides_stream as rs


def _multiset(df, cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


@pytest.mark.parametrize("files", [1, 4])
def test_csv_stream_equals_batch(spark, files):
    rides = load_rides(spark, SF0001)
    src = scratch_path(spark, "t-stream-src")
    write_rides_csv(rides.repartition(files), src)
    out = rs.run_to_parquet(rs.read_rides_stream(spark, src, max_files_per_trigger=1))
    back = spark.read.parquet(out).withColumn("pickup_datetime", F.col("pickup_datetime").cast("timestamp_ntz"))
    assert _multiset(back, RIDE_COLUMNS) == _multiset(rides, RIDE_COLUMNS)


def test_restart_from_checkpoint_no_duplicates(spark):
    rides = load_rides(spark, SF0001)
    src = scratch_path(spark, "t-restart-src")
    write_rides_csv(rides.repartition(2), src)
    out, ck = scratch_path(spark, "t-restart-out"), scratch_path(spark, "t-restart-ck")
    rs.run_to_parquet(rs.read_rides_stream(spark, src), out, ck)
    rs.run_to_parquet(rs.read_rides_stream(spark, src), out, ck)  # nothing new
    assert spark.read.parquet(out).count() == rides.count()


def test_handover_every_batch_kept(spark):
    stream = fare_floor(rs.ride_stream_from_events(spark, SF0001))
    out = rs.handover_batches(stream)
    got = spark.read.parquet(out)
    assert got.count() == fare_floor(load_rides(spark, SF0001)).count() == 937


def test_stream_clean_features_equals_batch(spark):
    out = rs.run_to_parquet(rs.stream_clean_features(rs.ride_stream_from_events(spark, SF0001)))
    batch = clean_rides(load_rides(spark, SF0001))
    assert spark.read.parquet(out).select("key").exceptAll(batch.select("key")).count() == 0
    assert spark.read.parquet(out).count() == batch.count()


def test_streaming_view_is_stream(spark):
    s = rs.stream_zone_sql(rs.ride_stream_from_events(spark, SF0001), "pickup_longitude > 0", view="t_view")
    assert s.isStreaming


def test_stream_avg_fare_complete_mode(spark):
    out = rs.stream_avg_fare(clean_rides(rs.ride_stream_from_events(spark, SF0001)), "hour")
    got = {r["hour"]: r["avg_fare"] for r in spark.read.parquet(out).collect()}
    exp = {r[0]: r[1] for r in clean_rides(load_rides(spark, SF0001)).groupBy("hour").avg("fare_amount").collect()}
    assert got.keys() == exp.keys()
    for k in exp:
        assert got[k] == pytest.approx(exp[k], rel=1e-12)


def _in_files(spark, n):
    src = scratch_path(spark, "t-many")
    write_rides_csv(load_rides(spark, SF0001).repartition(n), src)
    return rs.read_rides_stream(spark, src, max_files_per_trigger=1, ntz=True)


def test_handover_keeps_every_epoch_of_many(spark):
    out = rs.handover_batches(_in_files(spark, 4))
    got = spark.read.parquet(out)
    assert got.select("epoch").distinct().count() == 4 and got.count() == load_rides(spark, SF0001).count()


def test_replayed_epoch_replaces_its_rows(spark):
    """Without the commit log the last epoch runs again and counts once."""
    import glob
    import os
    out, ck = scratch_path(spark, "t-replay-out"), scratch_path(spark, "t-replay-ck")
    src = scratch_path(spark, "t-replay-src")
    write_rides_csv(load_rides(spark, SF0001).repartition(3), src)
    stream = lambda: rs.read_rides_stream(spark, src, max_files_per_trigger=1, ntz=True)
    rs.handover_batches(stream(), out, ck)
    last = max(glob.glob(f"{ck}/commits/[0-9]*"), key=lambda f: int(os.path.basename(f)))
    os.remove(last)
    for crc in glob.glob(f"{ck}/commits/.{os.path.basename(last)}.crc"):
        os.remove(crc)
    rs.handover_batches(stream(), out, ck)
    assert spark.read.parquet(out).count() == load_rides(spark, SF0001).count()


def test_averages_over_many_batches(spark):
    stream = clean_rides(_in_files(spark, 4))
    clean = clean_rides(load_rides(spark, SF0001))
    got = {r["hour"]: r["avg_fare"] for r in spark.read.parquet(rs.stream_avg_fare(stream, "hour")).collect()}
    assert got == pytest.approx({r[0]: r[1] for r in clean.groupBy("hour").avg("fare_amount").collect()}, rel=1e-9)
    every = spark.read.parquet(rs.stream_avg_fare_all(clean_rides(_in_files(spark, 3))))
    assert every.agg(F.sum("n_rides")).first()[0] == 4 * clean.count()


def test_a_source_with_nothing_to_read(spark, tmp_path):
    empty = lambda: rs.read_rides_stream(spark, str(tmp_path), ntz=True)
    assert spark.read.parquet(rs.handover_batches(empty())).count() == 0
    assert spark.read.parquet(rs.stream_avg_fare(clean_rides(empty()), "hour")).columns == ["hour", "avg_fare"]


def test_results_of_earlier_epochs_stay_until_the_next_is_complete(spark, tmp_path):
    newest = rs.stream_avg_fare(clean_rides(_in_files(spark, 2)), "hour", out=str(tmp_path / "avg"))
    assert newest.endswith("epoch=1") and spark.read.parquet(str(tmp_path / "avg" / "epoch=0")).count() > 0


def test_streams_through_all_zone_filters(spark):
    from farelens.operators.zones import area_sql, inside_nyc, outside_nyc, zone_rides
    rides = load_rides(spark, SF0001)
    for area in ("jfk", "manhattan", "brooklyn", "staten_island", "bronx", "inside", "outside"):
        want = {"inside": inside_nyc, "outside": outside_nyc}.get(area, lambda d, a=area: zone_rides(d, a))(rides)
        rides.createOrReplaceTempView("t_rides")
        got = spark.sql(f"SELECT * FROM t_rides WHERE {area_sql(area)}")
        assert _multiset(got, ["key"]) == _multiset(want, ["key"])
