"""Keyed store, epoch log and stream mechanisms, with crashes and replays."""

import datetime as dt

import pytest
from conftest import SF0001, edge_rows
from pyspark.sql import functions as F

from farelens.operators import aggregates as agg
from farelens.operators.changes import apply_changes
from farelens.operators.clean import cleaning_report
from farelens.plans import catalog
from farelens.session import scratch_path
from farelens.sources.keyed_store import KeyedStore
from farelens.sources.rides import RIDE_SCHEMA, good_rides, parse_rides, quarantined
from farelens.streaming import epochs as ep
from farelens.streaming import rides_stream as rs


def test_quartiles_order_one_range_only(spark):
    df = catalog.cleaned_dist(spark, SF0001)
    plan = agg.describe_distance(df)._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window" in line]
    assert windows and all(", r#" in w for w in windows)


CHANGE = "k long, v string, op string, seq int"


def test_a_small_batch_rewrites_its_buckets(spark):
    rows = spark.range(1000).select(F.col("id").alias("k"), F.concat(F.lit("v"), "id").alias("v"))
    store = KeyedStore.create(rows, scratch_path(spark, "t-store"), "k", buckets=16)
    before, held = store.manifest()
    old = store.read()
    batch = spark.createDataFrame([(3, "new", "update", 1), (5000, "in", "insert", 1)], CHANGE)
    touched = store.apply(batch)
    version, now = store.manifest()
    assert version == before + 1 and len(touched) <= 2 and {b for b in now if now[b] != held[b]} == touched
    assert sorted(map(tuple, store.read().collect())) == sorted(map(tuple, apply_changes(rows, batch, "k").collect()))
    assert sorted(map(tuple, old.collect())) == sorted(map(tuple, rows.collect()))  # who read the old version still does
    keys = spark.createDataFrame([(3,), (3,), (7777,)], "k long")
    found = store.lookup(keys)
    assert [tuple(r) for r in found.collect()] == [(3, "new")] and len(found.inputFiles()) <= 2


def test_a_crash_before_publishing_leaves_the_version(spark, monkeypatch):
    rows = spark.createDataFrame([(k, str(k)) for k in range(50)] + [(None, "none")], "k long, v string")
    store = KeyedStore.create(rows, scratch_path(spark, "t-store"), "k", buckets=4)

    def crash(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(KeyedStore, "_publish", crash)
        with pytest.raises(RuntimeError):
            store.apply(spark.createDataFrame([(1, "x", "delete", 1)], CHANGE))
    assert store.manifest()[0] == 0 and store.read().count() == 51
    gone = spark.createDataFrame([(k, "", "delete", 1) for k in range(50)], CHANGE)
    store.apply(gone)
    assert [tuple(r) for r in store.read().collect()] == [(None, "none")] and store.lookup(gone).count() == 0
    assert store.apply(gone.limit(0)) == set() and store.manifest()[0] == 1


def test_empty_store(spark):
    store = KeyedStore.create(spark.createDataFrame([], "k long, v string"), scratch_path(spark, "t-store"), "k", buckets=3)
    assert store.read().count() == 0
    store.apply(spark.createDataFrame([(1, "a", "insert", 1), (None, "b", "update", 2)], CHANGE))
    assert [tuple(r) for r in store.read().collect()] == [(1, "a")]


def test_epochs_crash_and_replay(spark, monkeypatch):
    one, two = (spark.createDataFrame([(k,)], "x int") for k in (1, 2))
    log = ep.EpochLog(spark, one.schema)
    assert log.read().count() == 0 and log.commit(0, one)

    def crash(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(ep.EpochLog, "_enter", crash)
        with pytest.raises(RuntimeError):
            log.commit(1, two)  # written, not entered
    again = ep.EpochLog(spark, one.schema, log.path)
    assert [r.x for r in again.read().collect()] == [1]
    assert again.commit(1, two) and not again.commit(1, two) and not again.commit(0, two)
    again.compact()
    assert sorted(r.x for r in log.read().collect()) == [1, 2] and len(log.current()) == 1 and not log.commit(1, one)
    assert log.commit(2, two, ep.REPLACE) and [r.x for r in again.read().collect()] == [2]


@pytest.fixture(scope="module")
def deliveries(spark):
    """Three ride files, and a fourth that repeats the first."""
    src = scratch_path(spark, "t-deliveries")
    rows = edge_rows()
    for k in (0, 1, 2, 0):
        spark.createDataFrame(rows[k::3], RIDE_SCHEMA).coalesce(1).write.mode("append").option("header", True).csv(src)
    return src


def test_update_mode_is_complete_mode(spark, deliveries):
    stream = rs.read_rides_stream(spark, deliveries, max_files_per_trigger=1)
    groups = stream.groupBy("passenger_count").agg(F.count(F.lit(1)).alias("n"), F.sum("fare_amount").alias("fare"))
    log = ep.merge_updates(groups, ["passenger_count"], ep.EpochLog(spark, groups.schema))
    assert len(log.entries()) == 5  # the empty one and four epochs
    want = spark.read.schema(RIDE_SCHEMA).option("header", True).csv(deliveries).groupBy("passenger_count").agg(F.count(F.lit(1)), F.sum("fare_amount"))
    assert sorted(map(str, log.read().collect())) == sorted(str(r).replace("count(1)", "n").replace("sum(fare_amount)", "fare") for r in want.collect())


def test_a_file_delivered_twice_counts_once(spark, deliveries):
    stream = rs.read_rides_stream(spark, deliveries, max_files_per_trigger=1)
    out = spark.read.parquet(rs.run_to_parquet(ep.once_per_key(stream, late="3650 days")))
    assert sorted(r.key for r in out.collect()) == sorted(r[0] for r in edge_rows())


def test_late_rows_are_dropped(spark):
    src = scratch_path(spark, "t-late")
    base = edge_rows()[0]
    at = lambda key, day: (key, base[1], dt.datetime(2012, 6, day), *base[3:])
    for rows in ([at("a", 20)], [at("b", 20)], [at("c", 1), at("d", 19)]):
        spark.createDataFrame(rows, RIDE_SCHEMA).coalesce(1).write.mode("append").option("header", True).csv(src)
    out = spark.read.parquet(rs.run_to_parquet(ep.once_per_key(rs.read_rides_stream(spark, src, max_files_per_trigger=1), late="2 days")))
    assert sorted(r.key for r in out.collect()) == ["a", "b", "d"]


def test_report_of_a_stream(spark, deliveries):
    stream = rs.read_rides_stream(spark, deliveries, max_files_per_trigger=1)
    kept, report = ep.EpochLog(spark, stream.schema), ep.EpochLog(spark, ep.report_schema(stream))
    ep.clean_and_report(stream, kept, report)
    batch = spark.read.schema(RIDE_SCHEMA).option("header", True).csv(deliveries)
    want = cleaning_report(batch).collect()
    assert ep.summed_report(report, stream).collect() == want and kept.read().count() == want[-1]["new_size"] and report.read().count() == 4
    empty = ep.EpochLog(spark, ep.report_schema(stream))
    assert ep.summed_report(empty, stream).collect() == cleaning_report(batch.limit(0)).collect()


LINES = ["key,fare_amount,pickup_datetime,pickup_longitude,pickup_latitude,dropoff_longitude,dropoff_latitude,passenger_count",
         "a,1.5,2012-06-13 12:00:00,-73.9,40.7,-73.8,40.8,1", "b,x,2012-06-13 12:00:00,-73.9,40.7,-73.8,40.8,1",
         "c,1.5,2012-06-13 12:00:00,-73.9,40.7,-73.8,40.8", "d,1.5,2012-06-13 12:00:00,-73.9,40.7,-73.8,40.8,1,9",
         "e,,,,,,,", "f,1.5,yesterday,-73.9,40.7,-73.8,40.8,1", '"g,h",1.5,2012-06-13 12:00:00,-73.9,40.7,-73.8,40.8,2']


def test_quarantine(spark):
    path = scratch_path(spark, "t-lines")
    spark.createDataFrame([(x,) for x in LINES], "value string").coalesce(2).write.text(path)
    batch = parse_rides(spark.read.text(path))
    out = rs.run_to_parquet(parse_rides(spark.readStream.text(path)))
    for parsed in (batch, spark.read.parquet(out)):
        assert sorted(r.key for r in good_rides(parsed).collect()) == ["a", "e", "g,h"]
        assert sorted(r.line[0] for r in quarantined(parsed).collect()) == ["b", "c", "d", "f"]
        assert sorted(r.line for r in quarantined(parsed).collect()) == sorted(x for x in LINES if x[0] in "bcdf")
