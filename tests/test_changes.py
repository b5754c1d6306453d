"""Keyed-table operators on small frames with known answers."""

from farelens.operators import changes as chg

BASE = [(1, "a", 1.0), (2, "b", 2.0), (3, "c", 3.0)]
SCHEMA = "id bigint, name string, val double"


def _base(spark):
    return spark.createDataFrame(BASE, SCHEMA)


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_lookup_and_delete(spark):
    keys = spark.createDataFrame([(1,), (1,), (9,)], "id bigint")
    assert _rows(chg.lookup_keys(_base(spark), keys, "id")) == [(1, "a", 1.0)]
    assert _rows(chg.delete_keys(_base(spark), keys, "id")) == [(2, "b", 2.0), (3, "c", 3.0)]


def test_insert_new_keeps_existing(spark):
    rows = spark.createDataFrame([(3, "x", 9.0), (4, "d", 4.0)], SCHEMA)
    assert _rows(chg.insert_new(_base(spark), rows, "id")) == BASE + [(4, "d", 4.0)]


def test_update_never_inserts(spark):
    rows = spark.createDataFrame([(2, "B", 20.0), (7, "z", 7.0)], SCHEMA)
    assert _rows(chg.update_matching(_base(spark), rows, "id")) == [(1, "a", 1.0), (2, "B", 20.0), (3, "c", 3.0)]


def test_batches_that_repeat_keys_and_hold_null(spark):
    rows = spark.createDataFrame([(4, "d", 4.0), (4, "e", 5.0), (2, "B", 1.0), (2, "C", 0.0), (None, "n", 0.0), (None, "m", 9.0)], SCHEMA)
    assert _rows(chg.insert_new(_base(spark), rows, "id").filter("id IS NOT NULL")) == BASE + [(4, "e", 5.0)]
    assert [tuple(r) for r in chg.insert_new(_base(spark), rows, "id").filter("id IS NULL").collect()] == [(None, "n", 0.0)]
    assert _rows(chg.update_matching(_base(spark), rows, "id")) == [(1, "a", 1.0), (2, "C", 0.0), (3, "c", 3.0)]
    changes = spark.createDataFrame([(None, "n", 1.0, "delete", 1), (None, "n", 1.0, "insert", 2), (2, "x", 0.0, "update", 1), (2, "y", 0.0, "update", 1)],
                                    "id bigint, name string, val double, op string, seq int")
    got = chg.apply_changes(_base(spark), changes, "id")
    assert _rows(got.filter("id IS NOT NULL")) == [(1, "a", 1.0), (2, "y", 0.0), (3, "c", 3.0)] and got.filter("id IS NULL").count() == 1


def test_a_small_batch_leaves_the_table_unshuffled(spark, tmp_path):
    """No exchange but those of the batch, and no full outer join."""
    base, batch = str(tmp_path / "base"), str(tmp_path / "batch")
    spark.range(200_000).selectExpr("id", "cast(id as string) AS name", "rand() AS val").write.parquet(base)
    spark.createDataFrame([(2, "B", 20.0, "update", 1), (10 ** 9, "z", 7.0, "insert", 1)], f"{SCHEMA}, op string, seq int").write.parquet(batch)
    table, changes = spark.read.parquet(base), spark.read.parquet(batch)
    for out in (chg.apply_changes(table, changes, "id"), chg.insert_new(table, changes, "id"), chg.update_matching(table, changes, "id")):
        assert out.count() in (200_000, 200_001)
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" not in plan and "FullOuter" not in plan and "BroadcastHashJoin" in plan


def test_apply_changes_latest_wins(spark):
    changes = spark.createDataFrame([
        (1, "A1", 10.0, "update", 1),
        (1, None, None, "delete", 2),        # two changes for key 1: delete is latest
        (2, "B", 20.0, "update", 1),
        (3, "dup", 0.0, "insert", 1),        # insert of an existing key is ignored
        (4, "d", 4.0, "insert", 1),
        (5, "e", 5.0, "update", 1),          # update of a missing key is ignored
        (6, "f", 6.0, "insert", 1),
        (6, None, None, "delete", 3),        # inserted then deleted in one batch
    ], "id bigint, name string, val double, op string, seq int")
    out = chg.apply_changes(_base(spark), changes, "id")
    assert _rows(out) == [(2, "B", 20.0), (3, "c", 3.0), (4, "d", 4.0)]


def test_latest_changes_hot_key(spark):
    # one key holding most of the batch is reduced by a plain aggregation
    rows = [(1, f"n{i}", float(i), "update", i) for i in range(5000)] + [(2, "x", 1.0, "update", 1)]
    changes = spark.createDataFrame(rows, "id bigint, name string, val double, op string, seq int")
    last = {r["id"]: r["seq"] for r in chg.latest_changes(changes, "id").collect()}
    assert last == {1: 4999, 2: 1}


def test_change_batch_matches_sql_text(spark):
    from conftest import SF001
    from farelens.plans.catalog import CHANGES_SQL, change_batch
    from farelens.sources.fixtures import read_table
    cust = read_table(spark, SF001, "customer")
    a = change_batch(cust)
    b = spark.sql(CHANGES_SQL, customer=cust)
    assert a.schema.simpleString() == b.schema.simpleString()
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
