"""Keyed-table operators (R1-R5) and ``apply_changes``.

The single-row REST verbs become set operations on a keyed table: a batch
of keys or changes is applied with semi, anti and left joins that have the
batch on the side that may be broadcast. Where it is not small the planner
takes a sort-merge join, and AQE splits skewed partitions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

OPS = ("insert", "update", "delete")


def keyed_scan(base: DataFrame, *cols: str) -> DataFrame:
    """All rows (optionally a projection)."""
    return base.select(*cols) if cols else base


def lookup_keys(base: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """R2: rows whose key is in ``keys`` (EXISTS).

    The key set is de-duplicated first; ``distinct`` combines map-side, so a
    key repeated millions of times reaches the join as one row.
    """
    return base.join(keys.select(key).distinct(), key, "left_semi")


def _present(base: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """The keys of ``keys`` that ``base`` has. The batch is the right side,
    so a small one is broadcast and the table is only scanned."""
    return base.select(key).join(keys.select(key).distinct(), key, "left_semi").distinct()


def _one_per_key(rows: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """One row per key, the greatest by its values."""
    return rows.groupBy(key).agg(F.max(F.struct(*columns)).alias("_row")).select(key, "_row.*")


def insert_new(base: DataFrame, rows: DataFrame, key: str) -> DataFrame:
    """Append rows whose key is not present yet; existing keys win. Rows
    of the batch with one key count as one, the greatest by its values; NULL
    is a key like any other within the batch and matches none of the table."""
    new = _one_per_key(rows, key, [c for c in base.columns if c != key])
    new = new.join(_present(base, new, key), key, "left_anti")
    return base.unionByName(new.select(*base.columns))


def update_matching(base: DataFrame, rows: DataFrame, key: str) -> DataFrame:
    """Replace the non-key columns of matching keys; never inserts. Rows
    of the batch with one key count as one, the greatest by its values (see
    ``latest_changes`` for the latest by an order column). A batch read from
    files has a known size and is broadcast when small."""
    value_cols = [c for c in base.columns if c != key]
    upd = _one_per_key(rows, key, value_cols).select(
        key, *[F.col(c).alias(f"_new_{c}") for c in value_cols], F.lit(True).alias("_hit"))
    joined = base.join(upd, key, "left")
    return joined.select(key, *[
        F.when(F.col("_hit"), F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c) for c in value_cols])


def delete_keys(base: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Drop rows whose key is in ``keys`` (NOT EXISTS); keys are
    de-duplicated map-side first, as in ``lookup_keys``."""
    return base.join(keys.select(key).distinct(), key, "left_anti")


def latest_changes(changes: DataFrame, key: str, order: str = "seq") -> DataFrame:
    """The last change per key by ``order``; ties broken by the row's values.

    A ``max`` over a struct led by the order column is an ordinary
    aggregation, so a key with very many changes is pre-combined map-side
    instead of landing in one window partition.
    """
    others = [c for c in changes.columns if c not in (key, order)]
    return (changes.groupBy(key)
                   .agg(F.max(F.struct(order, *others)).alias("_last"))
                   .select(key, "_last.*"))


def apply_changes(base: DataFrame, changes: DataFrame, key: str,
                  op: str = "op", order: str = "seq") -> DataFrame:
    """Apply a change batch: the latest change per key decides.

    insert: added if the key is new, ignored if it exists;
    update: replaces values if the key exists, ignored otherwise;
    delete: removes the key if present.
    One aggregation of the batch; the table is joined with the latest
    updates and deletes (the batch side is broadcast when small), and the
    inserts that survive an anti join with the keys present are appended.
    """
    value_cols = [c for c in base.columns if c != key]
    last = latest_changes(changes.select(key, op, order, *value_cols), key, order)
    chg = last.filter(F.col(op).isin("update", "delete")).select(
        key, F.col(op).alias("_op"), *[F.col(c).alias(f"_new_{c}") for c in value_cols])
    kept = base.join(chg, key, "left").filter(F.coalesce(F.col("_op"), F.lit("")) != "delete").select(key, *[
        F.when(F.col("_op") == "update", F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c) for c in value_cols])
    new = last.filter(F.col(op) == "insert").select(key, *value_cols)
    return kept.unionByName(new.join(_present(base, new, key), key, "left_anti")).select(*base.columns)
