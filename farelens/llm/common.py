"""Helpers shared by the training-data operators.

Shared storage: everything that outlives one job goes to the folder named by
``spark.checkpoint.dir``. It is read from the session; only a local session
that leaves it unset (tests) gets a temporary one.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from farelens.session import ensure_checkpoint_dir

#: ASCII white space as the contracts use it.
SPACE = r"[\x20\x09-\x0D]+"
DOCUMENTS = ("doc_id", "text", "lang", "source", "n_chars")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: cuts the
    lineage, survives lost executors, and no later job computes it again."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/farelens-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not use (names are case-insensitive)."""
    used = {c.lower() for c in df.columns}
    while name.lower() in used:
        name += "_"
    return name


#: Classes of keys that ``sifted`` tells apart; what it broadcasts has no
#: more rows (of one number) than this, whatever the input.
KEY_CLASSES = 1 << 18


def sifted(rows: DataFrame, keys: DataFrame, column: str) -> tuple[DataFrame, DataFrame]:
    """``rows`` whose ``column`` may be among ``keys``, and those that surely
    have none of them, so that a join need only shuffle the former."""
    kind = fresh(rows, "fl_kind")
    classes = F.pmod(F.xxhash64(F.col(f"`{column}`")), F.lit(KEY_CLASSES)).cast("int")
    marked = F.broadcast(keys.select(classes.alias(kind)).distinct())
    marked_rows, columns = rows.withColumn(kind, classes), [F.col(f"`{c}`") for c in rows.columns]
    return tuple(marked_rows.join(marked, kind, how).select(*columns) for how in ("left_semi", "left_anti"))


def text_or_empty(column: str | Column = "text") -> Column:
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


_remembered: list = []


def remembered(cache):
    """Register what a Python worker remembers between batches (anything with
    ``clear``)."""
    _remembered.append(cache)
    return cache


def forget_others(*mine) -> None:
    """A worker serves one operator after another; its memory is for the one
    at work."""
    for other in _remembered:
        if not any(other is m for m in mine):
            other.clear()


def width(spark: SparkSession) -> int:
    """Partitions of a shuffle, as the session is set up."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
