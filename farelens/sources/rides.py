"""Ride sources and sinks.

The ride table always has the fixed schema below; schema inference is never
used. Readers return lazy DataFrames so filters and projections applied later
reach the scan (``PushedFilters`` / pruned ``ReadSchema`` for Parquet).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..constants import DEFAULT_ROW_CAP
from ..session import scratch_path

RIDE_SCHEMA = T.StructType([
    T.StructField("key", T.StringType(), True),
    T.StructField("fare_amount", T.FloatType(), True),
    T.StructField("pickup_datetime", T.TimestampType(), True),
    T.StructField("pickup_longitude", T.FloatType(), True),
    T.StructField("pickup_latitude", T.FloatType(), True),
    T.StructField("dropoff_longitude", T.FloatType(), True),
    T.StructField("dropoff_latitude", T.FloatType(), True),
    T.StructField("passenger_count", T.IntegerType(), True),
])

RIDE_COLUMNS = [f.name for f in RIDE_SCHEMA.fields]

# Lossless text form for timestamps in CSV (default CSV writing keeps ms only).
CSV_TS_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"


RIDE_SCHEMA_NTZ = T.StructType([
    T.StructField(f.name, T.TimestampNTZType() if f.name == "pickup_datetime" else f.dataType, True)
    for f in RIDE_SCHEMA.fields])


def read_rides_csv(spark: SparkSession, path: str, sep: str = ",", ntz: bool = False) -> DataFrame:
    """Batch CSV scan with header and the fixed schema.

    By default the timestamp is ``timestamp`` and its format is left open, so
    both ``2009-06-15 17:26:21 UTC`` and ISO text with fractions are accepted.
    ``ntz=True`` reads files written by ``write_rides_csv`` from
    ``timestamp_ntz`` rides back as wall-clock values, independent of zones.
    """
    r = spark.read.option("header", True).option("sep", sep).option("mode", "PERMISSIVE")
    if ntz:
        r = r.schema(RIDE_SCHEMA_NTZ).option("timestampNTZFormat", CSV_TS_FORMAT)
    else:
        r = r.schema(RIDE_SCHEMA)
    return r.csv(path)


MALFORMED = "malformed"


def parse_rides(lines: DataFrame, sep: str = ",", ntz: bool = False) -> DataFrame:
    """S1/S2 with a quarantine: rides of CSV ``lines`` (column ``value``, batch
    or stream) and, in ``malformed``, the text of each line that breaks the
    schema (a field of another type, too many or too few fields); its ride
    columns are not to be used. Header lines are dropped; a quoted field may not
    hold a line break."""
    schema = RIDE_SCHEMA_NTZ if ntz else RIDE_SCHEMA
    whole = T.StructType([*schema.fields, T.StructField(MALFORMED, T.StringType())])
    options = {"sep": sep, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": MALFORMED} | ({"timestampNTZFormat": CSV_TS_FORMAT} if ntz else {})
    rows = lines.filter(F.col("value") != sep.join(RIDE_COLUMNS)).select(F.from_csv("value", whole.simpleString()[7:-1].replace(":", " "), options).alias("r"))
    return rows.select("r.*")


def good_rides(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col(MALFORMED).isNull()).drop(MALFORMED)


def quarantined(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col(MALFORMED).isNotNull()).select(F.col(MALFORMED).alias("line"))


def read_rides_parquet(spark: SparkSession, path: str) -> DataFrame:
    """Columnar ride store; filters and column pruning reach the scan."""
    return spark.read.parquet(path)


def write_rides_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV export with header; values are quoted where needed and
    timestamps keep microseconds so a read-back is lossless."""
    (df.write.mode(mode).option("header", True)
       .option("timestampFormat", CSV_TS_FORMAT)
       .option("timestampNTZFormat", CSV_TS_FORMAT)
       .csv(path))


def write_rides_parquet(df: DataFrame, path: str, partition_by: tuple[str, ...] = (),
                        mode: str = "overwrite") -> None:
    """Parquet sink; with ``partition_by=("year", "month")`` a filter on those
    columns prunes whole directories (``PartitionFilters`` in the scan)."""
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def register_view(df: DataFrame, name: str = "rides") -> DataFrame:
    """Name a (batch or streaming) plan for SQL."""
    df.createOrReplaceTempView(name)
    return df


def cap_rows(df: DataFrame, n: int = DEFAULT_ROW_CAP, order_by: str | Column = "key") -> DataFrame:
    """Repeatable row cap for a few rows, in one lazy top-n (every task
    keeps n rows and one task merges them). Ties go by the whole row's hash.
    For caps of millions see ``cap_rows_spread``."""
    order = F.col(order_by) if isinstance(order_by, str) else order_by
    return df.orderBy(order, F.xxhash64(*df.columns)).limit(n)


def cap_rows_spread(df: DataFrame, n: int, order_by: str = "key") -> DataFrame:
    """S6 for any n: the rows of ``cap_rows``, gathered in no single task.

    The rows' orders (key, then the whole row's hash) are range-partitioned
    and written down. From the partitions' counts follows the partition that
    the cap falls into; ranks are counted in that one alone, and the order at
    the cap (one row) turns the cap into a filter on the table. Of rows alike
    at the cap as many stay as fit.
    """
    spark = df.sparkSession
    order = F.struct(F.col(order_by).alias("k"), F.xxhash64(*df.columns).alias("h"))
    held = df.select(order.alias("o")).repartitionByRange("o").withColumn("part", F.spark_partition_id())
    path = scratch_path(spark, "cap")
    held.write.parquet(path)
    held = spark.read.schema(held.schema).parquet(path)
    # One row per partition of the shuffle.
    sizes = held.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    cut = sizes.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))).filter(
        (F.col("before") < n) & (F.col("before") + F.col("n") >= n)).first()
    if cut is None:  # the table has fewer rows (or none are asked for)
        return df if n > 0 else df.limit(0)
    ranks = Window.orderBy("o")
    last = (held.filter(F.col("part") == cut["part"])
                .withColumn("row", F.row_number().over(ranks)).withColumn("alike", F.rank().over(ranks))
                .filter(F.col("row") == n - cut["before"]).first())
    at = F.struct(F.lit(last["o"]["k"]).cast(df.schema[order_by].dataType).alias("k"), F.lit(last["o"]["h"]).cast("long").alias("h"))
    fit = last["row"] - last["alike"] + 1
    return df.filter(order < at).unionByName(df.filter(order == at).limit(fit))


def subset_rows(df: DataFrame, n: int = DEFAULT_ROW_CAP, order_by: str = "key") -> DataFrame:
    """Drop the timestamp and keep a repeatable n-row subset."""
    return cap_rows(df.drop("pickup_datetime"), n, order_by)


def preview_rows(df: DataFrame, n: int = 5, order_by: str = "key") -> DataFrame:
    """``show(n)``/``take(n)`` as a DataFrame, deterministic."""
    return cap_rows(df, n, order_by)


def count_rows(df: DataFrame, alias: str = "n_rows") -> DataFrame:
    """Row count as a one-row DataFrame (no driver round trip)."""
    return df.agg(F.count(F.lit(1)).alias(alias))


def project(df: DataFrame, *cols: str | Column) -> DataFrame:
    """Column pick."""
    return df.select(*cols)


def drop_columns(df: DataFrame, *cols: str) -> DataFrame:
    """Drop columns."""
    return df.drop(*cols)
