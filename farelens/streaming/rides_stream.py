"""Structured Streaming.

The batch column functions are reused unchanged on streams: cleaning,
features, distance, colour and zone filters are stateless, so a stream runs
them per micro-batch with no state. Every query has a checkpoint; the
per-epoch hand-over overwrites its own ``epoch=<id>`` directory, so a
replayed epoch after a failure replaces its output instead of duplicating it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.color import fare_color
from ..functions.geo import with_distance
from ..operators.aggregates import avg_fare_all
from ..operators.clean import clean_rides
from ..session import scratch_path
from ..sources.fixtures import read_table, rides_from_events
from ..sources.rides import CSV_TS_FORMAT, RIDE_SCHEMA, RIDE_SCHEMA_NTZ


def read_rides_stream(spark: SparkSession, path: str, sep: str = ",",
                      max_files_per_trigger: int | None = None, ntz: bool = False) -> DataFrame:
    """File stream of ride CSVs with header and the fixed schema
    (``ntz`` as in ``read_rides_csv``)."""
    r = spark.readStream.option("header", True).option("sep", sep)
    r = (r.schema(RIDE_SCHEMA_NTZ).option("timestampNTZFormat", CSV_TS_FORMAT) if ntz
         else r.schema(RIDE_SCHEMA))
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.csv(path)


def read_table_stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table read in place as a file stream (one file, one table)."""
    schema = read_table(spark, sf_dir, name).schema
    return (spark.readStream.schema(schema)
                 .option("pathGlobFilter", f"{name}.parquet").parquet(sf_dir))


def ride_stream_from_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rides derived from the ``events`` file stream (stateless projection)."""
    return rides_from_events(spark, read_table_stream(spark, sf_dir, "events"))


def _await(q: StreamingQuery) -> None:
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(f"stream {q.name} failed: {q.exception()}")


def run_to_parquet(stream: DataFrame, out: str | None = None, checkpoint: str | None = None,
                   partition_by: tuple[str, ...] = ()) -> str:
    """Drain everything available into Parquet (append) and stop."""
    spark = stream.sparkSession
    out = out or scratch_path(spark, "stream-out")
    checkpoint = checkpoint or scratch_path(spark, "stream-ckpt")
    w = (stream.writeStream.format("parquet").option("path", out)
               .option("checkpointLocation", checkpoint).outputMode("append")
               .trigger(availableNow=True))
    if partition_by:
        w = w.partitionBy(*partition_by)
    _await(w.start())
    return out


def handover_batches(stream: DataFrame, out: str | None = None, checkpoint: str | None = None) -> str:
    """Hand every micro-batch to batch code through ``foreachBatch``.

    Each epoch is written to ``<out>/epoch=<id>`` with overwrite, so a retried
    epoch replaces its own files; readers see every batch, not the last one.
    A source that has nothing to read leaves an empty ``epoch=-1``.
    """
    spark = stream.sparkSession
    out = out or scratch_path(spark, "handover")
    checkpoint = checkpoint or scratch_path(spark, "handover-ckpt")

    def write_epoch(batch: DataFrame, epoch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/epoch={epoch_id}")

    # There first, so that a reader never meets a folder without a schema.
    spark.createDataFrame([], stream.schema).write.mode("overwrite").parquet(f"{out}/epoch=-1")
    q = (stream.writeStream.foreachBatch(write_epoch)
               .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    _await(q)
    return out


def stream_zone_sql(stream: DataFrame, where: str, view: str = "rides_stream") -> DataFrame:
    """Register the stream as a view and filter it by SQL; the result
    is itself a stream."""
    stream.createOrReplaceTempView(view)
    return stream.sparkSession.sql(f"SELECT * FROM {view} WHERE {where}")


def stream_clean_features(stream: DataFrame) -> DataFrame:
    """T4: the batch cleaning chain, features, distance and colour on a stream."""
    return with_distance(clean_rides(stream)).withColumn("color", fare_color())


def _complete_to_parquet(agg: DataFrame, out: str | None, checkpoint: str | None, purpose: str) -> str:
    """Run a complete-mode aggregation to the end of the available input and
    return the folder of its newest result.

    Every epoch writes the full current result to a folder of its own,
    ``<out>/epoch=<id>``, and a result counts only once its write has
    finished: a crash or a reader at that moment still has the one before. A
    source that has nothing to read leaves the empty ``epoch=-1``.
    """
    spark = agg.sparkSession
    out = out or scratch_path(spark, purpose)
    checkpoint = checkpoint or scratch_path(spark, purpose + "-ckpt")

    newest = [f"{out}/epoch=-1"]
    spark.createDataFrame([], agg.schema).write.mode("overwrite").parquet(newest[0])

    def write_latest(batch: DataFrame, epoch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/epoch={epoch_id}")
        newest[0] = f"{out}/epoch={epoch_id}"

    q = (agg.writeStream.outputMode("complete").foreachBatch(write_latest)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    _await(q)
    return newest[0]


def stream_avg_fare_all(stream: DataFrame, out: str | None = None, checkpoint: str | None = None) -> str:
    """T5 for all four calendar dimensions at once: one stateful GROUPING SETS
    aggregation (state: one row per bucket, about 50), complete mode."""
    return _complete_to_parquet(avg_fare_all(stream), out, checkpoint, "avg-fare-all")


def stream_avg_fare(stream: DataFrame, dim: str, out: str | None = None,
                    checkpoint: str | None = None) -> str:
    """T5: running average fare per calendar bucket.

    Complete mode keeps one state row per bucket (24 hours, 12 months, ...);
    each epoch publishes the full current answer in a folder of its own.
    """
    agg = stream.groupBy(dim).agg(F.avg("fare_amount").alias("avg_fare"))
    return _complete_to_parquet(agg, out, checkpoint, "avg-fare")
