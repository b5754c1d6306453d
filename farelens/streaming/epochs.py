"""An epoch log: how results of a stream are published.

Every entry names a folder of Parquet files and is one small file that Spark's
committer publishes whole, after the data. Readers follow the log, so that what
a crash leaves behind between the two is never read; an epoch that comes again
after a restart and is in the log already changes nothing. An entry adds to what
is there (``append``) or stands in its place (``replace``); ``compact`` writes
what is current into few files and stands in the place of it.

The log has one writer, its streaming query. An empty log reads as an empty
table.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

from ..operators.clean import cleaning_steps, report_of, survivors
from ..operators.zones import tag_zones_with
from ..session import scratch_path

_ENTRY = "epoch long, path string, kind string"
APPEND, REPLACE, COMPACT = "append", "replace", "compact"


class EpochLog:
    def __init__(self, spark: SparkSession, schema: T.StructType, path: str | None = None) -> None:
        self.spark, self.schema = spark, schema
        self.path = (path or scratch_path(spark, "epochs")).rstrip("/")
        if path is None or not self._exists():
            self._enter(0, -1, "", REPLACE)

    def _exists(self) -> bool:
        try:
            return bool(self.entries())
        except AnalysisException:  # no such folder
            return False

    def _enter(self, number: int, epoch: int, path: str, kind: str) -> None:
        self.spark.createDataFrame([(epoch, path, kind)], _ENTRY).coalesce(1).write.mode("errorifexists").json(f"{self.path}/log/entry={number}")

    def entries(self) -> list:
        """What the log holds, in order; a row an epoch."""
        return self.spark.read.schema(_ENTRY + ", entry long").json(f"{self.path}/log").orderBy("entry").collect()

    def current(self, entries: list | None = None) -> list[str]:
        """Folders that make up the result."""
        entries = self.entries() if entries is None else entries
        start = max(k for k, e in enumerate(entries) if e["kind"] != APPEND)
        return [f"{self.path}/{e['path']}" for e in entries[start:] if e["path"]]

    def read(self) -> DataFrame:
        folders = self.current()
        return self.spark.read.schema(self.schema).parquet(*folders) if folders else self.spark.createDataFrame([], self.schema)

    def write(self, rows: DataFrame, name: str) -> str:
        path = f"data/{name}-{uuid.uuid4().hex}"
        rows.write.parquet(f"{self.path}/{path}")
        return path

    def commit(self, epoch: int, rows: DataFrame, kind: str = APPEND) -> bool:
        """Publish ``rows`` as ``epoch``, unless it was published before."""
        entries = self.entries()
        if epoch <= max(e["epoch"] for e in entries):
            return False
        self._enter(len(entries), epoch, self.write(rows, f"epoch-{epoch}"), kind)
        return True

    def compact(self, files: int = 1) -> None:
        """What is current in ``files`` files; readers of the old ones may go on."""
        entries = self.entries()
        if len(self.current(entries)) > 1:
            self._enter(len(entries), entries[-1]["epoch"], self.write(self.read().repartition(files), "compact"), COMPACT)


def _run(writer: DataStreamWriter, checkpoint: str | None, spark: SparkSession) -> None:
    q = writer.option("checkpointLocation", checkpoint or scratch_path(spark, "epochs-ckpt")).trigger(availableNow=True).start()
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(f"stream {q.name} failed: {q.exception()}")


def hand_over(stream: DataFrame, log: EpochLog, checkpoint: str | None = None) -> EpochLog:
    """Every micro-batch becomes an epoch of ``log``."""
    _run(stream.writeStream.foreachBatch(lambda batch, epoch: log.commit(epoch, batch) and None), checkpoint, log.spark)
    return log


def merge_updates(changed: DataFrame, keys: list[str], log: EpochLog, checkpoint: str | None = None) -> EpochLog:
    """T5 in update mode: a micro-batch brings only the groups that changed;
    they take the place of the published rows with their ``keys`` (NULL is a key
    like any other)."""

    def merge(batch: DataFrame, epoch: int) -> None:
        new = batch.select(*[F.col(k).alias(f"_{k}") for k in keys])
        same = F.lit(True)
        for k in keys:
            same = same & F.col(k).eqNullSafe(F.col(f"_{k}"))
        log.commit(epoch, log.read().join(new, same, "left_anti").unionByName(batch).coalesce(1), REPLACE)

    _run(changed.writeStream.outputMode("update").foreachBatch(merge), checkpoint, log.spark)
    return log


def tag_with_zone_table(stream: DataFrame, zones: Callable[[SparkSession], DataFrame], log: EpochLog, side: str = "pickup",
                        checkpoint: str | None = None) -> EpochLog:
    """T3 against a zone table (zone, lon_min, lon_max, lat_min, lat_max): one row
    per ride and zone that holds it, joined on grid cells as in the batch.

    ``zones`` reads the table and is called for every micro-batch, so a zone
    added or changed counts from the next micro-batch on; epochs that are in
    the log stay as they are, also when they are delivered again. ``log`` has
    the schema ``tagged_schema``.
    """

    def one(batch: DataFrame, epoch: int) -> None:
        log.commit(epoch, tag_zones_with(batch, zones(batch.sparkSession), side))

    _run(stream.writeStream.foreachBatch(one), checkpoint, log.spark)
    return log


def tagged_schema(df: DataFrame) -> T.StructType:
    return T.StructType([*df.schema.fields, T.StructField("zone", T.StringType())])


def clean_and_report(stream: DataFrame, kept: EpochLog, report: EpochLog, with_box: bool = True, checkpoint: str | None = None) -> None:
    """C4 and C5 on a stream in one pass: the rows that pass all steps go to
    ``kept``, and the counts after each step, observed on the way, to
    ``report`` (``report_schema``)."""
    steps = cleaning_steps(stream, with_box)

    def one(batch: DataFrame, epoch: int) -> None:
        seen, keep = Observation(), F.lit(True)
        for _, passes in steps:
            keep = keep & F.coalesce(passes, F.lit(False))
        if kept.commit(epoch, batch.observe(seen, *survivors(steps)).filter(keep)):
            counts = seen.get
        else:  # kept but not reported before a restart
            counts = batch.agg(*survivors(steps)).first().asDict()
        row = [tuple(counts.get(f.name, 0) for f in report.schema.fields)]
        report.commit(epoch, report.spark.createDataFrame(row, report.schema).coalesce(1))

    _run(stream.writeStream.foreachBatch(one), checkpoint, kept.spark)


def report_schema(df: DataFrame, with_box: bool = True) -> T.StructType:
    return T.StructType([T.StructField(f"n{i}", T.LongType()) for i in range(len(cleaning_steps(df, with_box)) + 1)])


def summed_report(report: EpochLog, df: DataFrame, with_box: bool = True) -> DataFrame:
    """The cleaning report of all epochs."""
    counts = [F.coalesce(F.sum(f.name), F.lit(0)).alias(f.name) for f in report.schema.fields]
    return report_of(report.read().agg(*counts), [name for name, _ in cleaning_steps(df, with_box)])


def once_per_key(stream: DataFrame, key: str = "key", time: str = "pickup_datetime", late: str = "30 days") -> DataFrame:
    """T1 with files delivered again: the first row of every ``key`` passes,
    its repeats within ``late`` of event time do not. State holds a key until the
    watermark has passed it by ``late``; rows that come later than that are
    dropped, as nothing tells whether they are repeats. Of rows without a time
    the first of every key passes too; state holds their keys for good."""
    at = f"_{time}"
    timed = stream.filter(F.col(time).isNotNull()).withColumn(at, F.col(time).cast("timestamp"))
    timed = timed.withWatermark(at, late).dropDuplicatesWithinWatermark([key]).drop(at)
    return timed.unionByName(stream.filter(F.col(time).isNull()).dropDuplicates([key]))
