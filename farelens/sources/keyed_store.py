"""A stored keyed table (R1-R5) that rewrites only what a batch touches.

Rows lie in ``buckets`` by the hash of their key, each bucket a folder of
Parquet files under the write that made it. A manifest says for every bucket
which write holds it; each version is one small folder that Spark's committer
publishes whole, so readers see a version or the one before. Versions are never
changed; a batch reads and writes the buckets of its keys and publishes a
manifest in which only these are new. There is one writer at a time: a second
one that starts from the same version fails on publishing.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.changes import apply_changes, lookup_keys

_MANIFEST = "bucket int, write string, n long, buckets int"
_BUCKET = "fl_bucket"


class KeyedStore:
    """``schema`` and ``key`` of the table at ``path``; ``buckets`` counts
    only where the table is made."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, key: str) -> None:
        self.spark, self.path, self.schema, self.key = spark, path.rstrip("/"), schema, key

    @classmethod
    def create(cls, rows: DataFrame, path: str, key: str, buckets: int = 64) -> KeyedStore:
        store = cls(rows.sparkSession, path, rows.schema, key)
        store._publish(0, store._write(rows, buckets), {}, buckets)
        return store

    def _bucket(self, buckets: int) -> Column:
        return F.pmod(F.xxhash64(F.col(self.key)), F.lit(buckets)).cast("int")

    def _write(self, rows: DataFrame, buckets: int) -> dict[int, tuple[str, int]]:
        """Rows by bucket in a new write: its name and rows for each bucket."""
        name = uuid.uuid4().hex
        placed = rows.withColumn(_BUCKET, self._bucket(buckets)).repartition(_BUCKET)
        placed.write.partitionBy(_BUCKET).parquet(f"{self.path}/data/write={name}")
        held = self.spark.read.schema(T.StructType([*self.schema.fields, T.StructField(_BUCKET, T.IntegerType())])).parquet(f"{self.path}/data/write={name}")
        return {r[_BUCKET]: (name, r["n"]) for r in held.groupBy(_BUCKET).agg(F.count(F.lit(1)).alias("n")).collect()}  # a row a bucket

    def _publish(self, version: int, new: dict[int, tuple[str, int]], old: dict[int, tuple[str, int]], buckets: int) -> None:
        rows = [(b, *(new.get(b) or old.get(b) or ("", 0)), buckets) for b in range(buckets)]
        self.spark.createDataFrame(rows, _MANIFEST).coalesce(1).write.mode("errorifexists").json(f"{self.path}/manifest/version={version}")

    def manifest(self) -> tuple[int, dict[int, tuple[str, int]]]:
        """The newest whole version, and by bucket its write and rows."""
        kept = self.spark.read.schema(_MANIFEST + ", version int").json(f"{self.path}/manifest")
        whole = kept.groupBy("version").agg(F.count(F.lit(1)).alias("have"), F.max("buckets").alias("of")).filter("have = of")
        version = whole.agg(F.max("version")).first()[0]
        return version, {r["bucket"]: (r["write"], r["n"]) for r in kept.filter(F.col("version") == version).collect()}

    def _read(self, held: dict[int, tuple[str, int]]) -> DataFrame:
        paths = [f"{self.path}/data/write={write}/{_BUCKET}={b}" for b, (write, n) in sorted(held.items()) if n]
        return self.spark.read.schema(self.schema).parquet(*paths) if paths else self.spark.createDataFrame([], self.schema)

    def read(self) -> DataFrame:
        """All rows of the newest version."""
        return self._read(self.manifest()[1])

    def _touched(self, keys: DataFrame, buckets: int) -> set[int]:
        return {r["b"] for r in keys.select(self._bucket(buckets).alias("b")).distinct().collect()}

    def lookup(self, keys: DataFrame) -> DataFrame:
        """R2: rows whose key is in ``keys``; reads only their buckets."""
        held = self.manifest()[1]
        touched = self._touched(keys, len(held))
        return lookup_keys(self._read({b: x for b, x in held.items() if b in touched}), keys, self.key)

    def apply(self, changes: DataFrame, op: str = "op", order: str = "seq") -> set[int]:
        """``changes.apply_changes`` on the touched buckets; the buckets
        that were rewritten."""
        version, held = self.manifest()
        touched = self._touched(changes, len(held))
        if touched:
            base = self._read({b: x for b, x in held.items() if b in touched})
            new = self._write(apply_changes(base, changes, self.key, op, order), len(held))
            self._publish(version + 1, {b: new.get(b, ("", 0)) for b in touched}, held, len(held))
        return touched
