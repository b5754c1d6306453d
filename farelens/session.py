"""Session settings and the shared scratch location.

Operators never create their own session; they take the caller's. These
helpers only build one for tests/bench and resolve where intermediate files
may go: always under the cluster-wide ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings that matter for every workload in this package.
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.driver.memory": "16g",
    "spark.ui.showConsoleProgress": "false",
    # Generated code for wide row expressions can exceed HotSpot's 8 KB
    # JIT limit and would then run in the bytecode interpreter.
    "spark.driver.extraJavaOptions": "-XX:-DontCompileHugeMethods",
    "spark.executor.extraJavaOptions": "-XX:-DontCompileHugeMethods",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "farelens", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(SESSION_DEFAULTS)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint root.

    ``spark.checkpoint.dir`` (or a checkpoint directory set on the context)
    names shared storage and is used as is. Only a local session that leaves
    it unset gets a temporary folder, removed when the process ends; on any
    other master that would be each machine's own disk, so it is an error.
    """
    sc = spark.sparkContext
    root = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not root:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError(f"set spark.checkpoint.dir to storage that all machines share (master {sc.master})")
        root = tempfile.mkdtemp(prefix="farelens-ckpt-")
        atexit.register(shutil.rmtree, root, ignore_errors=True)
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, purpose: str) -> str:
    """A fresh, never-reused directory under the shared checkpoint root."""
    root = ensure_checkpoint_dir(spark)
    return root.rstrip("/") + f"/farelens-{purpose}-{uuid.uuid4().hex}"
