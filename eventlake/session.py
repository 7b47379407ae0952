"""Session builder and shared-folder helpers.

The session pins the SQL time zone to UTC (timestamps in the feeds are zone-less
wall-clock values), turns on adaptive execution with skew-join handling and
dynamic partition overwrite, and keeps the web UI off.

Scratch data (lineage cuts, intermediate tables, archived inputs of the derived
queries) always lives below ``spark.checkpoint.dir`` – a folder every executor can
reach on a cluster.  Only when the session has none (local tests) do we create one.
"""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # Remove checkpoint files of lineage cuts once their RDDs are unreachable.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "eventlake", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the library defaults.

    On a cluster call it without ``master``; the launcher's settings win for
    anything given on the command line.
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    for k, v in DEFAULT_CONF.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    apply_defaults(spark)
    return spark


def apply_defaults(spark: SparkSession) -> SparkSession:
    """Apply the runtime-settable defaults to an existing session (driver-made)."""
    for k in ("spark.sql.session.timeZone", "spark.sql.adaptive.enabled",
              "spark.sql.sources.partitionOverwriteMode"):
        try:
            spark.conf.set(k, DEFAULT_CONF[k])
        except Exception:  # pragma: no cover - immutable in some deployments
            pass
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder; set a local one only when none is configured."""
    root = spark.conf.get(CHECKPOINT_CONF, None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError(f"set {CHECKPOINT_CONF} to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="eventlake-ckpt-")
        spark.conf.set(CHECKPOINT_CONF, root)
    try:
        if not spark.sparkContext.getCheckpointDir():
            spark.sparkContext.setCheckpointDir(root)
    except Exception:  # pragma: no cover - connect sessions have no context
        pass
    return root.rstrip("/")


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder below the shared checkpoint folder."""
    root = checkpoint_root(spark)
    return f"{root}/eventlake/{name}-{uuid.uuid4().hex[:12]}"


def staged(df, name: str):
    """``df`` written once to the shared checkpoint folder and read back: later plans neither
    recompute it nor guess its size (a small one is then broadcast by Spark itself)."""
    path = scratch_dir(df.sparkSession, name)
    tidily(df.sparkSession, lambda: df.write.parquet(path))
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def staged_while(df, name: str):
    """:func:`staged`, removed at the end of the ``with`` block."""
    path = scratch_dir(df.sparkSession, name)
    try:
        tidily(df.sparkSession, lambda: df.write.parquet(path))
        yield df.sparkSession.read.schema(df.schema).parquet(path)
    finally:
        drop_folder(df.sparkSession, path)


#: Removes an action's shuffle files when the action ends: what later steps need is in what it wrote.
TIDY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def tidily(spark: SparkSession, action):
    """Run an action whose shuffle files go when it ends; the session's setting is put back."""
    before = spark.conf.get(TIDY, None)
    spark.conf.set(TIDY, "true")
    try:
        return action()
    finally:
        spark.conf.unset(TIDY) if before is None else spark.conf.set(TIDY, before)


def drop_folder(spark: SparkSession, path: str) -> None:
    """Remove a scratch folder that is no longer read."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
