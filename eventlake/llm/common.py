"""Helpers shared by the operators: tables, shared-folder cuts, task-side iteration, components."""

from __future__ import annotations

import sys
import types
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, functions as F

from eventlake.session import drop_folder, tidily

#: The white space that separates words, as a Java regex class and its complement.
SPACE = r"\x20\x09-\x0D"
WORD = rf"[^{SPACE}]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_root(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; a temporary folder only for local sessions that set none."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        import tempfile
        root = tempfile.mkdtemp(prefix="llm-shared-")
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


def shared_path(spark: SparkSession, name: str) -> str:
    return f"{shared_root(spark)}/llm/{name}-{uuid.uuid4().hex[:12]}"


#: Folders written by the steps that are under way, one list for each open :func:`temporary`.
_written: list[list[str]] = []


def cut(spark: SparkSession, df: DataFrame, name: str, partition_by: str | None = None) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: later steps neither recompute
    it nor depend on the executors that made it."""
    path = shared_path(spark, name)
    writer = df.write.option("compression", "lz4")
    writer = writer.partitionBy(partition_by) if partition_by else writer
    if _written:
        _written[-1].append(path)
        tidily(spark, lambda: writer.parquet(path))
    else:
        writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def cut_in_rounds(spark: SparkSession, rounds, name: str) -> DataFrame:
    """:func:`cut` of the rows of all ``rounds``, run one after the other: only one round's shuffle is on disk at a time."""
    path = shared_path(spark, name)
    if _written:
        _written[-1].append(path)
    for df in rounds:
        tidily(spark, lambda: df.write.mode("append").option("compression", "lz4").parquet(path))
    return spark.read.schema(df.schema).parquet(path)


#: Shuffled joins drop rows without a partner by a Bloom filter before the shuffle, on tables of every size.
SIFT = {"spark.sql.optimizer.runtime.bloomFilter.enabled": "true", "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "0",
        "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": "1g"}


@contextmanager
def sifted(spark: SparkSession):
    """Within it, joins whose smaller side is filtered move only the rows that may have a partner."""
    before = {key: spark.conf.get(key, None) for key in SIFT}
    try:
        for key, value in SIFT.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


@contextmanager
def temporary(spark: SparkSession):
    """Within it, cuts are removed when it ends, but for those made by the function it gives:
    ``with temporary(spark) as keep: ...; return keep(df, name)``.  A kept cut belongs to the next outer one."""
    _written.append([])

    def keep(df: DataFrame, name: str) -> DataFrame:
        mine = _written.pop()  # the cut is the outer one's, or nobody's
        try:
            path = shared_path(spark, name)
            if _written:
                _written[-1].append(path)
            tidily(spark, lambda: df.write.option("compression", "lz4").parquet(path))
            return spark.read.schema(df.schema).parquet(path)
        finally:
            _written.append(mine)

    try:
        yield keep
    finally:
        for path in _written.pop():
            drop_folder(spark, path)


def release(spark: SparkSession, *names: str) -> None:
    """Remove the cuts of these names that the open :func:`temporary` holds, once nothing reads them any more."""
    if _written:
        gone = [p for p in _written[-1] if p.rsplit("/", 1)[1].rsplit("-", 1)[0] in names]
        _written[-1][:] = [p for p in _written[-1] if p not in gone]
        for path in gone:
            drop_folder(spark, path)


def bounded_batches(spark: SparkSession) -> None:
    """Keep Arrow batches small, so that a run of very long texts fits a worker's memory."""
    for key, most in (("spark.sql.execution.arrow.maxRecordsPerBatch", 2000),
                      ("spark.sql.execution.arrow.maxBytesPerBatch", 32 << 20)):
        try:
            now = int(spark.conf.get(key))
        except Exception:  # a Spark release without this setting
            continue
        if now <= 0 or now > most:
            spark.conf.set(key, str(most))


def process_cache() -> dict:
    """A dict that lives as long as the Python worker, for models that are slow to load."""
    module = sys.modules.setdefault("_llm_process_cache", types.ModuleType("_llm_process_cache"))
    return module.__dict__.setdefault("items", {})


def word_count(text):
    """Number of words of a text column; null counts 0."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def connected_components(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """(id, component) for every id in ``edges(a, b)``; component is the smallest reachable id.

    Each round takes the smallest label among a vertex, its neighbours and its label's own label
    (pointer jumping), until nothing changes.  A vertex with very many neighbours costs
    partial minima only.
    """
    with temporary(spark) as keep:
        both = cut(spark, edges.select("a", "b").union(edges.select("b", "a")).where("a <> b").distinct(), "cc-edges")
        labels = cut(spark, both.groupBy(F.col("a").alias("id")).agg(F.least("a", F.min("b")).alias("component")), "cc-labels")
        while True:
            near = (both.join(labels, both.b == labels.id).groupBy(F.col("a").alias("id")).agg(F.min("component").alias("near")))
            up = labels.select(F.col("id").alias("component"), F.col("component").alias("up"))
            new = labels.join(near, "id").join(up, "component").select("id", F.least("component", "near", "up").alias("new"), "component")
            # What changed is read from the written rows: an observer would stay in the session and end up in later closures.
            new = cut(spark, new.select("id", F.col("new").alias("component"), (F.col("new") < F.col("component")).alias("moved")), "cc-labels")
            labels = new.drop("moved")
            if new.where("moved").isEmpty():
                return keep(labels, "cc-components")
