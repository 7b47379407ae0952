"""Incremental ingest with Structured Streaming.

* :func:`line_stream` (T1): one stream of raw lines over a whole root, so folders may appear at
  any time; every file is read once thanks to the checkpoint, and whole within one batch.
  ``archive_dir`` (T2) moves consumed files there (``cleanSource=archive``);
  Spark moves a file once a later batch has committed.
* :func:`start_silver_stream` (T1, T3): each batch's lines become records by their own file's
  header (``sources.lines``), are mapped to the canonical schema by the feed folder they lie in and
  upserted into the keyed Silver table by URL with the deterministic survivor order; only touched
  buckets are rewritten.  State is the table itself.
* :func:`start_documents_stream` (T4): exported gold CSVs of any encoding and separator ->
  documents -> ``$set`` upsert by ``_id``.  A ledger keeps one row per file and batch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlake.operators.serve import build_documents
from eventlake.operators.silver import dated_survivors, map_records, survivor_order
from eventlake.sources.documents import export_key, export_rows, formats_of
from eventlake.session import staged_while
from eventlake.sinks.tables import by_key, dedupe_merge, set_merge, upsert_buckets
from eventlake.sources.feeds import feeds_records, path_exists
from eventlake.sources.lines import EXPORT_SEPARATORS, LINE_OPTIONS, csv_records, facts, numbered, stripped_key, with_origin


def line_stream(spark: SparkSession, root: str, archive_dir: str | None = None, max_files: int | None = None) -> DataFrame:
    """file, block, value of every line of the CSV files that are or come below ``root``."""
    r = spark.readStream.options(**LINE_OPTIONS)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    if archive_dir:
        r = r.option("cleanSource", "archive").option("sourceArchiveDir", archive_dir)
    return with_origin(r.format("text").load(root))


def _start(src: DataFrame, batch, checkpoint: str, available_now: bool):
    w = src.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


def start_silver_stream(spark: SparkSession, root: str, table_path: str, checkpoint: str,
                        archive_dir: str | None = None, n_buckets: int | None = None,
                        available_now: bool = True, max_files: int | None = None, **options):
    """All feeds below ``root`` into the Silver table; None if there is no such folder yet."""
    if not path_exists(spark, root):
        return None
    merge = dedupe_merge(survivor_order(), "event_url")

    def batch(df, epoch_id):
        texts = map_records(feeds_records(numbered(df)), dates=False, **options)
        with staged_while(texts, "stream-rows") as texts:
            survivors = [dated_survivors(part, **options) for part in by_key(texts, "event_url")]
            upsert_buckets(df.sparkSession, table_path, survivors, "event_url", merge, n_buckets)

    return _start(line_stream(spark, root, archive_dir, max_files), batch, checkpoint, available_now)


def start_documents_stream(spark: SparkSession, exports: str, docs_path: str, checkpoint: str,
                           schema=None, n_buckets: int | None = None, available_now: bool = True,
                           ledger_path: str | None = None, max_files: int | None = None):
    """Exports below ``exports`` into the documents table.  ``schema`` is not needed: every file
    is read by its own header.  ``ledger_path``: one row per batch and file (encoding, separator,
    header, rows), written before the upsert; a repeated batch replaces its own rows."""
    merge = set_merge("_id")

    def batch(df, epoch_id):
        lines = numbered(df)
        splits, files = facts(lines, EXPORT_SEPARATORS, stripped_key)
        if files.isEmpty():
            return
        rows = export_rows(lines, splits, files)
        if ledger_path:
            counts = csv_records(lines, EXPORT_SEPARATORS, stripped_key, files, splits).groupBy("path").agg(F.count(F.lit(1)).alias("n_rows"))
            entries = (formats_of(files).join(counts, F.col("file") == F.col("path"), "left")
                       .select(export_key(F.col("file")).alias("source_key"), "file", "encoding", "sep", "header",
                               F.coalesce("n_rows", F.lit(0)).alias("n_rows"), F.lit(epoch_id).alias("batch")))
            (entries.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(ledger_path))
        upsert_buckets(df.sparkSession, docs_path, build_documents(rows, F.col("source_key")), "_id", merge, n_buckets)

    return _start(line_stream(spark, exports, max_files=max_files), batch, checkpoint, available_now)
