"""Continuous de-duplication with bounded state (T3 option).

:func:`start_dedupe_stream` keeps one row per key with ``dropDuplicatesWithinWatermark``: a copy
that arrives while the key is remembered is dropped, and a key is forgotten once the watermark
(latest event time seen, less ``delay``) passes its time plus ``delay``.  State therefore holds the keys of
about two delays, however long the stream runs; the keyed Silver table (``streaming.ingest``)
is the choice where copies may come at any time.

Rows older than the watermark are dropped as late.  A null event time is never late; its key is
kept until the stream ends, so it takes no part (it is filtered out first).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def file_events(spark: SparkSession, path: str, schema: StructType, max_files: int | None = None) -> DataFrame:
    r = spark.readStream.schema(schema).option("recursiveFileLookup", True)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.parquet(path)


def deduplicated(stream: DataFrame, keys: list[str], event_time: str, delay: str) -> DataFrame:
    timed = stream.where(F.col(event_time).isNotNull())
    return timed.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(keys)


def start_dedupe_stream(stream: DataFrame, out_path: str, checkpoint: str, keys: list[str], event_time: str,
                        delay: str, available_now: bool = True):
    """First copies as Parquet at ``out_path``, appended batch by batch, each exactly once."""
    w = (deduplicated(stream, keys, event_time, delay).writeStream.format("parquet").outputMode("append")
         .option("path", out_path).option("checkpointLocation", checkpoint))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


def state_rows(query) -> list[int]:
    """Keys held after each of the query's recent batches."""
    return [op["numRowsTotal"] for p in query.recentProgress for op in p["stateOperators"]]
