"""Publishing a table by a catalog swap (K6, K7).

A run writes a new version folder; readers go on seeing the old one.  One ``ALTER TABLE … SET
LOCATION`` then moves the table over, so a reader sees either version whole, never a mixture, and
a failed run leaves nothing but an unreferenced folder.  :func:`remove_stale` deletes versions that
have been out of use for longer than a grace period, so running readers can finish.

The table is external.  ``csv`` tables hold a header, quoted fields and the types string and
timestamp only, as the original registers them; ``parquet`` keeps the frame's own types.
"""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlake.session import drop_folder

CSV_OPTIONS = {"header": "true", "quote": '"', "escape": '"', "multiLine": "true", "ignoreLeadingWhiteSpace": "false",
               "ignoreTrailingWhiteSpace": "false", "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}
STAMP_DIGITS = 13


def catalog_types(df: DataFrame) -> dict[str, str]:
    """Column -> catalog type: timestamps stay, everything else is text."""
    return {name: "timestamp" if kind.startswith("timestamp") else "string" for name, kind in df.dtypes}


def new_version(base: str) -> str:
    """``v=<milliseconds>-<random>``: names sort by time, and two runs never share one."""
    return f"{base.rstrip('/')}/v={int(time.time() * 1000):0{STAMP_DIGITS}d}-{uuid.uuid4().hex[:8]}"


def publish(df: DataFrame, database: str, table: str, base: str, fmt: str = "parquet") -> str:
    """Write ``df`` as a new version below ``base`` and point ``database.table`` to it; returns its folder."""
    spark = df.sparkSession
    folder = new_version(base)
    types = catalog_types(df) if fmt == "csv" else dict(df.dtypes)
    rows = df.select(*[F.col(f"`{c}`").cast(t).alias(c) for c, t in types.items()])
    options = CSV_OPTIONS | {"quoteAll": "true"} if fmt == "csv" else {}
    rows.write.options(**options).format(fmt).save(folder)
    name = f"`{database}`.`{table}`"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    columns = ", ".join(f"`{c}` {t}" for c, t in types.items())
    settings = ", ".join(f"'{k}' '{_quoted(v)}'" for k, v in CSV_OPTIONS.items()) if fmt == "csv" else ""
    known = spark.catalog.tableExists(f"{database}.{table}")
    if known and (dict(spark.table(name).dtypes) != types or _provider(spark, name) != fmt):
        spark.sql(f"DROP TABLE {name}")  # external: its data stays
        known = False
    if known:
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{_quoted(folder)}'")
    else:
        spark.sql(f"CREATE TABLE {name} ({columns}) USING {fmt} {f'OPTIONS ({settings})' if settings else ''} LOCATION '{_quoted(folder)}'")
    spark.catalog.refreshTable(name)
    return folder


def _quoted(value: str) -> str:
    return value.replace("\\", "\\\\").replace("'", "\\'")


def _described(spark: SparkSession, name: str) -> dict[str, str]:
    return {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()}


def _provider(spark: SparkSession, name: str) -> str:
    return _described(spark, name)["Provider"].lower()


def location(spark: SparkSession, database: str, table: str) -> str:
    return _described(spark, f"`{database}`.`{table}`")["Location"]


def versions(spark: SparkSession, base: str) -> list[str]:
    """Version folders below ``base``, oldest first."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(base)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = [s.getPath().getName() for s in fs.listStatus(root) if s.isDirectory()] if fs.exists(root) else []
    return [f"{base.rstrip('/')}/{n}" for n in sorted(n for n in names if n.startswith("v="))]


def remove_stale(spark: SparkSession, database: str, table: str, base: str, grace_seconds: float = 86_400, now: float | None = None) -> list[str]:
    """Delete the versions that a newer one replaced more than ``grace_seconds`` ago; returns them.

    A version goes out of use when its successor was written.  The current one always stays, and so do newer
    ones, which a run may be about to publish."""
    now = time.time() if now is None else now
    current, found, gone = location(spark, database, table).rstrip("/").rsplit("/", 1)[-1], versions(spark, base), []
    for folder, successor in zip(found, found[1:]):
        if folder.rsplit("/", 1)[-1] >= current:
            break
        if now - int(successor.rsplit("v=", 1)[-1][:STAMP_DIGITS]) / 1000 > grace_seconds:
            drop_folder(spark, folder)
            gone.append(folder)
    return gone
