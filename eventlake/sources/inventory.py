"""Folder inventory of a Bronze root: what lies there, what was consumed, what to move.

* :func:`list_files` – every CSV file below a root as a DataFrame.  Spark's own parallel listing
  finds them; no file is opened (the content column is pruned).
* :func:`folder_inventory` – one row per date folder: feed, label, date, files, bytes.
* :func:`consumed_folders` – the distinct date folders a batch's rows came from.
* :func:`folders_to_move` – consumed folders, and for a feed of which nothing was consumed its
  latest existing folder; numbered in folder order without a single-task sort.
* :func:`files_to_move` – the files of these folders with their archive keys.

Folders are named by their path from the Bronze root on (``Bronze/database …/date=…/``), so
listings, ledgers and object stores with other prefixes meet on one key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlake.functions.text import archive_key, date_prefix, date_value, decoded_path
from eventlake.operators.clients import assign_ids
from eventlake.operators.joins import first_by_order
from eventlake.schemas import FEED_FOLDERS
from eventlake.sources.feeds import feed_label, feed_of, path_exists

INVENTORY_FILES = "key string, bytes bigint, modified timestamp"


def object_key(path: Column | str) -> Column:
    """The path from the Bronze root on; null for files outside the feed folders."""
    folders = "|".join(sorted({f for names in FEED_FOLDERS.values() for f in names}))
    return F.nullif(F.regexp_extract(decoded_path(path), rf"(?:^|/)((?:{folders})/.*)$", 1), F.lit(""))


def list_files(spark: SparkSession, root: str, pattern: str = "*.csv") -> DataFrame:
    """key, bytes, modified of the feed files below ``root``; none if it does not exist."""
    if not path_exists(spark, root):
        return spark.createDataFrame([], INVENTORY_FILES)
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(root))
    return files.select(object_key("path").alias("key"), F.col("length").alias("bytes"), F.col("modificationTime").alias("modified")).where("key is not null")


def folder_inventory(files: DataFrame) -> DataFrame:
    """prefix, feed, label, date, n_files, bytes, modified of every date folder."""
    tagged = files.withColumn("prefix", date_prefix("key")).where("prefix is not null")
    folders = tagged.groupBy("prefix").agg(F.count(F.lit(1)).alias("n_files"), F.sum("bytes").alias("bytes"), F.max("modified").alias("modified"))
    return folders.select("prefix", feed_of(F.col("prefix")).alias("feed"), feed_label(F.col("prefix")).alias("label"),
                          date_value("prefix").alias("date"), "n_files", "bytes", "modified")


def consumed_folders(rows: DataFrame, src_file: str = "src_file") -> DataFrame:
    """The distinct date folders of a batch's source files (partial distinct per task)."""
    return rows.select(date_prefix(object_key(src_file)).alias("prefix")).where("prefix is not null").distinct()


def latest_folders(inventory: DataFrame, by_date: bool = False) -> DataFrame:
    """Each feed's last folder by name, or by date with ``by_date`` (the two root spellings sort apart)."""
    order = [F.col("date").desc()] * by_date + [F.col("prefix").desc()]
    return first_by_order(inventory.where("feed is not null"), ["feed"], order).select("feed", "prefix")


def folder_states(inventory: DataFrame, consumed: DataFrame, by_date: bool = False) -> DataFrame:
    """The inventory with ``state``: consumed, idle_latest (nothing of its feed was consumed, and it is the latest), waiting."""
    seen = consumed.select(F.col("prefix").alias("seen_prefix"))
    marked = inventory.join(seen, F.col("prefix") == F.col("seen_prefix"), "left")
    active = consumed.select(feed_of(F.col("prefix")).alias("feed")).distinct()
    idle = latest_folders(inventory, by_date).join(active, "feed", "left_anti").select(F.col("prefix").alias("idle_prefix"))
    state = (F.when(F.col("seen_prefix").isNotNull(), "consumed").when(F.col("idle_prefix").isNotNull(), "idle_latest").otherwise("waiting"))
    return marked.join(idle, F.col("prefix") == F.col("idle_prefix"), "left").withColumn("state", state).drop("seen_prefix", "idle_prefix")


def folders_to_move(states: DataFrame) -> DataFrame:
    """prefix, feed, state, position (from 1, in folder order) of what is to be moved."""
    moved = states.where("state <> 'waiting'").select("prefix", "feed", "state")
    return moved.join(assign_ids(moved, "prefix", id_col="position"), "prefix")


def files_to_move(files: DataFrame, moved: DataFrame) -> DataFrame:
    """key, archive_key, position of every file in a folder that is to be moved."""
    tagged = files.withColumn("prefix", date_prefix("key"))
    return tagged.join(moved.select("prefix", "position"), "prefix").select("key", archive_key("key").alias("archive_key"), "position")
