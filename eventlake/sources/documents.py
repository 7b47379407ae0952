"""Exported gold CSVs -> normalised rows for the document loader.

Files are read as raw lines (``sources.lines``), so one above a worker's memory is read in
splits.  Per file, by partial aggregates over its lines: UTF-8 if every line is valid (else
Latin-1), and the separator that the header line has more of (``;`` on a tie, the
original's default).  Keys are stripped/lower-cased (a leading byte-order mark dropped), values
stripped, and ``source_key`` is the file's export name.

Delimiter choice is our re-aimed rule: the original used Python's CSV sniffer
on the first 2,048 characters; on header-first exports both agree.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlake.functions.text import decoded_path, py_strip
from eventlake.sources.lines import EXPORT_SEPARATORS, csv_records, facts, raw_lines, stripped_key, value_of


def file_formats(spark: SparkSession, path: str) -> DataFrame:
    """(file, encoding, sep, header line) per CSV file under ``path``."""
    return formats_of(facts(raw_lines(spark, path), EXPORT_SEPARATORS, stripped_key)[1])


def formats_of(files: DataFrame) -> DataFrame:
    return files.select(F.col("path").alias("file"), F.when(F.col("utf8"), "UTF-8").otherwise("ISO-8859-1").alias("encoding"), "sep", "header")


def export_key(path) -> F.Column:
    """"<folder>/<name>.csv" of an export: a part file's folder when Spark wrote it as a
    directory, else the file itself.  Percent-encoding is undone."""
    plain = decoded_path(path)
    folder = F.regexp_extract(plain, r"([^/]+/[^/]+\.csv)/[^/]*$", 1)
    return F.when(folder != "", folder).otherwise(F.regexp_extract(plain, r"([^/]+/[^/]+)$", 1))


def export_rows(lines: DataFrame, splits: DataFrame | None = None, files: DataFrame | None = None) -> DataFrame:
    """Numbered raw lines of exports -> a column for every header name, and ``source_key``."""
    if files is None or splits is None:
        splits, files = facts(lines, EXPORT_SEPARATORS, stripped_key)
    # Header names become columns: as many as the schema of the result has.
    names = sorted(r[0] for r in files.select(F.explode("names")).distinct().collect() if r[0])
    records = csv_records(lines, EXPORT_SEPARATORS, stripped_key, files, splits)
    return records.select(*[py_strip(value_of(n)).alias(n) for n in names], export_key(F.col("path")).alias("source_key"))


def read_gold_exports(spark: SparkSession, path: str) -> DataFrame:
    """All exported gold CSVs below ``path`` as normalised rows + ``source_key``."""
    return export_rows(raw_lines(spark, path))
