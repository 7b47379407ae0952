"""Bronze -> Silver: map each feed to the canonical schema, union, filter, dedupe.

Options (defaults reproduce the original behaviour except where marked fixed):

* ``year_from_ingest`` (default True, fix): a date text without year takes the
  year of the listing's ingest date instead of the year the job runs.
* ``numeric_dmy`` (default False): also parse the third feed's
  ``sáb. 25/10/2025, 20:00`` shape (originally never parsed).
* ``city_from_location`` (default False): fill the third feed's city from its
  location with a trailing `` - Sp`` removed (originally always null).
* ``require_spaces`` (default False): only a spaced `` - `` separates city.
* Dedupe survivor is deterministic (fix): latest ingest date, then source, file,
  title and the remaining columns.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlake.functions.dates import ingest_date_from_path, to_ts_any
from eventlake.functions.text import fill_city
from eventlake.operators.joins import first_by_order
from eventlake.schemas import FEED_REQUIRED, SILVER_COLUMNS, STD_SCHEMA
from eventlake.sources.lines import has_names, value_of

STD_COLS = [f.name for f in STD_SCHEMA.fields]


def empty_std(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], STD_SCHEMA)


def has_required(df: DataFrame, feed: str) -> bool:
    return set(FEED_REQUIRED[feed]).issubset(df.columns)


def map_feed(df: DataFrame, feed: str, run_date: str | None = None, *,
             year_from_ingest: bool = True, numeric_dmy: bool = False,
             city_from_location: bool = False, require_spaces: bool = False,
             file_col: Column | None = None, dates: bool = True) -> DataFrame:
    """One feed (normalised headers + ``src_file``) -> canonical rows (without ``dates``: no ``event_date``).

    A feed missing any required column yields an empty canonical frame.
    """
    if not has_required(df, feed):
        return empty_std(df.sparkSession) if dates else empty_std(df.sparkSession).drop("event_date")
    src = file_col if file_col is not None else F.col("src_file")
    fields = {c: F.col(c) for c in FEED_REQUIRED[feed]}
    # Ingest date in its own projection: the date parser reads it as a column,
    # so its path regexes run once per row (Catalyst does not collapse a
    # projection when that would repeat an expensive expression).
    df = df.withColumn("_ingest", ingest_date_from_path(src, run_date))
    title, venue, city = _title_venue_city(feed, fields, city_from_location, require_spaces)
    rows = df.select(
        fields["url"].alias("event_url"), title.alias("title"), venue.alias("venue"), city.alias("city"),
        fields["date"].alias("event_date_text"),
        F.lit(feed).alias("source"), F.col("_ingest").alias("ingest_date"), src.alias("src_file"))
    return with_dates(rows, year_from_ingest, numeric_dmy) if dates else rows


def with_dates(rows: DataFrame, year_from_ingest: bool = True, numeric_dmy: bool = False) -> DataFrame:
    """Canonical rows with ``event_date``, which each row's date text, source and ingest date alone decide."""
    year = F.year(F.to_date("ingest_date")) if year_from_ingest else None
    date = to_ts_any(F.col("event_date_text"), year)
    if numeric_dmy:
        date = F.when(F.col("source") == "eventim", to_ts_any(F.col("event_date_text"), year, numeric_dmy=True)).otherwise(date)
    return rows.withColumn("event_date", date).select(*STD_COLS)


def _title_venue_city(feed: str, fields: dict[str, Column], city_from_location: bool, require_spaces: bool):
    nothing = F.lit(None).cast("string")
    if feed == "eventim":
        place = fields["location"]
        return fields["artist"], place, F.regexp_replace(place, r"\s*-\s*Sp$", "") if city_from_location else nothing
    if feed == "ticket360":
        return fields["title"], fields["place"], fields["city"]
    return fields["title"], fields["place"], fill_city(nothing, fields["place"], require_spaces)


def map_records(records: DataFrame, run_date: str | None = None, *, year_from_ingest: bool = True, numeric_dmy: bool = False,
                city_from_location: bool = False, require_spaces: bool = False, dates: bool = True) -> DataFrame:
    """Records of all feeds (``feed``, ``names``, ``values``, ``path``; see ``sources.lines``) -> canonical
    rows, in one projection: one pass over the files however many feeds there are.

    Records of a file whose header lacks a column that its feed needs are left out."""
    whole = reduce(or_, [(F.col("feed") == feed) & has_names(required) for feed, required in FEED_REQUIRED.items()])
    fields = sorted({c for required in FEED_REQUIRED.values() for c in required})
    rows = records.where(whole).select("feed", F.col("path").alias("src_file"), *[value_of(c).alias(c) for c in fields],
                                       ingest_date_from_path(F.col("path"), run_date).alias("_ingest"))
    cells = {c: F.col(c) for c in fields}
    of_feed = {feed: _title_venue_city(feed, cells, city_from_location, require_spaces) for feed in FEED_REQUIRED}

    def by_feed(n: int) -> Column:
        return reduce(lambda out, feed: F.when(F.col("feed") == feed, of_feed[feed][n]).otherwise(out), of_feed, F.lit(None).cast("string"))

    rows = rows.select(F.col("url").alias("event_url"), by_feed(0).alias("title"), by_feed(1).alias("venue"), by_feed(2).alias("city"),
                       F.col("date").alias("event_date_text"), F.col("feed").alias("source"),
                       F.col("_ingest").alias("ingest_date"), "src_file")
    return with_dates(rows, year_from_ingest, numeric_dmy) if dates else rows


def unify(frames: list[DataFrame]) -> DataFrame:
    """Union by name; columns missing in a frame are null-filled."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


SURVIVOR_COLUMNS = ["source", "src_file", "title", "venue", "city", "event_date_text", "event_date"]


def survivor_order(columns: list[str] = SURVIVOR_COLUMNS) -> list[Column]:
    """Latest ingest date first, then the remaining columns ascending (nulls last)."""
    return ([F.col("ingest_date").desc_nulls_last()]
            + [F.col(c).asc_nulls_last() for c in columns])


def dedupe_events(df: DataFrame) -> DataFrame:
    """Keep rows with a non-empty URL, one per URL (deterministic survivor)."""
    usable = df.filter(F.col("event_url").isNotNull() & (F.length("event_url") > 0))
    return first_by_order(usable, ["event_url"], survivor_order([c for c in SURVIVOR_COLUMNS if c in df.columns]))


def dated_survivors(texts: DataFrame, year_from_ingest: bool = True, numeric_dmy: bool = False, **_) -> DataFrame:
    """One row per URL of canonical rows without ``event_date``, then its date.

    Rows that agree in all columns before the date in the survivors' order have one date, so the survivors are
    those of the dated rows, and only they are parsed."""
    return with_dates(dedupe_events(texts), year_from_ingest, numeric_dmy)


def build_silver(feeds: dict[str, DataFrame], run_date: str | None = None,
                 keep_src_file: bool = False, **options) -> DataFrame:
    """``{feed: raw frame with src_file}`` -> Silver rows (8 columns, or 9 with
    ``keep_src_file``)."""
    mapped = [map_feed(df, feed, run_date, dates=False, **options) for feed, df in feeds.items()]
    silver = dated_survivors(unify(mapped), **options)
    return silver.select(*(STD_COLS if keep_src_file else SILVER_COLUMNS))


def split_by_run_date(silver: DataFrame, run_date: str) -> tuple[DataFrame, DataFrame]:
    """(past, future) events: ``event_date`` before the run date, and on or
    after it (undated events go to neither)."""
    cut = F.lit(run_date).cast("timestamp")
    return (silver.filter(F.col("event_date") < cut), silver.filter(F.col("event_date") >= cut))
