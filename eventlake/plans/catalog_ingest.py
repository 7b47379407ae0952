"""Registered queries of the readers, streams, inventories and published tables.

Imported by ``catalog``, whose registry they join.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from eventlake.plans import oracle as O
from eventlake.plans import standins
from eventlake.plans.catalog import _DOCS_SQL, register, ts_str
from eventlake.session import apply_defaults, drop_folder, scratch_dir, staged

#: Rows of one feed and month lie in one file, so the file never decides between two of them.
SILVER_FILES_CTE = O.SILVER_MONTH_CTE.replace("src_file ASC NULLS LAST,", "")
SILVER_FILES_SQL = O.with_(SILVER_FILES_CTE, """
SELECT event_url, title, venue, city, event_date_text,
       strftime(event_date, '%Y-%m-%d %H:%M:%S') AS event_date, source, ingest_date
FROM silver""")


def silver_rows(spark, path: str):
    from eventlake.schemas import SILVER_COLUMNS
    return spark.read.parquet(path).select(*SILVER_COLUMNS).withColumn("event_date", ts_str("event_date"))


@register("bronze_all_columns", SILVER_FILES_SQL)
def bronze_all_columns(spark, sf_dir):
    """S1/S3/S4/B19 raw-line feed reading (every file by its own header, half of one feed's
    files reversed), U1/F1/D1 and the keyed Silver table, all columns."""
    from eventlake.plans.jobs import bronze_to_silver
    apply_defaults(spark)
    root = scratch_dir(spark, "bronze-lines")
    standins.write_bronze_tree(spark, sf_dir, root, vary_headers=True)
    silver = scratch_dir(spark, "silver-lines") + "/events"
    bronze_to_silver(spark, root, silver, run_date="1970-01-01", n_buckets=16)
    drop_folder(spark, root)
    return silver_rows(spark, silver)


@register("stream_late_folders", SILVER_FILES_SQL)
def stream_late_folders(spark, sf_dir):
    """T1/T3 one raw-line stream over the root: the first run sees one feed; the other feeds' folders,
    half of one feed's files with reversed columns, appear before the second run."""
    from eventlake.streaming.ingest import start_silver_stream
    apply_defaults(spark)
    root, base = scratch_dir(spark, "bronze-late"), scratch_dir(spark, "silver-late")
    for feeds in (("sympla",), ("ticket360", "eventim")):
        standins.write_bronze_tree(spark, sf_dir, root, vary_headers=True, only=feeds)
        start_silver_stream(spark, root, base + "/events", base + "/_checkpoint", n_buckets=16, run_date="1970-01-01").awaitTermination()
    drop_folder(spark, root)
    return silver_rows(spark, base + "/events")


@register("stream_exports", O.with_(_DOCS_SQL, "SELECT * FROM merged"))
def stream_exports(spark, sf_dir):
    """T4 export stream (S6-S8 inside ``foreachBatch``): a UTF-8 ``,`` export in the first run, a Latin-1
    ``;`` one in the second; documents equal those of the batch job.  A ledger keeps the files."""
    from eventlake.operators.serve import flatten_documents
    from eventlake.sinks.files import export_csv
    from eventlake.streaming.ingest import start_documents_stream
    apply_defaults(spark)
    root, base = scratch_dir(spark, "exports-stream"), scratch_dir(spark, "docs-stream")
    exports = zip(standins.GOLD_EXPORT_KEYS, standins.gold_export_rows(spark, sf_dir), ((",", "UTF-8"), (";", "ISO-8859-1")))
    for key, rows, (sep, encoding) in exports:
        export_csv(rows, f"{root}/{key}", sep=sep, encoding=encoding)
        start_documents_stream(spark, root, base + "/docs", base + "/_checkpoint", n_buckets=16, ledger_path=base + "/ledger").awaitTermination()
    return flatten_documents(spark.read.parquet(base + "/docs").drop("_bucket"))


@register("folder_inventory", O.with_(O.FEEDS_CTE.replace("|| ship_s ||", "|| month_s ||") + """,
folders AS (
  SELECT DISTINCT 'Bronze/database Sympla/date=' || month_s || '/' AS prefix, 'sympla' AS feed, month_s AS date
  FROM rows2 WHERE l_returnflag = 'A'
  UNION SELECT DISTINCT 'bronze/database Ticket360/date=' || month_s || '/', 'ticket360', month_s FROM rows2 WHERE l_returnflag = 'N'
  UNION SELECT DISTINCT 'Bronze/database Evetim/date=' || month_s || '/', 'eventim', month_s FROM rows2 WHERE l_returnflag = 'R'
),
states AS (
  SELECT prefix, feed, date,
         CASE WHEN feed = 'sympla' AND date < '1998-01-01' THEN 'consumed'
              WHEN feed <> 'sympla' AND prefix = max(prefix) OVER (PARTITION BY feed) THEN 'idle_latest' ELSE 'waiting' END AS state
  FROM folders
)""", """
SELECT prefix, feed, date, state,
       CASE WHEN state <> 'waiting' THEN row_number() OVER (PARTITION BY state = 'waiting' ORDER BY prefix) END AS position
FROM states"""))
def folder_inventory_q(spark, sf_dir):
    """J5/A5/U3/O4 inventory of a Bronze tree after a batch that read one feed's folders before 1998: consumed
    folders, the latest existing folder of every idle feed, what waits, and the order to move them in."""
    from eventlake.sources.feeds import read_feed
    from eventlake.sources.inventory import consumed_folders, folder_inventory, folder_states, folders_to_move, list_files
    apply_defaults(spark)
    root = scratch_dir(spark, "bronze-inventory")
    standins.write_bronze_tree(spark, sf_dir, root)
    batch = read_feed(spark, root, "sympla").where(F.col("src_file").rlike("date=199[0-7]"))
    states = folder_states(folder_inventory(list_files(spark, root)), consumed_folders(batch))
    moved = folders_to_move(states).select("prefix", "position")
    return states.join(moved, "prefix", "left").select("prefix", "feed", "date", "state", "position")


@register("listing_frontier", """
WITH RECURSIVE sizes AS (
  SELECT lower(o_orderpriority) AS seg, CAST(floor(max(o_orderkey) / 64) + 1 AS INTEGER) AS last FROM orders GROUP BY 1
),
steps AS (SELECT unnest([1, 2, 3, 4]) AS way),
reach AS (
  SELECT seg, 0 AS no, 0 AS level FROM sizes
  UNION
  SELECT t.seg, t.no, t.level FROM (
    SELECT r.seg, s.last, r.level + 1 AS level,
           CASE WHEN r.no = 0 THEN CASE WHEN way < 4 THEN way END
                ELSE CASE way WHEN 1 THEN r.no - 1 WHEN 2 THEN r.no + 1 WHEN 3 THEN 2 * r.no ELSE 2 * r.no + 1 END END AS no
    FROM reach r JOIN sizes s ON s.seg = r.seg CROSS JOIN steps
    WHERE (r.no = 0 OR r.no % 7 <> 0) AND r.level < 40) t
  WHERE t.no BETWEEN 1 AND t.last
),
best AS (SELECT seg, no, min(level) AS level FROM reach GROUP BY seg, no)
SELECT '""" + standins.PAGE_HOST + """/categoria/' || seg AS listing,
       '""" + standins.PAGE_HOST + """/categoria/' || seg || CASE WHEN no = 0 THEN '' ELSE '?p=' || CAST(no AS VARCHAR) END AS url,
       no AS page_no, level, no = 0 OR no % 7 <> 0 AS stored,
       row_number() OVER (PARTITION BY seg ORDER BY no) AS position
FROM best""")
def listing_frontier_q(spark, sf_dir):
    """H2/F4/O1 page links read from HTML, followed from every listing's base page to the reachable
    set; pages that are linked but not stored; the pages' order."""
    from eventlake.operators.frontier import listing_frontier
    apply_defaults(spark)
    return listing_frontier(standins.pager_pages(spark, sf_dir))


@register("pagination_links", """
WITH sizes AS (SELECT lower(o_orderpriority) AS seg, CAST(floor(max(o_orderkey) / 64) + 1 AS INTEGER) AS last FROM orders GROUP BY 1),
pages AS (SELECT seg, last, unnest(range(0, last + 1)) AS no FROM sizes),
linked AS (
  SELECT DISTINCT seg, last, no, unnest(CASE WHEN no = 0 THEN [1, 2, 3] ELSE [no - 1, no + 1, 2 * no, 2 * no + 1] END) AS page_no
  FROM pages WHERE no = 0 OR no % 7 <> 0
)
SELECT '""" + standins.PAGE_HOST + """/categoria/' || seg || CASE WHEN no = 0 THEN '' ELSE '?p=' || CAST(no AS VARCHAR) END AS url,
       '""" + standins.PAGE_HOST + """/categoria/' || seg || '?p=' || CAST(page_no AS VARCHAR) AS link, CAST(page_no AS INTEGER) AS page_no
FROM linked WHERE page_no BETWEEN 1 AND last""")
def pagination_links_q(spark, sf_dir):
    """H2/F4 every stored page's own pagination links: those with ``?p=`` that contain its path."""
    from eventlake.sources.html import pagination_links
    apply_defaults(spark)
    return pagination_links(standins.pager_pages(spark, sf_dir))


@register("stream_dedupe", """
SELECT DISTINCT event_id, user_id, event_type, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts FROM events WHERE ts IS NOT NULL""")
def stream_dedupe(spark, sf_dir):
    """T3 option: ``dropDuplicatesWithinWatermark`` over five deliveries of six days each; every delivery
    repeats a third of the one before (inside the watermark) and a fifth of the one three before (too late)."""
    from eventlake.streaming.dedupe import file_events, start_dedupe_stream
    apply_defaults(spark)
    events = standins.table(spark, sf_dir, "events").select(
        "event_id", "user_id", "event_type", F.col("ts").cast("timestamp").alias("ts"))
    events = events.withColumn("part", F.floor((F.dayofmonth("ts") - 1) / 6).cast("int"))
    source, base = scratch_dir(spark, "deliveries"), scratch_dir(spark, "deduped")
    # The last part also takes the days after the thirtieth.
    part = F.least(F.col("part"), F.lit(4))
    for n in range(5):
        again = (part == n - 1) & (F.col("event_id") % 3 == 0) | (part == n - 3) & (F.col("event_id") % 5 == 0)
        events.where((part == n) | again).drop("part").write.parquet(f"{source}/delivery-{n}")
        stream = file_events(spark, source, events.drop("part").schema)
        start_dedupe_stream(stream, base + "/events", base + "/_checkpoint", ["event_id"], "ts", "7 days").awaitTermination()
    return spark.read.parquet(base + "/events").withColumn("ts", ts_str("ts"))


@register("catalog_publish", O.with_(O.SILVER_CTE, """
SELECT NULLIF(event_url, '') AS event_url, NULLIF(title, '') AS title, NULLIF(venue, '') AS venue, NULLIF(city, '') AS city,
       event_date_text, strftime(event_date, '%Y-%m-%d %H:%M:%S') AS event_date, source, ingest_date
FROM silver"""))
def catalog_publish(spark, sf_dir):
    """K6/K7 external CSV table published twice by a catalog swap (first one source, then all); the first
    version is removed, and the table is read through the catalog."""
    from eventlake.plans.catalog import _silver
    from eventlake.sinks.publish import publish, remove_stale
    apply_defaults(spark)
    base, database = scratch_dir(spark, "published"), f"eventlake_{uuid.uuid4().hex[:8]}"
    silver = staged(_silver(spark, sf_dir), "silver-rows")
    publish(silver.where("source = 'sympla'"), database, "events", base, "csv")
    publish(silver, database, "events", base, "csv")
    remove_stale(spark, database, "events", base, grace_seconds=-1)
    return spark.table(f"{database}.events").withColumn("event_date", ts_str("event_date"))


# --- jobs over files: archives, exports, client tables ------------------------------

@register("silver_csv_to_gold", O.with_(O.GOLD_CTE, "SELECT * FROM gold"))
def silver_csv_to_gold(spark, sf_dir):
    """K1/S2 Silver written as a CSV with header and read back, then the Gold job on it."""
    from eventlake.plans.catalog import _silver
    from eventlake.plans.jobs import silver_to_gold
    from eventlake.sinks.files import export_csv
    base = scratch_dir(spark, "silver-csv")
    export_csv(_silver(spark, sf_dir), f"{base}/events.csv")
    silver_to_gold(spark, f"{base}/events.csv", f"{base}/gold", silver_format="csv")
    return spark.read.parquet(f"{base}/gold")


_STAMP = "20250101_000000"


@register("gold_export_stamped", O.with_(O.GOLD_CTE, f"""
SELECT nome, NULLIF(local, '') AS local, cidade, data, hora, origem, data_ingestao,
       'gold/eventos_padronizados_{_STAMP}.csv' AS source_key FROM gold"""))
def gold_export_stamped(spark, sf_dir):
    """K3/K4/X7/P10 Gold exported under its run stamp with the display headers, read back by the export
    reader (S6-S8)."""
    from eventlake.plans.catalog import _silver
    from eventlake.plans.jobs import silver_to_gold
    from eventlake.schemas import GOLD_DISPLAY_NAMES
    from eventlake.sources.documents import read_gold_exports
    base = scratch_dir(spark, "gold-stamped")
    _silver(spark, sf_dir).write.parquet(f"{base}/silver")
    silver_to_gold(spark, f"{base}/silver", f"{base}/table", export_dir=f"{base}/exports/gold", run_stamp=_STAMP)
    rows = read_gold_exports(spark, f"{base}/exports")
    return rows.select(*[F.col(f"`{shown.lower()}`").alias(name) for name, shown in GOLD_DISPLAY_NAMES.items()], "source_key")


@register("bronze_archive", O.with_(SILVER_FILES_CTE, """
SELECT '2025-01-01' AS run_date, source, ingest_date, count(*) AS n_rows, count(DISTINCT event_url) AS n_urls, count(DISTINCT title) AS n_titles
FROM unified GROUP BY source, ingest_date"""))
def bronze_archive(spark, sf_dir):
    """K9 the Bronze job's archive: every consumed row, duplicates included, by run, source and ingest date;
    the same run twice leaves one copy."""
    from eventlake.plans.jobs import bronze_to_silver
    apply_defaults(spark)
    root, base = scratch_dir(spark, "bronze-archived"), scratch_dir(spark, "archive")
    standins.write_bronze_tree(spark, sf_dir, root)
    for _ in range(2):
        bronze_to_silver(spark, root, f"{base}/silver", run_date="2025-01-01", archive_path=f"{base}/rows", n_buckets=16)
    drop_folder(spark, root)
    rows = spark.read.parquet(f"{base}/rows")
    by = [F.col(c).cast("string").alias(c) for c in ("run_date", "source", "ingest_date")]
    return rows.groupBy(*by).agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("event_url").alias("n_urls"),
                                 F.count_distinct("title").alias("n_titles"))


@register("silver_archive", O.with_(O.SILVER_CTE, """
SELECT event_url, title, venue, city, event_date_text, strftime(event_date, '%Y-%m-%d %H:%M:%S') AS event_date,
       source, ingest_date, '2025-01-01' AS run_date
FROM silver"""))
def silver_archive(spark, sf_dir):
    """K10 the Gold job's archive: the consumed Silver rows under the run's date."""
    from eventlake.plans.catalog import _silver
    from eventlake.plans.jobs import silver_to_gold
    base = scratch_dir(spark, "silver-archived")
    _silver(spark, sf_dir).write.parquet(f"{base}/silver")
    silver_to_gold(spark, f"{base}/silver", f"{base}/gold", archive_path=f"{base}/rows", run_date="2025-01-01")
    return spark.read.parquet(f"{base}/rows").withColumn("run_date", F.col("run_date").cast("string"))


@register("client_table_csv", O.with_(O.FEATURES_CTE, """
SELECT f.client_id, i.client_id_seq, f.qtd_compras, CAST(f.gmv_total AS DOUBLE) AS gmv_total, f.seg_recorrencia, f.seg_velocidade, f.modal_route
FROM features f JOIN ids i ON i.client_id = f.client_id"""))
def client_table_csv(spark, sf_dir):
    """K12/S10/J4 the clients job run twice: ids are kept in a client map, the final table is written as a
    header CSV and read back with its types."""
    from eventlake.plans.jobs import clients_job, read_client_table
    apply_defaults(spark)
    p, base = standins.purchases(spark, sf_dir), scratch_dir(spark, "client-table")
    early = p.where(F.year("purchased_at") < 1970)  # no client yet: the map starts empty
    clients_job(spark, early, f"{base}/first", as_of="1970-01-01", client_map_path=f"{base}/map")
    clients_job(spark, p, f"{base}/clients", client_map_path=f"{base}/map", fmt="csv")
    table = read_client_table(spark, f"{base}/clients", fmt="csv")
    return table.select("client_id", "client_id_seq", "qtd_compras", F.col("gmv_total").cast("double").alias("gmv_total"),
                        "seg_recorrencia", "seg_velocidade", "modal_route")


@register("input_readiness", """
SELECT r.name, CASE WHEN r.flag IS NOT NULL AND EXISTS (SELECT 1 FROM lineitem l WHERE l.l_returnflag = r.flag) THEN 'OK' ELSE 'FALTANDO' END AS status
FROM (VALUES ('Bronze/database Sympla', 'A'), ('bronze/database Sympla', NULL), ('bronze/database Ticket360', 'N'),
             ('Bronze/database Ticket360', NULL), ('Bronze/database Eventim', NULL), ('bronze/database Eventim', NULL),
             ('Bronze/database Evetim', 'R'), ('bronze/database Evetim', NULL)) r(name, flag)""")
def input_readiness(spark, sf_dir):
    """S9/S3 every registered feed folder of a Bronze tree: there with files, or missing."""
    from eventlake.schemas import FEED_FOLDERS
    from eventlake.sources.feeds import readiness
    apply_defaults(spark)
    root = scratch_dir(spark, "bronze-ready")
    standins.write_bronze_tree(spark, sf_dir, root)
    return readiness(spark, {f: f"{root}/{f}" for folders in FEED_FOLDERS.values() for f in folders}).select("name", "status")


# --- whole inputs where other queries take a part -----------------------------------

@register("gold_missing_columns", O.with_(O.GOLD_CTE, """
SELECT nome, CAST(NULL AS VARCHAR) AS local, cidade, data, hora, origem, CAST(NULL AS VARCHAR) AS data_ingestao FROM gold"""))
def gold_missing_columns(spark, sf_dir):
    """P8 Gold from a Silver frame without venue and ingest date: null-filled."""
    from eventlake.operators.gold import build_gold
    from eventlake.plans.catalog import _silver
    return build_gold(_silver(spark, sf_dir).drop("venue", "ingest_date"))


@register("pt_date_rows", O.with_(O.SILVER_CTE, """
SELECT source, event_date_text, ingest_date, strftime(event_date, '%Y-%m-%d %H:%M:%S') AS event_date, count(*) AS n_rows
FROM unified GROUP BY ALL"""))
def pt_date_rows(spark, sf_dir):
    """X1/X2/X3 every listing's date text with the timestamp read from it, row by row (equal rows counted)."""
    from eventlake.operators.silver import map_feed, unify
    apply_defaults(spark)
    rows = unify([map_feed(df, feed) for feed, df in standins.bronze_feeds(spark, sf_dir).items()])
    rows = rows.withColumn("event_date", ts_str("event_date"))
    return rows.groupBy("source", "event_date_text", "ingest_date", "event_date").agg(F.count(F.lit(1)).alias("n_rows"))


@register("doc_id_exports", O.with_(_DOCS_SQL, "SELECT * FROM d1 UNION ALL SELECT * FROM d2"))
def doc_id_exports(spark, sf_dir):
    """S8/P3/P12/P13/X18 documents of both exports."""
    from eventlake.operators.serve import flatten_documents
    from eventlake.plans.catalog import _docs
    apply_defaults(spark)
    first, second = _docs(spark, sf_dir)
    return flatten_documents(first.unionByName(second))


@register("city_filter_feeds", O.with_(O.SILVER_CTE, """
SELECT source, trim(city) AS cidade, count(*) AS n_rows FROM unified
WHERE city IS NOT NULL AND length(trim(city)) > 0 AND lower(trim(city)) NOT IN ('null', 'none', 'n/a', 'na')
GROUP BY source, trim(city)"""))
def city_filter_feeds(spark, sf_dir):
    """P9/P14/F2 usable cities of all three feeds after mapping."""
    from eventlake.functions.text import is_usable_city
    from eventlake.operators.silver import map_feed, unify
    apply_defaults(spark)
    rows = unify([map_feed(df, feed) for feed, df in standins.bronze_feeds(spark, sf_dir).items()])
    rows = rows.select("source", F.trim("city").alias("cidade")).filter(is_usable_city("cidade"))
    return rows.groupBy("source", "cidade").agg(F.count(F.lit(1)).alias("n_rows"))
