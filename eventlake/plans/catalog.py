"""Registered queries: name -> (spark, sf_dir) -> DataFrame, and their SQL oracles.

Every query reads the driver tables (or data Spark derives from them) in full.
Timestamps are returned as ``yyyy-MM-dd HH:mm:ss`` strings so results compare
without zone conversions on the client side.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlake.plans import oracle as O
from eventlake.plans import standins
from eventlake.session import apply_defaults

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def ts_str(c) -> F.Column:
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss")


def _silver(spark: SparkSession, sf_dir: str, keep_src_file: bool = False) -> DataFrame:
    from eventlake.operators.silver import build_silver
    apply_defaults(spark)
    return build_silver(standins.bronze_feeds(spark, sf_dir), keep_src_file=keep_src_file)


# --- Bronze -> Silver -> Gold ---------------------------------------------

@register("gold_presentation", O.with_(O.GOLD_CTE, "SELECT * FROM gold"))
def gold_presentation(spark, sf_dir):
    """Flagship: three feeds -> canonical rows -> union, dedupe -> presentation table."""
    from eventlake.operators.gold import build_gold
    return build_gold(_silver(spark, sf_dir))


@register("feed_union_dedup", O.with_(O.SILVER_CTE, """
SELECT event_url, title, venue, city, event_date_text,
       strftime(event_date, '%Y-%m-%d %H:%M:%S') AS event_date, source, ingest_date
FROM silver"""))
def feed_union_dedup(spark, sf_dir):
    """P4-P7 feed mapping, U1 union by name, F1 URL filter, D1 deterministic dedupe."""
    s = _silver(spark, sf_dir)
    return s.withColumn("event_date", ts_str("event_date"))


@register("pt_date_parse", O.with_(O.FEEDS_CTE + f""",
parsed AS (
  SELECT source, date AS event_date_text,
         {O.pt_ts_sql('date', "year(CAST(" + O.ingest_sql('src_file') + " AS DATE))")} AS ts
  FROM (SELECT 'sympla' AS source, date, src_file FROM sympla
        UNION ALL SELECT 'ticket360', date, src_file FROM ticket360
        UNION ALL SELECT 'eventim', date, src_file FROM eventim)
)""", """
SELECT source, count(*) AS n_rows, count(ts) AS n_parsed,
       strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS min_ts,
       strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS max_ts,
       count(DISTINCT ts) AS n_distinct_ts
FROM parsed GROUP BY source"""))
def pt_date_parse(spark, sf_dir):
    """Parse every listing's date text (year from its ingest date)."""
    from eventlake.functions.dates import ingest_date_from_path, to_ts_any
    feeds = standins.bronze_feeds(spark, sf_dir)
    parts = []
    for feed, df in feeds.items():
        year = F.year(F.to_date(ingest_date_from_path("src_file")))
        parts.append(df.select(F.lit(feed).alias("source"), to_ts_any("date", year).alias("ts")))
    u = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return u.groupBy("source").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count("ts").alias("n_parsed"),
        ts_str(F.min("ts")).alias("min_ts"), ts_str(F.max("ts")).alias("max_ts"),
        F.count_distinct("ts").alias("n_distinct_ts"))


@register("source_counts", O.with_(O.SILVER_CTE, """
SELECT source, count(*) AS n_rows, count(DISTINCT src_file) AS n_files,
       min(ingest_date) AS first_ingest, max(ingest_date) AS last_ingest
FROM silver GROUP BY source"""))
def source_counts(spark, sf_dir):
    """A1 per-source row counts, D3 distinct source files, O4 date range per source."""
    s = _silver(spark, sf_dir, keep_src_file=True)
    return s.groupBy("source").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_distinct("src_file").alias("n_files"),
        F.min("ingest_date").alias("first_ingest"), F.max("ingest_date").alias("last_ingest"))


# --- serving: documents and upsert -----------------------------------------

def _docs(spark, sf_dir):
    from eventlake.operators.serve import build_documents, normalise_rows
    first, second = standins.gold_export_rows(spark, sf_dir)
    k1, k2 = standins.GOLD_EXPORT_KEYS
    return (build_documents(normalise_rows(first), k1),
            build_documents(normalise_rows(second), k2))


_DOCS_SQL = O.docs_cte(*standins.GOLD_EXPORT_KEYS)


@register("doc_id_md5", O.with_(_DOCS_SQL, "SELECT * FROM d1"))
def doc_id_md5(spark, sf_dir):
    """S8/P3 header + value normalising, P12 alias pick, X18 md5 key, P13 nested doc."""
    from eventlake.operators.serve import flatten_documents
    apply_defaults(spark)
    return flatten_documents(_docs(spark, sf_dir)[0])


@register("upsert_documents", O.with_(_DOCS_SQL, "SELECT * FROM merged"))
def upsert_documents(spark, sf_dir):
    """K8/J3 keyed upsert of the second export into the first (B14 survivor pick)."""
    from eventlake.operators.serve import batch_survivors, flatten_documents, upsert
    apply_defaults(spark)
    d1, d2 = _docs(spark, sf_dir)
    return flatten_documents(upsert(batch_survivors(d1), d2))


@register("upsert_counts", O.with_(_DOCS_SQL, """
SELECT (SELECT count(*) FROM d2) AS n_batch_rows, count(*) AS n_keys,
       count(t._id) AS n_updates, count(*) - count(t._id) AS n_inserts
FROM (SELECT DISTINCT _id FROM d2) k LEFT JOIN tgt t ON k._id = t._id"""))
def upsert_counts(spark, sf_dir):
    """A1 counts of an upsert: batch rows, keys, updates, inserts (F3: 0 rows -> 0)."""
    from eventlake.operators.serve import batch_survivors, upsert_stats
    apply_defaults(spark)
    d1, d2 = _docs(spark, sf_dir)
    return upsert_stats(batch_survivors(d1), d2)


# --- clients, labels, routes, enrichment ------------------------------------

def _purchases(spark, sf_dir):
    apply_defaults(spark)
    return standins.purchases(spark, sf_dir)


def _as_of(purchases) -> str:
    return str(purchases.agg(F.max(F.to_date("purchased_at"))).first()[0])


def _dates_to_str(df: DataFrame) -> DataFrame:
    """Query outputs: dates as ``yyyy-MM-dd`` strings, exact money decimals as
    doubles (the cast of an exact decimal is the same double in every engine)."""
    return df.select(*[F.col(c).cast("string").alias(c) if t == "date"
                       else F.col(c).cast("double").alias(c) if t.startswith("decimal")
                       else F.col(c) for c, t in df.dtypes])


@register("client_totals", O.with_(O.FEATURES_CTE, """
SELECT client_id, qtd_compras, CAST(gmv_total AS DOUBLE) AS gmv_total, first_purchase, last_purchase
FROM features"""))
def client_totals_q(spark, sf_dir):
    """A4 per-client purchase count, exact GMV, first/last purchase."""
    from eventlake.operators.clients import client_totals
    return _dates_to_str(client_totals(_purchases(spark, sf_dir)))


@register("client_features", O.with_(O.FEATURES_CTE,
                                    "SELECT * REPLACE (CAST(gmv_total AS DOUBLE) AS gmv_total) FROM features"))
def client_features_q(spark, sf_dir):
    """A8 features + G1/G2 segments + modal route per client."""
    from eventlake.operators.clients import client_features
    p = _purchases(spark, sf_dir)
    return _dates_to_str(client_features(p, _as_of(p)))


@register("seg_recorrencia", O.with_(O.FEATURES_CTE, """
SELECT seg_recorrencia, count(*) AS n_clients FROM features GROUP BY seg_recorrencia"""))
def seg_recorrencia_q(spark, sf_dir):
    """G1 recurrence segment distribution (A2/O3 value counts)."""
    from eventlake.operators.clients import client_features, value_counts
    p = _purchases(spark, sf_dir)
    return value_counts(client_features(p, _as_of(p)), "seg_recorrencia")


@register("seg_velocidade", O.with_(O.FEATURES_CTE, """
SELECT seg_velocidade, count(*) AS n_clients FROM features GROUP BY seg_velocidade"""))
def seg_velocidade_q(spark, sf_dir):
    """G2 speed segment distribution (A2/O3 value counts)."""
    from eventlake.operators.clients import client_features, value_counts
    p = _purchases(spark, sf_dir)
    return value_counts(client_features(p, _as_of(p)), "seg_velocidade")


@register("client_ids", O.with_(O.FEATURES_CTE, "SELECT * FROM ids"))
def client_ids_q(spark, sf_dir):
    """J4 stable sequential client ids (distributed ranking)."""
    from eventlake.operators.clients import assign_ids
    return assign_ids(_purchases(spark, sf_dir), "client_id")


def clients_final(spark, sf_dir) -> DataFrame:
    """K12 final client table: ids + features + segments."""
    from eventlake.operators.clients import assign_ids, client_features
    p = _purchases(spark, sf_dir)
    ids = assign_ids(p, "client_id")
    return ids.join(client_features(p, _as_of(p)), "client_id")


@register("client_profile", O.with_(O.FEATURES_CTE, """,
final AS (SELECT i.client_id_seq, f.* FROM ids i JOIN features f ON i.client_id = f.client_id)
SELECT count(*) AS n_rows, 14 AS n_columns,
       'client_id,client_id_seq,qtd_compras,gmv_total,first_purchase,last_purchase,ticket_medio,tenure_days,mean_gap_days,recency_days,weekend_share,seg_recorrencia,seg_velocidade,modal_route' AS columns,
       count(DISTINCT client_id_seq) AS n_clients,
       CAST(sum(CAST(gmv_total * 100 AS BIGINT)) AS DOUBLE) / count(gmv_total) / 100 AS gmv_total_mean,
       median(CAST(gmv_total * 100 AS BIGINT)) / 100.0 AS gmv_total_median,
       CAST(sum(qtd_compras) AS DOUBLE) / count(qtd_compras) AS qtd_compras_mean
FROM final"""))
def client_profile_q(spark, sf_dir):
    """G3 profile: A7 shape/columns, A6 distinct clients, A3 GMV mean + exact median."""
    from eventlake.operators.clients import client_profile
    return client_profile(clients_final(spark, sf_dir))


@register("label_7_30", O.with_(O.SEQ_CTE, """
SELECT client_id, purchase_id, CAST(d AS VARCHAR) AS purchase_date,
       CAST(next_d AS VARCHAR) AS next_purchase_date, date_diff('day', d, next_d) AS days_to_next,
       CASE WHEN next_d IS NOT NULL AND date_diff('day', d, next_d) <= 7 THEN 1
            WHEN d + INTERVAL 7 DAY <= (SELECT as_of FROM as_of) THEN 0 END AS label_7d,
       CASE WHEN next_d IS NOT NULL AND date_diff('day', d, next_d) <= 30 THEN 1
            WHEN d + INTERVAL 30 DAY <= (SELECT as_of FROM as_of) THEN 0 END AS label_30d
FROM seq"""))
def label_7_30(spark, sf_dir):
    """L1 buy-again-within-7/30-days labels per purchase, censored at the data end."""
    from eventlake.operators.labels import next_purchase_labels
    p = _purchases(spark, sf_dir)
    return _dates_to_str(next_purchase_labels(p, _as_of(p)))


def _cutoffs(p):
    from eventlake.operators.labels import cutoff_dates
    r = p.agg(F.min(F.to_date("purchased_at")), F.max(F.to_date("purchased_at"))).first()
    return cutoff_dates(r[0], r[1], 6), str(r[1])


@register("label_cutoffs", O.with_(O.PURCHASES_CTE + """,
cuts AS (
  SELECT CAST(c AS DATE) AS cutoff FROM (
    SELECT unnest(generate_series(
      CAST(make_date(year((SELECT min(d) FROM purchases)), 1, 1) AS TIMESTAMP),
      CAST((SELECT max(d) FROM purchases) AS TIMESTAMP), INTERVAL 6 MONTH)) AS c)
  WHERE CAST(c AS DATE) > (SELECT min(d) FROM purchases) AND CAST(c AS DATE) < (SELECT max(d) FROM purchases)
),
feats AS (
  SELECT p.client_id, k.cutoff, count(*) AS n_purchases, CAST(sum(p.gmv) AS DECIMAL(18,2)) AS gmv_before,
         date_diff('day', max(p.d), k.cutoff) AS days_since_last
  FROM purchases p JOIN cuts k ON p.d <= k.cutoff GROUP BY p.client_id, k.cutoff
),
hits AS (
  SELECT p.client_id, k.cutoff, count(*) AS n_in_horizon
  FROM purchases p JOIN cuts k ON p.d > k.cutoff AND p.d <= k.cutoff + INTERVAL 30 DAY
  GROUP BY p.client_id, k.cutoff
)""", """
SELECT f.client_id, CAST(f.cutoff AS VARCHAR) AS cutoff, n_purchases, CAST(gmv_before AS DOUBLE) AS gmv_before,
       days_since_last,
       CASE WHEN h.n_in_horizon > 0 THEN 1
            WHEN f.cutoff + INTERVAL 30 DAY <= (SELECT as_of FROM as_of) THEN 0 END AS label
FROM feats f LEFT JOIN hits h ON f.client_id = h.client_id AND f.cutoff = h.cutoff"""))
def label_cutoffs(spark, sf_dir):
    """L2 (client, cutoff) features up to the cutoff and buy-within-30-days label."""
    from eventlake.operators.labels import cutoff_labels
    p = _purchases(spark, sf_dir)
    cuts, as_of = _cutoffs(p)
    return _dates_to_str(cutoff_labels(p, cuts, 30, as_of))


@register("route_top20", O.with_(O.SEQ_CTE, "SELECT * FROM top20"))
def route_top20(spark, sf_dir):
    """O2/R2 the 20 most frequent origin-destination routes."""
    from eventlake.operators.routes import top_routes
    return top_routes(_purchases(spark, sf_dir), 20)


@register("route_next", O.with_(O.SEQ_CTE, """
SELECT client_id, purchase_id,
       CASE WHEN route IN (SELECT route FROM top20) THEN route ELSE 'OUTROS' END AS route,
       CASE WHEN next_route IN (SELECT route FROM top20) THEN next_route ELSE 'OUTROS' END AS next_route
FROM seq WHERE route IS NOT NULL AND next_route IS NOT NULL"""))
def route_next(spark, sf_dir):
    """R1 next-route target per purchase, classes restricted to the top 20 (R2)."""
    from eventlake.operators.routes import next_route_targets
    return next_route_targets(_purchases(spark, sf_dir), 20)


@register("route_recommend", O.with_(O.SEQ_CTE + """,
trans AS (
  SELECT route, next_route, count(*) AS n FROM seq
  WHERE route IS NOT NULL AND next_route IS NOT NULL GROUP BY route, next_route
),
ranked AS (
  SELECT route, next_route, n, row_number() OVER (PARTITION BY route ORDER BY n DESC, next_route ASC) AS rk
  FROM trans
),
gtop AS (
  SELECT route AS rec, n_purchases AS score, row_number() OVER (ORDER BY n_purchases DESC, route ASC) AS rk
  FROM top20
),
last AS (
  SELECT client_id, route AS last_route FROM (
    SELECT client_id, route, row_number() OVER (PARTITION BY client_id
           ORDER BY purchased_at DESC, purchase_id DESC) AS rn FROM purchases) WHERE rn = 1
)""", """
SELECT l.client_id, l.last_route, 'transition' AS basis, r.rk AS rank, r.next_route AS recommended_route,
       r.n AS score
FROM last l JOIN ranked r ON l.last_route = r.route WHERE r.rk <= 3
UNION ALL
SELECT l.client_id, l.last_route, 'global' AS basis, g.rk AS rank, g.rec AS recommended_route, g.score
FROM last l JOIN gtop g ON g.rk <= 3
WHERE l.last_route IS NULL OR l.last_route NOT IN (SELECT route FROM trans)"""))
def route_recommend(spark, sf_dir):
    """R3 counts-based next-route recommendation (top 3), global-frequency fallback."""
    from eventlake.operators.routes import recommend_routes
    return recommend_routes(_purchases(spark, sf_dir), 3)


def _holidays_sql():
    from eventlake.operators.enrich import FIXED_HOLIDAYS, MOVABLE_HOLIDAYS
    return O.holidays_cte(FIXED_HOLIDAYS, MOVABLE_HOLIDAYS)


@register("holiday_enrich", O.with_(O.PURCHASES_CTE + "," + _holidays_sql(), """
SELECT p.purchase_id, p.client_id, CAST(p.d AS VARCHAR) AS purchase_date,
       h.holiday_name IS NOT NULL AS is_holiday, h.holiday_name,
       date_diff('day', p.d, (SELECT min(holiday_date) FROM hd x WHERE x.holiday_date >= p.d))
         AS days_to_next_holiday,
       date_diff('day', (SELECT max(holiday_date) FROM hd x WHERE x.holiday_date <= p.d), p.d)
         AS days_since_prev_holiday
FROM purchases p LEFT JOIN hd h ON h.holiday_date = p.d"""))
def holiday_enrich(spark, sf_dir):
    """J1 holiday enrichment: generated national holidays (fixed + Easter-based),
    flag/name and distance to the nearest holidays per purchase."""
    from eventlake.operators.enrich import brazil_holidays, holiday_features
    p = _purchases(spark, sf_dir)
    r = p.agg(F.min(F.to_date("purchased_at")), F.max(F.to_date("purchased_at"))).first()
    hol = brazil_holidays(spark, max(1, r[0].year - 1), min(9999, r[1].year + 1))
    return _dates_to_str(holiday_features(p, hol))


@register("event_proximity", """
SELECT p.event_id, p.user_id,
       (SELECT count(*) FROM events e WHERE e.user_id = p.user_id AND e.event_type = 'error'
          AND e.ts >= p.ts - INTERVAL 86400 SECOND AND e.ts <= p.ts) AS n_errors_24h
FROM events p WHERE p.event_type = 'purchase'""")
def event_proximity(spark, sf_dir):
    """J2 band join: errors of the same user in the 24 h before each purchase event
    (running-count probes, no pair expansion)."""
    from eventlake.operators.enrich import band_counts
    apply_defaults(spark)
    ev = standins.table(spark, sf_dir, "events")
    return band_counts(ev, "purchase", "error", 86400, out="n_errors_24h").drop("ts")


# --- scalar building blocks over the driver tables ---------------------------

BRONZE_BUCKET_URI = "s3://eventos-bronze/"


def _feed_files(spark, sf_dir):
    feeds = standins.bronze_feeds(spark, sf_dir)
    return (feeds["sympla"].select("src_file").unionByName(feeds["ticket360"].select("src_file"))
            .unionByName(feeds["eventim"].select("src_file")).distinct())


_FILES_SQL = """
files AS (SELECT DISTINCT src_file FROM (SELECT src_file FROM sympla UNION ALL
          SELECT src_file FROM ticket360 UNION ALL SELECT src_file FROM eventim)),
uris AS (SELECT src_file, '""" + BRONZE_BUCKET_URI + """' || replace(src_file, ' ', '%20') AS src_uri FROM files),
keys AS (
  SELECT src_uri, regexp_extract(src_uri, '^s3://([^/]*)', 1) AS bucket,
         replace(regexp_replace(regexp_extract(src_uri, '^s3://[^/]*(.*)$', 1), '^/+', ''), '%20', ' ')
           AS object_key
  FROM uris
)"""


@register("path_lineage", O.with_(O.FEEDS_CTE + "," + _FILES_SQL, """
SELECT src_uri, bucket, object_key,
       CASE WHEN object_key LIKE '%database Sympla/%' THEN 'sympla'
            WHEN object_key LIKE '%database Ticket360/%' THEN 'ticket360'
            WHEN object_key LIKE '%database Eventim/%' OR object_key LIKE '%database Evetim/%' THEN 'eventim'
            ELSE COALESCE(NULLIF(regexp_extract(object_key, 'source=([^/]+)/', 1), ''), 'desconhecida')
       END AS source,
       """ + O.ingest_sql("object_key") + """ AS ingest_date,
       NULLIF(regexp_extract(object_key, '(.*/date=[0-9]{4}-[0-9]{2}-[0-9]{2}/)', 1), '') AS date_prefix,
       split_part(object_key, '/', 1) || '/Arquivos Processados/source=' ||
         CASE WHEN object_key LIKE '%database Sympla/%' THEN 'sympla'
              WHEN object_key LIKE '%database Ticket360/%' THEN 'ticket360'
              ELSE 'eventim' END
         || '/date=' || COALESCE(NULLIF(regexp_extract(object_key, 'date=([0-9]{4}-[0-9]{2}-[0-9]{2})', 1), ''),
                                 '0000-00-00')
         || '/' || regexp_extract(object_key, '([^/]*)$', 1) AS archive_key
FROM keys"""))
def path_lineage(spark, sf_dir):
    """B18 percent-decoded object URIs; X17 bucket/key split; X14 source; X1 ingest
    date; X15 date prefix; X16 archive key; D3 distinct source files."""
    from eventlake.functions import text as X
    from eventlake.functions.dates import ingest_date_from_path
    apply_defaults(spark)
    files = _feed_files(spark, sf_dir)
    uri = F.concat(F.lit(BRONZE_BUCKET_URI), F.regexp_replace("src_file", " ", "%20"))
    u = files.select(uri.alias("src_uri"))
    k = u.select("src_uri", X.uri_bucket("src_uri").alias("bucket"),
                 X.decoded_path(X.uri_key("src_uri")).alias("object_key"))
    return k.select("src_uri", "bucket", "object_key",
                    X.source_from_path("object_key").alias("source"),
                    ingest_date_from_path("object_key", run_date="1970-01-01").alias("ingest_date"),
                    X.date_prefix("object_key").alias("date_prefix"),
                    X.archive_key("object_key").alias("archive_key"))


@register("city_filter", O.with_(O.FEEDS_CTE, """
SELECT trim(city) AS cidade, count(*) AS n_rows FROM ticket360
WHERE city IS NOT NULL AND length(trim(city)) > 0 AND lower(trim(city)) NOT IN ('null', 'none', 'n/a', 'na')
GROUP BY trim(city)"""))
def city_filter(spark, sf_dir):
    """P9 trim + F2 usable-city predicate (null, blank, null-like values dropped)."""
    from eventlake.functions.text import is_usable_city
    apply_defaults(spark)
    t = standins.bronze_feeds(spark, sf_dir)["ticket360"].select(F.trim("city").alias("cidade"))
    return t.filter(is_usable_city("cidade")).groupBy("cidade").agg(F.count(F.lit(1)).alias("n_rows"))


@register("brt_shift", """
SELECT event_id,
       """ + O.brt("CAST(ts AS TIMESTAMP)", "%d/%m/%Y") + """ AS data,
       """ + O.brt("CAST(ts AS TIMESTAMP)", "%H:%M") + """ AS hora,
       """ + O.brt("CAST(CAST(ts AS DATE) AS TIMESTAMP)", "%d/%m/%Y %H:%M") + """ AS data_ingestao
FROM events""")
def brt_shift(spark, sf_dir):
    """X4 UTC -> São Paulo display (date, time, and a date-only value's display)."""
    from eventlake.functions.dates import brt_display
    apply_defaults(spark)
    ev = standins.table(spark, sf_dir, "events")
    ts = F.col("ts").cast("timestamp")
    return ev.select("event_id", brt_display(ts, "dd/MM/yyyy").alias("data"),
                     brt_display(ts, "HH:mm").alias("hora"),
                     brt_display(F.to_date(ts).cast("timestamp"), "dd/MM/yyyy HH:mm").alias("data_ingestao"))


@register("header_normalise", """
SELECT c_custkey AS c_custkey, c_name AS _c_name, c_nationkey AS c_nationkey,
       c_mktsegment AS market_segment FROM customer""")
def header_normalise(spark, sf_dir):
    """P1 header normalising (BOM, whitespace runs, case), P2 required-column gate,
    S5 empty canonical frame for a feed lacking columns, U1 union by name."""
    from eventlake.sources.feeds import gate
    apply_defaults(spark)
    c = standins.table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("﻿C_CUSTKEY"), F.col("c_name").alias(" c_name"),
        F.col("c_nationkey").alias("c_NationKey"), F.col("c_mktsegment").alias("Market \t Segment"))
    good = gate(c, ["c_custkey", "_c_name"])
    empty = gate(c.select(" c_name"), ["c_custkey", "_c_name"], good.schema)
    return good.unionByName(empty, allowMissingColumns=True)


_JS_WS = "[\\s\\x{0b}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}\\x{feff}]"


def _js_trim_sql(x: str) -> str:
    return f"regexp_replace({x}, '^{_JS_WS}+|{_JS_WS}+$', '', 'g')"


@register("first_comma_split", """
SELECT doc_id,
       md5(""" + _js_trim_sql("split_part(text, ',', 1)") + """) AS head_md5,
       length(""" + _js_trim_sql("split_part(text, ',', 1)") + """) AS head_len,
       md5(""" + _js_trim_sql("regexp_extract(text, '(?s)^[^,]*,(.*)$', 1)") + """) AS rest_md5,
       length(""" + _js_trim_sql("regexp_extract(text, '(?s)^[^,]*,(.*)$', 1)") + """) AS rest_len
FROM documents""")
def first_comma_split(spark, sf_dir):
    """X10 split of whole texts at the first comma (head, rest; JS-style trim)."""
    from eventlake.functions.text import split_first_comma
    apply_defaults(spark)
    d = standins.table(spark, sf_dir, "documents")
    head, rest = split_first_comma("text")
    x = d.select("doc_id", head.alias("h"), rest.alias("r"))
    return x.select("doc_id", F.md5("h").alias("head_md5"), F.length("h").alias("head_len"),
                    F.md5("r").alias("rest_md5"), F.length("r").alias("rest_len"))


@register("utf8_fallback", """
SELECT doc_id, lang, md5(text) AS text_md5, length(text) AS n_chars FROM documents""")
def utf8_fallback(spark, sf_dir):
    """S6 byte decoding: UTF-8 (BOM dropped) when valid, else Latin-1; bytes are
    the documents encoded per language as UTF-8, UTF-8 with BOM or Latin-1."""
    from eventlake.functions.text import decode_text
    apply_defaults(spark)
    b = standins.document_bytes(spark, sf_dir)
    t = b.select("doc_id", "lang", decode_text("content").alias("t"))
    return t.select("doc_id", "lang", F.md5("t").alias("text_md5"), F.length("t").alias("n_chars"))


@register("feed_partitions", O.with_(O.FEEDS_CTE + """,
files AS (SELECT DISTINCT src_file FROM (SELECT src_file FROM sympla UNION ALL
          SELECT src_file FROM ticket360 UNION ALL SELECT src_file FROM eventim)),
tagged AS (
  SELECT regexp_extract(src_file, 'database ([^/]+)/', 1) AS label, src_file,
         NULLIF(regexp_extract(src_file, '(.*/date=[0-9]{4}-[0-9]{2}-[0-9]{2}/)', 1), '') AS prefix
  FROM files
),
per_label AS (
  SELECT label, count(*) AS n_files, count(DISTINCT prefix) AS n_prefixes, max(prefix) AS latest_prefix
  FROM tagged GROUP BY label
)""", """
SELECT r.label, r.feed, COALESCE(p.n_files, 0) AS n_files, COALESCE(p.n_prefixes, 0) AS n_prefixes,
       p.latest_prefix, p.label IS NOT NULL AS consumed
FROM (VALUES ('Sympla', 'sympla'), ('Ticket360', 'ticket360'), ('Eventim', 'eventim'),
             ('Evetim', 'eventim')) r(label, feed)
LEFT JOIN per_label p ON p.label = r.label"""))
def feed_partitions(spark, sf_dir):
    """S3 feed registry (case variants, misspelt folder); U3 consumed date prefixes;
    A5 latest prefix per folder; J5 registry entries with nothing consumed."""
    from eventlake.functions.text import date_prefix
    from eventlake.sources.feeds import FEED_LABELS, feed_label
    apply_defaults(spark)
    files = _feed_files(spark, sf_dir)
    tagged = files.select(feed_label(F.col("src_file")).alias("label"), "src_file",
                          date_prefix("src_file").alias("prefix"))
    per = tagged.groupBy("label").agg(F.count(F.lit(1)).alias("n_files"),
                                      F.count_distinct("prefix").alias("n_prefixes"),
                                      F.max("prefix").alias("latest_prefix"))
    reg = spark.createDataFrame(list(FEED_LABELS.items()), "label string, feed string")
    # Broadcast the fixed registry (four rows); every registry row is kept.
    j = per.join(F.broadcast(reg), "label", "right")
    return j.select("label", "feed", F.coalesce("n_files", F.lit(0)).alias("n_files"),
                    F.coalesce("n_prefixes", F.lit(0)).alias("n_prefixes"), "latest_prefix",
                    F.col("latest_prefix").isNotNull().alias("consumed"))


@register("first_seen_per_category", """
SELECT user_id, event_type, event_id FROM (
  SELECT user_id, event_type, event_id, row_number() OVER (PARTITION BY user_id, event_type
         ORDER BY ts, event_id) AS rn FROM events) WHERE rn = 1""")
def first_seen_per_category(spark, sf_dir):
    """D2/F5/U2 first-seen key within each category (category = user, key = event type),
    earliest by (time, id)."""
    from eventlake.operators.joins import first_by_order
    apply_defaults(spark)
    ev = standins.table(spark, sf_dir, "events").filter(F.col("event_type").isNotNull())
    first = first_by_order(ev, ["user_id", "event_type"], [F.col("ts"), F.col("event_id")])
    return first.select("user_id", "event_type", "event_id")


@register("date_phrase", O.with_(O.FEEDS_CTE, """
SELECT url, NULLIF(regexp_extract(date, '(?i)[0-9]{1,2}\\s+de\\s+[\\pL\\pN_]+\\s+às\\s+[0-9]{1,2}:[0-9]{2}', 0), '')
         AS phrase
FROM sympla"""))
def date_phrase_q(spark, sf_dir):
    """X5 first `D de MÊS às HH:MM` phrase in a listing text."""
    from eventlake.functions.dates import date_phrase
    apply_defaults(spark)
    s = standins.bronze_feeds(spark, sf_dir)["sympla"]
    return s.select("url", date_phrase("date").alias("phrase"))


# --- HTML pages ----------------------------------------------------------------

def _link_sql(with_query_drop=True):
    return """
raw AS (
  SELECT page_id, url, unnest(l) AS href0, unnest(range(1, len(l) + 1)) AS pos
  FROM (SELECT page_id, url, regexp_extract_all(html, '<a\\b[^>]*href="([^"]*)"', 1) AS l FROM pages)
),
dec AS (
  SELECT page_id, url, pos,
         replace(replace(replace(replace(replace(href0, '&lt;', '<'), '&gt;', '>'), '&quot;', '"'),
                 '&#39;', ''''), '&amp;', '&') AS href
  FROM raw
),
absl AS (
  SELECT page_id, pos,
         split_part(CASE WHEN starts_with(href, 'http') THEN href
              ELSE regexp_extract(url, '^([a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*)', 1) || '/'
                   || regexp_replace(href, '^/+', '') END, '?', 1) AS link
  FROM dec
)"""


@register("links_extract", O.with_(_link_sql(), """
SELECT page_id, link, min(pos) AS pos FROM absl GROUP BY page_id, link"""))
def links_extract(spark, sf_dir):
    """S11/H1 anchors of stored pages: X11 absolute, X12 query dropped, D4 first
    occurrence per page kept with its position."""
    from eventlake.sources.html import extract_links
    apply_defaults(spark)
    pages = standins.table(spark, sf_dir, "pages")
    return extract_links(pages)


@register("links_paged", """
SELECT page_id, url, regexp_extract(url, '^([^?#]*)', 1) AS listing,
       COALESCE(TRY_CAST(NULLIF(regexp_extract(regexp_extract(url, '^[^?#]*\\?([^#]*)', 1),
                '(?:^|&)page=([^&]*)', 1), '') AS INTEGER), 0) AS page_no
FROM pages""")
def links_paged(spark, sf_dir):
    """H2/O1 pagination: listing (URL without query) and numeric page parameter
    (absent -> 0, so the base page sorts first)."""
    from eventlake.sources.html import paginate
    apply_defaults(spark)
    pages = standins.table(spark, sf_dir, "pages").select("page_id", "url")
    return paginate(pages, "url", "page").select("page_id", "url", "listing", "page_no")


def _cards(spark, sf_dir):
    from eventlake.functions.text import url_origin
    from eventlake.session import staged
    from eventlake.sources.html import cards_to_feed, first_seen, paginate, parse_cards, stop_at_empty_page
    apply_defaults(spark)
    pages = paginate(standins.listing_pages(spark, sf_dir), "url", "p") \
        .withColumn("origin", url_origin("url"))
    # One parse of every page; materialised once for the per-site branches below.
    raw = staged(parse_cards(pages), "cards")
    a = stop_at_empty_page(raw.filter(F.col("site") == "sympla"))
    a = cards_to_feed(a, "sympla", base_url=standins.PAGE_HOST)
    b = raw.filter((F.col("site") == "ticket360") & (F.col("pos") > 0))
    b = first_seen(cards_to_feed(b, "ticket360", page_origin=F.col("origin")))
    c = raw.filter((F.col("site") == "eventim") & (F.col("pos") > 0))
    c = cards_to_feed(c, "eventim")
    c = first_seen(c.filter(F.col("url").isNotNull() & (F.col("url") != "")))
    none = F.lit(None).cast("string")
    return (a.select(F.lit("sympla").alias("site"), "url", "title", "place", none.alias("city"), "date")
            .unionByName(b.select(F.lit("ticket360").alias("site"), "url", "title", "place", "city", "date"))
            .unionByName(c.select(F.lit("eventim").alias("site"), "url",
                                  F.nullif(F.col("artist"), F.lit("")).alias("title"),
                                  F.col("location").alias("place"), none.alias("city"), "date")))


@register("cards_listing", O.with_(O.ROWS_CTE + """,
cards AS (
  SELECT 'sympla' AS site, url, p_name AS title,
         CASE c_mktsegment
           WHEN 'BUILDING' THEN p_name || ' - ' || n_name
           WHEN 'AUTOMOBILE' THEN p_name || '-arena - ' || n_name
           WHEN 'MACHINERY' THEN p_name || ' – ' || n_name
           WHEN 'FURNITURE' THEN p_brand || ' hall - ' || n_name || ', BR'
           ELSE p_name END AS place,
         CAST(NULL AS VARCHAR) AS city,
         NULLIF(regexp_extract(CASE WHEN o_orderpriority = '1-URGENT' THEN '' ELSE
           CAST(ev_day AS VARCHAR) || ' de ' || """ + O._list(standins.MONTH_ABBR) + """[ev_month] || ' às ' || hhmm END,
           '(?i)[0-9]{1,2}\\s+de\\s+[\\pL\\pN_]+\\s+às\\s+[0-9]{1,2}:[0-9]{2}', 0), '') AS date,
         1 AS keep
  FROM rows2 WHERE l_returnflag = 'A'
  UNION ALL
  SELECT 'ticket360', url, upper(p_name), p_brand || ' - teatro',
         trim(CASE c_mktsegment WHEN 'HOUSEHOLD' THEN 'N/A' WHEN 'MACHINERY' THEN '  ' ELSE n_name END),
         CAST(ev_day AS VARCHAR) || ' ' || upper(""" + O._list(standins.MONTH_ABBR) + """[ev_month]) || ' • '
           || """ + O._list(standins.WEEKDAY_ABBR) + """[ev_dow],
         row_number() OVER (PARTITION BY c_mktsegment, l_orderkey ORDER BY l_linenumber, upper(p_name),
                            p_brand, n_name)
  FROM rows2 WHERE l_returnflag = 'N'
  UNION ALL
  SELECT 'eventim', '""" + standins.PAGE_HOST + """/event/' || CAST(l_orderkey AS VARCHAR) || '/',
         upper(p_name), n_name || ' - Sp', CAST(NULL AS VARCHAR),
         """ + O._list(standins.WEEKDAY_ABBR) + """[ev_dow] || '. ' || lpad(CAST(ev_day AS VARCHAR), 2, '0') || '/'
           || lpad(CAST(ev_month AS VARCHAR), 2, '0') || '/' || CAST(ev_year AS VARCHAR) || ', ' || hhmm,
         row_number() OVER (PARTITION BY c_mktsegment, l_orderkey ORDER BY l_linenumber, upper(p_name),
                            n_name, hhmm)
  FROM rows2 WHERE l_returnflag = 'R'
)""", "SELECT site, url, title, place, city, date FROM cards WHERE keep = 1"))
def cards_listing(spark, sf_dir):
    """H3-H5 card extraction from listing pages of the three site layouts
    (mapInPandas + a small tree builder), X5/X6/X10/X11/X13 field rules, H6 stop at the
    first empty page, D2/F5 first-seen URL per listing, U2 all pages appended."""
    return _cards(spark, sf_dir)


# --- files: CSV trees, exports, streaming ------------------------------------------

_SILVER_KEYS_SQL = O.with_(O.SILVER_MONTH_CTE, "SELECT event_url, source, ingest_date FROM silver")


@register("bronze_csv_ingest", _SILVER_KEYS_SQL)
def bronze_csv_ingest(spark, sf_dir):
    """S1/S3/S4/S12 recursive CSV feed reading (case variants, misspelt folder, B19
    header groups, lineage from the file path), K5 Bronze layout, then U1/F1/D1
    into a keyed Silver table (K1/K6 bucketed upsert)."""
    from eventlake.plans.jobs import bronze_to_silver
    from eventlake.session import scratch_dir
    apply_defaults(spark)
    root = scratch_dir(spark, "bronze")
    standins.write_bronze_tree(spark, sf_dir, root, vary_headers=True)
    silver = scratch_dir(spark, "silver") + "/events"
    bronze_to_silver(spark, root, silver, run_date="1970-01-01", n_buckets=16)
    return spark.read.parquet(silver).select("event_url", "source", "ingest_date")


@register("stream_ingest", _SILVER_KEYS_SQL)
def stream_ingest(spark, sf_dir):
    """T1 incremental file-stream ingest (availableNow, checkpointed), T3 URL upsert
    via foreachBatch into the keyed Silver table.  T2 archiving is configured
    (``cleanSource=archive``); Spark moves a file once a later batch commits."""
    from eventlake.session import drop_folder, scratch_dir
    from eventlake.streaming.ingest import start_silver_stream
    apply_defaults(spark)
    root = scratch_dir(spark, "bronze-stream")
    standins.write_bronze_tree(spark, sf_dir, root)
    base = scratch_dir(spark, "silver-stream")
    q = start_silver_stream(spark, root, base + "/events", base + "/_checkpoint",
                            archive_dir=base + "/_archive", n_buckets=16, run_date="1970-01-01")
    q.awaitTermination()
    drop_folder(spark, root)
    return spark.read.parquet(base + "/events").select("event_url", "source", "ingest_date")


@register("gold_csv_roundtrip", O.with_(_DOCS_SQL, "SELECT * FROM merged"))
def gold_csv_roundtrip(spark, sf_dir):
    """K3/K4 run-stamped quoted CSV exports (UTF-8 ',' and Latin-1 ';'), read back
    with S6 decoding, S7 delimiter choice, S8 normalised keys/values, then
    P12/P13/X18 documents and K8 bucketed $set upsert of both exports."""
    from eventlake.plans.jobs import gold_to_documents
    from eventlake.operators.serve import flatten_documents
    from eventlake.session import scratch_dir
    from eventlake.sinks.files import export_csv
    apply_defaults(spark)
    first, second = standins.gold_export_rows(spark, sf_dir)
    k1, k2 = standins.GOLD_EXPORT_KEYS
    out = scratch_dir(spark, "gold-exports")
    export_csv(first, f"{out}/{k1}", sep=",")
    docs = scratch_dir(spark, "docs") + "/eventos"
    gold_to_documents(spark, out, docs, n_buckets=16)
    out2 = scratch_dir(spark, "gold-exports")
    export_csv(second, f"{out2}/{k2}", sep=";", encoding="ISO-8859-1")
    gold_to_documents(spark, out2, docs, n_buckets=16)
    d = spark.read.parquet(docs).drop("_bucket")
    return flatten_documents(d)


# --- models (rows-only checks) -----------------------------------------------------

@register("ml_7_30")
def ml_7_30(spark, sf_dir):
    """L3 buy-within-7/30-days classifiers (logistic regression, time split at the
    last third of the cutoffs); scores for the held-out cutoffs."""
    from eventlake.operators.ml import purchase_horizon_model
    p = _purchases(spark, sf_dir)
    cuts, as_of = _cutoffs(p)
    split = str(cuts[(2 * len(cuts)) // 3])
    scores, _ = purchase_horizon_model(p, cuts, split, as_of)
    return _dates_to_str(scores)


@register("ml_route")
def ml_route(spark, sf_dir):
    """R4 next-route classifier (random forest over route + client history, top-20
    classes, time split); predictions for the held-out purchases."""
    from eventlake.operators.ml import next_route_model
    from eventlake.session import staged
    p = staged(_purchases(spark, sf_dir), "purchases")
    r = p.agg(F.min(F.to_date("purchased_at")), F.max(F.to_date("purchased_at"))).first()
    split = str(r[0] + (r[1] - r[0]) * 3 // 4)
    pred, _ = next_route_model(p, split)
    return pred


@register("sql_functions", ORACLE["pt_date_parse"])
def sql_functions(spark, sf_dir):
    """V1: the parser as SQL functions (``to_ts_any``, ``ingest_date_from_path``)
    used from ``spark.sql`` over the three feeds."""
    from eventlake.functions.sql import register_sql_functions
    apply_defaults(spark)
    register_sql_functions(spark)
    feeds = standins.bronze_feeds(spark, sf_dir)
    u = (feeds["sympla"].select(F.lit("sympla").alias("source"), "date", "src_file")
         .unionByName(feeds["ticket360"].select(F.lit("ticket360").alias("source"), "date", "src_file"))
         .unionByName(feeds["eventim"].select(F.lit("eventim").alias("source"), "date", "src_file")))
    u.createOrReplaceTempView("eventlake_feed_dates")
    return spark.sql("""
        SELECT source, count(*) AS n_rows, count(ts) AS n_parsed,
               date_format(min(ts), 'yyyy-MM-dd HH:mm:ss') AS min_ts,
               date_format(max(ts), 'yyyy-MM-dd HH:mm:ss') AS max_ts,
               count(DISTINCT ts) AS n_distinct_ts
        FROM (SELECT source, to_ts_any(date, year(to_date(ingest_date_from_path(src_file, NULL)))) AS ts
              FROM eventlake_feed_dates)
        GROUP BY source""")



TABLE_KEYS = {'orders': ['o_orderkey'], 'customer': ['c_custkey'], 'part': ['p_partkey'], 'supplier': ['s_suppkey'], 'lineitem': ['l_orderkey', 'l_linenumber'], 'events': ['event_id'], 'pages': ['page_id'], 'documents': ['doc_id'], 'conversations': ['conv_id', 'turn']}


@register("table_checks", """
SELECT 'orders' AS name, 'o_orderkey' AS keys, CAST(sum(n) AS BIGINT) AS n_rows, CAST(sum(CASE WHEN o_orderkey IS NULL THEN n ELSE 0 END) AS BIGINT) AS null_keys, CAST(count(*) FILTER (WHERE NOT (o_orderkey IS NULL) AND n > 1) AS BIGINT) AS dup_keys FROM (SELECT o_orderkey, count(*) AS n FROM orders GROUP BY o_orderkey)
UNION ALL
SELECT 'customer' AS name, 'c_custkey' AS keys, CAST(sum(n) AS BIGINT) AS n_rows, CAST(sum(CASE WHEN c_custkey IS NULL THEN n ELSE 0 END) AS BIGINT) AS null_keys, CAST(count(*) FILTER (WHERE NOT (c_custkey IS NULL) AND n > 1) AS BIGINT) AS dup_keys FROM (SELECT c_custkey, count(*) AS n FROM customer GROUP BY c_custkey)
UNION ALL
SELECT 'part' AS name, 'p_partkey' AS keys, CAST(sum(n) AS BIGINT) AS n_rows, CAST(sum(CASE WHEN p_partkey IS NULL THEN n ELSE 0 END) AS BIGINT) AS null_keys, CAST(count(*) FILTER (WHERE NOT (p_partkey IS NULL) AND n > 1) AS BIGINT) AS dup_keys FROM (SELECT p_partkey, count(*) AS n FROM part GROUP BY p_partkey)
UNION ALL
SELECT 'supplier' AS name, 's_suppkey' AS keys, CAST(sum(n) AS BIGINT) AS n_rows, CAST(sum(CASE WHEN s_suppkey IS NULL THEN n ELSE 0 END) AS BIGINT) AS null_keys, CAST(count(*) FILTER (WHERE NOT (s_suppkey IS NULL) AND n > 1) AS BIGINT) AS dup_keys FROM (SELECT s_suppkey, count(*) AS n FROM supplier GROUP BY s_suppkey)
UNION ALL
SELECT 'lineitem' AS name, 'l_orderkey,l_linenumber' AS keys, CAST(sum(n) AS BIGINT) AS n_rows, CAST(sum(CASE WHEN l_orderkey IS NULL OR l_linenumber IS NULL THEN n ELSE 0 END) AS BIGINT) AS null_keys, CAST(count(*) FILTER (WHERE NOT (l_orderkey IS NULL OR l_linenumber IS NULL) AND n > 1) AS BIGINT) AS dup_keys FROM (SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber)
UNION ALL
SELECT 'events' AS name, 'event_id' AS keys, CAST(sum(n) AS BIGINT) AS n_rows, CAST(sum(CASE WHEN event_id IS NULL THEN n ELSE 0 END) AS BIGINT) AS null_keys, CAST(count(*) FILTER (WHERE NOT (event_id IS NULL) AND n > 1) AS BIGINT) AS dup_keys FROM (SELECT event_id, count(*) AS n FROM events GROUP BY event_id)
UNION ALL
SELECT 'pages' AS name, 'page_id' AS keys, CAST(sum(n) AS BIGINT) AS n_rows, CAST(sum(CASE WHEN page_id IS NULL THEN n ELSE 0 END) AS BIGINT) AS null_keys, CAST(count(*) FILTER (WHERE NOT (page_id IS NULL) AND n > 1) AS BIGINT) AS dup_keys FROM (SELECT page_id, count(*) AS n FROM pages GROUP BY page_id)
UNION ALL
SELECT 'documents' AS name, 'doc_id' AS keys, CAST(sum(n) AS BIGINT) AS n_rows, CAST(sum(CASE WHEN doc_id IS NULL THEN n ELSE 0 END) AS BIGINT) AS null_keys, CAST(count(*) FILTER (WHERE NOT (doc_id IS NULL) AND n > 1) AS BIGINT) AS dup_keys FROM (SELECT doc_id, count(*) AS n FROM documents GROUP BY doc_id)
UNION ALL
SELECT 'conversations' AS name, 'conv_id,turn' AS keys, CAST(sum(n) AS BIGINT) AS n_rows, CAST(sum(CASE WHEN conv_id IS NULL OR turn IS NULL THEN n ELSE 0 END) AS BIGINT) AS null_keys, CAST(count(*) FILTER (WHERE NOT (conv_id IS NULL OR turn IS NULL) AND n > 1) AS BIGINT) AS dup_keys FROM (SELECT conv_id, turn, count(*) AS n FROM conversations GROUP BY conv_id, turn)""")
def table_checks_q(spark, sf_dir):
    """G4 output validation over the driver tables: rows, null keys, duplicate keys
    (A1 counts)."""
    from eventlake.operators.quality import table_checks
    apply_defaults(spark)
    return table_checks({t: (standins.table(spark, sf_dir, t), k) for t, k in TABLE_KEYS.items()})


@register("purchase_event_proximity", O.with_(O.PURCHASES_CTE + "," + O.SILVER_CTE, """
SELECT p.purchase_id,
  (SELECT count(*) FROM silver s WHERE trim(s.city) = p.destination AND s.event_date IS NOT NULL
     AND s.event_date >= p.purchased_at - INTERVAL 30 DAY AND s.event_date <= p.purchased_at) AS events_prev_30d,
  (SELECT count(*) FROM silver s WHERE trim(s.city) = p.destination AND s.event_date IS NOT NULL
     AND s.event_date >= p.purchased_at AND s.event_date <= p.purchased_at + INTERVAL 30 DAY) AS events_next_30d
FROM purchases p"""))
def purchase_event_proximity(spark, sf_dir):
    """J2 purchase <-> listed-event enrichment: same city (destination), events in
    the 30 days before / after each purchase (running-count band join, no pairs);
    K11 past/future split of the Silver events at the run date."""
    from eventlake.operators.enrich import event_proximity_counts
    from eventlake.operators.silver import split_by_run_date
    from eventlake.session import staged
    p = _purchases(spark, sf_dir)
    silver = staged(_silver(spark, sf_dir), "silver-rows")  # split, then read from both parts
    past, future = split_by_run_date(silver, "1998-08-02")
    events = past.unionByName(future)
    return event_proximity_counts(p, events, 30, 30)


# The other parts of the registry register themselves on import.
from eventlake.plans import catalog_ingest, catalog_models  # noqa: E402, F401
