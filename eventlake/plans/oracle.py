"""Independent DuckDB SQL for the registered queries (the correctness oracle).

Each query re-renders its input from the driver tables exactly as
``plans/standins.py`` does, then computes the result with plain SQL, written
separately from the Spark code.  Output column names equal the Spark ones.
"""

from __future__ import annotations

from eventlake.plans.standins import (EVENT_URL_BASE, MONTH_ABBR, MONTH_FULL, WEEKDAY_ABBR,
                                      WEEKDAY_FULL)
from eventlake.schemas import PT_MONTHS


def _list(words: list[str]) -> str:
    return "[" + ", ".join("'" + w + "'" for w in words) + "]"


def _month_case(expr: str) -> str:
    whens = " ".join(f"WHEN '{k}' THEN {v}" for k, v in PT_MONTHS.items())
    return f"(CASE {expr} {whens} END)"


ROWS_CTE = f"""
rows AS (
  SELECT l.l_orderkey, l.l_linenumber, l.l_returnflag, l.l_linestatus,
         CAST(l.l_shipdate AS DATE) AS ship, o.o_orderpriority, c.c_mktsegment,
         n.n_name, p.p_name, p.p_brand,
         day(o.o_orderdate) AS ev_day, month(o.o_orderdate) AS ev_month,
         year(o.o_orderdate) AS ev_year, dayofweek(o.o_orderdate) + 1 AS ev_dow,
         o.o_custkey % 24 AS ev_hour, (o.o_orderkey % 4) * 15 AS ev_min
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN part p ON l.l_partkey = p.p_partkey
),
rows2 AS (
  SELECT *, '{EVENT_URL_BASE}' || CAST(l_orderkey AS VARCHAR) AS url,
         lpad(CAST(ev_hour AS VARCHAR), 2, '0') || ':' || lpad(CAST(ev_min AS VARCHAR), 2, '0') AS hhmm,
         CASE WHEN l_linestatus = 'F' THEN 'Bronze' ELSE 'bronze' END AS root,
         strftime(ship, '%Y-%m-%d') AS ship_s, strftime(ship, '%Y%m%d') || '-120000' AS stamp,
         strftime(date_trunc('month', ship), '%Y-%m-%d') AS month_s,
         strftime(date_trunc('month', ship), '%Y%m%d') || '-120000' AS month_stamp
  FROM rows
)"""

FEEDS_CTE = ROWS_CTE + f""",
sympla AS (
  SELECT url, p_name AS title,
         CASE c_mktsegment
           WHEN 'BUILDING' THEN p_name || ' - ' || n_name
           WHEN 'AUTOMOBILE' THEN p_name || '-arena - ' || n_name
           WHEN 'MACHINERY' THEN p_name || ' – ' || n_name
           WHEN 'FURNITURE' THEN p_brand || ' hall - ' || n_name || ', BR'
           ELSE p_name END AS place,
         CASE WHEN o_orderpriority = '1-URGENT'
              THEN CAST(ev_day AS VARCHAR) || ' de ' || {_list(MONTH_FULL)}[ev_month] || ' de '
                   || CAST(ev_year AS VARCHAR) || ' às ' || hhmm
              ELSE {_list(WEEKDAY_FULL)}[ev_dow] || ', ' || CAST(ev_day AS VARCHAR) || ' de '
                   || {_list(MONTH_ABBR)}[ev_month] || ' às ' || hhmm END AS date,
         root || '/database Sympla/date=' || ship_s || '/sympla_' || stamp || '.csv' AS src_file
  FROM rows2 WHERE l_returnflag = 'A'
),
ticket360 AS (
  SELECT url, upper(p_name) AS title, p_brand || ' - teatro' AS place,
         CASE c_mktsegment WHEN 'HOUSEHOLD' THEN 'N/A' WHEN 'MACHINERY' THEN '  '
              ELSE n_name END AS city,
         CAST(ev_day AS VARCHAR) || ' ' || upper({_list(MONTH_ABBR)}[ev_month]) || ' • '
           || {_list(WEEKDAY_ABBR)}[ev_dow] AS date,
         CASE WHEN o_orderpriority <> '3-MEDIUM'
              THEN root || '/database Ticket360/date=' || ship_s || '/ticket360_' || stamp || '.csv'
              ELSE root || '/database Ticket360/ticket360_' || stamp || '.csv' END AS src_file
  FROM rows2 WHERE l_returnflag = 'N'
),
eventim AS (
  SELECT upper(p_name) AS artist, url, n_name || ' - Sp' AS location,
         {_list(WEEKDAY_ABBR)}[ev_dow] || '. ' || lpad(CAST(ev_day AS VARCHAR), 2, '0') || '/'
           || lpad(CAST(ev_month AS VARCHAR), 2, '0') || '/' || CAST(ev_year AS VARCHAR)
           || ', ' || hhmm AS date,
         'Bronze/database ' || CASE WHEN l_linestatus = 'F' THEN 'Eventim' ELSE 'Evetim' END
           || '/date=' || ship_s || '/eventim_' || stamp || '.csv' AS src_file
  FROM rows2 WHERE l_returnflag = 'R'
)"""

PT_LONG = r"([0-9]{1,2})\s+de\s+([a-zçãé]+)(?:\s+de\s+([0-9]{4}))?(?:\s+às\s+([0-9]{1,2}):([0-9]{2}))?"
PT_SHORT = r"([0-9]{1,2})\s+([a-z]{3})"


def _ts(y: str, m: str, d: str, hh: str, mi: str) -> str:
    return (f"CASE WHEN {y} BETWEEN 1 AND 9999 AND {m} IS NOT NULL AND {d} IS NOT NULL THEN "
            f"try_strptime(printf('%04d-%02d-%02d %02d:%02d', {y}, {m}, {d}, {hh}, {mi}), "
            f"'%Y-%m-%d %H:%M') END")


def pt_ts_sql(text: str, year: str) -> str:
    """SQL for the Portuguese parser followed by the four fixed patterns."""
    t = f"lower({text})"

    def g(rx, i):
        return f"regexp_extract({t}, '{rx}', {i})"

    def num(rx, i):
        return f"TRY_CAST(NULLIF({g(rx, i)}, '') AS INTEGER)"

    long_ts = _ts(f"COALESCE({num(PT_LONG, 3)}, {year})", _month_case(g(PT_LONG, 2)),
                  num(PT_LONG, 1), f"COALESCE({num(PT_LONG, 4)}, 0)", f"COALESCE({num(PT_LONG, 5)}, 0)")
    short_ts = _ts(year, _month_case(g(PT_SHORT, 2)), num(PT_SHORT, 1), "0", "0")
    fmts = ["%Y-%m-%d %H:%M:%S", "%Y-%m-%d", "%d/%m/%Y %H:%M", "%d/%m/%Y"]
    fallbacks = ", ".join(f"try_strptime({text}, '{f}')" for f in fmts)
    return f"COALESCE({long_ts}, {short_ts}, {fallbacks})"


def ingest_sql(path: str) -> str:
    d = f"regexp_extract({path}, 'date=([0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}})', 1)"
    s = f"regexp_extract({path}, '_([0-9]{{8}})-[0-9]{{6}}\\.csv$', 1)"
    return (f"COALESCE(NULLIF({d}, ''), CASE WHEN length({s}) > 0 THEN substr({s}, 1, 4) || '-' "
            f"|| substr({s}, 5, 2) || '-' || substr({s}, 7, 2) END)")


def _mapped(feed: str, title: str, venue: str, city: str) -> str:
    ing = ingest_sql("src_file")
    return f"""
  SELECT url AS event_url, {title} AS title, {venue} AS venue, {city} AS city,
         date AS event_date_text,
         {pt_ts_sql('date', f'year(CAST({ing} AS DATE))')} AS event_date,
         '{feed}' AS source, {ing} AS ingest_date, src_file
  FROM {feed}"""


CITY_FROM_VENUE = "trim(regexp_extract(place, '-\\s*([^-]*)$', 1))"

SILVER_CTE = FEEDS_CTE + f""",
unified AS (
  {_mapped('sympla', 'title', 'place', CITY_FROM_VENUE)}
  UNION ALL {_mapped('ticket360', 'title', 'place', 'city')}
  UNION ALL {_mapped('eventim', 'artist', 'location', 'CAST(NULL AS VARCHAR)')}
),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY event_url ORDER BY
      ingest_date DESC NULLS LAST, source ASC NULLS LAST, src_file ASC NULLS LAST,
      title ASC NULLS LAST, venue ASC NULLS LAST, city ASC NULLS LAST,
      event_date_text ASC NULLS LAST, event_date ASC NULLS LAST) AS rn
  FROM unified WHERE event_url IS NOT NULL AND length(event_url) > 0
),
silver AS (
  SELECT event_url, title, venue, city, event_date_text, event_date, source, ingest_date, src_file
  FROM ranked WHERE rn = 1
)"""


def brt(expr: str, fmt: str) -> str:
    return f"strftime(({expr} AT TIME ZONE 'UTC') AT TIME ZONE 'America/Sao_Paulo', '{fmt}')"


GOLD_CTE = SILVER_CTE + f""",
trimmed AS (
  SELECT trim(title) AS title, trim(venue) AS venue, trim(city) AS city, trim(source) AS source,
         trim(ingest_date) AS ingest_date, event_date
  FROM silver
),
gold AS (
  SELECT title AS nome,
         trim(regexp_replace(venue, '\\s*[-–—][^-–—]*$', '')) AS local,
         city AS cidade,
         {brt('event_date', '%d/%m/%Y')} AS data,
         {brt('event_date', '%H:%M')} AS hora,
         source AS origem,
         {brt('CAST(ingest_date AS TIMESTAMP)', '%d/%m/%Y %H:%M')} AS data_ingestao
  FROM trimmed
  WHERE city IS NOT NULL AND length(trim(city)) > 0
    AND lower(city) NOT IN ('null', 'none', 'n/a', 'na')
)"""


def with_(cte: str, body: str) -> str:
    return "WITH " + cte.strip() + "\n" + body


# --- documents / upsert -----------------------------------------------------

def _export_rows(cond: str, venue: str, key: str) -> str:
    return f"""
  SELECT trim(o_orderpriority) AS nome, {venue} AS local, n_name AS cidade,
         strftime(o_orderdate, '%d/%m/%Y') AS data,
         lpad(CAST(o_custkey % 24 AS VARCHAR), 2, '0') || ':00' AS hora,
         COALESCE(NULLIF(CASE WHEN o_orderstatus = 'P' THEN '' ELSE o_orderstatus END, ''),
                  'sympla') AS origem,
         '{key}' AS source_key
  FROM ox WHERE {cond}"""


def _docs(src: str) -> str:
    return f"""
  SELECT md5(COALESCE(nome, '') || '|' || COALESCE(data, '') || '|' || COALESCE(hora, '') || '|'
             || COALESCE(cidade, '') || '|' || COALESCE(origem, '')) AS _id,
         nome, data, hora AS hora_local, cidade AS lugar_cidade, local AS lugar_venue,
         CAST(NULL AS VARCHAR) AS lugar_estado, origem, source_key
  FROM {src}"""


def _survivors(src: str) -> str:
    return f"""
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY _id ORDER BY source_key DESC NULLS LAST,
                                 lugar_venue ASC NULLS LAST) AS rn
    FROM {src}) WHERE rn = 1"""


def docs_cte(k1: str, k2: str) -> str:
    return f"""
ox AS (
  SELECT o.*, c.c_mktsegment, n.n_name FROM orders o
  JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey
),
f1 AS ({_export_rows("o_orderdate < TIMESTAMP '1999-01-01'", 'c_mktsegment', k1)}),
f2 AS ({_export_rows("o_orderdate >= TIMESTAMP '1998-01-01'", 'lower(c_mktsegment)', k2)}),
d1 AS ({_docs('f1')}),
d2 AS ({_docs('f2')}),
tgt AS ({_survivors('d1')}),
bat AS ({_survivors('d2')}),
merged AS (
  SELECT COALESCE(b._id, t._id) AS _id,
         CASE WHEN b._id IS NOT NULL THEN b.nome ELSE t.nome END AS nome,
         CASE WHEN b._id IS NOT NULL THEN b.data ELSE t.data END AS data,
         CASE WHEN b._id IS NOT NULL THEN b.hora_local ELSE t.hora_local END AS hora_local,
         CASE WHEN b._id IS NOT NULL THEN b.origem ELSE t.origem END AS origem,
         CASE WHEN b._id IS NOT NULL THEN b.source_key ELSE t.source_key END AS source_key,
         CASE WHEN b._id IS NOT NULL THEN b.lugar_cidade ELSE t.lugar_cidade END AS lugar_cidade,
         CASE WHEN b._id IS NOT NULL THEN b.lugar_venue ELSE t.lugar_venue END AS lugar_venue,
         CAST(NULL AS VARCHAR) AS lugar_estado
  FROM tgt t FULL OUTER JOIN bat b ON t._id = b._id
)"""


# --- purchases / clients ------------------------------------------------------

PURCHASES_CTE = """
fl AS (
  SELECT l_orderkey, l_suppkey FROM (
    SELECT l_orderkey, l_suppkey, row_number() OVER (PARTITION BY l_orderkey
           ORDER BY l_linenumber, l_suppkey, l_partkey) AS rn FROM lineitem) WHERE rn = 1
),
dest AS (
  SELECT fl.l_orderkey, n.n_name AS destination FROM fl
  JOIN supplier s ON fl.l_suppkey = s.s_suppkey JOIN nation n ON s.s_nationkey = n.n_nationkey
),
purchases AS (
  SELECT 'cliente_' || CAST(o.o_custkey AS VARCHAR) AS client_id, o.o_orderkey AS purchase_id,
         CAST(o.o_orderdate AS TIMESTAMP) AS purchased_at,
         CAST(o.o_totalprice AS DECIMAL(18,2)) AS gmv, n.n_name AS origin, d.destination,
         CAST(o.o_orderdate AS DATE) AS d,
         CASE WHEN n.n_name IS NOT NULL AND d.destination IS NOT NULL
              THEN n.n_name || ' -> ' || d.destination END AS route
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  LEFT JOIN dest d ON d.l_orderkey = o.o_orderkey
),
as_of AS (SELECT max(d) AS as_of FROM purchases)"""

FEATURES_CTE = PURCHASES_CTE + """,
modal AS (
  SELECT client_id, route AS modal_route FROM (
    SELECT client_id, route, row_number() OVER (PARTITION BY client_id
           ORDER BY count(*) DESC, route ASC) AS rn
    FROM purchases WHERE route IS NOT NULL GROUP BY client_id, route) WHERE rn = 1
),
agg AS (
  SELECT client_id, count(*) AS qtd_compras, CAST(sum(gmv) AS DECIMAL(18,2)) AS gmv_total,
         sum(CAST(gmv * 100 AS BIGINT)) AS cents, min(d) AS first_purchase, max(d) AS last_purchase,
         sum(CASE WHEN dayofweek(d) IN (0, 6) THEN 1 ELSE 0 END) AS n_weekend
  FROM purchases GROUP BY client_id
),
features AS (
  SELECT a.client_id, qtd_compras, gmv_total, CAST(first_purchase AS VARCHAR) AS first_purchase,
         CAST(last_purchase AS VARCHAR) AS last_purchase,
         CAST(cents AS DOUBLE) / qtd_compras / 100 AS ticket_medio,
         date_diff('day', first_purchase, last_purchase) AS tenure_days,
         CASE WHEN qtd_compras > 1 THEN CAST(date_diff('day', first_purchase, last_purchase) AS DOUBLE)
              / (qtd_compras - 1) END AS mean_gap_days,
         date_diff('day', last_purchase, (SELECT as_of FROM as_of)) AS recency_days,
         CAST(n_weekend AS DOUBLE) / qtd_compras AS weekend_share,
         CASE WHEN qtd_compras <= 7 THEN 'ocasional' WHEN qtd_compras <= 12 THEN 'regular'
              ELSE 'recorrente' END AS seg_recorrencia,
         CASE WHEN qtd_compras <= 1 THEN 'sem_intervalo'
              WHEN date_diff('day', first_purchase, last_purchase) <= 175 * (qtd_compras - 1) THEN 'rapido'
              WHEN date_diff('day', first_purchase, last_purchase) <= 277 * (qtd_compras - 1) THEN 'moderado'
              ELSE 'lento' END AS seg_velocidade,
         m.modal_route
  FROM agg a LEFT JOIN modal m ON a.client_id = m.client_id
),
ids AS (
  SELECT client_id, row_number() OVER (ORDER BY client_id) AS client_id_seq
  FROM (SELECT DISTINCT client_id FROM purchases)
)"""

SEQ_CTE = PURCHASES_CTE + """,
seq AS (
  SELECT client_id, purchase_id, d, route,
         lead(d) OVER w AS next_d, lead(route) OVER w AS next_route
  FROM purchases WINDOW w AS (PARTITION BY client_id ORDER BY purchased_at, purchase_id)
),
top20 AS (
  SELECT route, count(*) AS n_purchases FROM purchases WHERE route IS NOT NULL
  GROUP BY route ORDER BY n_purchases DESC, route ASC LIMIT 20
)"""


def easter_sql(y: str) -> str:
    a, b, c = f"({y} % 19)", f"({y} // 100)", f"({y} % 100)"
    d, e = f"({b} // 4)", f"({b} % 4)"
    f = f"(({b} + 8) // 25)"
    g = f"(({b} - {f} + 1) // 3)"
    h = f"((19 * {a} + {b} - {d} - {g} + 15) % 30)"
    i, k = f"({c} // 4)", f"({c} % 4)"
    l_ = f"((32 + 2 * {e} + 2 * {i} - {h} - {k}) % 7)"
    m = f"(({a} + 11 * {h} + 22 * {l_}) // 451)"
    t = f"({h} + {l_} - 7 * {m} + 114)"
    return f"make_date({y}, CAST({t} // 31 AS INTEGER), CAST({t} % 31 + 1 AS INTEGER))"


def holidays_cte(fixed, movable) -> str:
    parts = []
    for mo, dy, name, since in fixed:
        cond = f"WHERE y >= {since}" if since else ""
        parts.append(f"SELECT make_date(y, {mo}, {dy}) AS holiday_date, '{name}' AS name, "
                     f"'nacional' AS scope FROM years {cond}")
    for off, name, scope in movable:
        parts.append(f"SELECT CAST({easter_sql('y')} + INTERVAL ({off}) DAY AS DATE) AS holiday_date, "
                     f"'{name}' AS name, '{scope}' AS scope FROM years")
    return """
years AS (
  SELECT CAST(range AS INTEGER) AS y FROM range(
    (SELECT CAST(year(min(d)) - 1 AS BIGINT) FROM purchases),
    (SELECT CAST(year(max(d)) + 2 AS BIGINT) FROM purchases))
),
hol AS (""" + "\n  UNION ALL ".join(parts) + """
),
hd AS (SELECT holiday_date, min(name) AS holiday_name FROM hol GROUP BY holiday_date)"""


# Feeds written as monthly scrape folders (file-based queries).
SILVER_MONTH_CTE = SILVER_CTE.replace("|| ship_s ||", "|| month_s ||").replace("|| stamp ||", "|| month_stamp ||")
