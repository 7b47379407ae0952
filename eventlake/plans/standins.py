"""Shape the driver's test tables like the inputs the jobs expect.

These builders only *render* rows in the input schemas (feed CSV columns, purchase
rows, page rows).  They do none of the jobs' work: parsing, city/venue logic,
lineage, de-duplication and all analytics run in the library on their output,
and would run the same on real feeds.

Listing feeds: every ``lineitem`` row is one scraped listing of the event
``o_orderkey`` (so one event is listed several times, on different days and
sites).  The listing's site follows ``l_returnflag`` (A/N/R), its scrape day is
``l_shipdate``, the event's wall-clock time is ``o_orderdate`` plus a time of
day, titles come from ``part`` and places/cities from ``customer``/``nation``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations"]

# Rendering vocabulary of the synthetic feeds (our own choice of text shapes).
MONTH_ABBR = ["jan", "fev", "mar", "abr", "mai", "jun", "jul", "ago", "set", "out", "nov", "dez"]
MONTH_FULL = ["janeiro", "fevereiro", "março", "abril", "maio", "junho", "julho", "agosto",
              "setembro", "outubro", "novembro", "dezembro"]
WEEKDAY_ABBR = ["dom", "seg", "ter", "qua", "qui", "sex", "sáb"]       # Sunday first
WEEKDAY_FULL = ["Domingo", "Segunda", "Terça", "Quarta", "Quinta", "Sexta", "Sábado"]
FEED_BY_FLAG = {"A": "sympla", "N": "ticket360", "R": "eventim"}
EVENT_URL_BASE = "https://ingressos.exemplo.com.br/evento/"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _pick(arr: list[str], idx1) -> F.Column:
    """1-based lookup in a fixed word list."""
    return F.element_at(F.array(*[F.lit(x) for x in arr]), idx1)


def _two(c) -> F.Column:
    return F.lpad(c.cast("string"), 2, "0")


def listing_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per lineitem with the fields the three feeds render from."""
    # The driver tables are single-row-group files (one scan task); real feeds
    # arrive as many files.  Spread the listings so rendering and the jobs'
    # per-row work run in parallel, as they would over many input splits.
    n = int(spark.conf.get("spark.sql.shuffle.partitions", "8"))
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_returnflag", "l_linestatus",
        F.to_date("l_shipdate").alias("ship")).repartition(n, "l_orderkey")
    o = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    p = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand")
    # Orders take their customers first: there are fewer of them to move than listings.
    o = (o.join(c, o.o_custkey == c.c_custkey).join(n, c.c_nationkey == n.n_nationkey)
          .drop("c_custkey", "c_nationkey", "n_nationkey"))
    rows = (li.join(o, li.l_orderkey == o.o_orderkey)
              .join(p, li.l_partkey == p.p_partkey))
    d = F.to_date("o_orderdate")
    return rows.select(
        "l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus", "ship",
        "o_orderpriority", "c_mktsegment", "n_name", "p_name", "p_brand",
        F.dayofmonth(d).alias("ev_day"), F.month(d).alias("ev_month"),
        F.year(d).alias("ev_year"), F.dayofweek(d).alias("ev_dow"),
        F.pmod("o_custkey", F.lit(24)).alias("ev_hour"),
        (F.pmod("o_orderkey", F.lit(4)) * 15).alias("ev_min"),
    )


def _src_file(root: F.Column, site: str, feed: str, dated: F.Column) -> F.Column:
    stamp = F.concat(F.date_format("ship", "yyyyMMdd"), F.lit("-120000"))
    name = F.concat(F.lit(f"{feed}_"), stamp, F.lit(".csv"))
    folder = F.concat(root, F.lit(f"/database {site}/"))
    return F.when(dated, F.concat(folder, F.lit("date="), F.col("ship").cast("string"),
                                  F.lit("/"), name)) \
            .otherwise(F.concat(folder, name))


def bronze_feeds(spark: SparkSession, sf_dir: str, with_keys: bool = False, rows: DataFrame | None = None) -> dict[str, DataFrame]:
    """The three raw feeds (all-string columns in file order) plus ``src_file``
    (and, with ``with_keys``, the listing's order/line/segment for page rendering)."""
    rows = listing_rows(spark, sf_dir) if rows is None else rows
    keys = [F.col("l_orderkey").alias("_order"), F.col("l_linenumber").alias("_line"),
            F.col("c_mktsegment").alias("_segment"), F.col("ship").alias("_ship")] if with_keys else []
    url = F.concat(F.lit(EVENT_URL_BASE), F.col("l_orderkey").cast("string"))
    hhmm = F.concat(_two(F.col("ev_hour")), F.lit(":"), _two(F.col("ev_min")))
    seg = F.col("c_mktsegment")
    upper_root = F.when(F.col("l_linestatus") == "F", F.lit("Bronze")).otherwise(F.lit("bronze"))

    # Site A: `Sábado, 25 de out às 20:00`, some with full month and year.
    a_date = F.when(
        F.col("o_orderpriority") == "1-URGENT",
        F.concat(F.col("ev_day").cast("string"), F.lit(" de "), _pick(MONTH_FULL, F.col("ev_month")),
                 F.lit(" de "), F.col("ev_year").cast("string"), F.lit(" às "), hhmm),
    ).otherwise(
        F.concat(_pick(WEEKDAY_FULL, F.col("ev_dow")), F.lit(", "), F.col("ev_day").cast("string"),
                 F.lit(" de "), _pick(MONTH_ABBR, F.col("ev_month")), F.lit(" às "), hhmm))
    a_place = (F.when(seg == "BUILDING", F.concat("p_name", F.lit(" - "), "n_name"))
                .when(seg == "AUTOMOBILE", F.concat("p_name", F.lit("-arena - "), "n_name"))
                .when(seg == "MACHINERY", F.concat("p_name", F.lit(" – "), "n_name"))
                .when(seg == "FURNITURE", F.concat("p_brand", F.lit(" hall - "), "n_name", F.lit(", BR")))
                .otherwise(F.col("p_name")))
    sympla = rows.filter(F.col("l_returnflag") == "A").select(
        url.alias("url"), F.col("p_name").alias("title"), a_place.alias("place"),
        a_date.alias("date"),
        _src_file(upper_root, "Sympla", "sympla", F.lit(True)).alias("src_file"), *keys)

    # Site B: `24 OUT • sex`; city column with blanks and null-like values.
    b_date = F.concat(F.col("ev_day").cast("string"), F.lit(" "),
                      F.upper(_pick(MONTH_ABBR, F.col("ev_month"))), F.lit(" • "),
                      _pick(WEEKDAY_ABBR, F.col("ev_dow")))
    b_city = (F.when(seg == "HOUSEHOLD", F.lit("N/A"))
               .when(seg == "MACHINERY", F.lit("  "))
               .otherwise(F.col("n_name")))
    ticket360 = rows.filter(F.col("l_returnflag") == "N").select(
        url.alias("url"), F.upper("p_name").alias("title"),
        F.concat(F.col("p_brand"), F.lit(" - teatro")).alias("place"), b_city.alias("city"),
        b_date.alias("date"),
        _src_file(upper_root, "Ticket360", "ticket360",
                  F.col("o_orderpriority") != "3-MEDIUM").alias("src_file"), *keys)

    # Site C: `sáb. 25/10/2025, 20:00`; misspelt folder for half of the files.
    c_date = F.concat(_pick(WEEKDAY_ABBR, F.col("ev_dow")), F.lit(". "), _two(F.col("ev_day")),
                      F.lit("/"), _two(F.col("ev_month")), F.lit("/"),
                      F.col("ev_year").cast("string"), F.lit(", "), hhmm)
    c_site = F.when(F.col("l_linestatus") == "F", F.lit("Eventim")).otherwise(F.lit("Evetim"))
    c_file = F.concat(F.lit("Bronze/database "), c_site, F.lit("/date="), F.col("ship").cast("string"),
                      F.lit("/eventim_"), F.date_format("ship", "yyyyMMdd"), F.lit("-120000.csv"))
    eventim = rows.filter(F.col("l_returnflag") == "R").select(
        F.upper("p_name").alias("artist"), url.alias("url"),
        F.concat(F.col("n_name"), F.lit(" - Sp")).alias("location"), c_date.alias("date"),
        c_file.alias("src_file"), *keys)
    return {"sympla": sympla, "ticket360": ticket360, "eventim": eventim}


# Exported gold rows (display headers) -------------------------------------

GOLD_EXPORT_KEYS = ("gold/eventos_padronizados_20250101_000000.csv",
                    "gold/eventos_padronizados_20250201_000000.csv")


def gold_export_rows(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Two exported gold files as rows with the display headers (padded with
    spaces, as a hand-edited CSV would be): orders before 1999 form the first,
    orders from 1998 on the second, so 1998 events are re-published with a
    changed venue."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate",
                                              "o_orderpriority", "o_orderstatus")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    rows = o.join(c, o.o_custkey == c.c_custkey).join(n, c.c_nationkey == n.n_nationkey)

    def shape(df, venue):
        return df.select(
            F.concat(F.lit(" "), F.col("o_orderpriority")).alias(" Nome do evento"),
            venue.alias("local"),
            F.col("n_name").alias("Cidade "),
            F.date_format("o_orderdate", "dd/MM/yyyy").alias("evento (formato dd/mm/yyyy)"),
            F.concat(_two(F.pmod("o_custkey", F.lit(24))), F.lit(":00"))
             .alias("hora do evento (horário do brasil)"),
            F.when(F.col("o_orderstatus") == "P", F.lit(""))
             .otherwise(F.col("o_orderstatus")).alias("origem"),
            F.lit("sympla").alias("source"))

    first = shape(rows.filter(F.col("o_orderdate") < F.lit("1999-01-01").cast("timestamp")),
                  F.col("c_mktsegment"))
    second = shape(rows.filter(F.col("o_orderdate") >= F.lit("1998-01-01").cast("timestamp")),
                   F.lower("c_mktsegment"))
    return first, second


# Purchases ------------------------------------------------------------------

def purchases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Purchases (FIXTURES §5) from orders: client = customer, GMV = total price,
    origin = the customer's nation, destination = the nation of the supplier of
    the order's first line (by line number, supplier, part); none if no lines."""
    from eventlake.operators.joins import first_by_order
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", "l_partkey")
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    first = first_by_order(li, ["l_orderkey"], [F.col("l_linenumber"), F.col("l_suppkey"),
                                                F.col("l_partkey")])
    dest = (first.join(s, first.l_suppkey == s.s_suppkey)
                 .join(n.withColumnRenamed("n_nationkey", "d_key").withColumnRenamed("n_name", "destination"),
                       F.col("s_nationkey") == F.col("d_key"))
                 .select("l_orderkey", "destination"))
    rows = (o.join(c, o.o_custkey == c.c_custkey)
              .join(n, c.c_nationkey == n.n_nationkey)
              .join(dest, o.o_orderkey == dest.l_orderkey, "left"))
    return rows.select(
        F.concat(F.lit("cliente_"), F.col("o_custkey").cast("string")).alias("client_id"),
        F.col("o_orderkey").alias("purchase_id"),
        F.col("o_orderdate").cast("timestamp").alias("purchased_at"),
        F.col("o_totalprice").cast("decimal(18,2)").alias("gmv"),
        F.col("n_name").alias("origin"),
        F.col("destination"))


def document_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as raw bytes, encoded by language: en UTF-8, fr UTF-8 with a
    byte-order mark, others Latin-1 (as files from mixed sources arrive)."""
    d = table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    n = int(spark.conf.get("spark.sql.shuffle.partitions", "8"))
    d = d.repartition(n, "doc_id")
    content = (F.when(F.col("lang") == "en", F.encode("text", "UTF-8"))
                .when(F.col("lang") == "fr", F.concat(F.unhex(F.lit("EFBBBF")), F.encode("text", "UTF-8")))
                .otherwise(F.encode("text", "ISO-8859-1")))
    return d.select("doc_id", "lang", content.alias("content"))


# Listing pages (HTML) -------------------------------------------------------

PAGE_HOST = "https://ingressos.exemplo.com.br"
ORDERS_PER_PAGE = 64


def _esc(c) -> F.Column:
    c = F.col(c) if isinstance(c, str) else c
    for ch, ent in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        c = F.replace(c, F.lit(ch), F.lit(ent))
    return c


def listing_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Card pages of the three sites, rendered from the listing rows.

    Listing = (site, customer segment); page = 64 consecutive orders, cards in
    (order, line) order.  Each listing also gets an empty page after its last
    one and then a repeat of its first page (what a scraper meets when it runs
    past the end of a listing)."""
    from eventlake.session import staged
    f = bronze_feeds(spark, sf_dir, with_keys=True)
    a = f["sympla"]
    card_a = F.concat(
        F.lit('<a class="sympla-card" href="/evento/'), F.col("_order").cast("string"), F.lit('"'),
        F.when(F.col("_line") % 2 == 1, F.concat(F.lit(' data-name="'), _esc("title"), F.lit('"')))
         .otherwise(F.lit("")),
        F.lit("><h3>"), _esc("title"), F.lit("</h3><p>"), _esc("place"),
        F.lit("</p><div><span>"), _esc("_segment"), F.lit("</span></div><div>"), _esc("date"),
        F.lit("</div></a>"))
    b = f["ticket360"]
    parts = F.split("date", " ")
    card_b = F.concat(
        F.lit('<a class="event-click" href="evento/'), F.col("_order").cast("string"),
        F.lit('" title="'), _esc("title"), F.lit('"><div class="header-card-event">'
                                                  '<div class="card-name-local"><strong>'),
        _esc("place"), F.lit('</strong></div></div><div class="card-endereco">'), _esc("city"),
        F.lit('</div><div class="row data-calendar"><span class="data-layer">'),
        F.element_at(parts, 1), F.lit('</span><span class="data-mes">'), F.element_at(parts, 2),
        F.lit('</span><span class="data-semana">'), F.element_at(parts, 4), F.lit("</span></div></a>"))
    c = f["eventim"]
    card_c = F.concat(
        F.lit('<product-group-item><div data-qa="product-group-headline"><span>'), _esc("artist"),
        F.lit('</span></div><div class="listing-item-clickable"><div class="listing-subheadline"><span>'),
        _esc("location"), F.lit(", "), _esc("date"),
        F.lit(f'</span></div><listing-cta><a href="{PAGE_HOST}/event/'), F.col("_order").cast("string"),
        F.lit('/">Ingressos</a></listing-cta></div></product-group-item>'))
    cards = (a.select(F.lit("sympla").alias("site"), "_segment", "_order", "_line", card_a.alias("card"))
             .unionByName(b.select(F.lit("ticket360").alias("site"), "_segment", "_order", "_line",
                                   card_b.alias("card")))
             .unionByName(c.select(F.lit("eventim").alias("site"), "_segment", "_order", "_line",
                                   card_c.alias("card"))))
    cards = cards.withColumn("page_no", (F.floor(F.col("_order") / ORDERS_PER_PAGE) + 1).cast("int"))
    pages = cards.groupBy("site", "_segment", "page_no").agg(
        F.array_sort(F.collect_list(F.struct("_order", "_line", "card"))).alias("cs"))
    pages = pages.select("site", "_segment", "page_no",
                         F.concat(F.lit("<html><body><main>"),
                                  F.array_join(F.transform("cs", lambda x: x["card"]), ""),
                                  F.lit("</main></body></html>")).alias("html"))
    pages = staged(pages, "listing-pages")  # the rendering is read three times
    last = pages.groupBy("site", "_segment").agg(F.max("page_no").alias("_last"),
                                                 F.min("page_no").alias("_first"))
    empty = last.select("site", "_segment", (F.col("_last") + 1).alias("page_no"),
                        F.lit("<html><body><main><p>Nenhum evento</p></main></body></html>").alias("html"))
    again = pages.join(last, ["site", "_segment"]).filter(F.col("page_no") == F.col("_first")) \
        .select("site", "_segment", (F.col("_last") + 2).alias("page_no"), "html")
    allp = pages.unionByName(empty).unionByName(again)
    url = F.concat(F.lit(PAGE_HOST + "/"), F.col("site"), F.lit("/categoria/"), F.lower("_segment"),
                   F.lit("?p="), F.col("page_no").cast("string"))
    n = int(spark.conf.get("spark.sql.shuffle.partitions", "8"))
    out = allp.select(F.concat_ws(":", "site", "_segment", F.col("page_no").cast("string")).alias("page_id"),
                      "site", url.alias("url"), "html")
    # Stored pages arrive as many files; spread them like input splits.
    return out.repartition(n * 2, "page_id")


def pager_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored pages of paged listings, one listing per order priority with as many pages as its
    largest order key needs.  The base page links to pages 1 to 3, page k to k - 1, k + 1, 2k and
    2k + 1; every seventh page is linked but not stored.  Each page also holds links that do not
    count: in a comment, to another listing's pages, and to an event."""
    o = table(spark, sf_dir, "orders").groupBy(F.lower("o_orderpriority").alias("seg")).agg(
        (F.floor(F.max("o_orderkey") / ORDERS_PER_PAGE) + 1).cast("int").alias("last"))
    pages = o.select("seg", "last", F.explode(F.sequence(F.lit(0), F.col("last"))).alias("no"))
    pages = pages.where((F.col("no") == 0) | (F.col("no") % 7 != 0))
    k = F.col("no")
    linked = F.when(k == 0, F.array(F.lit(1), F.lit(2), F.lit(3))).otherwise(F.array(k - 1, k + 1, k * 2, k * 2 + 1))
    linked = F.filter(linked, lambda x: (x >= 1) & (x <= F.col("last")))
    path = F.concat(F.lit("/categoria/"), F.col("seg"))
    anchors = F.transform(linked, lambda x: F.concat(F.lit('<a class="pg" href="'), path, F.lit("?p="), x.cast("string"), F.lit('">'), x.cast("string"), F.lit("</a>")))
    html = F.concat(F.lit("<html><body><nav>"), F.array_join(anchors, ""), F.lit("</nav><!-- <a href='"), path, F.lit("?p=999999'>x</a> -->"),
                    F.lit('<a href="/categoria/outra?p=5">y</a><a href="/evento/1?x=2">z</a></body></html>'))
    url = F.concat(F.lit(PAGE_HOST), path, F.when(k == 0, "").otherwise(F.concat(F.lit("?p="), k.cast("string"))))
    return pages.select(F.concat_ws(":", "seg", k.cast("string")).alias("page_id"), url.alias("url"), html.alias("html"))


# Bronze CSV tree --------------------------------------------------------------

BRONZE_FOLDERS = {"sympla": "Bronze/database Sympla", "ticket360": "bronze/database Ticket360",
                  "eventim": "Bronze/database Evetim"}


def write_bronze_tree(spark: SparkSession, sf_dir: str, root: str, vary_headers: bool = False, only: tuple | None = None) -> None:
    """Write the three feeds (or ``only`` some) as scraper CSV files: ``<root>/<folder>/date=<month start>/*.csv``.
    With ``vary_headers`` half of the second feed's files use another column order
    (under the other case variant of the root)."""
    from eventlake.schemas import FEED_SCHEMAS
    from eventlake.session import staged_while
    from eventlake.sinks.files import rename_partition_dirs, write_bronze
    with staged_while(listing_rows(spark, sf_dir), "listing-rows") as rows:
        for feed, df in bronze_feeds(spark, sf_dir, with_keys=True, rows=rows).items():
            if only and feed not in only:
                continue
            cols = [f.name for f in FEED_SCHEMAS[feed].fields]
            # One scrape folder per month (a real Bronze prefix holds a few runs).
            df = df.withColumn("_day", F.trunc("_ship", "month").cast("string"))
            folder = BRONZE_FOLDERS[feed]
            if vary_headers and feed == "ticket360":
                odd = F.col("_order") % 2 == 1
                write_bronze(df.filter(~odd), root, folder, cols, "_day")
                write_bronze(df.filter(odd), root, "Bronze/database Ticket360", list(reversed(cols)), "_day")
                rename_partition_dirs(spark, f"{root}/Bronze/database Ticket360")
            else:
                write_bronze(df, root, folder, cols, "_day")
            rename_partition_dirs(spark, f"{root}/{folder}")
