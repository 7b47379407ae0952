"""Card parsing for the three layouts, links, H6/D2; holidays and band counts."""

import datetime as dt

from pyspark.sql import functions as F

from eventlake.operators.enrich import band_counts, brazil_holidays
from eventlake.sources.html import (cards_to_feed, extract_links, first_seen, parse_cards,
                                    stop_at_empty_page)

A = ('<html><body><a class="sympla-card" href="/evento/1" data-name="Show &amp; Co"><h3>x</h3>'
     '<p> Arena - Rio </p><div><div>Sábado, 25 de out às 20:00</div></div></a>'
     '<a class="sympla-card" href="https://o/2"><h3> Solo </h3><p>Casa</p><div>sem data</div></a></body></html>')
B = ('<a class="event-click" href="/evento/9?x=1"><div class="header-card-event"><div class="card-name-local">'
     '<strong> Teatro </strong></div></div><div class="card-endereco"> Rio </div>'
     '<div class="row data-calendar"><span class="data-layer">24</span><span class="data-mes">OUT</span>'
     '<span class="data-semana">sex</span></div> Título </a><a class="event-click" href="/outro/1">no</a>')
C = ('<product-group-item><div data-qa="product-group-headline"><span> BAND </span></div>'
     '<div class="listing-item-clickable"><div class="listing-subheadline"><span>São Paulo, sáb. 25/10/2025, 20:00'
     '</span></div><listing-cta><a href="https://e/event/7/">x</a></listing-cta></div></product-group-item>')


def test_three_layouts(spark):
    pages = spark.createDataFrame([("a", "sympla", A), ("b", "ticket360", B), ("c", "eventim", C)],
                                  "page_id string, site string, html string") \
        .withColumn("origin", F.lit("https://t.com"))
    raw = parse_cards(pages).filter(F.col("pos") > 0)
    a = cards_to_feed(raw.filter(F.col("site") == "sympla"), "sympla", base_url="https://s.com").collect()
    assert [(r["url"], r["title"], r["place"], r["date"]) for r in a] == [
        ("https://s.com/evento/1", "Show & Co", "Arena - Rio", "25 de out às 20:00"),
        ("https://o/2", "Solo", "Casa", None)]
    b = cards_to_feed(raw.filter(F.col("site") == "ticket360"), "ticket360",
                      page_origin=F.col("origin")).collect()
    assert [(r["url"], r["title"], r["place"], r["city"], r["date"]) for r in b] == [
        ("https://t.com/evento/9?x=1", "Teatro  Rio 24OUTsex Título", "Teatro", "Rio", "24 OUT • sex")]
    c = cards_to_feed(raw.filter(F.col("site") == "eventim"), "eventim").collect()
    assert [(r["artist"], r["url"], r["location"], r["date"]) for r in c] == [
        ("BAND", "https://e/event/7/", "São Paulo", "sáb. 25/10/2025, 20:00")]


def test_stop_and_first_seen(spark):
    card = '<a class="sympla-card" href="/e/{}"><h3>t</h3><p>p</p></a>'
    pages = spark.createDataFrame([
        ("p1", "sympla", "L", 1, card.format(1) + card.format(2)),
        ("p2", "sympla", "L", 2, card.format(2)),
        ("p3", "sympla", "L", 3, "<p>vazio</p>"),
        ("p4", "sympla", "L", 4, card.format(9)),
    ], "page_id string, site string, listing string, page_no int, html string")
    raw = parse_cards(pages)
    kept = stop_at_empty_page(raw)
    assert sorted(r["href"] for r in kept.collect()) == ["/e/1", "/e/2", "/e/2"]
    first = first_seen(kept.withColumnRenamed("href", "url"))
    assert sorted((r["url"], r["page_no"]) for r in first.collect()) == [("/e/1", 1), ("/e/2", 1)]


def test_links(spark):
    pages = spark.createDataFrame([(1, "https://x.com/a/b?p=2", '<a href="/c?q=1">c</a><a class="k" href="d">d</a>'
                                                                '<a href="/c">c</a><a href="http://y/z?w">z</a>')],
                                  "page_id long, url string, html string")
    got = sorted((r["link"], r["pos"]) for r in extract_links(pages).collect())
    assert got == [("http://y/z", 4), ("https://x.com/c", 1), ("https://x.com/d", 2)]


def test_holidays(spark):
    h = {(r["holiday_date"], r["name"]) for r in brazil_holidays(spark, 2024, 2025).collect()}
    assert (dt.date(2024, 3, 29), "Sexta-feira Santa") in h        # Easter 2024-03-31
    assert (dt.date(2025, 3, 4), "Carnaval (terça-feira)") in h     # Easter 2025-04-20
    assert (dt.date(2024, 11, 20), "Dia Nacional de Zumbi e da Consciência Negra") in h
    assert not any(d == dt.date(2023, 11, 20) for d, _ in h)
    assert len([1 for d, _ in h if d.year == 2025]) == 13


def test_band_counts_against_brute_force(spark):
    import random
    rnd = random.Random(11)
    rows, base = [], dt.datetime(2024, 1, 1)
    for i in range(1500):
        user = 0 if i % 3 == 0 else rnd.randint(1, 30)     # user 0 holds a third of the events
        kind = rnd.choice(["purchase", "error", "view"])
        rows.append((i, base + dt.timedelta(seconds=rnd.randint(0, 5 * 86400)), user, kind))
    df = spark.createDataFrame(rows, "event_id long, ts timestamp, user_id long, event_type string")
    got = {r["event_id"]: r["n_in_band"] for r in band_counts(df, "purchase", "error", 86400,
                                                              n_partitions=6).collect()}
    for eid, ts, user, kind in rows:
        if kind != "purchase":
            continue
        ref = sum(1 for _, t2, u2, k2 in rows if u2 == user and k2 == "error"
                  and ts - dt.timedelta(seconds=86400) <= t2 <= ts)
        assert got[eid] == ref


def test_category_and_nav_links(spark):
    from eventlake.sources.html import category_links, nav_data_links
    html = ('<a href="/categoria/shows?x=1">a</a><a href="/local/sp">b</a><a href="/evento/1">c</a>'
            '<ul aria-label="Todos os eventos"><li><div class="js-nav-sub-trigger x" data-href="/rock">r</div>'
            '<div class="other" data-href="/no">n</div><div data-href="/pop" class="js-nav-sub-trigger">p'
            '</div><div class="js-nav-sub-trigger" data-href="/rock">again</div></li></ul>'
            '<div class="js-nav-sub-trigger" data-href="/outside">o</div>')
    pages = spark.createDataFrame([(1, "https://t.com/home?p=1", html)], "page_id long, url string, html string")
    assert sorted(r["link"] for r in category_links(pages).collect()) == [
        "https://t.com/categoria/shows", "https://t.com/local/sp"]
    assert sorted((r["link"], r["pos"]) for r in nav_data_links(pages).collect()) == [
        ("https://t.com/pop", 3), ("https://t.com/rock", 1)]


def test_two_sided_keyed_band_counts(spark):
    import random
    from eventlake.operators.enrich import keyed_band_counts
    rnd = random.Random(5)
    base = dt.datetime(2024, 1, 1)
    anchors = [(i, "hot" if i % 3 == 0 else rnd.choice("abcd"), base + dt.timedelta(hours=rnd.randint(0, 200)))
               for i in range(300)]
    counted = [(f"c{i}", "hot" if i % 2 == 0 else rnd.choice("abcd"), base + dt.timedelta(hours=rnd.randint(0, 200)))
               for i in range(900)]
    a = spark.createDataFrame(anchors + [(999, None, base)], "_aid long, _k string, _t timestamp")
    c = spark.createDataFrame(counted, "_cid string, _k string, _t timestamp")
    got = {r["_aid"]: r["_n"] for r in keyed_band_counts(a, c, 6 * 3600, 12 * 3600, n_partitions=5).collect()}
    for aid, k, t in anchors:
        ref = sum(1 for _, k2, t2 in counted
                  if k2 == k and t - dt.timedelta(hours=6) <= t2 <= t + dt.timedelta(hours=12))
        assert got[aid] == ref
    assert got[999] == 0
