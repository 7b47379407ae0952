"""Shapes that once lost rows or stopped a job."""

import pytest
from pyspark.sql import functions as F

from eventlake.operators.enrich import brazil_holidays, holiday_features
from eventlake.operators.sequence import with_next, with_running_sum
from eventlake.plans.jobs import bronze_to_silver, silver_to_gold
from eventlake.sinks.tables import BUCKET, dedupe_merge, rebucket, stored_buckets, upsert_buckets
from eventlake.sources.documents import read_gold_exports
from eventlake.sources.html import extract_links, parse_cards


def put(path, text, encoding="utf-8"):
    import os
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding=encoding, newline="") as f:
        f.write(text)


def test_bucket_count_is_kept(spark, tmp_dir):
    path, merge = f"{tmp_dir}/keyed", dedupe_merge([F.col("v").desc()], "k")
    batch = lambda lo, hi, v: spark.createDataFrame([(f"k{i}", v) for i in range(lo, hi)], "k string, v int")
    assert upsert_buckets(spark, path, batch(0, 50, 1), "k", merge, 8).rows == 50
    for n in (16, 5):
        with pytest.raises(ValueError):
            upsert_buckets(spark, path, batch(0, 1, 2), "k", merge, n)
        rebucket(spark, path, "k", n)
        assert stored_buckets(spark, path) == n
        for i in range(3):
            upsert_buckets(spark, path, batch(i, i + 1, n), "k", merge)
        rows = spark.read.parquet(path).drop(BUCKET).collect()
        assert len(rows) == 50 and len({r.k for r in rows}) == 50 and sum(r.v in (5, 16) for r in rows) == 3


def test_empty_run_and_header_only_feed(spark, tmp_dir):
    bronze_to_silver(spark, f"{tmp_dir}/none", f"{tmp_dir}/s1", run_date="2025-10-05")
    put(f"{tmp_dir}/b/Bronze/database Sympla/date=2025-10-01/a.csv", "url,title,place,date\n")
    assert bronze_to_silver(spark, f"{tmp_dir}/b", f"{tmp_dir}/s2", run_date="2025-10-05")["rows"] == 0
    for s in ("s1", "s2"):
        silver_to_gold(spark, f"{tmp_dir}/{s}", f"{tmp_dir}/{s}-gold")
        assert spark.read.parquet(f"{tmp_dir}/{s}-gold").count() == 0
    put(f"{tmp_dir}/b/Bronze/database Sympla/date=2025-10-02/a.csv", "url,title,place,date\nu1,A,Arena - Rio,25 de out\nu1,A,Arena - Rio,25 de out\n")
    for _ in range(2):
        assert bronze_to_silver(spark, f"{tmp_dir}/b", f"{tmp_dir}/s2", run_date="2025-10-05", archive_path=f"{tmp_dir}/arch")["rows"] == 1
    assert spark.read.parquet(f"{tmp_dir}/arch").count() == 2


def test_links_and_cards(spark):
    html = ('<!-- <a href="/no">x</a> <a class="event-click" href="/no">n</a> --><a href="/real" data-href="/other">r</a>'
            "<a data-href='/x' href='/single'>s</a><a title='a > href=\"/no\"' HREF=/bare>b</a>"
            '<a title="A > B" class="event-click" href="/evento/card"><h3>t</h3></a>')
    pages = spark.createDataFrame([("1", "http://h/p", html, "ticket360"), ("2", "http://h/q", html, "other"), ("3", "http://h/r", None, None)],
                                  "page_id string, url string, html string, site string")
    links = {r.link for r in extract_links(pages).where("page_id = '1'").collect()}
    assert links == {"http://h/real", "http://h/single", "http://h/bare", "http://h/evento/card"}
    fast, slow = (sorted(map(str, parse_cards(pages, prefilter=p).collect())) for p in (True, False))
    assert fast == slow and sum("pos=-1" in r for r in fast) == 2 and sum("/evento/card" in r for r in fast) == 1


def test_exports_by_their_own_header(spark, tmp_dir):
    put(f"{tmp_dir}/gold/a.csv", "nome,cidade,origem\nShow A,Rio,sympla\n")
    put(f"{tmp_dir}/gold/b c.csv", "cidade,origem,nome\nNatal,eventim,Show B\n")
    put(f"{tmp_dir}/gold/d.csv/part-0.csv", "nome;cidade;origem\nShow Ç;São;x\n", "latin-1")
    rows = {r.nome: r for r in read_gold_exports(spark, f"{tmp_dir}/gold").collect()}
    assert (rows["Show B"].cidade, rows["Show B"].source_key) == ("Natal", "gold/b c.csv")
    assert (rows["Show A"].source_key, rows["Show Ç"].source_key) == ("gold/a.csv", "gold/d.csv")


def test_sentinel_purchase_dates(spark):
    p = spark.createDataFrame([(i, 1, d) for i, d in enumerate(["0001-01-01", "2024-12-25", "9999-12-31", None])], "purchase_id int, client_id int, d string")
    p = p.withColumn("purchased_at", F.col("d").cast("timestamp"))
    rows = {r.purchase_id: r for r in holiday_features(p, brazil_holidays(spark, 2023, 2025)).collect()}
    assert rows[1].is_holiday and rows[1].days_to_next_holiday == 0 and rows[2].days_to_next_holiday is None and len(rows) == 4


def test_null_keys_are_kept(spark):
    df = spark.createDataFrame([(k, i) for i, k in enumerate([None, "a", None, "a", None, None])], "k string, t int")
    nxt = {r.t: r.next_t for r in with_next(df, "k", ["t"], ["t"], n_partitions=4).collect()}
    assert nxt == {0: 2, 2: 4, 4: 5, 5: None, 1: 3, 3: None}
    sums = {r.t: r.s for r in with_running_sum(df, "k", ["t"], F.lit(1), "s", n_partitions=4).collect()}
    assert sums == {0: 1, 2: 2, 4: 3, 5: 4, 1: 1, 3: 2}
