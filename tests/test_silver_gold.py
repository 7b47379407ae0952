"""Feed mapping, union/dedupe properties, gold rules and plan shape."""

import datetime as dt

from pyspark.sql import functions as F

from eventlake.operators.gold import build_gold
from eventlake.operators.silver import build_silver, dedupe_events, map_feed

SYMPLA = "url string, title string, place string, date string, src_file string"
T360 = "url string, title string, place string, city string, date string, src_file string"
EVENTIM = "artist string, url string, location string, date string, src_file string"


def feeds(spark):
    a = spark.createDataFrame([
        ("u1", "Show A", "Arena - Curitiba, PR", "Sábado, 25 de out às 20:00",
         "s3://b/Bronze/database Sympla/date=2025-10-01/sympla_20251001-100000.csv"),
        ("u2", "Show B", "Coca-Cola Arena", "3 de março de 2026",
         "s3://b/bronze/database Sympla/date=2025-10-02/sympla_20251002-100000.csv"),
        ("", "no url", "x - y", "1 de jan", "s3://b/Bronze/database Sympla/date=2025-10-02/s.csv"),
    ], SYMPLA)
    b = spark.createDataFrame([
        ("u1", "Show A (old)", "Teatro", "Curitiba", "24 OUT • sex",
         "s3://b/Bronze/database Ticket360/date=2025-09-01/t.csv"),
        ("u3", "Show C", "Casa", "n/a", "24 OUT • sex", "s3://b/Bronze/database Ticket360/date=2025-09-01/t.csv"),
    ], T360)
    c = spark.createDataFrame([
        ("ARTIST", "u4", "São Paulo - Sp", "sáb. 25/10/2025, 20:00",
         "s3://b/Bronze/database Evetim/date=2025-10-03/e.csv"),
    ], EVENTIM)
    return {"sympla": a, "ticket360": b, "eventim": c}


def test_silver_rows(spark):
    s = {r["event_url"]: r for r in build_silver(feeds(spark), run_date="2025-10-05").collect()}
    assert set(s) == {"u1", "u2", "u3", "u4"}
    # latest ingest date wins the duplicate URL
    assert s["u1"]["source"] == "sympla" and s["u1"]["city"] == "Curitiba, PR"
    assert s["u1"]["event_date"] == dt.datetime(2025, 10, 25, 20, 0)
    assert s["u2"]["city"] == "Cola Arena" and s["u2"]["event_date"] == dt.datetime(2026, 3, 3)
    assert s["u3"]["event_date"] == dt.datetime(2025, 10, 24)   # year from ingest date
    assert s["u4"]["event_date"] is None and s["u4"]["city"] is None   # original behaviour


def test_options(spark):
    s = {r["event_url"]: r for r in build_silver(feeds(spark), numeric_dmy=True,
                                                 city_from_location=True).collect()}
    assert s["u4"]["event_date"] == dt.datetime(2025, 10, 25, 20, 0)
    assert s["u4"]["city"] == "São Paulo"


def test_missing_column_gives_empty_feed(spark):
    f = feeds(spark)
    f["ticket360"] = f["ticket360"].drop("city")
    assert map_feed(f["ticket360"], "ticket360").count() == 0
    assert {r["event_url"] for r in build_silver(f).collect()} == {"u1", "u2", "u4"}


def test_dedupe_is_order_independent_and_idempotent(spark):
    rows = [(f"u{i % 7}", f"t{i}", "v", "c", "d", None, "s", f"2025-01-{1 + i % 5:02d}", f"f{i}")
            for i in range(60)]
    from eventlake.schemas import STD_SCHEMA
    df = spark.createDataFrame(rows, STD_SCHEMA)
    a = sorted(map(tuple, dedupe_events(df).collect()))
    b = sorted(map(tuple, dedupe_events(df.orderBy(F.rand(1)).repartition(5)).collect()))
    c = sorted(map(tuple, dedupe_events(dedupe_events(df)).collect()))
    assert a == b == c and len(a) == 7


def test_gold_rules(spark):
    g = build_gold(build_silver(feeds(spark), run_date="2025-10-05")).collect()
    by = {r["nome"]: r for r in g}
    assert set(by) == {"Show A", "Show B"}          # n/a and null cities dropped
    assert by["Show A"]["local"] == "Arena"
    assert (by["Show A"]["data"], by["Show A"]["hora"]) == ("25/10/2025", "17:00")
    assert by["Show A"]["data_ingestao"] == "30/09/2025 21:00"
    assert by["Show B"]["local"] == "Coca"


def test_plans_stay_in_the_jvm_and_push_filters(spark, tmp_dir):
    f = feeds(spark)
    path = f"{tmp_dir}/sympla"
    f["sympla"].write.parquet(path)
    f["sympla"] = spark.read.parquet(path)
    plan = build_gold(build_silver(f))._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    probe = spark.read.parquet(path).filter(F.col("url") == "u1").select("url")
    p2 = probe._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(url), EqualTo(url,u1)]" in p2
