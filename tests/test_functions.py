
import datetime as dt

import pytest
from pyspark.sql import functions as F

from eventlake.functions import dates as D
from eventlake.functions import text as X


def one(spark, expr, value, schema="v string"):
    return spark.createDataFrame([(value,)], schema).select(expr.alias("r")).first()["r"]


@pytest.mark.parametrize("text,year,expected", [
    ("Sábado, 25 de out às 20:00", 2025, dt.datetime(2025, 10, 25, 20, 0)),
    ("24 OUT • sex", 2025, dt.datetime(2025, 10, 24, 0, 0)),
    ("3 de março de 2026", 2025, dt.datetime(2026, 3, 3, 0, 0)),
    ("3 de marco de 2026 às 9:05", 2025, dt.datetime(2026, 3, 3, 9, 5)),
    ("31 de fevereiro", 2025, None),
    ("25 de out às 25:00", 2025, None),
    ("18 de xyz", 2025, None),
    ("", 2025, None),
    (None, 2025, None),
    ("2025-10-25 20:00:00", 2025, dt.datetime(2025, 10, 25, 20, 0)),
    ("25/10/2025 20:00", 2025, dt.datetime(2025, 10, 25, 20, 0)),
    ("25/10/2025", 2025, dt.datetime(2025, 10, 25, 0, 0)),
    ("sáb. 25/10/2025, 20:00", 2025, None),
])
def test_to_ts_any(spark, text, year, expected):
    assert one(spark, D.to_ts_any(F.col("v"), year), text) == expected


def test_numeric_dmy_opt_in(spark):
    got = one(spark, D.to_ts_any(F.col("v"), 2025, numeric_dmy=True), "sáb. 25/10/2025, 20:00")
    assert got == dt.datetime(2025, 10, 25, 20, 0)
    rng = one(spark, D.to_ts_any(F.col("v"), 2025, numeric_dmy=True),
              "sex. 24/10/2025 ─ dom. 26/10/2025")
    assert rng == dt.datetime(2025, 10, 24, 0, 0)


@pytest.mark.parametrize("venue,city,local", [
    ("Arena - Curitiba, PR", "Curitiba, PR", "Arena"),
    ("Coca-Cola Arena - São Paulo", "São Paulo", "Coca-Cola Arena"),
    ("Coca-Cola Arena", "Cola Arena", "Coca"),
    ("A – B", "", "A"),
    ("Clube X", "", "Clube X"),
])
def test_city_and_venue(spark, venue, city, local):
    assert one(spark, X.city_from_venue("v"), venue) == city
    assert one(spark, X.venue_local("v"), venue) == local


def test_require_spaces_option(spark):
    assert one(spark, X.city_from_venue("v", require_spaces=True), "Coca-Cola Arena") == ""
    assert one(spark, X.venue_local("v", require_spaces=True), "Coca-Cola Arena") == "Coca-Cola Arena"
    assert one(spark, X.city_from_venue("v", require_spaces=True),
               "Coca-Cola Arena - São Paulo") == "São Paulo"


@pytest.mark.parametrize("ts,expected", [
    (dt.datetime(2025, 10, 25, 20, 0), "25/10/2025 17:00"),
    (dt.datetime(2025, 10, 25, 0, 0), "24/10/2025 21:00"),
    (dt.datetime(2016, 12, 25, 0, 0), "24/12/2016 22:00"),
])
def test_brt_display(spark, ts, expected):
    assert one(spark, D.brt_display(F.col("v"), "dd/MM/yyyy HH:mm"), ts, "v timestamp") == expected


def test_brt_display_no_shift(spark):
    got = one(spark, D.brt_display(F.col("v"), "dd/MM/yyyy HH:mm", event_tz="America/Sao_Paulo"),
              dt.datetime(2025, 10, 25, 20, 0), "v timestamp")
    assert got == "25/10/2025 20:00"


def test_doc_id_nulls(spark):
    import hashlib
    df = spark.createDataFrame([(None, " a ", "b")], "p1 string, p2 string, p3 string")
    got = df.select(X.doc_id("p1", "p2", "p3").alias("h")).first()["h"]
    assert got == hashlib.md5("|a|b".encode()).hexdigest()


def test_decode_fallback(spark):
    rows = [(bytearray("São".encode("latin-1")),), (bytearray("São".encode("utf-8")),),
            (bytearray("São".encode("utf-8-sig")),)]
    df = spark.createDataFrame(rows, "b binary")
    assert [r["t"] for r in df.select(X.decode_text("b").alias("t")).collect()] == ["São"] * 3


@pytest.mark.parametrize("path,expected", [
    ("s3://b/Bronze/database Sympla/date=2025-10-01/sympla_20251002-101010.csv", "2025-10-01"),
    ("s3://b/Bronze/database Sympla/sympla_20251002-101010.csv", "2025-10-02"),
    ("s3://b/Bronze/database Sympla/whatever.csv", "2000-01-01"),
])
def test_ingest_date(spark, path, expected):
    assert one(spark, D.ingest_date_from_path("v", run_date="2000-01-01"), path) == expected


def test_header_normalise():
    assert X.normalize_header("﻿Event  URL") == "event_url"
    assert X.normalize_header(" a") == "_a"


def test_paths(spark):
    k = "Bronze/database Evetim/date=2025-10-01/eventim_20251001-000000.csv"
    assert one(spark, X.source_from_path("v"), k) == "eventim"
    assert one(spark, X.archive_key("v"), k) == \
        "Bronze/Arquivos Processados/source=eventim/date=2025-10-01/eventim_20251001-000000.csv"
    assert one(spark, X.archive_key("v"), "x/other/f.csv") == \
        "x/Arquivos Processados/source=desconhecida/date=0000-00-00/f.csv"
    assert one(spark, X.date_prefix("v"), k) == "Bronze/database Evetim/date=2025-10-01/"
    assert one(spark, X.uri_bucket("v"), "s3://bkt/a/b.csv") == "bkt"
    assert one(spark, X.uri_key("v"), "s3://bkt/a/b.csv") == "a/b.csv"
    assert one(spark, X.decoded_path("v"), "file:/x/database%20Sympla/a+b.csv") == \
        "file:/x/database Sympla/a+b.csv"


def test_page_number_and_split(spark):
    assert one(spark, X.page_number("v"), "https://x.com/cat?p=3") == 3
    assert one(spark, X.page_number("v"), "https://x.com/cat") == 0
    df = spark.createDataFrame([("São Paulo, sáb. 25/10/2025, 20:00",), ("Rio",)], "v string")
    h, r = X.split_first_comma("v")
    got = df.select(h.alias("h"), r.alias("r")).collect()
    assert (got[0]["h"], got[0]["r"]) == ("São Paulo", "sáb. 25/10/2025, 20:00")
    assert (got[1]["h"], got[1]["r"]) == ("Rio", "")
