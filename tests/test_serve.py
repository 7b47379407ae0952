"""Documents and keyed upsert properties."""

import hashlib

from pyspark.sql import functions as F

from eventlake.operators.serve import batch_survivors, build_documents, normalise_rows, upsert


def rows(spark, data):
    return normalise_rows(spark.createDataFrame(
        data, "` Nome do Evento ` string, local string, Cidade string, data string, hora string, "
              "origem string, source string"))


def test_documents_alias_pick_and_key(spark):
    d = build_documents(rows(spark, [(" Show ", "Arena", "Rio", "01/01/2025", "20:00", "", "sympla")]),
                        "gold/x.csv").first()
    assert d["nome"] == "Show" and d["origem"] == "sympla"
    assert d["_id"] == hashlib.md5("Show|01/01/2025|20:00|Rio|sympla".encode()).hexdigest()
    assert d["lugar"]["venue"] == "Arena" and d["lugar"]["estado"] is None


def test_upsert_semantics_and_idempotence(spark):
    t = build_documents(rows(spark, [("A", "v1", "Rio", "d", "h", "o", None),
                                     ("B", "v1", "Rio", "d", "h", "o", None)]), "k1") \
        .withColumn("extra", F.lit("keep"))
    t = batch_survivors(t)
    b = build_documents(rows(spark, [("A", "v2", "Rio", "d", "h", "o", None),
                                     ("A", "v0", "Rio", "d", "h", "o", None),
                                     ("C", None, "Rio", "d", "h", "o", None)]), "k2")
    once = upsert(t, b)
    twice = upsert(once, b)
    got = {r["nome"]: r for r in once.collect()}
    assert got["A"]["lugar"]["venue"] == "v0"          # deterministic survivor (smallest venue)
    assert got["A"]["extra"] == "keep" and got["A"]["source_key"] == "k2"
    assert got["B"]["source_key"] == "k1"
    assert got["C"]["extra"] is None and got["C"]["lugar"]["venue"] is None
    key = lambda df: sorted(map(str, df.orderBy("_id").collect()))
    assert key(once) == key(twice)
