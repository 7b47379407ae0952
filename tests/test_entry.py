"""Driver contract: entry runs, every oracle has a query, oracles agree at sf0.001."""

import importlib.util
import re

import duckdb
import pytest

import __spark_entry__ as E
from tools.oracle_check import TABLES, digest

SF = "/root/testdata/sf0.001"
FAST = ["gold_presentation", "pt_date_parse", "doc_id_md5", "upsert_documents", "client_features",
        "client_profile", "label_7_30", "label_cutoffs", "route_recommend", "holiday_enrich",
        "event_proximity", "links_extract", "path_lineage", "first_comma_split"]


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["nome", "local", "cidade", "data", "hora", "origem", "data_ingestao"]


def test_registry():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    own = {k for k in q if re.match(r"op\d+_", k) or k == "pipeline"}
    assert len(own) == (14 if importlib.util.find_spec("eventlake.llm") else 0)


@pytest.mark.parametrize("name", FAST)
def test_oracle_sf0001(spark, name):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = E.queries()[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    rel = con.sql(E.oracle_sql()[name])
    assert sorted(df.columns) == sorted(rel.columns)
    assert digest(df.columns, rows) == digest(rel.columns, rel.fetchall())
