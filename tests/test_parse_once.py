"""Feed files are parsed once per record, and only survivors' dates are read."""

from pyspark.sql import functions as F

from eventlake.operators.silver import STD_COLS, build_silver, dated_survivors, dedupe_events, map_records, with_dates
from eventlake.plans import jobs
from eventlake.sources.feeds import read_records


def _tree(tmp_dir):
    import os
    files = {"Bronze/database Sympla/date=2025-01-02/a.csv": 'url,title,place,date\nu1,"A, b",P - X,25 de out às 20:00\nu1,"A, b",P - X,25 de out às 20:00\n,t,p,d\nu2,"say ""hi""",Q,24 out\n',
             "bronze/database Ticket360/date=2025-02-02/b.csv": "date,city,place,title,url\n24 OUT • sex,N,P,T,u1\n31 FEV • sex,,P,T,u3\n"}
    for name, text in files.items():
        os.makedirs(os.path.dirname(f"{tmp_dir}/{name}"), exist_ok=True)
        with open(f"{tmp_dir}/{name}", "w", encoding="utf-8") as out:
            out.write(text)


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_filtered_records_are_parsed_once(spark, tmp_dir):
    _tree(tmp_dir)
    rows = dedupe_events(map_records(read_records(spark, tmp_dir), "1970-01-01"))
    assert _plan(rows).count("from_csv(") == 1
    got = {r["event_url"]: (r["title"], r["city"], r["source"]) for r in rows.collect()}
    assert got == {"u1": ("T", "N", "ticket360"), "u2": ('say "hi"', "", "sympla"), "u3": ("T", None, "ticket360")}


def test_only_survivors_are_dated(spark):
    cols = "event_url string, title string, venue string, city string, event_date_text string, source string, ingest_date string, src_file string"
    rows = [("u", "t", "v", None, text, source, day, "f") for text in ("25 de out às 20:00", "24 OUT • sex", None, "?")
            for source in ("sympla", "eventim") for day in ("2024-02-29", "2025-01-01", None)] * 2
    rows += [("", "t", "v", "c", "24 out", "sympla", "2025-01-01", "f"), (None,) * 8]
    texts = spark.createDataFrame(rows, cols)
    for options in ({}, {"year_from_ingest": False}, {"numeric_dmy": True}):
        plain = dedupe_events(with_dates(texts, **options)).select(*STD_COLS)
        assert dated_survivors(texts, **options).collect() == plain.collect()
    feed = texts.select(F.col("event_url").alias("url"), "title", F.col("venue").alias("place"), F.col("event_date_text").alias("date"), "src_file")
    plan = _plan(build_silver({"sympla": feed}))
    assert 0 < plan.index("make_timestamp") and plan.rindex("make_timestamp") < plan.index("Window")


def test_archive_does_not_parse_again(spark, tmp_dir, monkeypatch):
    _tree(tmp_dir)
    seen = []
    monkeypatch.setattr(jobs, "archive_rows", lambda df, *a: seen.append((df.inputFiles(), df.count())))
    jobs.bronze_to_silver(spark, tmp_dir, f"{tmp_dir}-silver", run_date="2025-03-01", archive_path=f"{tmp_dir}-rows", n_buckets=2)
    files, n = seen[0]
    assert n == 6 and all(f.endswith(".parquet") for f in files)
