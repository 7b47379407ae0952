"""Raw-line CSV reading, streams over whole roots, inventories, frontier, de-duplication and publishing."""

import csv
import io
import os
import random

from pyspark.sql import functions as F

from eventlake.operators.frontier import listing_frontier, missing_pages, next_missing
from eventlake.plans.jobs import bronze_to_silver, gold_to_documents
from eventlake.sinks.publish import location, publish, remove_stale, versions
from eventlake.sources.documents import file_formats, read_gold_exports
from eventlake.sources.feeds import read_feed
from eventlake.sources.inventory import consumed_folders, files_to_move, folder_inventory, folder_states, folders_to_move, list_files
from eventlake.sources.lines import csv_records, raw_lines
from eventlake.streaming.dedupe import file_events, start_dedupe_stream, state_rows
from eventlake.streaming.ingest import start_documents_stream, start_silver_stream


def put(path, data):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as f:
        f.write(data if isinstance(data, bytes) else data.encode())


def quoted(rows, sep=",", quoting=csv.QUOTE_MINIMAL, end="\n"):
    out = io.StringIO()
    csv.writer(out, delimiter=sep, quoting=quoting, lineterminator=end).writerows(rows)
    return out.getvalue()


# raw lines

def test_records_equal_a_csv_parser_however_the_file_is_split(spark, tmp_dir):
    """Random fields with quotes, separators and line ends, read in splits of 200 bytes."""
    rng = random.Random(11)
    pieces = ["a", "b c", '"', ",", "\n", "é", "x" * 30, '""', "1;2", ", ", '",', '\n"', "\r\n"]
    field = lambda: "".join(rng.choice(pieces) for _ in range(rng.randrange(1, 5))).strip(" \r") or "z"
    rows = [[str(i), field(), field()] for i in range(400)]
    put(f"{tmp_dir}/in/quoted.csv", quoted([["id", "one", "two"], *rows], quoting=csv.QUOTE_ALL))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200")
    try:
        lines = raw_lines(spark, f"{tmp_dir}/in")
        assert lines.select("block").distinct().count() > 50
        found = sorted((list(r.values) for r in csv_records(lines).collect()), key=lambda v: int(v[0]))
        assert found == rows
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_every_file_by_its_own_header_encoding_and_separator(spark, tmp_dir):
    root = f"{tmp_dir}/exports/gold"
    put(f"{root}/a.csv", "﻿ Nome do evento ,local,Cidade\nShow,Praça; central,São Paulo\n".encode())
    put(f"{root}/b.csv", "Cidade;Nome do evento;local\r\nSão João;Peça;\"Sala\r\nGrande\"\r\n\r\n".encode("latin-1"))
    put(f"{root}/c.csv", 'nome,local\n"unbalanced,x\nnext,y\n')
    put(f"{root}/d.csv", b"nome;extra\n")
    put(f"{root}/e.csv", b"")
    formats = {os.path.basename(r.file): (r.encoding, r.sep) for r in file_formats(spark, f"{tmp_dir}/exports").collect()}
    assert formats == {"a.csv": ("UTF-8", ","), "b.csv": ("ISO-8859-1", ";"), "c.csv": ("UTF-8", ","), "d.csv": ("UTF-8", ";")}
    rows = {(r["source_key"], r["nome do evento"], r["cidade"], r["local"]) for r in read_gold_exports(spark, f"{tmp_dir}/exports").collect()}
    assert ("gold/a.csv", "Show", "São Paulo", "Praça; central") in rows
    assert ("gold/b.csv", "Peça", "São João", "Sala\r\nGrande") in rows
    assert len([r for r in rows if r[0] == "gold/c.csv"]) == 2 and len(rows) == 4


def test_short_long_and_blank_records(spark, tmp_dir):
    put(f"{tmp_dir}/in/Bronze/database Sympla/date=2025-10-01/x.csv", "url,title,place,date\nu1,A\n\n   \nu2,B,C,D,E\n,,,\n")
    rows = sorted(((r.url, r.title, r.place, r.date) for r in read_feed(spark, f"{tmp_dir}/in", "sympla").collect()), key=str)
    assert rows == sorted([("u1", "A", None, None), ("u2", "B", "C", "D"), (None, None, None, None)], key=str)


def test_reading_lists_no_files_on_the_driver():
    import inspect
    from eventlake.sources import documents, feeds, lines
    for module in (documents, feeds, lines):
        assert "collect_list(\"file\")" not in inspect.getsource(module) and "binaryFile" not in inspect.getsource(module)


# streams

FEED_A, FEED_C = "Bronze/database Sympla", "Bronze/database Evetim"


def test_stream_sees_folders_and_headers_that_come_later(spark, tmp_dir):
    root, table, ckpt = f"{tmp_dir}/in", f"{tmp_dir}/silver", f"{tmp_dir}/ckpt"
    assert start_silver_stream(spark, root, table, ckpt) is None
    put(f"{root}/{FEED_A}/date=2025-10-01/a.csv", "url,title,place,date\nu1,A,Arena - Rio,25 de out\n")
    start_silver_stream(spark, root, table, ckpt, n_buckets=4).awaitTermination()
    put(f"{root}/{FEED_A}/date=2025-10-02/b.csv", 'date,place,title,url\n26 de out,Casa - SP,"Two\nlines",u2\n')
    put(f"{root}/{FEED_C}/date=2025-10-02/c.csv", 'artist,url,location,date\nBAND,u3,Rio - Sp,25/10/2025\n')
    put(f"{root}/other/d.csv", "url,title\nu9,x\n")
    put(f"{root}/bronze/database Ticket360/date=2025-10-02/t.csv", "url,title\nu8,missing columns\n")
    start_silver_stream(spark, root, table, ckpt, n_buckets=4).awaitTermination()
    found = {r.event_url: (r.title, r.city, r.source, r.ingest_date) for r in spark.read.parquet(table).collect()}
    assert found == {"u1": ("A", "Rio", "sympla", "2025-10-01"), "u2": ("Two\nlines", "SP", "sympla", "2025-10-02"),
                     "u3": ("BAND", None, "eventim", "2025-10-02")}
    bronze_to_silver(spark, root, f"{tmp_dir}/batch", n_buckets=4)
    cols = ["event_url", "title", "venue", "city", "event_date_text", "event_date", "source", "ingest_date"]
    same = lambda path: sorted(map(str, spark.read.parquet(path).select(cols).collect()))
    assert same(f"{tmp_dir}/batch") == same(table)


def test_export_stream_equals_batch_and_keeps_a_ledger(spark, tmp_dir):
    head = ["Nome do evento", "local", "cidade", "evento (formato dd/mm/yyyy)", "hora do evento (horário do brasil)", "origem"]
    one = [["São João", "Praça", "Rio", "01/01/2025", "20:00", "sympla"], ["Peça", "Teatro", "SP", "02/01/2025", "21:00", "x"]]
    two = [["Peça", 'Teatro "B"; novo', "SP", "02/01/2025", "21:00", "x"]]
    root, docs, ledger = f"{tmp_dir}/exports", f"{tmp_dir}/docs", f"{tmp_dir}/ledger"

    def run():
        start_documents_stream(spark, root, docs, f"{tmp_dir}/ckpt", n_buckets=4, ledger_path=ledger).awaitTermination()

    put(f"{root}/gold/e1.csv", quoted([head, *one]))
    run()
    put(f"{root}/gold/e2.csv", quoted([head[::-1], *[r[::-1] for r in two]], sep=";", end="\r\n").encode("latin-1"))
    run()
    run()  # nothing new
    gold_to_documents(spark, root, f"{tmp_dir}/batch", n_buckets=4)
    same = lambda path: sorted(map(str, spark.read.parquet(path).drop("_bucket").collect()))
    assert same(docs) == same(f"{tmp_dir}/batch") and len(same(docs)) == 2
    entries = sorted((r.batch, r.source_key, r.encoding, r.sep, r.n_rows) for r in spark.read.parquet(ledger).collect())
    assert entries == [(0, "gold/e1.csv", "UTF-8", ",", 2), (1, "gold/e2.csv", "ISO-8859-1", ";", 1)]


def test_watermark_dedupe_drops_late_copies_and_forgets_keys(spark, tmp_dir):
    import datetime as dt
    schema = "id long, ts timestamp"
    drops = [[(day * 10 + i, dt.datetime(2024, 1, 1) + dt.timedelta(days=day)) for i in range(10)] for day in range(12)]
    held = []
    for day, rows in enumerate(drops):
        again = drops[day - 1][:5] if day else []
        late = drops[day - 9][:3] if day >= 9 else []
        spark.createDataFrame(rows + again + late + rows[:2], schema).coalesce(2).write.parquet(f"{tmp_dir}/in/{day:02d}")
        stream = file_events(spark, f"{tmp_dir}/in", spark.createDataFrame([], schema).schema)
        query = start_dedupe_stream(stream, f"{tmp_dir}/out", f"{tmp_dir}/ckpt", ["id"], "ts", "2 days")
        query.awaitTermination()
        held.append(state_rows(query)[-1])
    found = sorted(r.id for r in spark.read.parquet(f"{tmp_dir}/out").collect())
    assert found == [r[0] for rows in drops for r in rows]  # each once
    assert max(held) <= 60 < len(found)  # keys of a few days, not of the whole stream


# inventory

def test_idle_feeds_give_their_latest_folder(spark, tmp_dir):
    root = f"{tmp_dir}/root"
    for key in (f"{FEED_A}/date=2025-01-01/a.csv", f"{FEED_A}/date=2025-01-02/b.csv", f"{FEED_A}/date=2025-01-02/c.csv", f"{FEED_A}/loose.csv",
                f"{FEED_C}/date=2025-03-01/a.csv", "Bronze/database Eventim/date=2025-02-01/a.csv", "bronze/database Eventim/date=2024-01-01/a.csv",
                f"{FEED_A}/date=2025-01-03/_hidden.csv", "elsewhere/date=2025-01-01/a.csv"):
        put(f"{root}/{key}", "url,title,place,date\n")
    files = list_files(spark, root)
    inventory = folder_inventory(files)
    assert {r.prefix: r.n_files for r in inventory.collect()}[f"{FEED_A}/date=2025-01-02/"] == 2
    batch = spark.createDataFrame([(f"file:{root}/Bronze/database%20Sympla/date=2025-01-01/a.csv",)], "src_file string")
    states = folder_states(inventory, consumed_folders(batch))
    state = {r.prefix: r.state for r in states.collect()}
    assert state[f"{FEED_A}/date=2025-01-01/"] == "consumed" and state[f"{FEED_A}/date=2025-01-02/"] == "waiting"
    assert state["bronze/database Eventim/date=2024-01-01/"] == "idle_latest"  # last by name, both spellings are one feed
    assert {r.prefix for r in folder_states(inventory, consumed_folders(batch), by_date=True).where("state = 'idle_latest'").collect()} == {f"{FEED_C}/date=2025-03-01/"}
    moved = folders_to_move(states)
    assert [(r.position, r.prefix) for r in moved.orderBy("position").collect()] == [(1, f"{FEED_A}/date=2025-01-01/"), (2, "bronze/database Eventim/date=2024-01-01/")]
    assert {r.archive_key for r in files_to_move(files, moved).collect()} == {
        "Bronze/Arquivos Processados/source=sympla/date=2025-01-01/a.csv", "bronze/Arquivos Processados/source=eventim/date=2024-01-01/a.csv"}
    assert folder_inventory(list_files(spark, f"{tmp_dir}/none")).count() == 0


# frontier

def test_frontier_follows_links_and_reports_missing_pages(spark):
    base = "https://x.com/categoria/rock"
    page = lambda *links: "<html><!-- <a href='/categoria/rock?p=77'> -->" + "".join(f'<a class=x href="{h}">n</a>' for h in links)
    rows = [("1", base, page("/categoria/rock?p=2", "?p=3", "/categoria/pop?p=9", "/evento/1")), ("2", f"{base}?p=2", page(f"{base}?p=3", f"{base}?p=10")),
            ("3", f"{base}?p=10", page("/categoria/rock?p=4", "/categoria/rock?p=x")), ("4", f"{base}?p=50", page("/categoria/rock?p=51")), ("5", "https://x.com/local/y", "<p>none")]
    pages = spark.createDataFrame(rows, "page_id string, url string, html string")
    found = {r.url: (r.level, r.stored, r.position) for r in listing_frontier(pages).collect()}
    assert found == {base: (0, True, 1), f"{base}?p=x": (3, False, 2), f"{base}?p=2": (1, True, 3), f"{base}?p=3": (1, False, 4), f"{base}?p=4": (3, False, 5),
                     f"{base}?p=10": (2, True, 6), "https://x.com/local/y": (0, True, 1)}
    frontier = listing_frontier(pages)
    assert missing_pages(frontier).count() == 3
    assert [r.url for r in next_missing(frontier).collect()] == [f"{base}?p=x"]
    assert max(r.level for r in listing_frontier(pages, max_levels=1).collect()) == 1


def test_nav_links_skip_comments(spark):
    from eventlake.sources.html import nav_data_links
    html = ('<!-- <ul aria-label="Todos os eventos"><div class="js-nav-sub-trigger" data-href="/no/"></div></ul> -->'
            '<ul aria-label="Todos os eventos"><div title="a > b" class="js-nav-sub-trigger" data-href="/yes/"></div></ul>')
    pages = spark.createDataFrame([("1", "https://x.com/", html)], "page_id string, url string, html string")
    assert [r.link for r in nav_data_links(pages).collect()] == ["https://x.com/yes/"]


# publishing

def test_readers_see_one_version(spark, tmp_dir):
    base, db = f"{tmp_dir}/tables/events", "eventlake_publish_test"
    first = spark.createDataFrame([("a", 'say "x", y\nz', "2025-01-01 10:00:00")], "k string, text string, at string").withColumn("at", F.col("at").cast("timestamp"))
    one = publish(first, db, "events", base, "csv")
    reader = spark.table(f"{db}.events")  # a reader that has resolved the table
    assert [tuple(r)[:2] for r in reader.collect()] == [("a", 'say "x", y\nz')] and dict(reader.dtypes)["at"] == "timestamp"
    two = publish(first.union(first.withColumn("k", F.lit("b"))), db, "events", base, "csv")
    assert location(spark, db, "events").endswith(two.rsplit("/", 1)[-1])
    assert reader.count() == 1 and spark.table(f"{db}.events").count() == 2  # the old version until it ends, the new one from now on
    assert remove_stale(spark, db, "events", base, grace_seconds=3600) == []
    assert remove_stale(spark, db, "events", base, grace_seconds=-1) == [one] and versions(spark, base) == [two]
    assert spark.table(f"{db}.events").count() == 2
    publish(first.select("k"), db, "events", base, "parquet")  # another format and schema
    assert spark.table(f"{db}.events").columns == ["k"]
