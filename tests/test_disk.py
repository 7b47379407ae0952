"""Scratch data: shuffle files go with their action, many rows are merged in rounds, staged rows are removed."""

import os
import time

from eventlake.operators.silver import survivor_order
from eventlake.session import staged_while
from eventlake.sinks import tables
from eventlake.sinks.tables import by_key, dedupe_merge, upsert_buckets

COLUMNS = "event_url string, title string, source string, ingest_date string, src_file string, venue string, city string, event_date_text string, event_date string"


def _rows(spark, day, n=60):
    rows = [(None if i == 7 else f"u{i % 20}", f"t{i}", "sympla", f"2024-01-{day + i % 3:02d}", "f", "v", "c", "d", "e") for i in range(n)]
    return spark.createDataFrame(rows + rows[:5], COLUMNS)


def _shuffle_files(spark) -> int:
    files = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().getAllFiles()
    return sum("shuffle_" in files.apply(i).getName() for i in range(files.size()))


def test_rounds_merge_like_one(spark, tmp_path, monkeypatch):
    merge = dedupe_merge(survivor_order(), "event_url")
    out = {}
    for name, most in (("one", 1_000_000), ("rounds", 10)):
        monkeypatch.setattr(tables, "ROUND_ROWS", most)
        path = str(tmp_path / name)
        for day in (1, 4):
            with staged_while(_rows(spark, day), "rows") as rows:
                parts = by_key(rows, "event_url")
                assert (len(parts) > 1) == (name == "rounds")
                keys = [{r[0] for r in part.select("event_url").collect()} for part in parts]
                assert sum(map(len, keys)) == 21 and set.union(*keys) == {None, *(f"u{i}" for i in range(20))}
                done = upsert_buckets(spark, path, parts, "event_url", merge, n_buckets=4)
                assert done.rows == 65
        out[name] = sorted(map(str, spark.read.parquet(path).collect()))
    assert out["one"] == out["rounds"] and len(out["one"]) == 21


def test_upsert_leaves_no_shuffle_files(spark, tmp_path):
    before = _shuffle_files(spark)
    upsert_buckets(spark, str(tmp_path / "t"), _rows(spark, 1).repartition(3), "event_url", dedupe_merge(survivor_order(), "event_url"), n_buckets=4)
    until = time.monotonic() + 20  # block managers remove them in the background
    while _shuffle_files(spark) > before and time.monotonic() < until:
        time.sleep(0.2)
    assert _shuffle_files(spark) <= before


def test_staged_rows_are_removed(spark):
    with staged_while(_rows(spark, 1), "rows") as rows:
        folder = rows.inputFiles()[0].rsplit("/", 1)[0].removeprefix("file://")
        assert rows.count() == 65 and os.path.isdir(folder)
    assert not os.path.exists(folder)


def test_bronze_tree_leaves_only_its_files(spark, tmp_path):
    from pathlib import Path

    from eventlake.plans import standins
    from eventlake.session import checkpoint_root
    sf = tmp_path / "sf"
    for name, row in {
        "lineitem": "1L l_orderkey, 1L l_partkey, 1 l_linenumber, 'A' l_returnflag, 'F' l_linestatus, date'2024-01-05' l_shipdate",
        "orders": "1L o_orderkey, 1L o_custkey, date'2024-02-05' o_orderdate, '1-URGENT' o_orderpriority",
        "customer": "1L c_custkey, 1 c_nationkey, 'BUILDING' c_mktsegment", "nation": "1 n_nationkey, 'PERU' n_name",
        "part": "1L p_partkey, 'show' p_name, 'b' p_brand"}.items():
        spark.sql(f"select {row}").write.parquet(f"{sf}/{name}.parquet")
    scratch = Path(checkpoint_root(spark).removeprefix("file:")) / "eventlake"
    before = set(scratch.glob("listing-rows-*"))
    standins.write_bronze_tree(spark, str(sf), str(tmp_path / "root"), only=("sympla",))
    assert set(scratch.glob("listing-rows-*")) == before
    lines = [line for f in (tmp_path / "root").rglob("*.csv") for line in f.read_text().splitlines()]
    assert len(lines) == 2 and "show - PERU" in lines[1]
