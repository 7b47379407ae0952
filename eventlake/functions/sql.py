"""The column functions as SQL functions (V1), for ``spark.sql`` users.

``register_sql_functions(spark)`` creates temporary SQL functions:

* ``pt_timestamp(text STRING, year INT) -> TIMESTAMP``
* ``to_ts_any(text STRING, year INT) -> TIMESTAMP``
* ``city_from_venue(venue STRING) -> STRING`` and ``venue_local(venue STRING) -> STRING``
* ``ingest_date_from_path(path STRING, run_date STRING) -> STRING``

Bodies are plain SQL expressions (no Python), built from the same fixed
patterns and month table as the DataFrame functions.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from eventlake.functions.dates import (FALLBACK_TS_PATTERNS, INGEST_DIR_RE, INGEST_FILE_RE,
                                       PT_LONG_RE, PT_SHORT_RE)
from eventlake.schemas import PT_MONTHS


def _q(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _month_map() -> str:
    return "map(" + ", ".join(f"{_q(k)}, {v}" for k, v in PT_MONTHS.items()) + ")"


def _pt_sql() -> str:
    t = "lower(text)"

    def g(rx, i):
        return f"regexp_extract({t}, {_q(rx)}, {i})"

    def num(rx, i):
        return f"try_cast(nullif({g(rx, i)}, '') AS INT)"

    m = _month_map()
    long_ts = (f"try_make_timestamp(coalesce({num(PT_LONG_RE, 3)}, year), "
               f"try_element_at({m}, {g(PT_LONG_RE, 2)}), {num(PT_LONG_RE, 1)}, "
               f"coalesce({num(PT_LONG_RE, 4)}, 0), coalesce({num(PT_LONG_RE, 5)}, 0), 0)")
    short_ts = (f"try_make_timestamp(year, try_element_at({m}, {g(PT_SHORT_RE, 2)}), "
                f"{num(PT_SHORT_RE, 1)}, 0, 0, 0)")
    ok_long = f"coalesce({num(PT_LONG_RE, 3)}, year) BETWEEN 1 AND 9999"
    return (f"coalesce(CASE WHEN {ok_long} THEN {long_ts} END, "
            f"CASE WHEN year BETWEEN 1 AND 9999 THEN {short_ts} END)")


def register_sql_functions(spark: SparkSession) -> list[str]:
    pt = _pt_sql()
    fall = ", ".join(
        f"CASE WHEN substring(text, 1, 1) BETWEEN '0' AND '9' AND instr(text, {_q('-' if '-' in p else '/')}) > 0 "
        f"THEN try_to_timestamp(text, {_q(p)}) END" for p in FALLBACK_TS_PATTERNS)
    stamp = f"regexp_extract(path, {_q(INGEST_FILE_RE)}, 1)"
    defs = {
        "pt_timestamp": ("text STRING, year INT", "TIMESTAMP", pt),
        "to_ts_any": ("text STRING, year INT", "TIMESTAMP", f"coalesce(pt_timestamp(text, year), {fall})"),
        "city_from_venue": ("venue STRING", "STRING", f"trim(regexp_extract(venue, {_q(r'-(?!.*-)\s*(.*)$')}, 1))"),
        "venue_local": ("venue STRING", "STRING", f"trim(regexp_replace(venue, {_q(r'\s*[-–—][^-–—]*$')}, ''))"),
        "ingest_date_from_path": (
            "path STRING, run_date STRING", "STRING",
            f"coalesce(nullif(regexp_extract(path, {_q(INGEST_DIR_RE)}, 1), ''), "
            f"CASE WHEN length({stamp}) > 0 THEN concat_ws('-', substring({stamp}, 1, 4), "
            f"substring({stamp}, 5, 2), substring({stamp}, 7, 2)) END, run_date)"),
    }
    for name, (args, ret, body) in defs.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({args}) RETURNS {ret} RETURN {body}")
    return list(defs)
