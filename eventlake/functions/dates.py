"""Date and time column functions (all JVM-side, no Python UDF).

* :func:`pt_timestamp`      – Portuguese listing dates (``25 de out às 20:00``,
  ``3 de março de 2026``, ``24 OUT • sex``); invalid values give null.
* :func:`to_ts_any`         – the Portuguese parser, then four fixed patterns.
* :func:`ingest_date_from_path` – ``date=`` folder, else ``_YYYYMMDD-HHMMSS.csv``
  file suffix, else the run date.
* :func:`brt_display`       – UTC (or a given zone) -> São Paulo display strings.
* :func:`date_phrase`, :func:`compose_card_date` – listing-card date text.

A text without a year takes ``year`` (the feed's ingest year by default), so a
result never depends on the day the job runs.
"""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from eventlake.schemas import BRT_TZ, FALLBACK_TS_PATTERNS, PT_MONTHS

# `D de MÊS [de AAAA] [às HH:MM]` and the short `D MMM` shape.  (?U) makes \s
# Unicode-aware like the original Python patterns; digits stay ASCII so a cast
# can never fail on a non-ASCII digit.
PT_LONG_RE = r"(?U)([0-9]{1,2})\s+de\s+([a-zçãé]+)(?:\s+de\s+([0-9]{4}))?(?:\s+às\s+([0-9]{1,2}):([0-9]{2}))?"
PT_SHORT_RE = r"(?U)([0-9]{1,2})\s+([a-z]{3})"
# Opt-in shape of the third feed: `sáb. 25/10/2025, 20:00`, ranges take the start.
NUMERIC_DMY_RE = r"(?U)([0-9]{2})/([0-9]{2})/([0-9]{4})(?:,\s*([0-9]{1,2}):([0-9]{2}))?"

INGEST_DIR_RE = r"date=([0-9]{4}-[0-9]{2}-[0-9]{2})"
INGEST_FILE_RE = r"_([0-9]{8})-[0-9]{6}\.csv$"
DATE_PHRASE_RE = r"(?iU)\d{1,2}\s+de\s+\w+\s+às\s+\d{1,2}:\d{2}"


def _month_map() -> Column:
    return F.create_map(*chain.from_iterable((F.lit(k), F.lit(v)) for k, v in PT_MONTHS.items()))


def _int_or_null(s: Column) -> Column:
    return F.when(s != "", s.try_cast("int"))


def _safe_ts(y: Column, mo: Column, d: Column, hh: Column, mi: Column) -> Column:
    ok = y.between(1, 9999) & mo.isNotNull() & d.isNotNull()
    return F.when(ok, F.try_make_timestamp(y, mo, d, hh, mi, F.lit(0)))


_SEP = "\u0001"


def _groups(t: Column, rx: str, n: int) -> Column:
    """Groups 1..n of the first match of ``rx`` in ``t`` with ONE regex pass:
    the whole text is rewritten to the groups joined by a control character and
    split.  No match -> the text is returned unchanged (one element)."""
    body = rx[4:] if rx.startswith("(?U)") else rx
    whole = "(?sU)^.*?" + body + ".*$"
    repl = _SEP.join(f"${i}" for i in range(1, n + 1))
    return F.split(F.regexp_replace(t, whole, repl), _SEP)


def _g(parts: Column, n: int, i: int) -> Column:
    return F.when(F.size(parts) == n, F.element_at(parts, i)).otherwise(F.lit(""))


def _bind(value: Column, fn) -> Column:
    """Evaluate ``value`` once per row and pass it to ``fn`` (a lambda variable
    is not duplicated by the optimizer the way a repeated subexpression is)."""
    return F.element_at(F.transform(F.array(value), fn), 1)


def _long_ts(lg: Column, year: Column, months: Column) -> Column:
    return _safe_ts(
        F.coalesce(_int_or_null(_g(lg, 5, 3)), year),
        F.try_element_at(months, _g(lg, 5, 2)),
        _int_or_null(_g(lg, 5, 1)),
        F.coalesce(_int_or_null(_g(lg, 5, 4)), F.lit(0)),
        F.coalesce(_int_or_null(_g(lg, 5, 5)), F.lit(0)),
    )


def _short_ts(sh: Column, year: Column, months: Column) -> Column:
    return _safe_ts(year, F.try_element_at(months, _g(sh, 2, 2)), _int_or_null(_g(sh, 2, 1)),
                    F.lit(0), F.lit(0))


def pt_timestamp(text: Column | str, year: Column | int | None = None) -> Column:
    """Parse a Portuguese listing date; ``year`` fills texts that carry none.

    Tried in order, first valid result wins: the long shape (its first match in
    the lower-cased text), then the short ``D MMM`` shape.  Unknown month, day
    or hour out of range -> that shape yields null.  Each shape costs one regex
    pass per row.
    """
    raw = F.col(text) if isinstance(text, str) else text
    t = F.translate(F.lower(raw), _SEP, "")
    if year is None:
        year = F.year(F.current_date())
    elif isinstance(year, int):
        year = F.lit(year)
    months = _month_map()
    return F.coalesce(
        _bind(_groups(t, PT_LONG_RE, 5), lambda lg: _long_ts(lg, year, months)),
        _bind(_groups(t, PT_SHORT_RE, 2), lambda sh: _short_ts(sh, year, months)))


def numeric_dmy_timestamp(text: Column | str) -> Column:
    """`dd/MM/yyyy[, HH:mm]` anywhere in the text (first match)."""
    t = F.translate(F.col(text) if isinstance(text, str) else text, _SEP, "")

    def build(g):
        return _safe_ts(_int_or_null(_g(g, 5, 3)), _int_or_null(_g(g, 5, 2)),
                        _int_or_null(_g(g, 5, 1)),
                        F.coalesce(_int_or_null(_g(g, 5, 4)), F.lit(0)),
                        F.coalesce(_int_or_null(_g(g, 5, 5)), F.lit(0)))
    return _bind(_groups(t, NUMERIC_DMY_RE, 5), build)


def to_ts_any(text: Column | str, year: Column | int | None = None,
              numeric_dmy: bool = False) -> Column:
    """Portuguese parser, then the fixed fallback patterns (``try_`` so ANSI mode
    returns null instead of failing).  ``numeric_dmy`` adds the opt-in shape of
    the third feed after the fixed patterns."""
    c = F.col(text) if isinstance(text, str) else text
    parts = [pt_timestamp(c, year)]
    # A failed pattern parse is costly (the parser throws internally), so each
    # pattern is only tried when the text could match it: it must start with a
    # digit and contain the pattern's date separator.
    starts_digit = F.substring(c, 1, 1).between("0", "9")
    for p in FALLBACK_TS_PATTERNS:
        sep = "-" if "-" in p else "/"
        parts.append(F.when(starts_digit & (F.instr(c, sep) > 0), F.try_to_timestamp(c, F.lit(p))))
    if numeric_dmy:
        parts.append(numeric_dmy_timestamp(c))
    return F.coalesce(*parts).cast("timestamp")


def ingest_date_from_path(path: Column | str, run_date: str | None = None) -> Column:
    """``yyyy-MM-dd`` string: the path's ``date=`` folder, else the
    ``_YYYYMMDD-HHMMSS.csv`` file suffix, else ``run_date`` (today if None)."""
    p = F.col(path) if isinstance(path, str) else path
    from_dir = F.regexp_extract(p, INGEST_DIR_RE, 1)
    stamp = F.regexp_extract(p, INGEST_FILE_RE, 1)
    from_file = F.concat_ws("-", F.substring(stamp, 1, 4), F.substring(stamp, 5, 2),
                            F.substring(stamp, 7, 2))
    fallback = F.lit(run_date) if run_date else F.date_format(F.current_timestamp(), "yyyy-MM-dd")
    return F.coalesce(F.nullif(from_dir, F.lit("")),
                      F.when(F.length(stamp) > 0, from_file),
                      fallback)


def to_brt(ts: Column, event_tz: str = "UTC") -> Column:
    """Shift a wall-clock timestamp stored as ``event_tz`` to São Paulo time.

    ``event_tz="UTC"`` reproduces the original behaviour (Brazilian wall-clock
    treated as UTC, so 20:00 shows 17:00); ``"America/Sao_Paulo"`` means no shift.
    """
    if event_tz == BRT_TZ:
        return ts
    if event_tz != "UTC":
        ts = F.to_utc_timestamp(ts, event_tz)
    return F.from_utc_timestamp(ts, BRT_TZ)


def brt_display(ts: Column, fmt: str, event_tz: str = "UTC") -> Column:
    return F.date_format(to_brt(ts, event_tz), fmt)


def date_phrase(text: Column | str) -> Column:
    """First ``D de MÊS às HH:MM`` phrase in a card's text, or null."""
    t = F.col(text) if isinstance(text, str) else text
    return F.nullif(F.regexp_extract(t, DATE_PHRASE_RE, 0), F.lit(""))


def compose_card_date(day: Column, month: Column, week: Column) -> Column:
    """``D MMM • weekday`` when day and month exist; the weekday part is optional."""
    d, m, w = (F.coalesce(F.trim(c), F.lit("")) for c in (day, month, week))
    week_part = F.when(w != "", F.concat(F.lit(" • "), w)).otherwise(F.lit(""))
    return F.when((d != "") & (m != ""), F.concat(d, F.lit(" "), m, week_part))
