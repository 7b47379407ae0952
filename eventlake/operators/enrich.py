"""Enrichment joins (definitions ours; the original script is not public).

* :func:`brazil_holidays` (J1 input): national holidays per year, fixed dates
  plus the Easter-based movable ones, generated by Spark expressions.
* :func:`holiday_features` (J1): per purchase, holiday flag/name and days to the
  next / since the previous holiday.  The join side is a day calendar over the
  data's date span (size = days in the span, checked before broadcasting).
* :func:`band_counts` (J2): per anchor event, how many events of another kind the
  same user had in ``[t - before, t]``.  Computed from running counts (two
  probes per anchor on one ordered stream), so no anchor x event pairs are
  ever produced, and the stream is range-partitioned so a hot user is split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from eventlake.operators.joins import broadcast_if_small
from eventlake.operators.sequence import with_running_sum

# Fixed-date national holidays (month, day, name, first year or None).
FIXED_HOLIDAYS = [
    (1, 1, "Confraternização Universal", None),
    (4, 21, "Tiradentes", None),
    (5, 1, "Dia do Trabalho", None),
    (9, 7, "Independência do Brasil", None),
    (10, 12, "Nossa Senhora Aparecida", None),
    (11, 2, "Finados", None),
    (11, 15, "Proclamação da República", None),
    (11, 20, "Dia Nacional de Zumbi e da Consciência Negra", 2024),
    (12, 25, "Natal", None),
]
# Easter-relative holidays (offset days, name, scope).
MOVABLE_HOLIDAYS = [
    (-48, "Carnaval (segunda-feira)", "ponto_facultativo"),
    (-47, "Carnaval (terça-feira)", "ponto_facultativo"),
    (-2, "Sexta-feira Santa", "nacional"),
    (60, "Corpus Christi", "ponto_facultativo"),
]


def easter_sunday(year: F.Column) -> F.Column:
    """Gregorian Easter date (anonymous Gregorian algorithm) as a Spark expression."""
    y = year
    a = F.pmod(y, F.lit(19))
    b = (y / 100).cast("int")
    c = F.pmod(y, F.lit(100))
    d = (b / 4).cast("int")
    e = F.pmod(b, F.lit(4))
    f = ((b + 8) / 25).cast("int")
    g = ((b - f + 1) / 3).cast("int")
    h = F.pmod(19 * a + b - d - g + 15, F.lit(30))
    i = (c / 4).cast("int")
    k = F.pmod(c, F.lit(4))
    l_ = F.pmod(32 + 2 * e + 2 * i - h - k, F.lit(7))
    m = ((a + 11 * h + 22 * l_) / 451).cast("int")
    t = h + l_ - 7 * m + 114
    return F.make_date(y, (t / 31).cast("int"), F.pmod(t, F.lit(31)) + 1)


def brazil_holidays(spark: SparkSession, first_year: int, last_year: int) -> DataFrame:
    years = spark.range(first_year, last_year + 1).select(F.col("id").cast("int").alias("y"))
    fixed = [F.when(F.lit(since is None) | (F.col("y") >= F.lit(since or 0)),
                    F.struct(F.make_date("y", F.lit(mo), F.lit(dy)).alias("holiday_date"),
                             F.lit(name).alias("name"), F.lit("nacional").alias("scope")))
             for mo, dy, name, since in FIXED_HOLIDAYS]
    easter = easter_sunday(F.col("y"))
    movable = [F.struct(F.date_add(easter, off).alias("holiday_date"), F.lit(name).alias("name"),
                        F.lit(scope).alias("scope")) for off, name, scope in MOVABLE_HOLIDAYS]
    out = years.select(F.explode(F.array(*fixed, *movable)).alias("h")).filter(F.col("h").isNotNull())
    return out.select("h.holiday_date", "h.name", "h.scope")


def holiday_calendar(holidays: DataFrame, days: DataFrame) -> DataFrame:
    """One row per day in ``days(day)``: holiday name (first by name) on that day, next
    holiday on/after it and previous holiday on/before it.

    Only observed days and holidays are ordered, so a sentinel date adds one row, not a span;
    there are at most as many rows as calendar days, whatever the number of purchases."""
    per_day = holidays.groupBy(F.col("holiday_date").alias("day")).agg(F.min("name").alias("holiday_name"))
    cal = (days.where("day is not null").distinct().join(per_day, "day", "full_outer")
           .withColumn("holiday_date", F.when(F.col("holiday_name").isNotNull(), F.col("day"))))
    fwd = Window.orderBy("day").rowsBetween(Window.currentRow, Window.unboundedFollowing)
    bwd = Window.orderBy("day").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return cal.select(
        "day", "holiday_name",
        F.first("holiday_date", ignorenulls=True).over(fwd).alias("next_holiday"),
        F.last("holiday_date", ignorenulls=True).over(bwd).alias("prev_holiday"))


def holiday_features(purchases: DataFrame, holidays: DataFrame) -> DataFrame:
    p = purchases.withColumn("purchase_date", F.to_date("purchased_at"))
    cal = holiday_calendar(holidays, p.select(F.col("purchase_date").alias("day")))
    j = p.join(cal, p.purchase_date == cal.day, "left")
    return j.select(
        "purchase_id", "client_id", "purchase_date",
        F.col("holiday_name").isNotNull().alias("is_holiday"), "holiday_name",
        F.datediff("next_holiday", "purchase_date").alias("days_to_next_holiday"),
        F.datediff("purchase_date", "prev_holiday").alias("days_since_prev_holiday"))


def band_counts(events: DataFrame, anchor_type: str, counted_type: str, before_s: int,
                user: str = "user_id", ts: str = "ts", kind: str = "event_type",
                event_id: str = "event_id", out: str = "n_in_band", after_s: int = 0,
                n_partitions: int | None = None) -> DataFrame:
    """Per ``anchor_type`` event: count of ``counted_type`` events with the same
    ``user`` key and ``t - before_s <= ts <= t + after_s``."""
    anchors = events.filter(F.col(kind) == anchor_type).select(
        F.col(event_id).alias("_aid"), F.col(user).alias("_k"), F.col(ts).cast("timestamp").alias("_t"))
    counted = events.filter(F.col(kind) == counted_type).select(
        F.col(event_id).alias("_cid"), F.col(user).alias("_k"), F.col(ts).cast("timestamp").alias("_t"))
    res = keyed_band_counts(anchors, counted, before_s, after_s, n_partitions)
    a = events.filter(F.col(kind) == anchor_type).select(F.col(event_id), F.col(user), F.col(ts))
    return a.join(res, a[event_id] == res["_aid"]).select(event_id, user, ts, F.col("_n").alias(out))


def keyed_band_counts(anchors: DataFrame, counted: DataFrame, before_s: int, after_s: int = 0,
                      n_partitions: int | None = None) -> DataFrame:
    """``anchors(_aid, _k, _t)``, ``counted(_cid, _k, _t)`` -> ``(_aid, _n)``: counted
    rows with the same key and ``_t`` in ``[t - before_s, t + after_s]``."""
    return keyed_window_counts(anchors, counted, {"_n": (before_s, after_s)}, n_partitions)


def keyed_window_counts(anchors: DataFrame, counted: DataFrame, windows: dict[str, tuple[int, int]],
                        n_partitions: int | None = None) -> DataFrame:
    """``_aid`` and one count per window ``{name: (seconds before, seconds after)}``.

    One ordered stream per key holds the counted rows (weight 1) and two probes
    per anchor and window (weight 0); a count is the running count at the upper probe minus
    that at the lower one.  Probes sort after/before counted rows at
    the same instant so both bounds are inclusive.  Anchors with a null key or
    time count 0."""
    c = counted.filter(F.col("_k").isNotNull() & F.col("_t").isNotNull()).select(
        "_k", "_t", F.lit(0).alias("_rank"), F.col("_cid").cast("string").alias("_id"),
        F.lit(1).alias("_w"), F.lit(None).cast("string").alias("_anchor"), F.lit("").alias("_side"))
    a = anchors.filter(F.col("_k").isNotNull() & F.col("_t").isNotNull())
    probes = []
    for name, (before_s, after_s) in windows.items():
        for side, shift, rank in (("hi", int(after_s), 1), ("lo", -int(before_s), -1)):
            at = F.col("_t") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(shift))
            probes.append(F.struct(at.alias("t"), F.lit(rank).alias("rank"), F.lit(f"{side}:{name}").alias("side")))
    p = a.select("_k", F.col("_aid").cast("string").alias("_anchor"), F.explode(F.array(*probes)).alias("p")).select(
        "_k", F.col("p.t").alias("_t"), F.col("p.rank").alias("_rank"), F.col("_anchor").alias("_id"), F.lit(0).alias("_w"),
        "_anchor", F.col("p.side").alias("_side"))
    run = with_running_sum(c.unionByName(p), "_k", ["_t", "_rank", "_id", "_side"], "_w", "_cum",
                           n_partitions=n_partitions)
    at = lambda side: F.max(F.when(F.col("_side") == side, F.col("_cum")))
    found = run.filter(F.col("_anchor").isNotNull()).groupBy("_anchor").agg(
        *[(at(f"hi:{name}") - at(f"lo:{name}")).cast("long").alias(name) for name in windows])
    ids = anchors.select(F.col("_aid"), F.col("_aid").cast("string").alias("_anchor"))
    return ids.join(found, "_anchor", "left").select("_aid", *[F.coalesce(name, F.lit(0)).alias(name) for name in windows])


def event_proximity_counts(purchases: DataFrame, events: DataFrame, days_before: int = 30,
                           days_after: int = 30, n_partitions: int | None = None) -> DataFrame:
    """Per purchase, listed events in the purchase's destination city in the
    ``days_before`` days up to the purchase and in the ``days_after`` days after it.
    ``events`` are Silver rows (``event_url, city, event_date``), read once."""
    anchors = purchases.select(F.col("purchase_id").alias("_aid"), F.col("destination").alias("_k"),
                               F.col("purchased_at").cast("timestamp").alias("_t"))
    counted = events.select(F.col("event_url").alias("_cid"), F.trim("city").alias("_k"),
                            F.col("event_date").alias("_t"))
    day = 86400
    windows = {f"events_prev_{days_before}d": (days_before * day, 0), f"events_next_{days_after}d": (0, days_after * day)}
    return keyed_window_counts(anchors, counted, windows, n_partitions).withColumnRenamed("_aid", "purchase_id")
