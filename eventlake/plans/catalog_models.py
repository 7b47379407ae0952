"""Registered queries of exact model evaluation, sketches and the enrichment tables.

Imported by ``catalog``, whose registry they join.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from eventlake.plans import oracle as O
from eventlake.plans.catalog import ORACLE, _as_of, _cutoffs, _holidays_sql, _purchases, _silver, register
from eventlake.session import scratch_dir, staged

RUN_DATE = "1998-08-02"

_FEATURE_ROWS = "WITH label_rows AS (" + ORACLE["label_cutoffs"] + """
),
scored AS (
  SELECT 'n_purchases' AS model, CAST(n_purchases AS DOUBLE) AS score, label FROM label_rows WHERE label IS NOT NULL
  UNION ALL SELECT 'gmv_before', gmv_before, label FROM label_rows WHERE label IS NOT NULL
  UNION ALL SELECT 'recency', CAST(-days_since_last AS DOUBLE), label FROM label_rows WHERE label IS NOT NULL
)"""


@register("auc_by_feature", _FEATURE_ROWS + """,
ranked AS (
  SELECT model, label, 2 * rank() OVER (PARTITION BY model ORDER BY score) + count(*) OVER (PARTITION BY model, score) - 1 AS rank2
  FROM scored
),
sums AS (
  SELECT model, count(*) AS n, sum(label) AS n_positive, sum(CASE WHEN label = 1 THEN rank2 ELSE 0 END) AS rank2_positive FROM ranked GROUP BY model
)
SELECT model, n, CAST(n_positive AS BIGINT) AS n_positive,
       CAST(rank2_positive - n_positive * (n_positive + 1) AS DOUBLE) / CAST(2 * n_positive * (n - n_positive) AS DOUBLE) AS auc
FROM sums""")
def auc_by_feature(spark, sf_dir):
    """L3 evaluation: exact AUC, ties at half weight, of ranking (client, cutoff) rows by each feature
    against the 30-day label; ranks come from a range-partitioned running count."""
    from eventlake.operators.evaluate import auc
    from eventlake.operators.labels import cutoff_labels
    p = _purchases(spark, sf_dir)
    cuts, as_of = _cutoffs(p)
    rows = staged(cutoff_labels(p, cuts, 30, as_of).where("label is not null"), "auc-rows")
    rankers = {"n_purchases": F.col("n_purchases"), "gmv_before": F.col("gmv_before"), "recency": -F.col("days_since_last")}
    each = F.explode(F.array(*[F.struct(F.lit(name).alias("model"), c.cast("double").alias("score")) for name, c in rankers.items()]))
    return auc(rows.select("label", each.alias("r")).select("label", "r.*"))


@register("route_confusion", O.with_(O.SEQ_CTE + """,
pairs AS (
  SELECT CASE WHEN route IN (SELECT route FROM top20) THEN route ELSE 'OUTROS' END AS route,
         CASE WHEN next_route IN (SELECT route FROM top20) THEN next_route ELSE 'OUTROS' END AS actual
  FROM seq WHERE route IS NOT NULL AND next_route IS NOT NULL
),
guess AS (
  SELECT route, actual AS predicted FROM (
    SELECT route, actual, row_number() OVER (PARTITION BY route ORDER BY count(*) DESC, actual) AS rn FROM pairs GROUP BY route, actual) WHERE rn = 1
),
judged AS (SELECT p.actual, g.predicted FROM pairs p JOIN guess g ON p.route = g.route)""", """
SELECT *, CAST(n_right AS DOUBLE) / NULLIF(n_predicted, 0) AS precision, CAST(n_right AS DOUBLE) / NULLIF(n_actual, 0) AS recall,
       CAST(n_right AS DOUBLE) * 2 / (n_actual + n_predicted) AS f1
FROM (
  SELECT c.route_class,
         (SELECT count(*) FROM judged WHERE actual = c.route_class) AS n_actual,
         (SELECT count(*) FROM judged WHERE predicted = c.route_class) AS n_predicted,
         (SELECT count(*) FROM judged WHERE actual = c.route_class AND predicted = c.route_class) AS n_right
  FROM (SELECT actual AS route_class FROM judged UNION SELECT predicted FROM judged) c)"""))
def route_confusion(spark, sf_dir):
    """R4 evaluation: precision, recall and F1 per class of predicting the most frequent successor of
    a route, from the confusion table."""
    from eventlake.operators.evaluate import class_report, confusion
    from eventlake.operators.joins import first_by_order
    from eventlake.operators.routes import next_route_targets
    pairs = staged(next_route_targets(_purchases(spark, sf_dir), 20).select("route", "next_route"), "route-pairs")
    counts = pairs.groupBy("route", "next_route").agg(F.count(F.lit(1)).alias("n"))
    guess = first_by_order(counts, ["route"], [F.col("n").desc(), F.col("next_route").asc()])
    judged = pairs.join(guess.select("route", F.col("next_route").alias("predicted")), "route")
    return class_report(confusion(judged, "next_route", "predicted")).withColumnRenamed("class", "route_class")


@register("ml_7_30_report")
def ml_7_30_report(spark, sf_dir):
    """L3 boosted trees with early stopping on the last training cutoffs, beside the linear model:
    exact out-of-time AUC per horizon."""
    from eventlake.operators.ml import horizon_report
    p = staged(_purchases(spark, sf_dir), "purchases")
    cuts, as_of = _cutoffs(p)
    return horizon_report(p, cuts, str(cuts[(2 * len(cuts)) // 3]), as_of)


@register("sketch_bounds", O.with_(O.PURCHASES_CTE, """
SELECT strftime(d, '%Y-%m') AS month, count(*) AS n, count(DISTINCT client_id) AS n_clients, TRUE AS distinct_within, TRUE AS median_within
FROM purchases GROUP BY 1"""))
def sketch_bounds(spark, sf_dir):
    """A3/A6 at scale: daily HLL and KLL sketches, written once and merged by month; the exact count
    of clients, and whether both estimates keep their error bounds."""
    from eventlake.operators.sketches import RANK_BOUND, daily_sketches, distinct_bound, estimates, merged
    p = _purchases(spark, sf_dir).select("client_id", "purchased_at", "gmv")
    days = staged(daily_sketches(p), "daily-sketches")
    month = F.date_format("day", "yyyy-MM").alias("month")
    found = staged(estimates(merged(days.select(month, "n", "clients", "cents"), "month")), "sketch-estimates")
    rows = p.select(F.date_format("purchased_at", "yyyy-MM").alias("month"), "client_id", (F.col("gmv") * 100).cast("long").alias("value"))
    share = lambda c: F.sum(c.cast("long")) / F.count(F.lit(1))
    exact = rows.join(found.select("month", "quantile_cents"), "month").groupBy("month").agg(
        F.count_distinct("client_id").alias("exact_clients"), share(F.col("value") < F.col("quantile_cents")).alias("below"),
        share(F.col("value") <= F.col("quantile_cents")).alias("upto"))
    out = found.join(exact, "month")
    # Small sets are counted exactly but for one register collision.
    near = F.abs(F.col("n_clients") - F.col("exact_clients")) <= F.greatest(F.lit(1.0), F.col("exact_clients") * distinct_bound())
    return out.select("month", "n", F.col("exact_clients").alias("n_clients"), near.alias("distinct_within"),
                      ((F.col("below") <= 0.5 + RANK_BOUND) & (F.col("upto") >= 0.5 - RANK_BOUND)).alias("median_within"))


@register("client_holiday_share", O.with_(O.PURCHASES_CTE + "," + _holidays_sql(), """
SELECT p.client_id, count(h.holiday_date) AS n_holiday, CAST(count(h.holiday_date) AS DOUBLE) / count(*) AS holiday_share
FROM purchases p LEFT JOIN hd h ON h.holiday_date = p.d GROUP BY p.client_id"""))
def client_holiday_share(spark, sf_dir):
    """A8 share of each client's purchases that fall on a holiday."""
    from eventlake.operators.clients import holiday_share
    from eventlake.operators.enrich import brazil_holidays
    p = _purchases(spark, sf_dir)
    years = p.agg(F.min(F.year("purchased_at")), F.max(F.year("purchased_at"))).first()
    return holiday_share(p, brazil_holidays(spark, years[0], years[1]))


@register("enrichment_tables", O.with_(O.PURCHASES_CTE + "," + _holidays_sql() + "," + O.SILVER_CTE, f"""
SELECT 'holidays' AS name, count(*) AS n_rows, count(DISTINCT holiday_date) AS n_keys, CAST(sum(date_diff('day', DATE '1970-01-01', holiday_date)) AS BIGINT) AS total FROM hol
UNION ALL
SELECT 'events_past', count(*), count(DISTINCT event_url), CAST(sum(date_diff('day', DATE '1970-01-01', CAST(event_date AS DATE))) AS BIGINT)
FROM silver WHERE event_date < TIMESTAMP '{RUN_DATE}'
UNION ALL
SELECT 'events_future', count(*), count(DISTINCT event_url), CAST(sum(date_diff('day', DATE '1970-01-01', CAST(event_date AS DATE))) AS BIGINT)
FROM silver WHERE event_date >= TIMESTAMP '{RUN_DATE}'
UNION ALL
SELECT 'purchases_enriched', count(*), count(DISTINCT purchase_id), CAST(sum(near) AS BIGINT) FROM (
  SELECT p.purchase_id,
    (SELECT count(*) FROM silver s WHERE trim(s.city) = p.destination AND s.event_date >= p.purchased_at - INTERVAL 30 DAY
       AND s.event_date <= p.purchased_at)
    + 2 * (SELECT count(*) FROM silver s WHERE trim(s.city) = p.destination AND s.event_date >= p.purchased_at
       AND s.event_date <= p.purchased_at + INTERVAL 30 DAY)
    + 1000 * (SELECT count(*) FROM hd h WHERE h.holiday_date = p.d) AS near
  FROM purchases p)"""))
def enrichment_tables(spark, sf_dir):
    """K11 the four output tables of the enrichment job, written and read back: rows, keys and a
    total over each (days of events and holidays; near events and holiday flags of purchases)."""
    from eventlake.plans.jobs import enrichment_job
    p = _purchases(spark, sf_dir)
    paths = enrichment_job(spark, p, _silver(spark, sf_dir), scratch_dir(spark, "enrichment"), RUN_DATE)
    days = lambda c: F.unix_date(F.to_date(c))
    near = F.col("events_prev_30d") + 2 * F.col("events_next_30d") + 1000 * F.col("is_holiday").cast("long")
    keys = {"holidays": ("holiday_date", days("holiday_date")), "events_past": ("event_url", days("event_date")),
            "events_future": ("event_url", days("event_date")), "purchases_enriched": ("purchase_id", near)}
    out = None
    for name, (key, total) in keys.items():
        one = spark.read.parquet(paths[name]).agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct(key).alias("n_keys"),
                                                  F.sum(total).cast("long").alias("total")).select(F.lit(name).alias("name"), "*")
        out = one if out is None else out.unionByName(one)
    return out
