"""Purchase-within-horizon labels (definitions ours; the original script is not public).

* :func:`next_purchase_labels` (L1): per purchase, days to the client's next
  purchase and 0/1 labels per horizon.  An anchor whose horizon runs past the
  end of the data (``as_of``) and has no next purchase inside it is censored:
  null, not 0.
* :func:`cutoff_labels` (L2): per (client, cutoff): features from purchases on or
  before the cutoff, label = any purchase in ``(cutoff, cutoff + horizon]``.
  Each purchase is expanded only to the cutoffs it concerns (a bounded parameter
  list) – no client x cutoff cross product.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlake.operators.sequence import with_next

ORDER = ["purchased_at", "purchase_id"]


def next_purchase_labels(purchases: DataFrame, as_of: str, horizons=(7, 30),
                         n_partitions: int | None = None) -> DataFrame:
    p = purchases.select("client_id", "purchase_id", "purchased_at",
                         F.to_date("purchased_at").alias("purchase_date"))
    x = with_next(p, "client_id", ORDER, ["purchase_date"], n_partitions=n_partitions)
    days = F.datediff("next_purchase_date", "purchase_date")
    end = F.lit(as_of).cast("date")
    cols = [F.col(c) for c in ("client_id", "purchase_id", "purchase_date", "next_purchase_date")]
    cols.append(days.alias("days_to_next"))
    for h in horizons:
        cols.append(F.when(F.col("next_purchase_date").isNotNull() & (days <= h), 1)
                     .when(F.date_add("purchase_date", h) <= end, 0)
                     .alias(f"label_{h}d"))
    return x.select(*cols)


def cutoff_dates(first: dt.date, last: dt.date, months: int = 6) -> list[dt.date]:
    """Cutoffs every ``months`` months (day 1), strictly after ``first`` and before ``last``."""
    out = []
    y, m = first.year, 1
    while True:
        d = dt.date(y, m, 1)
        if d > first and d < last:
            out.append(d)
        if d >= last:
            return out
        m += months
        while m > 12:
            m -= 12
            y += 1


def cutoff_labels(purchases: DataFrame, cutoffs: list, horizon: int, as_of: str) -> DataFrame:
    cuts = F.array(*[F.lit(c).cast("date") for c in cutoffs])
    d = F.to_date("purchased_at")
    p = purchases.select("client_id", d.alias("d"), "gmv")
    before = p.select("client_id", "d", "gmv",
                      F.explode(F.filter(cuts, lambda c: c >= F.col("d"))).alias("cutoff"))
    feats = before.groupBy("client_id", "cutoff").agg(
        F.count(F.lit(1)).alias("n_purchases"),
        F.sum("gmv").cast("decimal(18,2)").alias("gmv_before"),
        F.datediff(F.col("cutoff"), F.max("d")).alias("days_since_last"))
    after = p.select("client_id", F.explode(F.filter(
        cuts, lambda c: (c < F.col("d")) & (F.date_add(c, horizon) >= F.col("d")))).alias("cutoff"))
    hits = after.groupBy("client_id", "cutoff").agg(F.count(F.lit(1)).alias("n_in_horizon"))
    end = F.lit(as_of).cast("date")
    return feats.join(hits, ["client_id", "cutoff"], "left").select(
        "client_id", "cutoff", "n_purchases", "gmv_before", "days_since_last",
        F.when(F.col("n_in_horizon") > 0, 1)
         .when(F.date_add("cutoff", horizon) <= end, 0).alias("label"))
