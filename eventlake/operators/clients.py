"""Client features, segments, profile and stable ids from purchase history.

The original client scripts are not public; only their inputs, goals and the
columns ``client_id_seq, seg_recorrencia, seg_velocidade, gmv_total, qtd_compras``
are.  Every definition here is ours and parameterised:

* recurrence segment from the purchase count (cut points ``recurrence_cuts``);
* speed segment from the mean days between purchases, compared exactly as
  ``span_days <= cut * (n - 1)`` (cut points ``speed_cuts``); one purchase ->
  ``sem_intervalo``.

Input: a purchases frame (``client_id, purchase_id, purchased_at, gmv, origin,
destination``).  All aggregates are map-side combined; a hot client costs one
partial row per map task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eventlake.operators.joins import broadcast_if_small, first_by_order
from eventlake.operators.stats import median
from eventlake.session import checkpoint_root

RECURRENCE_CUTS = (7, 12)               # <=7 ocasional, <=12 regular, else recorrente
RECURRENCE_LABELS = ("ocasional", "regular", "recorrente")
SPEED_CUTS = (175, 277)                 # mean gap days: <=175 rapido, <=277 moderado
SPEED_LABELS = ("rapido", "moderado", "lento", "sem_intervalo")


def route_col(origin="origin", destination="destination") -> F.Column:
    return F.when(F.col(origin).isNotNull() & F.col(destination).isNotNull(),
                  F.concat(F.col(origin), F.lit(" -> "), F.col(destination)))


def client_totals(purchases: DataFrame) -> DataFrame:
    """A4: count, GMV (exact decimal), first and last purchase day per client."""
    d = F.to_date("purchased_at")
    return purchases.groupBy("client_id").agg(
        F.count(F.lit(1)).alias("qtd_compras"),
        F.sum("gmv").cast("decimal(18,2)").alias("gmv_total"),
        F.min(d).alias("first_purchase"),
        F.max(d).alias("last_purchase"),
    )


def modal_route(purchases: DataFrame) -> DataFrame:
    """Most frequent route per client (ties: smallest route text)."""
    r = purchases.select("client_id", route_col().alias("route")).filter(F.col("route").isNotNull())
    counts = r.groupBy("client_id", "route").agg(F.count(F.lit(1)).alias("_n"))
    top = first_by_order(counts, ["client_id"], [F.col("_n").desc(), F.col("route").asc()])
    return top.select("client_id", F.col("route").alias("modal_route"))


def holiday_share(purchases: DataFrame, holidays: DataFrame) -> DataFrame:
    """client_id, n_holiday, holiday_share: purchases made on a day of ``holidays(holiday_date, …)``.

    The holidays are one row per day of the calendar; a purchase without a date is not on one."""
    days = holidays.select(F.col("holiday_date").alias("_day")).distinct()
    p = purchases.select("client_id", F.to_date("purchased_at").alias("_d"))
    hit = p.join(broadcast_if_small(days), F.col("_d") == F.col("_day"), "left")
    out = hit.groupBy("client_id").agg(F.count("_day").alias("n_holiday"), F.count(F.lit(1)).alias("_n"))
    return out.select("client_id", "n_holiday", (F.col("n_holiday").cast("double") / F.col("_n")).alias("holiday_share"))


def client_features(purchases: DataFrame, as_of: str,
                    recurrence_cuts=RECURRENCE_CUTS, speed_cuts=SPEED_CUTS, holidays: DataFrame | None = None) -> DataFrame:
    """A8 + G1 + G2: one row per client; with ``holidays`` also the share of purchases on one."""
    d = F.to_date("purchased_at")
    cents = (F.col("gmv") * 100).cast("long")
    agg = purchases.groupBy("client_id").agg(
        F.count(F.lit(1)).alias("qtd_compras"),
        F.sum("gmv").cast("decimal(18,2)").alias("gmv_total"),
        F.sum(cents).alias("_cents"),
        F.min(d).alias("first_purchase"),
        F.max(d).alias("last_purchase"),
        F.sum(F.when(F.dayofweek(d).isin(1, 7), 1).otherwise(0)).alias("n_weekend"),
    )
    n = F.col("qtd_compras")
    span = F.datediff("last_purchase", "first_purchase")
    out = agg.select(
        "client_id", "qtd_compras", "gmv_total", "first_purchase", "last_purchase",
        (F.col("_cents").cast("double") / n / 100).alias("ticket_medio"),
        span.alias("tenure_days"),
        F.when(n > 1, span.cast("double") / (n - 1)).alias("mean_gap_days"),
        F.datediff(F.lit(as_of).cast("date"), F.col("last_purchase")).alias("recency_days"),
        (F.col("n_weekend").cast("double") / n).alias("weekend_share"),
        recurrence_segment(n, recurrence_cuts).alias("seg_recorrencia"),
        speed_segment(n, span, speed_cuts).alias("seg_velocidade"),
    )
    out = out.join(modal_route(purchases), "client_id", "left")
    return out if holidays is None else out.join(holiday_share(purchases, holidays).drop("n_holiday"), "client_id", "left")


def recurrence_segment(n, cuts=RECURRENCE_CUTS, labels=RECURRENCE_LABELS) -> F.Column:
    return F.when(n <= cuts[0], labels[0]).when(n <= cuts[1], labels[1]).otherwise(labels[2])


def speed_segment(n, span, cuts=SPEED_CUTS, labels=SPEED_LABELS) -> F.Column:
    gaps = n - 1
    return (F.when(n <= 1, labels[3])
             .when(span <= F.lit(cuts[0]) * gaps, labels[0])
             .when(span <= F.lit(cuts[1]) * gaps, labels[1])
             .otherwise(labels[2]))


def value_counts(df: DataFrame, col: str, out: str = "n_clients") -> DataFrame:
    """A2/O3: frequency of each non-null value, most frequent first."""
    return (df.filter(F.col(col).isNotNull()).groupBy(col)
              .agg(F.count(F.lit(1)).alias(out))
              .orderBy(F.col(out).desc(), F.col(col).asc()))


def client_profile(clients: DataFrame, id_col: str = "client_id_seq",
                   approx: bool = False) -> DataFrame:
    """Shape, distinct clients, GMV mean/median, mean purchase count.

    Money statistics are computed on integer cents so the mean and median are
    exact; the median is a distributed radix select (``approx`` for one pass).
    """
    # The three needed columns are materialised once; the median's radix passes
    # and the summary aggregate both read that copy.
    checkpoint_root(clients.sparkSession)
    base = clients.select(F.col(id_col).alias("_id"),
                          (F.col("gmv_total") * 100).cast("long").alias("c"),
                          F.col("qtd_compras").alias("q")).checkpoint(eager=True)
    med = median(base, "c", approx=approx, materialise=False)
    agg = base.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_distinct("_id").alias("n_clients"),
        (F.sum("c").cast("double") / F.count("c") / 100).alias("gmv_total_mean"),
        (F.sum("q").cast("double") / F.count("q")).alias("qtd_compras_mean"),
    )
    return agg.select(
        "n_rows", F.lit(len(clients.columns)).alias("n_columns"),
        F.lit(",".join(clients.columns)).alias("columns"), "n_clients",
        "gmv_total_mean",
        F.lit(None if med is None else med / 100.0).cast("double").alias("gmv_total_median"),
        "qtd_compras_mean")


def assign_ids(keys: DataFrame, key: str = "client_id", existing: DataFrame | None = None,
               id_col: str = "client_id_seq", n_partitions: int | None = None) -> DataFrame:
    """Stable sequential ids.  Known keys keep their id from ``existing``;
    new keys get ``max(existing id) + rank`` in key order.

    Ranks are computed without a global single-task window: keys are
    range-partitioned, numbered within each partition, and shifted by the sizes
    of the preceding partitions (one small row per partition).
    """
    new = keys.select(key).filter(F.col(key).isNotNull()).distinct()
    base = 0
    if existing is not None:
        new = new.join(existing.select(key), key, "left_anti")
        base = existing.agg(F.max(id_col)).first()[0] or 0
    n = n_partitions or int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    checkpoint_root(keys.sparkSession)
    # Checkpointed so the partition ids read by both branches below are the same.
    ranged = (new.repartitionByRange(n, key).withColumn("_pid", F.spark_partition_id())
                 .checkpoint(eager=True))
    ranked = ranged.withColumn("_r", F.row_number().over(Window.partitionBy("_pid").orderBy(key)))
    sizes = ranked.groupBy("_pid").agg(F.count(F.lit(1)).alias("_size"))
    offsets = sizes.select("_pid", (F.coalesce(F.sum("_size").over(
        Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).alias("_off"))
    ids = ranked.join(broadcast_if_small(offsets), "_pid").select(
        key, (F.lit(base) + F.col("_off") + F.col("_r")).cast("long").alias(id_col))
    if existing is not None:
        ids = existing.select(key, id_col).unionByName(ids)
    return ids
