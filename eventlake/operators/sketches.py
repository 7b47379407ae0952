"""Mergeable sketches of purchases (A3, A6 at scale): distinct clients and money quantiles per day.

:func:`daily_sketches` makes one row per day: a HyperLogLog sketch of the clients and a KLL
sketch of the purchase values.  A day is sketched once and stored; any span of days is answered
by merging stored rows (:func:`merged`), without reading a purchase again.

Bounds: a distinct estimate lies within ``distinct_bound`` of the truth (three standard errors of
1.04 / sqrt(2 ** k)); the rank of a quantile estimate lies within ``RANK_BOUND`` of the rank asked for.  Exact
counterparts are ``count_distinct`` and ``stats.median``.  Days without a date take no part.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LOG_REGISTERS, KLL_K = 14, 400
#: Three times the normalised rank error of a KLL sketch of this size, about 2.446 / k ** 0.9433.
RANK_BOUND = 3 * 2.446 / KLL_K ** 0.9433


def distinct_bound(log_registers: int = LOG_REGISTERS) -> float:
    return 3 * 1.04 / 2 ** (log_registers / 2)


def daily_sketches(purchases: DataFrame, log_registers: int = LOG_REGISTERS, k: int = KLL_K) -> DataFrame:
    """day, n, clients (HLL), cents (KLL): partial sketches per task, merged per day."""
    return (purchases.withColumn("day", F.to_date("purchased_at")).where("day is not null").groupBy("day")
            .agg(F.count(F.lit(1)).alias("n"), F.hll_sketch_agg("client_id", log_registers).alias("clients"),
                 F.kll_sketch_agg_bigint((F.col("gmv") * 100).cast("long"), k).alias("cents")))


def merged(sketches: DataFrame, by, k: int = KLL_K) -> DataFrame:
    """``by`` (a column of the span, such as a month), n, clients, cents."""
    return sketches.groupBy(by).agg(F.sum("n").alias("n"), F.hll_union_agg("clients").alias("clients"),
                                    F.kll_merge_agg_bigint("cents", k).alias("cents"))


def estimates(spans: DataFrame, share: float = 0.5) -> DataFrame:
    """The spans' columns, n, n_clients and the ``share`` quantile in cents."""
    keys = [c for c in spans.columns if c not in ("n", "clients", "cents")]
    return spans.select(*keys, "n", F.hll_sketch_estimate("clients").alias("n_clients"),
                        F.kll_sketch_get_quantile_bigint("cents", F.lit(share)).alias("quantile_cents"))
