"""Next origin-destination route (definitions ours; the original script is not public).

* :func:`top_routes` (O2/R2): the ``n`` most frequent routes (ties: route text).
* :func:`restrict_routes` (R2): routes outside the top ``n`` -> ``OUTROS``.
* :func:`next_route_targets` (R1): per purchase, the route of the client's next
  purchase (balanced per-client sequence, see ``operators/sequence.py``).
* :func:`recommend_routes` (R3): transition counts route -> next route; each
  client's last route gets its ``k`` most frequent successors; clients whose last
  route has none fall back to the ``k`` most frequent routes overall.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlake.operators.clients import route_col
from eventlake.operators.sequence import with_next
from eventlake.session import staged

OTHER = "OUTROS"
ORDER = ["purchased_at", "purchase_id"]


def with_route(purchases: DataFrame) -> DataFrame:
    return purchases.withColumn("route", route_col())


def top_routes(purchases: DataFrame, n: int = 20) -> DataFrame:
    return _most_frequent(with_route(purchases), n)


def _most_frequent(routed: DataFrame, n: int) -> DataFrame:
    r = routed.filter(F.col("route").isNotNull())
    return (r.groupBy("route").agg(F.count(F.lit(1)).alias("n_purchases"))
             .orderBy(F.col("n_purchases").desc(), F.col("route").asc()).limit(n))


def restrict_routes(df: DataFrame, col: str, top: DataFrame) -> DataFrame:
    """Replace values of ``col`` outside ``top.route`` by ``OUTROS`` (nulls stay null).
    ``top`` has at most ``n`` rows (a parameter), so it is broadcast."""
    keep = F.broadcast(top.select(F.col("route").alias("_keep")))
    j = df.join(keep, df[col] == keep["_keep"], "left")
    return j.withColumn(col, F.when(F.col(col).isNull(), F.lit(None))
                        .when(F.col("_keep").isNull(), F.lit(OTHER))
                        .otherwise(F.col(col))).drop("_keep")


def next_route_targets(purchases: DataFrame, top_n: int | None = 20,
                       n_partitions: int | None = None) -> DataFrame:
    p = with_route(purchases).select("client_id", "purchase_id", "purchased_at", "route")
    x = with_next(p, "client_id", ORDER, ["route"], n_partitions=n_partitions)
    x = x.filter(F.col("route").isNotNull() & F.col("next_route").isNotNull())
    if top_n:
        top = top_routes(purchases, top_n)
        x = restrict_routes(restrict_routes(x, "route", top), "next_route", top)
    return x.select("client_id", "purchase_id", "route", "next_route")


def recommend_routes(purchases: DataFrame, k: int = 3,
                     n_partitions: int | None = None) -> DataFrame:
    p = with_route(purchases).select("client_id", "purchase_id", "purchased_at", "route")
    # Written once: transitions, route frequencies and each client's last route are read from it.
    p = staged(with_next(p, "client_id", ORDER, ["purchase_id", "route"], n_partitions=n_partitions), "route-pairs")
    pairs = p.filter(F.col("route").isNotNull() & F.col("next_route").isNotNull())
    trans = pairs.groupBy("route", "next_route").agg(F.count(F.lit(1)).alias("n"))
    w_rank = [F.col("n").desc(), F.col("next_route").asc()]
    from pyspark.sql import Window
    ranked = trans.withColumn("rank", F.row_number().over(
        Window.partitionBy("route").orderBy(*w_rank))).filter(F.col("rank") <= k)
    per_route = ranked.groupBy("route").agg(F.array_sort(F.collect_list(
        F.struct("rank", F.col("next_route").alias("rec"), F.col("n").alias("score")))).alias("recs"))
    # Global fallback: k rows, a literal array.
    glob = _most_frequent(p, k).collect()
    fallback = F.array(*[F.struct(F.lit(i + 1).alias("rank"), F.lit(r["route"]).alias("rec"),
                                  F.lit(r["n_purchases"]).cast("long").alias("score"))
                         for i, r in enumerate(glob)]) if glob else F.array()
    last = p.filter(F.col("next_purchase_id").isNull())
    j = last.select("client_id", F.col("route").alias("last_route")) \
        .join(per_route, F.col("last_route") == per_route["route"], "left")
    recs = F.coalesce(F.col("recs"), fallback)
    out = j.select("client_id", "last_route",
                   F.when(F.col("recs").isNull(), F.lit("global")).otherwise(F.lit("transition"))
                    .alias("basis"), F.explode(recs).alias("r"))
    return out.select("client_id", "last_route", "basis", F.col("r.rank").alias("rank"),
                      F.col("r.rec").alias("recommended_route"), F.col("r.score").alias("score"))
