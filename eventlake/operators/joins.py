"""Join helpers: size-checked broadcast and first row by order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Broadcast only below this optimizer size estimate (bytes).
BROADCAST_LIMIT = 64 * 1024 * 1024


def estimated_bytes(df: DataFrame) -> int | None:
    """Catalyst's size estimate of a plan (no job is run)."""
    try:
        return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes().toString())
    except Exception:  # pragma: no cover - e.g. Spark Connect
        return None


def broadcast_if_small(df: DataFrame, limit: int = BROADCAST_LIMIT) -> DataFrame:
    """Hint a broadcast only when the optimizer proves the side is under ``limit``;
    otherwise leave the choice (sort-merge / shuffle-hash, AQE) to Spark."""
    size = estimated_bytes(df)
    if size is not None and size <= limit:
        return F.broadcast(df)
    return df


def first_by_order(df: DataFrame, partition: list[str], order: list[Column]) -> DataFrame:
    """One row per ``partition`` key: the first under a total ``order``.

    ``row_number() = 1`` lets Catalyst insert a partial ``WindowGroupLimit``
    before the shuffle, so a hot key sends one row per map task, not all rows.
    """
    from pyspark.sql import Window
    w = Window.partitionBy(*partition).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")
