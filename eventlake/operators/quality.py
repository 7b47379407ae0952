"""Output validation (G4, with S9 readiness in ``sources.feeds``).

:func:`table_checks` gives, per table: row count, rows with a null key and the
number of keys that occur more than once.  One aggregation per table (keys
grouped with map-side partial counts), results unioned into one small frame.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def table_check(name: str, df: DataFrame, keys: list[str]) -> DataFrame:
    any_null = F.lit(False)
    for k in keys:
        any_null = any_null | F.col(k).isNull()
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    return per_key.agg(
        F.sum("_n").cast("long").alias("n_rows"),
        F.sum(F.when(any_null, F.col("_n")).otherwise(0)).cast("long").alias("null_keys"),
        F.count(F.when(~any_null & (F.col("_n") > 1), 1)).cast("long").alias("dup_keys"),
    ).select(F.lit(name).alias("name"), F.lit(",".join(keys)).alias("keys"), "*")


def table_checks(tables: dict[str, tuple[DataFrame, list[str]]]) -> DataFrame:
    frames = [table_check(n, df, keys) for n, (df, keys) in tables.items()]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out
