"""Per-key sequence operators that stay balanced when one key is huge.

A plain ``Window.partitionBy(key)`` sends every row of a key to one task; if one
client holds a third of all purchases, that task does a third of the job.  Here
the rows are range-partitioned on ``(key, order...)`` first, so a hot key is
split across many partitions.  Each (partition, key) run is processed locally
and the run boundaries are repaired with a small per-run table (one row per
partition and key), never with all rows of a key in one place.

* :func:`with_next` – ``lead`` of some columns within each key.
* :func:`with_running_sum` – inclusive running sum within each key.

A null key is a key like any other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventlake.session import drop_folder, scratch_dir, staged


def _parts(df: DataFrame, n: int | None) -> int:
    if n:
        return n
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))


def _ranged(df: DataFrame, key: str, order: list[str], n: int | None) -> DataFrame:
    """Range-partition on (key, order), tag each row with its partition id, and
    write the result to the shared checkpoint folder.

    That write matters for correctness: range bounds come from a sample
    seeded by the RDD id, so two evaluations of the same plan (the two branches
    that read a run and its boundary) could split differently.  A written table
    fixes one assignment and also survives executor loss.  The input is written
    too, until then: the sample and its extra passes over uneven partitions would
    otherwise evaluate all that ``df`` is made of again.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, "sequence-input")
    df.write.parquet(path)
    rows = spark.read.schema(df.schema).parquet(path)
    out = staged(rows.repartitionByRange(_parts(df, n), key, *order).withColumn("_pid", F.spark_partition_id()), "sequence")
    drop_folder(spark, path)
    return out


def with_next(df: DataFrame, key: str, order: list[str], cols: list[str],
              prefix: str = "next_", n_partitions: int | None = None) -> DataFrame:
    """Add ``prefix + c`` = value of ``c`` on the key's next row under ``order``
    (``order`` must be total within a key).  Null on a key's last row."""
    x = _ranged(df, key, order, n_partitions)
    w = Window.partitionBy("_pid", key).orderBy(*order)
    run = Window.partitionBy("_pid", key)
    x = x.select("*", *[F.lead(c).over(w).alias("_n_" + c) for c in cols],
                 F.row_number().over(w).alias("_pos"), F.count(F.lit(1)).over(run).alias("_len"))
    # A run's last row continues with the first row of the key's next run.
    wk = Window.partitionBy(key).orderBy("_pid")
    bridge = (x.filter(F.col("_pos") == 1)
               .select("_pid", key, *[F.lead(c).over(wk).alias("_b_" + c) for c in cols]))
    out = x.join(bridge.withColumnsRenamed({"_pid": "_bp", key: "_bk"}),
                 (F.col("_pid") == F.col("_bp")) & F.col(key).eqNullSafe(F.col("_bk")), "left")
    last = F.col("_pos") == F.col("_len")
    return out.select(
        *[c for c in df.columns],
        *[F.when(last, F.col("_b_" + c)).otherwise(F.col("_n_" + c)).alias(prefix + c)
          for c in cols])


def with_running_sum(df: DataFrame, key: str, order: list[str], value: Column | str,
                     out: str, n_partitions: int | None = None) -> DataFrame:
    """Add ``out`` = sum of ``value`` over the key's rows up to and including this one."""
    v = F.col(value) if isinstance(value, str) else value
    x = _ranged(df.withColumn("_v", v), key, order, n_partitions)
    w = (Window.partitionBy("_pid", key).orderBy(*order)
               .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    x = x.withColumn("_local", F.sum("_v").over(w))
    totals = x.groupBy("_pid", key).agg(F.sum("_v").alias("_tot"))
    wk = (Window.partitionBy(key).orderBy("_pid")
                .rowsBetween(Window.unboundedPreceding, -1))
    offsets = totals.select("_pid", key,
                            F.coalesce(F.sum("_tot").over(wk), F.lit(0)).alias("_off"))
    return (x.join(offsets.withColumnsRenamed({"_pid": "_bp", key: "_bk"}),
                   (F.col("_pid") == F.col("_bp")) & F.col(key).eqNullSafe(F.col("_bk")))
              .drop("_bp", "_bk").withColumn(out, F.col("_local") + F.col("_off"))
              .drop("_pid", "_v", "_local", "_off"))
