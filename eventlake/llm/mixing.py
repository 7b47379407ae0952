"""Mixing sources to target weights by capped water-filling.

The budget is shared among sources by weight; a source whose share exceeds ``max_epochs``
times its size is clamped there, and what it leaves is shared again among the free ones, in
proportion to their weights, until none exceeds its cap.  Each source is then read whole as
often as fits its target, and once more in part: documents follow in a seeded hash order
until the target is met, the last one in part.  So a source's taken words differ from its
target by less than one word.

The order of a hot source is never sorted in one task: documents fall into hash buckets,
bucket sums locate the bucket in which the target is met, and only that bucket's documents
are ordered.  Equal seeds give equal mixes.

Edge cases: a null text has no words and is never taken; a null source is a source of its
own, last in order; repeated rows share their hash and are told apart by size, and equal
ones by an arbitrary but counted position; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from eventlake.llm.common import SPACE, WORD, cut, table, temporary, word_count

WEIGHTS, BUDGET, MAX_EPOCHS, BUCKETS = (5.0, 2.0, 1.0), 1.5, 2.0, 4096


def water_fill(sources: DataFrame, budget: float, max_epochs: float) -> DataFrame:
    """``sources(source, source_size, weight)`` with ``target``.

    Each round clamps every free source whose share exceeds its cap; only three sums per
    round reach the driver."""
    cap = F.col("source_size") * F.lit(max_epochs)
    level = 0.0
    while True:
        clamped = F.col("weight") * F.lit(level) >= cap
        used, weight = sources.agg(F.sum(F.when(clamped, cap)), F.sum(F.when(~clamped, F.col("weight")))).first()
        left = budget - (used or 0.0)
        new = left / weight if weight else level
        if not weight or new <= level:
            return sources.withColumn("target", F.when(clamped, cap).otherwise(F.col("weight") * F.lit(level)).cast("double"))
        level = new


def weigh(sources: DataFrame, weights: tuple[float, ...]) -> DataFrame:
    """Weights repeat along the sources in code-point order, null last.

    Sources are ranked in ranges, each shifted by the sizes of those before it."""
    spark = sources.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = [F.col("source").isNull(), F.col("source")]
    ranged = cut(spark, sources.repartitionByRange(n, *ordered).withColumn("part", F.spark_partition_id()), "mix-sources")
    before = (ranged.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
              .select("part", F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before")))
    rank = F.col("before") + F.row_number().over(Window.partitionBy("part").orderBy(*ordered)) - 1
    listed = F.array(*(F.lit(float(w)) for w in weights))
    return ranged.join(before, "part").select("source", "source_size", F.element_at(listed, (rank % len(weights) + 1).cast("int")).alias("weight"))


def bucket_plan(sized: DataFrame, weights: tuple[float, ...], budget: float, max_epochs: float) -> DataFrame:
    """source, bucket, words, source_size, target, whole (passes) and ``left``: what is left of the partial
    pass at the start of each bucket of ``sized(source, bucket, size)``: all of it, some or none."""
    spark = sized.sparkSession
    sums = cut(spark, sized.groupBy("source", "bucket").agg(F.sum("size").alias("words")), "mix-buckets")
    sources = sums.groupBy("source").agg(F.sum("words").alias("source_size"))
    total = sums.agg(F.sum("words")).first()[0] or 0
    targets = water_fill(cut(spark, weigh(sources, weights), "mix-weights"), budget * total, max_epochs)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    targets = targets.withColumn("whole", whole).withColumn(
        "part", F.greatest(F.lit(0), F.round(F.col("target")).cast("long") - F.col("whole") * F.col("source_size")))
    running = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    plan = (sums.withColumn("before", F.coalesce(F.sum("words").over(running), F.lit(0)))
            .alias("s").join(targets.alias("t"), F.expr("s.source <=> t.source")).drop(F.col("t.source")))
    return plan.withColumn("left", F.greatest(F.lit(0), F.least("words", F.col("part") - F.col("before")))).drop("before", "part", "weight")


def decided(rows: DataFrame, plan: DataFrame, prefix: str, ties: list[str]) -> DataFrame:
    """``rows`` with the plan's columns and ``taken``; those a row has (source, bucket, key, size) are named with ``prefix``.
    ``ties`` order rows of one key and size.

    Only the one bucket of a source that the partial pass ends in is ordered."""
    own = {c: F.col(prefix + c) for c in ("source", "bucket", "key", "size")}
    named = plan.select(*[F.col(c).alias("__plan_" + c) for c in plan.columns])
    joined = rows.join(named, own["source"].eqNullSafe(F.col("__plan_source")) & (own["bucket"] == F.col("__plan_bucket")))
    left = F.col("__plan_left")
    partial = left.between(1, F.col("__plan_words") - 1)
    order = Window.partitionBy("__plan_source", "__plan_bucket").orderBy(own["key"], own["size"], *ties).rowsBetween(Window.unboundedPreceding, -1)
    split = joined.where(partial).withColumn("__plan_before", F.coalesce(F.sum(own["size"]).over(order), F.lit(0))).withColumn(
        "__plan_extra", F.greatest(F.lit(0), F.least(own["size"], left - F.col("__plan_before")))).drop("__plan_before")
    plain = joined.where(~partial).withColumn("__plan_extra", F.when(left > 0, own["size"]).otherwise(0).cast("long"))
    return plain.unionByName(split).withColumn(prefix + "taken", F.col("__plan_whole") * own["size"] + F.col("__plan_extra"))


def mix(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text",
        weights: tuple[float, ...] = WEIGHTS, budget: float = BUDGET, max_epochs: float = MAX_EPOCHS,
        seed: int = 17, buckets: int = BUCKETS) -> DataFrame:
    """Per document row: (id, source, size, source_size, target, taken)."""
    spark = docs.sparkSession
    key = F.xxhash64(F.lit(seed), F.col(id_col).cast("string"))
    sized = cut(spark, docs.select(F.col(id_col).alias("id"), F.col(source_col).cast("string").alias("source"),
                                   word_count(F.col(text_col)).alias("size"), key.alias("key"))
                .withColumn("bucket", F.pmod("key", F.lit(buckets))), "mix-sizes")
    plan = cut(spark, bucket_plan(sized, weights, budget, max_epochs), "mix-plan")
    return decided(sized, plan, "", ["id"]).select(F.col("id").alias(id_col), F.col("source").alias(source_col), "size",
                                       F.col("__plan_source_size").alias("source_size"), F.col("__plan_target").alias("target"), "taken")


def mixed_rows(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", length_col: str | None = "n_chars",
               weights: tuple[float, ...] = WEIGHTS, budget: float = BUDGET, max_epochs: float = MAX_EPOCHS,
               seed: int = 17, buckets: int = BUCKETS) -> DataFrame:
    """The rows of ``docs`` as often as the mix takes them, columns unchanged; a fractional
    repetition is a row with the text's first words, whose length column follows.

    Rows are dealt by a hash of id and text.  Texts are neither copied nor shuffled, but for the one bucket of
    each source that the partial pass ends in: every other row is decided by the small plan alone."""
    spark = docs.sparkSession
    key = F.xxhash64(F.lit(seed), F.col(id_col).cast("string"), F.col(text_col))
    rows = docs.withColumns({"__source": F.col(source_col).cast("string"), "__size": word_count(F.col(text_col)), "__key": key,
                             "__bucket": F.pmod(key, F.lit(buckets))})
    with temporary(spark) as keep:
        sized = cut(spark, rows.select(*[F.col("__" + c).alias(c) for c in ("source", "size", "bucket")]), "mix-sizes")
        plan = keep(bucket_plan(sized, weights, budget, max_epochs), "mix-plan")
    taken = decided(rows, plan, "__", [id_col, text_col]).where("__taken > 0")
    rest = F.col("__taken") % F.col("__size")
    repeats = F.concat(F.array_repeat(F.col("__size"), (F.col("__taken") / F.col("__size")).cast("int")), F.when(rest > 0, F.array(rest)).otherwise(F.array().cast("array<bigint>")))
    rows = taken.withColumn("__words", F.explode(repeats))
    first = F.array_join(F.slice(F.regexp_extract_all(text_col, F.lit(rf"[{SPACE}]*+{WORD}"), F.lit(0)), 1, F.col("__words").cast("int")), "")
    if length_col in docs.columns:
        kind = docs.schema[length_col].dataType
        rows = rows.withColumn(length_col, F.when(F.col("__words") < F.col("__size"), F.length(first).cast(kind)).otherwise(F.col(length_col)))
    rows = rows.withColumn(text_col, F.when(F.col("__words") < F.col("__size"), first).otherwise(F.col(text_col)))
    return rows.select(docs.columns)


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words the mix takes of every document."""
    return mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")
