"""From documents to packed training sequences.

Each stage takes (spark, docs, sf_dir) and returns the rows of its successor; all but the
last return the columns of documents.
"""

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from eventlake.llm.common import cut, shared_path, table
from eventlake.llm.mixing import mixed_rows
from eventlake.llm.near_dedup import near_duplicates
from eventlake.llm.packing import pack
from eventlake.llm.quality_classifier import classify
from eventlake.llm.secrets import redact


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject."""
    judged = classify(docs, table(spark, sf_dir, "labels"), keep=tuple(docs.columns))
    return judged.where("predicted = 1").select(*(F.col(f"__keep_{c}").alias(c) for c in docs.columns))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate component (shingles of five words, similarity 0.8).

    Rows without an id stay; of several rows with one id that is kept, the one with the
    smallest text stays."""
    kept = cut(spark, near_duplicates(docs).where("kept").groupBy("doc_id").agg(F.count(F.lit(1)).alias("__rows")), "pipeline-kept")
    once = docs.join(kept.where("__rows = 1 and doc_id is not null").select("doc_id"), "doc_id", "left_semi").unionByName(docs.where("doc_id is null"))
    repeated = kept.where("__rows > 1 and doc_id is not null").select("doc_id")
    if not repeated.limit(1).count():
        return once.select(docs.columns)
    first = Window.partitionBy("doc_id").orderBy("text", *(c for c in docs.columns if c not in ("doc_id", "text")))
    picked = docs.join(repeated, "doc_id", "left_semi").withColumn("__first", F.row_number().over(first)).where("__first = 1").drop("__first")
    return once.unionByName(picked).select(docs.columns)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their secrets masked and ``n_chars`` brought up to date."""
    masked = redact(docs)
    return masked.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else masked


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the target weights of their sources take them."""
    return mixed_rows(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of every document's token pieces in the training sequences."""
    return pack(docs)


STAGES = [("quality", quality), ("near_dedup", near_dedup), ("secrets", secrets), ("mixing", mixing), ("packing", packing)]

#: Models, tokens and packing have no counterpart in DuckDB SQL; tests/llm hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on documents; each stage's rows are written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = shared_path(spark, f"stage-{name}")
        out = stage(spark, docs, sf_dir)
        out.write.parquet(path)
        docs = spark.read.schema(out.schema).parquet(path)
    return docs
