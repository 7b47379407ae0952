"""Exact model evaluation over any number of scored rows.

* :func:`auc` – area under the ROC curve by ranks, ties at half weight.  Rows with one score are
  collapsed to their label counts first (partial aggregates), then a running count of negatives over range-partitioned scores gives
  each score's rank; no row list is gathered.  All sums are whole numbers (decimals, so they cannot overflow); one division
  at the end.
* :func:`confusion` – actual x predicted counts of a multi-class model.
* :func:`class_report` – precision, recall and F1 per class from the confusion table.

A null score or label takes no part.  Without positives or without negatives the area is null.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlake.operators.sequence import with_running_sum


def auc(scored: DataFrame, score: str = "score", label: str = "label", by: str = "model") -> DataFrame:
    """``by``, n, n_positive, auc: one row for each value of ``by`` (label 1 against all others)."""
    rows = scored.where(F.col(score).isNotNull() & F.col(label).isNotNull())
    counts = rows.groupBy(by, F.col(score).alias("_score")).agg(
        F.sum((F.col(label) == 1).cast("long")).alias("_pos"), F.sum((F.col(label) != 1).cast("long")).alias("_neg"))
    run = with_running_sum(counts, by, ["_score"], F.col("_neg"), "_upto")
    big = lambda c: F.col(c).cast("decimal(19,0)")
    # Twice the pairs that are ordered right: negatives below count 2, those of the same score 1.
    won = F.sum(big("_pos") * (big("_upto") * 2 - big("_neg")))
    total = run.groupBy(by).agg(F.sum("_pos").alias("n_positive"), F.sum("_neg").alias("_n"), won.alias("_won"))
    pairs = big("n_positive") * big("_n") * 2
    area = F.when(pairs > 0, F.col("_won").cast("double") / pairs.cast("double"))
    return total.select(by, (F.col("n_positive") + F.col("_n")).alias("n"), "n_positive", area.alias("auc"))


def confusion(predicted: DataFrame, actual: str, guess: str) -> DataFrame:
    """actual, predicted, n; a null class is a class of its own (null)."""
    return predicted.groupBy(F.col(actual).alias("actual"), F.col(guess).alias("predicted")).agg(F.count(F.lit(1)).alias("n"))


def class_report(table: DataFrame) -> DataFrame:
    """class, n_actual, n_predicted, n_right, precision, recall, f1 of every class that occurs on either side."""
    sides = table.select(F.explode(F.array(
        F.struct(F.col("actual").alias("class"), F.col("n").alias("a"), F.lit(0).cast("long").alias("p"),
                 F.when(F.col("actual").eqNullSafe(F.col("predicted")), F.col("n")).otherwise(0).alias("r")),
        F.struct(F.col("predicted").alias("class"), F.lit(0).cast("long").alias("a"), F.col("n").alias("p"), F.lit(0).cast("long").alias("r")),
    )).alias("s")).select("s.*")
    out = sides.groupBy("class").agg(F.sum("a").alias("n_actual"), F.sum("p").alias("n_predicted"), F.sum("r").alias("n_right"))
    share = lambda of: F.when(F.col(of) > 0, F.col("n_right").cast("double") / F.col(of))
    f1 = F.col("n_right").cast("double") * 2 / (F.col("n_actual") + F.col("n_predicted"))
    return out.select("class", "n_actual", "n_predicted", "n_right", share("n_predicted").alias("precision"), share("n_actual").alias("recall"), f1.alias("f1"))
