"""Quality rules with risk-controlled thresholds.

Each rule compares one statistic of a text with a cutoff.  A labelled holdout decides which
cutoffs may be used: per stratum, a cutoff is certified when the exact binomial test rejects
"at least ``epsilon / rules`` of the good documents would be rejected" at level ``delta``
divided by the number of tests (Bonferroni over strata, rules and cutoffs).  Among certified
cutoffs of a rule the one with the best balance of bad to good rejections is taken; a rule
without one is off in that stratum.  So with probability ``1 - delta`` every stratum loses
less than ``epsilon`` of its good documents to the learned rules.

Edge cases: a null or empty text has no words, all counts 0, and fails the base rule; a null
stratum counts as the empty one; repeated rows are judged each; labels of a repeated id
count once, the smaller value; unlabelled tables leave only the base rule.
"""

from __future__ import annotations

from math import exp, lgamma, log, log1p

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from eventlake.llm.common import bounded_batches, cut, table

EPSILON, DELTA = 0.05, 0.05
#: A good document lost weighs this many bad ones caught when cutoffs are compared.
GOOD_WEIGHT = 5
#: Rule: (statistic, side on which it rejects, candidate cutoffs fixed before seeing labels).
RULES = {
    "symbols": ("try_divide(n_symbols, n_words)", ">", [0.02, 0.05, 0.1, 0.2, 0.4, 0.8, 1.6]),
    "dup_lines": ("try_divide(n_dup_lines, n_lines)", ">", [0.05, 0.1, 0.2, 0.3, 0.5, 0.7]),
    "repeats": ("try_divide(n_repeat_words, n_words)", ">", [0.02, 0.05, 0.1, 0.2, 0.3, 0.4]),
    "long_words": ("try_divide(word_chars, n_words)", ">", [7.0, 8.0, 9.0, 10.0, 12.0, 15.0]),
    "short_words": ("try_divide(word_chars, n_words)", "<", [2.0, 2.5, 3.0, 3.5, 4.0]),
    "few_kinds": ("try_divide(n_kinds, n_words)", "<", [0.02, 0.05, 0.1, 0.2, 0.3]),
}
_SPACES = b" \t\n\r\x0b\x0c"
_SYMBOLS = b"#*$%&|<>"
_CONTINUATION = bytes(range(0x80, 0xC0))
_STATS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_kinds"]


def text_stats(raw: bytes | None) -> tuple[int, ...]:
    """The counts named in ``_STATS`` for one whole UTF-8 text."""
    raw = raw or b""
    words = raw.split()  # bytes.split() separates at exactly the six ASCII white-space characters
    seen: dict[bytes, int] = {}
    ids = np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, len(words))
    repeated = 0
    if len(words) > 2:
        kinds = len(seen)
        if kinds < 1 << 21:
            window = (ids[:-2] * kinds + ids[1:-1]) * kinds + ids[2:]
        else:
            pair = np.unique(ids[:-1] * kinds + ids[1:], return_inverse=True)[1]
            window = pair[:-1] * kinds + ids[2:]
        _, inverse, count = np.unique(window, return_inverse=True, return_counts=True)
        twice = count[inverse] > 1
        inside = np.zeros(len(words), bool)
        for shift in range(3):
            inside[shift:len(words) - 2 + shift] |= twice
        repeated = int(inside.sum())
    lines = [x for x in raw.split(b"\n") if x.strip()]
    solid = raw.translate(None, _SPACES)
    return (len(words), len(solid.translate(None, _CONTINUATION)), len(raw) - len(raw.translate(None, _SYMBOLS)),
            len(lines) - len(set(lines)), repeated, len(lines), len(seen))


def scan(docs: DataFrame, id_col: str, text_col: str, stratum_col: str) -> DataFrame:
    def run(batches):
        for batch in batches:
            rows = [text_stats(x) for x in batch.column(1).cast(pa.binary()).to_pylist()]
            columns = [pa.array(c, pa.int64()) for c in zip(*rows)] if rows else [pa.array([], pa.int64())] * len(_STATS)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), *columns], ["id", "stratum", *_STATS])

    picked = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"),
                         F.coalesce(F.col(stratum_col).cast("string"), F.lit("")).alias("stratum"))
    kind = picked.schema["id"].dataType.simpleString()
    return picked.mapInArrow(run, f"id {kind}, stratum string, " + ", ".join(f"{c} bigint" for c in _STATS))


def binomial_tail(x: int, n: int, p: float) -> float:
    """P(Binomial(n, p) <= x), exactly summed."""
    if n <= 0:
        return 1.0
    base = lgamma(n + 1)
    return min(1.0, sum(exp(base - lgamma(i + 1) - lgamma(n - i + 1) + i * log(p) + (n - i) * log1p(-p))
                        for i in range(x + 1)))


def choose_cutoffs(counted: DataFrame, epsilon: float, delta: float, rules: dict = RULES) -> DataFrame:
    """(stratum, one cutoff column per rule; null: the rule is off) from the holdout counts."""
    tests = sum(len(r[2]) for r in rules.values())

    def run(batches):
        for pdf in batches:
            out = []
            for _, row in pdf.iterrows():
                best: dict = {"stratum": row["stratum"]}
                for name, (_, side, cutoffs) in rules.items():
                    top = (0, 0.0, None)
                    for i, at in enumerate(cutoffs):
                        good, bad = int(row[f"{name}_{i}_good"]), int(row[f"{name}_{i}_bad"])
                        gain = bad - GOOD_WEIGHT * good
                        lenient = at if side == ">" else -at
                        if gain > 0 and (gain, lenient) > top[:2] and binomial_tail(
                                good, int(row["n_good"]), epsilon / len(rules)) <= delta / (tests * int(row["strata"])):
                            top = (gain, lenient, at)
                    best[name] = top[2]
                out.append(best)
            yield pd.DataFrame(out, columns=["stratum", *rules]).astype({r: "float64" for r in rules})

    return counted.mapInPandas(run, "stratum string, " + ", ".join(f"{r} double" for r in rules))


def quality_rules(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  stratum_col: str = "lang", label_col: str = "quality", epsilon: float = EPSILON,
                  delta: float = DELTA, rules: dict = RULES) -> DataFrame:
    """Statistics, ``base_failed``, the learned rule's verdict and ``kept`` per document row."""
    spark = docs.sparkSession
    bounded_batches(spark)
    stats = cut(spark, scan(docs, id_col, text_col, stratum_col), "quality-stats")
    marks = (labels.where(F.col(label_col).isNotNull()).groupBy(F.col(id_col).alias("id"))
             .agg(F.min(label_col).alias("quality")))
    rejects = {r: F.expr(f"{stat} {side} `cut_{r}`") for r, (stat, side, _) in rules.items()}
    counts = [F.sum((F.expr(f"{stat} {side} {at!r}D") & (F.col("quality") == value)).cast("long")).alias(f"{r}_{i}_{name}")
              for r, (stat, side, cutoffs) in rules.items() for i, at in enumerate(cutoffs)
              for name, value in (("good", 1), ("bad", 0))]
    holdout = (stats.join(marks, "id").groupBy("stratum")
               .agg(F.sum((F.col("quality") == 1).cast("long")).alias("n_good"), *counts).na.fill(0))
    holdout = cut(spark, holdout, "quality-holdout")
    chosen = cut(spark, choose_cutoffs(holdout.withColumn("strata", F.lit(holdout.count())), epsilon, delta, rules), "quality-cutoffs")
    judged = stats.join(chosen.select(F.col("stratum"), *(F.col(r).alias(f"cut_{r}") for r in rules)), "stratum", "left")
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    why = F.coalesce(*(F.when(rejects[r], F.lit(r)) for r in rules))
    return judged.select(F.col("id").alias(id_col), *_STATS[:5], failed.alias("base_failed"),
                         (~failed & why.isNull()).alias("kept"), F.when(failed, "base").otherwise(why).alias("rejected_by"))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics and verdict of every document."""
    return quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
