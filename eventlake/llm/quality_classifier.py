"""Quality classifier from supervised subword embeddings.

A word's vector is the mean of the learned vectors of the hashed word and its hashed
character n-grams; a word that repeats the one before it adds a vector of its own.  A
document is the average of its words' vectors, put through a softmax layer.  Vectors and
layer are trained together by numpy stochastic gradient descent on a bounded sample of
labelled rows (of the ``sample`` ids with the smallest hashes, ``sample`` rows at most), in one task.  Scoring reads
every whole text: because the average is linear, each bucket's vector is first reduced to
its difference in logits, and a word costs one dictionary lookup.

Only rows for which crc32 of the id's text modulo ``folds`` differs from ``held_out`` teach
the model; labels, language, source and id are never features.

Edge cases: a null or empty text scores the learned bias; a repeated id takes its smallest
label; without labels of both classes every score is 0.5 or the bias alone; a null id is
not held out and not learned from.
"""

from __future__ import annotations

import operator
from collections import Counter
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from eventlake.llm.common import bounded_batches, cut, table

BUCKETS, DIM, EPOCHS, RATE, SAMPLE, SEED = 1 << 17, 8, 8, 0.5, 6000, 11
GRAMS = (3, 5)
CACHE_WORDS = 400_000
#: Bytes from which on a word is counted by blocks and not cached: a text without spaces is one word.
LONG_WORD, BLOCK = 64, 1 << 16


def word_buckets(word: bytes, buckets: int = BUCKETS) -> list[int]:
    """Buckets of a word and its character n-grams (bytes of the bracketed word); the last
    bucket is kept for repeats."""
    marked = b"<" + word + b">"
    out = [crc32(word) % (buckets - 1)]
    for n in range(GRAMS[0], GRAMS[1] + 1):
        out += [crc32(marked[i:i + n]) % (buckets - 1) for i in range(len(marked) - n + 1)]
    return out


def long_word_buckets(word: bytes, buckets: int = BUCKETS) -> tuple[dict[int, int], int]:
    """The same buckets with their counts, and how many there are, in memory bounded by ``buckets``."""
    marked = b"<" + word + b">"
    counts = {crc32(word) % (buckets - 1): 1}
    total = 1
    for n in range(GRAMS[0], GRAMS[1] + 1):
        places = len(marked) - n + 1
        total += places
        for low in range(0, places, BLOCK):
            for b, c in Counter([crc32(marked[i:i + n]) % (buckets - 1) for i in range(low, min(low + BLOCK, places))]).items():
                counts[b] = counts.get(b, 0) + c
    return counts, total


def document_features(raw: bytes | None, buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray]:
    """Distinct buckets and their weights (summing to 1) in the average of a whole text."""
    words = (raw or b"").split()
    counts: dict[bytes, int] = {}
    for w in words:
        counts[w] = counts.get(w, 0) + 1
    weights: dict[int, float] = {}
    for w, n in counts.items():
        if len(w) > LONG_WORD:
            found, total = long_word_buckets(w, buckets)
            for b, c in found.items():
                weights[b] = weights.get(b, 0.0) + n * c / total
            continue
        parts = word_buckets(w, buckets)
        for b in parts:
            weights[b] = weights.get(b, 0.0) + n / len(parts)
    repeats = sum(map(operator.eq, words, words[1:]))
    if repeats:
        weights[buckets - 1] = float(repeats)
    ids = np.fromiter(weights, np.int32, len(weights))
    return ids, np.fromiter(weights.values(), np.float32, len(weights)) / max(1, len(words) + repeats)


def train(features: list[tuple[np.ndarray, np.ndarray]], classes: np.ndarray, buckets: int = BUCKETS, dim: int = DIM,
          epochs: int = EPOCHS, rate: float = RATE, seed: int = SEED) -> tuple[np.ndarray, float]:
    """(logit difference of each bucket, bias difference) of a two-class softmax model."""
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1 / dim, 1 / dim, (buckets, dim)).astype(np.float32)
    layer, bias = np.zeros((2, dim), np.float32), np.zeros(2, np.float32)
    steps, done = epochs * len(features), 0
    for _ in range(epochs):
        for i in rng.permutation(len(features)):
            ids, weights = features[i]
            lr = rate * (1 - done / steps)
            done += 1
            mean = weights @ vectors[ids] if len(ids) else np.zeros(dim, np.float32)
            logits = layer @ mean + bias
            p = np.exp(logits - logits.max())
            grad = p / p.sum()
            grad[int(classes[i])] -= 1
            back = layer.T @ grad
            layer -= lr * np.outer(grad, mean)
            bias -= lr * grad
            if len(ids):
                vectors[ids] -= lr * weights[:, None] * back[None, :]
    return vectors @ (layer[1] - layer[0]), float(bias[1] - bias[0])


def training_rows(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, folds: int, held_out: int,
                  sample: int) -> DataFrame:
    """(order, label, ids, weights) of at most ``sample`` labelled rows, also when ids repeat."""
    spark = docs.sparkSession
    fold = F.crc32(F.col(id_col).cast("string").cast("binary")) % folds
    marks = (labels.where(F.col(label_col).isin(0, 1) & (fold != held_out)).groupBy(id_col)
             .agg(F.min(label_col).cast("int").alias("label")))
    here = docs.where(fold != held_out).select(id_col).distinct()
    chosen = cut(spark, marks.join(here, id_col, "left_semi").orderBy(F.xxhash64(F.col(id_col).cast("string")), id_col)
                 .limit(sample), "classifier-sample")
    texts = (docs.select(id_col, F.col(text_col).cast("string").alias("text")).join(chosen, id_col)
             .select(F.xxhash64(F.col(id_col).cast("string")).alias("order"), "label", F.col("text").cast("binary").alias("text"))
             .dropDuplicates(["order", "label", "text"]))

    def featurise(batches):
        for batch in batches:
            found = [document_features(t) for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([f[0].tobytes() for f in found], pa.binary()),
                                              pa.array([f[1].tobytes() for f in found], pa.binary())], ["order", "label", "ids", "weights"])

    found = texts.mapInArrow(featurise, "order bigint, label int, ids binary, weights binary")
    return found.orderBy(F.xxhash64("order", "ids", "weights"), "order", "ids").limit(sample)


def fit(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, folds: int, held_out: int,
        sample: int) -> tuple[np.ndarray, float]:
    """Train on the bounded sample, in one task; the model (one float per bucket) comes back."""
    def learn(whole: pa.Table) -> pa.Table:
        whole = whole.sort_by([("order", "ascending"), ("ids", "ascending")])
        feats = [(np.frombuffer(i, np.int32), np.frombuffer(w, np.float32))
                 for i, w in zip(whole["ids"].to_pylist(), whole["weights"].to_pylist())]
        scores, bias = train(feats, whole["label"].to_numpy())
        return pa.table({"scores": pa.array([scores.astype(np.float32).tobytes()], pa.binary()), "bias": [bias]})

    found = (training_rows(docs, labels, id_col, text_col, label_col, folds, held_out, sample).withColumn("all", F.lit(0)).groupBy("all")
             .applyInArrow(learn, "scores binary, bias double").collect())
    if not found:
        return np.zeros(BUCKETS, np.float32), 0.0
    return np.frombuffer(bytes(found[0]["scores"]), np.float32), found[0]["bias"]


def make_scorer(scores: np.ndarray, bias: float):
    """A function from a raw text to its probability of class 1, with a bounded word cache."""
    table_ = scores.tolist()
    repeat = table_[-1]
    buckets = len(table_)

    class Cache(dict):
        def __missing__(self, word):
            if len(word) > LONG_WORD:
                found, total = long_word_buckets(word, buckets)
                return sum([table_[b] * c for b, c in found.items()]) / total
            if len(self) >= CACHE_WORDS:
                self.clear()
            parts = word_buckets(word, buckets)
            value = self[word] = sum([table_[b] for b in parts]) / len(parts)
            return value

    cache = Cache()

    def score(raw: bytes | None) -> float:
        words = (raw or b"").split()
        repeats = sum(map(operator.eq, words, words[1:]))
        total = sum(map(cache.__getitem__, words)) + repeats * repeat
        logit = bias + total / max(1, len(words) + repeats)
        return float(1 / (1 + np.exp(-min(60.0, max(-60.0, logit)))))

    return score


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
             folds: int = 3, held_out: int = 1, sample: int = SAMPLE, keep: tuple[str, ...] = ()) -> DataFrame:
    """(id, held_out, score, predicted) per document row, plus the input columns in ``keep``."""
    spark = docs.sparkSession
    bounded_batches(spark)
    scores, bias = fit(docs, labels, id_col, text_col, label_col, folds, held_out, sample)

    def run(batches):
        score = make_scorer(scores, bias)
        for batch in batches:
            values = [score(t) for t in batch.column(0).cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(values, pa.float64())], [*batch.schema.names[1:], "score"])

    fold = F.crc32(F.col(id_col).cast("string").cast("binary")) % folds
    picked = docs.select(F.col(text_col).cast("string").alias("__text"), F.col(id_col),
                         F.coalesce(fold == held_out, F.lit(False)).alias("held_out"), *(F.col(c).alias(f"__keep_{c}") for c in keep))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in picked.schema.fields[1:])
    out = picked.mapInArrow(run, f"{schema}, score double")
    return out.select(id_col, "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"),
                      *(F.col(f"__keep_{c}") for c in keep))


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document."""
    return classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
