"""Approximate nearest neighbours by vantage-point trees.

Rows are dealt to shards of about ``shard_rows`` rows; each shard is indexed whole by a
vantage-point tree.  Largest inner product becomes smallest distance by one more coordinate:
with M the shard's largest squared norm, x is extended by sqrt(M - |x|^2) and a query by 0, so
the squared distance is |q|^2 + M - 2 q.x.  A subtree is skipped when the least distance that the
triangle inequality allows it, times ``factor``, exceeds the k-th distance found so far.  A factor
of 1 skips only what cannot hold a neighbour, so the search is exact; a larger one skips more.
Queries are cut into blocks, so that neither side of a task grows with the data.

Vectors that are null, empty, zero or hold null or non-finite components take no part, and vectors
of another length than the query's are never compared with it.  A query never finds a row with
its own id; other repeated rows are found as often as they occur.  Of query rows with one id,
the one with the smallest vector is searched.  Null ids take no part.  Vectors with a component
above 2 ** 100 in size are scanned instead; a score beyond the range of doubles is infinite, one
that is not a number takes no part.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from eventlake.llm.common import cut, table

K, SHARD_ROWS, BLOCK_ROWS, LEAF, FACTOR = 20, 8192, 4096, 128, 2.0
SLACK = 1e-6
#: Vectors with a larger component are scanned: their squares would swamp or overflow a tree's distances.
EXTREME = 2.0 ** 100


class Tree:
    """Vantage-point tree over one shard; queries are searched in batches."""

    def __init__(self, vectors: np.ndarray, ids: np.ndarray, leaf: int = LEAF, seed: int = 3):
        norms = (vectors ** 2).sum(axis=1)
        self.most = norms.max()
        self.vectors, self.ids, self.leaf = vectors, ids, leaf
        self.points = np.column_stack([vectors, np.sqrt(np.maximum(0, self.most - norms))])
        self.rng = np.random.default_rng(seed)
        self.root = self._build(np.argsort(ids, kind="stable"))

    def _build(self, rows: np.ndarray):
        """A leaf's rows, or (vantage row, two parts of (least, largest distance, subtree))."""
        if len(rows) <= self.leaf:
            return rows
        vantage = int(rows[self.rng.integers(len(rows))])
        away = np.sqrt(((self.points[rows] - self.points[vantage]) ** 2).sum(axis=1))
        order = np.argsort(away, kind="stable")
        halves = (order[:len(rows) // 2], order[len(rows) // 2:])
        return vantage, [(away[h[0]], away[h[-1]], self._build(np.sort(rows[h]))) for h in halves]

    def search(self, queries: np.ndarray, own: np.ndarray, k: int = K, factor: float = FACTOR) -> tuple[np.ndarray, np.ndarray]:
        """(scores, ids) of the k best rows found for each query, best first; -inf fills up."""
        self.queries, self.own, self.k, self.factor = queries, own, k, factor
        self.square = (queries ** 2).sum(axis=1) + self.most
        self.top = np.full((len(queries), k), -np.inf)  # the k best scores so far, least first
        self.reach = np.full(len(queries), np.inf)
        self.hits = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
        self._visit(self.root, np.arange(len(queries)))
        q, rows, scores = (np.concatenate(part) for part in zip(*self.hits))
        order = np.lexsort((self.ids[rows], -scores, q))
        q, rows, scores = q[order], rows[order], scores[order]
        rank = np.arange(len(q)) - np.searchsorted(q, q)
        q, rows, scores, rank = (x[rank < k] for x in (q, rows, scores, rank))
        best, found = np.full((len(queries), k), -np.inf), np.zeros((len(queries), k), np.int64)
        best[q, rank], found[q, rank] = scores, self.ids[rows]
        return best, found

    def _visit(self, node, q: np.ndarray) -> None:
        if not len(q):
            return
        if isinstance(node, np.ndarray):
            self._leaf(node, q)
            return
        vantage, parts = node
        away = np.sqrt(np.maximum(0, self.square[q] - 2 * (self.queries[q] @ self.vectors[vantage])))
        least = [np.maximum(0, np.maximum(low - away, away - high)) for low, high, _ in parts]
        inner = away <= parts[0][1]
        for part, side in ((0, inner), (1, ~inner), (1, inner), (0, ~inner)):
            self._visit(parts[part][2], q[side][least[part][side] * self.factor <= self.reach[q[side]] + SLACK])

    def _leaf(self, rows: np.ndarray, q: np.ndarray) -> None:
        near = self.queries[q] @ self.vectors[rows].T
        near[self.ids[rows][None, :] == self.own[q][:, None]] = -np.inf
        i, j = np.nonzero((near >= self.top[q, :1] - SLACK) & np.isfinite(near))
        # One fixed order of summation: equal vectors get equal scores wherever they lie.
        scores = np.einsum("nd,nd->n", self.queries[q[i]], self.vectors[rows[j]])
        self.hits.append((q[i], rows[j], scores))
        some = np.unique(i)
        exact = np.full(near.shape, -np.inf)
        exact[i, j] = scores
        q = q[some]
        self.top[q] = np.sort(np.partition(np.concatenate([self.top[q], exact[some]], axis=1), -self.k, axis=1)[:, -self.k:], axis=1)
        least = self.top[q, 0]
        full = np.isfinite(least)
        self.reach[q[full]] = np.sqrt(np.maximum(0, self.square[q[full]] - 2 * least[full]))


def scanned(queries: np.ndarray, own: np.ndarray, vectors: np.ndarray, ids: np.ndarray, k: int) -> list[tuple[int, int, float]]:
    """(query id, id, score) of each query's k best rows, every row scored."""
    out = []
    for query, me in zip(queries, own):
        with np.errstate(over="ignore", invalid="ignore"):
            scores = np.einsum("nd,nd->n", np.broadcast_to(query, vectors.shape), vectors)
        rows = np.flatnonzero((ids != me) & ~np.isnan(scores))
        rows = rows[np.lexsort((ids[rows], -scores[rows]))[:k]]
        out += [(int(me), int(ids[r]), float(scores[r])) for r in rows]
    return out


def matrix(column: pa.ChunkedArray) -> np.ndarray:
    flat = pa.chunked_array([c.flatten() for c in column.chunks], pa.float64()).to_numpy()
    return flat.reshape(len(column), -1)


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    vector = F.col(vector_col).cast("array<double>")
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(vector, lambda x: x != 0)
    return vectors.where(F.col(id_col).isNotNull() & fine).select(
        F.col(id_col).cast("long").alias("id"), vector.alias("vector"), F.size(vector).alias("dim"))


def search(vectors: DataFrame, queries: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = K,
           factor: float = FACTOR, shard_rows: int = SHARD_ROWS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best rows found for every row of ``queries``."""
    spark = vectors.sparkSession
    rows = cut(spark, usable(vectors, id_col, vector_col).withColumn("deal", F.monotonically_increasing_id()), "search-rows")
    asked = cut(spark, usable(queries, id_col, vector_col).groupBy("id").agg(F.min(F.struct("dim", "vector")).alias("v"))
                .select("id", "v.vector", "v.dim").withColumn("deal", F.monotonically_increasing_id()), "search-queries")
    shards = max(1, -(-rows.count() // shard_rows))
    blocks = max(1, -(-asked.count() // block_rows))
    spread = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    # A shard meets every block of queries; both sides carry the pair's key.
    left = rows.select("dim", F.pmod("deal", F.lit(shards)).cast("int").alias("shard"), spread(blocks).alias("block"), "id", "vector")
    right = asked.select("dim", spread(shards).alias("shard"), F.pmod("deal", F.lit(blocks)).cast("int").alias("block"), "id", "vector")

    def run(shard: pa.Table, block: pa.Table) -> pa.Table:
        schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])
        if not len(shard) or not len(block):
            return schema.empty_table()
        own, ids, queries, rows = block["id"].to_numpy(), shard["id"].to_numpy(), matrix(block["vector"]), matrix(shard["vector"])
        odd, odd_rows = np.abs(queries).max(axis=1) > EXTREME, np.abs(rows).max(axis=1) > EXTREME
        out = scanned(queries[odd], own[odd], rows, ids, k)
        if odd_rows.any():
            out += scanned(queries[~odd], own[~odd], rows[odd_rows], ids[odd_rows], k)
        parts = [pa.table([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)] if out else []
        if not odd.all() and not odd_rows.all():
            own = own[~odd]
            best, found = Tree(rows[~odd_rows], ids[~odd_rows]).search(queries[~odd], own, k, factor)
            full = np.isfinite(best)
            parts.append(pa.table([np.repeat(own, k).reshape(best.shape)[full], found[full], best[full]], schema=schema))
        return pa.concat_tables(parts) if parts else schema.empty_table()

    key = ["dim", "shard", "block"]
    found = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(run, "query_id bigint, vec_id bigint, score double")
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def op10_vector_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest rows of every vec_id divisible by 20."""
    vectors = table(spark, sf_dir, "embeddings")
    return search(vectors, vectors.where("vec_id % 20 = 0"))
