"""Hard negatives by an inverted multi-index over integer vectors.

Vectors are cut into two halves.  A codebook for each half, fitted on a bounded sample, gives every
row a pair of codes, its cell.  For an anchor, a row of cell (i, j) scores at most

    anchor_1 . c1_i + |anchor_1| r1_i  +  anchor_2 . c2_j + |anchor_2| r2_j

with r the codebook entry's radius, the largest distance of a row's half to its centre.  The
multi-sequence heap visits an anchor's cells by falling bound; once the bound is below the worst
score still needed (or below a window's lower end) nothing unseen can matter, and the visit stops
with a certified result.  Codebooks steer the order only: results are exact for any codebook.

Rows are dealt to shards of about ``shard_rows`` rows, so a cell with any share of all rows, such as
that of a very common vector, is split over all shards.  Anchors come in blocks of up to about ``block_rows``: a task
indexes one shard and streams a block's anchors past it, so its memory is bounded by the shard, and
each shard is copied once per block only.  A first pass finds each anchor's positives; a second
finds, for each anchor, the best rows of every window.

Edge cases: rows with a null id, a null label, a null or empty vector, or a null or non-finite component take no part;
vectors of another length than the anchor's are never compared with it; equal scores rank by the smaller id; repeated
rows are found as often as they occur, but never by an anchor of their own id; of anchors with one
id, the one with the smallest label and vector counts.  Scores are exact integers however large the
components; one beyond the range of a long is returned as the nearest long.  Windows below a
negative score are empty.  An empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructType

from eventlake.llm.common import bounded_batches, cut, table

POSITIVES, NEGATIVES, LOW, HIGH = 5, 5, 80, 100
SHARD_ROWS, BLOCK_ROWS, SAMPLE_ROWS, CODES, ROUNDS, GULP = 8192, 16_384, 4096, 16, 6, 1024
#: Windows are given in hundredths of the positive score.
UNIT = 100
#: Relative room for rounding in the bounds; scores themselves are exact.
SLACK = 1e-9
#: Integers below this are exact as doubles.
EXACT = 2.0 ** 53
LONG = (-2 ** 63, 2 ** 63 - 1)


def usable(vectors: DataFrame, id_col: str, vector_col: str, label: Column) -> DataFrame:
    """id, label, dim and the whole-numbered vector of the rows that take part."""
    vector = F.col(vector_col).cast("array<double>")
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & (F.size(vector) > 0)
    # floor as a double: a component of any size stays a whole number (256 x is exact but for overflow).
    whole = F.transform(vector, lambda x: F.when(F.abs(x) < 2.0 ** 44, F.floor(x * 256).cast("double")).otherwise(x * 256))
    rows = vectors.where(F.col(id_col).isNotNull() & fine).select(F.col(id_col).cast("long").alias("id"), label.cast("long").alias("label"),
                                                                  F.size(vector).alias("dim"), whole.alias("vector"))
    return rows.where(F.col("label").isNotNull() & F.forall("vector", lambda x: F.abs(x) < float("inf")))


def matrix(column) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def centres(points: np.ndarray, codes: int, seed: int) -> np.ndarray:
    """Lloyd's centres of a bounded sample."""
    rng = np.random.default_rng(seed)
    found = np.unique(points, axis=0)
    found = found[rng.permutation(len(found))[:codes]]
    for _ in range(ROUNDS):
        nearest = coded(points, found)
        for code in range(len(found)):
            mine = points[nearest == code]
            if len(mine):
                found[code] = mine.mean(axis=0)
    return found


def coded(points: np.ndarray, codebook: np.ndarray) -> np.ndarray:
    return ((codebook ** 2).sum(axis=1) - 2 * points @ codebook.T).argmin(axis=1)


def codebooks(rows: DataFrame, sample_rows: int = SAMPLE_ROWS, codes: int = CODES) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """{dim: (first half's centres, second half's)}, from at most ``sample_rows`` rows in order of a hash."""
    some = rows.select("dim", "vector").orderBy(F.xxhash64("id", "vector"), "vector").limit(sample_rows).toPandas()
    books = {}
    for dim, mine in some[some["dim"] > 1].groupby("dim")["vector"]:
        points = np.clip(np.array(mine.to_list(), dtype=float), -2.0 ** 400, 2.0 ** 400)
        books[int(dim)] = tuple(centres(half, codes, seed) for seed, half in enumerate((points[:, :dim // 2], points[:, dim // 2:])))
    return books


class Cells:
    """One shard's inverted multi-index: rows sorted by cell, and the radii of the codes here."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray, books):
        half = vectors.shape[1] // 2
        self.scale = max(1.0, float(np.abs(vectors).max(initial=0.0)))
        sides, codes = (vectors[:, :half], vectors[:, half:]), []
        #: Centres and radii in units of the shard's largest component: no bound overflows.
        self.books, self.radii = [], []
        for side, book in zip(sides, books or (np.zeros((1, half)), np.zeros((1, vectors.shape[1] - half)))):
            code = coded(side / self.scale, book / self.scale)
            away = np.sqrt((((side - book[code]) / self.scale) ** 2).sum(axis=1))
            radius = np.zeros(len(book))
            np.maximum.at(radius, code, away)
            codes.append(code)
            self.books.append(book / self.scale)
            self.radii.append(radius)
        cell = codes[0] * len(self.books[1]) + codes[1]
        order = np.lexsort((ids, cell))
        self.ids, self.labels, self.vectors, self.half = ids[order], labels[order], vectors[order], half
        self.largest = np.abs(self.vectors).max(axis=1, initial=0.0)
        edges = np.searchsorted(cell[order], np.arange(len(self.books[0]) * len(self.books[1]) + 1))
        self.low, self.high = edges[:-1].tolist(), edges[1:].tolist()

    def scores(self, anchor: np.ndarray, rows: np.ndarray):
        """Exact integer scores; as Python integers where doubles would round."""
        size = max(1.0, float(np.abs(anchor).max(initial=0.0))) * len(anchor)
        if self.scale < EXACT / size:
            return (self.vectors[rows] @ anchor).astype(np.int64)
        exact, out = [int(x) for x in anchor], np.empty(len(rows), dtype=object)
        for n, row in enumerate(rows):
            fits = self.largest[row] < EXACT / size
            out[n] = int(self.vectors[row] @ anchor) if fits else sum(a * int(x) for a, x in zip(exact, self.vectors[row]))
        return out

    def visits(self, anchor: np.ndarray):
        """(bound on the scores of these and all later rows, rows) in gulps, by the multi-sequence heap."""
        sides = []
        size = max(1.0, float(np.abs(anchor).max(initial=0.0)))
        for part, book, radius in zip((anchor[:self.half] / size, anchor[self.half:] / size), self.books, self.radii):
            bound = book @ part + radius * np.sqrt((part ** 2).sum())
            order = np.argsort(-bound, kind="stable")
            sides.append((bound[order].tolist(), order.tolist()))
        (first, first_code), (second, second_code) = sides
        room = SLACK * len(anchor)
        width, heap, seen = len(second), [(-(first[0] + second[0]), 0, 0)], {(0, 0)}
        rows, most = [], None
        while heap:
            bound, i, j = heapq.heappop(heap)
            for near in ((i + 1, j), (i, j + 1)):
                if near[0] < len(first) and near[1] < width and near not in seen:
                    seen.add(near)
                    heapq.heappush(heap, (-(first[near[0]] + second[near[1]]), *near))
            cell = first_code[i] * width + second_code[j]
            if self.low[cell] < self.high[cell]:
                most = -bound if most is None else most
                rows.append(np.arange(self.low[cell], self.high[cell]))
                if sum(map(len, rows)) >= GULP:
                    yield (most + room) * self.scale * size, np.concatenate(rows)
                    rows, most = [], None
        if rows:
            yield (most + room) * self.scale * size, np.concatenate(rows)


def best(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best rows: highest score, then smallest id."""
    if scores.dtype != object and len(scores) > 8 * k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        some = np.flatnonzero(scores >= least)
        return some[np.lexsort((ids[some], -scores[some]))[:k]]
    return np.array(sorted(range(len(ids)), key=lambda n: (-int(scores[n]), int(ids[n])))[:k], dtype=np.int64)


def nearest_same(cells: Cells, own: int, label: int, anchor: np.ndarray, k: int = POSITIVES) -> list[tuple[int, int]]:
    """(id, score) of the shard's k best other rows of the anchor's label."""
    ids, scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for bound, rows in cells.visits(anchor):
        if len(ids) == k and int(scores[-1]) > bound:
            break
        rows = rows[(cells.labels[rows] == label) & (cells.ids[rows] != own)]
        ids, scores = np.concatenate([ids, cells.ids[rows]]), np.concatenate([scores, cells.scores(anchor, rows)])
        keep = best(ids, scores, k)
        ids, scores = ids[keep], scores[keep]
    return [(int(i), int(s)) for i, s in zip(ids, scores)]


def in_windows(cells: Cells, own: int, label: int, anchor: np.ndarray, tops: list[int], k: int = NEGATIVES,
               low: int = LOW, high: int = HIGH) -> dict[int, list[tuple[int, int]]]:
    """{positive score: (id, score) of the shard's k best rows of other labels inside its window}."""
    tops = [t for t in sorted(set(tops)) if low * t <= high * t]
    found = {t: (np.zeros(0, np.int64), np.zeros(0, np.int64)) for t in tops}
    for bound, rows in cells.visits(anchor) if tops else ():
        # A window is done when it is full with better scores, or lies above all that follows.
        open_tops = [t for t in tops if UNIT * bound >= low * t and not (len(found[t][0]) == k and int(found[t][1][-1]) > bound)]
        if not open_tops:
            break
        rows = rows[(cells.labels[rows] != label) & (cells.ids[rows] != own)]
        scores = cells.scores(anchor, rows)
        for t in open_tops:
            fits = ((scores * UNIT >= low * t) & (scores * UNIT <= high * t)).astype(bool)
            if fits.any():
                ids, kept = np.concatenate([found[t][0], cells.ids[rows[fits]]]), np.concatenate([found[t][1], scores[fits]])
                keep = best(ids, kept, k)
                found[t] = ids[keep], kept[keep]
    return {t: [(int(i), int(s)) for i, s in zip(*found[t])] for t in tops}


def visit_all(shards: DataFrame, anchors: DataFrame, n_shards: int, block_rows: int, books, search, schema: str) -> DataFrame:
    """The rows that ``search(cells, id, label, vector, tops)`` gives for every anchor and every shard of its
    dimension.  A shard's rows come first in each (dim, shard, block), then its anchors are streamed."""
    blocks = max(1, -(-anchors.count() // block_rows))
    spread = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    columns = ["dim", "shard", "block", "turn", "id", "label", "vector", "tops"]
    rows = shards.withColumn("block", spread(blocks)).withColumns({"turn": F.lit(0), "tops": F.lit(None).cast("array<string>")})
    asking = (anchors.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int")).withColumn("shard", spread(n_shards))
              .withColumn("turn", F.lit(1)))
    dealt = rows.select(columns).unionByName(asking.select(columns)).repartition("dim", "shard", "block")
    names, kinds = zip(*((f.name, to_arrow_type(f.dataType)) for f in StructType.fromDDL(schema)))

    def run(batches):
        key, parts, cells = None, [], None
        for batch in batches:
            keys = np.column_stack([batch.column(c).to_numpy() for c in columns[:4]])
            edges = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1), len(keys)]
            for low, high in zip(edges[:-1], edges[1:]):
                if low == high:
                    continue
                some = batch.slice(low, high - low)
                if tuple(keys[low, :3]) != key:
                    key, parts, cells = tuple(keys[low, :3]), [], None
                if not keys[low, 3]:
                    parts.append(some)
                    continue
                if parts:
                    cells, parts = cells_of(pa.Table.from_batches(parts), books), []
                if cells is None:  # no row of this dimension was dealt to this shard
                    continue
                asked = zip(*(some.column(c).to_pylist() for c in ("id", "label")), matrix(some.column("vector")), some.column("tops").to_pylist())
                out = [row for one in asked for row in search(cells, *one)]
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)

    return dealt.sortWithinPartitions("dim", "shard", "block", "turn").mapInArrow(run, schema)


def cells_of(shard: pa.Table, books) -> Cells:
    return Cells(shard["id"].to_numpy(), shard["label"].to_numpy(), matrix(shard["vector"]), books.get(shard["dim"][0].as_py()))


def mine(vectors: DataFrame, anchor_where: str = "id % 100 = 0", id_col: str = "vec_id", vector_col: str = "embedding", label: Column | str = "label",
         positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH,
         shard_rows: int = SHARD_ROWS, block_rows: int = BLOCK_ROWS, sample_rows: int = SAMPLE_ROWS, codes: int = CODES) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score): for each anchor and each of its first
    ``positives`` rows of the same label, the first ``negatives`` rows of other labels with
    low * positive_score <= 100 * negative_score <= high * positive_score."""
    spark = vectors.sparkSession
    bounded_batches(spark)
    rows = cut(spark, usable(vectors, id_col, vector_col, F.col(label) if isinstance(label, str) else label)
               .withColumn("deal", F.monotonically_increasing_id()), "negatives-rows")
    n_shards = max(1, -(-rows.count() // shard_rows))
    shards = rows.withColumn("shard", F.pmod("deal", F.lit(n_shards)).cast("int")).drop("deal")
    anchors = cut(spark, rows.where(anchor_where).groupBy("id").agg(F.min(F.struct("label", "dim", "vector")).alias("v")).select("id", "v.*"), "negatives-anchors")
    books = codebooks(rows, sample_rows, codes)

    def positives_of(cells, own, lab, anchor, tops):
        return [(own, i, *as_text(score)) for i, score in nearest_same(cells, own, lab, anchor, positives)]

    found = visit_all(shards, anchors.withColumn("tops", F.lit(None).cast("array<string>")), n_shards, block_rows, books, positives_of,
                      "anchor_id bigint, positive_id bigint, score string, digits int")
    order = Window.partitionBy("anchor_id").orderBy(*by_score("score", "digits"), "positive_id")
    # A positive that occurs twice takes two places but gives its rows once.
    first = found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= positives).drop("place", "digits").distinct()
    first = cut(spark, first, "negatives-positives")

    asked = cut(spark, anchors.join(first.groupBy(F.col("anchor_id").alias("id")).agg(F.collect_set("score").alias("tops")), "id"), "negatives-asked")

    def negatives_of(cells, own, lab, anchor, tops):
        windows = in_windows(cells, own, lab, anchor, [int(t) for t in tops], negatives, low, high)
        return [(own, str(top), i, *as_text(score)) for top, rows in windows.items() for i, score in rows]

    near = visit_all(shards, asked, n_shards, block_rows, books, negatives_of,
                     "anchor_id bigint, top string, negative_id bigint, score string, digits int")
    order = Window.partitionBy("anchor_id", "top").orderBy(*by_score("score", "digits"), "negative_id")
    near = near.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= negatives)
    return (first.withColumnRenamed("score", "top").join(near, ["anchor_id", "top"])
            .select("anchor_id", "positive_id", "rank", "negative_id", long_of("top").alias("positive_score"), long_of("score").alias("negative_score")))


def as_text(score: int) -> tuple[str, int]:
    """Scores travel as text: an integer of any size orders by sign, number of digits and text."""
    return str(score), len(str(abs(score)))


def by_score(score: str, digits: str) -> list[Column]:
    """Falling order of integers written as text."""
    below = F.col(score).startswith("-")
    return [below, F.when(below, F.col(digits)).otherwise(-F.col(digits)), F.when(below, F.col(score)).asc(), F.when(~below, F.col(score)).desc()]


def long_of(score: str) -> Column:
    nearest = F.when(F.col(score).startswith("-"), F.lit(LONG[0])).otherwise(F.lit(LONG[1]))
    return F.coalesce(F.expr(f"try_cast({score} as bigint)"), nearest)


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Negatives of every vec_id divisible by 100; every seventh id's label is moved on by one."""
    vectors = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(vectors, "id % 100 = 0", label=label)


OP12_SQL = """
WITH rows AS (
  SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         [floor(256 * x::DOUBLE) FOR x IN embedding] AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
scored AS (
  SELECT a.id AS anchor_id, r.id AS id, a.label = r.label AS same, list_dot_product(a.v, r.v)::BIGINT AS score
  FROM rows a JOIN rows r ON a.id % 100 = 0 AND a.id <> r.id),
positives AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT p.anchor_id, p.positive_id, row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.id)::INTEGER AS rank,
       s.id AS negative_id, p.positive_score, s.score AS negative_score
FROM positives p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT s.same
  AND 80 * p.positive_score <= 100 * s.score AND 100 * s.score <= 100 * p.positive_score
QUALIFY rank <= 5
"""
