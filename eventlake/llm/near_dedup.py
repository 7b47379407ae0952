"""Near-duplicate documents by bottom-k sketches of one hash function.

Texts are classed by their exact word sequence, so copies cost one row each; one document
stands for its class.  Inverted lists of every representative's ``LISTED`` smallest shingle hashes
give the pairs that share values, filtered by the number of shared values and the sizes.  Only texts
that such a pair names are read again, for their sets; the estimate from the union of both sketches of
the ``SKETCH`` smallest values filters on, and the exact Jaccard similarity of the full sets confirms.

A list longer than ``LONG`` (a passage many documents share, a large family of copies) emits no
pairs of its own.  A pair that such lists alone connect has frequent values among at least a
third of either sketch; those documents alone are ranked again by re-mixed values of the same
hash, in bands.  Each takes a pivot, the most central document it shares a band with, and keeps
its difference from it: the values that only one of the two holds; those with open pairs move on to the
best pivot that their bands know, so that a family comes to have one.  Two sets differ in as many
values as their differences from one pivot do, so pairs with one pivot are settled exactly by
these small differences, and most are by their sizes alone: first each member with its pivot, then
with the member next to the pivot, then what lies in two components.  Only pairs with two pivots and
in two components are left to the bands.  A band's short list emits those; a long one is worked off by leaders: the
first members of its ``LED`` first components are compared with all members of other
components, components grow, and so on with sixteen times as many, until all have led or so few
members are left that each can be compared.  So work is in proportion to the members, not to their pairs, for the
first members of a family already join it.  What remains is compared across components.

Verified links form components; only pairs that lie in two components are verified.

A pair at the threshold is missed with a probability below 1e-6: its sketches share too few of
the ``LISTED`` smallest values, or no band.  Sets are of 64-bit hashes.

Edge cases: a null or wordless text has an empty set and is linked with nothing; rows of one
id are one document, whichever texts they hold; a row with a null id has no component and is
kept; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from eventlake.llm.common import bounded_batches, connected_components, cut, release, sifted, table, temporary

WORDS, PERCENT = 5, 80
SKETCH, LISTED, LONG = 64, 24, 64
BANDS, BAND_VALUES, LED = 88, 8, 4
#: Times that nodes of open lists may take a better pivot.
MOVES = 2


def text_words(raw: bytes | None) -> list[bytes]:
    """Words of a UTF-8 text, A-Z lower-cased (bytes.lower and bytes.split know ASCII only)."""
    return (raw or b"").lower().split()


def shingle_hashes(words: list[bytes], size: int) -> np.ndarray:
    """Sorted distinct 63-bit hashes of the word shingles; all words as one if there are fewer."""
    if not words:
        return np.zeros(0, np.int64)
    one = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    size = min(size, len(words))
    with np.errstate(over="ignore"):
        mixed = np.zeros(len(words) - size + 1, np.uint64)
        for i in range(size):
            mixed = (mixed ^ one[i:len(words) - size + 1 + i]) * np.uint64(0x9E3779B97F4A7C15)
            mixed ^= mixed >> np.uint64(29)
        mixed *= np.uint64(0xBF58476D1CE4E5B9)
        mixed ^= mixed >> np.uint64(32)
    return np.unique((mixed >> np.uint64(1)).astype(np.int64))


def class_key(words: list[bytes]) -> bytes | None:
    return xxhash.xxh3_128_digest(b" ".join(words)) if words else None


def sketches(docs: DataFrame, id_col: str, text_col: str, size: int) -> DataFrame:
    """(id, cls, n, least) per row: the ``LISTED`` smallest hashes; cls is null without words."""
    def run(batches):
        for batch in batches:
            keys, counts, kept = [], [], []
            for raw in batch.column(1).cast(pa.binary()).to_pylist():
                words = text_words(raw)
                hashes = shingle_hashes(words, size)
                keys.append(class_key(words))
                counts.append(len(hashes))
                kept.append(hashes[:LISTED])
            offsets = np.concatenate([[0], np.cumsum([len(k) for k in kept])]).astype(np.int32)
            values = np.concatenate(kept) if kept else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(keys, pa.binary()), pa.array(counts, pa.int64()),
                                              pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))], ["id", "cls", "n", "least"])

    picked = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return picked.mapInArrow(run, "id bigint, cls binary, n bigint, least array<bigint>")


def full_sets(docs: DataFrame, needed: DataFrame, id_col: str, text_col: str, size: int) -> DataFrame:
    """(node, hot, sketch, hashes) of the representatives in ``needed(node, rep, cls, times, hot)``; only those whose
    row is there several times are dealt out to be made one."""
    def run(batches):
        for batch in batches:
            rows = []
            for node, cls, hot, raw in zip(*(c.to_pylist() for c in batch.columns)):
                words = text_words(raw)
                if class_key(words) == cls:
                    hashes = shingle_hashes(words, size)
                    rows.append((node, hot, hashes[:SKETCH], hashes.tobytes()))
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.int64(), pa.bool_(), pa.list_(pa.int64()), pa.binary()))],
                                             ["node", "hot", "sketch", "hashes"])

    texts = docs.select(F.col(id_col).cast("long").alias("rep"), F.col(text_col).cast("string").cast("binary").alias("text"))
    sets = lambda some: (texts.join(some, "rep").select("node", "cls", "hot", "text")
                         .mapInArrow(run, "node bigint, hot boolean, sketch array<bigint>, hashes binary"))
    return sets(needed.where("times = 1")).unionByName(sets(needed.where("times > 1")).dropDuplicates(["node"]))


def list_pairs(lists: DataFrame) -> DataFrame:
    """(a, b, shared): pairs of nodes in lists of at most ``LONG`` members, with the lists shared."""
    members = F.sort_array(F.collect_list("node"))
    rest = F.transform(F.col("m"), lambda x, i: F.struct(x.alias("a"), F.slice(F.col("m"), i + 2, F.size("m")).alias("bs")))
    return (lists.groupBy("value").agg(members.alias("m")).where(F.size("m") > 1)
            .select(F.explode(rest).alias("p")).select("p.a", F.explode("p.bs").alias("b"))
            .groupBy("a", "b").agg(F.count(F.lit(1)).alias("shared")))


def open_pairs(lists: DataFrame) -> DataFrame:
    """(a, b): pairs of nodes of one list of ``lists(value, node, comp, pivot)`` that lie in two components and have not one pivot."""
    members = F.sort_array(F.collect_list(F.struct("node", "comp", "pivot")))

    def others(x, i):
        apart_ = F.filter(F.slice("m", i + 2, F.size("m")), lambda y: (y.comp != x.comp) & ~F.coalesce(y.pivot == x.pivot, F.lit(False)))
        return F.struct(x.node.alias("a"), F.transform(apart_, lambda y: y.node).alias("bs"))

    return (lists.groupBy("value").agg(members.alias("m"), F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo < hi")
            .select(F.explode(F.transform("m", others)).alias("p")).select("p.a", F.explode("p.bs").alias("b")).distinct())


def verify(pairs: DataFrame, sketch: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs whose union sketch does not rule them out and whose full sets reach the similarity.

    ``pairs`` is read several times: sketches and sets are moved only for the nodes that it names."""
    named = lambda frame, of, x: frame.join(of.select(F.col(x).alias("node")), "node", "left_semi")
    k = F.lit(SKETCH)
    union = F.slice(F.array_sort(F.array_union("sa", "sb")), 1, k)
    both = F.size(F.array_intersect(union, F.array_intersect("sa", "sb")))
    # Six standard deviations below the threshold; exact where a sketch is the whole set.
    likely = both >= F.floor(F.size(union) * F.lit(percent / 100 - 6 * (0.16 / SKETCH) ** 0.5))
    near = (pairs.select("a", "b").join(sketch.select(F.col("node").alias("b"), F.col("sketch").alias("sb")), "b")
            .join(named(sketch, pairs, "a").select(F.col("node").alias("a"), F.col("sketch").alias("sa")), "a").where(likely).select("a", "b"))
    near = cut(pairs.sparkSession, near, "near-likely")

    def run(batches):
        for batch in batches:
            keep = []
            for left, right in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                x, y = np.frombuffer(left, np.int64), np.frombuffer(right, np.int64)
                inter = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * inter >= percent * (len(x) + len(y) - inter) and inter > 0)
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return (near.join(sets.select(F.col("node").alias("b"), F.col("hashes").alias("hb")), "b")
            .join(named(sets, near, "a").select(F.col("node").alias("a"), F.col("hashes").alias("ha")), "a")
            .select("a", "b", "ha", "hb").mapInArrow(run, "a bigint, b bigint"))


def bands(sets: DataFrame) -> DataFrame:
    """(value, node): for each band, a hash of the least re-mixed values of a set."""
    def run(batches):
        rng = np.random.default_rng(5)
        odd = rng.integers(0, 1 << 62, BANDS * BAND_VALUES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        flip = rng.integers(0, 1 << 63, BANDS * BAND_VALUES, dtype=np.uint64)
        for batch in batches:
            nodes, values = [], []
            for node, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                hashes = np.frombuffer(raw, np.int64).astype(np.uint64)
                least = np.full(len(odd), np.iinfo(np.uint64).max, np.uint64)
                with np.errstate(over="ignore"):
                    for part in np.array_split(hashes, -(-len(hashes) // 256)):  # bounded memory for very long texts
                        least = np.minimum(least, ((part[None, :] ^ flip[:, None]) * odd[:, None] >> np.uint64(1)).min(axis=1))
                least = least.reshape(BANDS, BAND_VALUES)
                nodes += [node] * BANDS
                values += [xxhash.xxh3_64_intdigest(row.tobytes(), seed=i) >> 1 for i, row in enumerate(least)]
            yield pa.RecordBatch.from_arrays([pa.array(values, pa.int64()), pa.array(nodes, pa.int64())], ["value", "node"])

    return sets.select("node", "hashes").mapInArrow(run, "value bigint, node bigint")


def spread(members: DataFrame) -> DataFrame:
    """``members(node, lists, ...)`` with a row, and (value, count), for each of a node's lists."""
    return members.withColumn("l", F.explode("lists")).select("l.value", "l.count", *(c for c in members.columns if c != "lists"))


def pivots(lists: DataFrame) -> DataFrame:
    """(node, pivot): for each node of ``lists(value, node, best)`` the least ``best``, (rare, pivot), of all that it meets there."""
    best = lists.groupBy("value").agg(F.min("best").alias("best"))
    return lists.select("value", "node").join(best, "value").groupBy("node").agg(F.min("best").alias("best")).select("node", "best.pivot")


def open_lists(placed: DataFrame) -> DataFrame:
    """The rows of ``placed(value, node, comp, pivot, ...)`` in lists with two components that do not have one pivot.

    Components only grow, so a list that is dropped has nothing left to find."""
    of = placed.groupBy("value").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.min("pivot").alias("first"), F.max("pivot").alias("last"),
                                     F.count("pivot").alias("settled"), F.count(F.lit(1)).alias("members"))
    return placed.join(of.where("lo < hi and (settled < members or first < last)").select("value"), "value")


def differences(sets: DataFrame, of: DataFrame) -> DataFrame:
    """(node, pivot, n, other, diff): the values that either the node or its pivot holds, and the sizes of both sets.
    No row where they are less than half alike: then a difference is no smaller than the sets."""
    def run(batches):
        for batch in batches:
            rows = []
            for node, pivot, mine, its in zip(*(c.to_pylist() for c in batch.columns)):
                x, y = np.frombuffer(mine, np.int64), np.frombuffer(its, np.int64)
                diff = np.setxor1d(x, y, assume_unique=True)
                if 3 * len(diff) <= len(x) + len(y):
                    rows.append((node, pivot, len(x), len(y), diff))
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate([pa.int64()] * 4 + [pa.list_(pa.int64())])],
                                             ["node", "pivot", "n", "other", "diff"])

    heads = sets.join(of.select(F.col("pivot").alias("node")), "node", "left_semi")
    return (sets.join(of, "node").join(heads.select(F.col("node").alias("pivot"), F.col("hashes").alias("its")), "pivot")
            .select("node", "pivot", "hashes", "its").mapInArrow(run, "node bigint, pivot bigint, n bigint, other bigint, diff array<bigint>"))


def within(spark: SparkSession, comp: DataFrame, diffs: DataFrame, percent: int) -> DataFrame:
    """``comp`` after all links between nodes with one pivot."""
    # 100 * both >= percent * either, with both = (nx + ny - apart) / 2 and either = (nx + ny + apart) / 2
    alike = lambda size, apart: ((100 - percent) * size >= (100 + percent) * apart) & (apart < size)
    comp = grow(spark, comp, diffs.where(alike(F.col("n") + F.col("other"), F.size("diff")) & (F.col("node") != F.col("pivot")))
                .select(F.col("node").alias("a"), F.col("pivot").alias("b")))

    def links(side: DataFrame, condition: str) -> DataFrame:
        size, apart = F.col("x.n") + F.col("y.n"), F.size("x.diff") + F.size("y.diff")
        return (members.alias("x").join(side.alias("y"), F.expr("x.pivot = y.pivot and x.comp <> y.comp") & F.expr(condition)
                                        & alike(size, F.abs(F.size("x.diff") - F.size("y.diff")))
                                        & alike(size, apart - 2 * F.size(F.array_intersect("x.diff", "y.diff"))))
                .select(F.col("x.node").alias("a"), F.col("y.node").alias("b")))

    def placed() -> DataFrame:
        now = diffs.join(comp, "node").select("node", "pivot", "n", "diff", "comp")
        return cut(spark, now.join(comp.select(F.col("node").alias("pivot"), F.col("comp").alias("main")), "pivot"), "near-members")

    members = placed()
    next_ = members.where("node <> pivot").groupBy("pivot").agg(F.min(F.struct(F.size("diff").alias("apart"), "node")).alias("m")).select("m.node")
    comp = grow(spark, comp, links(members.join(next_, "node", "left_semi"), "true"))
    members = placed()
    # Whoever is not with the pivot, against all the others.
    return grow(spark, comp, links(members.where("comp <> main"), "(x.comp = x.main or x.node < y.node)"))


def grow(spark: SparkSession, comp: DataFrame, links: DataFrame) -> DataFrame:
    """(node, comp) after ``links``: components of the old components that the links join."""
    of = lambda x: comp.select(F.col("node").alias(x), F.col("comp").alias(f"c{x}"))
    joins = cut(spark, links.join(of("a"), "a").join(of("b"), "b").select(F.col("ca").alias("a"), F.col("cb").alias("b"))
                .where("a <> b").distinct(), "near-joins")
    if not joins.limit(1).count():
        return comp
    up = connected_components(spark, joins).select(F.col("id").alias("comp"), "component")
    return cut(spark, comp.join(up, "comp", "left").select("node", F.coalesce("component", "comp").alias("comp")), "near-comp")


def across(pairs: DataFrame, comp: DataFrame) -> DataFrame:
    """The pairs whose nodes lie in two components."""
    of = lambda x: comp.select(F.col("node").alias(x), F.col("comp").alias(f"c{x}"))
    return pairs.join(of("a"), "a").join(of("b"), "b").where("ca <> cb").select("a", "b")


def apart(pairs: DataFrame, settled: DataFrame) -> DataFrame:
    """The pairs whose nodes do not have one pivot in ``settled(node, pivot)``."""
    of = lambda x: settled.select(F.col("node").alias(x), F.col("pivot").alias(f"p{x}"))
    return pairs.join(of("a"), "a", "left").join(of("b"), "b", "left").where("pa is null or pb is null or pa <> pb").select("a", "b")


def ordered(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()


def work_off(spark: SparkSession, lists: DataFrame, comp: DataFrame, sketch: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """``comp`` after the links within long ``lists(value, node, pivot)``: by leaders, then across components; pairs with one pivot are settled."""
    two = "m.value = l.value and not (m.pivot <=> l.pivot and m.pivot is not null)"
    led = tried = None
    quota = LED
    while True:
        placed = cut(spark, lists.join(comp, "node"), "near-placed")
        placed = cut(spark, open_lists(placed), "near-open-lists")
        release(spark, "near-placed")
        lists = placed.drop("comp")
        open_ = placed
        if led is not None:
            done = led.join(placed, ["value", "node"]).select("value", "comp").distinct()
            open_ = open_.join(done, ["value", "comp"], "left_anti")
        first = open_.groupBy("value", "comp").agg(F.min(F.struct("node", "pivot")).alias("m"), F.count(F.lit(1)).alias("members")).select("value", "comp", "m.*", "members")
        by = Window.partitionBy("value")
        first = first.withColumn("rank", F.row_number().over(by.orderBy("node"))).withColumn("left", F.sum("members").over(by))
        few = first.where(F.col("left") <= LONG).select("value", "comp")
        leaders = cut(spark, first.where((F.col("left") > LONG) & (F.col("rank") <= quota)).select("value", "node", "comp", "pivot")
                      .unionByName(open_.join(few, ["value", "comp"]).select("value", "node", "comp", "pivot")), "near-leaders")
        if not leaders.limit(1).count():
            break
        pairs = ordered(placed.alias("m").join(leaders.alias("l"), F.expr(f"{two} and m.comp <> l.comp"))
                        .select(F.col("m.node").alias("x"), F.col("l.node").alias("y")))
        pairs = cut(spark, pairs.join(tried, ["a", "b"], "left_anti") if tried is not None else pairs, "near-led-pairs")
        comp = grow(spark, comp, verify(pairs, sketch, sets, percent))
        led = leaders.select("value", "node") if led is None else led.unionByName(leaders.select("value", "node"))
        tried = pairs if tried is None else tried.unionByName(pairs)
        quota *= 16  # the first leaders join most of a family; those after them find little
    if led is None:
        return comp
    # Members that never led, of components that meet in a list but are still apart.
    rest = cut(spark, placed.join(led, ["value", "node"], "left_anti"), "near-rest")
    pairs = ordered(rest.alias("m").join(rest.alias("l"), F.expr(f"{two} and m.comp < l.comp"))
                    .select(F.col("m.node").alias("x"), F.col("l.node").alias("y"))).join(tried, ["a", "b"], "left_anti")
    pairs = cut(spark, pairs, "near-rest-pairs")
    return grow(spark, comp, verify(pairs, sketch, sets, percent)) if pairs.limit(1).count() else comp


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS,
                    percent: int = PERCENT) -> DataFrame:
    """(id, n_shingles, component_id, kept) per row; links have 100 * both >= percent * either.

    Everything written on the way is removed; the result stays."""
    with temporary(docs.sparkSession) as keep:
        return keep(_near_duplicates(docs, id_col, text_col, words, percent), "near-components")


def _near_duplicates(docs: DataFrame, id_col: str, text_col: str, words: int, percent: int) -> DataFrame:
    spark = docs.sparkSession
    bounded_batches(spark)
    scanned = cut(spark, sketches(docs, id_col, text_col, words), "near-sketches")
    rows = cut(spark, scanned.select("id", "cls", "n"), "near-rows")
    worded = scanned.where("id is not null and cls is not null")
    first_rows = worded.groupBy("cls", "id").agg(F.count(F.lit(1)).alias("times")).groupBy("cls").agg(F.min(F.struct("id", "times")).alias("m"))
    reps = cut(spark, first_rows.select("cls", F.col("m.id").alias("rep"), "m.times").withColumn("node", F.monotonically_increasing_id()), "near-reps")
    least = worded.join(reps, "cls").where("id = rep").select("node", "rep", "cls", "times", "n", "least")
    least = cut(spark, least.where("times = 1").unionByName(least.where("times > 1").dropDuplicates(["node"])), "near-nodes")
    release(spark, "near-sketches")
    entries = least.select("node", F.explode("least").alias("value"))
    counted = cut(spark, entries.join(entries.groupBy("value").count().where("count > 1"), "value"), "near-counted")
    often = counted.where(F.col("count") > LONG).groupBy("node").agg(F.count(F.lit(1)).alias("often"))
    info = cut(spark, least.join(often, "node", "left").select(
        "node", "rep", "cls", "times", "n", F.coalesce("often", F.lit(0)).alias("often"), F.least("n", F.lit(LISTED)).alias("listed")), "near-info")
    side = lambda x: info.select(F.col("node").alias(x), F.col("n").alias(f"n{x}"), F.col("often").alias(f"often{x}"))
    pairs = (list_pairs(counted.where(F.col("count") <= LONG)).join(side("a"), "a").join(side("b"), "b")
             .where((100 * F.least("na", "nb") >= percent * F.greatest("na", "nb"))
                    & (3 * (F.col("shared") + F.least("oftena", "oftenb")) >= F.least(F.greatest("na", "nb"), F.lit(LISTED))))
             .select("a", "b"))
    pairs = cut(spark, pairs, "near-pairs")
    release(spark, "near-counted", "near-nodes")
    hot = F.col("often") * 3 >= F.col("listed")
    nodes = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).union(info.where(hot).select("node")).distinct()
    needed = cut(spark, info.join(nodes, "node").select("node", "rep", "cls", "times", hot.alias("hot")), "near-needed")
    with sifted(spark):  # few of the texts are needed
        sets = cut(spark, full_sets(docs, needed, id_col, text_col, words), "near-sets")
    sketch = sets.select("node", "sketch")
    # First each node with its least partner, then whatever pairs still lie in two components.
    first = cut(spark, pairs.groupBy("b").agg(F.min("a").alias("a")).select("a", "b"), "near-first")
    comp = connected_components(spark, verify(first, sketch, sets, percent)).select(F.col("id").alias("node"), F.col("component").alias("comp"))
    comp = cut(spark, sets.select("node").join(comp, "node", "left").select("node", F.coalesce("comp", "node").alias("comp")), "near-comp")
    more = pairs.join(first, ["a", "b"], "left_anti")
    some_hot = sets.where("hot").limit(1).count() > 0
    if some_hot:
        banded = cut(spark, bands(sets.where("hot")), "near-bands")
        sizes = cut(spark, banded.groupBy("value").count().where("count > 1"), "near-band-sizes")
        # One row per node: joins by node are as many as the nodes, not as their places in lists.
        banded = cut(spark, banded.join(sizes, "value").groupBy("node").agg(F.collect_list(F.struct("value", "count")).alias("lists")), "near-band-lists")
        release(spark, "near-bands", "near-band-sizes")
        # The most frequent values make a pivot; then whoever is still open takes the best pivot that its lists know.
        ranked = info.select("node", F.struct((F.col("listed") - F.col("often")).alias("rare"), F.col("node").alias("pivot")).alias("best"))
        diffs = cut(spark, differences(sets, cut(spark, pivots(spread(banded.join(ranked, "node"))), "near-pivots")), "near-differences")
        comp = within(spark, comp, diffs, percent)
        for moves in range(MOVES + 1):
            members = banded.join(comp, "node").join(diffs.select("node", "pivot"), "node", "left").withColumn("own", F.coalesce("pivot", "node"))
            members = cut(spark, members.join(ranked.select(F.col("node").alias("own"), "best"), "own").drop("own"), "near-band-members")
            lists = cut(spark, open_lists(spread(members)), "near-open")
            if moves == MOVES:
                break
            moved = (pivots(lists).join(diffs.select("node", F.col("pivot").alias("was")), "node", "left")
                     .where("was is null or was <> pivot").select("node", "pivot"))
            new = cut(spark, differences(sets, cut(spark, moved, "near-pivots")), "near-differences")
            if not new.limit(1).count():
                break
            diffs = cut(spark, diffs.join(new.select("node"), "node", "left_anti").unionByName(new), "near-differences")
            comp = within(spark, comp, diffs.join(new.select("pivot").distinct(), "pivot", "left_semi"), percent)
            banded = cut(spark, lists.groupBy("node").agg(F.collect_list(F.struct("value", "count")).alias("lists")), "near-open-nodes")
        settled = diffs.select("node", "pivot")
        release(spark, "near-band-lists", "near-band-members", "near-open-nodes")
        more = apart(across(more, comp), settled).union(open_pairs(lists.where(F.col("count") <= LONG)).join(first, ["a", "b"], "left_anti")).distinct()
    else:
        more = across(more, comp)
    comp = grow(spark, comp, verify(cut(spark, more, "near-across"), sketch, sets, percent))
    if some_hot:
        comp = work_off(spark, lists.where(F.col("count") > LONG).select("value", "node", "pivot"), comp, sketch, sets, percent)
    # From nodes to ids; an id with several texts joins their classes.
    named = cut(spark, comp.join(info.select("node", "rep"), "node"), "near-named")
    top = named.groupBy("comp").agg(F.min("rep").alias("top"))
    placed = cut(spark, rows.select("id", "cls", "n").join(reps.select("cls", "rep"), "cls", "left")
                 .join(named.join(top, "comp").select("rep", "top").groupBy("rep").agg(F.min("top").alias("top")), "rep", "left")
                 .select("id", "n", F.coalesce("top", "rep", "id").alias("top")), "near-tops")
    multi = placed.where("id is not null").groupBy("id").agg(F.min("top").alias("lo"), F.max("top").alias("hi")).where("lo < hi")
    multi = cut(spark, multi, "near-several")
    if multi.limit(1).count():
        joins = placed.join(multi.select("id", "lo"), "id").select(F.col("lo").alias("a"), F.col("top").alias("b"))
        up = connected_components(spark, joins).select(F.col("id").alias("top"), "component")
        placed = placed.join(up, "top", "left").select("id", "n", F.coalesce("component", "top").alias("top"))
    whole = placed.select("id", "n", F.when(F.col("id").isNotNull(), F.least("top", "id")).alias("component_id"))
    return whole.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), "component_id",
                        F.coalesce(F.col("id") == F.col("component_id"), F.lit(True)).alias("kept"))


def op9_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents, by shingles of four words."""
    return near_duplicates(table(spark, sf_dir, "documents"), words=4)
