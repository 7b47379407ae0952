"""Packing token ids into windows by best-fit decreasing.

Each document's ids end in a separator id.  A document longer than the window is first cut
into full windows; the rests are packed, longest first, each into the open window with the
least remaining room that still holds it, found by a segment tree over remaining capacities.
Rests are dealt at random into shards of about ``shard_rests`` rests, packed in one task
each, so a shard's size stays bounded however large the corpus or however hot an id is.

A sequence is padded to the window, except that one whose length is a power of two stays
as it is; ``padding`` says how many pads its sequence gets.

Edge cases: a null or empty text is the separator alone; repeated rows are packed each;
strings that look like special tokens are ordinary text; an empty table gives no rows.

Ids are those of the ``tokenizers`` file given.  The same vocabulary as ranks is run by the
faster ``tiktoken``; texts with characters beyond Latin, Greek and Cyrillic letters and
common punctuation, whose classes could differ between Unicode versions, or with special tokens go to ``tokenizers``.
"""

from __future__ import annotations

import base64
import re
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from eventlake.llm.common import bounded_batches, cut, process_cache, table

WINDOW, SEPARATOR, SHARD_RESTS = 1024, 0, 50_000
TOKENIZER = "byte_bpe_50k"
#: Characters whose Unicode class has long been fixed; others are left to ``tokenizers``.
BEYOND = re.compile("[^\t\n\r\x20-\x7e\xa0-ɏΑ-ΡΣ-ωА-я–—‘-”•…€]")


def make_encoder(name: str = TOKENIZER):
    """A function from a text to its ids as unsigned 32-bit numbers."""
    cache = process_cache()
    if ("encoder", name) not in cache:
        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer
        with open(public_tokenizers.path(f"{name}.tiktoken"), "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        fast = tiktoken.Encoding(name, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        exact = Tokenizer.from_file(public_tokenizers.path(f"{name}.json"))
        special = [re.escape(t.content) for t in exact.get_added_tokens_decoder().values()]
        cache["encoder", name] = (fast, exact, re.compile("|".join([BEYOND.pattern, *special])))
    fast, exact, beyond = cache["encoder", name]

    def encode(text: str) -> np.ndarray:
        if beyond.search(text):
            return np.array(exact.encode(text, add_special_tokens=False).ids, "<u4")
        return np.array(fast.encode_ordinary(text), "<u4")

    return encode


def tokenise(docs: DataFrame, id_col: str, text_col: str, window: int = WINDOW, separator: int = SEPARATOR,
             tokenizer: str = TOKENIZER, with_ids: bool = False) -> DataFrame:
    """One row per piece: full windows and a rest; ``deal`` is a random number fixed on writing."""
    names = ["id", "start", "length", "ids_crc32", "doc_tokens", "deal"] + ["ids"] * with_ids
    tail = np.array([separator], "<u4")

    def run(batches):
        encode = make_encoder(tokenizer)
        rng = np.random.default_rng(TaskContext.get().partitionId())
        for batch in batches:
            keys, rows, ids = [], [], []
            for i, text in enumerate(batch.column(1).cast(pa.binary()).to_pylist()):
                found = np.concatenate([encode(text.decode("utf-8", "replace")), tail]) if text else tail
                raw, total = memoryview(found.tobytes()), len(found)
                for start in range(0, total, window):
                    length = min(window, total - start)
                    piece = raw[4 * start:4 * (start + length)]
                    keys.append(i)
                    rows.append((start, length, crc32(piece), total))
                    if with_ids:
                        ids.append(bytes(piece))
            numbers = np.array(rows, np.int64).reshape(-1, 4)
            arrays = [batch.column(0).take(pa.array(keys, pa.int64())), *(pa.array(numbers[:, c]) for c in range(4)),
                      pa.array(rng.integers(0, 1 << 62, len(rows)))] + ([pa.array(ids, pa.binary())] if with_ids else [])
            yield pa.RecordBatch.from_arrays(arrays, names)

    picked = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = picked.schema["id"].dataType.simpleString()
    return picked.mapInArrow(run, f"id {kind}, " + ", ".join(f"{c} bigint" for c in names[1:6]) + ", ids binary" * with_ids)


class OpenWindows:
    """Open windows by remaining capacity; a segment tree finds the tightest that fits."""

    def __init__(self, window: int):
        self.leaves = 1
        while self.leaves <= window:
            self.leaves *= 2
        self.filled = [0] * (2 * self.leaves)
        self.stacks: list[list[int]] = [[] for _ in range(window + 1)]

    def add(self, room: int, number: int) -> None:
        self.stacks[room].append(number)
        at = room + self.leaves
        while at:
            self.filled[at] += 1
            at //= 2

    def take(self, need: int) -> tuple[int, int] | None:
        """(room, window) with the least room of at least ``need``, removed; None if none fits."""
        at = need + self.leaves
        while not self.filled[at]:
            while at & 1:  # a right child: climb
                at //= 2
            if at == 0:
                return None
            at += 1
        while at < self.leaves:
            at = 2 * at if self.filled[2 * at] else 2 * at + 1
        room = at - self.leaves
        number = self.stacks[room].pop()
        while at:
            self.filled[at] -= 1
            at //= 2
        return room, number


def best_fit_decreasing(lengths: np.ndarray, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(window of each piece, offset in it, used length of each window)."""
    order = np.argsort(-lengths, kind="stable")
    tree, used = OpenWindows(window), []
    where, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    for i in order.tolist():
        size = int(lengths[i])
        found = tree.take(size)
        if found is None:
            number = len(used)
            used.append(0)
        else:
            number = found[1]
        where[i], offset[i] = number, used[number]
        used[number] += size
        if used[number] < window:
            tree.add(window - used[number], number)
    return where, offset, np.array(used, np.int64)


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, separator: int = SEPARATOR,
         tokenizer: str = TOKENIZER, shard_rests: int = SHARD_RESTS, with_ids: bool = False) -> DataFrame:
    """Pieces with ``sequence_id``, ``offset`` and the ``padding`` of their sequence."""
    spark = docs.sparkSession
    bounded_batches(spark)
    pieces = cut(spark, tokenise(docs, id_col, text_col, window, separator, tokenizer, with_ids), "packing-pieces")
    shards = max(1, -(-pieces.count() // shard_rests))

    def run(shard: pa.Table) -> pa.Table:
        where, offset, used = best_fit_decreasing(shard["length"].to_numpy(), window)
        number = shard["shard"][0].as_py()
        pads = np.where(used & (used - 1) == 0, 0, window - used)
        return (shard.drop_columns(["shard", "deal"]).append_column("sequence_id", pa.array((number << 32) + where))
                .append_column("offset", pa.array(offset)).append_column("padding", pa.array(pads[where])))

    dealt = pieces.withColumn("shard", F.pmod("deal", F.lit(shards)))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema.fields if f.name != "deal")
    packed = dealt.groupBy("shard").applyInArrow(run, f"{schema}, sequence_id bigint, offset bigint, padding bigint")
    return packed.withColumnRenamed("id", id_col)


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's pieces and their places."""
    return pack(table(spark, sf_dir, "documents"))
