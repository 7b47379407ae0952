"""Conversation structure repair at least cost, by Hirschberg's divide and conquer.

A conversation's rows, in the order of their turns, are edited until the first letters of their
roles read ``(s?(ua)+)?``.  Keep (K) costs 0, Rerole (R) to user or assistant 2, Delete (D) 3,
Insert (I) of an empty user or assistant row 2; an undeleted truncated row adds 1; blank and
duplicate rows must be deleted.  Four states say what has been emitted: nothing, the system row,
a user row last, an assistant row last.

A forward vector holds for each state the least cost of the rows so far and the rank of its least
audit among the states' audits.  Inserts go with the edit of the row they precede, so no two audits
of the same rows are prefixes of each other, and ranks decide ties as the whole audits would.  The
forward vector of the first half and the backward vector of the second meet mid-conversation; the
cheapest crossing with the least rank is fixed, and both halves recurse, in linear space.

Rows are range-partitioned by conversation and turn, so a conversation with any share of all rows
spans many tasks.  Only the first and last run of a partition can belong to such a conversation:
each is summed up as a 4 x 4 table of (cost, rank), two small rows a partition, and the same
divide and conquer over these tables fixes the states at the partition borders.  Then every task
reconstructs its own runs.

Edge cases: nulls in any column count as one space (a null turn sorts first and is left out of
``gaps``); rows of one turn are ordered by role, the first 100 characters of the text, and its
md5; equal rows are counted, not expanded, so repeated rows cannot fill a task.  A conversation without rows has
no report; an empty table gives an empty one.  Other columns are ignored.
The audit of a conversation is one string, and its digest is one sequential hash: both are as
long as the conversation by their definition.  The hash is streamed, never held.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from eventlake.llm.common import SPACE, bounded_batches, cut, table
from eventlake.session import checkpoint_root

NOTHING, SYSTEM, USER, ASSISTANT = range(4)
FAR = float("inf")
#: Least inserts that complete a conversation from each state.
TAIL = ("", "II", "I", "")
GOAL = tuple(2.0 * len(t) for t in TAIL)
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
#: Row classes: 2 * (place of the role's first letter in "sua", else 3) + truncated, or FORCED.
FORCED = 8


def follow(state: int, letter: str) -> int | None:
    """The state after emitting a row whose role begins with ``letter``."""
    if letter == "s":
        return SYSTEM if state == NOTHING else None
    if letter == "u":
        return None if state == USER else USER
    return ASSISTANT if letter == "a" and state == USER else None


def row_step(kind: int) -> tuple[dict[int, tuple[float, str]], ...]:
    """For each state before a row: {state after: (least cost, least audit piece)}."""
    steps = []
    for start in range(4):
        found: list[tuple[int, float, str]] = [(start, DELETE, "D")]
        state, inserts = start, 0
        while kind != FORCED and inserts < 3:
            late = kind % 2 * TRUNCATED + inserts * INSERT
            kept = follow(state, "sua?"[kind // 2])
            if kept is not None:
                found.append((kept, late, "I" * inserts + "K"))
            new = ASSISTANT if state == USER else USER
            found.append((new, late + REROLE, "I" * inserts + "R"))
            state, inserts = new, inserts + 1
        best: dict[int, tuple[float, str]] = {}
        for end, cost, piece in found:
            best[end] = min(best.get(end, (FAR, "")), (float(cost), piece))
        steps.append(best)
    return tuple(steps)


ROW_STEPS = [row_step(kind) for kind in range(FORCED + 1)]


def step_of(kind: int, copies: int) -> tuple:
    """The step of a row and of its further copies, which are duplicates and go."""
    extra = copies - 1
    if not extra:
        return ROW_STEPS[kind]
    return tuple({end: (cost + DELETE * extra, piece + "D" * extra) for end, (cost, piece) in best.items()} for best in ROW_STEPS[kind])


def forward(steps, start: int) -> list[tuple[float, int]]:
    """(least cost, rank of the least audit) for each state after ``steps``; (inf, -1) if out of reach."""
    vector = [(FAR, -1)] * 4
    vector[start] = (0.0, 0)
    for step in steps:
        found = [(FAR, -1, "")] * 4
        for state, (cost, rank) in enumerate(vector):
            if rank >= 0:
                for end, (more, piece) in step[state].items():
                    new = (cost + more, rank, piece)
                    if found[end][1] < 0 or new < found[end]:
                        found[end] = new
        order = sorted((e for e in range(4) if found[e][1] >= 0), key=lambda e: found[e][1:])
        vector = [(FAR, -1)] * 4
        for rank, end in enumerate(order):
            vector[end] = (found[end][0], rank)
    return vector


def backward(steps, goal) -> list[float]:
    """Least cost from each state before ``steps`` to the end, where ``goal`` prices the last state."""
    vector = list(goal)
    for step in reversed(steps):
        vector = [min((cost + vector[end] for end, (cost, _) in best.items()), default=FAR) for best in step]
    return vector


def exactly(state: int) -> tuple:
    return tuple(0.0 if s == state else FAR for s in range(4))


def crossings(steps, start: int, goal) -> list[int]:
    """The state after each step on the cheapest way, least audit first."""
    states: list[int] = []
    todo = [(0, len(steps), start, goal)]
    while todo:
        low, high, start, goal = todo.pop()
        if low == high:
            continue
        if high - low == 1:
            best = steps[low][start]
            states.append(min((cost + goal[end], key, end) for end, (cost, key) in best.items())[2])
            continue
        middle = (low + high) // 2
        first, second = forward(steps[low:middle], start), backward(steps[middle:high], goal)
        _, _, meet = min((cost + second[s], rank, s) for s, (cost, rank) in enumerate(first) if rank >= 0)
        todo += [(middle, high, meet, goal), (low, middle, start, exactly(meet))]
    return states


@lru_cache(maxsize=20_000)
def short_pieces(kinds: tuple, copies: tuple, start: int, goal: tuple) -> tuple:
    return pieces_of(kinds, copies, start, goal)


def pieces_of(kinds, copies, start: int, goal) -> tuple:
    """(cost, audit piece of each row, state before each row, state at the end)."""
    steps = [step_of(k, n) for k, n in zip(kinds, copies)]
    after = crossings(steps, start, goal)
    before = [start, *after[:-1]] if after else []
    taken = [step[s][e] for step, s, e in zip(steps, before, after)]
    return sum(c for c, _ in taken), [p for _, p in taken], before, after[-1] if after else start


def solve(kinds: list[int], copies: list[int], start: int = NOTHING, goal=GOAL) -> tuple:
    """As :func:`pieces_of`; short conversations of one shape are solved once."""
    if len(kinds) <= 32:
        return short_pieces(tuple(kinds), tuple(copies), start, tuple(goal))
    return pieces_of(kinds, copies, start, goal)


# --- rows -------------------------------------------------------------------

def plain(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text; null roles and texts as one space."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    return conversations.select("conv_id", F.col("turn").cast("long").alias("turn"), space("role").alias("role"), space("text").alias("text"))


def damage(conversations: DataFrame) -> DataFrame:
    """Rows with faults put in by crc32(conv_id:turn) % 20, a null as one space."""
    part = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    draw = F.crc32(F.concat(part("conv_id"), F.lit(":"), part("turn")).cast("binary")) % 20
    rows = plain(conversations).withColumn("draw", draw).where("draw <> 0")
    text = F.when(F.col("draw") == 1, "").when(F.col("draw") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("draw") == 4, "user").otherwise(F.col("role"))
    copies = F.explode(F.when(F.col("draw") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), copies.alias("copy")).drop("copy")


def ordered_rows(conversations: DataFrame) -> DataFrame:
    """Distinct rows with ``copies``, ``blank``, ``repeats`` (the first copy repeats an earlier row) and
    ``kind``, range-partitioned and sorted by conversation and turn, and checkpointed as they lie."""
    spark = conversations.sparkSession
    rows = plain(conversations).groupBy("conv_id", "turn", "role", "text").agg(F.count(F.lit(1)).alias("copies"))
    rows = cut(spark, rows.withColumn("words", F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"))), "conversation-rows")
    # Only words that occur in several turns of a conversation are joined back, one row for each.
    place = F.struct(F.col("turn").isNotNull().alias("known"), "turn")
    again = (rows.groupBy(F.col("conv_id").alias("again_id"), F.col("words").alias("again_words"))
             .agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("turns")).where("turns > 1"))
    same = F.col("conv_id").eqNullSafe(F.col("again_id")) & (F.col("words") == F.col("again_words"))
    blank = ~F.col("text").rlike(f"[^{SPACE}]")
    repeats = F.coalesce(place > F.col("first"), F.lit(False))
    cut_off = ~F.col("text").rlike(rf"[.!?][{SPACE}]*\z")
    letter = F.substring("role", 1, 1)
    place_of = F.when(letter == "s", 0).when(letter == "u", 1).when(letter == "a", 2).otherwise(3)
    marked = (rows.join(again, same, "left")
              .withColumns({"blank": blank, "repeats": ~blank & repeats, "letter": letter})
              .withColumn("kind", F.when(F.col("blank") | F.col("repeats"), FORCED).otherwise(2 * place_of + cut_off.cast("int")))
              .withColumn("head", F.substring("text", 1, 100)))
    order = [F.col(c).asc_nulls_first() for c in ("conv_id", "turn", "role", "head", "words")]
    checkpoint_root(spark)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    laid = marked.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    return laid.select("conv_id", "turn", F.col("role").cast("binary").alias("role"), F.col("text").cast("binary").alias("text"),
                       "copies", "blank", "repeats", "letter", "kind").checkpoint(eager=True)


def runs(batches, columns: list[str]):
    """(conv_id, {column: values}) of each run of rows of one conversation in a partition."""
    have, values = None, None
    for batch in batches:
        got = {c: batch.column(c).to_pylist() for c in ["conv_id", *columns]}
        for i, conv in enumerate(got["conv_id"]):
            if values is None or conv != have:
                if values is not None:
                    yield have, values
                have, values = conv, {c: [] for c in columns}
            for c in columns:
                values[c].append(got[c][i])
    if values is not None:
        yield have, values


def summaries(rows: DataFrame) -> list:
    """One row for the first and one for the last run of each partition: at most two a partition."""
    conv = rows.schema["conv_id"]
    schema = T.StructType([T.StructField("part", T.IntegerType()), conv, T.StructField("costs", T.ArrayType(T.DoubleType())),
                           T.StructField("ranks", T.ArrayType(T.IntegerType())), T.StructField("letter", T.StringType()), T.StructField("turn", T.LongType())])

    def run(batches):
        part, first, last = TaskContext.get().partitionId(), None, None
        for found in runs(batches, ["kind", "copies", "letter", "turn"]):
            first, last = first or found, found
        ends = [] if first is None else [first] if first is last else [first, last]
        for key, run in ends:
            steps = [step_of(k, n) for k, n in zip(run["kind"], run["copies"])]
            table = [cell for start in range(4) for cell in forward(steps, start)]
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([key], to_arrow_type(conv.dataType)),
                                              pa.array([[c for c, _ in table]], pa.list_(pa.float64())), pa.array([[r for _, r in table]], pa.list_(pa.int32())),
                                              pa.array([run["letter"][-1]]), pa.array([run["turn"][-1]], pa.int64())], schema.names)

    return rows.select("conv_id", "turn", "copies", "letter", "kind").mapInArrow(run, schema).collect()


def borders(ends: list) -> dict:
    """{(partition, conv_id): (state before, prices of the state after, last, letter and turn before)}
    of the runs of conversations that span partitions."""
    chains, fixed = [], {}
    for end in sorted(ends, key=lambda e: e.part):  # stable: a partition's first run comes before its last
        if chains and chains[-1][-1].part != end.part and chains[-1][-1].conv_id == end.conv_id:
            chains[-1].append(end)
        else:
            chains.append([end])
    for chain in chains:
        if len(chain) > 1:
            steps = [tuple({end: (e.costs[4 * s + end], e.ranks[4 * s + end]) for end in range(4) if e.ranks[4 * s + end] >= 0}
                           for s in range(4)) for e in chain]
            state, before = NOTHING, None
            for e, after in zip(chain, crossings(steps, NOTHING, GOAL)):
                last = e is chain[-1]
                fixed[e.part, e.conv_id] = (state, exactly(after), last, before and before.letter, before and before.turn)
                state, before = after, e
    return fixed


def repaired_run(run: dict, fixed) -> tuple:
    """(cost, audit, rows kept or made as (edit, role, text))."""
    start, goal, last = (NOTHING, GOAL, True) if fixed is None else fixed[:3]
    cost, pieces, before, state = solve(run["kind"], run["copies"], start, goal)
    out = []
    for piece, state_before, role, text in zip(pieces, before, run["role"], run["text"]):
        now = state_before
        for edit in piece:
            if edit in "IR":
                now = ASSISTANT if now == USER else USER
                out.append((edit, b"user" if now == USER else b"assistant", b"" if edit == "I" else text))
            elif edit == "K":
                out.append((edit, role, text))
    if last:
        cost, pieces = cost + GOAL[state], [*pieces, TAIL[state]]
        for _ in TAIL[state]:
            state = ASSISTANT if state == USER else USER
            out.append(("I", b"user" if state == USER else b"assistant", b""))
    return cost, "".join(pieces), out


REPORT = ("part int, spans boolean, least bigint, most bigint, turns bigint, blank bigint, duplicate bigint, truncated bigint, "
          "illegal bigint, cost bigint, audit string, repaired_sha256 string")


def run_reports(rows: DataFrame, fixed: dict) -> DataFrame:
    """One row per run: a whole conversation, or the part of one in a partition (``spans``)."""
    conv = rows.schema["conv_id"]
    schema = T.StructType([conv, *T.StructType.fromDDL(REPORT).fields])
    kinds = [to_arrow_type(f.dataType) for f in schema]

    def count(key, run, part):
        mine = fixed.get((part, key))
        cost, audit, out = repaired_run(run, mine)
        letter, turn = (None, None) if mine is None else mine[3:]
        illegal = 0
        for now, copies in zip(run["letter"], run["copies"]):
            illegal += (letter is not None and letter + now not in ("su", "ua", "au")) + copies - 1
            letter = now
        known = [t for t in run["turn"] if t is not None]
        blank = sum(n for n, b in zip(run["copies"], run["blank"]) if b)
        duplicate = sum(n - 1 + r for n, b, r in zip(run["copies"], run["blank"], run["repeats"]) if not b)
        sha = None if mine else hashlib.sha256(b"\n".join(role + b":" + text for _, role, text in out)).hexdigest()
        return (key, part, mine is not None, min(known, default=None), max(known, default=None), len(set(known) - {turn}), blank, duplicate,
                sum(k != FORCED and k % 2 for k in run["kind"]), illegal, int(cost), audit, sha)

    def run(batches):
        part, done = TaskContext.get().partitionId(), []
        for key, found in runs(batches, ["turn", "role", "text", "copies", "blank", "repeats", "letter", "kind"]):
            done.append(count(key, found, part))
            if len(done) >= 500:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*done), kinds)], schema.names)
                done = []
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*done), kinds)], schema.names)

    return rows.mapInArrow(run, schema)


def run_rows(rows: DataFrame, fixed: dict, only_spanning: bool = False) -> DataFrame:
    """(conv_id, part, place, edit, role, text) of the repaired conversations; (part, place) orders them."""
    conv = rows.schema["conv_id"]
    schema = T.StructType([conv, *T.StructType.fromDDL("part int, place bigint, edit string, role binary, text binary").fields])
    kinds = [to_arrow_type(f.dataType) for f in schema]

    def run(batches):
        part = TaskContext.get().partitionId()
        for key, found in runs(batches, ["role", "text", "copies", "kind"]):
            mine = fixed.get((part, key))
            if mine is None and only_spanning:
                continue
            out = repaired_run(found, mine)[2]
            for low in range(0, len(out), 2000):
                some = [(key, part, low + i, *row) for i, row in enumerate(out[low:low + 2000])]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*some), kinds)], schema.names)

    return rows.select("conv_id", "role", "text", "copies", "kind").mapInArrow(run, schema)


def streamed_hashes(rows: DataFrame) -> DataFrame:
    """(conv_id, repaired_sha256) from repaired rows: one pass over each conversation, nothing held."""
    conv = rows.schema["conv_id"]
    schema = T.StructType([conv, T.StructField("repaired_sha256", T.StringType())])

    def run(batches):
        have, digest = None, None
        for batch in batches:
            for key, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "role", "text"))):
                if digest is None or key != have:
                    if digest is not None:
                        yield pa.RecordBatch.from_arrays([pa.array([have], to_arrow_type(conv.dataType)), pa.array([digest.hexdigest()])], schema.names)
                    have, digest = key, hashlib.sha256()
                else:
                    digest.update(b"\n")
                digest.update(role + b":" + text)
        if digest is not None:
            yield pa.RecordBatch.from_arrays([pa.array([have], to_arrow_type(conv.dataType)), pa.array([digest.hexdigest()])], schema.names)

    return rows.repartition("conv_id").sortWithinPartitions("conv_id", "part", "place").select("conv_id", "role", "text").mapInArrow(run, schema)


def repair(conversations: DataFrame) -> DataFrame:
    """The repaired rows: conv_id, part, place, edit (K, R or I), role, text; (part, place) is their order."""
    bounded_batches(conversations.sparkSession)
    rows = ordered_rows(conversations)
    fixed = run_rows(rows, borders(summaries(rows)))
    return fixed.withColumns({"role": F.col("role").cast("string"), "text": F.col("text").cast("string")})


def report(conversations: DataFrame) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256 of each conversation."""
    spark = conversations.sparkSession
    bounded_batches(spark)
    rows = ordered_rows(conversations)
    fixed = borders(summaries(rows))
    found = run_reports(rows, fixed)
    if fixed:  # conversations that span partitions: a few rows a partition
        found = cut(spark, found, "conversation-reports")
        counts = [F.sum(c).alias(c) for c in ("turns", "blank", "duplicate", "truncated", "illegal", "cost")]
        audit = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("part", "audit"))), lambda x: x.audit), "")
        joined = (found.where("spans").groupBy("conv_id")
                  .agg(F.min("least").alias("least"), F.max("most").alias("most"), *counts, audit.alias("audit")))
        # A conversation of which no row is left has nothing to hash.
        hashes = streamed_hashes(run_rows(rows, fixed, only_spanning=True)).select(F.col("conv_id").alias("hash_id"), "repaired_sha256")
        joined = joined.join(hashes, F.col("conv_id").eqNullSafe(F.col("hash_id")), "left").drop("hash_id")
        joined = joined.withColumn("repaired_sha256", F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest())))
        found = found.where("not spans").drop("part", "spans").unionByName(joined)
    gaps = F.coalesce(F.col("most") - F.col("least") + 1 - F.col("turns"), F.lit(0)).cast("long")
    return found.select("conv_id", gaps.alias("gaps"), "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation damaged, then repaired; one without rows after the damage has zeros."""
    conversations = table(spark, sf_dir, "conversations")
    found = report(damage(conversations)).withColumnRenamed("conv_id", "found_id")
    every = conversations.select("conv_id").distinct()
    long = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c)
    return every.join(found, F.col("conv_id").eqNullSafe(F.col("found_id")), "left").select(
        "conv_id", *[long(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
        F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"))
