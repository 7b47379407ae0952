"""Secret scan: fixed patterns, and character Markov models compared by log-likelihood ratio.

One pass over the texts finds the base spans and the candidates (runs of identifier
characters, ``MIN_LENGTH`` or longer, with a letter, outside base spans) and counts character
pairs.  Values of base spans are the labelled samples of random strings; all other text but the
candidates with a digit, which have no label, gives the samples of ordinary identifiers; pair counts of either, summed over all documents, give two
first-order Markov models.  A candidate is a further span when the ratio of its likelihoods
exceeds ``threshold`` nats and ``per_char`` nats a character.

Edge cases: a null or empty text has no spans; without any base span there is no model of
random strings and nothing is added; repeated rows are scanned each; spans are code points,
end exclusive.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from eventlake.llm.common import bounded_batches, cut, table

THRESHOLD, PER_CHAR, MIN_LENGTH = 8.0, 0.25, 16
#: Kinds in order, with their patterns and least lengths.
KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
ASSIGN_CHARS, ACCESS_CHARS = 6, 20
_HEX_BYTES = re.compile(rb"[0-9a-f]{24}")
_KEYWORDS = (b"passw", b"secret", b"token", b"api")
CANDIDATE = re.compile(rf"[A-Za-z0-9+/_=-]{{{MIN_LENGTH},}}")
_CANDIDATE_BYTES = re.compile(CANDIDATE.pattern.encode())
#: Symbols of the models: 0 is any character outside identifiers.
SYMBOLS = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_=-."
K = len(SYMBOLS) + 1
_CODE = np.zeros(256, np.int32)
for _i, _c in enumerate(SYMBOLS):
    _CODE[ord(_c)] = _i + 1


def base_spans(raw: bytes) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the fixed patterns, by start, then kind as listed."""
    lowered = raw.lower()
    wants = (any(k in lowered for k in _KEYWORDS), b"AKIA" in raw, _HEX_BYTES.search(raw) is not None)
    if not any(wants):
        return []
    text = raw.decode("utf-8", "replace")
    out = []
    if wants[0]:
        out += [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_CHARS]
    if wants[1]:
        out += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if len(m[0]) >= ACCESS_CHARS]
    if wants[2]:
        out += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    return sorted(out, key=lambda s: (s[0], KINDS.index(s[2])))


def secret_value(text: str, span: tuple[int, int, str]) -> str:
    found = text[span[0]:span[1]]
    return ASSIGN.match(found)[2] if span[2] == "assign" else found


def candidates(raw: bytes, spans: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    """(start, end, token) of identifier runs with a letter that touch no base span."""
    if not _CANDIDATE_BYTES.search(raw):
        return []
    text, out, i = raw.decode("utf-8", "replace"), [], 0
    for m in CANDIDATE.finditer(text):
        while i < len(spans) and spans[i][1] <= m.start():
            i += 1
        if any(c.isalpha() for c in m[0]) and not any(s[0] < m.end() and m.start() < s[1] for s in spans[i:i + 4]):
            out.append((m.start(), m.end(), m[0]))
    return out


def pair_counts(raw: bytes) -> np.ndarray:
    """Counts of neighbouring symbols, as K * first + second."""
    codes = _CODE[np.frombuffer(raw, np.uint8)]
    return np.bincount(codes[:-1] * K + codes[1:], minlength=K * K) if len(codes) > 1 else np.zeros(K * K, np.int64)


def scan(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Rows of two kinds: spans and candidates per document (cell null), pair counts per batch."""
    def run(batches):
        for batch in batches:
            raws = batch.column(1).cast(pa.binary()).to_pylist()
            spans, found, values, open_ = [], [], [], []
            for raw in raws:
                base = base_spans(raw) if raw else []
                more = candidates(raw, base) if raw else []
                if base:
                    text = raw.decode("utf-8", "replace")
                    values += [secret_value(text, s) for s in base]
                spans.append([f"{k}:{s}:{e}" for s, e, k in base])
                found.append([f"{s}:{e}:{t}" for s, e, t in more])
                open_ += [t for _, _, t in more if any(c.isdigit() for c in t)]
            n = len(raws)
            nulls = pa.nulls(n, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, pa.list_(pa.string())), pa.array(found, pa.list_(pa.string())),
                                              nulls, nulls, nulls], names)
            random = pair_counts((" " + " ".join(values) + " ").encode()) if values else np.zeros(K * K, np.int64)
            unlabelled = pair_counts((" " + " ".join(open_) + " ").encode()) if open_ else 0
            plain = pair_counts(b" ".join(r for r in raws if r)) - random - unlabelled
            cells = np.nonzero(plain | random)[0]
            empty = pa.nulls(len(cells), pa.list_(pa.string()))
            yield pa.RecordBatch.from_arrays([pa.nulls(len(cells), batch.schema.field(0).type), empty, empty, pa.array(cells, pa.int64()),
                                              pa.array(random[cells], pa.int64()), pa.array(plain[cells], pa.int64())], names)

    names = ["id", "spans", "found", "cell", "random", "plain"]
    picked = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = picked.schema["id"].dataType.simpleString()
    return picked.mapInArrow(run, f"id {kind}, spans array<string>, found array<string>, cell bigint, random bigint, plain bigint")


def markov_ratio(cells: list[int], random: list[int], plain: list[int]) -> np.ndarray | None:
    """log P(second | first) under random strings less that under ordinary text, K x K."""
    counts = np.zeros((2, K * K))
    counts[0, cells], counts[1, cells] = random, np.maximum(plain, 0)
    if not counts[0].sum():
        return None
    tables = counts.reshape(2, K, K) + 0.5
    logs = np.log(tables / tables.sum(axis=2, keepdims=True))
    return logs[0] - logs[1]


def likelihood_ratio(token: str, ratio: np.ndarray) -> float:
    codes = _CODE[np.frombuffer(f" {token} ".encode("latin-1", "replace"), np.uint8)]
    return float(ratio[codes[:-1], codes[1:]].sum())


def learn(scanned: DataFrame) -> np.ndarray | None:
    """The ratio table of both models from the pair counts of ``scan``."""
    cells = scanned.where("cell is not null").groupBy("cell").agg(F.sum("random").alias("r"), F.sum("plain").alias("p")).collect()
    return markov_ratio([c["cell"] for c in cells], [c["r"] for c in cells], [c["p"] for c in cells])


def is_random(token: str, ratio: np.ndarray | None, threshold: float, per_char: float) -> bool:
    if ratio is None:
        return False
    value = likelihood_ratio(token, ratio)
    return value >= threshold and value >= per_char * len(token)


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD,
                 per_char: float = PER_CHAR) -> DataFrame:
    """Per document row: counts and digest of the base spans, and all spans with the added ones."""
    spark = docs.sparkSession
    bounded_batches(spark)
    scanned = cut(spark, scan(docs, id_col, text_col), "secrets-scan")
    ratio = learn(scanned)

    def run(batches):
        rank = {k: i for i, k in enumerate((*KINDS, "random"))}
        for batch in batches:
            rows = []
            for base, found in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                kinds = [s.split(":")[0] for s in base]
                more = [f"random:{start}:{end}" for start, end, token in (c.split(":", 2) for c in found)
                        if is_random(token, ratio, threshold, per_char)]
                every = sorted(base + more, key=lambda s: (int(s.split(":")[1]), rank[s.split(":")[0]]))
                rows.append((*(kinds.count(k) for k in KINDS), hashlib.sha256(",".join(base).encode()).hexdigest(), ",".join(every), len(more)))
            if rows:
                columns = [pa.array(c, t) for c, t in zip(zip(*rows), [pa.int64()] * 3 + [pa.string()] * 2 + [pa.int64()])]
                yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names)

    names = ["id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_random"]
    kind = scanned.schema["id"].dataType.simpleString()
    out = scanned.where("cell is null").select("id", "spans", "found").mapInArrow(
        run, f"id {kind}, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string, n_random bigint")
    return out.withColumnRenamed("id", id_col)


def masked(raw: bytes, ratio: np.ndarray | None, by: str, threshold: float, per_char: float) -> str | None:
    """The text with its spans replaced (overlapping ones as one), or None if it has none."""
    base = base_spans(raw)
    spans = sorted([(s, e) for s, e, _ in base] + [(s, e) for s, e, t in candidates(raw, base) if is_random(t, ratio, threshold, per_char)])
    if not spans:
        return None
    text, out, at = raw.decode("utf-8", "replace"), [], 0
    for start, end in spans:
        if start >= at:
            out += [text[at:start], by]
        at = max(at, end)
    return "".join(out) + text[at:]


def redact(docs: DataFrame, text_col: str = "text", by: str = "[secret]", threshold: float = THRESHOLD,
           per_char: float = PER_CHAR) -> DataFrame:
    """The rows of ``docs`` with every secret in ``text_col`` replaced; other columns stay."""
    spark = docs.sparkSession
    bounded_batches(spark)
    ratio = learn(cut(spark, scan(docs.withColumn("__none", F.lit(0)), "__none", text_col).where("cell is not null"), "secrets-pairs"))
    place = docs.columns.index(text_col)

    def run(batches):
        for batch in batches:
            column = batch.column(place)
            new = [raw and masked(raw, ratio, by, threshold, per_char) for raw in column.cast(pa.binary()).to_pylist()]
            if any(new):
                text = pa.array([old if n is None or n == b"" else n for n, old in zip(new, column.to_pylist())], column.type)
                batch = batch.set_column(place, batch.schema.field(place), text)
            yield batch

    return docs.mapInArrow(run, docs.schema)


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document."""
    return find_secrets(table(spark, sf_dir, "documents"))
