"""Empty tables, clashing columns and a large family at the real settings."""

import itertools
import random

import pytest

import corpus_pipeline
from eventlake.llm import mixing, near_dedup, packing, passages, pii, quality_classifier, quality_rules, secrets, vector_search, warc
from eventlake.llm.common import _written, temporary, cut

DOC = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.mark.parametrize("run", [
    lambda s, d, m: pii.find_pii(d), lambda s, d, m: secrets.find_secrets(d), lambda s, d, m: packing.pack(d),
    lambda s, d, m: passages.find_passages(d), lambda s, d, m: near_dedup.near_duplicates(d), lambda s, d, m: mixing.mix(d),
    lambda s, d, m: mixing.mixed_rows(d), lambda s, d, m: secrets.redact(d),
    lambda s, d, m: corpus_pipeline.near_dedup(s, d, ""), lambda s, d, m: corpus_pipeline.secrets(s, d, ""),
    lambda s, d, m: corpus_pipeline.mixing(s, d, ""), lambda s, d, m: corpus_pipeline.packing(s, d, ""),
    lambda s, d, m: warc.round_trip(s.createDataFrame([], "page_id long, url string, html string")),
    lambda s, d, m: vector_search.search(m, m),
], ids=["pii", "secrets", "packing", "passages", "near_dedup", "mix", "mixed_rows", "redact", "stage near_dedup", "stage secrets", "stage mixing",
        "stage packing", "warc", "vector_search"])
def test_empty_tables_give_no_rows(spark, run):
    docs = spark.createDataFrame([], DOC)
    vectors = spark.createDataFrame([], "vec_id long, embedding array<double>, label int")
    assert run(spark, docs, vectors).count() == 0


def test_a_family_larger_than_the_long_list_limit(spark):
    """260 edits of one text, and of it edits of edits, beside unrelated texts; components as by brute force."""
    rng = random.Random(12)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(6))
    base = [word() for _ in range(160)]
    texts = [" ".join(base)]
    for n in range(260):
        start = base if n % 3 else texts[rng.randrange(len(texts))].split()
        edited = list(start)
        for _ in range(rng.randrange(1, 9)):
            edited[rng.randrange(len(edited))] = word()
        texts.append(" ".join(edited))
    texts += [" ".join(word() for _ in range(120)) for _ in range(40)] + [" ".join(base[:80] + [word() for _ in range(60)]) for _ in range(30)]
    sets = [{tuple(w[i:i + 4]) for i in range(len(w) - 3)} for w in (t.split() for t in texts)]
    top = list(range(len(texts)))

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    for a, b in itertools.combinations(range(len(texts)), 2):
        both = len(sets[a] & sets[b])
        if 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
            x, y = sorted((find(a), find(b)))
            top[y] = x
    frame = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in enumerate(texts)], DOC)
    found = {r.doc_id: r.component_id for r in near_dedup.near_duplicates(frame, words=4).collect()}
    assert found == {i: find(i) for i in range(len(texts))}
    assert len(set(found.values())) < 200 and sum(c == 0 for c in found.values()) > 100


def test_temporary_cuts_go_and_kept_ones_stay(spark):
    import os
    with temporary(spark) as keep:
        inner = cut(spark, spark.range(10), "inner")
        gone = inner.inputFiles()
        kept = keep(inner.where("id > 3"), "kept")
    assert kept.count() == 6 and not any(os.path.exists(f.removeprefix("file://").removeprefix("file:")) for f in gone) and not _written


def test_mixed_rows_agree_with_the_mix(spark):
    """Words taken per document are those that the rows hold, whatever the row's other columns are called."""
    rng = random.Random(3)
    rows = [(i, " ".join("w" for _ in range(rng.randrange(0, 30))), "en", rng.choice(["a", "b", "c", None]), 0, "x", "y") for i in range(300)]
    frame = spark.createDataFrame(rows, DOC + ", size string, taken string")
    out = mixing.mixed_rows(frame)
    assert out.columns == frame.columns
    sizes, taken = {}, {}
    for r in out.collect():
        taken[r.doc_id] = taken.get(r.doc_id, 0) + len(r.text.split())
        assert r.n_chars == 0 or r.n_chars == len(r.text)
    targets = {}
    for r in mixing.mix(frame).collect():
        targets[r.source] = r.target
        sizes[r.doc_id] = (r.source, r.size)
    for source, target in targets.items():
        assert abs(sum(taken.get(i, 0) for i, (s, _) in sizes.items() if s == source) - target) <= 1
    assert all(t <= 2 * sizes[i][1] for i, t in taken.items())


def test_classifier_and_rules_on_empty_documents(spark):
    docs, labels = spark.createDataFrame([], DOC), spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert quality_rules.quality_rules(docs, labels).count() == 0
    assert quality_classifier.classify(docs, labels).count() == 0
