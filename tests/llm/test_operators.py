"""Each training-data operator against brute force, a round trip or held-out accuracy, and its edge cases."""

import base64
import hashlib
import itertools
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from eventlake.llm import mixing, near_dedup, packing, passages, pii, quality_classifier, quality_rules, secrets, vector_search, warc
from eventlake.llm.common import SIFT, connected_components

SF = "/root/testdata/sf0.001"
DOC = "doc_id long, text string, lang string, source string, n_chars long, kept string, score string, row string"


def docs_of(spark, texts, ids=None, sources=None):
    ids = list(range(len(texts))) if ids is None else ids
    return spark.createDataFrame([(i, t, "en", (sources or ["s"] * len(texts))[n], len(t or ""), "x", "y", "z")
                                  for n, (i, t) in enumerate(zip(ids, texts))], DOC)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.read.parquet(f"{SF}/labels.parquet")


EDGE = [None, "", " \t\n", "one", "a b c d " * 400, "9" * 5000, "x" * 20000, "é ö 😀 word\nword\n\nword", "a b c d " * 400]


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


# 1 personal data
PII = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
       "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def pii_valid(kind, found):
    digits = [int(c) for c in found if c in "0123456789"]
    if kind == "ip":
        return all(int(p) <= 255 for p in found.split("."))
    if kind == "card":
        twice = [d if i % 2 == 0 else (2 * d if d < 5 else 2 * d - 9) for i, d in enumerate(reversed(digits))]
        return 13 <= len(digits) <= 19 and sum(twice) % 10 == 0
    return kind == "email" or 9 <= len(digits) <= 15


def pii_brute(text):
    return [f"{k}:{m.start()}:{m.end()}" for k, p in PII.items() for m in re.finditer(p, text or "") if pii_valid(k, m[0])]


def test_pii_base_spans(spark, docs):
    odd = EDGE + ["a@b.c_d@e.f x@y.z.", "1.2.3.4.5.6.7.8 999.1.1.1 0255.1.2.3", "4111 1111 1111 1111 4111-1111-1111-1111-", "+1 (234) 555-6789 +12",
                  "😀 a.b@c.de 😀 +49 30 1234567", "@@@ ++1 +1234567890123456"]
    both = docs_of(spark, odd).select("doc_id", "text").union(docs.select(F.col("doc_id") + 1000, "text"))
    found = {r.doc_id: r for r in pii.find_pii(both).collect()}
    for r in both.collect():
        spans = pii_brute(r.text)
        assert found[r.doc_id].base_sha256 == hashlib.sha256(",".join(spans).encode()).hexdigest()
        assert found[r.doc_id].n_email == sum(s.startswith("email") for s in spans)
        assert set(spans) <= set(found[r.doc_id].spans.split(",")) | {""}


def test_pii_bootstraps_contexts(spark):
    texts = [f"my phone number: +1 ({200 + i}) 555-{1000 + i} ok" for i in range(12)] + ["my phone number: 0171-5551234 ok", "the year 2024 was fine"]
    found = {r.doc_id: r for r in pii.find_pii(docs_of(spark, texts)).collect()}
    assert found[12].spans == "phone:17:29" and found[13].spans == ""


# 2 quality rules
def stats_brute(text):
    words, lines = words_of(text), [x for x in (text or "").split("\n") if words_of(x)]
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    twice = {w for w in windows if windows.count(w) > 1} if len(windows) < 3000 else {w for w, n in __import__("collections").Counter(windows).items() if n > 1}
    inside = {i + j for i, w in enumerate(windows) if w in twice for j in range(3)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(inside)


def test_quality_statistics(spark, docs, labels):
    both = docs_of(spark, EDGE).select("doc_id", "text", "lang").union(docs.select(F.col("doc_id") + 1000, "text", "lang"))
    found = {r.doc_id: r for r in quality_rules.quality_rules(both, labels).collect()}
    for r in both.collect():
        row = found[r.doc_id]
        want = stats_brute(r.text)
        assert (row.n_words, row.word_chars, row.n_symbols, row.n_dup_lines, row.n_repeat_words) == want
        assert row.base_failed == (want[0] < 50 or 100 * want[4] > 50 * want[0])


def test_quality_thresholds_keep_good(spark):
    rng = random.Random(2)
    good = [" ".join(f"w{rng.randrange(999)}" for _ in range(60)) for _ in range(3000)]
    bad = [" ".join(f"w{rng.randrange(999)}###" for _ in range(60)) for _ in range(300)]
    labels = spark.createDataFrame([(i, int(i < 3000)) for i in range(3300)], "doc_id long, quality int")
    out = quality_rules.quality_rules(docs_of(spark, good + bad), labels)
    assert out.where("doc_id >= 3000 and kept").count() == 0 and out.where("doc_id < 3000 and not kept").count() == 0


def test_binomial_tail():
    assert quality_rules.binomial_tail(0, 10, 0.1) == pytest.approx(0.9 ** 10)
    assert quality_rules.binomial_tail(10, 10, 0.1) == pytest.approx(1)


# 3 WARC
def test_warc_round_trip(spark):
    html = ["<p>a</p>", "<p>a</p>", None, "", "é" * 5000, "<p>a</p>", "x" * 3_000_000]
    pages = spark.createDataFrame([(9 - i, f"http://h/{i}\r\nx", h, "clash") for i, h in enumerate(html)], "page_id long, url string, html string, digest string")
    rows = {r.page_id: r for r in warc.round_trip(pages.repartition(2), file_bytes=2000).collect()}
    for i, h in enumerate(html):
        data = (h or "").encode()
        same = [9 - j for j, g in enumerate(html) if (g or "") == (h or "")]
        row = rows[9 - i]
        assert row.payload_digest == base64.b32encode(hashlib.sha1(data).digest()).decode() and row.payload_bytes == len(data)
        assert row.refers_to == (None if min(same) == 9 - i else min(same))
        assert (row.record_type, row.payload) == (("response", data) if row.refers_to is None else ("revisit", None))


def test_warc_reader_rejects_damage():
    record = warc.gzip_member(warc.response_record(1, "u", b"data", None, warc.DATE))
    read = lambda raw: list(warc.read_records(raw[i:i + 7] for i in range(0, len(raw), 7)))
    assert len(read(record * 3)) == 3
    plain = zlib.decompress(record, 31)
    for broken in (plain.replace(b"data", b"dat!"), plain.replace(b"data", b"dataa")):
        with pytest.raises(ValueError):
            read(warc.gzip_member(broken))
    with pytest.raises(Exception):
        read(record[:-9])


# 4 mixing
def test_mixing_targets(spark):
    rng = random.Random(3)
    texts = ["w " * rng.randrange(40) for _ in range(900)] + [None, ""]
    sources = [rng.choice(["a", "a", "a", "b", "c", None]) for _ in texts]
    docs = docs_of(spark, texts, sources=sources, ids=[i // 2 for i in range(len(texts))])
    rows = mixing.mix(docs).collect()
    assert len(rows) == len(texts) and sorted(map(tuple, rows), key=str) == sorted(map(tuple, mixing.mix(docs).collect()), key=str)
    sizes, taken, target = {}, {}, {}
    for r in rows:
        assert 0 <= r.taken <= 2 * r["size"]
        sizes[r.source] = sizes.get(r.source, 0) + r["size"]
        taken[r.source] = taken.get(r.source, 0) + r.taken
        target[r.source] = r.target
    weight = dict(zip(["a", "b", "c", None], itertools.cycle((5.0, 2.0, 1.0))))
    want, left = {}, 1.5 * sum(sizes.values())
    free = set(sizes)
    while free:
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = [s for s in free if share[s] > 2 * sizes[s]]
        want.update(share)
        if not over:
            break
        for s in over:
            want[s] = 2.0 * sizes[s]
            left -= want[s]
            free.discard(s)
    for s in sizes:
        assert target[s] == pytest.approx(want[s]) and abs(taken[s] - target[s]) <= 1
    mixed = mixing.mixed_rows(docs)
    assert mixed.columns == docs.columns and sum(len(words_of(r.text)) for r in mixed.collect()) == sum(taken.values())
    assert mixing.mix(docs.limit(0)).count() == 0


# 5 passages
def test_passages(spark):
    rng = random.Random(1)
    make = lambda n: [f"w{rng.randrange(5000)}" for _ in range(n)]
    shared, texts = make(60), []
    for i in range(30):
        p = list(shared)
        if i % 3 == 1:
            p[20], p[40] = "zz", "yy"
        if i % 3 == 2:
            p.insert(30, "new")
            del p[10]
        texts.append(" ".join(make(rng.randrange(200)) + p + make(rng.randrange(200))))
    plain = [" ".join(make(150)) for _ in range(30)]
    copies = [plain[0]] * 3
    short = [" ".join(shared[:30]), None, "", "w " * 300]
    rows = passages.find_passages(docs_of(spark, texts + plain + copies + short)).collect()
    met = {r.doc_id for r in rows} | {r.ref_doc_id for r in rows}
    assert met == set(range(30)) | {30, 60, 61, 62}
    for r in rows:
        if r.kind == "passage":
            assert len(set(words_of(texts[r.doc_id])[r.start_word:r.end_word]) & set(shared)) >= 50
    assert passages.find_passages(docs_of(spark, [None, ""])).count() == 0


def passage_rows(spark, texts):
    rows = passages.find_passages(docs_of(spark, [" ".join(t) for t in texts])).where("kind = 'passage'").collect()
    return [(r.doc_id, r.start_word, r.end_word, r.ref_doc_id, r.ref_start, r.ref_end, r.agreeing) for r in rows]


def made(seed):
    rng = random.Random(seed)
    return lambda n: [f"w{rng.randrange(50000)}" for _ in range(n)]


def evenly_edited(passage, every):
    return [f"edit{i}" if i % every == every - 1 else w for i, w in enumerate(passage)]


def test_passages_of_evenly_spread_edits(spark):
    """Every passage of 60 words that agrees in 0.8 or more is found, as brute-force alignment finds it."""
    make, texts = made(31), []
    for every in (5, 6, 8, 15):
        for _ in range(8):
            p = make(60)
            texts += [make(40) + p + make(40), make(70) + evenly_edited(p, every) + make(20)]
    rows = passage_rows(spark, texts)
    found = {frozenset(r[:1] + r[3:4]): r for r in rows}
    assert set(found) == {frozenset((i, i + 1)) for i in range(0, len(texts), 2)}
    for pair, r in found.items():
        a, b = texts[r[3]], texts[r[0]]
        lag = 30 if min(pair) == r[3] else -30  # of the passage in the other text
        agree = [i for i in range(len(a)) if 0 <= i + lag < len(b) and a[i] == b[i + lag]]
        assert r[6] == len(agree) and (r[4], r[5]) == (agree[0], agree[-1] + 1) and r[1] - r[4] == lag


def test_passages_apart_are_cut(spark):
    make, texts, n = made(32), [], 0
    for between in (50, 90, 200):
        head, foot = make(60), make(60)
        texts += [make(20) + head + make(between) + foot + make(20) for _ in range(3)]
    stray, p = make(8), make(60)  # a common run ahead of the passage
    texts += [make(20) + stray + make(40) + p + make(9), make(30) + stray + make(44) + p + make(5)]
    rows = passage_rows(spark, texts)
    for n in range(0, 9, 3):
        mine = [r for r in rows if r[0] // 3 * 3 == n and r[0] < 9]
        assert len(mine) == 6 and all(r[2] - r[1] == r[5] - r[4] == r[6] == 60 for r in mine)
    assert [r[6] for r in rows if {r[0], r[3]} == {9, 10}] == [60]


def test_passages_of_common_seeds(spark):
    """Two texts share a passage, exact or edited, whose every seed also stands in other texts, different ones for each."""
    make = made(33)
    exact, edited = make(60), make(60)
    texts = [make(30) + exact + make(30), make(9) + exact + make(60), make(30) + edited + make(30), make(9) + evenly_edited(edited, 6) + make(60)]
    for p, copies in ((exact, 40), (edited, 6)):
        for at in range(0, 57):
            texts += [make(30) + p[at:at + 4] + make(30) for _ in range(copies)]
    rows = passage_rows(spark, texts)
    assert {frozenset((r[0], r[3])) for r in rows} == {frozenset((0, 1)), frozenset((2, 3))}
    assert {r[6] for r in rows if r[0] < 2} == {60}


def test_list_pairs_of_long_lists():
    """Every text of a long list that holds the same longer run meets one reference; each text meets itself."""
    nodes = np.repeat(np.arange(50), 2)
    places = np.tile([3, 90], 50)
    runs = np.where(places == 3, nodes // 10 + 1, 0)
    a, b, words = passages.list_pairs(np.ones(100, np.int64), runs, nodes, places, 32, 4, 50)
    assert {(nodes[i], nodes[j]) for i, j, w in zip(a, b, words) if w == 50} >= {(n // 10 * 10, n) for n in range(50) if n % 10}
    assert {(nodes[i], places[i], places[j]) for i, j in zip(a, b) if nodes[i] == nodes[j]} == {(n, 3, 90) for n in range(50)}
    assert len(a) < 6 * 100


def test_passages_of_seeds_in_many_texts(spark, monkeypatch):
    """Two texts share an edited passage whose every seed also stands in 40 smaller or larger texts: lists longer than 32, also in blocks."""
    make = made(35)
    p = make(60)
    texts = [make(30) + p + make(30), make(9) + evenly_edited(p, 6) + make(60)]
    for at in range(0, 57, 3):
        texts += [make(30) + p[at:at + 6] + make(30) for _ in range(40)]
    found = []
    for block in (passages.BLOCK, 8):
        monkeypatch.setattr(passages, "BLOCK", block)
        found.append(sorted(passage_rows(spark, texts)))
    assert {frozenset((r[0], r[3])) for r in found[0]} == {frozenset((0, 1))} and found[0] == found[1]


def test_blocks_hold_the_whole_list():
    rng = np.random.default_rng(3)
    seeds = np.zeros(400, passages.PLACE)
    seeds["hash"], seeds["node"], seeds["run"] = np.repeat([1, 2], 200), np.tile(np.sort(rng.integers(0, 60, 200)), 2), rng.integers(0, 4, 400)
    seeds["at"] = np.arange(400)
    whole = passages.listed(seeds, None, 1024)
    assert [r[3] for r in whole] == ["whole"] and np.array_equal(np.frombuffer(whole[0][4], passages.PLACE), seeds)
    blocks = [r for r in passages.listed(seeds, None, 16) if r[3] == "block"]
    parts = [np.frombuffer(r[4], passages.PLACE) for r in blocks]
    assert np.array_equal(np.concatenate(parts), seeds) and len(blocks) > 8
    for n, part in enumerate(parts[1:]):
        assert part["hash"][0] != parts[n]["hash"][-1] or part["node"][0] != parts[n]["node"][-1]


def test_passages_in_rounds(spark, monkeypatch):
    """Seeds dealt out in rounds and joins made in rounds give the passages of one round, and no round makes them all."""
    rng = random.Random(8)
    shared = [f"s{rng.randrange(40)}" for _ in range(60)]
    texts = [" ".join([f"w{n}_{i}" for i in range(20)] + shared + [f"v{n}_{i}" for i in range(20)]) for n in range(6)]
    texts += [texts[0], None, "", " ".join(shared[:49])]
    docs = docs_of(spark, texts)
    whole = sorted(map(tuple, passages.find_passages(docs).collect()))
    made, seed_matches = [], passages.seed_matches

    def counted(*args):
        made.append(args[-1])
        return seed_matches(*args)

    monkeypatch.setattr(passages, "seed_matches", counted)
    for name, value in (("FLUSH", 100), ("ROUND_JOINS", 1000), ("JOIN_WORDS", 10 ** 6), ("PART_JOINS", 50)):
        monkeypatch.setattr(passages, name, value)
    assert sorted(map(tuple, passages.find_passages(docs).collect())) == whole and len(whole) > 15
    assert made[0] > 1 and len(made) == made[0]


def test_passages_repeated_in_one_text(spark):
    make = made(34)
    p, once, line = make(60), make(60), make(10)
    texts = [make(20) + once + make(100) + once + make(20),  # in one text alone
             make(10) + p + make(30), make(40) + p + make(80) + p + make(10),
             make(5) + line * 8 + make(9), make(25) + line * 9 + make(3)]  # a repeated short sentence
    rows = passage_rows(spark, texts)
    assert [r[:6] for r in rows if r[0] == 0] == [(0, 180, 240, 0, 20, 80)]
    covered = {(r[0], i) for r in rows for i in range(r[1], r[2])} | {(r[3], i) for r in rows for i in range(r[4], r[5])}
    assert {(2, i) for i in (*range(40, 100), *range(180, 240))} <= covered and (1, 10) in covered
    assert {(3, i) for i in range(5, 85)} <= covered and {(4, i) for i in range(25, 105)} <= covered
    assert all(r[5] <= r[1] for r in rows if r[0] == r[3])


def test_chain_is_collinear():
    x, y = np.array([0, 10, 20, 15, 300]), np.array([5, 15, 25, 2, 305])
    best = passages.chains(x, y)[0]
    assert best == [0, 1, 2]


# 6 classifier
def test_classifier(spark):
    docs, labels = spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    rows = quality_classifier.classify(docs, labels).join(labels.withColumnRenamed("quality", "truth"), "doc_id").where("held_out").collect()
    assert np.mean([r.predicted == r.truth for r in rows]) > 0.93
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    odd = quality_classifier.classify(docs_of(spark, EDGE, ids=[None, *range(1, len(EDGE))]), labels.limit(0)).collect()
    assert len(odd) == len(EDGE) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in odd)


def test_classifier_reads_long_words(spark):
    rng = random.Random(12)
    head = "".join(chr(0x4E00 + i) for i in range(40))
    good, bad = [chr(0x5000 + i) for i in range(60)], [chr(0x6000 + i) for i in range(60)]
    texts = [head + "".join(rng.choice(good if i % 2 else bad) for _ in range(200)) for i in range(600)]  # one word each
    labels = spark.createDataFrame([(i, i % 2) for i in range(600)], "doc_id long, quality int")
    rows = quality_classifier.classify(docs_of(spark, texts), labels).where("held_out").collect()
    assert np.mean([r.predicted == r.doc_id % 2 for r in rows]) > 0.95
    word = rng.randbytes(70_000).replace(b" ", b"x")
    parts = quality_classifier.word_buckets(word)
    counts, total = quality_classifier.long_word_buckets(word)
    assert total == len(parts) and counts == {b: parts.count(b) for b in rng.sample(parts, 50)} | counts


def test_classifier_sample_bounds_rows(spark):
    """One id with most of the rows: the training task still reads no more rows than the sample."""
    ids = [0] * 500 + list(range(1, 200))
    docs = docs_of(spark, [f"text number {i}" for i in range(len(ids))], ids=ids)
    labels = spark.createDataFrame([(i, i % 2) for i in range(200)], "doc_id long, quality int")
    rows = quality_classifier.training_rows(docs, labels, "doc_id", "text", "quality", 3, 1, 200).collect()
    assert len(rows) == 200 and len({r.order for r in rows}) > 20


# 7 packing
def test_packing(spark, docs):
    import public_tokenizers
    from tokenizers import Tokenizer
    exact = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    both = docs_of(spark, EDGE + ["日本語 text ǆ ﬁ", "a  b \n\n c   "]).select("doc_id", "text").union(docs.select(F.col("doc_id") + 1000, "text"))
    rows = packing.pack(both, shard_rests=60).collect()
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
    for r in both.collect():
        ids = np.array(exact.encode(r.text or "", add_special_tokens=False).ids + [0], "<u4")
        at = 0
        for p in sorted(by_doc[r.doc_id], key=lambda p: p.start):
            assert p.start == at and p.ids_crc32 == zlib.crc32(ids[at:at + p.length].tobytes()) and p.doc_tokens == len(ids)
            at += p.length
        assert at == len(ids)
    for pieces in by_sequence.values():
        at = 0
        for p in sorted(pieces, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= 1024 and pieces[0].padding == (0 if at & (at - 1) == 0 else 1024 - at)


def test_best_fit_decreasing():
    lengths = np.random.default_rng(1).integers(1, 1024, 2000)
    where, offset, used = packing.best_fit_decreasing(lengths)
    rooms, want = [], []
    for i in np.argsort(-lengths, kind="stable"):
        fits = [(room, n) for n, room in enumerate(rooms) if room >= lengths[i]]
        if fits:
            rooms[min(fits)[1]] -= lengths[i]
        else:
            rooms.append(1024 - lengths[i])
    assert len(rooms) == len(used) and used.sum() == lengths.sum()


# 8 secrets
SECRETS = {"assign": (r"""(?ia)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", lambda m: len(m[2]) >= 6),
           "access": (r"AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 20), "hex": (r"[0-9a-f]+", lambda m: len(m[0]) >= 24)}


def secrets_brute(text):
    found = [(m.start(), n, f"{k}:{m.start()}:{m.end()}") for n, (k, (p, fine)) in enumerate(SECRETS.items()) for m in re.finditer(p, text or "") if fine(m)]
    return [s for _, _, s in sorted(found)]


def test_secrets(spark, docs):
    odd = EDGE + ["é PassWord = 'abc123x' ſecret=abcdefg token:short", "x" + "AKIA" + "A" * 16 + "b", "deadbeef" * 3 + "g", "API_KEY: " + "0a" * 20, "ké token = \"ab.cd=ef\""]
    both = docs_of(spark, odd).select("doc_id", "text").union(docs.select(F.col("doc_id") + 1000, "text"))
    found = {r.doc_id: r for r in secrets.find_secrets(both).collect()}
    for r in both.collect():
        spans = secrets_brute(r.text)
        row = found[r.doc_id]
        assert row.base_sha256 == hashlib.sha256(",".join(spans).encode()).hexdigest()
        assert (row.n_assign, row.n_access, row.n_hex) == tuple(sum(s.startswith(k) for s in spans) for k in SECRETS)
        assert set(spans) <= set(row.spans.split(",")) | {""}


def test_secrets_markov_and_redaction(spark):
    rng = random.Random(4)
    token = lambda n: "".join(rng.choice("ABCDEFGHJKabcdefghjk0123456789") for _ in range(n))
    texts = [f"some very long_identifier and its name here password={token(24)} and more plain words" for _ in range(400)] + [
        f"the deploy id {token(32)} was used", "a very_long_identifier_name_2 in plain text", None, ""]
    docs = docs_of(spark, texts)
    found = {r.doc_id: r for r in secrets.find_secrets(docs).collect()}
    assert found[400].spans == "random:14:46" and found[401].spans == ""
    out = {r.doc_id: r.text for r in secrets.redact(docs).collect()}
    assert out[400] == "the deploy id [secret] was used" and out[0] == "some very long_identifier and its name here [secret] and more plain words"
    assert out[401] == texts[401] and out[402] is None and out[403] == ""


def test_secrets_of_letters_only(spark, docs):
    rng = random.Random(8)
    every, letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
    token = lambda n, chars: "".join(rng.choice(chars) for _ in range(n))
    texts = [f"some plain words and an uncharacteristically-long identifier name here password={token(24, every)} and more" for _ in range(400)]
    keys = [token(n, letters) for n in (16, 20, 32)] + [token(24, letters[26:])]
    plain = ["an internationalization/identifier in plain words", "uncharacteristically-long_identifier_name", "-" * 40]
    docs = docs_of(spark, texts + [f"the key {k} was used" for k in keys] + plain + [r.text for r in docs.select("text").collect()])
    found = {r.doc_id: r.spans for r in secrets.find_secrets(docs).collect()}
    out = {r.doc_id: r.text for r in secrets.redact(docs).collect()}
    for i, k in enumerate(keys):
        assert found[400 + i] == f"random:8:{8 + len(k)}" and out[400 + i] == "the key [secret] was used"
    assert [(found[404 + i], out[404 + i]) for i in range(3)] == [("", p) for p in plain]


# 9 near-duplicates
def components_brute(texts, size, percent=80):
    sets = {}
    for i, t in texts.items():
        w = [re.sub("[A-Z]", lambda m: m[0].lower(), x) for x in words_of(t)]
        sets[i] = {tuple(w[j:j + size]) for j in range(len(w) - size + 1)} if len(w) >= size else {tuple(w)} if w else set()
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for a, b in itertools.combinations(sorted(sets), 2):
        x, y = sets[a], sets[b]
        if x and y and 100 * len(x & y) >= percent * len(x | y):
            a, b = root(a), root(b)
            parent[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), root(i)) for i in sets}


def test_near_duplicates(spark, docs):
    texts = {r.doc_id + 1000: r.text for r in docs.select("doc_id", "text").collect()} | dict(enumerate(EDGE))
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string").withColumn("kept", F.lit("clash")).withColumn("n", F.lit(1))
    rows = near_dedup.near_duplicates(df, words=4).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == components_brute(texts, 4)
    assert all(r.kept == (r.doc_id == r.component_id) for r in rows)
    assert near_dedup.near_duplicates(df.limit(0)).count() == 0


def test_near_duplicates_long_lists(spark, monkeypatch):
    """A family of near copies around the threshold, and texts that share only a passage, with short lists at 6."""
    monkeypatch.setattr(near_dedup, "LONG", 6)
    rng = random.Random(6)
    make = lambda n: [f"v{rng.randrange(9000)}" for _ in range(n)]
    base, line = make(60), make(12)
    texts = {}
    for i in range(80):
        w = list(base)
        for _ in range(rng.randrange(4)):
            w[rng.randrange(60)] = f"m{rng.randrange(9000)}"
        texts[i] = " ".join(w)
    for i in range(80, 140):
        texts[i] = " ".join(make(rng.randrange(3, 9)) + line)
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    rows = near_dedup.near_duplicates(df, words=4).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == components_brute(texts, 4)


def test_near_duplicates_of_one_family_are_settled_by_their_pivot(spark, monkeypatch):
    """Near copies of one text, most below the threshold to most others: few pairs of whole sets are compared."""
    monkeypatch.setattr(near_dedup, "LONG", 6)
    rng = random.Random(9)
    base = [f"v{rng.randrange(9000)}" for _ in range(90)]
    texts = {}
    for i in range(150):
        w = list(base)
        for at in rng.sample(range(90), rng.choice([1, 1, 2, 3, 4, 6])):
            w[at] = f"m{rng.randrange(9000)}"
        texts[i] = " ".join(w)
    seen, verify = [], near_dedup.verify

    def counted(pairs, sketch, sets, percent):
        seen.append(pairs.count())
        return verify(pairs, sketch, sets, percent)

    monkeypatch.setattr(near_dedup, "verify", counted)
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    rows = near_dedup.near_duplicates(df, words=4).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == components_brute(texts, 4)
    assert sum(seen) < 10 * len(texts)


def test_short_band_lists_make_only_pairs_that_are_open(spark, monkeypatch):
    """A family whose bands are short lists: nearly all of its pairs have one pivot and one component, and are never made."""
    monkeypatch.setattr(near_dedup, "LONG", 6)
    rng = random.Random(11)
    base = [f"v{rng.randrange(9000)}" for _ in range(90)]
    texts = {}
    for i in range(60):
        w = list(base)
        for at in rng.sample(range(90), rng.choice([1, 1, 2, 3, 4])):
            w[at] = f"m{rng.randrange(9000)}"
        texts[i] = " ".join(w)
    seen, apart = [], near_dedup.apart

    def counted(pairs, settled):
        seen.append(pairs.count())
        return apart(pairs, settled)

    def long_lists_are_short(sets):
        monkeypatch.setattr(near_dedup, "LONG", 64)
        return bands(sets)

    bands = near_dedup.bands
    monkeypatch.setattr(near_dedup, "apart", counted)
    monkeypatch.setattr(near_dedup, "bands", long_lists_are_short)
    settings = [spark.conf.get(key, None) for key in SIFT]
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    rows = near_dedup.near_duplicates(df, words=4).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == components_brute(texts, 4)
    assert sum(seen) < 2 * len(texts)
    assert [spark.conf.get(key, None) for key in SIFT] == settings


def test_open_pairs_of_a_list(spark):
    rows = [(1, 10, 1, 5), (1, 11, 2, 5), (1, 12, 3, None), (1, 13, 3, None), (1, 14, 4, 6), (2, 20, 7, None), (2, 21, 7, 8)]
    pairs = near_dedup.open_pairs(spark.createDataFrame(rows, "value long, node long, comp long, pivot long"))
    assert sorted(map(tuple, pairs.collect())) == [(10, 12), (10, 13), (10, 14), (11, 12), (11, 13), (11, 14), (12, 14), (13, 14)]


def test_lists_without_an_open_pair_are_dropped(spark):
    rows = [(1, 10, 1, 5), (1, 11, 2, 5), (2, 10, 1, 5), (2, 12, 3, None), (3, 20, 7, None), (3, 21, 7, 8), (4, 10, 1, 5), (4, 14, 4, 6)]
    left = near_dedup.open_lists(spark.createDataFrame(rows, "value long, node long, comp long, pivot long"))
    assert sorted((r.value, r.node) for r in left.collect()) == [(2, 10), (2, 12), (4, 10), (4, 14)]


def test_pivots_are_the_best_of_all_lists(spark):
    rows = [(1, 10, (3, 10)), (1, 11, (1, 11)), (2, 10, (3, 10)), (2, 12, (0, 12)), (3, 13, (5, 13)), (3, 11, (1, 11))]
    found = near_dedup.pivots(spark.createDataFrame(rows, "value long, node long, best struct<rare: long, pivot: long>"))
    assert {tuple(r) for r in found.collect()} == {(10, 12), (11, 11), (12, 12), (13, 11)}


def test_two_families_of_one_text_come_to_have_one_pivot(spark, monkeypatch):
    """Copies on either side of a text: whoever is still open moves to a better pivot, and the components are those of all pairs."""
    monkeypatch.setattr(near_dedup, "LONG", 6)
    rng = random.Random(13)
    base = [f"v{rng.randrange(9000)}" for _ in range(90)]
    texts = {}
    for i in range(120):
        w = list(base)
        for at in rng.sample(range(0, 60) if i % 2 else range(30, 90), rng.choice([2, 3, 4, 5])):
            w[at] = f"m{rng.randrange(9000)}"
        texts[i] = " ".join(w)
    made, differences = [], near_dedup.differences
    monkeypatch.setattr(near_dedup, "differences", lambda sets, of: (made.append({tuple(r) for r in of.select("node", "pivot").collect()}), differences(sets, of))[1])
    rows = near_dedup.near_duplicates(spark.createDataFrame(list(texts.items()), "doc_id long, text string"), words=4).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == components_brute(texts, 4)
    assert len(made) > 1 and not made[0] & made[1]


def test_near_duplicates_repeated_and_null_ids(spark):
    rows = near_dedup.near_duplicates(docs_of(spark, ["a b c d e f", "a b c d e f", "x y z u v w", "q r s t p o", "x y z u v w"], ids=[7, 3, 3, None, 9])).collect()
    assert sorted((r.doc_id, r.component_id, r.kept) for r in rows if r.doc_id is not None) == [(3, 3, True), (3, 3, True), (7, 3, False), (9, 3, False)]
    assert [(r.component_id, r.kept) for r in rows if r.doc_id is None] == [(None, True)]


def test_components_of_a_chain(spark):
    edges = spark.createDataFrame([(i + 1, i) for i in range(5, 60)], "a long, b long")
    assert {tuple(r) for r in connected_components(spark, edges).collect()} == {(i, 5) for i in range(5, 61)}


# 10 vector search
def test_vector_search(spark):
    vectors = spark.read.parquet(f"{SF}/embeddings.parquet")
    rows = vector_search.search(vectors, vectors.where("vec_id % 20 = 0"), factor=1.0, shard_rows=150, block_rows=9).collect()
    table = vectors.toPandas()
    x, ids = np.array(table.embedding.tolist(), float), table.vec_id.to_numpy()
    got = {}
    for r in sorted(rows, key=lambda r: (r.query_id, r.rank)):
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    loose = {}
    for r in vector_search.search(vectors, vectors.where("vec_id % 20 = 0")).collect():
        loose.setdefault(r.query_id, set()).add(r.vec_id)
    hits = 0
    for q, found in got.items():
        scores = (x * x[ids == q][0]).sum(axis=1)
        order = [i for i in np.lexsort((ids, -scores)) if ids[i] != q][:20]
        assert [v for v, _ in found] == [ids[i] for i in order] and np.allclose([s for _, s in found], scores[order])
        hits += len(loose[q] & {ids[i] for i in order})
    assert len(got) == sum(i % 20 == 0 for i in ids) and hits >= 0.9 * 20 * len(got)


def test_vector_search_edge_cases(spark):
    nan = float("nan")
    rows = [(0, [1.0, 0.0]), (1, None), (2, []), (3, [0.0, 0.0]), (4, [nan, 1.0]), (5, [1.0, None]), (6, [2.0, 0.0]), (7, [2.0, 0.0]), (8, [1.0, 1.0, 1.0]),
            (None, [1.0, 0.0]), (9, [-1.0, 0.5]), (6, [2.0, 0.0])] + [(100 + i, [0.5, 0.0]) for i in range(400)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("score", F.lit("clash"))
    found = vector_search.search(df, df.where("vec_id in (0, 1, 3, 4, 8)"), factor=1.0).orderBy("rank").collect()
    assert [r.vec_id for r in found] == [6, 6, 7] + [100 + i for i in range(17)] and {r.query_id for r in found} == {0}


def test_components_leave_model_evaluation_usable(spark):
    """A model is evaluated before and after components in one session."""
    from eventlake.plans.catalog import QUERIES
    before = QUERIES["ml_7_30"](spark, SF).count()
    edges = spark.createDataFrame([(1, 2), (2, 3), (5, 6)], "a long, b long")
    assert sorted(tuple(r) for r in connected_components(spark, edges).collect()) == [(1, 1), (2, 1), (3, 1), (5, 5), (6, 5)]
    assert QUERIES["ml_7_30"](spark, SF).count() == before > 0


def test_packing_takes_special_strings_as_tokens(spark):
    import public_tokenizers
    from tokenizers import Tokenizer
    exact = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = ["a <|endoftext|> b", "<|endoftext|>" * 3, "no token <|end"]
    tokens = {r.doc_id: r.doc_tokens for r in packing.pack(docs_of(spark, texts)).collect()}
    assert tokens == {i: len(exact.encode(t, add_special_tokens=False).ids) + 1 for i, t in enumerate(texts)}


def test_search_beside_extreme_vectors(spark):
    rng = np.random.default_rng(8)
    points = [[float(x) for x in p] for p in rng.normal(size=(300, 4))] + [[1e200, 0.5, -1e200, 1.0], [1e-200, 0.0, 0.0, 0.0]]
    frame = spark.createDataFrame([(i, p) for i, p in enumerate(points)], "vec_id long, embedding array<double>")
    found = vector_search.search(frame, frame.where("vec_id % 60 = 0"), k=5, factor=1.0, shard_rows=100).collect()
    for query in range(0, 302, 60):
        scores = sorted(((-float(np.dot(points[query], p)), i) for i, p in enumerate(points) if i != query))[:5]
        assert [r.vec_id for r in sorted((r for r in found if r.query_id == query), key=lambda r: r.rank)] == [i for _, i in scores]
