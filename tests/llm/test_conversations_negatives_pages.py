"""Conversation repair, hard negatives and page text against brute force, and their edge cases."""

import hashlib
import html
import itertools
import random
import re
import zlib

import numpy as np
import pytest

from eventlake.llm import conversation_repair as repair, hard_negatives as negatives, html_text

SF = "/root/testdata/sf0.001"
CONV = "conv_id long, turn long, role string, text string, cost string, audit string, part int"


# 11 conversation repair
def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        draw = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if draw == 0:
            continue
        text = "" if draw == 1 else re.sub("[.!?]", "", text) if draw == 2 else text
        out += [(conv, turn, "user" if draw == 4 else role, text)] * (2 if draw == 3 else 1)
    return out


def sort_key(row):
    _, turn, role, text = row
    words = hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()
    return turn is not None, turn or 0, role.encode(), text[:100].encode(), words


def repaired_brute(rows):
    """The report of one conversation's rows, by a table over (row, state) of whole audits."""
    rows = sorted(rows, key=sort_key)
    seen, faults = set(), []
    for _, _, role, text in rows:
        words = re.sub("[\x20\x09-\x0d]", "", text)
        faults.append("blank" if not words else "duplicate" if (role, text) in seen else "truncated" if words[-1] not in ".!?" else "")
        seen.add((role, text))

    def emit(made, initial):
        return made + initial if re.fullmatch("(s?(ua)*u?)?", made + initial) else None

    def inserted(ways):  # every way, with inserts after it; two suffice to reach any state
        for _ in range(3):
            for (cost, audit, made, out) in list(ways):
                for role in ("user", "assistant"):
                    new = emit(made, role[0])
                    if new is not None:
                        ways.add((cost + 2, audit + "I", new, out + ((role, ""),)))
        return ways

    def pruned(ways):  # only what was emitted last matters
        best = {}
        for way in ways:
            state = "" if not way[2] else way[2][-1] + str(len(way[2]) > 1 or way[2] != "s")
            best[state] = min(best.get(state, way), way, key=lambda w: w[:2])
        return set(best.values())

    ways = {(0, "", "", ())}
    for (_, _, role, text), fault in zip(rows, faults):
        new = set()
        for cost, audit, made, out in inserted(ways):
            new.add((cost + 3, audit + "D", made, out))
            if fault not in ("blank", "duplicate"):
                late = fault == "truncated"
                kept = emit(made, role[:1]) if role[:1] in tuple("sua") else None
                if kept is not None:
                    new.add((cost + late, audit + "K", kept, out + ((role, text),)))
                for other in ("user", "assistant"):
                    changed = emit(made, other[0])
                    if changed is not None:
                        new.add((cost + 2 + late, audit + "R", changed, out + ((other, text),)))
        ways = pruned(new)
    done = [w for w in inserted(ways) if re.fullmatch("(s?(ua)+)?", w[2])]
    cost, audit, _, out = min(done, key=lambda w: w[:2])
    turns = {r[1] for r in rows if r[1] is not None}
    initials = [r[2][:1] for r in rows]
    return {"gaps": max(turns) - min(turns) + 1 - len(turns) if turns else 0, "blank": faults.count("blank"), "duplicate": faults.count("duplicate"),
            "truncated": faults.count("truncated"), "illegal": sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])),
            "cost": cost, "audit": audit, "repaired_sha256": hashlib.sha256("\n".join(f"{r}:{t}" for r, t in out).encode()).hexdigest()}


def by_conversation(rows):
    groups = {}
    for row in rows:
        groups.setdefault(row[0], []).append(row)
    return groups


def check_reports(spark, rows):
    frame = spark.createDataFrame([(*r, "x", "y", 1) for r in rows], CONV)
    found = {r.conv_id: r.asDict() for r in repair.report(frame).collect()}
    expected = {conv: repaired_brute([(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in mine]) for conv, mine in by_conversation(rows).items()}
    assert found.keys() == expected.keys()
    for conv, want in expected.items():
        assert {k: found[conv][k] for k in want} == want, (conv, by_conversation(rows)[conv])


def test_repair_of_all_short_role_sequences(spark):
    rows = [(n, turn, role, f"t{turn}.") for n, roles in enumerate(itertools.chain.from_iterable(
        itertools.product(("system", "user", "assistant", "tool"), repeat=k) for k in range(1, 5))) for turn, role in enumerate(roles)]
    check_reports(spark, rows)


def test_repair_of_random_conversations(spark):
    rng = random.Random(5)
    texts = ["a.", "b!", "cut", "", " \t", "é 😀?", "a.", None, "x" * 30000 + "."]
    rows = [(conv, rng.choice([0, 1, 2, 3, 5, 9, None]), rng.choice(["user", "assistant", "system", "", "tool", None, "s"]), rng.choice(texts))
            for conv in [*range(60), None] for _ in range(rng.randrange(1, 14))]
    check_reports(spark, rows)


def test_conversation_over_many_partitions(spark):
    rng = random.Random(6)
    rows = [(7, turn // 2, rng.choice(["user", "assistant", "user", "assistant", "system"]), rng.choice(["ok.", f"t{turn}.", f"t{turn}", " "])) for turn in range(900)]
    rows += [(conv, turn, ("user", "assistant")[turn % 2], f"c{turn}.") for conv in (*range(6), *range(8, 60)) for turn in range(4)]
    check_reports(spark, rows)
    frame = spark.createDataFrame([(*r, "x", "y", 1) for r in rows], CONV)
    found = repair.repair(frame).where("conv_id = 7").orderBy("part", "place").collect()
    assert len({r.part for r in found}) > 1  # it does span partitions
    text = "\n".join(f"{r.role}:{r.text}" for r in found)
    assert hashlib.sha256(text.encode()).hexdigest() == repaired_brute([r for r in rows if r[0] == 7])["repaired_sha256"]


def test_repeated_rows_and_deleted_conversations(spark):
    rows = [(1, 0, "user", "same.")] * 500 + [(2, 0, "system", " ")] * 300 + [(3, None, "assistant", "x.")] * 3
    check_reports(spark, rows)


def test_repair_query_on_damaged_table(spark):
    source = spark.read.parquet(f"{SF}/conversations.parquet")
    rows = [tuple(r) for r in source.select("conv_id", "turn", "role", "text").collect()]
    left = by_conversation(damaged(rows))
    found = {r.conv_id: r.asDict() for r in repair.op11_conversation_repair(spark, SF).collect()}
    assert found.keys() == {r[0] for r in rows}
    empty = {"gaps": 0, "blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0, "cost": 0, "audit": "", "repaired_sha256": hashlib.sha256().hexdigest()}
    for conv, row in found.items():
        want = repaired_brute(left[conv]) if conv in left else empty
        assert {k: row[k] for k in want} == want
    kept = sorted((r.conv_id, r.turn, r.role, r.text) for r in repair.damage(source).collect())
    assert kept == sorted(damaged(rows))


def test_repair_of_nothing(spark):
    assert repair.report(spark.createDataFrame([], CONV)).count() == 0
    assert repair.repair(spark.createDataFrame([], CONV)).count() == 0


# 12 hard negatives
VEC = "vec_id long, embedding array<double>, label int, rank string, negative_id string, score string"


def negatives_brute(rows, low=80, high=100):
    """rows: (id, label, integer vector)."""
    out = []
    for own, label, anchor in {i: (i, la, v) for i, la, v in sorted(rows, key=lambda r: (r[0], r[1], r[2]), reverse=True) if i % 100 == 0}.values():
        score = lambda v: sum(a * b for a, b in zip(anchor, v))
        others = [(i, la, score(v)) for i, la, v in rows if i != own and len(v) == len(anchor)]
        rank = lambda some: sorted(some, key=lambda r: (-r[1], r[0]))[:5]
        for positive, top in set(rank([(i, s) for i, la, s in others if la == label])):
            window = rank([(i, s) for i, la, s in others if la != label and low * top <= 100 * s <= high * top])
            out += [(own, positive, n + 1, i, top, s) for n, (i, s) in enumerate(window)]
    return sorted(out)


def mined(spark, rows, **options):
    frame = spark.createDataFrame([(i, v, la, "x", "y", "z") for i, la, v in rows], VEC)
    return sorted(tuple(r) for r in negatives.mine(frame, **options).collect())


@pytest.mark.parametrize("codes", [1, 5])
def test_negatives_against_brute_force(spark, codes):
    rng = np.random.default_rng(3)
    points = np.concatenate([rng.normal(size=(500, 6)) * 0.3, rng.normal(size=(200, 6)) * 0.05 + 0.5])
    rows = [(int(i), int(rng.integers(3)), [float(x) for x in p]) for i, p in enumerate(points)]
    rows += [(1000 + i, i % 2, [0.5] * 6) for i in range(150)]  # one very common vector
    rows += [(1, 0, rows[1][2]), (300, 1, [0.1] * 6), (300, 0, [0.2] * 6), (400, 0, [0.0] * 6)]
    whole = [(i, la, [int(np.floor(256 * x)) for x in v]) for i, la, v in rows]
    assert mined(spark, rows, shard_rows=200, block_rows=4, sample_rows=300, codes=codes) == negatives_brute(whole)


def test_negatives_take_no_broken_rows(spark):
    nan, inf = float("nan"), float("inf")
    fine = [(0, 0, [1.0, 1.0]), (1, 0, [1.0, 0.5]), (2, 1, [0.5, 0.9]), (3, 1, [0.9, 0.55])]
    broken = [(4, 1, None), (5, 1, [1.0, None]), (6, 1, [nan, 1.0]), (7, None, [1.0, 0.4]), (8, 1, [inf, 1.0]), (None, 1, [1.0, 0.4]), (9, 1, []),
              (10, 1, [1.0]), (11, 1, [1.0, 0.4, 0.0])]
    whole = [(i, la, [int(np.floor(256 * x)) for x in v]) for i, la, v in fine]
    assert mined(spark, fine + broken) == negatives_brute(whole) != []
    assert mined(spark, []) == []


def test_negatives_of_huge_components_are_exact(spark):
    rng = random.Random(4)
    rows = [(i, i % 2, [rng.uniform(0.5, 1) * 2.0 ** rng.choice([0, 20, 28]) for _ in range(4)]) for i in range(120)]
    whole = [(i, la, [int(np.floor(256 * x)) for x in v]) for i, la, v in rows]
    nearest = [(*r[:4], *(min(s, 2 ** 63 - 1) for s in r[4:])) for r in negatives_brute(whole)]
    assert mined(spark, rows, shard_rows=50) == sorted(nearest)
    with_one = [*rows, (500, 0, [1e200, -1e300, 3.0, 0.0])]
    whole.append((500, 0, [int(256 * x) for x in with_one[-1][2]]))
    clip = [(*r[:4], *(max(min(s, 2 ** 63 - 1), -2 ** 63) for s in r[4:])) for r in negatives_brute(whole)]
    assert mined(spark, with_one, shard_rows=50) == sorted(clip)


def test_negatives_query_matches_sql(spark):
    import duckdb
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{SF}/embeddings.parquet'")
    found = negatives.op12_hard_negatives(spark, SF)
    assert found.columns == [c[0] for c in con.execute(negatives.OP12_SQL).description]
    assert sorted(tuple(r) for r in found.collect()) == sorted(con.execute(negatives.OP12_SQL).fetchall()) != []


# 13 page text
PAGE = "page_id long, url string, html string, text string, n_chars string"


def texts(spark, pages):
    frame = spark.createDataFrame([(i, f"u{i}", p, "x", "y") for i, p in enumerate(pages)], PAGE)
    found = sorted(html_text.extract_text(frame).collect())
    assert [r.n_chars for r in found] == [len(r.text) for r in found] and [r.url for r in found] == [f"u{i}" for i in range(len(pages))]
    return [r.text for r in found]


def test_articles_of_the_table(spark):
    """Every article's blocks, as cut from the known layout of the pages."""
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    for row in html_text.op13_html_extraction(spark, SF).collect():
        article = re.search("<article>(.*)</article>", pages[row.page_id], re.S)[1].replace("<br>", " ")
        blocks = [" ".join(html.unescape(re.sub("<[^>]+>", "", b)).split()) for b in re.split("</?(?:h1|p)>", article)]
        assert row.text == "\n".join(b for b in blocks if b)


LONG = "A sentence of the article that goes on for a while, with commas and other things in it. "
FRAME = ("<html><head><title>T</title><style>p{{}}</style></head><body><div id=header><h2>Site</h2></div><ul class='menu'><li><a href=/a>a</a><li><a href=/b>b</a></ul>"
         "<div class=\"cookie-notice\"><p>We use cookies, please do agree to all of them, it will be good for us.</p></div>{}"
         "<div class=sidebar><p>Not this.</p></div><section id='comments'><article class=comment><p>" + "Great text, thank you. " * 60 + "</p></article></section>"
         "<form><label>Name</label><input name=q></form><script>var a = '<p>no</p>';</script><!-- no --><div class=\"site-footer\">&copy; all</div></body></html>")


def test_layouts_without_article_elements(spark):
    parts = [f"<div class=has-sidebar><div><h1>Title</h1><p>{LONG}</p><p>Short.</p><p>{LONG}<b>bold</b>ly</p><ul><li>one<li>two &amp; three</ul><div class='ad'>Buy</div></div></div>",
             f"<main><h1>Title</h1><p>{LONG * 9}<p>x</main>", f"<article><header><h1>T</h1></header><section><p>{LONG * 5}</section><section><p>Only this.</section><aside>no</aside></article>",
             f"<h1>Title</h1><p>{LONG}</p><blockquote>Quote</blockquote><p>{LONG}</p>"]
    line = LONG.strip()
    assert texts(spark, [FRAME.format(p) for p in parts]) == [
        f"Title\n{line}\nShort.\n{LONG}boldly\none\ntwo & three", f"Title\n{(LONG * 9).strip()}\nx", f"T\n{(LONG * 5).strip()}\nOnly this.", f"Title\n{line}\nQuote\n{line}"]


def test_titles_and_hidden_parts(spark):
    body = f"<p>{LONG}</p>"
    pages = [f"<body><main><h1>Title</h1><article>{body}<div class='cookieNotice'>no</div><p style='display: none'>no</p><ins class=adsbygoogle>no</ins></article></main></body>",
             f"<body><div><h1>Site</h1></div><h1>Old</h1><article><h1>Own</h1>{body}<div id=ad2>no</div><span aria-hidden=true>no</span></article></body>"]
    assert texts(spark, pages) == [f"Title\n{LONG.strip()}", f"Own\n{LONG.strip()}"]


def test_link_lists_lose_against_text(spark):
    links = "".join(f"<li><a href=/{i}>A link with quite some words in it, number {i}</a></li>" for i in range(60))
    page = f"<body><div><ul>{links}</ul></div><div><p>{LONG}</p><p>{LONG}</p></div></body>"
    assert texts(spark, [page]) == [f"{LONG.strip()}\n{LONG.strip()}"]


def test_odd_markup(spark):
    pages = [None, "", " \n", "plain &amp; text &am &#8212; &nbsp; x", "<p>a\n<b>b</b>\n<i>c</i>d<br>e", "<a href=x\">t</a> and 5 < 6 <b", "<!-- x <p>y", "<div>" * 30000 + "deep",
             "<p>one<p>two</p></p></div>three", "<script>no", "<table><tr><td>a<td>b<tr><td>c</table>", "<P CLASS='AD'>no</P><P>yes</P>", "x" * 300000, "<p>&#xD800;half"]
    assert texts(spark, pages) == ["", "", "", "plain & text &am — x", "a b cd e", "t and 5 < 6", "", "deep", "one\ntwo\nthree", "", "a b\nc", "yes", "x" * 300000, "�half"]
    assert html_text.extract_text(spark.createDataFrame([], PAGE)).count() == 0
    again = spark.createDataFrame([(None, None, "<p>x", "", "")] * 3, PAGE)
    assert [tuple(r) for r in html_text.extract_text(again).collect()] == [(None, None, "x", 1)] * 3


def test_hostile_pages_take_linear_time():
    for page in ("<a \"x" * 50000, "<a =\"" * 50000, "<!--" * 50000, "</b>" * 50000, "<b>" * 50000 + "</i>" * 50000, "<b>" * 30000 + "<p></p>" * 30000, "<td>" * 50000):
        html_text.main_text(page)
