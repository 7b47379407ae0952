"""Main text of web pages by composite text density.

A page's markup becomes a tree of elements.  For every element

    density = C / T * log(C / L * T / K, base = ln(C * L / (C - L) + C * Lb / Cb + e))

with C its characters, L those inside links, T its tags, K its link tags, Lb and Cb the body's; a
zero counts as one where it divides, and the base is 2 at least.  An element's density sum adds the densities of its children.
The element with the largest sum is the core of the article, and the least density on the path from
it up to the body is the threshold: below the body, every topmost element at or above the threshold
gives the element with the largest sum in its subtree, and the texts of all chosen are the article.
If an ``article`` or ``main`` element encloses the core, it is taken whole instead, with an ``h1`` just before
it if it holds none, so that short paragraphs beside the core are not lost; elsewhere headings, paragraphs, lists and tables beside a
chosen element are taken too if less than half of their text is links.

Elements that are never part of an article are cut first: by tag (scripts, styles, forms, menus,
footers, side notes, page headers) and by words in ``class``, ``id`` and ``role`` (adverts, notices,
reader comments and the like), unless they enclose an ``article`` or ``main`` element; forms and
elements cut by words also stay if they enclose an ``h1``.

Python turns one page at a time into one row inside ``mapInArrow``; nothing is shuffled, and a task
holds one batch of pages.  All passes over a tree are loops, so depth has no limit.

Edge cases: a null or empty html, or one without text, gives an empty text and 0 characters; unclosed, misnested and
cut-off markup is read as a browser would, roughly (a cut-off tag ends the text); repeated rows and null
ids are kept as they are; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from eventlake.llm.common import bounded_batches, table

# HTML element names by role.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Their content is text that is never shown; it ends at the element's own end tag alone.
RAW = frozenset("script style textarea title iframe noembed noframes xmp plaintext".split())
CUT = frozenset("script style textarea title iframe noembed noframes head template noscript svg math canvas object audio video "
                "form button select option datalist nav footer aside menu dialog".split())
BLOCK = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
                  "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre search section summary table tbody tfoot thead tr ul".split())
#: Cells and line breaks separate words, not blocks.
SPACED = frozenset("br td th".split())
WHOLE = frozenset(("article", "main"))
CUES = frozenset("ad ads adbox adsbygoogle adsense adunit advert adverts advertisement advertising banner sponsor sponsored promo promos promotion "
                 "cookie cookies cookiebar cookiebanner cookieconsent cookienotice consent gdpr notice notices notification alert popup modal overlay "
                 "comment comments commentlist respond responses replies discussion disqus feedback sidebar nav navbar navigation menu breadcrumb breadcrumbs "
                 "footer masthead share sharing social related recommended trending teaser teasers newsletter subscribe signup login pagination pager "
                 "toolbar skip-link copyright".split())
#: Cues of a page's head outside articles, unless one of the second set goes with them.
HEADS, HEADINGS = frozenset(("header", "topbar")), frozenset("article entry post story content".split())
#: Class words that begin so tell what an element goes with, not what it is.
ABOUT = ("has-", "with-", "no-", "without-", "is-")
#: Siblings of these names join a chosen element.
TEXTUAL = frozenset("h1 h2 h3 h4 h5 h6 p ul ol dl blockquote pre table figure".split())
ROLES = frozenset("navigation banner contentinfo complementary search alert alertdialog dialog menu menubar".split())
#: A start tag closes an open element of these names, unless one of the fences is met first.
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"),
          "option": ("option",), "tbody": ("tbody", "thead", "tr", "td", "th"), "tfoot": ("tbody", "thead", "tr", "td", "th")}
FENCES = frozenset("ul ol dl table select body html article section div main".split())

#: Comments, tags (a quote counts after "=" only; a tag without ">" ends before the next "<"), declarations.
TOKEN = re.compile(r"""<!--(?:>|->|.*?(?:--!?>|\Z))
  | <(?P<end>/)?(?P<name>[A-Za-z][^\s/><]*)(?P<attrs>(?:[^<>=]++|=\s*+(?:"[^"]{0,65536}+"|'[^']{0,65536}+')?)*+)(?:>|(?=<)|\Z)
  | <[!?/][^>]*+(?:>|\Z)""", re.S | re.X)
ATTRIBUTE = re.compile(r"""(?:^|[\s"'/])(class|id|role|style|aria-hidden|hidden)(?=[\s=/]|$)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
#: Words of a name: at hyphens, underscores and humps; a number at the end does not count.
SPLIT = re.compile(r"[\s_-]+")
HUMP, NUMBER, NOT_SHOWN = re.compile(r"(?<=[a-z])(?=[A-Z])"), re.compile(r"\d+$"), re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


class Tree:
    """Elements as parallel lists, in page order; a parent's number is below its children's."""

    def __init__(self):
        self.parent, self.name, self.cues = [-1], ["html"], [""]
        #: (element, text) in page order; None in place of a text ends a block.
        self.pieces: list[tuple[int, str | None]] = []

    def add(self, parent: int, name: str, attrs: str) -> int:
        self.parent.append(parent)
        self.name.append(name)
        self.cues.append(attrs)
        return len(self.parent) - 1


def parse(page: str) -> Tree:
    tree, stack, at = Tree(), [0], 0
    opened: Counter = Counter()  # open elements by name: no search for what is not open

    def close_to(depth: int) -> None:
        while len(stack) > depth:
            name = tree.name[stack.pop()]
            opened[name] -= 1
            if name in BLOCK:
                tree.pieces.append((stack[-1], None))
            elif name in SPACED:
                tree.pieces.append((stack[-1], " "))

    while at < len(page):
        found = TOKEN.search(page, at)
        if found is None:
            tree.pieces.append((stack[-1], page[at:]))
            break
        if found.start() > at:
            tree.pieces.append((stack[-1], page[at:found.start()]))
        at = found.end()
        if not found["name"]:
            continue
        name = found["name"].lower()
        if found["end"]:
            for depth in range(len(stack) - 1, 0, -1) if opened[name] else ():
                if tree.name[stack[depth]] == name:
                    close_to(depth)
                    break
                # An inline end tag does not reach beyond its block.
                if name not in BLOCK and tree.name[stack[depth]] in BLOCK:
                    break
            continue
        if name in BLOCK and opened["p"]:  # a block ends an open paragraph
            for depth in range(len(stack) - 1, 0, -1):
                if tree.name[stack[depth]] == "p":
                    close_to(depth)
                    break
                if tree.name[stack[depth]] in BLOCK:
                    break
        for depth in range(len(stack) - 1, 0, -1) if name in CLOSES else ():
            open_name = tree.name[stack[depth]]
            if open_name in CLOSES[name]:
                close_to(depth)
                if name not in ("tr", "tbody", "tfoot"):
                    break
            elif open_name in FENCES:
                break
        attrs = found["attrs"] or ""
        number = tree.add(stack[-1], name, attrs)
        if name in BLOCK or name in SPACED:
            tree.pieces.append((stack[-1], None if name in BLOCK else " "))
        if name in VOID:
            continue
        if name in RAW:
            end = re.compile(f"</{re.escape(name)}(?=[\\s/>])[^>]*>?", re.I).search(page, at)
            at = len(page) if end is None else end.end()
            continue
        stack.append(number)
        opened[name] += 1
    return tree


def cued(name: str, attrs: str) -> tuple[bool, bool]:
    """Whether an element's attributes call it something other than article text, or a page's head."""
    if not attrs or name in ("html", "body"):
        return False, False
    head = False
    for kind, a, b, c in ATTRIBUTE.findall(attrs):
        value, kind = a or b or c, kind.lower()
        words = value.lower().split()
        if kind == "hidden" or kind == "aria-hidden" and words == ["true"] or kind == "style" and NOT_SHOWN.search(value):
            return True, False
        if kind == "role" and ROLES.intersection(words):
            return True, False
        if kind in ("class", "id"):
            # An article's class list often says more than what it is: only whole words count there.
            parts = set(words)
            if name not in WHOLE:
                named = [w for w in HUMP.sub("-", value).lower().split() if not w.startswith(ABOUT)]
                parts = {NUMBER.sub("", p) for w in (*words, *named) if not w.startswith(ABOUT) for p in (w, *SPLIT.split(w))}
            if CUES & parts:
                return True, False
            head = head or bool(HEADS & parts) and not HEADINGS & parts
    return False, head


def cut_elements(tree: Tree) -> list[bool]:
    """Whether each element, or one around it, is cut."""
    n = len(tree.name)
    marked = [cued(name, attrs) for name, attrs in zip(tree.name, tree.cues)]
    holds, titled = [False] * n, [False] * n  # encloses an article that is not itself marked; an h1
    for i in range(n - 1, 0, -1):
        up = tree.parent[i]
        holds[up] = holds[up] or holds[i] or tree.name[i] in WHOLE and not marked[i][0]
        titled[up] = titled[up] or titled[i] or tree.name[i] == "h1"
    gone, inside = [False] * n, [False] * n
    for i in range(1, n):
        up, name = tree.parent[i], tree.name[i]
        inside[i] = inside[up] or name in WHOLE
        if gone[up] or name in RAW or name == "head":
            gone[i] = True
        elif not holds[i]:
            page_head = not inside[i] and (name == "header" or marked[i][1])
            gone[i] = page_head or name in CUT and name != "form" or (marked[i][0] or name == "form") and not titled[i]
    return gone


def densities(tree: Tree, gone: list[bool], sizes: list[int]) -> tuple[list[float], list[float], list[float]]:
    """(density, sum of the children's densities, share of characters in links) of every element."""
    n = len(tree.name)
    chars, tags, linked, links = list(sizes), [0] * n, [0] * n, [0] * n
    for i in range(n - 1, 0, -1):
        if gone[i]:
            continue
        up, is_link = tree.parent[i], tree.name[i] == "a"
        if is_link:
            linked[i] = chars[i]
        chars[up] += chars[i]
        linked[up] += linked[i]
        tags[up] += tags[i] + 1
        links[up] += links[i] + is_link
    of_body = linked[0] / max(chars[0], 1)
    density, total = [0.0] * n, [0.0] * n
    for i in range(n - 1, -1, -1):
        c, t, lc, lt = chars[i], max(tags[i], 1), linked[i], links[i]
        if not gone[i] and c:
            base = max(2.0, math.log(c * lc / max(c - lc, 1) + c * of_body + math.e))
            density[i] = c / t * math.log(max(1.0, c / max(lc, 1) * t / max(lt, 1)), base)
            if i:
                total[tree.parent[i]] += density[i]
    return density, total, [lc / max(c, 1) for c, lc in zip(chars, linked)]


def inside(tree: Tree, i: int, around: int) -> bool:
    while i > around:
        i = tree.parent[i]
    return i == around


def chosen_elements(tree: Tree, gone: list[bool], density: list[float], total: list[float], link_share: list[float]) -> set[int]:
    """The elements that make up the article; everything below them belongs to it."""
    n = len(tree.name)
    core = max((i for i in range(n) if not gone[i]), key=lambda i: (total[i], -i))
    path, i = [core], core
    while tree.parent[i] >= 0:
        i = tree.parent[i]
        path.append(i)
    whole = next((i for i in path if tree.name[i] in WHOLE), None)
    if whole is not None:
        # A title just before an article that has none belongs to it.
        before = [i for i in range(1, whole) if tree.parent[i] == tree.parent[whole] and tree.name[i] == "h1" and not gone[i]]
        titled = any(tree.name[i] == "h1" and inside(tree, i, whole) for i in range(whole + 1, n))
        return {whole} if titled else {whole, *before[-1:]}
    if tree.name[core] in ("body", "html"):
        return {core}
    threshold, around = min(density[i] for i in path), set(path[1:])
    peak = list(range(n))  # the element with the largest sum in each subtree
    for i in range(n - 1, 0, -1):
        up = tree.parent[i]
        if not gone[i] and total[peak[i]] >= total[peak[up]] and total[peak[i]] > total[up]:
            peak[up] = peak[i]
    chosen, under = {core}, [False] * n
    for i in range(1, n):
        under[i] = under[tree.parent[i]]
        if not (gone[i] or under[i] or i in around) and density[i] >= threshold and density[i] > 0:
            chosen.add(peak[i])
            under[i] = True
    beside = {tree.parent[i] for i in chosen}
    return chosen | {i for i in range(1, n) if not gone[i] and tree.parent[i] in beside and tree.name[i] in TEXTUAL and link_share[i] < 0.5}


def main_text(page: str | None) -> str:
    """The article's blocks, joined by line ends."""
    if not page:
        return ""
    tree = parse(page)
    gone = cut_elements(tree)
    pieces = [(i, html.unescape(s) if s and "&" in s else s) for i, s in tree.pieces]
    sizes = [0] * len(tree.name)
    for i, s in pieces:
        if s and not gone[i]:
            sizes[i] += len("".join(s.split()))
    chosen = chosen_elements(tree, gone, *densities(tree, gone, sizes))
    kept = [i in chosen and not gone[i] for i in range(len(tree.name))]
    for i in range(1, len(kept)):
        kept[i] = kept[i] or kept[tree.parent[i]] and not gone[i]
    blocks, line = [], []
    for i, s in [*pieces, (0, None)]:
        if s is None:
            blocks.append(" ".join("".join(line).split()))
            line = []
        else:
            line.append(s if kept[i] else " ")
    return "\n".join(b for b in blocks if b)


def extract_text(pages: DataFrame, id_col: str = "page_id") -> DataFrame:
    """page_id, url, text, n_chars of every row of ``pages``."""
    bounded_batches(pages.sparkSession)
    source = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                          F.col("html").cast("binary").alias("html"))

    def run(batches):
        for batch in batches:
            texts = [main_text(None if page is None else page.decode("utf-8", "replace")) for page in batch.column("html").to_pylist()]
            # A reference to half a surrogate pair has no UTF-8 form.
            texts = [t.encode("utf-8", "replace").decode() for t in texts]
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()),
                                              pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    return source.mapInArrow(run, "page_id bigint, url string, text string, n_chars bigint")


def op13_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return extract_text(table(spark, sf_dir, "pages"))
