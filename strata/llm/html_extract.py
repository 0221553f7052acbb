"""Main text of HTML pages (operator 7): flat text blocks judged by a decision tree.

A page is cut into flat text blocks at block-level tags. Each block carries its
word count and link density, those of its neighbours, and what the markup
around it says (inside an article, inside a menu/footer/side container, heading,
list entry). A decision tree, grown here on the small labelled table below,
says which blocks are main text.

Containers are told by their tag and by whole tokens of class, id, role and label:
``sidebar`` and ``comment-list`` mark a side container, ``has-sidebar``,
``legal-news`` and ``social-policy`` do not, since a word beside the side word says
something else. A token that also names the main text or a wrapper
(``content-sidebar-wrap``) is weak: a main container inside it counts as main again.
Inside comments, menus, footers and the like nothing does.

Tags are read by the rules for attributes: a stray quote is part of a name or an
unquoted value. Text of inline media and formulas belongs to its block.

No shuffle: a page is judged in the task that reads it.

Defined results: null or empty html gives the empty text; a page without any
main block gives the empty text; unclosed tags and comments run to the end of
their container or page; repeated rows are judged row by row; other columns are
ignored.
"""

from __future__ import annotations

import html
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import table

#: attributes: names may hold quotes; a value is quoted, or runs to the next space
ATTRS = r"(?:[\s/]++|=?[^\s/>=]++(?:\s*+=\s*+(?:\"[^\"]*+\"|'[^']*+'|[^\s>\"'][^\s>]*+|(?=>)))?+|=)*+"
# one pattern for everything that starts with "<": comments, raw-text elements, tags, declarations
TOKEN = re.compile(
    r"<(?:!--(?:>|.*?(?:--!?>|\Z))"
    r"|(?P<raw>script|style|noscript|template|textarea|title|iframe|select|option|button)(?=[\s/>])" + ATTRS + r"(?:(?<=/)>|>.*?(?:</(?P=raw)\s*>|\Z))"
    r"|(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attr>" + ATTRS + r")>"
    r"|[!?/][^>]*>)", re.S | re.I)
HINT = re.compile(r"(?:^|(?<=[\s/\"']))(class|id|role|aria-label)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)

# Tags that end a text block
BLOCK = frozenset("""address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption
figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre section
summary table tbody td tfoot th thead tr ul caption""".split())
# Containers whose nesting is tracked
CONTAINER = frozenset("""article aside blockquote dialog div dl fieldset figure footer form header head main menu nav
ol section table td ul details""".split())
# Containers that never hold main text
SIDE = frozenset("nav footer aside form menu dialog head fieldset".split())
# Words of class, id or role that mark such containers
SIDE_WORD = frozenset("""ad ads advert adverts advertisement advertising adbox adslot sponsor sponsored promo promotion
banner sidebar side widget comment comments reply replies respond discussion disqus cookie cookies consent gdpr notice
notices alert newsletter subscribe subscription signup login share sharing social related recommended recommendations
menu menubar nav navbar navigation breadcrumb breadcrumbs pagination pager footer foot masthead topbar toolbar popup
modal overlay legal copyright skip search searchbox tags tagcloud toc trackback complementary contentinfo form""".split())
MAIN_WORD = frozenset("article main content story post entry articlebody postbody body text".split())
# Words that name a place or a shape and leave a token's meaning alone
PLACE_WORD = frozenset("""list lists box block section area left right top bottom upper lower site page global primary secondary
links link item items bar posts articles stories title heading head form inner row column col panel holder module region
zone slot unit thread count more buttons button icons icon us this fixed sticky mobile desktop large small
wide narrow first last 1 2 3""".split())
# Words of wrappers, which hold main text as well as what stands beside it
WRAP_WORD = frozenset("wrap wrapper wrapping container outer layout grid columns holder".split())
# Reader comments and the like, whatever else a token says, unless it only says that there are some
COMMENT_WORD = frozenset("comment comments disqus replies gdpr advertisement breadcrumb breadcrumbs".split())
STATE_WORD = frozenset("has no with without hide show open closed allow enable enabled disable disabled off on".split())

# The labelled table. Columns: words, link density, words and link density of the block before
# and after, inside a side container, inside a main container, heading, list entry; label 1 is main text.
LABELLED = np.array([
    # paragraphs and headings of articles, long and short
    (120, .00, 8, .00, 90, .00, 0, 1, 0, 0, 1), (60, .05, 120, .00, 40, .10, 0, 1, 0, 0, 1), (1, .00, 60, .00, 30, .00, 0, 1, 0, 0, 1),
    (3, .00, 1, 1.0, 80, .00, 0, 1, 1, 0, 1), (9, .00, 12, .00, 120, .00, 0, 1, 1, 0, 1), (25, .30, 60, .00, 20, .00, 0, 1, 0, 0, 1),
    (2, .00, 3, .00, 2, .00, 0, 1, 0, 0, 1), (14, .00, 20, .00, 13, .00, 0, 1, 0, 1, 1), (6, .00, 9, .00, 7, .00, 0, 1, 0, 1, 1),
    (40, .10, 14, .00, 0, .00, 0, 1, 0, 0, 1), (300, .02, 9, .00, 0, .00, 0, 1, 0, 0, 1), (5, .00, 0, .00, 0, .00, 0, 1, 0, 0, 1),
    (8, .00, 300, .00, 4, .00, 0, 1, 0, 0, 1), (1, .00, 1, .00, 1, .00, 0, 1, 1, 0, 1), (18, .50, 40, .00, 30, .00, 0, 1, 0, 0, 1),
    (70, .00, 5, .00, 0, .00, 0, 1, 0, 0, 1), (12, .00, 1, .00, 12, .00, 0, 1, 0, 0, 1), (4, 1.0, 60, .00, 50, .00, 0, 1, 0, 0, 1),
    # the same beside link lists, adverts and comments
    (21, .00, 20, .00, 11, 1.0, 0, 1, 0, 0, 1), (18, .00, 9, 1.0, 24, .00, 0, 1, 0, 0, 1), (6, .00, 4, 1.0, 5, 1.0, 0, 1, 0, 0, 1),
    (35, .10, 3, 1.0, 12, .90, 0, 1, 0, 0, 1), (2, .00, 1, 1.0, 30, .00, 0, 1, 1, 0, 1), (11, .00, 25, .00, 2, 1.0, 0, 1, 0, 1, 1),
    # main text of pages without a main container
    (80, .00, 7, .00, 60, .00, 0, 0, 0, 0, 1), (45, .05, 80, .00, 90, .00, 0, 0, 0, 0, 1), (30, .00, 45, .05, 28, .00, 0, 0, 0, 0, 1),
    (12, .00, 70, .00, 50, .00, 0, 0, 0, 0, 1), (7, .00, 2, .00, 95, .00, 0, 0, 1, 0, 1), (150, .10, 4, 1.0, 6, .90, 0, 0, 0, 0, 1),
    (22, .00, 30, .00, 18, .00, 0, 0, 0, 0, 1), (5, .00, 60, .00, 70, .00, 0, 0, 0, 0, 1), (16, .00, 25, .00, 20, .00, 0, 0, 0, 1, 1),
    # menus, footers, side columns, adverts, forms, comments
    (1, 1.0, 1, 1.0, 1, 1.0, 1, 0, 0, 1, 0), (2, 1.0, 1, 1.0, 60, .00, 1, 0, 0, 1, 0), (9, .00, 1, 1.0, 12, .00, 1, 0, 0, 0, 0),
    (40, .00, 2, 1.0, 15, .00, 1, 0, 0, 0, 0), (10, .00, 80, .00, 0, .00, 1, 0, 0, 0, 0), (90, .00, 60, .00, 0, .00, 1, 0, 0, 0, 0),
    (15, .20, 300, .00, 4, 1.0, 1, 0, 0, 0, 0), (4, .00, 12, .00, 30, .00, 1, 0, 1, 0, 0), (35, .00, 4, .00, 28, .00, 1, 0, 0, 0, 0),
    (35, .00, 90, .00, 25, .00, 1, 1, 0, 0, 0), (6, 1.0, 90, .00, 4, 1.0, 1, 1, 0, 1, 0), (3, .00, 120, .00, 40, .00, 1, 1, 1, 0, 0),
    (18, .00, 60, .00, 50, .00, 1, 1, 0, 0, 0), (2, 1.0, 40, .00, 60, .00, 1, 1, 0, 0, 0), (120, .00, 3, .00, 0, .00, 1, 1, 0, 0, 0),
    # link lists and stray lines outside every container
    (2, 1.0, 2, 1.0, 2, 1.0, 0, 0, 0, 1, 0), (5, 1.0, 3, 1.0, 6, 1.0, 0, 0, 0, 0, 0), (4, .80, 2, 1.0, 80, .00, 0, 0, 0, 0, 0),
    (3, .00, 2, 1.0, 4, 1.0, 0, 0, 0, 0, 0), (2, .00, 0, .00, 3, 1.0, 0, 0, 0, 0, 0), (6, .90, 90, .00, 0, .00, 0, 0, 0, 0, 0),
    (5, .00, 3, 1.0, 2, .00, 0, 0, 0, 0, 0), (12, .95, 20, .90, 14, 1.0, 0, 0, 0, 1, 0), (25, .90, 4, 1.0, 3, 1.0, 0, 0, 0, 0, 0),
    (2, .00, 3, .00, 2, .00, 0, 0, 0, 0, 0), (1, .00, 2, 1.0, 0, .00, 0, 0, 0, 0, 0), (3, 1.0, 60, .00, 3, 1.0, 0, 0, 0, 1, 0),
], dtype=float)
FEATURES = ["words", "links", "words_before", "links_before", "words_after", "links_after", "side", "main", "heading", "entry"]


def grow(x: np.ndarray, y: np.ndarray, depth: int = 6, least: int = 1):
    """A binary classification tree by Gini impurity: (feature, cut, left, right) or a class."""
    if depth == 0 or len(y) < 2 * least or y.min() == y.max():
        return int(round(float(y.mean())))
    best = None
    for f in range(x.shape[1]):
        values = np.unique(x[:, f])
        for cut in (values[1:] + values[:-1]) / 2:
            left = x[:, f] <= cut
            a, b = y[left], y[~left]
            if min(len(a), len(b)) < least:
                continue
            gini = len(a) * a.mean() * (1 - a.mean()) + len(b) * b.mean() * (1 - b.mean())
            if best is None or gini < best[0] - 1e-12:
                best = (gini, f, float(cut))
    if best is None:
        return int(round(float(y.mean())))
    _, f, cut = best
    left = x[:, f] <= cut
    return (f, cut, grow(x[left], y[left], depth - 1, least), grow(x[~left], y[~left], depth - 1, least))


def judge(tree, row) -> int:
    while not isinstance(tree, int):
        tree = tree[2] if row[tree[0]] <= tree[1] else tree[3]
    return tree


NEITHER, SIDE_KIND, MAIN_KIND, WEAK_SIDE = 0, 1, 2, 3


def _token(token: str) -> int:
    """What one token of a class, id, role or label says of its container."""
    words = [w for w in re.split(r"[^a-z0-9]+", re.sub(r"(?<=[a-z])(?=[A-Z])", "-", token).lower()) if w]
    side = [w for w in words if w in SIDE_WORD]
    if any(w in COMMENT_WORD for w in words) and not any(w in STATE_WORD for w in words):
        return SIDE_KIND
    if side and all(w in SIDE_WORD or w in PLACE_WORD or w in MAIN_WORD or w in WRAP_WORD or w.isdigit() for w in words):
        return WEAK_SIDE if any(w in MAIN_WORD or w in WRAP_WORD for w in words) else SIDE_KIND
    if not side and words and any(w in MAIN_WORD for w in words) and all(w in MAIN_WORD or w in PLACE_WORD or w in WRAP_WORD for w in words):
        return MAIN_KIND
    return NEITHER


def _kind(tag: str, attr: str) -> int:
    """Side container, main container, weak side container or neither."""
    if tag in SIDE:
        return SIDE_KIND
    said = set()
    comments = False
    if "=" in attr:
        for m in HINT.finditer(attr):
            value = m[2] if m[2] is not None else m[3] if m[3] is not None else m[4]
            # a label is one phrase, the others are tokens
            for token in [value] if m[1].lower() == "aria-label" else value.split():
                k = _token(token)
                said.add(k)
                comments |= k == SIDE_KIND and any(w in COMMENT_WORD for w in re.split(r"[^a-z]+", token.lower()))
    if tag in ("article", "main"):
        return SIDE_KIND if comments and tag == "article" else MAIN_KIND
    if tag == "body":
        return NEITHER
    if MAIN_KIND in said and not comments:
        return MAIN_KIND
    return SIDE_KIND if SIDE_KIND in said else WEAK_SIDE if WEAK_SIDE in said else NEITHER


def blocks(page: str) -> list[list]:
    """Flat text blocks in page order: [text, words, link density, side, main, heading, entry]."""
    out: list[list] = []
    stack: list[tuple[str, int, int]] = []      # tag, kind, weak side containers that a main container put aside
    side = weak = main = in_link = 0
    heading = entry = False
    parts: list[str] = []
    linked = 0

    def flush():
        nonlocal linked
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                out.append([text, text.count(" ") + 1, min(1.0, linked / len(text)), int(side > 0 or weak > 0), int(main > 0),
                            int(heading), int(entry)])
            parts.clear()
        linked = 0

    def pop(to: int):
        nonlocal side, weak, main
        while len(stack) > to:
            _, k, aside = stack.pop()
            side -= k == SIDE_KIND
            main -= k == MAIN_KIND
            weak = aside if k == MAIN_KIND else weak - (k == WEAK_SIDE)

    def say(raw: str):
        nonlocal linked
        text = html.unescape(raw) if "&" in raw else raw
        parts.append(text)
        if in_link:
            linked += len(text.strip())

    # a tag that is not closed by any ">" is cut off by the end of the page
    upto = page.rfind(">") + 1
    at, open_end = 0, False
    for m in TOKEN.finditer(page, 0, upto):
        # a comment or raw element that nothing closes runs to the end of the page
        open_end = m.end() == upto and m["tag"] is None and (
            not page.endswith("-->", 0, upto) if page.startswith("<!--", m.start()) else
            bool(m["raw"]) and not re.search(r"</%s\s*>\Z|/>\Z" % m["raw"], m[0], re.I))
        if m.start() > at:
            say(page[at:m.start()])
        at = m.end()
        tag = m["tag"]
        if tag is None:
            continue
        tag = tag.lower()
        ends = bool(m["end"])
        if tag == "a":
            in_link = 0 if ends else 1
        elif tag in ("br", "wbr", "img", "input"):
            parts.append("" if tag == "wbr" else " ")
        elif tag in BLOCK:
            flush()
            in_link = 0
            heading = not ends and len(tag) == 2 and tag[0] == "h" and tag[1].isdigit()
            entry = not ends and tag in ("li", "dt", "dd", "td", "th")
            if tag in ("td", "th", "tr"):       # a cell ends where the next one or its row begins
                for i in range(len(stack) - 1, -1, -1):
                    if stack[i][0] == "table":
                        break
                    if stack[i][0] == "td":
                        pop(i)
                        break
            if tag in CONTAINER:
                if ends:
                    for i in range(len(stack) - 1, -1, -1):
                        if stack[i][0] == tag:
                            pop(i)
                            break
                elif not m["attr"].endswith("/"):
                    k = _kind(tag, m["attr"])
                    # a page header holds no main text; the header of an article does
                    if tag == "header" and k == NEITHER and not main:
                        k = SIDE_KIND
                    stack.append((tag, k, weak))
                    side += k == SIDE_KIND
                    main += k == MAIN_KIND
                    weak = 0 if k == MAIN_KIND else weak + (k == WEAK_SIDE)
            elif tag == "body" and not ends:
                pop(0)          # an unclosed head ends here
    if at < len(page) and not open_end:
        rest = page[at:]
        cut = re.search(r"<[a-zA-Z/!?]", page[upto:])
        say(rest[:cut.start() + upto - at] if cut else rest)
    flush()
    return out


def main_text(page: str, tree) -> str:
    found = blocks(page)
    keep = []
    none = [None, 0, 0.0]
    for i, b in enumerate(found):
        p = found[i - 1] if i else none
        n = found[i + 1] if i + 1 < len(found) else none
        if judge(tree, (b[1], b[2], p[1], p[2], n[1], n[2], b[3], b[4], b[5], b[6])):
            keep.append(b[0])
    return "\n".join(keep)


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
            labelled: np.ndarray = LABELLED) -> DataFrame:
    """id, url, ``text`` (main text) and ``n_chars`` (its code points) per row."""
    tree = grow(labelled[:, :-1], labelled[:, -1])

    def run(batches):
        for b in batches:
            texts = [main_text(p, tree) if p else "" for p in b.column(html_col).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(id_col), b.column(url_col), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=[id_col, url_col, "text", "n_chars"])

    schema = T.StructType([pages.schema[id_col], pages.schema[url_col],
                           T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])
    return pages.select(*[F.col(f"`{c}`") for c in (id_col, url_col, html_col)]).mapInArrow(run, schema)


def op7_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))


QUERIES = {"op7_html_extract": op7_html_extract}
ORACLE = {}
