"""Main text of HTML pages: boosted trees over DOM nodes, decoded along the tree.

A page is read into blocks and their ancestors.  Gradient-boosted trees score
every element from its own markup, its attribute words, its depth, the density
of its subtree and its siblings.  Decoding picks the best-scoring set of kept
elements in which nothing is kept below a dropped element, so an article inside
a menu, or a menu inside an article, is settled once.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daycast.session import ship_package

#: Pages the trees are fitted on, at most (those with the smallest hash of their id).
SAMPLE = 128
TREES, DEPTH, RATE = 24, 4, 0.3
#: Elements scored at once.
ROWS = 8192

# Elements by how HTML treats their text.
HIDDEN = frozenset("script style noscript template head title meta link svg iframe object canvas textarea select option annotation annotation-xml".split())
RAW = ("script", "style", "noscript", "template", "textarea", "title", "svg", "iframe")
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
MATH = frozenset("math maction menclose merror mfrac mi mmultiscripts mn mo mover mpadded mphantom mroot mrow ms mspace msqrt mstyle msub msubsup msup mtable mtd mtext mtr munder munderover semantics".split())
INLINE = MATH | frozenset("a abbr b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr".split())
CLOSES_P = frozenset("address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
#: Elements that do not end an open <head>.
IN_HEAD = frozenset("head html base link meta title style script noscript template".split())
#: An opening tag on the left ends an open one on the right.
ENDS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
SCOPE = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("tr", "table"), "th": ("tr", "table")}

# Words of class, id and role attributes that tell what a part is for.
HINTS = {
    "article": "article post entry story content main body text prose hentry",
    "menu": "nav navigation menu navbar breadcrumb breadcrumbs topbar tabs pagination pager toc links",
    "header": "header masthead banner logo brand top hero",
    "footer": "footer foot copyright colophon legal bottom",
    "side": "sidebar side aside widget rail related recommended more popular trending",
    "advert": "ad ads advert adverts advertisement sponsored sponsor promo promotion",
    "notice": "notice cookie cookies consent gdpr alert banner popup modal overlay newsletter subscribe signup paywall",
    "form": "form search login contact input",
    "comment": "comment comments respond reply replies discussion disqus thread reader",
    "share": "share social follow tags meta byline author date",
}
_HINT = {w: i for i, ws in enumerate(HINTS.values()) for w in ws.split()}
_TAGS = ["article", "main", "section", "div", "p", "h", "ul", "li", "nav", "header", "footer", "aside", "form", "table", "blockquote", "body", "#text", "other"]
_TAG = {t: i for i, t in enumerate(_TAGS)} | {f"h{i}": _TAGS.index("h") for i in range(1, 7)} | {"ol": _TAGS.index("ul"), "menu": _TAGS.index("nav"),
                                                                                            "fieldset": _TAGS.index("form"), "button": _TAGS.index("form")}

_TOKEN = re.compile(
    r"<!--(?:-?>|.*?(?:--!?>|\Z))|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)", re.S)
# the rest of a tag: a quote opens a value only behind "=", elsewhere it is a character like others; possessive, so one pass
_REST = re.compile(r"""((?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+'|[^\s"'>][^\s>]*+)?+)*+)>""")
_ATTR = re.compile(r"""([^\s/>=]++)(?:\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s"'>][^\s>]*+)))?+""")
_SPLIT = re.compile(r"[^a-z]+")
_SELF_CLOSED = re.compile(r"(?:^|[\s\"']|^[^=]*)/$")
_RAW_END = {t: re.compile(rf"<(/?){t}(?:\s[^<>]*+|/)?>", re.I) for t in RAW}
_RAW_CLOSE = {t: re.compile(rf"</{t}(?=[\s/>])[^<>]*+>", re.I) for t in RAW}


class Node:
    """An element: its parent's index, tag, attribute words and the text pieces in it."""

    __slots__ = ("parent", "tag", "hints", "depth", "pieces", "children", "link")

    def __init__(self, parent: int, tag: str, hints: list[int], depth: int, link: bool) -> None:
        self.parent, self.tag, self.hints, self.depth, self.link = parent, tag, hints, depth, link
        self.pieces: list[tuple[int, str, bool]] = []  # block number, text, inside a link
        self.children: list[int] = []


def _hints(attrs: str) -> list[int]:
    out = []
    if "=" in attrs:
        for name, *value in _ATTR.findall(attrs):
            if name.lower() in ("class", "id", "role", "itemprop", "itemtype"):
                out += [_HINT[w] for w in _SPLIT.split(html.unescape("".join(value)).lower()) if w in _HINT]
    return out


class _Open:
    """Open elements; per tag the places where it is open, so that no start or end tag walks the whole stack."""

    def __init__(self) -> None:
        self.stack: list[tuple[str, int]] = [("#root", 0)]  # tag and the element its text goes to
        self.places: dict[str, list[int]] = {}
        self.links = 0
        self.hidden = 0  # place of the outermost hidden element, 0 for none

    def push(self, tag: str, node: int) -> None:
        self.places.setdefault(tag, []).append(len(self.stack))
        self.stack.append((tag, node))
        self.links += tag == "a"

    def last(self, tags) -> int:
        """Place of the innermost open one of ``tags``, 0 if none is open."""
        at = 0
        for t in tags:
            places = self.places.get(t)
            if places and places[-1] > at:
                at = places[-1]
        return at

    def cut(self, at: int) -> None:
        """Ends the element at place ``at`` (if not 0) and all inside it; a hidden one among them hides no longer."""
        while at and len(self.stack) > at:
            tag, _ = self.stack.pop()
            self.places[tag].pop()
            self.links -= tag == "a"
        if at and self.hidden >= at:
            self.hidden = 0


def read_page(page: str) -> list[Node]:
    """Elements of a page in order, index 0 the root; inline elements belong to the block around them.

    A block of text directly in the root is an element of its own (``#text``).
    One pass: the time grows with the page's length, however broken its markup.
    A tag that the page's end cuts off is markup; a ``<`` that opens no tag is text.
    """
    nodes = [Node(-1, "body", [], 0, False)]
    open_ = _Open()
    block, at = 0, 0

    def put(text: str) -> None:
        if not text:
            return
        if open_.hidden and open_.stack[open_.hidden][0] == "head" and not text.isspace():
            open_.cut(open_.hidden)  # the end tag of <head> may be left out: what belongs to the body ends it
        if not open_.hidden:
            to = open_.stack[-1][1]
            if to == 0:
                last = nodes[0].children[-1] if nodes[0].children else 0
                if not last or nodes[last].tag != "#text" or nodes[last].pieces[0][0] != block:
                    if text.isspace():
                        return
                    last = len(nodes)
                    nodes[0].children.append(last)
                    nodes.append(Node(0, "#text", [], 1, False))
                to = last
            nodes[to].pieces.append((block, text, open_.links > 0))

    while m := _TOKEN.search(page, at):
        put(page[at:m.start()])
        at = m.end()
        tag = m.group(2)
        if tag is None:
            if page.startswith("<![CDATA[", m.start()):
                put(page[m.start() + 9:m.end() - (3 if page.endswith("]]>", 0, m.end()) else 0)])
            continue
        rest = _REST.match(page, at)
        if not rest:
            return nodes
        at, tag, attrs = rest.end(), tag.lower(), rest.group(1)
        if m.group(1):
            open_.cut(open_.last((tag,)))
            if tag not in INLINE:
                block += 1
            continue
        if open_.hidden and open_.stack[open_.hidden][0] == "head" and tag not in IN_HEAD:
            open_.cut(open_.hidden)
        if tag in HIDDEN and _SELF_CLOSED.search(attrs):
            # empty, unless its own end tag is the next one of its name
            after = _RAW_END[tag].search(page, at) if tag in RAW else None
            if not (after and after.group(1)):
                continue
        if tag in RAW:
            end = _RAW_CLOSE[tag].search(page, at)
            at = end.end() if end else len(page)
            continue
        if tag in VOID:
            if tag == "br":
                put(" ")
            elif tag not in INLINE:
                block += 1
            continue
        if tag in ("html", "body"):
            continue
        if tag in HIDDEN:
            open_.hidden = open_.hidden or len(open_.stack)
            open_.push(tag, open_.stack[-1][1])
            continue
        ends, scope = ENDS.get(tag, ()), SCOPE.get(tag, ())
        if tag in CLOSES_P:
            ends, scope = ("p",), ("button", "table", "td", "li", "div", "article", "section", "body")
        if ends and (ended := open_.last(ends)) > open_.last(scope):
            open_.cut(ended)
        if tag in INLINE:
            open_.push(tag, open_.stack[-1][1])
            continue
        block += 1
        parent = open_.stack[-1][1]
        nodes[parent].children.append(len(nodes))
        nodes.append(Node(parent, tag, _hints(attrs), nodes[parent].depth + 1, open_.links > 0))
        open_.push(tag, len(nodes) - 1)
    put(page[at:])
    return nodes


def features(nodes: list[Node]) -> np.ndarray:
    """One row per element; subtree sums run from the leaves up."""
    n, h, t = len(nodes), len(HINTS), len(_TAGS)
    own = np.zeros((n, 4))  # characters, linked characters, sentence ends, pieces
    for i, x in enumerate(nodes):
        for _, s, linked in x.pieces:
            c = len(s)
            own[i] += (c, c if linked or x.link else 0, s.count(". ") + s.count(".\n") + s.endswith("."), 1)
    sub = np.concatenate([own, np.ones((n, 1)), np.array([[x.tag == "p", x.tag == "li"] for x in nodes], float)], axis=1)
    for i in range(n - 1, 0, -1):
        sub[nodes[i].parent] += sub[i]
    out = np.zeros((n, 2 * t + 2 * h + 14))
    for i, x in enumerate(nodes):
        tag = _TAG.get(x.tag, t - 1)
        out[i, tag] = 1
        out[i, 2 * t:2 * t + h] = np.bincount(x.hints, minlength=h)[:h]
        if i:
            p = x.parent
            # what the ancestors say is handed down
            out[i, t:2 * t] = np.maximum(out[p, t:2 * t], out[p, :t])
            out[i, 2 * t + h:2 * t + 2 * h] = out[p, 2 * t + h:2 * t + 2 * h] + out[p, 2 * t:2 * t + h]
    total = max(sub[0, 0], 1.0)
    b = 2 * t + 2 * h
    size = np.maximum(sub[:, 0], 1.0)
    out[:, b] = np.log1p(own[:, 0])
    out[:, b + 1] = np.log1p(sub[:, 0])
    out[:, b + 2] = sub[:, 0] / total
    out[:, b + 3] = sub[:, 1] / size
    out[:, b + 4] = np.log1p(sub[:, 2])
    out[:, b + 5] = sub[:, 0] / sub[:, 4]  # characters per element below
    out[:, b + 6] = np.log1p(sub[:, 5])
    out[:, b + 7] = sub[:, 6] / sub[:, 4]
    out[:, b + 8] = [x.depth for x in nodes]
    out[:, b + 9] = [len(x.children) for x in nodes]
    for x in nodes:
        below = max(sum(sub[y, 0] for y in x.children), 1.0)
        for k, c in enumerate(x.children):
            out[c, b + 10] = k / max(len(x.children) - 1, 1)  # place among the siblings
            out[c, b + 11] = len(x.children)
            out[c, b + 12] = sub[c, 0] / below
            out[c, b + 13] = k and np.log1p(sub[x.children[k - 1], 0])
    return out


# ---- trees ----------------------------------------------------------------


def fit_trees(x: np.ndarray, y: np.ndarray) -> tuple[tuple[np.ndarray, ...], float]:
    """Gradient boosting with logistic loss; a tree is a list of (feature, limit, left, right, value), feature -1 in a leaf."""
    base = float(np.log((y.sum() + 1) / (len(y) - y.sum() + 1)))
    f, trees = np.full(len(y), base), []
    cuts = [np.unique(np.quantile(c, np.linspace(0.05, 0.95, 12))) for c in x.T]
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-f))
        tree: list[tuple] = []
        _grow(x, y - p, p * (1 - p), np.arange(len(y)), cuts, DEPTH, tree)
        trees.append(tree)
        f += RATE * _tree_value(tree, x)
    most = max(map(len, trees))
    # field by field, a row per tree
    return tuple(np.array([[n[i] for n in t] + [0] * (most - len(t)) for t in trees]) for i in range(5)), base


def _grow(x, g, h, rows, cuts, depth, tree) -> int:
    """Adds the best split of ``rows`` (or a leaf) and returns its number."""
    me = len(tree)
    tree.append((-1, 0.0, 0, 0, float(g[rows].sum() / (h[rows].sum() + 1.0))))
    if not depth or len(rows) < 8:
        return me
    best = (1e-6, None)
    gs, hs = g[rows].sum(), h[rows].sum()
    for j, limits in enumerate(cuts):
        col = x[rows, j]
        for limit in limits:
            left = col <= limit
            gl, hl = g[rows][left].sum(), h[rows][left].sum()
            gain = gl * gl / (hl + 1) + (gs - gl) ** 2 / (hs - hl + 1) - gs * gs / (hs + 1)
            if gain > best[0] and left.any() and not left.all():
                best = (gain, (j, float(limit), left))
    if best[1] is None:
        return me
    j, limit, left = best[1]
    a = _grow(x, g, h, rows[left], cuts, depth - 1, tree)
    b = _grow(x, g, h, rows[~left], cuts, depth - 1, tree)
    tree[me] = (j, limit, a, b, 0.0)
    return me


def _tree_value(tree: list[tuple], x: np.ndarray) -> np.ndarray:
    at = np.zeros(len(x), int)
    feature, limit, left, right, value = (np.array(c) for c in zip(*tree))
    for _ in range(DEPTH):
        inner = feature[at] >= 0
        go = x[np.arange(len(x)), np.maximum(feature[at], 0)] <= limit[at]
        at = np.where(inner, np.where(go, left[at], right[at]), at)
    return value[at]


def scores(model: tuple, x: np.ndarray) -> np.ndarray:
    """All trees walk some thousand rows at once, level by level, by flat places (a leaf stays where it is)."""
    if len(x) > ROWS:
        return np.concatenate([scores(model, x[a:a + ROWS]) for a in range(0, len(x), ROWS)])
    (feature, limit, left, right, value), base = model
    most = feature.shape[1]
    tree = np.arange(len(feature))[:, None] * most
    row = np.arange(len(x)) * x.shape[1]
    at, flat = np.zeros((len(feature), len(x)), int), np.ascontiguousarray(x).ravel()
    for _ in range(DEPTH):
        place = tree + at
        f = feature.ravel()[place]
        go = flat[row + np.maximum(f, 0)] <= limit.ravel()[place]
        at = np.where(f >= 0, np.where(go, left.ravel()[place], right.ravel()[place]), at)
    return base + RATE * value.ravel()[tree + at].sum(axis=0)


def decode(nodes: list[Node], score: np.ndarray) -> list[bool]:
    """Best set of kept elements with nothing kept below a dropped one."""
    n = len(nodes)
    weight = np.array([sum(len(s) for _, s, _ in x.pieces) for x in nodes])
    gain = score * np.log2(2 + weight)  # a long paragraph's verdict counts for more
    gain[0] = 0.0  # the root itself is no choice
    best = gain.copy()
    drop = -gain.copy()
    for i in range(n - 1, 0, -1):
        p = nodes[i].parent
        best[p] += max(best[i], drop[i])
        drop[p] += drop[i]
    keep = [True] * n
    for i in range(1, n):
        keep[i] = keep[nodes[i].parent] and bool(best[i] >= drop[i])
    return keep


def main_text(page: str, model: tuple) -> str:
    """Blocks of kept elements in page order, one per line, white space as one blank."""
    nodes = read_page(page)
    if all(x.tag == "#text" for x in nodes[1:]):
        return _join([x.pieces for x in nodes])
    keep = decode(nodes, scores(model, features(nodes)))
    if not any(keep[1:]):
        keep = [x.tag == "#text" for x in nodes]
    return _join([x.pieces for x, k in zip(nodes[1:], keep[1:]) if k])


def _join(parts: list[list[tuple[int, str, bool]]]) -> str:
    blocks: dict[int, list[str]] = {}
    for pieces in parts:
        for block, text, _ in pieces:
            blocks.setdefault(block, []).append(text)
    lines = (" ".join(html.unescape("".join(blocks[b])).split()) for b in sorted(blocks))
    return "\n".join(s for s in lines if s)


# ---- training -------------------------------------------------------------

_SURE_IN, _SURE_OUT = ("article", "main"), ("nav", "aside", "footer", "header", "form", "dialog")


def teacher(nodes: list[Node]) -> np.ndarray | None:
    """1 for elements of the article, 0 for the rest, from semantic markup; None for pages without any."""
    y = np.zeros(len(nodes))
    out_hint = {_HINT[w] for w in ("nav", "sidebar", "ad", "footer", "notice", "form", "comment", "share")}
    for i, x in enumerate(nodes):
        if x.tag in _SURE_OUT or out_hint & set(x.hints):
            y[i] = -1
        elif i and y[x.parent]:
            y[i] = y[x.parent]
        elif x.tag in _SURE_IN:
            y[i] = 1
    return (y == 1).astype(float) if (y == 1).any() else None


def variants(page: str) -> list[str]:
    """The page and rewritings of its own parts, so that the trees also learn from attributes and text alone.

    The article's element is renamed, its neighbours are told by class words
    only, and parts that pages commonly have (comments, a sidebar, a notice, a
    form) are set up from the page's own words.
    """
    m = re.search(r"<article[^>]*>(.*?)</article>", page, re.S)
    if not m:
        return [page]
    inner = m.group(1)
    words = re.sub(r"<[^>]+>|&[^;\s]*;", " ", inner).split()
    few, some = " ".join(words[:9]), " ".join(words[9:60])
    varied = _varied(inner)
    nav = re.search(r"<nav.*?</nav>", page, re.S)
    menu = nav.group(0) if nav else "<nav><ul><li><a href='/'>Home</a></li></ul></nav>"
    foot = re.search(r"<footer.*?</footer>", page, re.S)
    end = foot.group(0) if foot else f"<footer>{few}</footer>"
    as_div = re.sub(r"(</?)(nav|footer)", lambda t: t.group(1) + "div" + ("" if "/" in t.group(1) else f' class="{"menu" if t.group(2) == "nav" else "footer"}"'), menu + "\0" + end)
    menu2, end2 = as_div.split("\0")
    extra = (f'<aside><p>{some}</p></aside><div class="sidebar"><h3>{few}</h3><ul><li><a href="/x">{few}</a></li></ul></div>'
             f'<section class="comments" id="comments"><h2>{few}</h2><div class="comment"><p>{some}</p></div><p>{few}</p></section>'
             f'<div class="cookie-notice"><p>{few}</p></div><form action="/s"><label>{few}</label><input name="q"><button>{few}</button></form>')
    head = f"<header><p>{few}</p></header>"
    # the article as loose text in the body, beside loose links
    cut = max(len(words) // 3, 1)
    loose = (f"<h1>{' '.join(words[:1])}</h1>{' '.join(words[:cut])}<br><br><b>{' '.join(words[cut:cut + 3])}</b> {' '.join(words[cut + 3:2 * cut])}"
             f"<h2>{few}</h2>{' '.join(words[2 * cut:])}")
    links = "".join(f'<a href="/{i}">{w}</a> | ' for i, w in enumerate(words[:5]))
    return [page,
            f"{LOOSE}<body>{links}{menu2}{loose}{extra}{end2}</body>",
            f"{LOOSE}<body><h1>{' '.join(words[:1])}</h1>{' '.join(words[:cut])}<br><br>{' '.join(words[cut:2 * cut])}</body>",
            f"<body>{head}{menu}<main><article>{varied}<aside>{some}</aside></article></main>{extra}{end}</body>",
            f'<body>{menu2}<div class="post-content">{inner}<div class="share">{few}</div></div>{extra}{end2}</body>',
            f'<body>{head}{menu2}<div class="post-content">{varied}</div>{extra}{end2}</body>',
            f'<body><div class="header">{few}</div>{menu2}<main><section><article>{inner}<section class="comments"><p>{some}</p><p>{few}</p></section></article></section></main>{end2}</body>']


def _varied(inner: str) -> str:
    """The article with paragraphs turned into what else articles hold: lists, quotations, headings, tables, figures."""
    forms = ("<p>{}</p>", "<ul><li>{}</li><li>{}</li></ul>", "<blockquote>{}</blockquote>", "<p>{}</p>", "<h2>{}</h2>",
             "<ol><li><a href='/n'>{}</a></li><li>{}</li></ol>", "<div><p>{}</p></div>", "<table><tr><td>{}</td><td>{}</td></tr></table>",
             "<figure><figcaption>{}</figcaption></figure>", "<section><h3>{}</h3><p>{}</p></section>", "<pre>{}</pre>")
    turn = iter(range(1 << 30))

    def put(m: re.Match) -> str:
        form = forms[next(turn) % len(forms)]
        words = re.sub(r"<[^>]*>", " ", m.group(1)).split()
        cut = len(words) // 2 if form.count("{}") > 1 else len(words)
        if "h2" in form or "h3" in form:
            cut = min(cut, 8)
        return form.format(*[" ".join(w) for w in (words[:cut], words[cut:])][:form.count("{}")])

    text = re.sub(r"<p>(.*?)(?=</p>|<p>|\Z)(?:</p>)?", put, inner, flags=re.S)
    # short articles too get one of each
    head = " ".join(re.sub(r"<[^>]*>", " ", inner).split()[:12])
    return text + f"<ul><li>{head}</li><li>{head[:30]}</li></ul><blockquote>{head}</blockquote><p>{head}</p>"


#: Marks a rewriting whose article is loose text in the body.
LOOSE = "<!--loose-->"


def _teacher_of_variant(page: str) -> tuple[np.ndarray, np.ndarray] | None:
    if page.startswith(LOOSE):
        nodes = read_page(page)
        y = [x.parent == 0 and (x.tag in ("h1", "h2") or x.tag == "#text" and not all(linked for _, s, linked in x.pieces if len(s) > 3)) for x in nodes]
        return features(nodes), np.array(y, float)
    marked = page.replace('<div class="post-content">', '<article class="post-content">')
    nodes = read_page(page)
    y = teacher(read_page(marked) if marked is not page else nodes)
    return (features(nodes), y) if y is not None and len(y) == len(nodes) else None


def fit(pages: DataFrame) -> tuple:
    """Trees from at most ``SAMPLE`` pages; without a page that marks its article up, from a plain pattern page."""
    # the keys first, copies once, then the pages of these keys: no task sends more than a sample
    keyed = pages.filter(F.col("html").isNotNull()).select(F.xxhash64("page_id", "html").alias("key"), "html")
    keys = [r["key"] for r in keyed.select("key").distinct().orderBy("key").limit(SAMPLE).collect()]
    rows = keyed.filter(F.col("key").isin(keys)).groupBy("key").agg(F.min("html").alias("html")).collect()
    learn = [v for r in sorted(rows) for v in variants(r["html"])]
    data = [d for v in learn if (d := _teacher_of_variant(v)) is not None]
    if not data:
        words = " ".join(["word"] * 40)
        plain = f"<nav><ul><li><a href='/'>home</a></li></ul></nav><article><h1>title</h1><p>{words}.</p><p>{words}.</p></article><footer>end</footer>"
        data = [d for v in variants(plain) if (d := _teacher_of_variant(v)) is not None]
    return fit_trees(np.concatenate([x for x, _ in data]), np.concatenate([y for _, y in data]))


def extract(pages: DataFrame) -> DataFrame:
    """All pages with ``text``, the main text of the whole ``html``.

    Needs ``page_id, html``; other columns pass (``text`` is replaced).  NULL or
    empty pages, and pages without any kept element, have an empty text; a page
    without elements is one block; broken markup (missing ends, stray quotes and
    ``<``) is read as browsers do, a tag cut off by the page's end is dropped; repeated rows are equal; an empty table stays empty.
    """
    ship_package(pages.sparkSession)
    keep = [c for c in pages.columns if c != "text"]
    pages = pages.select(*keep)
    model = pages.sparkSession.sparkContext.broadcast(fit(pages))
    fields = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in pages.schema.fields)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(p, model.value) if p else "" for p in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=[*keep, "text"])

    return pages.mapInArrow(task, fields + "text string")


def op6_pages(spark, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    return extract(pages).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
