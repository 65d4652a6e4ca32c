"""Main text of HTML pages: gradient-boosted trees over DOM nodes, decoded so that the tree stays consistent.

A page becomes a tree of block elements whose leaves are runs of inline text.  Every node is described by its subtree
(text, links, tags, paragraphs), the tokens of its tag, class, id and role and those above it, its depth and its
siblings.  The trees are trained on a bounded sample of the given pages: where a page marks its article with an
``article`` or ``main`` element, that is the label, and the page's own blocks are also laid out anew in other templates
(other containers, side bars, notices, forms, adverts, reader comments).  In half of these the article's container has
no telling name, and often those around it have none, and the pages are learned with their articles unnamed, too, so
that density, depth and siblings have to carry the decision.
If no page marks its article, the paragraphs of the sample that stand in no side matter are laid out so.

Decoding picks, by dynamic programming, the most likely labelling in which everything below a dropped node is dropped,
so no choice contradicts one above it.  The text is that of the kept leaves in page order.
"""

from __future__ import annotations

import html as entities
import random
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fresh

SAMPLE = 160  # pages that the model is trained on, at most
SAMPLE_CHARS = 1 << 18  # longer pages are trained on only if there are fewer than SAMPLE others
LAYOUTS = 4  # further layouts made of each of them
MIN_LAYOUTS = 320  # as many at least, however few pages there are
TREES, DEPTH, RATE, BINS = 60, 4, 0.25, 32

# Fixed values of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template svg math iframe object canvas video audio select textarea title head".split())
UNPARSED = frozenset("script style textarea title".split())
IN_HEAD = frozenset("base basefont bgsound head html link meta noscript script style template title".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr br img input button".split()
)
ENDS_PARAGRAPH = frozenset(
    "address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split()
)
SIBLINGS = {"li": ("li", "ul ol menu"), "dt": ("dt dd", "dl"), "dd": ("dt dd", "dl"), "tr": ("tr td th", "table"), "td": ("td th", "tr table"), "th": ("td th", "tr table"), "option": ("option", "select")}

#: Attribute words by what they tend to mark; the trees decide what they are worth.
TOKEN_GROUPS = {
    "content": "article articlebody body content entry main page post story text blog prose news".split(),
    "menu": "nav navbar navigation menu breadcrumb breadcrumbs pagination pager tabs toolbar topbar sitemap toc links".split(),
    "frame": "header head masthead footer foot copyright colophon banner logo branding".split(),
    "side": "sidebar side aside widget related recommended rail teaser more promo trending popular".split(),
    "advert": "ad ads adv advert advertisement sponsor sponsored promo promotion dfp banner outbrain taboola".split(),
    "notice": "cookie cookies consent gdpr notice alert popup modal overlay newsletter subscribe signup paywall message warning disclaimer".split(),
    "comment": "comment comments commentlist disqus reply replies respond discussion reader readers feedback reviews".split(),
    "form": "form search login register signin contact field input button share social follow".split(),
}
TAG_GROUPS = {
    "content": "article main".split(), "menu": "nav menu".split(), "frame": "header footer".split(), "side": ["aside"],
    "form": "form fieldset button dialog".split(), "heading": "h1 h2 h3 h4 h5 h6".split(), "paragraph": "p blockquote pre figcaption".split(),
    "list": "ul ol li dl dt dd".split(), "table": "table tr td th tbody thead".split(), "generic": "div section span body html".split(),
}
_GROUPS = list(TOKEN_GROUPS)
_TAGS = list(TAG_GROUPS)
_TOKEN_BIT = {}
for _i, _g in enumerate(_GROUPS):
    for _t in TOKEN_GROUPS[_g]:
        _TOKEN_BIT[_t] = _TOKEN_BIT.get(_t, 0) | 1 << _i
_TAG_INDEX = {t: i for i, g in enumerate(_TAGS) for t in TAG_GROUPS[g]}
_TAG_BITS = {"article": 1 << 0, "main": 1 << 0, "nav": 1 << 1, "menu": 1 << 1, "header": 1 << 2, "footer": 1 << 2, "aside": 1 << 3, "form": 1 << 7}

_TOKENS = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)", re.S)
_ATTRIBUTES = re.compile(r"(?:class|id|role|itemprop)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_ATTRIBUTE_WORDS = re.compile(r"[a-z]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")


@dataclass
class Page:
    """Nodes in page order: parent, tag, token bits, text of a leaf (None for elements), share of it in links."""

    parent: list[int]
    tag: list[str]
    bits: list[int]
    text: list[str | None]
    linked: list[int]
    tags_inside: list[int]


def _attribute_bits(attributes: str) -> int:
    bits = 0
    if "=" in attributes:
        for m in _ATTRIBUTES.finditer(attributes):
            for word in _ATTRIBUTE_WORDS.findall(_CAMEL.sub(" ", m[1] or m[2] or m[3] or "").lower()):
                bits |= _TOKEN_BIT.get(word, 0)
    return bits


def parse(source: str) -> Page:
    """Lenient parse: unclosed and misplaced tags are repaired by nesting rules, whatever is cut off ends where the page does.

    A head ends at the first tag or text that cannot stand in one.  Another skipped element without an end tag ends with
    the block that it is in, or, outside all blocks, where the next block begins.
    """
    page = Page([-1], ["html"], [0], [None], [0], [0])
    stack = [0]  # open block elements
    pieces: list[str] = []
    links = linked = inner_tags = 0

    def flush() -> None:
        nonlocal linked, inner_tags, pieces
        if pieces:
            text = " ".join(entities.unescape("".join(pieces)).split())
            if text:
                page.parent.append(stack[-1])
                page.tag.append("#text")
                page.bits.append(0)
                page.text.append(text)
                page.linked.append(min(linked, len(text)))
                page.tags_inside.append(inner_tags)
            pieces = []
        linked = inner_tags = 0

    def close(names: frozenset | set, within: frozenset | set = frozenset()) -> None:
        for k in range(len(stack) - 1, 0, -1):
            tag = page.tag[stack[k]]
            if tag in names:
                flush()
                del stack[k:]
                return
            if tag in within:
                return

    unclosed: dict[str, set[int]] = {}

    def is_unclosed(name: str, start: int) -> bool:
        """Whether the tag at ``start`` has no end tag, when those of this name are paired from the inside."""
        if name not in unclosed:
            opened: list[int] = []
            for t in re.finditer(f"<(/?){name}(?=[\\s/>])[^>]*(/?)>", source, re.I):
                if t[1]:
                    del opened[-1:]
                elif not t[0].endswith("/>"):
                    opened.append(t.start())
            unclosed[name] = set(opened)
        return start in unclosed[name]

    at, skip_until = 0, None
    bare = False  # skipping an element without an end tag, in which ``inside`` blocks are open
    inside: list[str] = []
    scan = _TOKENS.search
    while True:
        m = scan(source, at)
        if m is None:
            rest = source[at:]
            if rest and skip_until in (None, "head"):
                pieces.append(rest)
            break
        if skip_until == "head" and m.start() > at and not source[at : m.start()].isspace():
            skip_until = None
        if m.start() > at and skip_until is None:
            piece = source[at : m.start()]
            pieces.append(piece)
            if links:
                linked += len(piece)
        at = m.end()
        name = m[2]
        if name is None:
            continue
        name = name.lower()
        closing = m[1] == "/"
        if skip_until is not None:
            in_block = bare and len(stack) > 1
            if closing and name == skip_until and not bare or skip_until == "head" and name in ("body", "/head"):
                skip_until = None
                if closing or name != "body":
                    continue
            elif skip_until == "head" and not closing and name not in IN_HEAD:
                skip_until = None
            elif in_block and closing and name not in inside and any(page.tag[k] == name for k in stack):
                skip_until = None
            elif bare and not in_block and not closing and name in ENDS_PARAGRAPH:
                skip_until = None
            else:
                if skip_until == "head" and not closing and name in ("noscript", "template") and not is_unclosed(name, m.start()):
                    end = re.compile(f"</{name}[^>]*>?", re.I).search(source, at)
                    at = end.end() if end else at
                    continue
                if in_block and name in inside and closing:
                    del inside[len(inside) - 1 - inside[::-1].index(name) :]
                elif in_block and not closing and name not in VOID and not m[0].endswith("/>"):
                    inside.append(name)
                if not closing and name in UNPARSED:
                    inside = [x for x in inside if x != name]
                    end = re.compile(f"</{name}", re.I).search(source, at)
                    at = end.start() if end else len(source)
                continue
        if name in RAW:
            if not closing and not m[0].endswith("/>"):
                if name in UNPARSED:
                    end = re.compile(f"</{name}[^>]*>?", re.I).search(source, at)
                    at = end.end() if end else len(source)
                else:
                    skip_until, inside = name, []
                    bare = name != "head" and is_unclosed(name, m.start())
            pieces.append(" ")
            continue
        if name in INLINE:
            inner_tags += 1
            if name == "a":
                links = 0 if closing else 1
            elif name == "br":
                pieces.append(" ")
            continue
        if name in ("html", "body") or name in VOID:
            flush()
            continue
        if closing:
            if name == "p" and not any(page.tag[k] == "p" for k in stack):
                flush()
            else:
                close({name})
            flush()
            continue
        flush()
        links = 0
        if name in ENDS_PARAGRAPH:
            close({"p"}, {"td", "th", "li", "div", "section", "article", "blockquote"} - {"p"})
        if name in SIBLINGS:
            own, stop = SIBLINGS[name]
            close(set(own.split()), set(stop.split()))
        page.parent.append(stack[-1])
        page.tag.append(name)
        page.bits.append(_attribute_bits(m[3]) | _TAG_BITS.get(name, 0))
        page.text.append(None)
        page.linked.append(0)
        page.tags_inside.append(0)
        if not m[0].endswith("/>"):
            stack.append(len(page.tag) - 1)
    flush()
    return page


N_FEATURES = 12 + 2 * len(_GROUPS) + len(_TAGS)


def features(page: Page) -> np.ndarray:
    """One row per node."""
    n = len(page.tag)
    parent = page.parent
    size, leaves, linked, tags, paragraphs, nodes = ([0] * n for _ in range(6))
    children = [0] * n
    index = [0] * n
    for i in range(1, n):
        index[i] = children[parent[i]]
        children[parent[i]] += 1
    for i in range(n - 1, -1, -1):
        text = page.text[i]
        nodes[i] += 1
        if text is not None:
            size[i], leaves[i], linked[i] = len(text), 1, page.linked[i]
            tags[i] += page.tags_inside[i]
        elif page.tag[i] == "p":
            paragraphs[i] += 1
        if i:
            p = parent[i]
            size[p] += size[i]
            leaves[p] += leaves[i]
            linked[p] += linked[i]
            tags[p] += tags[i] + 1
            paragraphs[p] += paragraphs[i]
            nodes[p] += nodes[i]
    depth, above = [0] * n, [0] * n
    before = 0
    out = np.zeros((n, N_FEATURES), dtype=np.float32)
    total = max(1, size[0])
    sizes, groups = len(_GROUPS), 12
    for i in range(n):
        p = parent[i] if i else 0
        if i:
            depth[i] = depth[p] + 1
            above[i] = above[p] | page.bits[p]
        s = size[i]
        leaf = page.text[i] is not None  # a leaf is marked by what its element is
        out[i, :12] = (
            min(depth[i], 20), min(s, 500), linked[i] / (s + 1), min(s / (tags[i] + 1), 500), min(paragraphs[i], 20), min(leaves[i], 50),
            s / total, before / total, index[i] / max(1, children[p]), min(children[p], 20), s / max(1, size[p]), min(nodes[i], 100),
        )
        for bits, offset in ((page.bits[p] if leaf else page.bits[i], groups), (above[i], groups + sizes)):
            while bits:
                low = bits & -bits
                out[i, offset + low.bit_length() - 1] = 1
                bits ^= low
        kind = _TAG_INDEX.get(page.tag[p] if leaf else page.tag[i])
        if kind is not None:
            out[i, groups + 2 * sizes + kind] = 1
        if leaf:
            before += s
    return out


class BoostedTrees:
    """Binary gradient boosting with histograms; trees of fixed depth stored as arrays."""

    def fit(self, x: np.ndarray, y: np.ndarray) -> BoostedTrees:
        self.edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS)[1:-1])) for f in range(x.shape[1])]
        b = np.stack([np.searchsorted(e, x[:, f], side="right") for f, e in enumerate(self.edges)], axis=1)
        rate = np.clip(y.mean(), 1e-3, 1 - 1e-3)
        self.base = float(np.log(rate / (1 - rate)))
        z = np.full(len(y), self.base)
        self.feature, self.cut, self.leaf = [], [], []
        for _ in range(TREES):
            p = 1 / (1 + np.exp(-z))
            g, h = y - p, p * (1 - p)
            node = np.zeros(len(y), dtype=np.int64)
            feature, cut = np.zeros(2**DEPTH - 1, dtype=np.int64), np.full(2**DEPTH - 1, np.inf, dtype=np.float32)
            for level in range(DEPTH):
                first, width = 2**level - 1, 2**level
                best = np.full(width, 1e-6)
                for f, e in enumerate(self.edges):
                    if not len(e):
                        continue
                    cell = node * BINS + b[:, f]
                    hist_g = np.bincount(cell, g, width * BINS).reshape(width, BINS).cumsum(axis=1)
                    hist_h = np.bincount(cell, h, width * BINS).reshape(width, BINS).cumsum(axis=1)
                    gl, hl, gt, ht = hist_g[:, :-1], hist_h[:, :-1], hist_g[:, -1:], hist_h[:, -1:]
                    gain = gl**2 / (hl + 1) + (gt - gl) ** 2 / (ht - hl + 1) - gt**2 / (ht + 1)
                    gain = gain[:, : len(e)]
                    at = gain.argmax(axis=1)
                    top = gain[np.arange(width), at]
                    for k in np.flatnonzero(top > best):
                        best[k], feature[first + k], cut[first + k] = top[k], f, e[at[k]]
                node = node * 2 + (x[np.arange(len(y)), feature[first + node]] >= cut[first + node])
            gs, hs = np.bincount(node, g, 2**DEPTH), np.bincount(node, h, 2**DEPTH)
            leaf = RATE * gs / (hs + 1)
            z += leaf[node]
            self.feature.append(feature)
            self.cut.append(cut)
            self.leaf.append(leaf)
        return self

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        z = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for feature, cut, leaf in zip(self.feature, self.cut, self.leaf, strict=True):
            node = np.zeros(len(x), dtype=np.int64)
            for level in range(DEPTH):
                at = 2**level - 1 + node
                node = node * 2 + (x[rows, feature[at]] >= cut[at])
            z += leaf[node]
        return z


def decode(parent: list[int], log_odds: np.ndarray) -> list[bool]:
    """The likeliest labels in which everything below a dropped node is dropped; the root is kept."""
    z = np.clip(log_odds, -30, 30)
    keep = (-np.logaddexp(0, -z)).tolist()
    drop = (-np.logaddexp(0, z)).tolist()
    n = len(parent)
    for i in range(n - 1, 0, -1):  # keep: own term and the better of both for each child; drop: the whole subtree
        keep[parent[i]] += max(keep[i], drop[i])
        drop[parent[i]] += drop[i]
    out = [True] * n
    for i in range(1, n):
        out[i] = out[parent[i]] and keep[i] > drop[i]
    return out


def kept_text(page: Page, labels: list[bool]) -> str:
    return "\n".join(t for t, k in zip(page.text, labels, strict=True) if k and t is not None)


_UNWANTED = sum(1 << _GROUPS.index(g) for g in ("menu", "side", "advert", "notice", "comment", "form"))


def teacher(page: Page) -> list[bool] | None:
    """Labels from semantic markup: the article's nodes and those around them; None without an article."""
    n = len(page.tag)
    article = next((i for name in ("article", "main") for i in range(n) if page.tag[i] == name), None)
    if article is None:
        return None
    inside, around = [False] * n, [False] * n
    for i in range(article, n):
        p = page.parent[i]
        unwanted = page.tag[i] in ("nav", "aside", "form", "footer") or page.bits[i] & _UNWANTED
        inside[i] = i == article or (inside[p] and not unwanted)
    i = page.parent[article]
    while i >= 0:
        around[i] = True
        i = page.parent[i]
    return [a or b for a, b in zip(inside, around, strict=True)]


def _paragraphs(page: Page) -> list[str]:
    """The paragraphs outside all marked side matter, if one is long: texts for layouts where no page marks its article."""
    barred = [False] * len(page.tag)
    out = []
    for i in range(1, len(page.tag)):
        up = page.parent[i]
        barred[i] = barred[up] or page.tag[i] in ("nav", "aside", "form", "footer", "header") or bool(page.bits[i] & _UNWANTED)
        text = page.text[i]
        if text is not None and not barred[i] and page.tag[up] in ("p", "blockquote", "h1") and 2 * page.linked[i] < len(text):
            out.append(text)
    return out if any(len(t) >= 40 for t in out) else []


def layouts(sources: list[str], count: int, seed: int = 5, at_least: int = 0) -> list[tuple[str, list[str]]]:
    """Pages made of the blocks of the given ones in other templates, and the main texts that belong to them."""
    pick = random.Random(seed)
    parsed = [parse(source) for source in sources]
    marked = [[t for t, k in zip(page.text, teacher(page) or [], strict=False) if k and t] for page in parsed]
    articles = [b for b in marked if b] or [b for b in map(_paragraphs, parsed) if b]
    if not articles:
        return []
    esc = entities.escape
    words = lambda: pick.choice(pick.choice(articles)).split()
    some = lambda a, b: " ".join((words() * 3)[: pick.randint(a, b)])
    paragraph = lambda: esc(pick.choice(pick.choice(articles)))

    def links(tag: str) -> str:
        items = "".join(f'<li><a href="/{k}">{esc(some(1, 3))}</a></li>' for k in range(pick.randint(3, 9)))
        return f"{tag}<ul>{items}</ul>"

    def neutral() -> tuple[str, str]:
        name = "".join(pick.choice("bcdfghjkqvwxz") for _ in range(pick.randint(1, 4))) + pick.choice(["", "1", "-2", "_x"])
        return pick.choice([("div", ""), ("div", ""), ("section", ""), ("div", f' class="{name}"'), ("section", f' id="{name}"')])

    def box(kinds: list[tuple[str, str]], inner: str, unnamed: float = 0.0) -> str:
        tag, attributes = neutral() if pick.random() < unnamed else pick.choice(kinds)
        return f"<{tag}{attributes}>{inner}</{tag}>"

    named = lambda tag, *names: [(tag, f' {pick.choice(["class", "id"])}="{n}"') for n in names]
    out = []
    for blocks in articles * max(count, -(-at_least // len(articles))):
        plain = pick.choice([0.0, 0.0, 0.2, 0.8])  # how many of the boxes around the article have no telling name
        main_kinds = [("article", ""), ("main", ""), ("article", ' class="post"')] + named("div", "content", "post-content", "article-body", "entry", "main-content", "story") + named("section", "article", "post-body")
        body = []
        for k, t in enumerate(blocks):
            tag = "h1" if k == 0 and len(t) < 120 else pick.choice(["p", "p", "p", "p", "blockquote", "h2" if len(t) < 60 else "p"])
            body.append(f"<{tag}>{esc(t)}" + ("" if tag == "p" and pick.random() < 0.1 else f"</{tag}>"))
            if pick.random() < 0.08:
                body.append(box(named("div", "ad", "advert", "sponsored", "newsletter", "share", "related") + [("aside", "")], pick.choice([f"<p>{esc(some(4, 20))}</p>", esc(some(4, 20))])))
        comments = "".join(box(named("div", "comment", "reply") + [("li", ""), ("article", ' class="comment"'), ("div", ' class="comment-body"')], f"<p>{paragraph()}</p>") for _ in range(pick.randint(1, 6)))
        comments = box(named("div", "comments", "disqus", "reader-comments", "discussion") + named("section", "comments", "replies") + named("ol", "commentlist"), pick.choice(["", "<h3>Comments</h3>"]) + comments)
        inside = pick.random() < 0.3
        content = box(main_kinds, "".join(body) + (comments if inside else ""), unnamed=0.5)
        side = box([("aside", "")] + named("div", "sidebar", "widget", "related", "promo"), links(f"<h3>{esc(some(1, 3))}</h3>") + pick.choice(["", f"<p>{paragraph()}</p>"]))  # prose beside the article: always named
        top = [
            box([("nav", "")] + named("div", "nav", "menu", "navbar") + named("ul", "menu"), links(""), plain),
            box([("header", "")] + named("div", "header", "masthead", "banner"), pick.choice([f"<h1>{esc(some(1, 4))}</h1>", f"<p>{esc(some(3, 9))}</p>", esc(some(2, 6))]), plain),
            box(named("div", "cookie-notice", "notice", "consent", "alert", "popup"), pick.choice([f"<p>{esc(some(8, 30))}</p>", esc(some(5, 30))]), plain),
            box(named("div", "ad", "advert", "ads", "sponsored", "banner"), pick.choice([f"<p>{esc(some(5, 40))}</p>", esc(some(5, 40))]), plain),
            box([("form", "")] + named("form", "search", "login"), f"<label>{esc(some(1, 3))}</label><input><p>{esc(some(3, 10))}</p><button>{esc(some(1, 2))}</button>"),
        ]
        bottom = [side, box([("footer", "")] + named("div", "footer", "copyright", "site-footer"), pick.choice([f"<p>&copy; {esc(some(4, 15))}</p>", f"&copy; {esc(some(4, 40))}", links("")]), plain)]
        if not inside and pick.random() < 0.7:
            bottom.insert(0, comments)
        bottom += [t for t in top[2:] if pick.random() < 0.3]
        top = [t for t in top if pick.random() < 0.6]
        if pick.random() < 0.3:
            bottom.remove(side)
            top.append(side)
        pick.shuffle(top)
        whole = "".join([*top, content, *bottom])
        if pick.random() < 0.4:
            whole = f'<div class="{pick.choice(["wrapper", "page", "container", "site", "layout"])}">{whole}</div>'
        out.append((f"<html><body>{whole}</body></html>", blocks))
    return out


def _labels_of(page: Page, blocks: list[str]) -> list[bool]:
    """Labels of a page whose main texts are known: the leaves that are these texts in order, and all above them."""
    n, k = len(page.tag), 0
    labels = [False] * n
    barred = [False] * n
    for i in range(n):
        bad = page.tag[i] in ("nav", "aside", "form", "footer", "header") or page.bits[i] & _UNWANTED
        barred[i] = i > 0 and (barred[page.parent[i]] or bool(bad))
        if k < len(blocks) and not barred[i] and page.text[i] is not None and page.text[i] == " ".join(blocks[k].split()):
            k += 1
            j = i
            while j >= 0 and not labels[j]:
                labels[j] = True
                j = page.parent[j]
    labels[0] = True
    return labels


def train(pages: DataFrame, html: str = "html", url: str = "url") -> BoostedTrees:
    """Fit on at most ``SAMPLE`` different pages, chosen by a hash of their content: pages that mark their article
    before others, and those over ``SAMPLE_CHARS`` last.

    Only hashes are ranked; page text is read again for the chosen ones alone, one copy of each.  Without any paragraph
    to learn from everything is kept.
    """
    hashed = pages.where(F.col(html).isNotNull()).select(F.col(html).cast("string").alias("h")).withColumn("k", F.xxhash64("h"))
    ranked = hashed.groupBy("k").agg(F.max(F.length("h") > SAMPLE_CHARS).alias("long"), F.max(~F.col("h").rlike(r"(?i)<(?:article|main)[\s>]")).alias("unmarked"))
    ranked = ranked.orderBy("long", "unmarked", "k").limit(SAMPLE)
    keys = [r["k"] for r in ranked.collect()]
    sources = [r["h"] for r in hashed.where(F.col("k").isin(keys)).groupBy("k").agg(F.min("h").alias("h")).orderBy("k").collect()]
    return fit(sources)


def _unnamed(page: Page, labels: list[bool], keep: int) -> Page:
    """The page with its article's elements as plain blocks, and without the attribute words outside ``keep``."""
    content = _TAG_BITS["article"]
    tag = ["div" if t in ("article", "main") else t for t in page.tag]
    bits = [b & ~content if k else b & (keep | _TAG_BITS.get(t, 0)) for b, k, t in zip(page.bits, labels, page.tag, strict=True)]
    return Page(page.parent, tag, bits, page.text, page.linked, page.tags_inside)


def fit(sources: list[str]) -> BoostedTrees:
    """Trees of the given pages: as they are, with the article unnamed, with most words dropped, and in other layouts."""
    xs, ys = [], []
    for source in sources:
        page = parse(source)
        if (labels := teacher(page)) is not None:
            for variant in (page, _unnamed(page, labels, -1), _unnamed(page, labels, 1 << _GROUPS.index("comment"))):
                xs.append(features(variant))
                ys.append(labels)
    for source, blocks in layouts(sources, LAYOUTS, at_least=MIN_LAYOUTS):
        page = parse(source)
        xs.append(features(page))
        ys.append(_labels_of(page, blocks))
    if not xs:
        return BoostedTrees().fit(np.zeros((2, N_FEATURES), np.float32), np.array([1.0, 1.0]))
    return BoostedTrees().fit(np.vstack(xs), np.concatenate([np.array(y, dtype=float) for y in ys]))


def extract(pages: DataFrame, model: BoostedTrees, html: str = "html", out: str = "text") -> DataFrame:
    """``pages`` without the html, with the main text (empty if there is none, for null and empty pages too)."""
    shared = pages.sparkSession.sparkContext.broadcast(model)
    names = [c for c in pages.columns if c not in (html, out)]
    hidden = fresh(pages, "__html")
    source = pages.select(*[F.col(f"`{c}`") for c in names], F.coalesce(F.col(f"`{html}`").cast("string"), F.lit("")).alias(hidden))
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema.fields if f.name != hidden]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = shared.value
        for batch in batches:
            texts: list[str] = []
            for first in range(0, batch.num_rows, 64):
                group = [parse(s) for s in batch.column(hidden).slice(first, 64).to_pylist()]
                z = trees.log_odds(np.vstack([features(p) for p in group]))
                at = 0
                for p in group:
                    n = len(p.tag)
                    texts.append(kept_text(p, decode(p.parent, z[at : at + n])))
                    at += n
            kept = [batch.column(c) for c in batch.schema.names if c != hidden]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(texts, pa.string())], names=[*names, out])

    return source.mapInArrow(run, ", ".join([*fields, f"`{out}` string"]))
