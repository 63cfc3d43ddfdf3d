"""Main text of web pages by tag-path ratios.

Text lies in nodes, and every node has a path of tags from the root. For each path of a page the
text length, the punctuation and the text inside links are added up and divided by the number of its
nodes. Articles have paths of long, punctuated, link-free text; menus have many short linked nodes.
The path's weight, ``log1p(length ratio) * log1p(punctuation ratio) * (1 - link share)``, is given to
its nodes, smoothed along the page with a Gaussian, and fused with the raw weight. Paths whose fused
weight reaches a share of the page's largest are content; the element that holds most of their text,
or the outermost article (else main) element around it, is the article, and its other blocks
(headings, short paragraphs, references) belong to it. Without such an element on a flat page, where
that is the body, blocks of links are left out.

Nodes inside elements whose tag says that they are no article (menus, footers, asides ...) or that
are hidden take part in nothing. Roles, classes and ids are a factor of the weight: a container named
as a whole for such a part ("comments", "ad-slot", also a form) has paths of its own and weighs next
to nothing, one whose class has such a word among others ("share-prices") a little less than without.
It goes with all it holds unless most of its text is content. Names of inline elements, headings,
paragraphs, html, body, main and article say nothing, nor do ids made of several words (anchors of
headings), nor does the name of an element that holds most of the page's text, unless an article or
main element beside it has text (a short article with many comments).

Defined results: a null or empty page, or one without content, has an empty text; character
references are decoded, also those without a semicolon that HTML allows; an open tag at the end of a
cut page is dropped; pages of any length are read whole; repeated rows get equal texts.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict
from collections.abc import Iterator
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .batches import extend, schema_with, small_batches

CONTENT = 0.3       # share of the largest fused weight
COVER = 0.8         # share of the content text that the article element holds
SIGMA = 1.0         # of the smoothing, in nodes
MOST = 0.5          # share of the page's text from which on an element is not left out for its name, and
                    # share of a named element's text that must be content for it to stay
NAMED = {"!": 0.05, "?": 0.7}   # factors of paths below an element named as a whole, and in part
BESIDE = 0.1        # of that element's text: what articles beside it must hold to speak against this

# fixed values: element names of HTML
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track",
        "wbr"}
RAW = {"script", "style", "title", "textarea", "noscript", "iframe", "xmp", "noembed", "noframes", "template"}
BLOCK = {"address", "article", "aside", "blockquote", "body", "center", "dd", "details", "dialog", "dir", "div", "dl",
         "dt", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "head",
         "header", "hr", "html", "li", "main", "menu", "nav", "ol", "p", "pre", "section", "summary", "table",
         "tbody", "td", "tfoot", "th", "thead", "tr", "ul"}
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
          "th": {"td", "th"}, "option": {"option"}, "tbody": {"thead", "tbody", "tr", "td", "th"}}
LISTS = {"ul", "ol", "menu", "dl", "table", "select"}
# elements whose names are looked at
NAMEABLE = BLOCK - {"html", "body", "main", "article", "p", "h1", "h2", "h3", "h4", "h5", "h6", "blockquote", "pre",
                    "figcaption", "summary", "hr", "address", "dd", "dt"}
CONTAINERS = {"article", "main", "body", "div", "section", "td", "html", "#"}
# words of tags, roles, classes and ids that mark what is no article
AWAY_TAGS = {"nav", "footer", "aside", "button", "select", "dialog", "menu", "svg", "math", "object", "audio",
             "video", "canvas", "head"}
AWAY_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alert", "menu", "menubar",
              "toolbar", "form"}
AWAY_WORDS = {"ad", "ads", "advert", "adverts", "advertisement", "advertising", "banner", "sponsor", "sponsored", "promo",
              "promotion", "cookie", "cookies", "consent", "gdpr", "notice", "notices", "popup", "modal", "overlay",
              "sidebar", "widget", "widgets", "menu", "nav", "navbar", "navigation", "breadcrumb", "breadcrumbs",
              "footer", "masthead", "comment", "comments", "disqus", "reply", "replies", "respond", "share",
              "sharing", "social", "related", "recommended", "recommendations", "newsletter", "subscribe",
              "signup", "login", "toolbar", "pagination", "pager", "copyright", "hidden", "alert", "skip"}
# words that say where or how something stands, not what it is
PLACE_WORDS = {"area", "article", "articles", "author", "bar", "block", "blocks", "body", "bottom", "box", "button",
               "buttons", "center", "col", "column", "container", "content", "desktop", "fixed", "form", "global",
               "group", "header", "holder", "icons", "inner", "item", "items", "js", "layout", "left", "link", "links",
               "list", "lists", "main", "message", "messages", "mobile", "outer", "page", "panel", "post", "posts",
               "primary", "reader", "readers", "region", "right", "row", "secondary", "section", "site", "slot",
               "sticky", "stories", "story", "thread", "title", "top", "unit", "user", "users", "wrap", "wrapper",
               "zone"}

_TOKEN = re.compile(
    r"<!--.*?(?:--!?>|\Z)|<[!?][^>]*+>?|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)(?:>|\Z)|[^<]++|<", re.S)
# attributes one after another, so that a value is never searched for names
_ATTRIBUTE = re.compile(r"([^\s\"'>/=][^\s\"'>/=]*+)(?:\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s>]*+)))?")
_SPLIT = re.compile(r"[^a-z]+")
_SPACE = re.compile(r"\s+")
_PUNCTUATION = re.compile(r"[.,;:!?…。、，！？؟¿¡]")


def _named(name: str, value: str) -> str:
    """How far a class or an id is that of no article: as a whole ``!``, in part ``?``, not at all."""
    found = ""
    for token in value.split():
        words = [w for w in _SPLIT.split(token) if len(w) > 1]
        marked = [w for w in words if w in AWAY_WORDS and (w != "hidden" or token == w)]
        if not marked or words[0] in ("has", "no", "with", "without"):
            continue
        if all(w in AWAY_WORDS or w in PLACE_WORDS for w in words):
            return "!"
        if name == "class":
            found = "?"
    return found


def _away(tag: str, attributes: str, inside_article: bool) -> tuple[bool, str]:
    """Whether an element is no article at any rate, and how far its names say so."""
    if tag in AWAY_TAGS or (tag == "header" and not inside_article):
        return True, ""
    named = {"!"} if tag == "form" else set()
    for name, *values in _ATTRIBUTE.findall(attributes) if attributes else ():
        name, value = name.lower(), next(filter(None, values), "").lower()
        if name == "hidden" or (name == "aria-hidden" and value == "true"):
            return True, ""
        if name == "style" and "display:none" in value.replace(" ", ""):
            return True, ""
        if tag in NAMEABLE:
            if name == "role" and value in AWAY_ROLES:
                named.add("!")
            if name in ("class", "id"):
                named.add(_named(name, value))
    return False, "!" if "!" in named else "?" if "?" in named else ""


class _Block:
    """A run of text between block boundaries."""

    __slots__ = ("parts", "path", "chain", "linked", "named")

    def __init__(self):
        self.parts, self.path, self.chain, self.linked, self.named = [], "", (), 0, ()


class _Named:
    """What elements whose names say that they are no article hold, and articles outside them."""

    def __init__(self):
        self.total, self.around = 0, {}  # text of the page; numbers of the elements around each of them
        self.held: dict[int, int] = defaultdict(int)
        self.articles: dict[int, int] = defaultdict(int)

    def kept(self) -> frozenset[int]:
        """Those that hold most of the page, with no article beside them."""
        return frozenset(
            e for e, n in self.held.items() if n > MOST * self.total and BESIDE * n > max(
                (m for a, m in self.articles.items() if a not in self.around[e]), default=0))


def blocks(html: str) -> list[_Block]:
    """Blocks of a page in order, without those in elements that are no article at any rate."""
    out, named = _blocks(html, frozenset())
    kept = named.kept()
    return _blocks(html, kept)[0] if kept else out


def _blocks(html: str, kept: frozenset[int]) -> tuple[list[_Block], _Named]:
    out: list[_Block] = []
    # tag and mark of its name, number of the element, no article at any rate, named elements around
    stack: list[tuple[str, int, bool, tuple[int, ...]]] = [("#", 0, False, ())]
    named = _Named()
    block = _Block()
    number = at = 0

    def flush() -> None:
        nonlocal block
        if block.parts:
            out.append(block)
            block = _Block()

    def pop(to: int) -> None:
        for tag, *_ in stack[to:]:
            if tag.rstrip("!?") in BLOCK:
                flush()
                break
        del stack[to:]

    while match := _TOKEN.match(html, at):
        at = match.end()
        closing, tag, attributes = match.group(1, 2, 3) if match.group(2) else match.group(4, 5, 6)
        if tag is None:
            text = match.group()
            if text[0] == "<" and len(text) > 1 or stack[-1][2]:
                continue
            text = unescape(text)
            length = len(text.strip())
            named.total += length
            if stack[-1][3]:
                for e in stack[-1][3]:
                    named.held[e] += length
            elif length and not kept:
                for t, n, *_ in stack:
                    if t in ("article", "main"):
                        named.articles[n] += length
            if not block.parts and not text.strip():
                continue
            block.parts.append(text)
            if not block.path and text.strip():
                block.path = "/".join(t for t, *_ in stack)
                block.chain = tuple(n for _, n, *_ in stack)
                block.named = stack[-1][3]
            if any(t == "a" for t, *_ in stack):
                block.linked += length
            continue
        if match.end() == len(html) and match.group()[-1] != ">":
            break  # a tag that the end of the page cut off
        tag = tag.lower()
        if closing:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0].rstrip("!?") == tag:
                    pop(i)
                    break
            else:
                if tag == "p":
                    flush()
            continue
        if tag in BLOCK:
            flush()
            for i in range(len(stack) - 1, -1, -1):  # a block ends an open paragraph
                if stack[i][0] == "p":
                    pop(i)
                    break
                if stack[i][0].rstrip("!?") in BLOCK:
                    break
        if tag in CLOSES:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0].rstrip("!?") in CLOSES[tag]:
                    pop(i)
                elif stack[i][0].rstrip("!?") in LISTS:
                    break
        number += 1
        if tag in VOID:
            if tag == "br" and block.parts:
                block.parts.append(" ")
            continue
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}(?=[\s/>]|\Z)[^>]*>?", re.I).search(html, at)
            at = end.end() if end else len(html)
            continue
        if attributes and attributes.endswith("/") and tag in ("path", "circle", "rect", "use"):
            continue
        inside = any(t in ("article", "main") for t, *_ in stack)
        away, by_name = _away(tag, attributes, inside)
        if by_name and number not in kept:
            named.around[number] = {n for _, n, *_ in stack}
            stack.append((tag + by_name, number, stack[-1][2] or away, (*stack[-1][3], number)))
        else:
            stack.append((tag, number, stack[-1][2] or away, stack[-1][3]))
    flush()
    return [b for b in out if b.path], named


def path_weights(paths: list[str], lengths: np.ndarray, marks: np.ndarray, linked: np.ndarray) -> np.ndarray:
    """Weight of each node's path, from the sums over the path's nodes."""
    index = {p: i for i, p in enumerate(dict.fromkeys(paths))}
    of = np.array([index[p] for p in paths])
    n = np.bincount(of)
    length, mark, link = (np.bincount(of, weights=x) for x in (lengths, marks, linked))
    share = link / np.maximum(length, 1)
    return (np.log1p(length / n) * np.log1p(mark / n) * (1 - np.minimum(share, 1)))[of] * name_factors(paths)


def name_factors(paths: list[str]) -> np.ndarray:
    """Factor of each path for the named elements on it."""
    return np.array([math.prod(f ** p.count(mark) for mark, f in NAMED.items()) for p in paths])


def smooth(x: np.ndarray, sigma: float = SIGMA) -> np.ndarray:
    reach = max(1, math.ceil(3 * sigma))
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    total = np.convolve(np.ones(len(x)), kernel)[reach:-reach]
    return np.convolve(x, kernel)[reach:-reach] / total


def extract(html: str | None) -> str:
    """Main text: blocks joined by an empty line."""
    found = blocks(html or "")
    texts = [_SPACE.sub(" ", "".join(b.parts)).strip() for b in found]
    if not texts:
        return ""
    lengths = np.array([len(t) for t in texts], float)
    marks = np.array([len(_PUNCTUATION.findall(t)) for t in texts], float)
    linked = np.array([b.linked for b in found], float)
    weight = path_weights([b.path for b in found], lengths, marks, linked)
    fused = weight * smooth(weight)
    plain = np.array(["!" not in b.path for b in found])
    if fused[plain].max(initial=0) <= 0 and (plain.any() or fused.max() <= 0):  # text without punctuation
        fused = lengths * (1 - np.minimum(linked / np.maximum(lengths, 1), 1)) * name_factors([b.path for b in found])
    if fused.max() <= 0:
        return ""
    content = fused >= CONTENT * fused.max()
    shares: dict[int, np.ndarray] = defaultdict(lambda: np.zeros(2))
    for b, length, chosen in zip(found, lengths, content):
        for element in b.named:
            shares[element] += (length, length * chosen)
    out = {element for element, (length, chosen) in shares.items() if chosen < MOST * length}
    content &= np.array([out.isdisjoint(b.named) for b in found])
    held: dict[int, float] = defaultdict(float)
    depth: dict[int, int] = {}
    for b, length, chosen in zip(found, lengths, content):
        if chosen:
            for d, element in enumerate(b.chain):
                held[element] += length
                depth[element] = d
    most = [e for e, h in held.items() if h >= COVER * lengths[content].sum()]
    article = max(most, key=lambda e: depth[e], default=None)
    if article is not None:  # of one long paragraph or of inline elements it is the container around
        block = next(b for b in found if article in b.chain)
        tags, i = [t.rstrip("!?") for t in block.path.split("/")], block.chain.index(article)
        while i and tags[i] not in CONTAINERS:
            i -= 1
        i = next((tags.index(t) for t in ("article", "main") if t in tags[:i + 1]), i)
        article, flat = block.chain[i], tags[i] in ("#", "html", "body")
    links = linked / np.maximum(lengths, 1)
    return "\n\n".join(t for t, b, chosen, link in zip(texts, found, content, links)
                       if t and out.isdisjoint(b.named) and (chosen or (article in b.chain and (link < 0.7 or not flat))))


def extract_text(df: DataFrame, *, html: str = "html") -> DataFrame:
    """``df`` with text (main text of the page) and n_chars (its code points) instead of the page."""
    small_batches(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [extract(x) for x in batch.column(html).to_pylist()]
            yield extend(batch, {"text": pa.array(texts, pa.string()),
                                 "n_chars": pa.array([len(t) for t in texts], pa.int64())},
                         drop=(html, "text", "n_chars"))

    return df.mapInArrow(run, schema_with(df, "text string, n_chars bigint", drop=(html, "text", "n_chars")))
