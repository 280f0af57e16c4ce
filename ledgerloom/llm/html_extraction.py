"""Main text of web pages as a maximum-scoring subsequence of their tokens."""

from __future__ import annotations

import html as entities
import math
import re
from collections import Counter

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Pages that the weights are learned from, by the hash of their id, and the longest taken.
SAMPLE, SAMPLE_CHARS = 500, 200_000

# Elements by their role in HTML.
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
RAW = {"script", "style", "textarea", "title", "noscript", "iframe", "template", "xmp", "noembed", "noframes"}
INLINE = {
    "a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins",
    "kbd", "label", "mark", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup",
    "time", "tt", "u", "var", "wbr", "img", "math", "mfrac", "mi", "mn", "mo", "mover", "mrow", "mspace", "msqrt",
    "mstyle", "msub", "msubsup", "msup", "mtext", "munder", "munderover", "semantics",
}
OUTSIDE = {
    "head", "nav", "header", "footer", "aside", "form", "menu", "dialog", "button", "select", "svg", "canvas", "object",
    "audio", "video", "map", "fieldset", "datalist",
}
#: Names of what surrounds an article, as classes and ids have them.
NAMES = {
    "ad", "ads", "adv", "advert", "adverts", "advertisement", "advertising", "adsense", "adslot", "banner", "sponsor",
    "sponsored", "promo", "promotion", "cookie", "cookies", "consent", "gdpr", "notice", "notices", "notification",
    "alert", "sidebar", "sidenav", "menu", "nav", "navbar", "navigation", "breadcrumb", "breadcrumbs", "topbar",
    "toolbar", "masthead", "header", "footer", "comment", "comments", "commentlist", "disqus", "discussion", "reply",
    "replies", "respond", "share", "sharing", "social", "related", "recommended", "newsletter", "subscribe", "signup",
    "login", "popup", "modal", "overlay", "widget", "widgets", "pagination", "pager", "copyright", "legal", "skip",
    "search", "form", "teaser", "outbrain", "taboola",
}
#: Of these, names that parts of an article have as well.
AMBIGUOUS = {
    "alert", "banner", "copyright", "discussion", "form", "header", "legal", "modal", "notice", "notices",
    "notification", "overlay", "promotion", "replies", "reply", "respond", "search", "skip", "teaser",
}
#: Parts that a class may have beside the names above.
FILLERS = {
    "area", "bar", "block", "bottom", "box", "buttons", "items", "left", "links", "list", "main", "posts", "primary",
    "right", "secondary", "section", "site", "slot", "top",
}
#: Words that an element with an ambiguous name outside an article must have to be kept.
AMBIGUOUS_COST = 20
ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "alert", "menu", "menubar", "note"}
WHOLE = {"html", "body", "article", "main"}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
#: Blocks of running text, and what else may stand between two that belong together; around a heading
#: also its wrappers.
PROSE = {"p", "blockquote", "pre"} | HEADINGS
BETWEEN = PROSE | {"br", "hr", "figure", "wbr", "img"}
WRAPPERS = {"div", "section", "header", "hgroup"}
#: Opening one of these ends a paragraph that was left open.
ENDS_P = {
    "p", "div", "ul", "ol", "dl", "table", "pre", "blockquote", "section", "article", "aside", "header", "footer", "nav",
    "form", "h1", "h2", "h3", "h4", "h5", "h6", "hr", "main", "figure", "address", "fieldset", "details", "menu",
}

_TOKEN = re.compile(
    # <!--> and <!---> are whole, empty comments.
    r"<!--(?:-?>|.*?(?:--!?>|\Z))|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+'|[\"'])*+)(?:>|\Z)|<[!?/][^>]*+(?:>|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
_PARTS = re.compile(r"[^a-z0-9]+|(?<=[a-z])(?=[A-Z])")
_SPACE = re.compile(r"\s+")


def _named(value: str) -> str:
    """What the classes or the id say: ``outside``, ``ambiguous`` or nothing. A class counts as a whole:
    all of its parts must be such names or fillers, so that ``has-sidebar`` says nothing."""
    found = ""
    for token in re.sub(r"([a-z])([A-Z])", r"\1-\2", value).lower().split():
        parts = {x for x in _PARTS.split(token) if x}
        names = parts & NAMES
        if "".join(_PARTS.split(token)) in NAMES:
            names, parts = {"".join(_PARTS.split(token))}, set()
        if names and parts - names <= FILLERS:
            if names - AMBIGUOUS:
                return "outside"
            found = "ambiguous"
    return found


def _unwanted(name: str, attributes: str, in_article: bool) -> tuple[bool, str]:
    """Whether an element is of a kind that is never part of the article, and what its names say."""
    if name in WHOLE:
        return False, ""
    if name in OUTSIDE:
        return not (name == "header" and in_article), ""
    if not attributes or attributes.isspace():
        return False, ""
    said = ""
    for key, value in _ATTRIBUTE.findall(attributes):
        key, value = key.lower(), value.strip("\"'")
        if key in ("class", "id"):
            said = max(said, _named(value))  # outside, ambiguous, nothing
        elif key == "role" and value.lower() in ROLES:
            return True, ""
        elif key == "hidden" or key == "aria-hidden" and value.lower() == "true":
            return True, ""
        elif key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
            return True, ""
    return False, said


def _left_out(out: list[tuple], spans: list[list]) -> list[list]:
    """The named elements that are no part of the article. One that holds an article, or that holds blocks
    and in them most of the words of the article or page it stands in, is never left out, and one of
    ambiguous name only outside articles and if it is short."""
    words, inner = [0], [0]
    for kind, value, wanted, inside in out:
        n = len(value.split()) if kind == "text" and wanted else 0
        words.append(words[-1] + n)
        inner.append(inner[-1] + n * inside)
    left = []
    for span in spans:
        a, b, said, inside = span
        of = inner if inside else words
        n = of[b] - of[a]
        holds = not inside and inner[b] > inner[a]
        most = 2 * n > of[-1] and any(out[i][0] == "open" and out[i][1] not in INLINE for i in range(a + 1, b))
        if not (holds or most or said == "ambiguous" and (inside or n >= AMBIGUOUS_COST)):
            left.append(span)
    return left


def tokens(page: str) -> list[tuple[str, str, bool, bool]]:
    """(kind, value, wanted, in_article) in page order; kind is ``text`` with decoded text, ``open`` or
    ``close`` with an element's name. Text inside unwanted elements is not wanted, nor is text inside named
    ones that are left out. Tags that are not
    closed, or closed without being open, are borne with; comments and raw elements leave nothing."""
    out: list[tuple[str, str, bool, bool]] = []
    open_: list[tuple[str, bool, list | None]] = []
    spans: list[list] = []  # of elements whose names speak against them
    bad = inside = 0
    at, end = 0, len(page)
    while at < end:
        m = _TOKEN.search(page, at)
        stop = m.start() if m else end
        if stop > at:
            out.append(("text", entities.unescape(page[at:stop]), not bad, inside > 0))
        if not m:
            break
        at = m.end()
        name = (m[2] or "").lower()
        if not name:
            continue
        if m[1]:
            depth = next((k for k in range(len(open_) - 1, -1, -1) if open_[k][0] == name), None)
            # A stray end tag inside an article doesn't end what stands around the article.
            if depth is not None:
                for other, unwanted, span in open_[depth:]:
                    bad -= unwanted
                    inside -= other in ("article", "main")
                    if span:
                        span[1] = len(out)
                del open_[depth:]
            out.append(("close", name, not bad, inside > 0))
            continue
        if name in RAW:
            close = re.compile(rf"</{re.escape(name)}(?=[\s/>])[^>]*>?", re.I).search(page, at)
            at = close.end() if close else end
            continue
        if name in ENDS_P and open_ and any(o[0] == "p" for o in open_):
            k = max(i for i, o in enumerate(open_) if o[0] == "p")
            if all(o[0] in INLINE for o in open_[k + 1 :]):
                bad -= sum(o[1] for o in open_[k:])
                for o in open_[k:]:
                    if o[2]:
                        o[2][1] = len(out)
                del open_[k:]
        unwanted, said = _unwanted(name, m[3], inside > 0)
        out.append(("open", name, not (bad or unwanted), inside > 0))
        if name not in VOID and not m[3].endswith("/"):
            span = [len(out) - 1, None, said, inside > 0] if said and not bad else None
            if span:
                spans.append(span)
            open_.append((name, unwanted, span))
            bad += unwanted
            inside += name in ("article", "main")
    for span in spans:
        span[1] = len(out) if span[1] is None else span[1]
    after = 0  # spans are in page order; nested ones are passed once
    for a, b, _, _ in _left_out(out, spans) if spans else []:
        for i in range(max(a, after), b):
            kind, value, _, within = out[i]
            out[i] = (kind, value, False, within)
        after = max(after, b)
    return out


def learn_weights(pages: list[str]) -> dict[str, float]:
    """Log odds of each kind of tag, and of words, to stand inside the article, from pages that mark it.
    Words come out positive and are held to 0.2 at least; tags that are not clearly of the article are
    held below zero, by more if they stand outside."""
    inner, outer = Counter(), Counter()
    for page in pages:
        for kind, value, _, inside in tokens(page):
            of = inner if inside else outer
            if kind == "text":
                of["word"] += len(value.split())
            else:
                of[f"{kind} {value}"] += 1
    n, m = sum(inner.values()) + 1, sum(outer.values()) + 1
    odds = {k: math.log((inner[k] + 1) / n) - math.log((outer[k] + 1) / m) for k in inner | outer}
    weights = {k: max(-10.0, min(-0.1, v - 1)) for k, v in odds.items()}
    return weights | {"word": min(1.0, max(0.2, odds.get("word", 1.0)))}


def best_region(scores: list[float]) -> tuple[int, int]:
    """The contiguous range with the greatest sum, the first of equals; empty if no score is positive."""
    best, span, total, start = 0.0, (0, 0), 0.0, 0
    for i, s in enumerate(scores):
        if total <= 0:
            total, start = 0.0, i
        total += s
        if total > best:
            best, span = total, (start, i + 1)
    return span


def _bounds(found: list[tuple], begin: int, end: int) -> tuple[int, int]:
    """The region grown to whole blocks: to the next tags on both sides that are not inline."""
    def within(token: tuple) -> bool:
        return token[0] == "text" or token[1] in INLINE

    while begin > 0 and within(found[begin - 1]):
        begin -= 1
    while end < len(found) and within(found[end]):
        end += 1
    return begin, end


def _linked(block: list[tuple]) -> bool:
    """Whether most of a block's words stand in links."""
    inside = linked = words = 0
    for kind, value, _, _ in block:
        if kind == "text":
            words += len(value.split())
            linked += len(value.split()) * (inside > 0)
        elif value == "a":
            inside = max(0, inside + (1 if kind == "open" else -1))
    return 2 * linked > words


def _grown(found: list[tuple], begin: int, end: int) -> tuple[int, int]:
    """The region with the blocks that its edges cut, and the blocks of text and headings next to it
    whose words did not pay for their tags. Headings alone are taken in front only: behind, they open
    what follows."""
    begin, end = _bounds(found, begin, end)

    def blank(token: tuple) -> bool:
        return token[0] == "text" and not token[1].strip()

    def passes(token: tuple, names: set[str]) -> bool:
        return blank(token) or token[2] and token[0] != "text" and (token[1] in names or token[1] in INLINE)

    i = begin
    while True:
        while i > 0 and passes(found[i - 1], BETWEEN | WRAPPERS):
            i -= 1
        if i == 0 or found[i - 1][0] != "text" or not found[i - 1][2]:
            break
        a, b = _bounds(found, i - 1, i)
        if a == 0 or found[a - 1][0] != "open" or found[a - 1][1] not in PROSE or _linked(found[a:b]):
            break
        if found[a - 1][1] not in HEADINGS and not all(passes(t, BETWEEN) for t in found[b:begin]):
            break
        i = begin = a - 1
    i = end
    while True:
        while i < len(found) and passes(found[i], BETWEEN):
            i += 1
        if i == len(found) or found[i][0] != "text" or not found[i][2]:
            break
        a, b = _bounds(found, i, i + 1)
        if found[a - 1][0] != "open" or found[a - 1][1] not in PROSE or _linked(found[a:b]):
            break
        i = b
        if found[a - 1][1] not in HEADINGS:
            end = b
    return begin, end


def extract(page: str, weights: dict[str, float]) -> str:
    """The main text of one page, '' if it has none. Inside the best region nothing but unwanted
    elements is left out; blocks are lines, with single spaces."""
    found = tokens(page)
    # If the page marks its article, what lies outside can't gain.
    marked = any(kind == "text" and inside and wanted and value.strip() for kind, value, wanted, inside in found)
    scores = []
    for kind, value, wanted, inside in found:
        if kind == "text":
            n = len(value.split())
            scores.append(n * weights["word"] if wanted and (inside or not marked) else -0.1 * n)
        else:
            scores.append(min(-0.1, weights.get(f"{kind} {value}", -0.5)))
    begin, end = best_region(scores)
    if begin < end:
        begin, end = _grown(found, begin, end)
    # The article is one element: texts cut off by their own tags' cost still belong to it.
    if begin < end and marked:
        while begin > 0 and found[begin - 1][3]:
            begin -= 1
        while end < len(found) and found[end][3]:
            end += 1
    lines, line = [], []
    for kind, value, wanted, inside in found[begin:end]:
        if kind == "text":
            if wanted and (inside or not marked):
                line.append(value)
        elif value not in INLINE:
            lines.append("".join(line))
            line = []
    lines.append("".join(line))
    return "\n".join(x for x in (_SPACE.sub(" ", s).strip() for s in lines) if x)


def fit(pages: DataFrame, id: str = "page_id", html: str = "html") -> dict[str, float]:
    """Weights from a bounded sample of the pages that mark their article, SAMPLE of them by the hash of
    the id. Without any such page the weights are those of no evidence."""
    marked = pages.where(F.col(html).rlike("(?i)<(article|main)[\\s>]") & (F.length(html) <= SAMPLE_CHARS))
    ids = marked.select(F.col(id).alias("id")).orderBy(F.xxhash64("id"), "id").limit(SAMPLE)
    sample = pages.select(F.col(id).alias("id"), F.col(html).alias("html")).join(ids.distinct(), "id").where(
        F.length("html") <= SAMPLE_CHARS
    )
    rows = sample.orderBy(F.xxhash64("id"), F.xxhash64("html")).limit(SAMPLE).select("html").collect()
    return learn_weights(sorted(r["html"] for r in rows))


def main_text(html: Column, weights: dict[str, float]) -> Column:
    @F.pandas_udf("string")
    def of(pages: pd.Series) -> pd.Series:
        return pd.Series([extract(p, weights) for p in pages.fillna("")], dtype=object)

    return of(F.coalesce(html, F.lit("")))


def extracted(pages: DataFrame, weights: dict[str, float], html: str = "html") -> DataFrame:
    """``pages`` with ``main_text``. Null and empty pages have an empty text."""
    return pages.withColumn("main_text", main_text(F.col(html), weights))
