"""Main text of HTML pages: the maximum-scoring contiguous region.

A page is a sequence of words and tags.  Words score by the place they stand in,
tags cost a little; a linear scan (Kadane) finds the contiguous region with the
largest sum, and its words of positive score are the text.

Weights come from labelled pages: those with exactly one ``article`` element
label their own words as inside or outside.  A place is described by features,
the names, classes, ids and roles of the elements around it; each feature's
weight is a log ratio of its words inside to those outside, and the worst
feature of a place decides.  Features that occur together are told apart by
covering: the one with most words outside is weighed first and takes its words
along, so a list is not blamed for the menus it was seen in.  A list of names
adds what the labels can't show, parts of an article that are not its text.
"""

from __future__ import annotations

import html
import math
import re
from bisect import bisect

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Attributes as HTML reads them; a quote that is never closed ends with the tag.
_ATTR = r"""[^\s/>][^\s/>=]*(?:\s*=\s*(?:"[^"]*"|'[^']*'|[^\s>"'][^\s>]*|["'][^\s>]*))?"""
_ATTRS = rf"(?:[\s/]++|{_ATTR})*+"
# Comments, raw-text elements, tags and text.  An unclosed comment or tag runs to
# the end of the page; a raw element without an end tag is its tag and the text
# that follows.
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<![^>]*(?:>|\Z)|<\?[^>]*(?:>|\Z)"
    r"|<(?P<raw>script|style|noscript|template|textarea|title|svg|math|iframe|object|select)(?=[\s/>])"
    rf"(?:(?P<empty>{_ATTRS}(?<=/)>)|{_ATTRS}>(?:.*?</(?P=raw)(?=[\s/>])[^>]*(?:>|\Z)|[^<]*))"
    rf"|<(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<attrs>{_ATTRS})(?:>|\Z)"
    r"|(?P<text>[^<]+|<)", re.S | re.I)
ATTR = re.compile(r"""([^\s/>][^\s/>=]*)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>"'][^\s>]*|["'][^\s>]*))?""")

INLINE = set("a abbr acronym b bdi bdo big cite code data del dfn em font i img input ins kbd label mark q rp rt ruby s "
             "samp small span strike strong sub sup time tt u var wbr".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
# Elements that hold no main text.
DROPPED = set("nav header footer aside form menu head button dialog fieldset".split())   # a header outside of an article
# Classes, ids and roles that mark such elements.
MARKS = set("ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie "
            "cookies disclaimer discussion disqus footer gdpr header masthead menu menubar modal nav navbar navigation "
            "newsletter notice notices notification outbrain pagination paywall popup promo promoted promotion recommended "
            "related replies reply respond search share sharing sidebar signup skip social sponsor sponsored subscribe "
            "taboola teaser toolbar topbar widget complementary contentinfo".split())
MODIFIERS = set("with without has no not is".split())   # "no-comments" marks no comments
# An opening tag of the first kind ends an open element of the second kinds,
# unless one of the third kinds was opened in between.
ENDS = {"li": ("li", "ul ol menu"), "dt": ("dt dd", "dl"), "dd": ("dt dd", "dl"), "tr": ("tr td th", "table"),
        "td": ("td th", "tr table"), "th": ("td th", "tr table"), "option": ("option", "select datalist optgroup"),
        "optgroup": ("option optgroup", "select")}
ENDS = {name: (frozenset(ends.split()), frozenset(walls.split())) for name, (ends, walls) in ENDS.items()}
# Opening tags that end an open paragraph.
BLOCKS = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 "
                   "h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre search section table ul li dt dd".split())
P_WALLS = frozenset("button td th caption table object marquee applet html".split())
LISTED = -2.0      # weight of a listed name, at best: an article may hold such a part
LOWEST = -3.0
MILD = 0.02        # what a word in a bad place costs, of its weight: a notice must not cut an article in two
TAG = -0.01
LEAST = 20         # words outside that a feature needs to be weighed


class Page:
    """Words and tags of a page, and the elements they stand in."""

    def __init__(self, page: str):
        self.events: list[tuple[str, str, int]] = []   # ("text", "tag" or "close", value, element)
        self.names, self.marks, self.parents, self.words = [""], [()], [0], [0]
        self.articles = 0
        self.inside = [False]
        self._read(page)
        for e in range(len(self.names) - 1, 0, -1):
            self.words[self.parents[e]] += self.words[e]

    def _read(self, page: str) -> None:
        stack = [0]
        opened: dict[str, list[int]] = {}   # where on the stack each name is open

        def cut(at: int) -> None:
            """Close the elements from this place of the stack on."""
            while len(stack) > at:
                opened[self.names[stack.pop()].split()[-1]].pop()

        def last(names) -> int:
            return max((at[-1] for n in names if (at := opened.get(n))), default=-1)

        for m in TOKEN.finditer(page):
            here = stack[-1]
            if (text := m["text"]) is not None:
                self.events.append(("text", text, here))
                self.words[here] += len(text.split())
                continue
            name = (m["name"] or "").lower()
            if not name:
                continue
            if m["close"]:
                # The nearest open element of that name, and what it holds; a stray end tag closes nothing.
                if places := opened.get(name):
                    cut(places[-1])
                self.events.append(("close", name, stack[-1]))
                continue
            if name in BLOCKS and (at := last(("p",))) > last(P_WALLS):
                cut(at)
            if name in ENDS:
                ends, walls = ENDS[name]
                wall = last(walls)
                if inner := [places[bisect(places, wall)] for n in ends if (places := opened.get(n)) and places[-1] > wall]:
                    cut(min(inner))
            here = stack[-1]
            inside = self.inside[here] or name == "article"
            self.articles += name == "article"
            self.names.append("article header" if name == "header" and self.inside[here] else name)
            self.marks.append(_marks(m["attrs"]))
            self.parents.append(here)
            self.words.append(0)
            self.inside.append(inside)
            e = len(self.names) - 1
            self.events.append(("tag", name, e))
            if name not in VOID:
                opened.setdefault(name, []).append(len(stack))
                stack.append(e)

    def features(self, e: int) -> tuple[str, ...]:
        """What an element adds to the places in it, the most telling first.  The
        marks of one that holds most of the page's words say nothing, nor does a
        form around them: themes put layout words there."""
        own = self.names[e]
        if 2 * self.words[e] <= self.words[0]:
            return *self.marks[e], own
        return () if own == "form" else (own,)


def _marks(attrs: str) -> tuple[str, ...]:
    out = []
    for key, value in ATTR.findall(attrs) if attrs else ():
        key, value = key.lower(), value.strip("\"'").lower()
        if key == "hidden" or key == "aria-hidden" and value == "true":
            out.append("@hidden")
        elif key in ("class", "id", "role"):
            out += ["." + v for v in value.split()]
    return tuple(out)


def _listed(feature: str) -> bool:
    if not feature.startswith("."):
        return feature == "@hidden" or feature in DROPPED
    parts = [p for p in re.split(r"[^a-z]+", feature[1:]) if p]
    return bool(parts) and (parts[0] in MARKS or parts[-1] in MARKS and parts[0] not in MODIFIERS)


def places(page: Page, weights: dict[str, float]) -> list[float]:
    """Weight of the place inside every element: its worst feature's, 0 at best."""
    out = [0.0]
    for e in range(1, len(page.names)):
        got = out[page.parents[e]]
        for f in page.features(e):
            got = min(got, weights.get(f, 0.0), LISTED if _listed(f) else 0.0)
        out.append(got)
    return out


def best_region(scores: list[float]) -> tuple[int, int]:
    """First and one past the last place of the contiguous range with the largest
    sum, the first and shortest of equal ones; empty if no score is positive."""
    best = run = 0.0
    start = lo = hi = 0
    for i, s in enumerate(scores):
        if run <= 0:
            run, start = 0.0, i
        run += s
        if run > best:
            best, lo, hi = run, start, i + 1
    return lo, hi


def extract(page: str, weights: dict[str, float]) -> str:
    """Main text of one page: blocks in page order, joined by a line feed."""
    p = Page(page)
    place = places(p, weights)
    scores = []
    for kind, value, e in p.events:
        if kind == "text":
            w = 1.0 + place[e]
            scores.append(len(value.split()) * (w if w > 0 else MILD * w))
        else:
            scores.append(weights.get("tag:" + value, TAG))
    lo, hi = best_region(scores)
    blocks, held = [], []
    for kind, value, e in p.events[lo:hi]:
        if kind == "text":
            if 1.0 + place[e] > 0:
                held.append(value)
        elif value not in INLINE and held:
            blocks.append("".join(held))
            held = []
    if held:
        blocks.append("".join(held))
    return "\n".join(t for b in blocks if (t := " ".join(html.unescape(b).split())))


def _count(page: str) -> dict[tuple[str, bool], int]:
    """Words by the features around them, outermost first, and tags; inside or
    outside the page's one article, which is no feature itself."""
    p = Page(page)
    got: dict[tuple[str, bool], int] = {}
    if p.articles != 1:
        return got
    around = [""]
    for e in range(1, len(p.names)):
        own = " ".join(f.replace(" ", "_") for f in p.features(e) if f != "article")
        around.append(f"{around[p.parents[e]]} {own}" if own else around[p.parents[e]])
    for kind, value, e in p.events:
        if kind == "close" or value == "article":
            continue
        key = (around[e] if kind == "text" else "tag:" + value, p.inside[e])
        n = len(value.split()) if kind == "text" else 1
        if n:
            got[key] = got.get(key, 0) + n
    return got


def weigh(counts: list[tuple[str, bool, int]]) -> dict[str, float]:
    """Weights of features and tags from (features or tag, inside, number)."""
    words: dict[str, list[int]] = {}
    tags: dict[str, list[int]] = {}
    for key, inside, n in counts:
        (tags if key.startswith("tag:") else words).setdefault(key, [0, 0])[inside] += n

    def ratio(out: int, inside: int, base: float) -> float:
        return math.log((inside + 1) / (out + 1)) - base

    base = ratio(*(sum(v[i] for v in words.values()) for i in (0, 1)), 0.0) if words else 0.0
    left = [([f.replace("_", " ") if f == "article_header" else f for f in k.split()], v) for k, v in words.items()]
    weights: dict[str, float] = {}
    while left:
        seen: dict[str, list[int]] = {}
        for features, (out, inside) in left:
            for depth, f in enumerate(dict.fromkeys(features)):
                s = seen.setdefault(f, [0, 0, 0])
                s[0] += out
                s[1] += inside
                s[2] += depth * out
        bad = [(-s[0], s[2], f) for f, s in seen.items() if s[0] >= LEAST and ratio(s[0], s[1], base) < -1.0]
        if not bad:
            break   # the features that are left tell nothing apart
        f = min(bad)[2]
        weights[f] = max(LOWEST, ratio(seen[f][0], seen[f][1], base))
        left = [x for x in left if f not in x[0]]
    total = ratio(*(sum(v[i] for v in tags.values()) for i in (0, 1)), 0.0) if tags else 0.0
    for t, (out, inside) in tags.items():
        weights[t] = TAG * (1.0 - max(LOWEST, min(0.0, ratio(out, inside, total))))
    return weights


def learn_weights(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", sample: int = 2000,
                  max_chars: int = 200_000) -> dict[str, float]:
    """Weights from the labelled pages of at most ``sample`` ids (a documented
    bound, taken in the order of a hash of the id, with up to ``max_chars``
    characters a page).  An id that several rows hold counts by the page whose
    hash is smallest, so what comes back is bounded too."""
    rows = (pages.select(F.col(id_col).alias("_i"), F.col(html_col).alias("_h"))
            .where(f"_i is not null and length(_h) <= {int(max_chars)} and _h ilike '%<article%'"))
    ids = rows.select("_i").distinct().orderBy(F.xxhash64("_i"), "_i").limit(sample)
    rows = rows.join(F.broadcast(ids), "_i").groupBy("_i").agg(
        F.min_by("_h", F.struct(F.xxhash64("_h"), F.col("_h"))).alias("_h")).select("_h")

    def count(batches):
        for batch in batches:
            got: dict[tuple[str, bool], int] = {}
            for page in batch.column("_h").to_pylist():
                for key, n in _count(page).items():
                    got[key] = got.get(key, 0) + n
            yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in got], pa.string()), pa.array([i for _, i in got], pa.bool_()),
                                              pa.array(list(got.values()), pa.int64())], names=["key", "inside", "n"])

    counts = rows.mapInArrow(count, "key string, inside boolean, n long").groupBy("key", "inside").agg(F.sum("n").alias("n"))
    return weigh([(r.key, r.inside, r.n) for r in counts.collect()])


def main_text(pages: DataFrame, weights: dict[str, float] | None = None, id_col: str = "page_id", url_col: str = "url",
              html_col: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars) for every row, over the whole page.

    Null, empty and tag-only pages give an empty text.  Ids and urls are passed
    on, null or repeated; further columns are not looked at; an empty table gives
    no rows.  Without ``weights``
    they are learnt from ``pages``.
    """
    weights = dict(weights or learn_weights(pages, id_col, html_col))
    frame = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    kinds = {f.name: f.dataType.simpleString() for f in frame.schema.fields}

    def run(batches):
        for batch in batches:
            texts = [extract(p, weights) if p else "" for p in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    return frame.mapInArrow(run, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long")
