"""Operator 5, main text of web pages by tag-path ratios.

A page's text nodes are grouped by root-to-leaf tag path (tags with class or id).
Per path, text length and punctuation are summed and give two ratios: mean text
length of a node and mean punctuation of a node, each against the page. Ratios
are smoothed over neighbouring blocks in page order and fused; a block inside an
article or main element weighs the more, the more of the page's text that element
holds. Paths above a threshold are content, on every page. Headings, list items
and table cells are short by nature: a run of them goes with the content block
that it adjoins, unless it is made of links. Paths that run through elements for
navigation, forms, scripts and the like are never content. A class or id that
speaks of adverts, sidebars, comments and the like only lowers a path's weight:
much where the whole name does ("comment-list"), little where it also speaks of
something else ("comment-on-policy"). The ratios decide.

A block is a block-level element's own text: character references are decoded,
white space becomes one space, ends are trimmed, blocks are joined by a line feed.

Edge cases: null or empty html gives empty text; unclosed, crossed and unknown
tags are taken as browsers take them in outline (a paragraph ends at the next
block, a stray end tag is ignored, the page's end closes everything); quotes in
an unquoted attribute value are ordinary signs; text with no markup is one block;
nesting of any depth costs the same per element (a path is a number: its parent's
path and a label); repeated rows are extracted alike; other columns are ignored; an
empty table gives an empty result.
"""
from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed values of the markup language.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
BLOCK = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset
figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p
pre search section summary table tbody td tfoot th thead tr ul""".split())
#: An open element of the set ends where one of the keys starts.
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
        "th": {"td", "th"}, "option": {"option"}, "body": {"head"}}
SCOPE = frozenset("ul ol dl table body html div article section main nav aside header footer form select td th blockquote".split())

# What is not main text.
NEVER = frozenset("""script style noscript template head title nav footer aside form button select option textarea
input label fieldset dialog menu svg math canvas iframe object audio video map noembed noframes xmp search""".split())
#: Parts of a class or id (split at hyphens, underscores and capitals) ...
NOISE_PARTS = frozenset("""ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion promoted
nav navbar navigation menu breadcrumb breadcrumbs footer masthead topbar sidebar widget widgets cookie cookies consent gdpr
notice notices alert popup modal overlay toast newsletter subscribe subscription signup login share sharing social related
recommended recommendations trending comment comments commentlist disqus respond replies pagination pager toolbar
hidden copyright disclaimer banner""".split())
#: ... and whole classes or ids that mark an element as no main text.
NOISE_NAMES = frozenset("""header site-header page-header main-header top-header site_header page_header side aside rail legal
tags taglist search searchbox follow popular reply discussion skip skip-link top bottom""".split())
#: Parts that tell of another element, as in "with-sidebar".
OTHERS = frozenset("with has no without".split())
#: Parts that say nothing of an element's content.
NEUTRAL = frozenset("""area bar block bottom box button buttons card column container content group head icon icons inner item
items js left link links list main module outer page panel post posts right row section site text title top wrap wrapper""".split())
ROLE = frozenset("navigation banner contentinfo complementary search alert alertdialog dialog form menu menubar toolbar".split())
MARKED = frozenset(["article", "main"])
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
ITEMS = frozenset("li dt dd td th caption figcaption".split())
#: Elements that do not hold a text's run of blocks but are part of it.
RUN = HEADINGS | frozenset("li dt dd ul ol dl p".split())

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([A-Za-z][^\s/>]*)"
    # attributes: a name, and a value that is quoted or goes to the next space or >
    r"((?>[\s/]+|[^\s/>][^\s/>=]*+(?:\s*=\s*(?:\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z)|[^\s>\"'][^\s>]*+)?)?)*+)(?:>|\Z)", re.S)
_ATTR = re.compile(r"([^\s/>][^\s/>=]*)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"'][^\s>]*))?)?")
_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_SPACES = re.compile(r"\s+")
_PUNCT = re.compile(r"[.,;:!?…。，、；：！？]")

#: Blocks on either side that smooth a ratio, and the share of the page's mean
#: fused ratio from which a path is content.
REACH = 2
THRESHOLD = 0.35
#: Weight of paths inside a marked element that holds all the page's text; the
#: weight falls to 1 with the share of the text that the element holds.
MARKED_WEIGHT = 8.0
#: Weight of paths under a name that only speaks of what is no main text, and of
#: those under names that half do.
NAMED_WEIGHT, HALF_NAMED_WEIGHT = 0.05, 0.7
#: A block is a link from this share of link text on.
LINK_SHARE = 0.5


class Block(NamedTuple):
    path: int
    text: str
    marked: int  # number of the outermost article or main element, 0 outside
    kind: str  # "heading", "item" or ""
    link: bool
    inside: int  # path of the element that holds the block's run
    named: float  # weight by the names above it


class Paths:
    """Root-to-leaf paths as numbers. A path knows its parent, its depth and one
    far ancestor, so that an ancestor is found in few steps."""

    def __init__(self):
        self.number: dict[tuple[int, str], int] = {}
        self.parent, self.depth, self.far = [0], [0], [0]

    def below(self, parent: int, label: str) -> int:
        made = self.number.setdefault((parent, label), len(self.parent))
        if made == len(self.parent):
            f = self.far[parent]
            even = self.depth[parent] - self.depth[f] == self.depth[f] - self.depth[self.far[f]]
            self.parent.append(parent)
            self.depth.append(self.depth[parent] + 1)
            self.far.append(self.far[f] if even and parent else parent)
        return made

    def under(self, path: int, above: int) -> bool:
        """Whether ``above`` is a proper ancestor of ``path``."""
        while self.depth[path] > self.depth[above]:
            path = self.far[path] if self.depth[self.far[path]] >= self.depth[above] else self.parent[path]
            if path == above:
                return True
        return False


class _Node:
    __slots__ = ("tag", "path", "noise", "marked", "link", "named", "block", "run")

    def __init__(self, tag: str, path: int, noise: bool, marked: int, link: bool, named: float, block: int, run: int):
        self.tag, self.path, self.noise, self.marked, self.link, self.named = tag, path, noise, marked, link, named
        #: places in the stack of the block that holds it and of the element of its run
        self.block, self.run = block, run


def _noise(tag: str, attrs: dict[str, str], marked: int) -> bool:
    if tag in NEVER or "hidden" in attrs or attrs.get("aria-hidden") == "true":
        return True
    if tag == "header" and not marked:
        return True
    if attrs.get("role", "").lower() in ROLE:
        return True
    return bool(re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", attrs.get("style", ""), re.I))


def _named(tag: str, attrs: dict[str, str]) -> float:
    """Weight by an element's class and id: the lowest of its names."""
    if tag in ("body", "html"):
        return 1.0
    return min(map(name_weight, f"{attrs.get('class', '')} {attrs.get('id', '')}".split()), default=1.0)


@lru_cache(4096)
def name_weight(name: str) -> float:
    """By the share of a name's telling parts that speak of no main text."""
    if name.lower() in NOISE_NAMES:
        return NAMED_WEIGHT
    parts = [x.lower() for x in _PARTS.findall(name)]
    noise = sum(x in NOISE_PARTS for x in parts)
    if not noise or OTHERS.intersection(parts):
        return 1.0
    telling = noise + sum(x not in NOISE_PARTS and x not in NEUTRAL for x in parts)
    return NAMED_WEIGHT if noise == telling else 1 - 2 * (1 - HALF_NAMED_WEIGHT) * noise / telling


def blocks(page: str, paths: Paths | None = None) -> list[Block]:
    """Every block with text outside noise, in page order."""
    paths = paths or Paths()
    out: list[Block] = []
    stack = [_Node("", 0, False, 0, False, 1.0, 0, 0)]
    is_open: Counter[str] = Counter()
    text: list[str] = []
    at = linked = n_marked = 0

    def flush() -> None:
        nonlocal linked
        got = _SPACES.sub(" ", "".join(text)).strip()
        text.clear()
        if got:
            top = stack[-1]
            k = top.block  # a block's path ends with its block
            tags = (stack[k].tag, stack[max(0, k - 1)].tag)  # an item may hold its text in a paragraph
            kind = "heading" if tags[0] in HEADINGS else "item" if ITEMS.intersection(tags) else ""
            out.append(Block(stack[k].path, got, top.marked, kind, linked >= LINK_SHARE * len(got),
                             stack[stack[k].run].path, top.named))
        linked = 0

    def add(piece: str) -> None:
        nonlocal linked
        if piece and not stack[-1].noise:
            text.append(html.unescape(piece))
            if stack[-1].link:
                linked += len(_SPACES.sub(" ", text[-1]).strip())

    def close(tag: str, scope: frozenset | None = None) -> None:
        if not is_open[tag]:
            return
        for k in range(len(stack) - 1, 0, -1):
            if stack[k].tag == tag:
                if any(x.tag in BLOCK for x in stack[k:]):
                    flush()
                is_open.subtract(x.tag for x in stack[k:])
                del stack[k:]
                return
            if scope and stack[k].tag in scope:
                return

    pos, n = 0, len(page)
    while pos < n:
        m = _TAG.search(page, pos)
        if not m:
            break
        add(page[at: m.start()])
        pos = at = m.end()
        tag = (m[2] or "").lower()
        if not tag:
            continue
        if m[1]:
            if tag == "p" and not is_open["p"]:
                flush()
            elif tag in BLOCK:
                close(tag)
            else:
                close(tag, BLOCK)
            continue
        if tag == "br":
            add(" ")
            continue
        if tag in BLOCK:
            if tag not in ("html", "body"):
                close("p", SCOPE)
            for old in ENDS.get(tag, ()):
                close(old, SCOPE - {old})
            flush()
        if tag in VOID:
            continue
        raw = m[3].rstrip()
        attrs = {k.lower(): html.unescape(a or b or c) for k, a, b, c in _ATTR.findall(raw)} if raw else {}
        top = stack[-1]
        marked = top.marked
        if not marked and (tag in MARKED or attrs.get("role") == "main"):
            n_marked += 1
            marked = n_marked
        noise = top.noise or _noise(tag, attrs, top.marked)
        if tag in RAW:  # text up to its own end tag, never content
            end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*(?:>|\Z)", re.I).search(page, pos)
            pos = at = end.end() if end else n
            continue
        label = attrs.get("class") or attrs.get("id") or ""
        here = len(stack)
        stack.append(_Node(tag, paths.below(top.path, tag + (f".{label}" if label else "")), noise, marked,
                           top.link or tag == "a", min(top.named, _named(tag, attrs)),
                           here if tag in BLOCK else top.block,
                           here if tag in BLOCK and tag not in RUN else top.run))
        is_open[tag] += 1
    add(page[at:])
    flush()
    return out


def _smooth(values: list[float]) -> list[float]:
    """Gaussian mean over REACH neighbours on either side."""
    weight = [math.exp(-(d * d) / 2) for d in range(REACH + 1)]
    out = []
    for i in range(len(values)):
        near = range(max(0, i - REACH), min(len(values), i + REACH + 1))
        total = sum(weight[abs(i - j)] for j in near)
        out.append(sum(values[j] * weight[abs(i - j)] for j in near) / total)
    return out


def content_paths(kept: list[Block]) -> set[tuple[int, bool]]:
    """(path, marked) whose fused, smoothed ratios reach the threshold."""
    if not kept:
        return set()
    keys = [(b.path, b.marked > 0) for b in kept]
    length: dict[tuple[int, bool], list[float]] = {}
    held: dict[int, int] = {}
    for key, b in zip(keys, kept):
        s = length.setdefault(key, [0.0, 0.0, 0.0])
        s[0] += len(b.text)
        s[1] += len(_PUNCT.findall(b.text))
        s[2] += 1
        held[b.marked] = held.get(b.marked, 0) + len(b.text)
    total, signs = sum(s[0] for s in length.values()), sum(s[1] for s in length.values())
    mean, mean_signs = total / len(kept), (signs + 1) / len(kept)
    by_block = [length[key] for key in keys]
    long = _smooth([s[0] / s[2] / mean for s in by_block])
    dotted = _smooth([(s[1] + 0.5) / s[2] / mean_signs for s in by_block])
    weight = [b.named * (1 + (MARKED_WEIGHT - 1) * held[b.marked] / total if b.marked else 1.0) for b in kept]
    fused = [math.sqrt(a * b) * w for a, b, w in zip(long, dotted, weight)]
    level: dict[tuple[int, bool], float] = {}
    for key, f in zip(keys, fused):
        level[key] = level.get(key, 0.0) + f / length[key][2]
    # text-weighted mean, so that a page of one long article and many short links has a high bar
    bar = THRESHOLD * sum(f * s[0] / s[2] for f, s in zip(fused, by_block)) / sum(s[0] / s[2] for s in by_block)
    return {key for key, f in level.items() if f >= bar}


def _with_short(kept: list[Block], chosen: list[bool], paths: Paths) -> list[bool]:
    """``chosen`` and the runs of headings and items next to chosen blocks; a
    heading also needs a block below it."""
    def together(short: Block, text: Block) -> bool:  # in the same part of the page
        return short.marked == text.marked and (short.marked > 0 or paths.under(text.path, short.inside))

    out, i = list(chosen), 0
    while i < len(kept):
        end = i
        while (end < len(kept) and not chosen[end] and kept[end].kind and not kept[end].link
               and kept[end].named > NAMED_WEIGHT):
            end += 1
        if end > i:
            above = i > 0 and chosen[i - 1] and together(kept[i], kept[i - 1])
            below = end < len(kept) and chosen[end] and together(kept[end - 1], kept[end])
            last = end
            while not below and last > i and kept[last - 1].kind == "heading":
                last -= 1
            if above or below:
                out[i:last] = [True] * (last - i)
        i = max(end, i + 1)
    return out


def main_text(page: str | None) -> str:
    if not isinstance(page, str) or not page:
        return ""
    paths = Paths()
    found = blocks(page, paths)
    content = content_paths(found)
    chosen = _with_short(found, [(b.path, b.marked > 0) in content for b in found], paths)
    return "\n".join(b.text for b, ok in zip(found, chosen) if ok)


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of every page."""
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for b in batches:
            yield b.map(main_text, na_action=None)

    text = F.pandas_udf(run, "string")
    return (pages.select("page_id", "url", text("html").alias("text"))
            .withColumn("n_chars", F.length("text").cast("long")))
