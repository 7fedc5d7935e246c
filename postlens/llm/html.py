"""Main text of web pages by two passes of block rules.

First pass: a page is cut into blocks at block-level tags. Blocks inside containers that never
hold the article (menus, headers, footers, sidebars, adverts, notices, forms, comments) are bad,
as are blocks that are mostly links. Other blocks are good when they are long and dense in stop
words, or part of an explicit article; short or thin ones stay ambiguous. Second pass: ambiguous
blocks take the label of the nearest decided neighbours, and where the two sides differ the block
goes with the nearer one, bad if both are as near.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_LINK_DENSITY = 0.33
LONG = 70  # code points; shorter blocks are decided by their neighbours
STOP_DENSITY = 0.20

# Frequent function words of the languages the rules are meant for.
STOP_WORDS = frozenset(
    """
    a an and are as at be been but by for from had has have he her his i if in is it its not of on or she that the
    their they this to was we were which who will with you
    aber als am an auch auf aus bei das dass dem den der des die durch ein eine einem einen einer er es für hat ich im
    in ist mit nach nicht noch nur oder sein sich sie sind so über um und von vor war wie wird zu zum zur
    a al con como de del el en es esta este fue ha la las lo los más no o para pero por que se sin su sus también un
    una y
    au aux avec ce ces cette dans de des du elle en est et il ils je la le les leur mais ne nous on ou par pas plus pour
    que qui sa se ses son sur un une vous à
    """.split()
)
# Names of HTML elements.
RAW = frozenset("script style noscript template svg math iframe object canvas textarea select title".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    """
    address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure
    footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre section
    summary table tbody td tfoot th thead tr ul
    """.split()
)
# Elements that end an open one of their own kind.
SIBLINGS = frozenset("p li dt dd option td th tr".split())
BAD_ELEMENTS = frozenset("nav footer aside form menu dialog head button label fieldset".split())
BAD_ROLES = frozenset("navigation banner contentinfo complementary search form menu menubar dialog alert".split())
ARTICLE = frozenset("article main".split())
# Words in a class or id that mark a container as no part of the article.
BAD_NAMES = frozenset(
    """
    ad ads adv advert advertisement adverts advertising banner breadcrumb breadcrumbs comment comments commentlist
    consent cookie cookies disqus footer header login masthead menu menus modal nav navbar navigation newsletter notice
    notices pagination popup promo promotion reader related replies respond share sharing sidebar signup skip social
    sponsor sponsored subscribe toolbar topbar widget widgets
    """.split()
)

_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<[!?][^>]*>?", re.S)
_ATTRIBUTE = re.compile(r"(?i)\b(class|id|role|hidden|aria-hidden)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_NAME = re.compile(r"[a-z]+")
_SPACE = re.compile(r"\s+")
_WORD = re.compile(r"[^\W\d_]+")


@dataclass
class Block:
    text: str
    linked: int
    region: int  # number of the article it is in; 0 outside
    bad: bool
    label: str = ""


def _is_bad(name: str, attributes: str, in_article: bool) -> bool:
    if name in BAD_ELEMENTS or (name == "header" and not in_article):
        return True
    for key, *values in _ATTRIBUTE.findall(attributes):
        key, value = key.lower(), "".join(values).lower()
        if key == "hidden" or (key == "aria-hidden" and value == "true"):
            return True
        if key == "role" and value in BAD_ROLES:
            return True
        if key in ("class", "id") and name not in ("html", "body"):
            names = BAD_NAMES.intersection(_NAME.findall(value))
            if names - {"header"} or (names and not in_article):
                return True
    return False


def blocks(page: str) -> list[Block]:
    """The page's blocks with a text, in order; scripts, styles and comments of the markup are none."""
    out: list[Block] = []
    open_: list[tuple[str, bool, int]] = []  # element, bad so far, article
    parts: list[str] = []
    linked = regions = 0
    in_link = False

    def flush() -> None:
        nonlocal linked
        text = _SPACE.sub(" ", "".join(parts)).strip()
        if text:
            _, bad, region = open_[-1] if open_ else ("", False, 0)
            out.append(Block(text, linked, region, bad))
        parts.clear()
        linked = 0

    def put(raw: str) -> None:
        nonlocal linked
        if raw:
            text = html.unescape(raw)
            parts.append(text)
            if in_link:
                linked += len(text.strip())

    at = 0
    while tag := _TAG.search(page, at):
        put(page[at : tag.start()])
        at = tag.end()
        name = (tag[2] or "").lower()
        if not name:
            continue
        if name in RAW and not tag[1] and not tag[3].rstrip().endswith("/"):
            end = re.compile(rf"</{re.escape(name)}\b[^>]*>", re.I).search(page, at)
            at = end.end() if end else len(page)
            continue
        if name == "br":
            parts.append(" ")
        elif name == "a":
            in_link = not tag[1]
        if name in BLOCK:
            flush()
            in_link = False
            if tag[1]:
                names = [e[0] for e in open_]
                if name in names:
                    del open_[len(names) - 1 - names[::-1].index(name) :]
            elif name not in VOID:
                if name in SIBLINGS and open_ and open_[-1][0] == name:
                    open_.pop()
                bad, region = open_[-1][1:] if open_ else (False, 0)
                if name in ARTICLE and not region:
                    regions += 1
                    region = regions
                open_.append((name, bad or _is_bad(name, tag[3], region > 0 and name not in ARTICLE), region))
        elif not tag[1] and name not in VOID and _is_bad(name, tag[3], True) and name not in ("a", "html"):
            # An inline container that is no content goes with all it holds.
            end = re.compile(rf"</{re.escape(name)}\b[^>]*>", re.I).search(page, at)
            at = end.end() if end else at
    put(page[at:])
    flush()
    return out


def _first_pass(block: Block) -> str:
    if block.bad or block.linked > MAX_LINK_DENSITY * len(block.text):
        return "bad"
    if len(block.text) < LONG:
        return ""
    words = _WORD.findall(block.text.lower())
    if sum(w in STOP_WORDS for w in words) >= STOP_DENSITY * max(1, len(words)):
        return "good"
    return "" if block.region else "bad"


def classify(found: list[Block]) -> list[Block]:
    """Label every block ``good`` or ``bad``; neighbours are asked inside one article, or outside all.

    In an article that has blocks but none decided, all its ambiguous blocks are good.
    """
    for block in found:
        block.label = _first_pass(block)
    for region in {b.region for b in found}:
        # A menu or advert inside an article says nothing about the blocks around it.
        mine = [b for b in found if b.region == region and not (region and b.bad)]
        decided = [i for i, b in enumerate(mine) if b.label]
        before, after = [None] * len(mine), [None] * len(mine)
        last = None
        for i, b in enumerate(mine):
            before[i] = last
            last = i if b.label else last
        last = None
        for i in range(len(mine) - 1, -1, -1):
            after[i] = last
            last = i if mine[i].label else last
        given = []
        for i, b in enumerate(mine):
            if b.label:
                given.append(b.label)
            elif not decided:
                given.append("good" if region else "bad")
            else:
                sides = [(abs(i - j), mine[j].label) for j in (before[i], after[i]) if j is not None]
                given.append(min(sides)[1])  # "bad" sorts before "good"
        for b, label in zip(mine, given):
            b.label = label
    return found


def main_text(page: str | None) -> str:
    """The good blocks, joined by line breaks; empty for null and for pages without an article."""
    return "\n".join(b.text for b in classify(blocks(page or "")) if b.label == "good")


def extract(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` of each row of ``page_id, url, html``; rows are independent."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(page.as_py()) for page in batch["html"]]
            yield pa.RecordBatch.from_arrays(
                [batch["page_id"], batch["url"], pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                ["page_id", "url", "text", "n_chars"],
            )

    kept = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html")
    return kept.mapInArrow(run, "page_id long, url string, text string, n_chars long")
