"""The main text of a web page by block rules in two passes.

A page is a sequence of blocks, the text between two block tags. The first pass puts out what
lies in navigation, adverts, forms and the like. It decides the other blocks by link density, length
and the density of stop words, and leaves short or middling blocks open. Inside an article or
main element a block goes out for its links alone, and in from SHORT words on. On a page whose
text has few stop words of the lists, which is then in another language or script, length and links decide.
The second pass gives open blocks the label of the nearest decided neighbours, those of an article within it:
of both if they agree. Else a block of an article goes in, and another one if it has enough stop words
and no links. On a page without article and without any block that is in, the open ones are the text if they
have half of SHORT words together. White space within a block becomes one space; blocks are joined by one space.

Defined results: null or empty html, and a page without main text, give an empty text. What
an unclosed comment, tag, script or style swallows is not text, as in a browser. Pages are read
whole, whatever their length, in linear time; every row gives a row; other columns are
not read.
"""

from __future__ import annotations

import re
from html import unescape
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from pagemill.llm.worker import travels

travels(__name__)

# Elements whose content is no text, void elements, elements that break a block.
SILENT = frozenset("script style title noscript template textarea svg math iframe object canvas audio video select".split())
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p "
    "pre search section summary table tbody td tfoot th thead tr ul".split()
)
#: Containers of anything but main text, by element and by name in class, id or role. A name of several words counts if
#: all of them are listed here or among the words that say only where or how such a container stands.
OUTSIDE = frozenset("nav aside footer form button dialog menu head".split())
OUTSIDE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments complementary "
    "contentinfo cookie cookies consent disclaimer disqus footer gdpr login masthead menu modal nav navbar navigation "
    "newsletter notice notices pagination pager popup promo promoted promotion related replies reply respond search "
    "share sharing sidebar signup social sponsor sponsored subscribe subscription tags toolbar widget widgets".split()
)
READERS = frozenset("comment comments disqus replies reply respond".split())
BESIDE = frozenset(
    "all area articles bar bars block body bottom box buttons col column container content external fixed floating follow form "
    "global group header icons inline inner item items latest left link links list main more outer overlay page policy post "
    "posts primary reader readers recent right secondary section site slot sticky thread top unit us user visitor wrap wrapper x".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
ARTICLE = frozenset(("article", "main"))
#: Frequent function words of English, German, French, Spanish, Italian and Portuguese.
STOP_WORDS = frozenset(
    "a about after all also an and are as at be been but by can did do for from had has have he her his how i if in into "
    "is it its more no not of on only or other our out she so some than that the their them then there they this to up "
    "was we were what when which who will with would you your "
    "aber als am auch auf aus bei bin bis das dass dem den der des die doch ein eine einem einen einer er es für hat "
    "ich im ist ja kann mit nach nicht noch nur oder sein sich sie sind so über um und uns von vor war was wenn wie wir "
    "zu zum zur "
    "au aux avec ce cette ces dans de des du elle en est et il ils je la le les leur lui mais ne nous on ou où par pas "
    "pour qu que qui sa se ses son sont sur un une vous y "
    "al como con del el ella en entre era es esta este fue ha hay la las lo los más me mi muy no o para pero por que se "
    "si sin sobre su sus también un una uno y ya "
    "che da di e gli i il non per più sono ao as com dos em foi mais mas na nas nos não os pela pelo são uma".split()
)
#: The thresholds: words of a short and of a long block, stop-word and link densities; what is almost all links.
SHORT, LONG, STOPS_LOW, STOPS_HIGH, LINKS, ALL_LINKS = 12, 30, 0.15, 0.25, 0.34, 0.8

_TAG = re.compile(r"<(?:(!--)|(/?)([a-zA-Z][^\s/>]*)|[!?/])")
_TAG_END = re.compile(r"[^>\"']*(?:\"[^\"]*\"[^>\"']*|'[^']*'[^>\"']*)*+>")
_ATTRIBUTE = re.compile(r"([^\s\"'>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_NAME_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
#: Scripts written without blanks between words: two characters count as a word.
_UNSPACED = re.compile("[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\U00020000-\U0003ffff]")
_STRIP = ".,;:!?()[]\"'«»„“”"


class Block(NamedTuple):
    text: str
    linked: int  # characters inside links
    inside: bool  # of an article
    outside: bool  # of any text container


def _names(value: str, listed: frozenset[str]) -> bool:
    """Whether a name in `value` is made of listed words and of words that go beside them."""
    for name in value.split():
        parts = {part.lower() for part in _NAME_PARTS.findall(name)}
        if not parts.isdisjoint(listed) and parts <= OUTSIDE_WORDS | BESIDE:
            return True
    return False


def _outside(tag: str, attributes: str, in_article: bool) -> tuple[bool, bool]:
    """Whether an element holds no main text, and whether it holds readers' comments."""
    values, anchor = [], ""
    if "=" in attributes or "hidden" in attributes.lower():
        for name, *value in _ATTRIBUTE.findall(attributes):
            name = name.lower()
            if name == "hidden":
                return True, False
            if name == "id" and tag == "section" and in_article:
                anchor = "".join(value)
            elif name in ("class", "id", "role"):
                values.append("".join(value))
    # A heading within an article names a part of it, as the id of a section does unless readers speak there.
    if tag in ("html", "body") or (tag in HEADINGS and in_article):
        return False, False
    joined = " ".join(values)
    readers = _names(joined, READERS) or _names(anchor, READERS)
    return tag in OUTSIDE or readers or _names(joined, OUTSIDE_WORDS), readers


def blocks_of(html: str) -> list[Block]:
    """The blocks of a page in page order."""
    found: list[Block] = []
    parts: list[str] = []
    linked = at = 0
    # Open elements: (tag, in an article, in no text container, in readers' comments).
    stack: list[tuple[str, bool, bool, bool]] = []
    open_tags: dict[str, int] = {}
    lower: str | None = None

    def close() -> None:
        nonlocal linked
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                _, inside, outside, _ = stack[-1] if stack else ("", False, False, False)
                found.append(Block(text, linked, inside, outside))
            parts.clear()
        linked = 0

    def add(text: str) -> None:
        nonlocal linked
        if text:
            if "&" in text:
                text = unescape(text)
            parts.append(text)
            if open_tags.get("a"):
                linked += len(text.strip())

    while (m := _TAG.search(html, at)) is not None:
        add(html[at : m.start()])
        comment, ending, tag = m.groups()
        if comment:
            at = html.find("-->", m.start() + 2) + 3
            if at < 3:
                at = len(html)
            continue
        if tag is None:  # declarations and stray marks
            at = html.find(">", m.end()) + 1 or len(html)
            continue
        end = _TAG_END.match(html, m.end())
        if end is None:
            at = len(html)
            break
        at, tag = end.end(), tag.lower()
        if ending:
            if tag in BLOCKS:
                close()
            if open_tags.get(tag):
                while True:
                    name = stack.pop()[0]
                    open_tags[name] -= 1
                    if name == tag:
                        break
            continue
        if tag in SILENT:
            lower = html.lower() if lower is None else lower
            if len(lower) != len(html):  # a letter whose lower case is longer
                lower = "".join(c.lower() if c.isascii() else c for c in html)
            if not end.group().endswith("/>") or tag not in ("svg", "math"):
                at = lower.find("</" + tag, at)
                if at < 0:
                    at = len(html)
            continue
        if tag == "br":
            parts.append(" ")
            continue
        if tag in BLOCKS:
            close()
        if tag in VOID:
            continue
        # A paragraph, item or cell ends the one before it.
        if tag in ("p", "li", "dt", "dd", "tr", "td", "th", "option") and stack and stack[-1][0] == tag:
            open_tags[stack.pop()[0]] -= 1
        _, inside, outside, readers = stack[-1] if stack else ("", False, False, False)
        bad, by_readers = _outside(tag, end.group()[:-1], inside)
        if tag in ARTICLE:
            inside, outside = (inside or not (bad or readers)), bad or by_readers or readers
        elif tag == "header":
            outside = outside or not inside or bad
        else:
            outside = outside or bad
        stack.append((tag, inside, outside, readers or by_readers))
        open_tags[tag] = open_tags.get(tag, 0) + 1
    add(html[at:])
    close()
    return found


class Counts(NamedTuple):
    words: float
    stops: int
    links: float  # share of the characters


def counts_of(block: Block) -> Counts:
    words = block.text.lower().split()
    unspaced = len(_UNSPACED.findall(block.text))
    stops = sum(w.strip(_STRIP) in STOP_WORDS for w in words)
    return Counts(max(len(words), unspaced / 2), stops, block.linked / len(block.text))


def first_pass(block: Block, counts: Counts, known: bool) -> bool | None:
    """In, out, or open. `known`: the stop-word lists cover the language of the page."""
    if block.outside:
        return False
    words, stops, links = counts
    if block.inside:
        if links > ALL_LINKS and words < LONG:
            return False
        return None if links > LINKS or words < SHORT else True
    if links > LINKS:
        return False
    if words < SHORT:
        return None if not block.linked else False
    if not known:
        return True if words >= LONG else None
    if stops >= STOPS_HIGH * words and words >= LONG:
        return True
    return None if stops >= STOPS_LOW * words else False


def second_pass(blocks: list[Block], counts: list[Counts], decided: list[bool | None], nothing: bool | None) -> list[bool]:
    """Open blocks by their nearest decided neighbours; where there is none, that neighbour is `nothing`."""
    after = [nothing] * len(blocks)
    following = nothing
    for i in range(len(blocks) - 1, -1, -1):
        after[i] = following
        following = following if decided[i] is None else decided[i]
    out, before = [], nothing
    for block, (words, stops, _), label, later in zip(blocks, counts, decided, after):
        if label is None:
            if before == later and before is not None:
                label = before
            elif block.inside:
                label = True
            else:
                label = stops >= STOPS_HIGH * words and not block.linked and words >= SHORT
        else:
            before = label
        out.append(label)
    return out


def labels(blocks: list[Block]) -> list[bool]:
    """Both passes."""
    counts = [counts_of(b) for b in blocks]
    free = [c for b, c in zip(blocks, counts) if not b.outside]
    known = sum(c.stops for c in free) >= STOPS_HIGH * sum(c.words for c in free)
    decided = [first_pass(b, c, known) for b, c in zip(blocks, counts)]
    out: list[bool] = [False] * len(blocks)
    for inside in (True, False):
        at = [i for i, b in enumerate(blocks) if (b.inside and not b.outside) == inside]
        chosen = second_pass([blocks[i] for i in at], [counts[i] for i in at], [decided[i] for i in at], None if inside else False)
        for i, label in zip(at, chosen):
            out[i] = label
    if not any(out) and not any(b.inside for b in blocks):
        still = [i for i, label in enumerate(decided) if label is None]
        if sum(counts[i].words for i in still) >= SHORT / 2:
            for i in still:
                out[i] = True
    return out


def main_text_of(html: str | None) -> str:
    blocks = blocks_of(html or "")
    return " ".join(b.text for b, good in zip(blocks, labels(blocks)) if good)


def main_text(html: Column) -> Column:
    """string: the main text of every page, empty if it has none."""

    @F.arrow_udf(returnType="string")
    def extract(pages: pa.Array) -> pa.Array:
        return pa.array([main_text_of(page.as_py()) for page in pages], pa.string())

    return extract(html)
