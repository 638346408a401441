"""Main text of web pages by two passes of block rules.

First pass: blocks are classified by stop-word density, length and link density, and by the containers
they stand in.  Second pass: ambiguous short blocks inherit the label of the nearest decided block.
"""

from __future__ import annotations

import html as references
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Frequent function words of four languages.
STOP_WORDS = frozenset(
    """
the of and to a in is it that for on with as was be by this are from or an at not have but which
der die das und ist in den von zu mit sich auf für ein eine im dem nicht auch es an als werden aus er
le la les de des et est un une du que en qui dans pour pas sur au avec par ce se il plus sont
el los las del y que en un una es por con para se no su al lo como más o pero sus
""".split()
)

# Element names by what they mean here.
SKIPPED = frozenset("head script style noscript template svg math iframe object canvas audio video form button select textarea datalist option map nav header footer aside menu dialog".split())
RAW = frozenset("script style textarea title noscript template iframe xmp".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html li main menu nav ol p pre section summary table tbody tfoot thead tr ul caption title".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# Words of class and id names.  The first kind marks a container as no part of the article whatever else is in
# the name; the second only where all other words of the name are of the last, which say nothing of what is inside.  Of the
# second, hard ones stand a class name's one unknown word; an id may be a heading's anchor and so may not have one.
SURE_NAMES = frozenset("adsense advert adverts advertisement advertising breadcrumb breadcrumbs disqus gdpr navbar newsletter outbrain sidebar sidebars taboola".split())
HARD_NAMES = frozenset("ad ads banner cc comment comments consent cookie cookies footer menu nav navigation popup promo share sharing social sponsor sponsored subscribe subscription toolbar widget".split())
BAD_NAMES = HARD_NAMES | frozenset("disclaimer header notice notices promoted related reply replies respond".split())
VAGUE_NAMES = frozenset("area articles bar block body bottom box button buttons col column container content entry fixed form global google grid group head info inner item items js law left link links list main md modal only outer page panel policy post posts print reader right row section site slot sm sticky stories thread top user users view window wrap wrapper".split())
# Words of an article element's class that make it a pointer to another page.
TEASER_NAMES = frozenset("advert promo promoted recommended related sponsored teaser teasers".split())
BAD_ROLES = frozenset("banner navigation complementary contentinfo search form dialog alert menu menubar".split())

# A value may hold > inside quotes only right after =; a quote elsewhere is a character like others.
_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?>[^>=]++|=\s*+\"[^\"]*+\"|=\s*+'[^']*+'|=)*+)(?:>|\Z)|<[!?][^>]*(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"([^\s=\"'/>][^\s=/>]*)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_NAMES = re.compile(r"[a-z]+")
_MAIN_ROLE = re.compile(r"(?<![^\s\"'])role\s*=\s*[\"']?main(?![^\s\"'/>])", re.I)
#: Containers that an article never stands in, so that one around it has been left open.
_LEFT_OPEN = frozenset("nav menu header ul ol li div p".split())
_WORD = re.compile(r"[^\W\d_]+")


#: Elements inside a line whose content is no text: skipped up to their end, unless a block or cell begins or ends before it.
_INLINE = SKIPPED - BLOCKS - {"head", "textarea"}
_ENDS = {name: re.compile(rf"</{name}\s*>" + (rf"|</?(?:{'|'.join(sorted(BLOCKS | {'td', 'th'}))})[\s/>]" if name not in RAW else ""), re.I) for name in _INLINE}


@dataclass
class Block:
    text: str
    linked: int  # code points inside links
    bad: bool  # inside a container that is no part of the article
    inside: bool  # inside <article> or <main>
    heading: bool
    label: str = ""


def _words(name: str) -> set[str]:
    """Words of two letters or more in a name such as site-header-v2 or siteHeader."""
    return {w for w in _NAMES.findall(re.sub(r"(?<=[a-z])(?=[A-Z])", "-", name).lower()) if len(w) > 1}


def _marks_furniture(name: str, unknown: int = 0) -> bool:
    """Whether a class or id name such as cookie-notice is of a container beside the article, with up to so many unknown words."""
    words = _words(name)
    if not words.isdisjoint(SURE_NAMES):
        return True
    others = len(words - BAD_NAMES - VAGUE_NAMES)
    return not words.isdisjoint(BAD_NAMES) and others == 0 or not words.isdisjoint(HARD_NAMES) and others <= unknown


def _badness(name: str, attributes: str, inside: bool) -> int:
    """2: a container of no part of the article; 1: an article's own header, whose headings are part; else 0."""
    if name in SKIPPED:
        return 1 if name == "header" and inside else 2
    for key, *values in _ATTRIBUTE.findall(attributes) if attributes else ():
        value, key = "".join(values), key.lower()
        if key == "hidden" and value.lower() != "until-found" or key == "aria-hidden" and value.lower() == "true" or key == "role" and value.lower() in BAD_ROLES:
            return 2
        if key in ("class", "id") and name not in ("html", "body", "article", "main") and any(_marks_furniture(x, key == "class") for x in value.split()):
            return 2
        if key == "class" and name == "article" and not (words := _words(value)).isdisjoint(TEASER_NAMES) and words <= TEASER_NAMES | VAGUE_NAMES:
            return 2
    return 0


def split_blocks(page: str) -> list[Block]:
    """Blocks of text in page order, character references decoded and white space made single spaces.

    Tolerates what pages in the wild have: unclosed and crossed elements, a cut-off end, < in text.
    """
    out: list[Block] = []
    stack: list[tuple[str, int, bool]] = []  # name, badness, inside; of open block-level and bad elements
    opened: Counter = Counter()  # how many of each name the stack has
    ends: dict[str, tuple] = {}  # of each inline element, where its end was searched from last, and what was found
    parts: list[str] = []
    link_parts: list[str] = []
    heading = False
    in_link = 0
    at = 0

    def flush() -> None:
        if parts:
            text = " ".join(references.unescape("".join(parts)).split())
            if text:
                bad, inside = (stack[-1][1], stack[-1][2]) if stack else (0, False)
                linked = len(" ".join(references.unescape("".join(link_parts)).split()))
                out.append(Block(text, linked, bad > (1 if heading else 0), inside, heading))
            parts.clear()
            link_parts.clear()

    def add(text: str) -> None:
        if text:
            parts.append(text)
            if in_link:
                link_parts.append(text)

    while True:
        m = _TOKEN.search(page, at)
        add(page[at : m.start() if m else len(page)])
        if not m:
            break
        at = m.end()
        name = (m[2] or "").lower()
        if not name:
            continue
        closing = bool(m[1])
        if name == "a":
            in_link = 0 if closing else 1
            add(" " if closing else "")
        elif name == "br" or name in ("td", "th"):
            add(" ")
        block = name in BLOCKS
        if block:
            flush()
        if name in _ENDS and not closing and not m[3].endswith("/"):
            begin, end = ends.get(name, (len(page), None))  # what an earlier search found may still be ahead
            if at < begin or end and end.start() < at:
                end = _ENDS[name].search(page, at)
                ends[name] = (at, end)
            if name in RAW:
                at = end.end() if end else len(page)
                continue
            if end and end[0].lower().startswith(f"</{name}"):
                add(" ")
                at = end.end()
                continue
        if closing:
            if opened[name]:
                if not block:
                    flush()
                while True:
                    last = stack.pop()[0]
                    opened[last] -= 1
                    if last == name:
                        break
            heading = heading and name not in HEADINGS
            continue
        if block:
            heading = name in HEADINGS
            if name in ("p", *HEADINGS) or name in ("li", "dd", "dt", "tr"):  # these end an open one of their kind
                for k in range(len(stack) - 1, -1, -1):
                    if stack[k][0] == name or (stack[k][0] == "p" and name in ("p", *HEADINGS)):
                        opened.subtract(x[0] for x in stack[k:])
                        del stack[k:]
                        break
                    if stack[k][0] not in ("p", *HEADINGS):
                        break
        was_bad, was_inside = (stack[-1][1], stack[-1][2]) if stack else (0, False)
        bad = _badness(name, m[3], was_inside)
        main = name == "main" or _MAIN_ROLE.search(m[3]) is not None
        if was_bad and (main or name == "article" and all(x[0] in _LEFT_OPEN for x in stack if x[1])):
            was_bad = 0  # stands in nothing but a menu or header that was left open
        if (block or bad) and name not in VOID and not m[3].endswith("/"):
            if bad and not was_bad and not block:
                flush()
            stack.append((name, max(was_bad, bad), was_inside or main or name == "article"))
            opened[name] += 1
        if name in RAW:
            end = re.compile(rf"</{name}\s*>", re.I).search(page, at)
            if name == "title" or name == "textarea":
                flush()
            parts.clear() if bad else None
            if stack and stack[-1][0] == name:
                stack.pop()
                opened[name] -= 1
            at = end.end() if end else len(page)
    flush()
    return out


def classify(blocks: list[Block], stop_words: frozenset = STOP_WORDS, short: int = 70, long: int = 200, low: float = 0.15, high: float = 0.3, links: float = 0.35) -> None:
    """First pass, label of each block: good, bad, short (which is ambiguous), neargood.

    Outside the article element many links make a block bad, as few stop words do; inside it either makes it
    ambiguous, for an article may quote, link, list and count.  Where no longer block of the page reaches the low
    density, its language is none of the stop words': density is left out and length alone decides.  Short blocks outside
    the article element that are prose by their stop words and links, and long together, are nearly good.
    """
    density = []
    for b in blocks:
        words = _WORD.findall(b.text.lower())
        density.append(sum(w in stop_words for w in words) / max(1, len(words)))
    plain = [not b.bad and not b.heading and len(b.text) >= short and b.linked <= links * len(b.text) for b in blocks]
    known = any(d >= low for d, fine in zip(density, plain, strict=True) if fine)
    for b, d, fine in zip(blocks, density, plain, strict=True):
        d = d if known else high
        if b.bad or b.linked > links * len(b.text) and not b.inside:
            b.label = "bad"
        elif not fine:
            b.label = "short"
        elif b.inside:
            b.label = "good" if d >= low else "short"
        elif d >= high:
            b.label = "good" if len(b.text) > long else "neargood"
        else:
            b.label = "neargood" if d >= low else "bad"
    run: list[Block] = []
    for b, d in [*zip(blocks, density, strict=True), (None, 0)]:  # short blocks of prose in a row are together what a longer one is
        if b and b.label == "short" and not (b.heading or b.inside) and d >= high and b.linked <= links * len(b.text):
            run.append(b)
            continue
        if sum(len(x.text) for x in run) > long:
            for x in run:
                x.label = "neargood"
        run = []


def _sweep(blocks: list[Block], order) -> list[tuple[int, str]]:
    """For each block the distance and label of the last decided one before it in that order; "" if there is none.

    It looks on its own side of the article's border only.  What stands in a container of comments, menus, notices and such
    says nothing of the rest.
    """
    out = [(len(blocks) + 1, "")] * len(blocks)
    last, inside = None, None
    for i in order:
        b = blocks[i]
        if b.inside != inside:
            last, inside = None, b.inside
        if last is not None:
            out[i] = (abs(i - last), blocks[last].label)
        if b.label in ("good", "bad") and not b.bad:
            last = i
    return out


def inherit(blocks: list[Block]) -> list[bool]:
    """Second pass: whether each block is part of the article.

    A nearly good block is good if either nearest decided neighbour is, or if there is none and no other part of the page is
    marked as the article.  Then each
    short block takes the label of the nearest decided one; of two equally near ones that differ, bad
    outside the article element and good inside it.  A heading goes with what follows it.  Inside the
    article element a block without a decided neighbour is kept, elsewhere a short one is not.
    """
    there, back = range(len(blocks)), range(len(blocks) - 1, -1, -1)
    marked = any(b.inside and b.label in ("good", "neargood") for b in blocks)
    for b, (_, before), (_, after) in zip(blocks, _sweep(blocks, there), _sweep(blocks, back), strict=True):
        if b.label == "neargood":
            alone = not before and not after and (b.inside or not marked)
            b.label = "neargood good" if alone or "good" in (before, after) else "neargood bad"
    for b in blocks:
        b.label = b.label.removeprefix("neargood ")
    out = []
    for b, (d1, before), (d2, after) in zip(blocks, _sweep(blocks, there), _sweep(blocks, back), strict=True):
        if b.label != "short":
            out.append(b.label == "good")
        elif b.heading and after:
            out.append(after == "good")
        elif before == after:
            out.append((before or ("good" if b.inside else "bad")) == "good")
        elif d1 == d2:
            out.append(b.inside)
        else:
            out.append((before if d1 < d2 else after) == "good")
    return out


def main_text(page: str | None) -> str:
    blocks = split_blocks(page or "")
    classify(blocks)
    return "\n".join(b.text for b, keep in zip(blocks, inherit(blocks), strict=True) if keep)


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of every page; null or empty html gives an empty text.

    Pages are independent of each other: one pass, no exchange.  Repeated rows, null ids and null urls give a row each,
    other columns are ignored.  A page of any length is read whole, in time that grows with its length: the second pass
    finds nearest decided blocks in one sweep each way.
    """

    @F.pandas_udf("string")
    def get(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for html in batches:
            yield pd.Series([main_text(x) for x in html])

    return pages.select("page_id", "url", get(F.coalesce("html", F.lit(""))).alias("text")).withColumn("n_chars", F.length("text").cast("long"))
