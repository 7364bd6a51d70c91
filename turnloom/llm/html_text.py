"""Main text of web pages by block rules in two passes.

A page is cut into blocks at its block tags. The first pass decides what it can of each block:
by the elements around it (menus, footers, forms and the like are never main text), by link
density, and by length together with the share of stop words. Short blocks and blocks between the
thresholds stay open; the second pass gives them the label of the nearest decided neighbours in
the same part of the page.
"""

from __future__ import annotations

import html
import re
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

MAX_LINK_DENSITY = 0.33
SHORT_CHARS = 70
LONG_CHARS = 200
FEW_STOP_WORDS = 0.10
MANY_STOP_WORDS = 0.20

# Common short words of the languages at hand.
STOP_WORDS = frozenset(
    """
    a an and are as at be by for from in is it of on or that the this to was were with not but
    he she they we you i his her their our your its have has had will would can which who what
    le la les un une des du de et en est que qui dans pour par sur au aux avec ce cette il elle
    ne pas plus se son sa ses ou nous vous ils elles
    der die das ein eine einer eines einem einen und in ist im von zu mit auf für den dem des
    nicht sich als auch an bei aus nach wie es er sie wir ihr
    el los las una unos unas y es por para con del al lo su sus se no como más o pero este esta
    mi yo tu
    """.split()
)

# Elements whose content is never text, and elements around text that is not the page's own.
SILENT = frozenset("script style noscript template svg math iframe object canvas audio video head".split())
ASIDE = frozenset(
    "nav header footer aside form menu button select option textarea dialog fieldset label".split()
)
MAIN = frozenset("article main".split())
BLOCK = frozenset(
    """
    address article aside blockquote body center dd details dialog dir div dl dt fieldset
    figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol
    option p pre section select summary table tbody td textarea tfoot th thead title tr ul head
    button caption
    """.split()
)
VOID = frozenset("area base br col embed hr img input link meta source track wbr param".split())
# Tags that a new block of the kind closes.
CLOSED_BY = {
    "p": BLOCK - {"html", "body", "head"},
    "li": frozenset({"li"}),
    "dt": frozenset({"dt", "dd"}),
    "dd": frozenset({"dt", "dd"}),
    "tr": frozenset({"tr", "tbody", "tfoot"}),
    "td": frozenset({"td", "th", "tr", "tbody", "tfoot"}),
    "th": frozenset({"td", "th", "tr", "tbody", "tfoot"}),
    "option": frozenset({"option"}),
    "head": frozenset({"body"}),
}
# Words in class, id or role that mark a part as not the page's own text.
ASIDE_NAMES = frozenset(
    """
    ad ads advert adverts advertisement advertising banner promo promoted sponsor sponsored
    sponsors menu menus nav navbar navigation breadcrumb breadcrumbs sidebar side aside widget
    widgets related recommended footer header masthead cookie cookies consent gdpr notice notices
    alert popup modal overlay newsletter subscribe subscription signup login share sharing social
    comment comments disqus replies reply discussion respond pagination pager toolbar complementary
    contentinfo search skip outbrain taboola
    """.split()
)

# What such a word can be joined with and still mark the part; "no-sidebar" marks nothing.
PLACE_NAMES = frozenset(
    """
    main site page global top bottom left right primary secondary box wrapper wrap container area
    bar block list item section content inner outer links
    """.split()
)

_token = re.compile(
    r"<!--.*?(?:-->|\Z)|<![^>]*(?:>|\Z)|<\?[^>]*(?:>|\Z)"
    r"|</([a-zA-Z][^\s/>]*)[^>]*(?:>|\Z)"
    r"|<([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))*)(?:>|\Z)",
    re.S,
)
_named = re.compile(r"(?<![\w-])(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_hidden = re.compile(r"(?:^|\s)hidden(?:\s|=|/|$)|aria-hidden\s*=\s*[\"']?true|display\s*:\s*none", re.I)
_between = re.compile(r"[-_:.0-9]+")
_heading = re.compile(r"h[1-6]")
_white = re.compile(r"\s+")
_word = re.compile(r"[^\W\d_]+")


class Block(NamedTuple):
    text: str
    linked: int  # characters of it inside links
    aside: bool
    main: int  # which article or main element it is in; 0 for none
    heading: bool


def marks_aside(name: str, attributes: str, in_main: bool) -> bool:
    """Whether an element's class, id or role says that it is not the page's own text.

    An id of a heading, or of a section of an article, names what it is about.
    """
    for kind, *values in _named.findall(attributes):
        if kind.lower() == "id" and (_heading.fullmatch(name) or in_main and name == "section"):
            continue
        for word in "".join(values).lower().split():
            parts = {x for x in _between.split(word) if x}
            if not ASIDE_NAMES.isdisjoint(parts) and parts <= ASIDE_NAMES | PLACE_NAMES:
                return True
    return False


def blocks(page: str) -> list[Block]:
    """The blocks of a page that have text, in order."""
    out: list[Block] = []
    # open elements: name, whether its content is set aside (1 by a name, 2 by what it is), the
    # main element it is in
    open_: list[tuple[str, int, int]] = [("", 0, 0)]
    parts: list[str] = []
    linked = links = mains = breaks = 0
    at, size = 0, len(page)

    def flush() -> None:
        nonlocal linked, breaks
        text = _white.sub(" ", "".join(parts)).strip()
        if text:
            name, aside, main = open_[-1]
            heading = any(len(n) == 2 and n[0] == "h" and n[1].isdigit() for n, _, _ in open_)
            out.append(Block(text, linked, bool(aside), main, heading))
        parts.clear()
        linked = breaks = 0

    def close(depth: int) -> None:
        nonlocal links
        while len(open_) > depth:
            name = open_[-1][0]
            if name in BLOCK:
                flush()
            elif name == "a":
                links -= 1
            open_.pop()

    for match in _token.finditer(page):
        if match.start() < at:
            continue  # inside an element without markup
        if match.start() > at:
            piece = html.unescape(page[at : match.start()])
            if breaks and not piece.isspace():
                breaks = 0
            parts.append(piece)
            if links:
                linked += len(_white.sub("", piece))
        at = match.end()
        closing, opening, attributes = match.group(1), match.group(2), match.group(3)
        if opening:
            name = opening.lower()
            if name in SILENT and name != "head" and not attributes.rstrip().endswith("/"):
                end = re.compile(rf"</{re.escape(name)}\b[^>]*(?:>|\Z)", re.I).search(page, at)
                at = end.end() if end else size
                continue
            if name == "br":
                breaks += 1
                if breaks > 1:
                    flush()
                else:
                    parts.append(" ")
                continue
            if name == "hr":
                flush()
                continue
            if name in VOID:
                continue
            # what the new element closes, as far as the nearest part that may hold it
            for depth in range(len(open_) - 1, 0, -1):
                known = open_[depth][0]
                if name in CLOSED_BY.get(known, ()):
                    close(depth)
                elif known in ("table", "ul", "ol", "dl", "select") or known in MAIN:
                    break
            if name in BLOCK:
                flush()
            if name == "a":
                links += 1
            _, aside, main = open_[-1]
            if aside == 1 and (name == "main" or name == "article" and not mains):
                aside = 0  # a name around the page's text does not set it aside
            if name in MAIN and not aside:
                mains += not main
                main = main or mains
            if name in ASIDE and not (name == "header" and main) or name == "head":
                aside = 2
            if attributes and not aside:
                if name not in MAIN and name not in ("html", "body"):
                    aside = int(marks_aside(name, attributes, bool(main)))
            if attributes and aside < 2 and _hidden.search(attributes):
                aside = 2
            open_.append((name, aside, main))
        elif closing:
            name = closing.lower()
            if name == "p" and not any(n == "p" for n, _, _ in open_):
                flush()
                continue
            for depth in range(len(open_) - 1, 0, -1):
                if open_[depth][0] == name:
                    close(depth)
                    break
                if open_[depth][0] in BLOCK and name not in BLOCK:
                    break  # an inline tag closes nothing outside its block
    if at < size:
        parts.append(html.unescape(page[at:]))
        if links:
            linked += len(_white.sub("", parts[-1]))
    close(1)
    flush()
    return out


def stop_word_share(block: Block) -> float:
    words = _word.findall(block.text.lower())
    return sum(w in STOP_WORDS for w in words) / len(words) if words else 0.0


def first_pass(block: Block, has_main: bool) -> bool | None:
    """Whether a block is main text; None where that stays open."""
    if block.aside or has_main and not block.main:
        return False
    if block.linked > MAX_LINK_DENSITY * len(block.text):
        return False
    if has_main:
        # the page itself says where its text is: only links speak against a block there
        return True if len(block.text) >= SHORT_CHARS else None
    if len(block.text) < SHORT_CHARS:
        return None
    share = stop_word_share(block)
    if share >= MANY_STOP_WORDS:
        return True
    if share >= FEW_STOP_WORDS:
        return True if len(block.text) >= LONG_CHARS else None
    # few known words: another language, or no running text
    return None


def labels(page: list[Block]) -> list[bool]:
    """Both passes. Where the first finds no main text by stop words, long open blocks are it. Ties
    between two neighbours go to main text inside an article or main element and to a heading
    before main text; elsewhere both must be main text."""
    has_main = any(b.main and not b.aside for b in page)
    first = [first_pass(b, has_main) for b in page]
    if not has_main and True not in first:
        long = (len(b.text) >= LONG_CHARS for b in page)
        first = [True if x is None and y else x for x, y in zip(first, long)]
    before = _nearest(page, first)
    after = _nearest(page[::-1], first[::-1])[::-1]
    out = []
    for block, label, left, right in zip(page, first, before, after):
        if label is not None:
            out.append(label)
        elif block.main:
            out.append(left is not False or right is not False)
        elif block.heading:
            out.append(bool(right))
        else:
            known = [x for x in (left, right) if x is not None]
            out.append(bool(known) and all(known))
    return out


def _nearest(page: list[Block], first: list[bool | None]) -> list[bool | None]:
    """For each block the label last decided before it in the same part; an article is a part, and
    so is all that lies outside articles. What elements or names set aside decides for no other."""
    last: dict[int, bool] = {}
    out = []
    for block, label in zip(page, first):
        out.append(last.get(block.main))
        if label is not None and not block.aside:
            last[block.main] = label
    return out


def main_text(page: str | None) -> str:
    """The main text of a page, its blocks parted by an empty line."""
    found = blocks(page or "")
    return "\n\n".join(b.text for b, keep in zip(found, labels(found)) if keep)


def extract(page: str | Column = "html") -> Column:
    """The main text of a column of pages; empty for null, and where a page has none.

    Character references are decoded; white space inside a block becomes one blank. Every page is
    taken whole; one that breaks off in a tag, comment or script ends there.
    """

    @F.arrow_udf("string")
    def text(column: pa.Array) -> pa.Array:
        return pa.array(map(main_text, column.to_pylist()), pa.string())

    return text(F.col(page) if isinstance(page, str) else page)
