"""Main text of web pages: flat text blocks, classified by a tree over each block and its neighbours.

A page is cut into blocks wherever a block-level tag begins or ends; hidden elements have none. A block is described by its word count and
link density, those of the blocks before and after it, and marks (article, page furniture or a telling class or id around
it, heading, a line about rights). An article inside furniture clears the marks of what is around it; that there were some is a mark of its own. A tree
learned from the labelled blocks below keeps or drops a block. A menu or page header that is never closed ends where the
next element begins after its text.
"""

from __future__ import annotations

import html
import re
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .bytetext import slices
from .common import column
from .trees import Tree

# Elements of HTML by their part in a page.
UNREAD = set("script style template title noscript textarea select option button svg math iframe object canvas "
             "audio video datalist".split())
VOID = set("area base br col embed hr img input link meta source track wbr".split())
INLINE = set("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp "
             "small span strike strong sub sup time tt u var wbr img input".split())
FURNITURE = set("nav footer aside form dialog menu header".split())
ARTICLE = set("article main".split())
# Parts of class, id and role names that tell page furniture and articles.
TELLING = set("ad ads adslot advert adverts advertisement advertising banner sponsor sponsored promo promotion cookie "
              "cookies consent gdpr notice notification alert popup modal overlay newsletter subscribe subscription "
              "signup login share sharing social related recommended recommendations sidebar widget menu nav navbar "
              "navigation breadcrumb breadcrumbs footer masthead comment comments commentlist disqus reply replies "
              "respond discussion search toolbar pagination pager copyright legal disclaimer tags skip reviews "
              "testimonials guestbook".split())
STORY = set("article content story entry post main".split())
# Words before a telling part that say the element only has such a thing, or has none; people whose
# reviews are comments; words of a line about rights; furniture that comes before the article.
ABOUT = set("with has have no without".split())
VISITORS = set("user users reader readers customer customers visitor visitors guest guests member members".split())
BEFORE = set("nav header menu".split())

_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>"
                  r"|<(/?)([A-Za-z][^\s/>]*)([^>]*)(?:>|\Z)", re.S)
_NAMED = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
_HIDDEN = re.compile(r"""(?:^|\s)hidden(?:\s|=|/|$)|aria-hidden\s*=\s*["']?true|display\s*:\s*none""", re.I)

_RIGHTS = re.compile(r"\A(?:copyright\b|©|\(c\))[^\w]*(?:c\b[^\w]*)?[12][0-9]{3}\b", re.I)

# Fixed value: words from which a block is long, however long it is.
LONG = 32

#: Marks of an element and of everything inside it; the fifth tells that an article cleared others, the last one is a
#: block's own and tells of a line about rights.
STORY_MARK, FURNITURE_MARK, TELLING_MARK, HIDDEN_MARK, CLEARED_MARK, RIGHTS_MARK = 1, 2, 4, 8, 16, 32


@dataclass
class Block:
    pieces: list[str] = field(default_factory=list)
    linked: int = 0
    marks: int = 0
    heading: bool = False
    text: str = ""
    words: int = 0


def _names(attributes: str) -> tuple[bool, bool]:
    """Whether class, id and role name an article, and whether they name furniture.

    "page-with-sidebar" and "no-ads" only tell what the element has or lacks and name no furniture; "tags-article",
    where the last part is what the element is, names an article.
    """
    story = telling = False
    for found in _NAMED.finditer(attributes):
        for name in (found[1] or found[2] or found[3] or "").lower().split():
            parts = re.findall(r"[a-z]+", name)
            told = [i for i, part in enumerate(parts) if part in TELLING and not (i and set(parts[:i]) & ABOUT)]
            reviewed = "review" in parts and bool(VISITORS & set(parts))
            if parts and parts[-1] == "article":
                story = True
            elif told or reviewed:
                telling = True
            story = story or bool(STORY.intersection(parts))
    return story, telling


def _marks(tag: str, attributes: str, outer: int) -> int:
    """Marks of an element, given those of the elements around it."""
    marks = outer
    named = attributes and tag not in ("html", "body")
    story, telling = _names(attributes) if named else (False, False)
    if tag in ARTICLE or story:
        marks |= STORY_MARK
        if outer & (FURNITURE_MARK | TELLING_MARK) and tag not in FURNITURE and not telling:
            marks = marks & ~(FURNITURE_MARK | TELLING_MARK) | CLEARED_MARK
    if tag in FURNITURE and not (tag == "header" and outer & STORY_MARK):
        marks |= FURNITURE_MARK
    if named and _HIDDEN.search(attributes):
        marks |= HIDDEN_MARK
    if telling and tag not in ARTICLE:
        marks |= TELLING_MARK
    return marks


def blocks(page: str) -> list[Block]:
    """Text blocks of a page in order; never fails, whatever the markup."""
    found, unclosed = _blocks(page, frozenset())
    return _blocks(page, unclosed)[0] if unclosed else found


def _blocks(page: str, ending: frozenset[int]) -> tuple[list[Block], frozenset[int]]:
    """Text blocks of a page, and where menus and page headers begin that are never closed.

    Those that begin at a place in ``ending`` end where an element begins after text of theirs.
    """
    found: list[Block] = []
    block, stack, link, at = Block(), [("", 0)], 0, 0
    open_at: dict[str, list[int]] = {}  # where in the stack each tag is open
    begun: dict[int, tuple[int, int]] = {}  # depth of open menus and page headers: where they begin, blocks before them
    unclosed: set[int] = set()

    def leave(depth: int, ended: bool = False) -> None:
        """Close the elements from a depth of the stack on; ``ended`` if the one at that depth has its own end."""
        while len(stack) > depth:
            open_at[stack.pop()[0]].pop()
            if len(stack) in begun:
                place, _ = begun.pop(len(stack))
                if not (ended and len(stack) == depth):
                    unclosed.add(place)

    def put(piece: str) -> None:
        if "&" in piece:
            piece = html.unescape(piece)
        block.pieces.append(piece)
        if link:
            block.linked += len(piece.split())

    def close() -> None:
        nonlocal block
        block.text = " ".join("".join(block.pieces).split())
        if block.text and not block.marks & HIDDEN_MARK:
            block.words = block.text.count(" ") + 1
            if block.words < LONG and _RIGHTS.search(block.text):
                block.marks |= RIGHTS_MARK
            found.append(block)
        block = Block(marks=stack[-1][1], heading=any(t[:1] == "h" and t[1:].isdigit() for t, _ in stack[-2:]))

    while match := _TAG.search(page, at):
        if match.start() > at:
            put(page[at:match.start()])
        at = match.end()
        tag = (match[2] or match[5] or "").lower()
        if not tag:
            continue
        ends, attributes = match[1] or match[4], match[3] or match[6] or ""
        if tag in UNREAD and not ends:
            if attributes.rstrip().endswith("/") and tag in ("svg", "math"):
                continue
            stop = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*(?:>|\Z)", re.I).search(page, at)
            at = stop.end() if stop else len(page)
            put(" ")
        elif tag == "br":
            put(" ")
        elif tag == "a":
            link = 0 if ends else 1
        if tag in UNREAD or tag in VOID and tag != "hr":
            continue
        if tag in INLINE:
            telling = not ends and attributes and _marks(tag, attributes, 0)
            if not telling and not open_at.get(tag):
                continue
        if ends:
            if open_at.get(tag):
                leave(open_at[tag][-1], True)
            close()
        elif tag == "hr":
            close()
        else:
            if ending and begun and tag not in INLINE and tag not in ("ul", "ol", "li"):
                close()
                spent = [depth for depth, (place, before) in begun.items() if place in ending and len(found) > before]
                if spent:
                    leave(min(spent))
            if tag not in INLINE and stack[-1][0] == "p":
                leave(len(stack) - 1)
            if tag in ("li", "tr", "td", "th", "dt", "dd", "option") and stack[-1][0] == tag:
                leave(len(stack) - 1)
            open_at.setdefault(tag, []).append(len(stack))
            stack.append((tag, _marks(tag, attributes, stack[-1][1])))
            close()
            if tag in BEFORE and stack[-1][1] & FURNITURE_MARK:
                begun[len(stack) - 1] = match.start(), len(found)
    put(page[at:])
    close()
    leave(1)
    return found, frozenset(unclosed)


def features(found: list[Block]) -> np.ndarray:
    """One row per block: words and link density of it, the one before and the one after, then its marks.

    Words count up to LONG; the fewer and the more words of the two neighbours and the higher of their densities stand
    beside them.
    """
    words = np.minimum([0, *[b.words for b in found], 0], LONG).astype(float)
    density = np.array([0, *[min(b.linked / b.words, 1.0) for b in found], 0], float)
    marks = np.array([b.marks for b in found], int)
    columns = [words[1:-1], density[1:-1], words[:-2], density[:-2], words[2:], density[2:],
               np.minimum(words[:-2], words[2:]), np.maximum(words[:-2], words[2:]),
               np.maximum(density[:-2], density[2:])]
    columns += [(marks & m > 0).astype(float) for m in (
        STORY_MARK, FURNITURE_MARK, TELLING_MARK, CLEARED_MARK, RIGHTS_MARK)]
    return np.stack([*columns, np.array([b.heading for b in found], float)], axis=1)


# The labelled table. A page is a row of blocks: words, linked words, marks (s story, f furniture, t telling name,
# c cleared, r rights, 1 heading), and + for a block of the main text or - for one that is not.
LABELLED = """
6,6,f,- 8,0,t,- 11,0,s1,+ 60,0,s,+ 3,0,s,+ 1,0,s,+ 140,0,s,+ 2,0,s,+ 9,0,f,-
4,4,f,- 2,2,f,- 30,0,t,- 7,0,s1,+ 1,0,s,+ 2,0,s,+ 1,0,s,+ 12,2,f,-
1,1,f,- 5,0,s1,+ 220,4,s,+ 25,0,st,- 90,3,s,+ 14,14,sf,- 40,0,st,- 55,0,st,- 6,1,f,-
3,3,ft,- 12,0,f1,- 9,0,s1,+ 4,0,s,+ 35,35,s,+ 80,0,s,+ 18,0,sf,- 1,0,sf,-
2,2,,- 3,3,,- 1,1,,- 6,0,1,+ 45,0,,+ 2,0,,+ 51,2,,+ 1,0,,+ 90,0,,+ 7,7,,- 6,4,,-
7,0,f1,- 1,1,f,- 16,0,s,+ 1,0,s1,+ 100,20,s,+ 2,2,s,- 6,6,st,- 9,0,ft,- 85,0,ft,-
1,0,s1,+ 9,9,s,+ 10,0,s,+ 4,0,st,- 19,0,sf,- 110,0,f,- 130,2,t,-
40,40,,- 6,6,,- 200,3,,+ 180,0,,+ 1,0,1,+ 95,0,,+ 12,12,,- 2,1,,-
1,0,,- 2,0,,- 1,0,,- 3,0,,- 7,0,1,+ 52,1,,+ 4,0,,+ 71,0,,+ 36,0,,+ 6,0,,- 4,0,,- 9,0,r,-
2,2,,- 3,0,,- 2,2,,- 19,0,,- 5,5,,- 9,0,1,+ 130,2,,+ 3,0,,+ 41,0,,+ 8,8,,- 3,0,,- 4,4,,- 11,0,,-
3,0,,- 2,0,,- 24,0,,- 1,0,,- 88,0,,+ 18,0,,+ 60,0,,+ 2,2,,- 7,0,,- 1,1,,- 10,0,r,-
2,0,,- 10,0,1,+ 18,0,,+ 24,0,,+ 15,0,,+ 22,0,,+ 17,0,,+ 2,0,,- 12,0,,-
5,0,t,- 8,0,sc1,+ 44,0,sc,+ 6,0,sc,+ 90,0,sc,+ 33,0,sc,+ 15,0,sc,+ 3,3,f,- 4,0,f,-
3,0,f,- 4,0,sc,- 2,0,sc,- 6,0,sc,- 3,0,sc,- 12,0,sc,- 5,5,t,-
48,0,t,- 39,0,f,- 52,0,ft,-
9,0,s1,+ 16,0,s,+ 12,0,s,+ 20,0,s,+ 1,0,s,+ 8,0,f,- 1,0,f,- 10,0,st,- 9,0,s,+
3,0,,- 16,0,,- 2,0,,- 17,0,,- 4,0,,-
9,0,s1,+ 70,0,s,+ 5,5,s,- 4,4,s,- 6,6,s,- 50,0,s,+ 3,3,s,- 30,1,s,+
2,2,s,- 1,1,s,- 3,3,s,- 3,0,s1,+ 90,2,s,+ 20,0,s,+ 4,4,s,- 3,0,sr,-
1,1,,- 2,2,,- 3,0,1,+ 60,0,,+ 2,0,1,+ 44,0,,+ 2,0,1,- 3,3,,- 4,4,,- 6,0,sr,-
3,0,1,+ 60,0,,+ 40,0,,+
8,0,,+
5,0,f,- 3,0,sc1,+ 44,0,sc,+ 1,0,sc,+ 60,0,sc,+
5,5,f,- 12,0,s1,+ 18,0,s,+ 7,0,s,+ 25,0,s,+ 6,0,s,+ 5,0,s,+ 22,0,s,+ 10,0,s,+ 8,0,f,-
"""


def labelled_blocks(shorter: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of the table, neighbours taken from each page's row.

    ``shorter`` halves the unlinked main text inside articles that often: there, short blocks are main text as well.
    """
    letters = {"s": STORY_MARK, "f": FURNITURE_MARK, "t": TELLING_MARK, "c": CLEARED_MARK, "r": RIGHTS_MARK, "1": 0}
    x, y = [], []
    for line in LABELLED.split("\n"):
        rows = [entry.split(",") for entry in line.split()]
        if shorter and "s" not in "".join(marks for _, _, marks, label in rows if label == "+"):
            continue
        page = [Block(words=int(w), linked=int(linked), marks=sum(letters[m] for m in marks), heading="1" in marks)
                for w, linked, marks, _ in rows]
        for b, (*_, label) in zip(page, rows):
            if label == "+" and b.marks == STORY_MARK and 3 * b.linked < b.words:
                b.words = max(b.words >> shorter, 1)
        if page:
            x.append(features(page))
            y += [label == "+" for *_, label in rows]
    return np.concatenate(x), np.array(y, float)


@lru_cache(1)
def classifier() -> Tree:
    tables = [labelled_blocks(shorter) for shorter in range(4)]
    return Tree(np.concatenate([x for x, _ in tables]), np.concatenate([y for _, y in tables]), depth=12)


def main_text(page: str) -> str:
    """Kept blocks of a page, joined by one blank."""
    found = blocks(page)
    if not found:
        return ""
    kept = classifier().predict(features(found)) >= 0.5
    return " ".join(b.text for b, keep in zip(found, kept) if keep)


def extract(pages: DataFrame, id_column: str = "page_id", url_column: str = "url",
            html_column: str = "html") -> DataFrame:
    """page_id, url, text: one row per input row; text is empty for a null or empty page and one without main text.

    Unclosed and stray tags, comments and quotes are read as far as they go. Repeated rows give equal texts; other
    columns are not read.
    """

    def run(batches):
        for batch in batches:
            for part in slices(batch.column(2)):
                rows = batch.slice(part.first, part.last - part.first)
                texts = [main_text(page or "") for page in rows.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0), rows.column(1), pa.array(texts, pa.string())], ["page_id", "url", "text"])

    chosen = pages.select(column(id_column).alias("page_id"), column(url_column).alias("url"),
                          column(html_column).cast("string").alias("html"))
    kinds = dict(chosen.dtypes)
    return chosen.mapInArrow(run, f"page_id {kinds['page_id']}, url {kinds['url']}, text string")
