"""Main text of web pages by two-pass block rules.

A page is cut into blocks at block-level tags. The first pass decides each block by its
text: link density, length, the share of stop words and a copyright sign. What the
containers say (nav, footer, an element whose class, id or role names an advert or a menu,
an article) is one more feature of the block: a mark turns prose down, an article opens
what the rules would drop. Short and middling blocks stay open; in the second pass they
take the label of the nearest decided neighbour in containers that say the same, or on the
whole page where the containers say nothing, kept only if no neighbour as near is dropped;
headings take that of the next decided block.

A mark is not believed everywhere. An article inside an element marked by its class, id
or by being a form counts as the article if the page has no other.
"""

from __future__ import annotations

import re
from html import unescape
from typing import NamedTuple

from pyspark.sql import DataFrame

from tallyhouse.llm.common import map_rows

# Frequent function words of six languages.
STOP_WORDS = frozenset(
    "the of and to in is that it was for on are as with they be at this have from or by not but what all were "
    "we when your can there use an each which do how their if will "
    "der die das und in den von zu mit sich des auf für ist im dem nicht ein eine als auch es an werden aus er hat "
    "dass sie nach wird bei einer um am sind noch wie einem über "
    "de la le et les des en un du une que est pour qui dans sur par plus pas au avec ce il sont ne se son "
    "el los las una y con del por se su para es al lo como más o pero sus le ha "
    "il di che non per una sono gli della con nel "
    "o os da do em um não uma na no mais dos das ao".split()
)
# HTML elements.
RAW = frozenset("script style noscript template textarea title svg math iframe object select option".split())
DROPPED = frozenset("nav footer aside dialog menu button fieldset label head".split())
KEPT = frozenset("article main".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol option p pre section summary table "
    "tbody td tfoot th thead tr ul button label".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
VOID = frozenset("hr br img input meta link source track wbr area base col embed".split())
# Names in class, id or role attributes that mark what does not belong to the text.
MARKS = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion nav navbar navigation menu "
    "breadcrumb breadcrumbs sidebar widget widgets footer masthead banner cookie cookies consent gdpr notice notices "
    "popup modal overlay newsletter subscribe subscription signup login search share sharing social related "
    "recommended teaser pagination pager copyright legal disclaimer toolbar complementary contentinfo".split()
)
# Readers' own texts, often in article elements of their own: dropped wherever they stand.
COMMENTS = frozenset("comment comments disqus reply replies respond".split())
# Names that speak for the text, as a whole: ``content`` does, ``content-ad`` does not.
CONTENT = frozenset("article content main post entry story".split())
# Parts that say how a page is laid out, not what the element holds: ``with-sidebar``.
LAYOUT = ("with-", "has-", "no-")
# Dropped outside the article only: a headline may stand in the article's own header.
OUTSIDE = frozenset(["header"])

_TAG = re.compile(
    r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([A-Za-z][^\s/>]*)((?:[^>=]|=\s*"[^"]*"|=\s*'[^']*'|=)*+)(?:>|\Z)""",
    re.S,
)
_NAMED = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
_HIDDEN = re.compile(r"""(?:^|\s)hidden(?:\s|=|/|$)|aria-hidden\s*=\s*["']?true|display\s*:\s*none""", re.I)
_SPLIT = re.compile(r"[^a-z]+")
_EDGES = re.compile(r"^\W+|\W+$")

# Limits of the first pass.
LINKS = 0.4
SHORT, LONG = 70, 200
FEW_STOPS, MANY_STOPS = 0.10, 0.20
GOOD, BAD, OPEN = 1, -1, 0

# What the containers say about a block: nothing, the article, a mark that an article inside
# can refute, such an article, a mark that stands.
PLAIN, ARTICLE, DOUBTED, HELD, MARKED = range(5)


class Block(NamedTuple):
    text: str
    linked: int  # characters in links
    place: int  # what the containers say, one of the five above
    heading: bool

    @property
    def rule(self) -> int:
        """Label of the text by itself."""
        if self.linked > LINKS * len(self.text) or "\N{COPYRIGHT SIGN}" in self.text and len(self.text) < LONG:
            return BAD
        if len(self.text) < SHORT:
            return OPEN
        words = self.text.lower().split()
        share = sum(_EDGES.sub("", word) in STOP_WORDS for word in words) / len(words)
        if share >= MANY_STOPS or share >= FEW_STOPS and len(self.text) >= LONG:
            return GOOD
        return BAD if share < FEW_STOPS / 2 and len(self.text) < LONG else OPEN


def _names(attributes: str) -> tuple[set[str], set[str]]:
    """(whole names, their parts) of class, id and role; names of the layout left out."""
    whole = {
        name
        for found in _NAMED.finditer(attributes)
        for name in "".join(filter(None, found.groups())).lower().split()
        if not name.startswith(LAYOUT)
    }
    return whole, {part for name in whole for part in _SPLIT.split(name)}


def _inside(place: int, tag: str, attributes: str) -> int:
    """What is said inside an element that stands in ``place``."""
    if tag in ("html", "body"):
        return place
    whole, parts = _names(attributes) if attributes else (set(), set())
    if tag in DROPPED or parts & COMMENTS or attributes and _HIDDEN.search(attributes):
        return MARKED
    if tag in KEPT:
        return {PLAIN: ARTICLE, DOUBTED: HELD}.get(place, place)
    marked = tag == "form" or bool(parts & MARKS) and not whole & CONTENT
    if place not in (ARTICLE, HELD):
        marked = marked or tag in OUTSIDE or bool(parts & OUTSIDE)
    if not marked:
        return place
    return {PLAIN: DOUBTED, DOUBTED: DOUBTED}.get(place, MARKED)


def blocks(html: str) -> list[Block]:
    """Each block that has text, in page order."""
    out: list[Block] = []
    texts: list[str] = []
    # Open elements: (tag, what is said inside).
    stack: list[tuple[str, int]] = [("", PLAIN)]
    linked = 0
    link = 0  # number of open elements when the open link began, 0 without one

    def end_block() -> None:
        nonlocal linked
        text = "".join(texts)
        texts.clear()
        if text and not text.isspace():
            text = " ".join((unescape(text) if "&" in text else text).split())
            if text:
                out.append(Block(text, linked, stack[-1][1], stack[-1][0] in HEADINGS))
        linked = 0

    place, size = 0, len(html)
    while place < size:
        found = _TAG.search(html, place)
        until = found.start() if found else size
        if until > place:
            text = html[place:until]
            texts.append(text)
            if link and not text.isspace():
                linked += len(text)
        if not found:
            break
        place = found.end()
        tag = found[2]
        if tag is None:
            continue
        tag = tag.lower()
        closing = bool(found[1])
        if tag in RAW:
            if not closing and not found[3].endswith("/"):
                end = re.compile(rf"</{tag}\b[^>]*(?:>|\Z)", re.I).search(html, place)
                place = end.end() if end else size
            continue
        if tag == "a":
            link = 0 if closing else len(stack)
        elif tag == "br":
            texts.append("\n")
        elif tag in BLOCKS:
            end_block()
            if closing:
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i][0] == tag:
                        del stack[i:]
                        break
            elif tag not in VOID:
                if tag in ("p", "li") and stack[-1][0] == tag:
                    stack.pop()
                stack.append((tag, _inside(stack[-1][1], tag, found[3])))
            # A link may go around blocks, but not out of the element it was opened in.
            if link > len(stack):
                link = 0
    end_block()
    return out


def hints(found: list[Block]) -> list[int]:
    """GOOD, BAD or OPEN by the containers; an article held by a doubted mark counts if it is the only one."""
    held = BAD if any(block.place == ARTICLE for block in found) else GOOD
    said = {PLAIN: OPEN, ARTICLE: GOOD, DOUBTED: BAD, HELD: held, MARKED: BAD}
    return [said[block.place] for block in found]


def first_pass(rule: int, hint: int) -> int:
    """Label of a block: its rule, unless the containers say the opposite.

    A mark turns prose down (a notice, an advert); an article leaves open what its text speaks against.
    """
    if rule == -hint:
        return BAD if hint == BAD else OPEN
    return rule


def second_pass(labels: list[int], hints: list[int], headings: list[bool]) -> list[bool]:
    """Open blocks take the label of the nearest decided one; at equal distances both must be kept.

    A heading goes with what it stands above: the next decided block, if there is one. Blocks of an article or of marked elements look at their like only, and without any decided one
    do as the containers say. The others look at the whole page; without any decided block
    nothing speaks against them, and they are kept.
    """
    size = len(labels)

    def nearest(order: range) -> list[int | None]:
        """Place of the last decided block met before each, as far as it may look."""
        out: list[int | None] = [None] * size
        last: dict[int | None, int | None] = {}
        for i in order:
            if labels[i]:
                last[None] = last[hints[i]] = i
            out[i] = last.get(hints[i] or None)
        return out

    kept = []
    for i, near in enumerate(zip(nearest(range(size)), nearest(range(size - 1, -1, -1)))):
        decided = [j for j in (near[1:] if headings[i] and near[1] is not None else near) if j is not None]
        if decided:
            closest = min(abs(j - i) for j in decided)
            kept.append(all(labels[j] == GOOD for j in decided if abs(j - i) == closest))
        else:
            kept.append(hints[i] != BAD)
    return kept


def labelled(html: str | None) -> list[tuple[str, int, int, bool]]:
    """(text, label by the rules, what the containers say, whether it is kept) of each block."""
    found = blocks(html or "")
    rules, said = [block.rule for block in found], hints(found)
    kept = second_pass([first_pass(*pair) for pair in zip(rules, said)], said, [block.heading for block in found])
    return [(block.text, *rest) for block, *rest in zip(found, rules, said, kept)]


def main_text(html: str | None) -> str:
    return "\n".join(text for text, _, _, kept in labelled(html) if kept)


def extracted(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every page.

    A null or empty page has an empty text; null ids and urls stay. Pages cut off inside a
    tag, comment or script lose that piece only. Repeated pages are extracted each; other
    columns are not read. No shuffle.
    """

    def row(page_id: int | None, url: str | None, html: str | None) -> tuple:
        text = main_text(html)
        return page_id, url, text, len(text)

    return map_rows(pages, ["page_id", "url", "html"], row, "page_id long, url string, text string, n_chars long")
