"""Main text of web pages by text-to-tag ratio.

The standard library's parser streams a page's events. Text between block
boundaries is a line; its ratio is its characters by the tags met since the line
before. Ratios are smoothed with a Gaussian over neighbouring lines, and a
threshold between two clusters (two means in one dimension) tells lines of
content from the rest; where the clusters lie close together all lines are content,
and so is a line of some length outside links, whatever its ratio. The innermost
element that holds all content lines, and all articles they stand in, is the region
whose lines are the main text.

Lines that belong to no article wherever they stand are left out by structure:
scripts, styles, menus, footers, sidebars, forms, and elements whose role, class
or id names them as advert, notice, comment and the like; a header counts as
one unless an article holds it. A class or id only suggests this: it never leaves
out an article, nor an element that holds most of the page's content lines (as
``content has-sidebar`` may); a name that stands alone (``sidebar``) must hold
nearly all of them to be passed over. Lines of links alone, or of copyright, that lie before
or after all other lines of a region without an article are its menu or its footer, named or not.

Defined cases: null and empty pages give empty text; text without any tag is
one line and comes back whole; unclosed and crossing tags are closed where their
parents end; a tag or comment that the page's end breaks off is left out, with what the comment
holds; unknown declarations (``<![...``) end at the next ``>``, marked data at ``]]>``; a page of any length is
read to its end, in time that grows with it; repeated rows give repeated results; an empty table gives an empty one.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from mailsift import session
from mailsift.llm.common import text_bytes

# Names of elements and words in their attributes.
OUTSIDE = frozenset(
    "head title script style noscript template nav footer aside form button select option textarea svg canvas iframe "
    "object dialog menu audio video map".split()
)
NAMED = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner sidebar menu nav navbar "
    "navigation breadcrumb breadcrumbs footer cookie cookies consent notice notices popup modal newsletter subscribe "
    "signup comment comments disqus respond reply replies share sharing social related recommended widget login search "
    "pagination pager toolbar skip masthead topbar gdpr overlay disclaimer response responses discussion discussions".split()
)
STEMS = ("advert", "breadcrumb", "comment", "cookie", "newsletter", "promo", "sidebar", "sponsor")
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog form menu menubar toolbar".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var wbr".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
REGIONS = frozenset("html body main article section div td center".split())
_CLOSES = {  # an element of this kind ends open ones of these kinds
    **dict.fromkeys("address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split(), {"p"}),
    "li": {"li", "p"}, "dt": {"dt", "dd", "p"}, "dd": {"dt", "dd", "p"}, "tr": {"tr", "td", "th", "p"}, "td": {"td", "th", "p"},
    "th": {"td", "th", "p"}, "option": {"option"}, "body": {"head"},
}
CLOSE = 4.0  # clusters whose means differ by less are one
PROSE = 40  # characters outside links that make a line content
MOST, NEARLY_ALL = 0.5, 0.95  # of the content; a named element that holds so much is not left out
_WORDS = re.compile(r"[^a-z0-9]+")
_MARKUP = re.compile(r"<[a-zA-Z/!?]")
_RIGHTS = re.compile(r"\s*(©|\(c\)|copyright\b)|.*\ball rights reserved\b", re.I | re.S)


class _Lines(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.kinds, self.parents = ["html"], [-1]  # elements by number
        self.named: dict[int, tuple[bool, frozenset[str]]] = {}  # by element: does a name stand alone, words
        self.stack = [(0, "html", False)]  # number, kind, left out
        self.open = {"html": 1}
        self.lines: list[tuple[str, int, int]] = []  # text, tags, element
        self.unlinked: list[int] = []  # of each line, characters outside links
        self.text: list[str] = []
        self.linked: list[bool] = []  # of each piece of text
        self.tags = 0
        self.at = 0
        self.broken_off = self.unmarked = False

    def read(self, html: str) -> None:
        """The whole page. What follows the last ``>`` is text, up to a tag that is not finished."""
        last = html.rfind(">") + 1
        self.feed(html[:last])
        self.close()
        begun = _MARKUP.search(html, last)
        text = html[last : begun.start() if begun else len(html)]
        if text and not self.cdata_elem and not self.broken_off:
            self.handle_data(unescape(text))
        self.end_line()

    def parse_comment(self, i, report=True):
        end = super().parse_comment(i, report)
        if end < 0:  # the rest of the page is the comment
            self.broken_off = True
            end = len(self.rawdata)
        return end

    def parse_marked_section(self, i, report=1):
        if self.rawdata.startswith("<![CDATA[", i) and not self.unmarked:
            end = self.rawdata.find("]]>", i)
            if end >= 0:
                return end + 3
            self.unmarked = True  # nor will one be found later
        end = self.rawdata.find(">", i)
        return end + 1 if end >= 0 else len(self.rawdata)

    def end_line(self) -> None:
        text = " ".join("".join(self.text).split())
        if text:
            self.lines.append((text, self.tags, self.at))
            self.unlinked.append(len(" ".join("".join(x for x, linked in zip(self.text, self.linked) if not linked).split())))
            self.tags = 0
        self.text, self.linked = [], []

    def handle_starttag(self, tag, attrs):
        if tag == "body" and self.open.get("body"):
            return
        self.tags += 1
        if tag == "br":
            self.text.append(" ")
            self.linked.append(False)
            return
        if tag not in INLINE:
            self.end_line()
            self._close_before(tag)
        if tag in VOID:
            return
        out = self.stack[-1][2] or self._left_out(tag, attrs)
        named = None if out else self._named(tag, attrs)
        if named or out and not self.stack[-1][2]:
            self.end_line()
        if tag not in INLINE or out or named:
            self.kinds.append(tag)
            self.parents.append(self.stack[-1][0])
            number = len(self.kinds) - 1
        else:
            number = self.stack[-1][0]
        if named:
            self.named[number] = named
        self.stack.append((number, tag, out))
        self.open[tag] = self.open.get(tag, 0) + 1

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def _close_before(self, tag: str) -> None:
        kinds = _CLOSES.get(tag)
        while kinds and len(self.stack) > 1:
            top = self.stack[-1][1]
            if top in kinds:
                self._pop()
            elif top in INLINE and any(self.open.get(k) for k in kinds) and self._under(kinds):
                self._pop()
            else:
                return

    def _under(self, kinds: set[str]) -> bool:
        """Is the innermost block element one of these kinds?"""
        for _, kind, _ in reversed(self.stack):
            if kind not in INLINE:
                return kind in kinds
        return False

    def _pop(self) -> None:
        number, kind, out = self.stack[-1]
        if number in self.named and number != self.stack[-2][0]:
            self.end_line()
        self.stack.pop()
        self.open[kind] -= 1
        if out and not self.stack[-1][2]:
            self.text, self.linked = [], []

    def handle_endtag(self, tag):
        self.tags += 1
        if tag in VOID:
            return
        if tag not in INLINE:
            self.end_line()
        if not self.open.get(tag):
            return
        if tag in INLINE and not self._inside_block(tag):
            return  # closes nothing across a block's border
        while len(self.stack) > 1:
            kind = self.stack[-1][1]
            self._pop()
            if kind == tag:
                return

    def _inside_block(self, tag: str) -> bool:
        for _, kind, _ in reversed(self.stack):
            if kind == tag:
                return True
            if kind not in INLINE:
                return False
        return False

    def handle_data(self, data):
        number, _, out = self.stack[-1]
        if not out:
            if self.text and number != self.at:
                self.end_line()
            self.at = number
            self.text.append(data)
            self.linked.append(self.open.get("a", 0) > 0)

    def _left_out(self, tag: str, attrs) -> bool:
        if tag in OUTSIDE:
            return True
        in_article = bool(self.open.get("article") or self.open.get("main"))
        if tag == "header" and not in_article:
            return True
        if tag in ("html", "body", "main"):
            return False
        for name, value in attrs:
            if name == "hidden" or name == "aria-hidden" and value == "true":
                return True
            if name == "style" and value and re.search(r"display\s*:\s*none", value):
                return True
            if name == "role" and value and value.lower() in ROLES:
                return True
        return False

    def _named(self, tag: str, attrs) -> tuple[bool, frozenset[str]] | None:
        """Do class or id name what is left out? If so, does a name stand alone, and all words."""
        if tag in ("html", "body", "main", "article"):
            return None
        in_article = bool(self.open.get("article") or self.open.get("main"))
        names = NAMED if in_article or tag in ("h1", "h2") else NAMED | {"header"}
        values = [value.lower() for name, value in attrs if name in ("class", "id") and value]
        words = frozenset(w for value in values for w in _WORDS.split(value))
        if not (words & names or any(w.startswith(STEMS) for w in words)):
            return None
        return any(x in names for value in values for x in value.split()), words

    def left_out(self, element: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """Which elements go by their names, given the content of each line's element."""
        parents = self.parents
        mass = np.bincount(element, weight, len(parents))
        for number in range(len(mass) - 1, 0, -1):
            mass[parents[number]] += mass[number]
        outer = np.full(len(parents), -1)  # the nearest named element around
        for number in range(1, len(parents)):
            above = parents[number]
            outer[number] = above if above in self.named else outer[above]
        alike: dict[frozenset[str], float] = {}  # content of all elements with the same words
        for number, (_, words) in self.named.items():
            above = outer[number]
            if above < 0 or self.named[above][1] != words:
                alike[words] = alike.get(words, 0) + mass[number]
        spared = {n for n, (alone, _) in self.named.items() if not alone and mass[n] >= MOST * mass[0]}
        out = self._below(spared)
        gone = {self.named[n][1] for n in self.named if out[n] and n not in spared}
        best = max(gone, key=lambda words: (alike[words], sorted(words)), default=None)
        if best and alike[best] >= NEARLY_ALL * (alike[best] + weight[~out[element]].sum()):
            out = self._below(spared | {n for n, (_, words) in self.named.items() if words == best})
        return out

    def _below(self, spared: set[int]) -> np.ndarray:
        """Named elements but for the spared ones, and all that they hold."""
        out = np.zeros(len(self.parents), bool)
        for number in range(1, len(out)):
            out[number] = out[self.parents[number]] or number in self.named and number not in spared
        return out


def _smooth(ratios: np.ndarray, sigma: float = 1.0) -> np.ndarray:
    reach = int(np.ceil(2 * sigma))
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    weight = np.convolve(np.ones(len(ratios)), kernel, "full")[reach : reach + len(ratios)]
    return np.convolve(ratios, kernel, "full")[reach : reach + len(ratios)] / weight


def _threshold(values: np.ndarray) -> float:
    """Border between two clusters: midway between their means; the least value where they lie close together."""
    border = values.mean()
    for _ in range(50):
        low, high = values[values < border], values[values >= border]
        if not len(low) or not len(high):
            break
        new = (low.mean() + high.mean()) / 2
        if new == border:
            break
        border = new
    low, high = values[values < border], values[values >= border]
    return border if len(low) and high.mean() >= CLOSE * low.mean() else values.min()


def _content(lines: list[tuple[str, int, int]], unlinked: list[int]) -> np.ndarray:
    """Which lines are content."""
    sizes = np.array([len(text) for text, _, _ in lines], float)
    ratios = sizes / np.maximum([tags for _, tags, _ in lines], 1)
    smooth = _smooth(ratios)
    border, free = _threshold(smooth), np.array(unlinked)
    # A link alone in its line is not lifted by a paragraph beside it.
    content = (smooth >= border) & ((free > 0) | (ratios >= border)) | (free >= PROSE)
    return content if content.any() else np.ones(len(lines), bool)


def main_text(html: str | None) -> str:
    if not html:
        return ""
    parser = _Lines()
    parser.read(html)
    if not parser.lines:
        return ""
    lines, element, unlinked = parser.lines, np.array([at for _, _, at in parser.lines]), parser.unlinked
    content = _content(lines, unlinked)
    if parser.named:
        sizes = np.array([len(text) for text, _, _ in lines], float)
        stay = np.flatnonzero(~parser.left_out(element, sizes * content)[element])
        if not len(stay):
            return ""
        lines, element, unlinked = [lines[i] for i in stay], element[stay], [unlinked[i] for i in stay]
        content = _content(lines, unlinked)
    region = _region(parser, element[content])
    inside = np.zeros(len(parser.kinds), bool)
    for number, parent in enumerate(parser.parents):
        inside[number] = number == region or parent >= 0 and inside[parent]
    chosen = inside[element]
    if not _in_article(parser, region):
        _trim(chosen, content, lines, unlinked, parser, element)
    heading = np.array([parser.kinds[at] == "h1" for at in element])
    if chosen.any() and not (chosen & heading).any():  # the headline stands before its text
        before = np.flatnonzero(heading[: chosen.argmax()])
        chosen[before[-1:]] = True
    return " ".join(text for (text, _, _), here in zip(lines, chosen) if here)


def _in_article(parser: _Lines, number: int) -> bool:
    while number >= 0:
        if parser.kinds[number] in ("article", "main"):
            return True
        number = parser.parents[number]
    return False


def _trim(chosen: np.ndarray, content: np.ndarray, lines: list, unlinked: list, parser: _Lines, element: np.ndarray) -> None:
    """Take away lines at either end that are links alone, and copyright lines at the end."""
    at = np.flatnonzero(chosen)
    if not any(unlinked[i] for i in at):
        return  # nothing but links, which are then the text
    own = [not _in_article(parser, element[i]) for i in at]
    link = [mine and unlinked[i] == 0 and not content[i] for mine, i in zip(own, at)]
    first, last = 0, len(at)
    while first < last and link[first]:
        first += 1
    while last > first and (link[last - 1] or own[last - 1] and _RIGHTS.match(lines[at[last - 1]][0])):
        last -= 1
    if first < last:
        chosen[at[:first]] = chosen[at[last:]] = False


def _region(parser: _Lines, content: np.ndarray) -> int:
    """The innermost region that holds these elements, widened to the article around it."""
    held = np.bincount(content, minlength=len(parser.kinds))
    for number in range(len(held) - 1, 0, -1):
        held[parser.parents[number]] += held[number]
    inner = max(n for n in range(len(held)) if held[n] == held[0])  # these lie in one another
    for kind in ("article", "main"):
        around = [n for n, k in enumerate(parser.kinds) if k == kind and held[n] == held[0]]
        if around:
            return max(around)
    while parser.kinds[inner] not in REGIONS:
        inner = parser.parents[inner]
    return inner


def extract(pages: DataFrame, html_col: str = "html", text_out: str = "text") -> DataFrame:
    """``pages`` without its html, with the main text."""
    session.tune(pages.sparkSession)
    rest = [c for c in pages.columns if c.lower() not in (html_col.lower(), text_out.lower())]
    source = pages.select(
        F.struct(*[F.col(f"`{c}`") for c in rest], F.lit(True).alias("_row_there")).alias("row"),
        text_bytes(html_col).alias("html"),
    )
    fields = StructType().add("row", source.schema["row"].dataType).add("text", StringType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(html) for html in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(texts, pa.string())], ["row", "text"])

    return source.mapInArrow(run, fields).select(*[F.col(f"row.`{c}`") for c in rest], F.col("text").alias(text_out))
