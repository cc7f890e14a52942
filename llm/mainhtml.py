"""Main text of web pages by text-to-tag ratios.

The standard library's parser streams a page as events.  They make lines: runs of text
between tags that part blocks, each with its number of tags and the container it stands
in.  The ratio of text to tags of the lines is smoothed by a Gaussian and clustered by a
threshold into content and the rest.  The page's article, if marked up, or else the
smallest container of all lines that are not mostly links is the region; its lines are the
text, but for those in menus, headers, footers, sidebars, notices, adverts, forms and
comments.  A word in a class marks no container of most of the region's text.  Of several
articles the one with most text in content lines counts.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Names of elements, and words in class, id and role that mark what is no article.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q rp rt ruby s samp small span strike "
    "strong sub sup time tt u var wbr img".split()
)
NO_END = frozenset("area base br col embed hr img input link meta param source track wbr".split())
NEVER = frozenset(
    "head title script style noscript template svg math iframe object canvas audio video select option datalist button "
    "textarea form fieldset dialog".split()
)
AROUND = frozenset("nav footer aside menu".split())
MARKED = frozenset(
    "nav navbar navigation menu breadcrumb breadcrumbs footer sidebar aside ad ads advert adverts advertisement sponsor "
    "sponsored banner promo promotion cookie cookies consent notice notices gdpr popup modal overlay share sharing social "
    "related recommended newsletter subscribe subscription signup login search pagination pager widget toolbar skip "
    "complementary contentinfo dialog alert".split()
)
TALK = frozenset("comment comments commentlist respond disqus replies reply discussion".split())
ADVERT = frozenset("ad ads advert adverts advertisement sponsor sponsored promo".split())
DENIED = re.compile(r"(?:^|\s)(?:no|non|not|has|with|without)[-_]\S*")  # "has-sidebar" is said of what stands around one
MAIN = frozenset("article main".split())
CLOSED_BY_BLOCK = frozenset("p li dt dd option".split())
WORDS = re.compile(r"[a-z]+")
SPREAD = 1.0  # of the Gaussian, in lines
REACH = 2
LINKED = 0.5  # share of link text from which a line is mostly links


class _Lines(HTMLParser):
    """Collects lines: (text, tags, container, left out by its element, share of link text, innermost marked container or 0)."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.lines: list[tuple[str, int, int, bool, float, int]] = []
        self.parents = [0]  # container -> the one around it
        self.kinds = ["page"]
        # Tag, container, why it is left out, innermost marked one, within an article or main part.
        self.stack: list[tuple[str, int, str, int, bool]] = [("", 0, "", 0, False)]
        self.open: dict[str, int] = {}  # tag -> how many are on the stack
        self.muted: list[str] = []  # open inline elements from the advert on
        self.marks: dict[int, int] = {}  # marked container -> the marked one around it, or 0
        self.parts: list[str] = []
        self.tags = 0
        self.links = 0
        self.linked = 0

    def _end_line(self) -> None:
        text = " ".join("".join(self.parts).split())
        if text:
            _, container, why, mark, _ = self.stack[-1]
            self.lines.append((text, self.tags, container, bool(why), self.linked / len(text), mark))
        self.parts, self.tags, self.linked = [], 0, 0
        self.muted = []

    def _pop(self) -> str:
        tag = self.stack.pop()[0]
        self.open[tag] -= 1
        return tag

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.tags += 1
        if tag == "a":
            self.links += 1
        if tag in INLINE and tag != "br":
            if tag not in NO_END and (self.muted or _words(attrs) & ADVERT):
                self.muted.append(tag)
            return
        tags = self.tags
        self._end_line()
        self.tags = tags if not self.lines else 1
        if tag in NO_END:
            return
        while len(self.stack) > 1 and self.stack[-1][0] in CLOSED_BY_BLOCK and tag not in ("ul", "ol", "dl"):
            self._pop()
        self.links = 0
        _, around, why, mark, in_main = self.stack[-1]
        words = _words(attrs)
        if tag in MAIN and why in ("", "around"):
            why, mark = "", 0  # an unclosed advert does not swallow the article
        if not why:
            if tag in NEVER:
                why = "never"
            elif words & TALK and tag not in ("body", "html"):
                why = "talk"
            elif tag in AROUND or (tag == "header" and not in_main):
                why = "around"
            elif tag not in MAIN and tag not in ("body", "html") and (
                words & MARKED or ("header" in words and not in_main) or ("form" in words)
            ):
                self.marks[len(self.parents)] = mark
                mark = len(self.parents)
        self.parents.append(around)
        self.kinds.append(tag if not words & {"main"} or tag in MAIN else "main")
        self.stack.append((tag, len(self.parents) - 1, why, mark, in_main or tag in MAIN))
        self.open[tag] = self.open.get(tag, 0) + 1

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        # HTML has no self-closing containers: <div/> opens one.
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag: str) -> None:
        self.tags += 1
        if tag == "a":
            self.links = max(0, self.links - 1)
        if tag in INLINE:
            if tag in self.muted:
                while self.muted.pop() != tag:
                    pass
            return
        self._end_line()
        if self.open.get(tag):
            while self._pop() != tag:
                pass
            self.links = 0

    def handle_data(self, data: str) -> None:
        if self.muted:
            return
        self.parts.append(data)
        if self.links:
            self.linked += len(data.strip())

    def finish(self) -> None:
        self.close()
        self._end_line()


def _words(attrs: list[tuple[str, str | None]]) -> set[str]:
    """Words of what an element's class, id and role say of itself."""
    return {w for n, v in attrs if n in ("class", "id", "role") and v for w in WORDS.findall(DENIED.sub(" ", v.lower()))}


def smoothed(ratios: np.ndarray) -> np.ndarray:
    """Ratios after a Gaussian over neighbouring lines; the ends repeat."""
    at = np.arange(-REACH, REACH + 1)
    kernel = np.exp(-(at**2) / (2 * SPREAD**2))
    return np.convolve(np.pad(ratios, REACH, mode="edge"), kernel / kernel.sum(), mode="valid")


def main_text(html: str | None) -> str:
    """The main text of a page; empty if there is none."""
    if not html:
        return ""
    parser = _Lines()
    parser.feed(html)
    parser.finish()
    lines = parser.lines
    if not lines:
        return ""
    ratios = np.array([len(line[0]) / max(line[1], 1) for line in lines])
    smooth = smoothed(ratios)
    last = _last(parser.parents)
    inner = [i for i, line in enumerate(lines) if not line[3]]
    region = _article(parser, inner, smooth >= smooth.std())
    marked = region is not None
    if marked:
        inner = [i for i in inner if region <= lines[i][2] <= last[region]]
    usable = _unmarked(parser, inner)
    if not usable:
        return ""
    if not marked:
        region = _around(parser, last, [i for i in usable if lines[i][4] < LINKED] or usable)
    content = {i for i in usable if smooth[i] >= smooth.std()} or set(usable)
    kept = [
        lines[i][0] for i in usable
        if region <= lines[i][2] <= last[region] and (marked or i in content or lines[i][4] < LINKED)
    ]
    return " ".join(kept)


def _last(parents: list[int]) -> list[int]:
    """The last container within each one; containers are numbered outside in, in page order."""
    last = list(range(len(parents)))
    for c in range(len(parents) - 1, 0, -1):
        last[parents[c]] = max(last[parents[c]], last[c])
    return last


def _article(parser: _Lines, inner: list[int], content: np.ndarray) -> int | None:
    """The article, or else the main part, with most text in content lines, then with most text; None if the page has neither."""
    mass = [(0, 0)] * len(parser.parents)
    for i in inner:
        size = len(parser.lines[i][0])
        main, all_ = mass[parser.lines[i][2]]
        mass[parser.lines[i][2]] = (main + size * bool(content[i]), all_ + size)
    for c in range(len(mass) - 1, 0, -1):
        main, all_ = mass[parser.parents[c]]
        mass[parser.parents[c]] = (main + mass[c][0], all_ + mass[c][1])
    for kind in ("article", "main"):
        found = [c for c, (_, all_) in enumerate(mass) if all_ and parser.kinds[c] == kind]
        if found:
            return max(found, key=lambda c: (mass[c], -c))
    return None


def _unmarked(parser: _Lines, inner: list[int]) -> list[int]:
    """Those of ``inner`` in no marked container but those that hold most of their text outside links."""
    mass = dict.fromkeys(parser.marks, 0)
    total = 0
    for i in inner:
        text, _, _, _, linked, mark = parser.lines[i]
        if linked < LINKED:
            total += len(text)
            if mark:
                mass[mark] += len(text)
    for mark in reversed(parser.marks):  # inside out
        if parser.marks[mark]:
            mass[parser.marks[mark]] += mass[mark]
    left_out = {0: False}
    for mark, outer in parser.marks.items():  # outside in
        left_out[mark] = left_out[outer] or 2 * mass[mark] <= total
    return [i for i in inner if not left_out[parser.lines[i][5]]]


def _around(parser: _Lines, last: list[int], chosen: list[int]) -> int:
    """The smallest container of all these lines."""
    within = [parser.lines[i][2] for i in chosen]
    region, end = min(within), max(within)
    while last[region] < end:
        region = parser.parents[region]
    return region


def main_texts(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) for every row of ``pages``.

    Null and empty pages have an empty text; null ids and urls stay null; repeated rows
    are kept.  Texts are whole, blocks in page order.  Other columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                part = batch.slice(i, 256)
                texts = [main_text(h.as_py()) for h in part.column(2)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                    names=["page_id", "url", "text", "n_chars"],
                )

    return pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string")).mapInArrow(
        run, "page_id long, url string, text string, n_chars long"
    )
