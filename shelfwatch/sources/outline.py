"""A page's marked elements as rows.

A small per-page helper: it reads HTML with the standard parser and reports the
elements that carry a mark.  What the marks mean, and every rule on top of them, is
expressed in Spark (see ``pages``).

The page's text comes back once, as pieces in page order; an element is the interval of the
pieces in it.  So elements in elements repeat no text, and all work is linear in the page but
for a binary search here and there.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections import Counter
from dataclasses import dataclass
from html import unescape
from html.parser import HTMLParser

VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
REMEMBERED, LONGEST = 20_000, 1_000
HIDDEN = frozenset(("script", "style", "template"))
LABEL_HOLDERS = frozenset(("span", "div", "td", "tr", "li"))


@dataclass(frozen=True)
class Mark:
    """One way to earn a mark: a simple selector, optionally below a marked element.

    ``attrs`` maps a name to its value, or to None for "present"; ``holds`` maps a name
    to a part of its value; ``exact_class`` is the whole class text.
    """

    tags: tuple[str, ...] = ()
    id: str | None = None
    classes: tuple[str, ...] = ()
    attrs: tuple[tuple[str, str | None], ...] = ()
    holds: tuple[tuple[str, str], ...] = ()
    exact_class: str | None = None
    last_child: bool = False
    below: str | None = None


@dataclass(slots=True)
class Tag:
    """What an element's tag says by itself, wherever the element stands."""

    name: str
    attrs: dict[str, str]
    ways: list[tuple[str, str | None, bool]]  # marks that it fits: name, ``below``, ``last_child``
    kept: list[tuple[str, str]]
    by_label: bool  # may hold the price of a label
    hidden: bool
    closed: bool  # by itself


def _fits(name: str, attrs: dict[str, str], mark: Mark) -> bool:
    """By itself: ``below`` and ``last_child`` are looked at where the element stands."""
    classes = attrs.get("class", "").split()
    return (
        (not mark.tags or name in mark.tags)
        and (mark.id is None or attrs.get("id") == mark.id)
        and all(c in classes for c in mark.classes)
        and (mark.exact_class is None or " ".join(classes) == mark.exact_class)
        and all(n in attrs and (v is None or attrs[n] == v) for n, v in mark.attrs)
        and all(part in attrs.get(n, "") for n, part in mark.holds)
    )


class Index(dict):
    """Ways by their most telling part, so that few are tried per element."""

    def __init__(self) -> None:
        self._memories: dict[tuple, Tags] = {}

    def tags(self, keep_attrs: tuple[str, ...], label_marks: tuple[Mark, ...]) -> Tags:
        key = (keep_attrs, label_marks)
        if key not in self._memories:
            self._memories[key] = Tags(self, keep_attrs, label_marks)
        return self._memories[key]


# A tag in plain writing: names of letters, values in double quotes.  All others are left to the parser.
_SPACE = r"[ \t\n\r\f]"
_END = re.compile(rf"/([a-zA-Z][a-zA-Z0-9-]*){_SPACE}*")
_START = re.compile(rf'([a-zA-Z][a-zA-Z0-9-]*)((?:{_SPACE}+[a-zA-Z][a-zA-Z0-9_:.-]*(?:="[^"]*")?)*){_SPACE}*')
_ATTRIBUTE = re.compile(rf'{_SPACE}+([a-zA-Z][a-zA-Z0-9_:.-]*)(?:="([^"]*)")?')
_REMARK = re.compile(r"!--[^->]+--")
# Elements whose content is text to their end tag, and those that some parsers take for such.
_AS_TEXT = frozenset(HTMLParser.CDATA_CONTENT_ELEMENTS)
_ODD = frozenset(("plaintext", *getattr(HTMLParser, "RCDATA_CONTENT_ELEMENTS", ()))) | (_AS_TEXT - {"script", "style"})


class Tags:
    """Tags that look alike are looked at once: they are remembered, up to a number."""

    def __init__(self, index: Index, keep_attrs: tuple[str, ...], label_marks: tuple[Mark, ...]) -> None:
        self.index, self.keep_attrs, self.label_marks = index, keep_attrs, label_marks
        self.known: dict[str, Tag | str] = {}  # as written; the name of end tags
        self._read: dict[tuple, Tag] = {}
        self.root = self.of("", {})

    def written(self, text: str) -> Tag | str | None:
        """The tag between < and >, the name of an end tag; None: it takes a parser to tell."""
        if found := _END.fullmatch(text):
            tag = found[1].lower()
        elif found := _START.fullmatch(text):
            name, values = found[1].lower(), {}
            if name in _ODD:
                return None
            for key, value in _ATTRIBUTE.findall(found[2]):
                values[key.lower()] = unescape(value) if "&" in value else value
            tag = self._made(name, values)
        else:
            return None
        if len(text) <= LONGEST:
            if len(self.known) >= REMEMBERED:
                self.known.clear()
            self.known[text] = tag
        return tag

    def of(self, name: str, attrs: dict[str, str]) -> Tag:
        key = (name, *attrs.items())
        tag = self._read.get(key)
        if tag is None:
            if len(self._read) >= REMEMBERED:
                self._read.clear()
            tag = self._read[key] = self._made(name, attrs)
        return tag

    def _made(self, name: str, attrs: dict[str, str]) -> Tag:
        return Tag(
            name, attrs,
            [(mark, way.below, way.last_child) for mark, way in _candidates(self.index, name, attrs) if _fits(name, attrs, way)],
            [(a, attrs[a]) for a in self.keep_attrs if a in attrs],
            any(_fits(name, attrs, m) for m in self.label_marks), name in HIDDEN, name in VOID,
        )


def index_marks(marks: dict[str, tuple[Mark, ...]]) -> Index:
    index = Index()
    for name, ways in marks.items():
        for way in ways:
            if way.id is not None:
                keys = [("id", way.id)]
            elif way.classes:
                keys = [("class", way.classes[0])]
            elif way.attrs:
                keys = [("attr", way.attrs[0][0])]
            else:
                keys = [("tag", tag) for tag in way.tags]
            for key in keys:
                index.setdefault(key, []).append((name, way))
    return index


def _candidates(index: Index, tag: str, attrs: dict[str, str]):
    yield from index.get(("tag", tag), ())
    for name, value in attrs.items():
        yield from index.get(("attr", name), ())
        if name == "id":
            yield from index.get(("id", value), ())
        elif name == "class":
            for part in set(value.split()):
                yield from index.get(("class", part), ())


class _Tree:
    """Elements in document order, each in all lists; an end tag closes up to the nearest open match."""

    def __init__(self, root: Tag) -> None:
        self.tags, self.parents, self.lasts = [root], [-1], [-1]
        self.first_texts, self.end_texts = [0], [-1]
        self.texts: list[tuple[str, int]] = []  # with the element that holds it
        self.open = [0]
        self._names: Counter[str] = Counter()  # of the open elements

    def start(self, tag: Tag) -> None:
        number, at = len(self.tags), len(self.texts)
        self.tags.append(tag)
        self.parents.append(self.open[-1])
        self.first_texts.append(at)
        self.lasts.append(number)
        self.end_texts.append(at)
        if not tag.closed:
            self.open.append(number)
            self._names[tag.name] += 1

    def end(self, name: str) -> None:
        if self._names[name]:
            while self._close_one() != name:
                pass

    def _close_one(self) -> str:
        number = self.open.pop()
        self.lasts[number], self.end_texts[number] = len(self.tags) - 1, len(self.texts)
        name = self.tags[number].name
        self._names[name] -= 1
        return name

    def finish(self) -> _Tree:
        while self.open:
            self._close_one()
        return self


class _Reader(HTMLParser):
    """Any page."""

    def __init__(self, tags: Tags) -> None:
        super().__init__(convert_charrefs=True)
        self.tree = _Tree(tags.root)
        self._of = tags.of
        self._pending: list[str] = []

    def updatepos(self, i, j):
        return j  # lines and columns are not asked for

    def _flush(self) -> None:
        if self._pending:
            self.tree.texts.append(("".join(self._pending), self.tree.open[-1]))
            self._pending = []

    def handle_starttag(self, tag, attrs):
        self._flush()
        self.tree.start(self._of(tag, {name: value or "" for name, value in attrs}))

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.tree.end(tag)

    def handle_endtag(self, tag):
        self._flush()
        self.tree.end(tag)

    def handle_data(self, data):
        self._pending.append(data)

    def handle_comment(self, data):
        self._flush()

    def read(self, html: str) -> _Tree:
        self.feed(html)
        self.close()
        self._flush()
        return self.tree.finish()


def _plain_page(html: str, tags: Tags) -> _Tree | None:
    """What ``_Reader`` reads, for a page of plainly written tags; None if there is any other markup."""
    tree = _Tree(tags.root)
    known, texts, open_, start, end = tags.known, tree.texts, tree.open, tree.start, tree.end
    head, *rest = html.split("<")
    if rest and not head and rest[0][:8].lower() == "!doctype":
        _, gt, head = rest.pop(0).partition(">")
        if not gt:
            return None
    if head:
        texts.append((unescape(head), 0))
    as_text = None  # the element whose content is text to its end tag
    for chunk in rest:
        written, gt, text = chunk.partition(">")
        if not gt:
            return None
        tag = known.get(written) or tags.written(written)
        if as_text:
            if tag != as_text:
                return None
            as_text = None
        if tag is None:
            if not _REMARK.fullmatch(written):
                return None
        elif isinstance(tag, str):
            end(tag)
        else:
            start(tag)
            if tag.name in _AS_TEXT:
                as_text = tag.name
        if text:
            texts.append((unescape(text) if "&" in text and not as_text else text, open_[-1]))
    return None if as_text else tree.finish()


# A run that the price rule takes for a number: it needs a digit, and only the first run counts.
_RUN = re.compile(r"[\d,.]+")
_DIGIT = re.compile(r"\d")


def _first_runs(pieces: list[str]) -> list[bool | None]:
    """From every piece on: whether the first run is a number; None if there is none to the end."""
    found: list[tuple[int, bool | None]] = [(len(pieces), None)]
    for i in range(len(pieces) - 1, -1, -1):
        run = _RUN.search(pieces[i])
        found.append((i, bool(_DIGIT.search(run.group()))) if run else found[-1])
    return found[::-1]


def _labelled(tree: _Tree, before: list[int], pieces: list[str], label: re.Pattern) -> list[tuple]:
    """(elements that hold the label texts, from, to) for each container of label texts with a price.

    The interval is the first one with a price: of the marked elements in the container, of the
    container itself, of the three elements after it.
    """
    tags, parents, lasts = tree.tags, tree.parents, tree.lasts
    holders: list[int] = []
    boxes: dict[int, list[int]] = {}
    for text, holder in tree.texts:
        if label.search(text):
            if not holders:
                for n, tag in enumerate(tags):
                    holders.append(n if tag.name in LABEL_HOLDERS else holders[parents[n]] if n else 0)
            if holders[holder]:
                boxes.setdefault(holders[holder], []).append(holder)
    if not boxes:
        return []
    runs = _first_runs(pieces)
    spans = [(before[a], before[b]) for a, b in zip(tree.first_texts, tree.end_texts)]
    children: dict[int, list[int]] = {}
    for n, parent in enumerate(parents):
        children.setdefault(parent, []).append(n)

    def priced(n: int) -> bool:
        at, number = runs[spans[n][0]]
        return bool(number) and at < spans[n][1]

    inner = [n for n, tag in enumerate(tags) if n and tag.by_label and priced(n)]
    found = []
    for at, own in boxes.items():
        place = bisect_right(inner, at)
        beside = children[parents[at]]
        first = bisect_right(beside, at)
        tried = [*(n for n in inner[place : place + 1] if n <= lasts[at]), *(n for n in (at, *beside[first : first + 3]) if priced(n))]
        if tried:
            found.append((list(dict.fromkeys(own)), *spans[tried[0]]))
    return found


def outline(
    html: str,
    index: Index,
    keep_attrs: tuple[str, ...] = (),
    label: re.Pattern | None = None,
    label_marks: tuple[Mark, ...] = (),
) -> dict:
    """A page's visible text, marked elements, script text and prices near labels.

    ``pieces``: the visible text, piece by piece, white space squeezed, none empty; ``raws``:
    the same with its white space.  ``marks``: for each mark its elements in page order: place
    (pre), last element inside, parent, the intervals of pieces and of raws, kept attributes.
    ``index`` is what ``index_marks`` made of the wanted marks.
    """
    known = index.tags(keep_attrs, label_marks if label is not None else ())
    tree = _plain_page(html or "", known) or _Reader(known).read(html or "")
    tags, parents, texts = tree.tags, tree.parents, tree.texts

    pieces: list[str] = []
    raws: list[str] = []
    before, raw_before = [0], [0]  # pieces ahead of every text
    for text, holder in texts:
        if not tags[holder].hidden:
            raws.append(text)
            if not text.isspace():
                pieces.append(" ".join(text.split()))
        before.append(len(pieces))
        raw_before.append(len(raws))
    shown = len(pieces)

    last_children = dict(zip(parents, range(len(parents))))
    above: list[frozenset[str]] = [frozenset()]
    marks: dict[str, list[tuple]] = {}
    scripts: list[str] = []
    for number, (tag, parent, first, end) in enumerate(zip(tags, parents, tree.first_texts, tree.end_texts)):
        if tag.name == "script":
            scripts.append("".join(t for t, _ in texts[first:end]))
        if not number:
            continue
        inherited = above[parent]
        own = dict.fromkeys(
            name for name, below, last_child in tag.ways
            if (below is None or below in inherited) and (not last_child or last_children[parent] == number)
        ) if tag.ways else None
        above.append(inherited.union(own) if own else inherited)
        if own:
            a, b, raw_a, raw_b = before[first], before[end], raw_before[first], raw_before[end]
            if tag.hidden:
                # Its own text is no part of the page's: it stands behind it.
                hidden = [t for t, _ in texts[first:end]]
                a, b, raw_a, raw_b = len(pieces), len(pieces) + 1, len(raws), len(raws) + 1
                pieces.append(" ".join(" ".join(hidden).split()))
                raws.append("".join(hidden))
            node = (number, tree.lasts[number], parent, a, b, raw_a, raw_b, tag.kept)
            for name in own:
                marks.setdefault(name, []).append(node)

    labels = _labelled(tree, before, pieces[:shown], label) if label is not None else []
    return {
        "pieces": pieces, "raws": raws, "shown": shown, "marks": list(marks.items()), "labels": labels,
        "scripts": "\n".join(scripts),
    }
