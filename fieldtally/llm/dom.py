"""A page as a flat tree: its elements in page order, and its pieces of text, each with its element and its block.

Tags are read as browsers read them as far as that decides where text belongs: comments, raw text of scripts and styles, quoted
attributes, implied ends of paragraphs, list items, headings and cells, and end tags that close all that is still open inside. End
tags without a start are left out; elements that are never closed end with their parent. Formatting tags (``b``, ``span`` and
all names that are not blocks) are read through: their text belongs to the element around them. Reading is linear in the page's
length, however its tags are nested or broken.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from html import unescape

# Element names by their role in HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea xmp iframe noembed noframes".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
BLOCKS = HEADINGS | frozenset(
    "address article aside blockquote caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "header hgroup legend li main menu nav ol option p pre search section summary table tbody td tfoot th thead tr ul".split()
)
TABLE_PARTS = frozenset("caption tbody td tfoot th thead tr".split())
ENDS_PARAGRAPH = BLOCKS - TABLE_PARTS - {"option", "legend"} | {"hr"}
# What a start tag ends, if it is open in the same list or table.
ENDS = {
    "li": ("li",),
    "dd": ("dd", "dt"),
    "dt": ("dd", "dt"),
    "td": ("td", "th", "caption"),
    "th": ("td", "th", "caption"),
    "tr": ("tr", "caption"),
    "tbody": ("tr", "tbody", "thead", "tfoot", "caption"),
    "thead": ("tr", "tbody", "thead", "tfoot", "caption"),
    "tfoot": ("tr", "tbody", "thead", "tfoot", "caption"),
}
LISTS = {"li": ("ul", "ol", "menu", "dir"), "dd": ("dl",), "dt": ("dl",)}
SCOPES = ("table", "td", "th", "caption", "object", "button")
ROOT = ("html", "head", "body")

TAG = re.compile(
    r"""<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*+)(?P<attributes>(?:[^=>]++|=\s*+(?:"[^"]*+(?:"|\Z)|'[^']*+(?:'|\Z))?+)*+)(?:>|\Z)"""
)
ATTRIBUTE = re.compile(r"""(?:^|[\s"'/])(class|id|role)\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s"'>]++))""", re.IGNORECASE)


@dataclass
class Tree:
    """Element 0 is the body. ``last`` is the last element inside each; pieces are (element, block, text)."""

    names: list[str] = field(default_factory=lambda: ["body"])
    parents: list[int] = field(default_factory=lambda: [-1])
    marks: list[dict[str, str]] = field(default_factory=lambda: [{}])
    last: list[int] = field(default_factory=lambda: [0])
    pieces: list[tuple[int, int, str]] = field(default_factory=list)


class Reader:
    """Open tags as a stack, and the places on it of each name, so that no end tag is looked for by a walk."""

    def __init__(self) -> None:
        self.tree, self.block = Tree(), 0
        self.open: list[tuple[str, int]] = []  # (name, element that its text belongs to)
        self.places: dict[str, list[int]] = {}
        self.solid: list[int] = []  # places of blocks

    def place(self, *names: str) -> int:
        return max((self.places[n][-1] for n in names if self.places.get(n)), default=-1)

    def here(self) -> int:
        return self.open[-1][1] if self.open else 0

    def pop_to(self, place: int) -> None:
        while len(self.open) > place:
            name, element = self.open.pop()
            self.places[name].pop()
            if name in BLOCKS:
                self.solid.pop()
                self.block += 1
            if self.here() != element:
                self.tree.last[element] = len(self.tree.names) - 1

    def start(self, name: str, attributes: str, node: bool) -> None:
        if name in ENDS_PARAGRAPH and (p := self.place("p")) > self.place(*SCOPES):
            self.pop_to(p)
        if name in HEADINGS and self.solid and self.open[self.solid[-1]][0] in HEADINGS:
            self.pop_to(self.solid[-1])
        while name in ENDS and (at := self.place(*ENDS[name])) > self.place(*LISTS.get(name, ("table",)), *(SCOPES if name in LISTS else ())):
            self.pop_to(at)
        if name in VOID:
            if name == "br":
                self.text(" ")
            self.block += name == "hr"
            return
        element = self.here()
        if node:
            tree = self.tree
            tree.names.append(name)
            tree.parents.append(element)
            tree.marks.append({m[1].lower(): m[2] or m[3] or m[4] or "" for m in reversed(list(ATTRIBUTE.finditer(attributes)))})
            element = len(tree.names) - 1
            tree.last.append(element)
        if name in BLOCKS:
            self.solid.append(len(self.open))
            self.block += 1
        self.places.setdefault(name, []).append(len(self.open))
        self.open.append((name, element))

    def end(self, name: str) -> None:
        at = self.place(name)
        if name == "br":
            self.text(" ")
        elif name in HEADINGS and (at := self.place(*HEADINGS)) < 0 or at < 0:
            return
        elif name not in BLOCKS and self.solid and self.solid[-1] > at and name not in SCOPES:
            return  # a formatting tag does not end the blocks inside it
        elif name == "table" or at >= self.place(*(("table",) if name in TABLE_PARTS else SCOPES)):
            self.pop_to(at)

    def text(self, text: str) -> None:
        if text:
            self.tree.pieces.append((self.here(), self.block, text))


def read(page: str, is_node) -> Tree:
    """The tree of a page. ``is_node(name, attributes)`` says which of the names that are not blocks are elements of it."""
    reader, at = Reader(), 0
    while True:
        cut = page.find("<", at)
        reader.text(unescape(page[at : cut if cut >= 0 else len(page)]))
        if cut < 0:
            break
        if tag := TAG.match(page, cut):
            name, at = tag["name"].lower(), tag.end()
            if tag["end"]:
                reader.end(name)
            elif name in RAW:
                close = re.compile(rf"</{name}(?=[\s/>])[^>]*+>?", re.IGNORECASE).search(page, at)
                at = close.end() if close else len(page)
            elif name not in ROOT and not (name in ("svg", "math") and tag["attributes"].endswith("/")):
                reader.start(name, tag["attributes"], name in BLOCKS or is_node(name, tag["attributes"]))
        elif page.startswith("<!--", cut):
            close = re.compile("--!?>").search(page, cut + 2)
            at = close.end() if close else len(page)
        elif page[cut + 1 : cut + 2] in ("!", "?", "/"):
            close = page.find(">", cut)
            at = close + 1 if close >= 0 else len(page)
        else:
            reader.text("<")
            at = cut + 1
    reader.pop_to(0)
    reader.tree.last[0] = len(reader.tree.names) - 1
    return reader.tree
