"""HTML of a note to Markdown; plain Python without Spark.

tree() gives elements by stack rules: an end tag closes the nearest open element of its name and all inside it, a stray one is
ignored, nothing else is closed for the author. Text of comments and declarations counts as text unless drop_comments is set.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from html.parser import HTMLParser
from itertools import groupby

from .tables import Cell, grid, markdown_table, span

# What is a block, what never holds anything, and the classes of titles
BLOCKS = frozenset("div p table h1 h2 h3 h4 ul ol".split())
VOID = frozenset("area base basefont bgsound br col command embed frame hr image img input isindex keygen link menuitem meta nextid param source spacer track wbr".split())
TITLE_CLASSES = frozenset({"Titulo_1"})
SECTION_CLASSES = frozenset({"Titulo_2", "ANOTACION"})


@dataclass(slots=True)
class Element:
    name: str
    attributes: dict[str, str | None] = field(default_factory=dict)
    inside: list[Element | str] = field(default_factory=list)

    def classes(self) -> frozenset[str]:
        return frozenset((self.attributes.get("class") or "").split())

    def elements(self) -> Iterator[Element]:
        return (x for x in self.inside if not isinstance(x, str))

    def descendants(self, name: str) -> Iterator[Element]:
        """In document order; pages nest as deep as they like, so no recursion here or below."""
        ahead = [self.elements()]
        while ahead:
            x = next(ahead[-1], None)
            if x is None:
                ahead.pop()
                continue
            if x.name == name:
                yield x
            ahead.append(x.elements())

    def emphasis(self) -> tuple[bool, bool]:
        """(bold, italic) by tag or inline style."""
        style = (self.attributes.get("style") or "").replace(" ", "").lower()
        return self.name in ("b", "strong") or "font-weight:bold" in style, self.name in ("i", "em") or "font-style:italic" in style


class _Builder(HTMLParser):
    def __init__(self, drop_comments: bool):
        super().__init__(convert_charrefs=True)
        self.open = [Element("")]
        self.drop_comments = drop_comments

    def handle_starttag(self, tag, attrs):
        element = Element(tag, dict(attrs))
        self.open[-1].inside.append(element)
        if tag not in VOID:
            self.open.append(element)

    def handle_startendtag(self, tag, attrs):
        self.open[-1].inside.append(Element(tag, dict(attrs)))

    def handle_endtag(self, tag):
        depth = next((k for k in range(len(self.open) - 1, 0, -1) if self.open[k].name == tag), None)
        if depth:
            del self.open[depth:]

    def handle_data(self, data):
        inside = self.open[-1].inside
        if inside and isinstance(inside[-1], str) and not isinstance(inside[-1], _Aside):
            inside[-1] += data
        else:
            inside.append(data)

    def _aside(self, data: str) -> None:
        if not self.drop_comments:
            self.open[-1].inside.append(_Aside(data))

    handle_comment = _aside
    handle_pi = _aside
    unknown_decl = _aside

    def handle_decl(self, decl):
        self._aside(decl[8:] if decl[:7].upper() == "DOCTYPE" else decl)


class _Aside(str):
    """Text that doesn't join with the text around it."""

    __slots__ = ()


def tree(source: str, drop_comments: bool = False) -> Element:
    builder = _Builder(drop_comments)
    builder.feed(source)
    builder.close()
    return builder.open[0]


def tidy(text: str) -> str:
    """Blanks and tabs as one blank, none around line breaks, trimmed."""
    return re.sub(r" *\n *", "\n", re.sub(r"[ \t]+", " ", text)).strip()


def _runs(element: Element, line_break: str) -> Iterator[tuple[str, tuple[bool, bool]]]:
    """(text, (bold, italic)) of what an element holds; its own emphasis doesn't count."""
    ahead = [(iter(element.inside), (False, False))]
    while ahead:
        inside, (bold, italic) = ahead[-1]
        x = next(inside, None)
        if x is None:
            ahead.pop()
        elif isinstance(x, str):
            yield re.sub(r"\s+", " ", x), (bold, italic)
        elif x.name == "br":
            yield line_break, (bold, italic)
        elif x.name not in ("script", "style"):
            b, i = x.emphasis()
            ahead.append((iter(x.inside), (bold or b, italic or i)))


def inline(element: Element, line_break: str = "\n") -> str:
    """An element as one paragraph; markers stand inside the blanks around emphasised text."""
    out = []
    for (bold, italic), run in groupby(_runs(element, line_break), key=lambda r: r[1]):
        text = "".join(t for t, _ in run)
        core = text.strip(" ")
        if core and (bold or italic):
            mark = "**" * bold + "*" * italic
            before, _, after = text.partition(core)
            text = f"{before}{mark}{core}{mark}{after}"
        out.append(text)
    return tidy("".join(out))


def table(element: Element) -> str:
    def cell(x: Element) -> Cell:
        text = inline(x, " ").replace("\n", " ").replace("|", r"\|").strip()
        return Cell(text, span(x.attributes.get("rowspan")), span(x.attributes.get("colspan")))

    return markdown_table(grid([cell(x) for x in row.elements() if x.name in ("td", "th")] for row in element.descendants("tr")))


def _heading(element: Element) -> int:
    """Level of a heading, 0 for none."""
    classes = element.classes()
    if element.name == "h1" or classes & TITLE_CLASSES:
        return 1
    if element.name == "h2" or classes & SECTION_CLASSES:
        return 2
    return 3 if element.name in ("h3", "h4") else 0


def blocks(root: Element) -> Iterator[tuple[str, str]]:
    """(kind, Markdown) of the blocks in order; kinds: text, table, heading, paragraph."""
    ahead = [iter(root.inside)]
    while ahead:
        x = next(ahead[-1], None)
        if x is None:
            ahead.pop()
            continue
        if isinstance(x, str):
            kind, made = "text", tidy(x)
        elif x.name in ("script", "style"):
            continue
        elif x.name == "table":
            kind, made = "table", table(x)
        elif level := _heading(x):
            kind, made = "heading", inline(x, " ")
            made = made and f"{'#' * level} {made}"
        elif x.name in ("div", "p") and any(y.name in BLOCKS for y in x.elements()):
            ahead.append(iter(x.inside))
            continue
        else:
            kind, made = "paragraph", inline(x)
        if made.strip():
            yield kind, made


def html_blocks(source: str | None, drop_comments: bool = False) -> list[tuple[str, str]]:
    document = tree(source or "", drop_comments)
    return list(blocks(next(document.descendants("body"), document)))


def html_to_md(source: str | None, drop_comments: bool = False) -> str:
    """Blocks joined by a blank line; null and empty sources give an empty text."""
    return "\n\n".join(made for _, made in html_blocks(source, drop_comments))
