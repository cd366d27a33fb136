"""Visible text of HTML pages, laid out: a tree builder with implied tags, then rendering.

The builder closes what HTML lets authors leave open (paragraphs, list items, table rows
and cells, options) and drops end tags without a start. The renderer skips what a browser
does not show (by element, attribute or style attribute; style sheets are not evaluated, and
of closed details the summary shows), collapses white space, separates blocks by lines or
blank lines, marks and indents list items and pads table cells so that columns line up. Cells
keep their blocks and lists as lines, and reach over as many columns and rows as they say.

Pages are independent rows, read in Arrow batches; nothing is shuffled. The walk keeps its
own stack, so deep nesting cannot exhaust Python's.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import defaultdict
from collections.abc import Iterable
from dataclasses import dataclass
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import prepare, read_table, strings, unused_name

# Fixed values of HTML: element kinds.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
UNSEEN = set("head script style template noscript title iframe object svg math datalist audio video canvas".split())
SPACED = set("p h1 h2 h3 h4 h5 h6 blockquote ul ol dl table pre figure fieldset hr".split())
BLOCK = SPACED | set(
    "html body div section article aside nav header footer main address form li dt dd tr caption details summary figcaption "
    "thead tbody tfoot option optgroup select textarea legend center".split()
)
#: Start tags that may stand in a head, and end tags that close what a cell stands in.
NOT_CONTENT = UNSEEN | {"html", "body", "meta", "link", "base"}
OUT_OF_CELLS = {"tr", "table", "thead", "tbody", "tfoot", "body", "html"}
#: A start tag ends open elements of the first set, looking up to an element of the second.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th", "caption"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "thead": ({"thead", "tbody", "tfoot", "tr", "td", "th", "caption"}, {"table"}),
    "tbody": ({"thead", "tbody", "tfoot", "tr", "td", "th", "caption"}, {"table"}),
    "tfoot": ({"thead", "tbody", "tfoot", "tr", "td", "th", "caption"}, {"table"}),
    "option": ({"option"}, {"select", "datalist"}),
    "optgroup": ({"option", "optgroup"}, {"select"}),
    "body": ({"head"}, {"html"}),
}
#: An open paragraph ends where a block begins, unless one of these lies in between.
HOLDS_P = {"td", "th", "caption", "button", "table", "li", "dd", "dt", "div", "section", "article", "blockquote"}
#: A table with a longer line in a cell lays out the page, not data: its cells follow each other as blocks.
DATA_LINE = 200
#: Greatest spans of a cell in the HTML standard (fixed values).
COLUMNS, ROWS = 1000, 65534

_SPACES = re.compile(r"[ \t\n\r\f\v]+")
_HIDDEN_STYLE = re.compile(r"(?:display\s*:\s*none|visibility\s*:\s*(?:hidden|collapse))", re.I)


class Node:
    __slots__ = ("tag", "attrs", "children")

    def __init__(self, tag: str, attrs: dict):
        self.tag, self.attrs, self.children = tag, attrs, []

    def hidden(self) -> bool:
        if self.tag in UNSEEN or "hidden" in self.attrs:
            return True
        if self.tag == "input" and (self.attrs.get("type") or "").lower() == "hidden":
            return True
        return bool(_HIDDEN_STYLE.search(self.attrs.get("style") or ""))


class TreeBuilder(HTMLParser):
    """Tree of a page; never fails on malformed markup, however deep."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Node("root", {})
        self.open = [self.root]
        self.places: dict[str, list[int]] = defaultdict(list)  # of the open elements, by tag

    def _last(self, tags: Iterable[str]) -> int:
        """Place of the innermost open element with one of the tags; -1 for none."""
        return max((self.places[t][-1] for t in tags if self.places[t]), default=-1)

    def _end(self, place: int) -> None:
        for node in self.open[place:]:
            self.places[node.tag].pop()
        del self.open[place:]

    def _close(self, tags: set[str], until: set[str]) -> None:
        k = self._last(tags)
        if k < 0 or k < self._last(until - tags):
            return
        # The outermost one of the run is ended, with all it holds.
        while k > 1 and self.open[k - 1].tag in tags:
            k -= 1
        self._end(k)

    def handle_starttag(self, tag, attrs):
        if tag in BLOCK:
            self._close({"p"}, HOLDS_P)
        if tag in CLOSES:
            self._close(*CLOSES[tag])
        if tag not in NOT_CONTENT:
            self._close({"head"}, {"template"})  # content ends an open head
        node = Node(tag, dict(attrs))
        self.open[-1].children.append(node)
        if tag not in VOID:
            self.places[tag].append(len(self.open))
            self.open.append(node)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag):
        if tag == "br":
            self.handle_starttag("br", [])
        place = self._last((tag,))
        # An end tag does not reach out of a cell.
        if place > 0 and (tag in OUT_OF_CELLS or place >= self._last(("td", "th", "table"))):
            self._end(place)

    def handle_data(self, data):
        self.open[-1].children.append(data)


class Lines:
    """Text being laid out: pending breaks and spaces are settled when text comes."""

    def __init__(self):
        self.done: list[str] = []
        self.parts: list[str] = []  # of the line that is being filled
        self.space = False
        self.blank = False

    def text(self, data: str) -> None:
        for k, part in enumerate(_SPACES.split(data)):
            if k:
                self.space = True
            if part:
                if self.space and self.parts:
                    self.parts.append(" ")
                self.parts.append(part)
                self.space = False

    def verbatim(self, data: str) -> None:
        first, *others = data.expandtabs(4).split("\n")
        self.parts += [first] if first else []
        for line in others:
            self.end_line(keep_empty=True)
            self.parts = [line] if line else []

    def end_line(self, keep_empty: bool = False) -> None:
        if self.parts or keep_empty:
            if self.blank and self.done:
                self.done.append("")
            self.done.append("".join(self.parts))
            self.blank = False
        self.parts, self.space = [], False

    def gap(self) -> None:
        self.end_line()
        self.blank = True

    def add(self, lines: list[str], first: str = "", rest: str = "") -> None:
        """Finished lines with a mark before the first and an indent before the others."""
        self.end_line()
        for k, line in enumerate(lines):
            self.parts = [(first if k == 0 else rest if line else "") + line]
            self.end_line(keep_empty=True)

    def finished(self) -> list[str]:
        self.end_line()
        return self.done


@dataclass
class Cell:
    lines: list[str]
    columns: int
    rows: int


def _placed(rows: list[list[Cell]]) -> list[list[tuple[int, Cell]]]:
    """First column of every cell; columns that a cell above reaches down into are passed over."""
    taken: dict[int, int] = {}  # rows that a column is still taken for
    found = []
    for row in rows:
        at, own = 0, []
        for cell in row:
            while taken.get(at):
                at += 1
            own.append((at, cell))
            for k in range(at, at + cell.columns):
                taken[k] = max(taken.get(k, 0), cell.rows)
            at += cell.columns
        found.append(own)
        taken = {k: n - 1 for k, n in taken.items() if n > 1}
    return found


def _table(rows: list[list[Cell]]) -> list[str]:
    """Rows of cells with columns lined up; a cell of several lines makes its row as high."""
    if any(len(line) > DATA_LINE for row in rows for cell in row for line in cell.lines):
        blocks = [cell.lines for row in rows for cell in row if cell.lines]
        return [line for k, lines in enumerate(blocks) for line in ([""] if k else []) + lines]
    placed = _placed(rows)
    widths: dict[int, int] = defaultdict(int)
    for row in placed:
        for at, cell in row:
            if cell.columns == 1:
                widths[at] = max(widths[at], max(map(len, cell.lines), default=0))
            else:
                widths[at] += 0
    used = sorted(widths)
    found = []
    for row in placed:
        height = max([1, *(len(cell.lines) for _, cell in row)])
        for y in range(height):
            parts, end = [], 0
            for at, cell in row:
                parts += [" " * widths[k] for k in used[bisect_left(used, end) : bisect_left(used, at)]]
                end = at + cell.columns
                own = [widths[k] for k in used[bisect_left(used, at) : bisect_left(used, end)]]
                parts.append((cell.lines[y] if y < len(cell.lines) else "").ljust(sum(own) + 3 * (len(own) - 1)))
            found.append(" | ".join(parts).rstrip())
    return found


def _span(node: Node, name: str, most: int) -> int:
    value = node.attrs.get(name) or "1"
    return min(max(int(value), 1), most) if value.isdecimal() and len(value) < 9 else 1


class _Frame:
    """An element on the walk's stack, with what it stands in."""

    def __init__(self, node: Node, out: Lines, verbatim: bool, above: _Frame | None = None):
        self.node, self.out, self.verbatim, self.next = node, out, verbatim, 0
        self.count = 0  # items of a list so far
        self.rows: list[list[Cell]] = []  # of a table
        self.items = (above.items if above else 0) + (node.tag == "li")
        self.table = self if node.tag == "table" else above.table if above else None
        self.group = self if node.tag in ("ul", "ol", "menu") else above.group if above else None

    def spaced(self) -> bool:
        """Whether blank lines go around the element; a list in a list has none."""
        return self.node.tag in SPACED and not (self.node.tag in ("ul", "ol") and self.items)

    def shows(self, child: Node | str) -> bool:
        if self.node.tag == "details" and "open" not in self.node.attrs:
            return isinstance(child, Node) and child.tag == "summary" and not child.hidden()
        return not isinstance(child, Node) or not child.hidden()


def _enter(stack: list[_Frame], node: Node) -> None:
    top = stack[-1]
    out, verbatim = top.out, top.verbatim
    if node.tag == "br":
        out.end_line(keep_empty=bool(out.done or out.parts))
        return
    if node.tag == "hr":
        out.gap()
        out.add(["-" * 8])
        out.gap()
        return
    if node.tag == "input":
        if (node.attrs.get("type") or "text").lower() in ("text", "submit", "button", "reset", "search", "email", "url"):
            out.text(f" {node.attrs.get('value') or ''} ")
        return
    # What needs a mark, an indent or padding is laid out by itself first.
    apart = node.tag in ("li", "dd", "blockquote", "td", "th", "pre", "textarea")
    frame = _Frame(node, Lines() if apart else out, verbatim or node.tag in ("pre", "textarea"), top)
    if frame.spaced():
        out.gap()
    elif node.tag in BLOCK:
        out.end_line()
    stack.append(frame)
    if node.tag == "tr" and frame.table:
        frame.table.rows.append([])


def _leave(stack: list[_Frame]) -> None:
    frame = stack.pop()
    node, out = frame.node, stack[-1].out
    if node.tag == "li":
        group = frame.group
        mark = "- "
        if group:
            group.count += 1
            start = group.node.attrs.get("start") or "1"
            first = int(start) if start.isdecimal() and len(start) < 9 else 1
            mark = f"{first + group.count - 1}. " if group.node.tag == "ol" else "- "
        out.add(frame.out.finished() or [""], mark, " " * len(mark))
    elif node.tag == "dd":
        out.add(frame.out.finished(), "  ", "  ")
    elif node.tag == "blockquote":
        out.add(frame.out.finished(), "> ", "> ")
    elif node.tag in ("pre", "textarea"):
        out.add(frame.out.finished())
    elif node.tag in ("td", "th"):
        lines = frame.out.finished()
        if frame.table and frame.table.rows:
            cell = Cell(lines, _span(node, "colspan", COLUMNS), _span(node, "rowspan", ROWS))
            frame.table.rows[-1].append(cell)
        else:
            out.text(f" {' '.join(lines)} ")
    elif node.tag == "table":
        out.add(_table([r for r in frame.rows if r]))
    if frame.spaced():
        out.gap()
    elif node.tag in BLOCK:
        out.end_line()


def visible_text(html: str) -> str:
    """The text a reader of the page sees, laid out in lines."""
    builder = TreeBuilder()
    builder.feed(html)
    builder.close()
    lines = Lines()
    stack = [_Frame(builder.root, lines, False)]
    while stack:
        frame = stack[-1]
        if frame.next == len(frame.node.children):
            if len(stack) == 1:
                break
            _leave(stack)
            continue
        child = frame.node.children[frame.next]
        frame.next += 1
        if not frame.shows(child):
            continue
        if isinstance(child, Node):
            _enter(stack, child)
        elif frame.verbatim:
            frame.out.verbatim(child)
        elif frame.node.tag not in ("table", "tr", "thead", "tbody", "tfoot") or child.strip():
            frame.out.text(child)
    return "\n".join(lines.finished())


def extract(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """The rows with ``text`` in place of the HTML column, whole pages.

    A null page gives null, an empty one the empty text. Markup without visible text gives
    the empty text; text without markup is kept with its white space collapsed. Repeated
    rows are treated alike; an empty table stays empty. A column named ``text`` is replaced.
    """
    prepare(pages.sparkSession)
    own = [c for c in pages.columns if c not in (html_col, "text")]
    helper = unused_name(pages, "_html")
    rows = pages.select(F.col(html_col).alias(helper), *[F.col(f"`{c}`") for c in own])

    def render(batches):
        for batch in batches:
            html = batch[helper]
            texts = [visible_text(h) if known else None for h, known in zip(strings(html).to_pylist(), html.is_valid().to_pylist())]
            columns = {"text": pa.array(texts, pa.string())} | {c: batch[c] for c in batch.schema.names if c != helper}
            yield pa.record_batch(columns)

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[1:])
    return rows.mapInArrow(render, f"text string{', ' + kinds if kinds else ''}").select(*[F.col(f"`{c}`") for c in own], "text")


def op3_html_extraction(spark, sf_dir: str) -> DataFrame:
    return extract(read_table(spark, sf_dir, "pages"))
