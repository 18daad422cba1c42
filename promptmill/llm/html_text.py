"""Text of web pages as a reader sees it: blocks, lists and aligned tables.

A small tree builder applies the usual implied tags (an open ``p``, ``li``, ``td`` ... ends where another begins), a visibility
pass drops what is never shown, and a renderer writes block spacing, list marks and padded table cells.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
_UNSEEN = frozenset(
    "head script style template title meta link base noscript iframe noembed noframes object audio video canvas svg math "
    "datalist param source track area map dialog".split()
)
_BLOCK = frozenset(
    "html body address article aside blockquote center dd details dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr legend li main menu nav ol p pre search section summary table ul "
    "caption thead tbody tfoot tr td th".split()
)
_SPACED = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl menu dir blockquote pre table figure fieldset hr".split())
# A start tag of the key ends an open element of the values, unless an element of _SCOPE lies between.
_ENDS = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "option": ("option",), "optgroup": ("option", "optgroup"),
    "tr": ("td", "th", "tr", "caption", "colgroup"), "td": ("td", "th"), "th": ("td", "th"),
    "thead": ("td", "th", "tr", "thead", "tbody", "tfoot", "caption", "colgroup"),
    "tbody": ("td", "th", "tr", "thead", "tbody", "tfoot", "caption", "colgroup"),
    "tfoot": ("td", "th", "tr", "thead", "tbody", "tfoot", "caption", "colgroup"),
    "body": ("head",), "rp": ("rt", "rp"), "rt": ("rt", "rp"),
}
_SCOPE = {
    "li": frozenset(("ul", "ol", "menu", "dir")), "dt": frozenset(("dl",)), "dd": frozenset(("dl",)), "tr": frozenset(("table",)),
    "td": frozenset(("table", "tr")), "th": frozenset(("table", "tr")), "thead": frozenset(("table",)),
    "tbody": frozenset(("table",)), "tfoot": frozenset(("table",)), "p": frozenset(("td", "th", "caption", "button", "object")),
}
# Inside these only the elements of _IN_TABLE stay; other visible content is put before the table, as HTML has it.
_TABLE_PARTS = frozenset("table thead tbody tfoot tr colgroup".split())
_CELLS = frozenset("td th caption".split())
_STRUCTURE = (_TABLE_PARTS | _CELLS | {"col"}) - {"table"}
_IN_TABLE = _STRUCTURE | frozenset("style script template".split())
_ENDS_P = _BLOCK - frozenset("html body td th tr thead tbody tfoot caption".split())
_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?")
_HIDDEN = re.compile(r"(?:^|;)\s*(?:display\s*:\s*none|visibility\s*:\s*(?:hidden|collapse))", re.I)
#: Lists and tables nested deeper are written as plain blocks.
_DEEPEST = 60
_SPACES = re.compile(r"[ \t\n\r\f]+")


class Node:
    __slots__ = ("name", "attributes", "children")

    def __init__(self, name: str, attributes: dict[str, str] | None = None):
        self.name, self.attributes, self.children = name, attributes or {}, []


def _attributes(source: str) -> dict[str, str]:
    found: dict[str, str] = {}
    for name, value in _ATTRIBUTE.findall(source):
        if value[:1] in "\"'" and len(value) > 1:
            value = value[1:-1]
        found.setdefault(name.lower(), unescape(value))
    return found


class _Open(list):
    """The open elements, with the places of those of each name: no search walks over the others."""

    def __init__(self, root: Node):
        super().__init__([root])
        self.places: dict[str, list[int]] = {}

    def append(self, node: Node) -> None:
        self.places.setdefault(node.name, []).append(len(self))
        super().append(node)

    def cut(self, place: int) -> None:
        while len(self) > place:
            self.places[super().pop().name].pop()

    def last(self, names) -> int:
        """The place of the innermost open element of some names, or 0; the root is none of them."""
        places = self.places
        return max((found[-1] for name in names if (found := places.get(name))), default=0)


def build(html: str) -> Node:
    """The element tree; text is stored as strings, with character references read."""
    root = Node("html")
    stack = _Open(root)

    def close(names, scope=frozenset()) -> None:
        place = stack.last(names)
        if place and place >= stack.last(scope):
            stack.cut(place)

    def open_part() -> int:
        """Place of the table part that an element of a table belongs to, or 0 inside a cell or outside tables."""
        part = stack.last(_TABLE_PARTS)
        return 0 if stack.last(_CELLS) > part else part

    def put(child: Node | str, stays: bool = False) -> None:
        """Append to the open element, or before the open table if only parts of tables may stay there."""
        if not stays and stack[-1].name in _TABLE_PARTS:
            table = stack.last(("table",))
            if table:  # the last child of the element around it
                stack[table - 1].children.insert(-1, child)
                return
        stack[-1].children.append(child)

    at, end = 0, len(html)
    while at < end:
        token = _TOKEN.search(html, at)
        text = html[at : token.start() if token else end]
        if text:
            text = unescape(text)
            put(text, not text.strip())
        if not token:
            break
        at = token.end()
        name = (token[2] or "").lower()
        if not name:
            continue
        if token[1]:
            if stack.last((name,)):
                close((name,), frozenset(("td", "th", "table")) if name in ("b", "i", "a", "span", "em", "strong", "font", "p", "form") else frozenset())
            elif name == "p":
                put(Node("p"))
            continue
        if name == "html":
            root.attributes |= _attributes(token[3])
            continue
        if name in _STRUCTURE and (part := open_part()):
            stack.cut(part + 1)  # what was put before the table ends here
            if name in ("caption", "colgroup", "col"):
                close(("tr", "thead", "tbody", "tfoot"), frozenset(("table",)))
                close(("thead", "tbody", "tfoot"), frozenset(("table",)))
            if stack[-1].name == "colgroup" and name != "col":
                stack.cut(len(stack) - 1)
        elif name == "table" and stack[-1].name in _TABLE_PARTS:
            close(("table",))
        while name in _ENDS:
            depth = len(stack)
            close(_ENDS[name], _SCOPE.get(name, frozenset()))
            if len(stack) == depth or name in ("li", "dt", "dd"):
                break
        if name in _ENDS_P:
            close(("p",), _SCOPE["p"])
        if name == "tr" and stack[-1].name == "table" or name in ("td", "th") and stack[-1].name in ("table", "tbody", "thead", "tfoot"):
            if name in ("td", "th"):
                row = Node("tr")
                stack[-1].children.append(row)
                stack.append(row)
        node = Node(name, _attributes(token[3]) if token[3].strip(" /") else None)
        if name == "form" and stack[-1].name in _TABLE_PARTS and stack.last(("table",)):
            continue  # a form between table parts holds nothing
        put(node, name in _IN_TABLE)
        if name in _RAW:
            stop = re.compile(rf"</{re.escape(name)}(?=[\s/>])[^>]*>?", re.I).search(html, at)
            inner = html[at : stop.start() if stop else end]
            node.children.append(unescape(inner) if name in ("textarea", "title") else inner)
            at = stop.end() if stop else end
        elif name not in _VOID and not token[3].endswith("/"):
            stack.append(node)
        elif name not in _VOID and name not in ("svg", "math", "path"):
            stack.append(node)  # a slash does not close an element of HTML
    return root


def visible(node: Node) -> bool:
    attributes = node.attributes
    if node.name in _UNSEEN and not (node.name == "dialog" and "open" in attributes):
        return False
    if not attributes:
        return True
    return not (
        ("hidden" in attributes and attributes["hidden"].lower() != "until-found")
        or (node.name == "input" and attributes.get("type", "").lower() == "hidden")
        or _HIDDEN.search(attributes.get("style", ""))
    )


def _width(text: str) -> int:
    if text.isascii():
        return len(text)
    return sum(0 if unicodedata.combining(c) else 2 if unicodedata.east_asian_width(c) in "WF" else 1 for c in text)


class _Lines:
    """Lines so far, with the blank lines that are due before the next one."""

    def __init__(self):
        self.lines: list[str] = []
        self.current: list[str] = []
        self.gap = 0
        self.space = False

    def word(self, text: str) -> None:
        if not text:
            return
        if self.gap and self.lines and not self.current:
            self.lines += [""] * (self.gap - 1)
        self.gap = 0
        self.current.append(text)

    def empty(self) -> None:
        """A line without text that stays."""
        if self.gap and self.lines and not self.current:
            self.lines += [""] * (self.gap - 1)
        self.gap = 0
        self.current.append("")

    def flow(self, text: str) -> None:
        collapsed = _SPACES.sub(" ", text)
        if collapsed[:1] == " ":
            self.space = True
            collapsed = collapsed[1:]
        if not collapsed:
            return
        tail = collapsed[-1] == " "
        self.word((" " if self.space and self.current else "") + collapsed.rstrip(" "))
        self.space = tail

    def end(self) -> None:
        if self.current:
            self.lines.append("".join(self.current))
            self.current = []
        self.space = False

    def block(self, blank: bool) -> None:
        self.end()
        self.gap = max(self.gap, 2 if blank else 1)

    def add(self, lines: list[str], blank: bool) -> None:
        self.block(blank)
        if lines:
            if self.lines:
                self.lines += [""] * (self.gap - 1)
            self.lines += lines
            self.gap = 2 if blank else 1

    def done(self) -> list[str]:
        self.end()
        return self.lines


def _render(root: Node, depth: int = 0) -> list[str]:
    """Lines of one element's content; nested lists and tables are rendered apart and set in, to a depth of ``_DEEPEST``."""
    out = _Lines()
    apart = depth < _DEEPEST
    # An explicit stack, so that deeply nested pages do not exhaust Python's.
    waiting: list = [("open", child, False) for child in reversed(root.children)]
    while waiting:
        step, node, pre = waiting.pop()
        if step == "close":
            out.block(node.name in _SPACED)
        elif isinstance(node, str):
            if pre:
                parts = node.replace("\r\n", "\n").split("\n")
                for i, part in enumerate(parts):
                    if i:
                        if not out.current:
                            out.empty()
                        out.end()
                    out.word(part)
            else:
                out.flow(node)
        elif not visible(node):
            continue
        elif node.name == "br":
            if not out.current:
                out.gap = max(out.gap, 2) if out.lines else 0
            out.end()
            out.gap = max(out.gap, 1)
        elif node.name == "hr":
            out.add(["---"], True)
        elif node.name == "img":
            if node.attributes.get("alt"):
                out.flow(node.attributes["alt"])
        elif node.name == "input":
            if node.attributes.get("type", "text").lower() in ("submit", "button", "reset", "text"):
                out.flow(node.attributes.get("value", ""))
        elif apart and node.name in ("ul", "ol", "menu", "dir"):
            out.add(_list(node, depth + 1), root.name != "li")
        elif apart and node.name == "table":
            out.add(_table(node, depth + 1), True)
        elif apart and node.name == "dd":
            out.add(["    " + line if line else "" for line in _render(node, depth + 1)], False)
        elif apart and node.name == "blockquote":
            out.add(["> " + line if line else ">" for line in _render(node, depth + 1)], True)
        elif node.name in _BLOCK:
            out.block(node.name in _SPACED)
            waiting.append(("close", node, pre))
            waiting += [("open", child, pre or node.name == "pre") for child in reversed(node.children)]
        else:
            waiting += [("open", child, pre or node.name == "textarea") for child in reversed(node.children)]
    return [line.rstrip() for line in out.done()]


def _list(node: Node, depth: int) -> list[str]:
    start = node.attributes.get("start", "1")
    number = int(start) if re.fullmatch(r"-?\d{1,9}", start) else 1
    lines: list[str] = []
    for child in node.children:
        if isinstance(child, str):
            if child.strip(" \t\n\r\f"):
                lines.append(_SPACES.sub(" ", child).strip(" "))
            continue
        if not visible(child):
            continue
        if child.name != "li":
            holder = Node("div")
            holder.children = [child]
            lines += ["  " + line if line else "" for line in _render(holder, depth)]
            continue
        given = child.attributes.get("value", "")
        number = int(given) if node.name == "ol" and re.fullmatch(r"-?\d{1,9}", given) else number
        mark = f"{number}. " if node.name == "ol" else "- "
        number += 1
        own = _render(child, depth)
        lines += [(mark if i == 0 else " " * len(mark)) + line if line else "" for i, line in enumerate(own or [""])] if own else [mark.rstrip()]
    return lines


def _rows(node: Node) -> Iterator[Node]:
    waiting = list(reversed(node.children))
    while waiting:
        child = waiting.pop()
        if isinstance(child, Node) and visible(child):
            if child.name == "tr":
                yield child
            elif child.name in ("thead", "tbody", "tfoot"):
                waiting += reversed(child.children)


def _span(cell: Node, name: str) -> int:
    value = cell.attributes.get(name, "1")
    return max(1, min(int(value), 1000)) if re.fullmatch(r"\d{1,9}", value) else 1


def _table(node: Node, depth: int) -> list[str]:
    """Cells of a column start at the same place, two blanks after the widest one before; other content comes first."""
    before = Node("div")
    before.children = [c for c in node.children if isinstance(c, str) or c.name not in ("tr", "thead", "tbody", "tfoot", "colgroup", "col")]
    grid: list[dict[int, list[str]]] = []
    taken: dict[int, int] = {}  # rows that a cell above still covers, by column
    for row in _rows(node):
        cells: dict[int, list[str]] = {}
        column = 0
        for cell in row.children:
            if not isinstance(cell, Node) or cell.name not in ("td", "th") or not visible(cell):
                continue
            while taken.get(column, 0):
                column += 1
            cells[column] = _render(cell, depth)
            for extra in range(_span(cell, "colspan")):
                taken[column + extra] = _span(cell, "rowspan")
            column += _span(cell, "colspan")
        grid.append(cells)
        taken = {c: n - 1 for c, n in taken.items() if n > 1}
    widths: dict[int, int] = {}
    for cells in grid:
        last = max(cells, default=0)
        for column, lines in cells.items():
            if column != last or column in widths:
                widths[column] = max(widths.get(column, 0), *(map(_width, lines or [""])))
    lines = _render(before, depth)
    columns = sorted(set(widths).union(*grid)) if grid else []
    for cells in grid:
        height = max((len(own) for own in cells.values()), default=0)
        for i in range(height):
            text = ""
            place = 0
            for column in columns:
                own = cells.get(column, [])
                part = own[i] if i < len(own) else ""
                if part:
                    text += " " * (place - _width(text)) + part
                place += widths.get(column, 0) + 2
            lines.append(text.rstrip())
    return lines


def page_text(html: str | None) -> str:
    """The visible text of one page; empty for a null or empty page."""
    return "\n".join(_render(build(html))).strip("\n") if html else ""


def extract(pages: DataFrame, *, page_id: str = "page_id", html: str = "html") -> DataFrame:
    """``page_id, text`` for every page row.

    Broken markup is read as far as it goes and never fails; null and empty pages give an empty text; repeated rows each get
    their text; an empty table gives no rows; other columns are ignored.
    """
    kind = pages.select(page_id).schema[0].dataType.simpleString()

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = pa.array([page_text(value.as_py()) for value in batch.column("html")], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), texts], ["page_id", "text"])

    given = pages.select(F.col(page_id).alias("page_id"), F.col(html).alias("html"))
    return given.mapInArrow(read, f"page_id {kind}, text string")
