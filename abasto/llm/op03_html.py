"""HTML to text by layout: a tree with implied tags, visibility rules, block spacing, lists and aligned tables.

The builder closes what HTML lets an author leave out (paragraphs, list items, definition terms, options, table rows and
cells), ignores end tags that match nothing, and keeps at most ``DEPTH`` open elements: deeper ones become siblings, as
browsers do it. Invisible are the head, scripts, styles, templates and other non-rendered elements, the ``hidden``
attribute, hidden inputs, closed dialogs, closed details but for their summary, and the inline styles ``display:none`` and
``visibility:hidden`` (a descendant may set ``visibility:visible``). Paragraph-like blocks stand apart by an empty line,
other blocks by a line end; white space collapses outside ``pre``. List items carry bullets or numbers and are indented
by nesting; table cells are padded to the width of their column. What stands in a table outside its cells and caption is
moved in front of the table. Formulas and the text of drawings are shown.

Null html: null text. Empty html: empty text. Null or repeated ``page_id``: each row is rendered on its own. Empty table:
no rows. Other columns are not read.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_left
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from abasto.llm.common import prepare

DEPTH = 250

# Element names of the HTML standard by what the builder and the renderer do with them.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes plaintext".split())
HEAD = frozenset("base link meta script style title template noscript".split())
UNSEEN = frozenset(
    "head script style template title noscript noembed noframes iframe object audio video canvas datalist "
    "area param source track map embed".split()
)
APART = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl menu dir table pre blockquote figure fieldset hr xmp".split())
BLOCK = APART | frozenset(
    "html body div section article aside header footer nav main address form li dt dd details summary figcaption "
    "legend center caption search hgroup dialog optgroup option".split()
)
CLOSES_P = (BLOCK - {"html", "body", "option", "optgroup", "legend", "caption"}) | {"hr"}
LISTS = frozenset("ul ol menu dir".split())
ROWS = frozenset("tbody thead tfoot".split())
BETWEEN = ROWS | {"table", "tr"}
IN_TABLE = ROWS | {"tr", "td", "th", "caption", "colgroup", "col"}
FOREIGN = {  # elements of formulas and drawings that do not show
    "svg": frozenset("defs desc metadata symbol clippath mask pattern marker lineargradient radialgradient filter".split()),
    "math": frozenset("annotation annotation-xml mphantom".split()),
}
HTML_IN_FOREIGN = frozenset("foreignobject desc annotation-xml".split())
PARTS = frozenset("mfrac msub msup msubsup mroot munder mover munderover mmultiscripts mtr".split())
SCOPE = frozenset("table td th caption template button html".split())

_SKIPPED = re.compile(r"<!--(?:>|->|.*?(?:-->|--!>|\Z))|<[!?][^>]*(?:>|\Z)|</(?:[^A-Za-z>][^>]*)?(?:>|\Z)", re.DOTALL)
_TAG = re.compile(r"<(/?)([A-Za-z][^\s/>]*)")
_STOP = re.compile("[>\"']")
_ATTRIBUTE = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_BLANKS = re.compile(r"[ \t\n\r\f]+")


class Node:
    __slots__ = ("name", "attributes", "children")

    def __init__(self, name: str, attributes: str = ""):
        self.name, self.attributes, self.children = name, attributes, []

    def attribute(self, wanted: str) -> str | None:
        if wanted in self.attributes.lower():
            for match in _ATTRIBUTE.finditer(self.attributes):
                if match[1].lower() == wanted:
                    return html.unescape(next((value for value in match.groups()[1:] if value is not None), ""))
        return None


# -- the tree --------------------------------------------------------------------------------------------------------


class Builder:
    def __init__(self):
        self.root = Node("html")
        self.open = [self.root]
        self.in_head = True
        self.foreign = False  # whether the page has had a formula or drawing

    def _close(self, names: frozenset[str] | set[str], barrier: frozenset[str] | set[str]) -> bool:
        """Close up to the nearest open element of these names, unless a barrier stands before it."""
        for place in range(len(self.open) - 1, 0, -1):
            name = self.open[place].name
            if name in names:
                del self.open[place:]
                return True
            if name in barrier:
                return False
        return False

    def _push(self, node: Node) -> None:
        if len(self.open) >= DEPTH:
            self.open.pop()
        self.open[-1].children.append(node)
        self.open.append(node)

    def text(self, value: str) -> None:
        if self.open[-1].name == "colgroup" and not value.isspace():
            self.open.pop()
        top = self.open[-1]
        if top.name in BETWEEN and not value.isspace():
            self._before_table(value)
        else:
            top.children.append(value)

    def _table_context(self) -> int:
        """The place of the open table, row group or row whose cells have all ended, 0 where there is none."""
        for place in range(len(self.open) - 1, 0, -1):
            name = self.open[place].name
            if name in BETWEEN:
                return place
            if name in ("td", "th", "caption", "template"):
                break
        return 0

    def _foreign(self) -> str | None:
        """The formula or drawing that the next element is a part of."""
        for place in range(len(self.open) - 1, 0, -1):
            name = self.open[place].name
            if name in FOREIGN:
                return name
            if name in HTML_IN_FOREIGN:
                break
        return None

    def _before_table(self, value: str | Node) -> None:
        """What stands between cells belongs in front of the table."""
        for place in range(len(self.open) - 1, 0, -1):
            if self.open[place].name == "table":
                siblings = self.open[place - 1].children
                at = len(siblings) - 1
                while at > 0 and siblings[at] is not self.open[place]:
                    at -= 1
                siblings.insert(at, value)
                return
        self.open[-1].children.append(value)

    def start(self, name: str, attributes: str) -> bool:
        """Whether the element stays open."""
        if name in ("html", "body", "head"):
            if name == "head" and self.in_head:
                self._push(Node("head"))
            elif name == "body":
                self._leave_head()
            return True
        if self.in_head and name not in HEAD:
            self._leave_head()
        if name in IN_TABLE and (place := self._table_context()):
            del self.open[place + 1 :]
        elif name == "table" and self._table_context():
            self.end("table")
        elif self.open[-1].name == "colgroup" and name != "template":
            self.open.pop()
        if name in CLOSES_P:
            self._close({"p"}, SCOPE)
        if name == "li":
            self._close({"li"}, LISTS | SCOPE)
        elif name in ("dt", "dd"):
            self._close({"dt", "dd"}, {"dl"} | SCOPE)
        elif name in ("option", "optgroup"):
            self._close({"option"} if name == "option" else {"option", "optgroup"}, {"select", "datalist"} | SCOPE)
        elif name in ROWS:
            self._close(ROWS | {"caption"}, {"table"})
        elif name == "tr":
            self._close({"tr", "caption"}, ROWS | {"table"})
        elif name in ("td", "th"):
            self._close({"td", "th"}, {"tr", "table"})
            if self.open[-1].name in ROWS | {"table"}:
                self._push(Node("tr"))
        elif name in ("h1", "h2", "h3", "h4", "h5", "h6") and re.fullmatch("h[1-6]", self.open[-1].name):
            self.open.pop()
        elif name == "a":
            self._close({"a"}, SCOPE | BLOCK)
        node = Node(name, attributes)
        foreign = self._foreign() if self.foreign else None
        self.foreign = self.foreign or name in FOREIGN
        if foreign and name in FOREIGN[foreign]:
            node.attributes += " hidden"
        closed = name in VOID or (attributes.endswith("/") and (foreign is not None or name in FOREIGN))
        if self.open[-1].name in BETWEEN and name not in IN_TABLE | {"script", "style", "template"}:
            if name == "form":  # the standard leaves it empty
                closed = True
            self._before_table(node)
            if not closed:
                if len(self.open) >= DEPTH:
                    self.open.pop()
                self.open.append(node)
        elif closed:
            self.open[-1].children.append(node)
        else:
            self._push(node)
        return not closed

    def _leave_head(self) -> None:
        self._close({"head"}, frozenset())
        self.in_head = False

    def end(self, name: str) -> None:
        if name == "br":
            self.start("br", "")
        elif name == "p":
            if not self._close({"p"}, SCOPE):
                self.open[-1].children.append(Node("p"))
        elif name == "head":
            self._leave_head()
        elif re.fullmatch("h[1-6]", name):
            self._close({"h1", "h2", "h3", "h4", "h5", "h6"}, SCOPE)
        elif name == "li":
            self._close({"li"}, LISTS | SCOPE)
        elif name == "table":
            self._close({"table"}, frozenset())
        elif name in ("tr", "td", "th", *ROWS):
            self._close({name}, {"table"})
        elif name not in ("html", "body"):
            self._close({name}, SCOPE - {name})


class Tags:
    """Finds the ends of tags, in time linear in the page.

    A ``>`` between quotes does not end a tag. Where a quote of the tag never ends, its next ``>`` does; the quotes on such
    a way are remembered, for every later tag that comes to one of them has the same rest of the way.
    """

    def __init__(self, source: str):
        self.source, self.lost = source, set()

    def end(self, at: int) -> int:
        """The place of the sign that ends the tag, or the end of the page."""
        source, start, way = self.source, at, []
        while match := _STOP.search(source, at):
            if match[0] == ">":
                return match.start()
            way.append(match.start())
            close = -1 if match.start() in self.lost else source.find(match[0], match.end())
            if close < 0:
                self.lost.update(way)
                first = source.find(">", start)
                return first if first >= 0 else len(source)
            at = close + 1
        return len(source)


def tree(source: str) -> Node:
    """The element tree of a page."""
    builder, at, size, tags = Builder(), 0, len(source), Tags(source)
    while at < size:
        less = source.find("<", at)
        if less < 0:
            less = size
        if less > at:
            value = source[at:less]
            if builder.in_head and not value.isspace() and builder.open[-1].name in ("html", "head"):
                builder._leave_head()
            builder.text(html.unescape(value) if "&" in value else value)
        if less == size:
            break
        if match := _SKIPPED.match(source, less):
            at = match.end()
            continue
        match = _TAG.match(source, less)
        if match is None:  # a lone sign
            builder.text("<")
            at = less + 1
            continue
        stop = tags.end(match.end())
        at = min(stop + 1, size)
        name = match[2].lower()
        if match[1]:
            builder.end(name)
            continue
        if builder.start(name, source[match.end() : stop]) and name in RAW:
            close = re.compile(rf"</{re.escape(name)}(?=[\s/>])", re.IGNORECASE).search(source, at)
            stop = close.start() if close else size
            value = source[at:stop]
            builder.text(html.unescape(value) if name in ("textarea", "title") else value)
            builder.end(name)
            at = size if close is None else max(source.find(">", stop) + 1, stop + 1)
    return builder.root


# -- rendering -------------------------------------------------------------------------------------------------------


class Page:
    """Lines of a box. ``gap`` is how many line ends have to stand before the next text."""

    def __init__(self):
        self.lines: list[str] = []
        self.line: list[str] = []
        self.gap, self.space = 0, False

    def apart(self, lines: int) -> None:
        if self.line:
            self.lines.append("".join(self.line))
            self.line = []
        if self.lines:
            self.gap = max(self.gap, lines)
        self.space = False

    def _settle(self) -> None:
        if self.gap:
            self.lines += [""] * (self.gap - 1)
            self.gap = 0

    def words(self, value: str) -> None:
        value = _BLANKS.sub(" ", value)
        if not value:
            return
        text = value.strip(" ")
        if not text:
            self.space = self.space or bool(self.line)
            return
        self._settle()
        if self.line and (self.space or value[0] == " "):
            self.line.append(" ")
        self.line.append(text)
        self.space = value[-1] == " "

    def new_line(self) -> None:
        self._settle()
        self.lines.append("".join(self.line))
        self.line, self.space = [], False

    def exact(self, value: str) -> None:
        self._settle()
        first, *more = value.split("\n")
        self.line.append(first)
        for part in more:
            self.lines.append("".join(self.line))
            self.line = [part]
        self.space = False

    def box(self, lines: list[str], first: str, rest: str) -> None:
        """Lines of an inner box behind a prefix."""
        if not lines and not first.strip():
            return
        self.apart(1)
        self._settle()
        lines = lines or [""]
        self.lines.append((first + lines[0]).rstrip())
        self.lines += [(rest + line).rstrip() for line in lines[1:]]

    def done(self) -> list[str]:
        self.apart(0)
        lines = [line.rstrip(" ") for line in self.lines]
        while lines and not lines[-1]:
            lines.pop()
        while lines and not lines[0]:
            lines.pop(0)
        return lines


def seen(node: Node, visible: bool) -> bool | None:
    """Whether the element's text shows; None where nothing below it can show."""
    if node.name in UNSEEN or (node.name == "input" and (node.attribute("type") or "").lower() == "hidden"):
        return None
    if node.name == "dialog" and node.attribute("open") is None:
        return None
    if not node.attributes:
        return visible
    if node.attribute("hidden") is not None:
        return None
    style = (node.attribute("style") or "").lower().replace(" ", "")
    if "display:none" in style:
        return None
    if "visibility:hidden" in style or "visibility:collapse" in style:
        return False
    return True if "visibility:visible" in style else visible


def render(node: Node, page: Page, visible: bool = True, exact: bool = False) -> None:
    for child in node.children:
        if node.name in PARTS:  # parts of a formula stand apart
            page.words(" ")
        if isinstance(child, str):
            if visible:
                page.exact(child) if exact else page.words(child)
            continue
        shows = seen(child, visible)
        if shows is None:
            continue
        name = child.name
        if name == "br":
            page.new_line()
        elif name == "hr":
            page.apart(2)
        elif name == "wbr" or name in VOID:
            if name == "input" and shows and (value := child.attribute("value")):
                page.words(value)
        elif name == "table":
            page.apart(2)
            for line in table_lines(child, shows):
                page.box([line], "", "")
            page.apart(2)
        elif name in LISTS:
            nested = node.name == "li"
            page.apart(1 if nested else 2)
            list_items(child, page, shows)
            page.apart(1 if nested else 2)
        elif name == "details" and child.attribute("open") is None:
            summary = Node("details")
            summary.children = [c for c in child.children if isinstance(c, Node) and c.name == "summary"][:1]
            page.apart(1)
            render(summary, page, shows, exact)
            page.apart(1)
        elif name in ("blockquote", "dd"):
            inner = Page()
            render(child, inner, shows, exact)
            page.apart(2 if name == "blockquote" else 1)
            page.box(inner.done(), "  ", "  ")
            page.apart(2 if name == "blockquote" else 1)
        elif name == "li":
            one = Node("ul")
            one.children = [child]
            list_items(one, page, shows)
        elif name in BLOCK or name in ("td", "th", "tr", *ROWS, "text", "foreignobject", "mtr"):
            lines = 2 if name in APART else 1
            page.apart(lines)
            if name == "pre" and child.children and isinstance(child.children[0], str):
                child.children[0] = child.children[0].removeprefix("\n")
            render(child, page, shows, exact or name in ("pre", "xmp", "textarea"))
            page.apart(lines)
        else:
            render(child, page, shows, exact or name == "textarea")


def list_items(node: Node, page: Page, visible: bool) -> None:
    """Bullets or numbers in front, further lines below the text."""
    ordered, number = node.name == "ol", 1
    if ordered and (start := node.attribute("start")) and re.fullmatch(r"-?\d{1,9}", start.strip()):
        number = int(start)
    for child in node.children:
        if isinstance(child, str):
            if visible and not child.isspace():
                page.apart(1)
                page.words(child)
            continue
        shows = seen(child, visible)
        if shows is None:
            continue
        inner = Page()
        if child.name != "li":
            holder = Node("li")
            holder.children = [child]
            render(holder, inner, shows)
            page.box(inner.done(), "  ", "  ")
            continue
        if ordered and (value := child.attribute("value")) and re.fullmatch(r"-?\d{1,9}", value.strip()):
            number = int(value)
        render(child, inner, shows)
        mark = f"{number}. " if ordered else "- "
        number += 1
        if lines := inner.done():
            page.box(lines, mark, " " * len(mark))


def _span(cell: Node, name: str, most: int) -> int:
    """How many columns or rows a cell fills: at least one, at most what the standard allows."""
    digits = re.match(r"\s*\+?(\d+)", cell.attribute(name) or "")
    return max(1, min(int(digits[1][:9]), most)) if digits else 1


def table_lines(node: Node, visible: bool) -> list[str]:
    """A caption, then rows with their cells padded to the columns' widths."""
    lines: list[str] = []
    rows: list[list[tuple[int, int, list[str]]]] = []
    above: list[tuple[int, int, int]] = []  # columns from, to, and the row until which cells from above fill them
    number = 0

    def row(element: Node, shows: bool) -> None:
        nonlocal number
        cells, column, filled = [], 0, iter(above)
        next_filled, added = next(filled, None), []
        for cell in element.children:
            if isinstance(cell, str) or (own := seen(cell, shows)) is None:
                continue
            while next_filled and next_filled[0] <= column:
                column, next_filled = max(column, next_filled[1]), next(filled, None)
            wide, high = (_span(cell, name, most) for name, most in (("colspan", 1000), ("rowspan", 65534)))
            inner = Page()
            holder = cell
            if cell.name not in ("td", "th"):
                holder = Node("td")
                holder.children = [cell]
            render(holder, inner, own)
            cells.append((column, wide, inner.done()))
            added.append((column, column + wide, number + high))
            column += wide
        number += 1
        left = sorted(place for place in [*above, *added] if place[2] > number)
        above.clear()
        for place in left:  # neighbours that end in one row are one
            if above and above[-1][1] == place[0] and above[-1][2] == place[2]:
                place = (above.pop()[0], *place[1:])
            above.append(place)
        if any(text for _, _, text in cells):
            rows.append(cells)

    def walk(element: Node, shows: bool) -> None:
        for child in element.children:
            if isinstance(child, str) or (own := seen(child, shows)) is None:
                continue
            if child.name == "tr":
                row(child, own)
            elif child.name in ROWS:
                walk(child, own)
                above.clear()
            elif child.name == "caption":
                inner = Page()
                render(child, inner, own)
                lines.extend(inner.done())
            else:  # of a page deeper than DEPTH
                alone = Node("tr")
                alone.children = [child]
                row(alone, shows)

    walk(node, visible)
    widths: dict[int, int] = {}
    for cells in rows:
        for column, wide, text in cells:
            if wide == 1:
                widths[column] = max(widths.get(column, 0), *(len(line) for line in text), 0) if text else widths.get(column, 0)
    shown = sorted(column for column, width in widths.items() if width)
    edges = [0, *accumulate(widths[column] + 2 for column in shown)]  # columns without text take no room
    for cells in rows:
        for height in range(max(len(text) for _, _, text in cells)):
            out, at = [], 0
            for column, _, text in cells:
                if height < len(text):
                    gap = edges[bisect_left(shown, column)] - at
                    gap = gap if gap > 1 or not at else 2  # behind a cell that is wider than its columns
                    out += [" " * gap, text[height]]
                    at += gap + len(text[height])
            lines.append("".join(out).rstrip())
    return lines


def to_text(source: str) -> str:
    """The visible text of a page."""
    page = Page()
    render(tree(source), page)
    return "\n".join(page.done())


def text_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(page_id, html) to (page_id, text, n_lines)."""
    for batch in batches:
        texts = [None if value.as_py() is None else to_text(value.as_py()) for value in batch.column(1)]
        lines = [None if text is None else text.count("\n") + bool(text) for text in texts]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(texts, pa.string()), pa.array(lines, pa.int64())], ["page_id", "text", "n_lines"]
        )


def extract(pages: DataFrame) -> DataFrame:
    """page_id, text, n_lines."""
    prepare(pages.sparkSession)
    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.col("html").cast("string").alias("html"))
    return rows.mapInArrow(text_rows, "page_id bigint, text string, n_lines bigint")
