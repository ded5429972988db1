"""Layout-aware text of web pages.

A page is read into a tree (missing end tags are implied as browsers do) and
the tree is rendered as plain text: everything a reader would see, in order.
Blocks are set apart by line breaks, paragraphs and headings by blank lines;
list items carry marks and are indented by depth; the cells of a table are
aligned in columns, spans over columns and rows included; preformatted text
keeps its blanks. Not visible, and left out: the head, scripts, styles,
templates, comments, embedded media, closed dialogs, what a closed
``details`` holds beside its summary, the brackets of ruby text, and elements
that an attribute or inline style takes out (``display``). ``visibility`` is
inherited: text is left out below a hidden element until a descendant is made
visible. Of drawings (SVG) the text elements are read, of formulas (MathML)
all but annotations, of form fields the labels of buttons.

Each page is rendered on its own inside a map over Arrow batches: no shuffle,
and memory of one batch. Reading is linear in the page: of every element name
the open ones are known by place, so no tag walks the nesting.

Defined results: null or empty pages give the empty text; damaged markup is
read as far as it goes and never fails; pages of any length and nesting are
read whole and without recursion, but for tables in tables, which keep their
columns ``DEEP`` levels down and are plain blocks below; columns are aligned
up to ``WIDEST`` characters, and wider cells push their row on; an empty table
of pages gives an empty result; repeated rows are rendered each; other columns
pass, one called like the result is replaced.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from html.parser import HTMLParser
from itertools import accumulate

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Element names of the HTML standard by their default rendering.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
UNSEEN = frozenset(
    "head script style template noscript title meta link base iframe object embed canvas audio video "
    "datalist colgroup col area param source track rp".split()
)
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre ul ol dl table figure".split())
BLOCKS = SPACED | frozenset(
    "address article aside body caption center dd details dialog dir div dt fieldset figcaption footer form header "
    "hgroup hr html legend li main menu nav option optgroup search section summary tbody td tfoot th thead tr".split()
)
# a start tag (left) ends an open element (right), unless one of the bounds is nearer
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th", "caption", "colgroup"}, {"table"}),
    "td": ({"td", "th", "caption", "colgroup"}, {"tr", "table"}),
    "th": ({"td", "th", "caption", "colgroup"}, {"tr", "table"}),
    "caption": ({"caption", "colgroup"}, {"table"}),
    "colgroup": ({"caption", "colgroup"}, {"table"}),
    "thead": ({"thead", "tbody", "tfoot", "tr", "td", "th", "caption", "colgroup"}, {"table"}),
    "tbody": ({"thead", "tbody", "tfoot", "tr", "td", "th", "caption", "colgroup"}, {"table"}),
    "tfoot": ({"thead", "tbody", "tfoot", "tr", "td", "th", "caption", "colgroup"}, {"table"}),
    "option": ({"option"}, {"select", "datalist"}),
    "optgroup": ({"option", "optgroup"}, {"select"}),
    "body": ({"head"}, set()),
}
# an open paragraph ends at these, but not across the bounds
ENDS_P = SPACED | frozenset(
    "address article aside center details dialog dir div fieldset figcaption footer form header hgroup hr main menu "
    "nav search section summary".split()
)
P_BOUNDS = frozenset("table td th caption button object".split())
SCOPES = frozenset("table td th caption html body".split())  # end tags of inline elements stop here

# SVG and MathML: what is not drawn, where HTML goes on inside, and HTML elements that end it
FOREIGN_UNSEEN = frozenset(
    "annotation annotation-xml defs desc metadata symbol clippath mask pattern marker lineargradient radialgradient "
    "filter".split()
)
FOREIGN_HTML = frozenset("foreignobject desc title mi mo mn ms mtext annotation-xml".split())
ENDS_FOREIGN = frozenset(
    "b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li listing menu meta "
    "nobr ol p pre ruby s small span strong strike sub sup table tt u ul var".split()
)
# MathML elements whose children stand apart
APART = frozenset("mfrac mroot msub msup msubsup munder mover munderover mmultiscripts mtable mtr".split())

_STYLE = re.compile(r"(?:^|;)\s*(display|visibility)\s*:\s*([a-z-]+)", re.I)
_SPACES = re.compile(r"[ \t\n\r\f]+")
DEEP = 100
WIDEST = 60
_MOST_COLUMNS, _MOST_ROWS = 1000, 65534  # of one cell, as in the HTML standard
_GAP = "  "


class _Node:
    """``shown``: not taken out; ``visible``: its own visibility, None if inherited."""

    __slots__ = ("tag", "shown", "visible", "items", "span", "rows", "start", "closed")

    def __init__(self, tag: str, attrs: dict[str, str | None]):
        self.tag = tag
        style = {k.lower(): v.lower() for k, v in _STYLE.findall(attrs.get("style") or "")}
        self.shown = not (
            tag in UNSEEN
            or style.get("display", "none" if "hidden" in attrs else "") == "none"
            or (tag == "input" and (attrs.get("type") or "").lower() == "hidden")
            or (tag == "dialog" and "open" not in attrs)
        )
        self.visible = {"visible": True, "hidden": False, "collapse": False}.get(style.get("visibility", ""))
        self.closed = tag == "details" and "open" not in attrs
        self.items: list[_Node | str] = []
        if tag == "input" and (attrs.get("type") or "").lower() in ("submit", "button", "reset") and attrs.get("value"):
            self.items.append(f" {attrs['value']} ")
        self.span = self.rows = 1
        if tag in ("td", "th"):
            self.span = _number(attrs.get("colspan"), 1, 1, _MOST_COLUMNS)
            self.rows = _number(attrs.get("rowspan"), 1, 0, _MOST_ROWS) or _MOST_ROWS  # 0: to the end
        self.start = _number(attrs.get("start"), 1, -(10**9), 10**9) if tag == "ol" else 1


def _number(value: str | None, default: int, low: int, high: int) -> int:
    if value and re.fullmatch(r"\s*[+-]?\d{1,9}\s*", value):
        return min(max(int(value), low), high)
    return default


class _Builder(HTMLParser):
    """Start tags, end tags and text to a tree."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = _Node("#root", {})
        self.open = [self.root]
        self.places: dict[str, list[int]] = {}  # of each name, the indices of its open elements
        self.foreign: list[int] = []  # indices of open svg and math elements

    def _push(self, node: _Node) -> None:
        self.places.setdefault(node.tag, []).append(len(self.open))
        self.open.append(node)

    def _end(self, index: int) -> None:
        for node in self.open[index:]:
            self.places[node.tag].pop()
        del self.open[index:]
        while self.foreign and self.foreign[-1] >= index:
            self.foreign.pop()

    def _last(self, names) -> int:
        """Index of the innermost open element of ``names``, 0 if there is none."""
        return max((at[-1] for n in names if (at := self.places.get(n))), default=0)

    def _in_foreign(self) -> bool:
        return bool(self.foreign) and self._last(FOREIGN_HTML) < self.foreign[-1]

    def _nearest(self, names, bounds) -> int:
        """Index of the innermost open element of ``names``, 0 if a bound is nearer."""
        i = self._last(names)
        return i if i and i >= self._last(bounds) else 0

    def _start_foreign(self, tag, attrs, closed: bool) -> None:
        node = _Node(tag, attrs)
        if tag in FOREIGN_UNSEEN or attrs.get("display") == "none":
            node.shown = False
        if node.visible is None:
            node.visible = {"visible": True, "hidden": False, "collapse": False}.get(attrs.get("visibility") or "")
        self.open[-1].items.append(node)
        if not closed:
            if tag in ("svg", "math"):
                self.foreign.append(len(self.open))
            self._push(node)

    def handle_starttag(self, tag, attrs, closed=False):
        if self._in_foreign():
            if tag not in ENDS_FOREIGN:
                self._start_foreign(tag, dict(attrs), closed)
                return
            while self._in_foreign():
                self._end(self.foreign[-1])
        if tag in ENDS_P and (i := self._nearest({"p"}, P_BOUNDS)):
            self._end(i)
        if tag in CLOSES:
            names, bounds = CLOSES[tag]
            while i := self._nearest(names, bounds):
                self._end(i)
        elif tag not in UNSEEN and self.open[-1].tag == "head":
            self._end(len(self.open) - 1)  # content begins: the head is over
        if self.open[-1].tag == "colgroup" and tag not in ("col", "template"):
            self._end(len(self.open) - 1)  # it holds nothing else
        if tag in ("svg", "math"):
            self._start_foreign(tag, dict(attrs), closed)
            return
        node = _Node(tag, dict(attrs))
        self.open[-1].items.append(node)
        if tag not in VOID:
            self._push(node)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs, True)  # as browsers do, a slash closes void, SVG and MathML elements only

    def handle_endtag(self, tag):
        if tag == "br":
            self.handle_starttag("br", [])
            return
        bounds = () if tag in SCOPES else ({"table"} if tag in BLOCKS else SCOPES)
        if i := self._nearest({tag}, bounds):
            self._end(i)

    def handle_data(self, data):
        if self.open[-1].tag in ("head", "colgroup") and data.strip():
            self._end(len(self.open) - 1)
        self.open[-1].items.append(data)


class _Text:
    """Lines of rendered text."""

    def __init__(self):
        self.lines: list[str] = []
        self.line: list[str] = []
        self.blank = False  # a blank line is due before the next text
        self.indent: list[str] = []
        self.mark = ""
        self.space = False

    def inline(self, text: str) -> None:
        body = _SPACES.sub(" ", text.replace("\xa0", " "))
        bare = body.strip(" ")
        if not bare:
            self.space |= bool(body) and bool(self.line)
            return
        if self.line and (self.space or body[0] == " "):
            self.line.append(" ")
        self.line.append(bare)
        self.space = body[-1] == " "

    def preformatted(self, text: str) -> None:
        first, *rest = text.replace("\r\n", "\n").replace("\xa0", " ").split("\n")
        if first:
            self.line.append(first)
        for part in rest:
            self.end_line(keep=True)
            if part:
                self.line.append(part)

    def end_line(self, keep: bool = False) -> None:
        text = "".join(self.line).rstrip()
        self.line, self.space = [], False
        if not text.strip():
            if not (keep and self.lines and self.lines[-1]):
                return
            text = ""
        if text and self.blank and self.lines and self.lines[-1]:
            self.lines.append("")
        if text:
            self.blank = False
        lead = "".join(self.indent)
        if self.mark and text:
            lead = lead[: max(0, len(lead) - len(self.mark))] + self.mark
            self.mark = ""
        self.lines.append((lead + text).rstrip())

    def block(self, spaced: bool) -> None:
        self.end_line()
        self.blank |= spaced

    def text(self) -> str:
        self.end_line()
        return "\n".join(self.lines).strip("\n")


def _laid_out(rows: list[list[tuple[list[str], int, int]]]) -> list[list[tuple[int, list[str], int]]]:
    """Cells (lines, columns, rows) as (first column, lines, columns): a cell
    takes the next place that no cell from a row above still holds."""
    out, held = [], []  # held: (first column, column after, rows left) by column
    for cells in rows:
        placed, column, k = [], 0, 0
        for lines, span, down in cells:
            while k < len(held) and held[k][0] <= column:
                column = max(column, held[k][1])
                k += 1
            placed.append((column, lines, span, down))
            column += span
        out.append([p[:3] for p in placed])
        still = [(a, b, left - 1) for a, b, left in held if left > 1]
        more = [(c, c + span, down - 1) for c, _, span, down in placed if down > 1]
        held = sorted(still + more) if more else still
    return out


def _aligned(rows: list[list[tuple[int, list[str], int]]]) -> list[str]:
    """The lines of laid-out rows, columns as wide as their widest own cell."""
    widths: dict[int, int] = {}
    for cells in rows:
        for column, lines, span in cells:
            if span == 1:
                widths[column] = min(WIDEST, max(widths.get(column, 0), max(map(len, lines))))
    columns = sorted(widths)
    starts = [0, *accumulate(widths[c] + len(_GAP) for c in columns)]
    out = []
    for cells in rows:
        for k in range(max((len(lines) for _, lines, _ in cells), default=0)):
            row = ""
            for column, lines, _ in cells:
                if k < len(lines) and lines[k]:
                    if due := starts[bisect_left(columns, column)]:
                        row = row.ljust(due)
                    if row and not row.endswith(_GAP):
                        row += _GAP
                    row += lines[k]
            out.append(row.rstrip())
    return out


def _table(table: _Node, depth: int, visible: bool) -> list[str]:
    """The rows of a table (with its caption first), cells aligned in columns."""
    rows: list[list[tuple[list[str], int, int]]] = []
    before: list[str] = []
    todo: list[tuple[_Node | str, bool]] = [(x, visible) for x in reversed(table.items)]
    loose = _Node("div", {})  # text and elements between the cells: shown before the table, as browsers do

    def aside(item: _Node | str, seen: bool) -> None:
        holder = _Node("#part", {})
        holder.visible, holder.items = seen, [item]
        loose.items.append(holder)

    def cell_of(cell: _Node, seen: bool) -> tuple[list[str], int, int]:
        own = seen if cell.visible is None else cell.visible
        return _render(cell, depth + 1, own).split("\n"), cell.span, cell.rows

    while todo:
        item, seen = todo.pop()
        if isinstance(item, str):
            if item.strip():
                aside(item, seen)
            continue
        if not item.shown:
            continue
        own = seen if item.visible is None else item.visible
        if item.tag in ("thead", "tbody", "tfoot"):
            todo.extend((x, own) for x in reversed(item.items))
        elif item.tag == "caption":
            before += _render(item, depth + 1, own).split("\n")
        elif item.tag == "tr":
            cells = []
            for cell in item.items:
                if isinstance(cell, _Node) and cell.shown and cell.tag in ("td", "th"):
                    cells.append(cell_of(cell, own))
                elif isinstance(cell, _Node) and cell.shown or isinstance(cell, str) and cell.strip():
                    aside(cell, own)
            rows.append(cells)
        elif item.tag in ("td", "th"):  # a cell without a row
            rows.append([cell_of(item, seen)])
        else:
            aside(item, seen)
    if loose.items:
        before += _render(loose, depth + 1, visible).split("\n")
    return [x for x in before if x] + _aligned(_laid_out(rows))


def _drawn(svg: _Node) -> list[_Node | str]:
    """The text elements of a drawing, set apart, and the HTML inside it."""
    out: list[_Node | str] = [" "]
    todo = [(x, None) for x in reversed(svg.items)]
    while todo:
        item, above = todo.pop()
        if isinstance(item, str) or not item.shown:
            continue
        if item.visible is None:
            item.visible = above  # what stands between is not walked again
        if item.tag in ("text", "foreignobject"):
            out += [item, " "]
        else:
            todo.extend((x, item.visible) for x in reversed(item.items))
    return out


def _render(root: _Node, depth: int = 0, visible: bool = True) -> str:
    """The visible text below ``root``, walked with a stack of steps."""
    out = _Text()
    pre = 0
    seen = [visible]  # of the open elements
    lists: list[list] = []  # open lists: [ordered, next number]
    todo: list[tuple[str, object]] = [("in", x) for x in reversed(root.items)]
    while todo:
        step, item = todo.pop()
        if isinstance(item, str):
            if seen[-1]:
                (out.preformatted if pre else out.inline)(item)
            continue
        tag = item.tag
        if step == "out":
            seen.pop()
            if tag in BLOCKS:
                out.block(tag in SPACED and not (tag in ("ul", "ol", "dl") and len(lists) > 1))
            if tag == "pre":
                pre -= 1
            elif tag in ("ul", "ol", "menu", "dir"):
                lists.pop()
            elif tag in ("li", "blockquote", "dd") and out.indent:
                out.indent.pop()
                out.mark = ""
            continue
        if not item.shown:
            continue
        if tag == "br":
            out.end_line(keep=True)
            continue
        if tag == "img":
            continue
        if tag in BLOCKS:
            out.block(tag in SPACED and not (tag in ("ul", "ol", "dl") and lists))
        own = seen[-1] if item.visible is None else item.visible
        if tag == "table" and depth < DEEP:
            for line in _table(item, depth, own):
                out.line = [line]
                out.end_line(keep=True)
            out.block(True)
            continue
        if tag == "pre":
            pre += 1
        elif tag in ("ul", "ol", "menu", "dir"):
            lists.append([tag == "ol", item.start])
        elif tag == "li":
            mark = "- "
            if lists and lists[-1][0]:
                mark = f"{lists[-1][1]}. "
                lists[-1][1] += 1
            out.indent.append(" " * len(mark))
            out.mark = mark if own else ""
        elif tag in ("blockquote", "dd"):
            out.indent.append("  ")
        elif tag in ("td", "th"):
            out.inline(" ")
        items = _drawn(item) if tag == "svg" else item.items
        if tag in APART:
            items = [y for x in items for y in (" ", x)]
        elif item.closed:
            items = [x for x in items if isinstance(x, _Node) and x.tag == "summary"][:1]
        seen.append(own)
        todo.append(("out", item))
        todo.extend(("in", x) for x in reversed(items))
    return out.text()


def page_text(html: str | None) -> str:
    """The visible text of one page."""
    if not html:
        return ""
    builder = _Builder()
    builder.feed(html)
    builder.close()
    return _render(builder.root)


def extract_text(df: DataFrame, html: str = "html", into: str = "text") -> DataFrame:
    """``df`` with ``into``: the visible text of ``html``."""

    @F.pandas_udf(T.StringType())
    def render(pages: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in pages:
            yield batch.map(page_text, na_action=None).astype(object)

    return df.withColumn(into, render(F.col(f"`{html}`").cast("string")))


def op8_html_text(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return extract_text(pages.select("page_id", "url", "html")).select("page_id", "url", "text")


QUERIES = {"op8_html_text": op8_html_text}
ORACLE = {}
