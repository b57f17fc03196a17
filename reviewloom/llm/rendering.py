"""Visible text of web pages as laid out: blocks on lines of their own, lists with markers, tables with aligned cells."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .markup import BLOCK, NOTES, SPACED, UNDRAWN, UNSEEN, Node, Sheet, build
from .tables import map_arrow, slices

_RUN = re.compile(r"[ \t\n\f\r]+")
#: Tables in tables that are laid out as such; deeper ones become plain blocks, with all their text.
DEEPEST = 20
_GAP = "  "


def width(line: str) -> int:
    """Columns that a line takes: wide characters two, marks none."""
    if line.isascii():
        return len(line)
    return sum(0 if unicodedata.combining(c) else 2 if unicodedata.east_asian_width(c) in "WF" else 1 for c in line)


class _Page:
    """Lines under construction."""

    def __init__(self) -> None:
        self.lines: list[str] = []
        self.line: list[str] = []
        self.space = False  # collapsed white space not written yet
        self.gap = False  # an empty line is due before the next text
        self.indents: list[list[str]] = []  # [first line's, further lines']

    def _put(self, text: str) -> None:
        if self.space and self.line:
            self.line.append(" ")
        self.space = False
        self.line.append(text)

    def text(self, data: str, kept: bool) -> None:
        if kept:
            first, *rest = data.replace("\r\n", "\n").split("\n")
            if first:
                self._put(first)
            for line in rest:
                self.feed(True)
                if line:
                    self._put(line)
            return
        if not data:
            return
        words = _RUN.sub(" ", data)
        if words[0] == " ":
            self.space = True
        if bare := words.strip(" "):
            self._put(bare)
            self.space = words[-1] == " "

    def feed(self, always: bool = False) -> None:
        """End the line; an empty one counts only if ``always``."""
        text = "".join(self.line).rstrip(" ")
        self.line.clear()
        self.space = False
        if not text and not always:
            return
        if text:
            if self.gap and self.lines:
                self.lines.append("")
            self.gap = False
            text = "".join(first for first, _ in self.indents) + text
            for indent in self.indents:
                indent[0] = indent[1]
        self.lines.append(text)

    def block(self, spaced: bool) -> None:
        self.feed()
        self.gap |= spaced

    def done(self) -> list[str]:
        self.feed()
        while self.lines and not self.lines[-1]:
            self.lines.pop()
        return self.lines


def _number(value: str | None, default: int, least: int = -(1 << 31), most: int = 1 << 31) -> int:
    match = re.match(r"\s*([+-]?\d{1,9})", value or "")
    return min(most, max(least, int(match[1]))) if match else default


def _list_depth(node: Node) -> int:
    return sum(1 for _ in _above(node, ("ul", "ol", "menu", "dir")))


def _above(node: Node, tags) -> Iterator[Node]:
    at = node.parent
    while at is not None:
        if at.tag in tags:
            yield at
        at = at.parent


class _Renderer:
    def __init__(self, sheet: Sheet) -> None:
        self.sheet = sheet
        self.numbers: dict[int, int] = {}  # next number per ordered list

    def _marker(self, node: Node) -> str:
        parent = node.parent
        if parent is not None and parent.tag == "ol":
            step = -1 if "reversed" in parent.attributes else 1
            items = sum(1 for c in parent.children if isinstance(c, Node) and c.tag == "li") if step < 0 else 1
            start = self.numbers.get(id(parent), _number(parent.attributes.get("start"), items))
            number = _number(node.attributes.get("value"), start)
            self.numbers[id(parent)] = number + step
            return f"{number}. "
        return "- "

    def lines(self, top: Node, hidden: bool, kept: bool, tables: int) -> list[str]:
        """Rendered children of ``top``; hidden and kept (white space) are inherited."""
        page = _Page()
        # The last is "svg" in a drawing, "text" in its text, "math" in a formula.
        stack: list[tuple] = [(top, iter(top.children), hidden, kept, None, "")]
        while stack:
            node, children, hidden, kept, leave, inside = stack[-1]
            child = next(children, None)
            if child is None:
                stack.pop()
                if leave == "word":
                    page.space = True
                elif leave:
                    page.block(leave == "spaced")
                    if node.tag in ("li", "dd", "blockquote"):
                        page.indents.pop()
                continue
            if isinstance(child, str):
                if not hidden and inside != "svg":
                    page.text(child, kept)
                continue
            tag = child.tag
            if tag in UNSEEN or tag == "dialog" and "open" not in child.attributes:
                continue
            if inside and tag in (NOTES if inside == "math" else UNDRAWN):
                continue
            style = self.sheet.style(child)
            if inside in ("svg", "text"):
                style = {n: child.attributes[n].strip().lower() for n in ("display", "visibility") if n in child.attributes} | style
            if style.get("display") == "none":
                continue
            unseen = hidden
            if (seen := style.get("visibility")) in ("hidden", "collapse", "visible"):
                unseen = seen != "visible"
            if tag == "br":
                page.feed(not hidden and not page.line and bool(page.lines))
                continue
            if tag == "input":
                kind = child.attributes.get("type", "text").lower()
                if not unseen and kind not in ("hidden", "password", "checkbox", "radio", "file", "image", "color", "range"):
                    page.text(child.attributes.get("value", ""), False)
                continue
            white = style.get("white-space", "pre" if tag in ("pre", "textarea", "xmp") else "")
            spaces = white.startswith("pre") if white else kept
            display = style.get("display", "")
            if tag == "table" and tables < DEEPEST:
                page.block(True)
                for line in self._table(child, unseen, spaces, tables):
                    page.line.append(line)
                    page.feed(True)
                page.block(True)
                continue
            as_block = (tag in BLOCK or tag in ("tr", "thead", "tbody", "tfoot") or display in ("block", "flex", "grid", "list-item", "table")) and not display.startswith("inline")
            within = iter(child.children)
            if tag == "details" and "open" not in child.attributes:
                first = next((c for c in child.children if isinstance(c, Node) and c.tag == "summary"), None)
                within = iter([first] if first is not None else [])
            leave = None
            if as_block:
                # A list in a list follows its item without an empty line.
                spaced = tag in SPACED and not (tag in ("ul", "ol", "menu", "dir") and _list_depth(child))
                leave = "spaced" if spaced else "block"
                page.block(spaced)
                if tag == "li":
                    marker = self._marker(child)
                    page.indents.append([marker, " " * len(marker)])
                elif tag in ("dd", "blockquote"):
                    page.indents.append([_GAP, _GAP])
            elif tag in ("td", "th") or inside == "math" and (tag == "mtd" or node.tag == "mfrac"):
                page.space = True
            elif inside == "svg" and tag in ("text", "foreignobject") or inside == "text" and not child.attributes.keys().isdisjoint(("x", "y", "dy")):
                leave, page.space = "word", True
            if tag in ("pre", "textarea") and child.children and isinstance(child.children[0], str) and child.children[0].startswith("\n"):
                child.children[0] = child.children[0][1:]
            if tag in ("svg", "math"):
                inside = tag
            elif inside in ("svg", "text") and tag in ("text", "foreignobject"):
                inside = "text" if tag == "text" else ""
            stack.append((child, within, unseen, spaces, leave, inside))
        return page.done()

    def _rows(self, table: Node) -> tuple[list[Node], list[Node]]:
        """Captions, and rows in the order shown: head, bodies, foot."""
        captions, head, body, foot = [], [], [], []
        for child in table.children:
            if not isinstance(child, Node) or self.sheet.style(child).get("display") == "none":
                continue
            if child.tag == "caption":
                captions.append(child)
            elif child.tag == "tr":
                body.append(child)
            elif child.tag in ("thead", "tbody", "tfoot"):
                rows = [r for r in child.children if isinstance(r, Node) and r.tag == "tr"]
                {"thead": head, "tbody": body, "tfoot": foot}[child.tag].extend(rows)
        return captions, [r for r in [*head, *body, *foot] if self.sheet.style(r).get("display") != "none"]

    def _table(self, table: Node, hidden: bool, kept: bool, tables: int) -> list[str]:
        captions, rows = self._rows(table)
        out = [line for c in captions for line in self.lines(c, hidden, kept, tables + 1)]
        taken: dict[int, int] = {}  # column -> rows that a cell from above still covers
        grid: list[list[tuple[int, int, list[str], str]]] = []
        for row in rows:
            cells, column = [], 0
            taken = {c: n - 1 for c, n in taken.items() if n > 1}
            covered = set(taken)
            for cell in row.children:
                if not isinstance(cell, Node) or cell.tag not in ("td", "th"):
                    continue
                style = self.sheet.style(cell)
                if style.get("display") == "none":
                    continue
                while column in covered:
                    column += 1
                across = _number(cell.attributes.get("colspan"), 1, 1, 1000)
                down = _number(cell.attributes.get("rowspan"), 1, 1, 65534)
                unseen = hidden if "visibility" not in style else style["visibility"] != "visible"
                side = style.get("text-align") or cell.attributes.get("align", "").lower()
                cells.append((column, across, self.lines(cell, unseen, kept, tables + 1), side))
                if down > 1:
                    taken |= {c: down for c in range(column, column + across)}
                column += across
            grid.append(cells)
        widths: dict[int, int] = {}
        for across_only in (False, True):
            for cells in grid:
                for column, across, lines, _ in cells:
                    if (across > 1) == across_only:
                        need = max(map(width, lines), default=0)
                        have = sum(widths.get(c, 0) for c in range(column, column + across)) + len(_GAP) * (across - 1)
                        if need > have:
                            # Only the last column of a span grows; columns in between exist if another cell made them.
                            widths[column + across - 1] = widths.get(column + across - 1, 0) + need - have
        used = sorted(c for c, n in widths.items() if n)
        starts, at = {}, 0
        for c in used:
            starts[c] = at
            at += widths[c] + len(_GAP)
        for cells in grid:
            for k in range(max((len(lines) for _, _, lines, _ in cells), default=0)):
                line, end = "", 0
                for column, across, lines, side in cells:
                    mine = [c for c in used if column <= c < column + across] if across > 1 else [column] * (column in starts)
                    if k >= len(lines) or not mine:
                        continue
                    room = starts[mine[-1]] + widths[mine[-1]] - starts[mine[0]]
                    spare = max(0, room - width(lines[k]))
                    before = {"right": spare, "center": spare // 2}.get(side, 0)
                    line += " " * (starts[mine[0]] + before - end) + lines[k]
                    end = max(starts[mine[0]] + before, end) + width(lines[k])
                out.append(line.rstrip(" "))
        return out


def render(html: str) -> str:
    """All visible text of a page as it is laid out; empty lines between spaced blocks, never two in a row outside of ``pre``.

    Of drawings (svg) the text elements count, not what ``use`` repeats; of formulas (math) all but annotations, on one line.
    """
    root, styles = build(html)
    sheet = Sheet(styles)
    style = sheet.style(root)
    if style.get("display") == "none":
        return ""
    return "\n".join(_Renderer(sheet).lines(root, style.get("visibility") in ("hidden", "collapse"), False, 0))


def extract_text(pages: DataFrame) -> DataFrame:
    """(page_id, text) for every row of ``pages``.

    A null or empty html gives the empty text; rows with null or repeated ids stay rows of their own. An empty table gives an
    empty result. Other columns are not read.
    """

    def rendered(batches):
        for batch in slices(batches, 1):
            texts = [render(html) if html else "" for html in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["page_id", "text"])

    kind = pages.schema["page_id"].dataType.simpleString()
    rows = pages.select("page_id", F.col("html"))
    return map_arrow(rows, rendered, f"page_id {kind}, text string")
