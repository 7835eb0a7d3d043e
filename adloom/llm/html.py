"""Visible text of web pages by layout.

A tree builder reads tags in order, closes elements whose end tags are implied, and keeps raw-text elements whole. Elements that
a browser would not show (heads, scripts, templates, the ``hidden`` attribute, ``display:none``, hidden inputs …) are left out.
The rest is laid out: blocks on lines of their own, paragraphs, headings, lists and tables set off by an empty line; list items
with bullets or numbers, indented by depth; table cells padded to the width of their column; white space kept in ``pre`` only.

Null and empty pages give an empty text. Broken markup never fails: stray end tags are passed over and open elements close at
the end. Elements deeper than ``DEEPEST`` are laid out as their ancestor at that depth. A tag that never closes is text. Every
page is read once from front to back, whatever its markup. Cells that span columns or rows keep those columns free. The text of
a cell longer than ``WIDEST`` pushes the rest of its row aside instead of widening the column, and tables of a greater width than
``PADDED`` are written without padding; no text is cut.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_left

import pyarrow as pa
from pyspark.sql import DataFrame

from adloom.llm.common import extended, map_text

DEEPEST = 200
WIDEST = 200
PADDED = 4000
NAME_END = re.compile(r"[\s/>]")
SPECIAL = re.compile(r"[>\"']")
LONG_NUMBER = re.compile(r"&#[0-9]{4000,};?")
ATTRIBUTE = re.compile(r"([^\s=/\"'<>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.S)
HIDING = re.compile(r"display\s*:\s*none|visibility\s*:\s*(?:hidden|collapse)", re.I)
BLANKS = re.compile(r"[ \t\r\n\f]+")

# Element classes and implied end tags of the markup language.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
UNSEEN = frozenset("head script style template title noscript iframe noembed noframes datalist audio video canvas object defs desc metadata symbol annotation annotation-xml param meta link base area".split())
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl table blockquote pre figure hr fieldset menu".split())
BLOCK = SPACED | frozenset("div section article header footer nav aside main address form li dt dd tr caption thead tbody tfoot figcaption details summary dialog legend option optgroup body html center hgroup search".split())
ENDS_P = frozenset("address article aside blockquote center details dialog div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre search section table ul".split())
# What a start tag closes, and the elements past which it does not look.
IMPLIED = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "option": ({"option"}, {"select", "datalist"}), "optgroup": ({"option", "optgroup"}, {"select"}),
    "tr": ({"tr", "td", "th", "caption"}, {"table"}), "td": ({"td", "th"}, {"table", "tr"}), "th": ({"td", "th"}, {"table", "tr"}),
    "thead": ({"tr", "td", "th", "thead", "tbody", "tfoot", "caption"}, {"table"}),
    "tbody": ({"tr", "td", "th", "thead", "tbody", "tfoot", "caption"}, {"table"}),
    "tfoot": ({"tr", "td", "th", "thead", "tbody", "tfoot", "caption"}, {"table"}),
    "body": ({"head"}, set()),
}
IN_TABLE = frozenset("td th tr caption thead tbody tfoot colgroup".split())
SCOPES = frozenset("table td th caption html template object".split())
MOST_ACROSS, MOST_DOWN = 1000, 65534  # of colspan and rowspan


class Node:
    __slots__ = ("tag", "children", "hidden", "start", "alt", "across", "down")

    def __init__(self, tag: str, hidden: bool = False, start: int = 1, alt: str = "", across: int = 1, down: int = 1) -> None:
        self.tag, self.hidden, self.start, self.alt, self.across, self.down = tag, hidden, start, alt, across, down
        self.children: list[Node | str] = []


def element(tag: str, raw: str) -> Node:
    if not raw.strip(" /"):
        return Node(tag, tag in UNSEEN)
    given = {m[1].lower(): plain(m[2] or m[3] or m[4] or "") for m in ATTRIBUTE.finditer(raw)}
    hidden = tag in UNSEEN or "hidden" in given or bool(HIDING.search(given.get("style", ""))) or tag == "input" and given.get("type", "").lower() == "hidden"
    start = int(given["start"]) if tag == "ol" and given.get("start", "").isdecimal() and len(given["start"]) < 10 else 1
    alt = given.get("alt", "") if tag == "img" else given.get("value", "") if tag == "input" else ""
    if tag not in ("td", "th"):
        return Node(tag, hidden, start, alt)
    return Node(tag, hidden, across=spanned(given.get("colspan"), MOST_ACROSS), down=spanned(given.get("rowspan"), MOST_DOWN))


def spanned(given: str | None, most: int) -> int:
    """A number of columns or rows; 1 if it is not one. No rows at all means all that follow."""
    value = (given or "").strip()
    if not (value.isascii() and value.isdecimal()):
        return 1
    n = int(value) if len(value) < 7 else most
    return min(n, most) if n else most if most == MOST_DOWN else 1


def plain(text: str) -> str:
    """The text with its character references replaced; numbers too long to be one are unknown characters."""
    return html.unescape(LONG_NUMBER.sub("\ufffd", text)) if "&" in text else text


class Tags:
    """Finds the tags of a page from front to back. What was seen further on, or was not there, is remembered, so that the time is
    in proportion to the page even where tags never close."""

    def __init__(self, page: str) -> None:
        self.page = page
        self.last = page.rfind(">")
        self.special = (0, -1)  # no quote or ``>`` between these places, one at the second
        self.name_end = (0, -1)
        self.unclosed: set[int] = set()  # quotes from which no tag ends

    def _next(self, known: tuple[int, int], pattern: re.Pattern, at: int) -> tuple[int, int]:
        if known[0] <= at <= known[1]:
            return known
        m = pattern.search(self.page, at)
        return at, m.start() if m else len(self.page)

    def end(self, at: int) -> int | None:
        """The place of the ``>`` that ends a tag whose attributes begin at ``at``; quoted ones are passed over."""
        passed = []
        while at <= self.last:
            self.special = self._next(self.special, SPECIAL, at)
            place = self.special[1]
            if place >= len(self.page) or place in self.unclosed:
                break
            if self.page[place] == ">":
                return place
            passed.append(place)
            at = self.page.find(self.page[place], place + 1) + 1
            if not at:
                break
        self.unclosed.update(passed)
        return None

    def at(self, place: int) -> tuple[int, str, str, bool] | None:
        """(place behind it, name, attributes, closing) of the tag or comment at ``place``; None if it is text."""
        page = self.page
        if page.startswith("<!--", place):
            stop = page.find("-->", place + 4)
            return (stop + 3 if stop >= 0 else len(page)), "", "", False
        if place > self.last:
            return None
        if page.startswith(("<!", "<?"), place):
            return page.find(">", place) + 1, "", "", False
        closing = page.startswith("/", place + 1)
        begin = place + 1 + closing
        if not (page[begin : begin + 1].isascii() and page[begin : begin + 1].isalpha()):
            return None
        self.name_end = self._next(self.name_end, NAME_END, begin)
        after = self.name_end[1]
        stop = self.end(after)
        return None if stop is None else (stop + 1, page[begin:after].lower(), page[after:stop], closing)


def build(page: str) -> Node:
    """The tree of a page."""
    root = Node("html")
    stack, at = [root], 0

    def close(tags: set[str] | frozenset[str], fence: set[str] | frozenset[str], innermost: bool = False) -> None:
        """Close the outermost (or innermost) open element of ``tags`` above the innermost of ``fence``."""
        cut = None
        for i in range(len(stack) - 1, 0, -1):
            if stack[i].tag in tags:
                cut = i
                if innermost:
                    break
            elif stack[i].tag in fence:
                break
        if cut is not None:
            del stack[cut:]

    tags, look = Tags(page), page.find("<")
    while look >= 0:
        found = tags.at(look)
        if not found:
            look = page.find("<", look + 1)
            continue
        if look > at:
            stack[-1].children.append(plain(page[at:look]))
        at, tag, attributes, closing = found
        look = page.find("<", at)
        if not tag:
            continue
        if closing:
            if tag == "br":
                stack[-1].children.append(Node("br"))
            elif tag not in ("html", "body"):
                close({tag}, frozenset() if tag == "table" else {"table"} if tag in IN_TABLE else SCOPES, innermost=True)
            continue
        if tag in ENDS_P:
            close({"p"}, SCOPES | {"button"})
        if tag in IMPLIED:
            close(*IMPLIED[tag])
        if tag in ("html", "body"):
            if element(tag, attributes).hidden:
                root.hidden = True
            continue
        node = element(tag, attributes)
        stack[-1].children.append(node)
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])", re.I).search(page, at)
            stop = page.find(">", end.end()) if end else -1
            body = page[at : end.start() if stop >= 0 else len(page)]
            if tag in ("textarea", "title", "xmp"):
                node.children.append(body if tag == "xmp" else plain(body))
            at = stop + 1 if stop >= 0 else len(page)
            look = page.find("<", at)
        elif tag not in VOID and not attributes.endswith("/") or tag not in VOID and tag in BLOCK:
            if len(stack) < DEEPEST:
                stack.append(node)
    if at < len(page):
        stack[-1].children.append(plain(page[at:]))
    return root


class Lines:
    """Text under layout: finished lines, the line being written, and the space owed before the next one."""

    def __init__(self) -> None:
        self.done: list[str] = []
        self.now: list[str] = []
        self.gap = 0
        self.mark = ""

    def text(self, s: str) -> None:
        s = BLANKS.sub(" ", s)
        if s == " " or not s:
            if self.now and not self.now[-1].endswith(" ") and s:
                self.now.append(" ")
            return
        if not self.now:
            s = s.lstrip(" ")
        elif s[0] == " " and self.now[-1].endswith((" ", "\n")):
            s = s[1:]
        if s:
            self.now.append(s)

    def end(self, gap: int = 1) -> None:
        line = "".join(self.now).rstrip(" ")
        self.now = []
        if line or self.mark and gap < 0:
            if self.done and self.gap > 1:
                self.done.append("")
            self.done.append(self.mark + line)
            self.mark, self.gap = "", 1
        self.gap = max(self.gap, gap)

    def add(self, lines: list[str], first: str = "", rest: str = "") -> None:
        """Finished lines of an inner box, indented."""
        if lines:
            if self.done and self.gap > 1:
                self.done.append("")
            self.done += [((first if i == 0 else rest) + x).rstrip(" ") for i, x in enumerate(lines)]
            self.gap = 1


class Grid:
    """Places the cells of a table in columns; those that span rows keep their columns in the rows below."""

    def __init__(self) -> None:
        self.rows: list[list[tuple[int, int, list[str]]]] = []  # first column, columns, lines
        self.held: list[tuple[int, int, int]] = []  # first column, end, first row that is free again

    def row(self, cells: list[tuple[list[str], int, int]]) -> None:
        now, at = len(self.rows), 0
        self.held = [h for h in self.held if h[2] > now]
        row, new, k = [], [], 0
        for lines, across, down in cells:
            while k < len(self.held) and self.held[k][0] <= at:
                at = max(at, self.held[k][1])
                k += 1
            row.append((at, across, lines))
            if down > 1:
                if new and new[-1][1:] == (at, now + down):
                    new[-1] = (new[-1][0], at + across, now + down)
                else:
                    new.append((at, at + across, now + down))
            at += across
        self.rows.append(row)
        if new:
            self.held = sorted(self.held + new)

    def lines(self) -> list[str]:
        # Columns in which no cell begins have no width of their own.
        begins = sorted({at for row in self.rows for at, _, _ in row})
        column = {at: i for i, at in enumerate(begins)}
        widths = [0] * len(begins)
        for row in self.rows:
            for at, across, lines in row:
                i = column[at]
                size = max([0, *map(len, lines)])
                if size <= WIDEST and (i + 1 == len(begins) or begins[i + 1] >= at + across):
                    widths[i] = max(widths[i], size)
        for row in self.rows if 2 * len(begins) <= PADDED else []:
            for at, across, lines in row:
                i, j = column[at], bisect_left(begins, at + across)
                size = max([0, *map(len, lines)])
                if size <= WIDEST and j - i > 1:
                    widths[j - 1] += max(0, size - sum(widths[i:j]) - 2 * (j - i - 1))
        offsets = [0]
        for w in widths:
            offsets.append(offsets[-1] + w + 2)
        wide = offsets[-1] > PADDED
        out = []
        for row in self.rows:
            for k in range(max([0, *(len(lines) for _, _, lines in row)])):
                line = []
                length = 0
                for at, _, lines in row:
                    blank = 2 * bool(line) if wide else max(offsets[column[at]] - length, 2 * bool(line))
                    text = lines[k] if k < len(lines) else ""
                    line.append(" " * blank + text)
                    length += blank + len(text)
                out.append("".join(line).rstrip(" "))
        return out


def table_lines(node: Node, depth: int) -> list[str]:
    """Rows of a table, cells padded to their column; cells of several lines fill as many lines."""
    grid = Grid()
    lead: list[str] = []
    todo = [c for c in reversed(node.children)]
    while todo:
        c = todo.pop()
        if isinstance(c, str):
            lead += [x for x in [BLANKS.sub(" ", c).strip(" ")] if x]
        elif c.hidden:
            continue
        elif c.tag in ("thead", "tbody", "tfoot"):
            grid.held = []
            todo += reversed(c.children)
        elif c.tag == "tr":
            cells = [k for k in c.children if not (isinstance(k, str) and not k.strip()) and not (isinstance(k, Node) and k.hidden)]
            grid.row([(lay(k, depth + 1), k.across, k.down) if isinstance(k, Node) else (lay(wrap(k), depth + 1), 1, 1) for k in cells])
        elif c.tag in ("td", "th"):
            grid.row([(lay(c, depth + 1), c.across, c.down)])
        elif c.tag not in ("colgroup", "col"):
            lead += lay(c, depth + 1)
    return lead + grid.lines()


def wrap(text: str) -> Node:
    node = Node("td")
    node.children.append(text)
    return node


def lay(node: Node, depth: int = 0) -> list[str]:
    """Lines of an element. Inner boxes with lines of their own (lists, tables) nest at most ``DEEPEST`` deep."""
    out = Lines()
    number = [node.start]
    todo: list = [("leave", node, 0), *reversed(node.children)]
    parents = [node]
    while todo:
        c = todo.pop()
        if isinstance(c, tuple):
            if c[0] == "leave" and c[1] is not node:
                parents.pop()
                if c[1].tag in BLOCK:
                    out.end(2 if c[1].tag in SPACED else 1)
            continue
        if isinstance(c, str):
            if any(p.tag in ("pre", "textarea", "xmp") for p in parents):
                first, *rest = c.split("\n")
                out.now.append(first)
                for x in rest:
                    line = "".join(out.now).rstrip(" ")
                    out.now = []
                    out.done += [""] * (out.gap > 1 and bool(out.done)) + [line]
                    out.gap = 1
                    out.now.append(x)
            else:
                out.text(c)
            continue
        if c.hidden:
            continue
        tag = c.tag
        if tag == "br":
            line = "".join(out.now).rstrip(" ")
            out.now = []
            out.done += [""] * (out.gap > 1 and bool(out.done)) + [line]
            out.gap = 1
        elif tag in ("img", "input"):
            out.text(c.alt)
        elif tag == "table":
            out.end(2)
            out.add(table_lines(c, depth))
            out.gap = 2
        elif tag in ("ul", "ol", "menu"):
            inside = parents[-1].tag == "li" or node.tag == "li"
            out.end(1 if inside else 2)
            n = c.start
            for item in c.children:
                if isinstance(item, str) and not item.strip() or isinstance(item, Node) and item.hidden:
                    continue
                mark = f"{n}. " if tag == "ol" else "- "
                n += 1
                out.add(lay(item if isinstance(item, Node) else wrap(item), depth + 1), mark, " " * len(mark))
            out.gap = max(out.gap, 1 if inside else 2)
        elif tag == "blockquote":
            out.end(2)
            out.add(lay(_as(c, "div"), depth + 1), "> ", "> ")
            out.gap = 2
        else:
            if tag in BLOCK:
                out.end(2 if tag in SPACED else 1)
                if tag == "dd" and c.children:
                    out.add(lay(_as(c, "div"), depth + 1), "  ", "  ")
                    continue
                if tag == "hr":
                    out.add(["---"])
                    out.gap = 2
                    continue
            elif tag in ("td", "th", "text", "tspan") and out.now:
                out.text(" ")
            parents.append(c)
            todo.append(("leave", c, 0))
            todo += reversed(c.children)
    out.end()
    while out.done and not out.done[-1]:
        out.done.pop()
    return out.done


def _as(node: Node, tag: str) -> Node:
    copy = Node(tag)
    copy.children = node.children
    return copy


def render(page: str | None) -> str:
    """The visible text of a page."""
    if not page:
        return ""
    root = build(page)
    return "" if root.hidden else "\n".join(lay(root))


def extract(pages: DataFrame, column: str = "html", name: str = "text") -> DataFrame:
    """``pages`` with its markup replaced by the visible text; a column of that name is replaced, others pass through."""
    others = [c for c in pages.columns if c not in (column, name)]

    def run(batch: pa.RecordBatch) -> dict:
        return {c: batch.column(c) for c in others} | {name: [render(p) for p in batch.column(column).to_pylist()]}

    return map_text(pages, column, run, extended(pages, others, f"{name} string"))
