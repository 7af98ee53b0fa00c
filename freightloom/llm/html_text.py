"""Visible text of web pages, laid out.

A page is cut into tags and text in one pass, built into a tree (end tags that
authors may leave out are implied), and the tree is walked once: what is not
shown is left out, blocks stand on lines of their own, paragraphs have a blank
line between them, list items a marker, and the cells of a table line up.
Every element is opened, however deep it lies: nothing recurses, and the open
elements of a tag are found by their positions, not by looking back.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections import defaultdict
from collections.abc import Callable, Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from freightloom.llm.common import field_of, slices, text_of

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
HEAD = frozenset("base basefont bgsound link meta noframes script style template title noscript".split())
UNSEEN = frozenset("head script style template title noscript iframe noembed noframes object audio video canvas datalist".split())
#: Within svg and math: what is not drawn, where HTML begins again, and the start tags of HTML that end both.
UNDRAWN = frozenset("title desc defs metadata annotation annotation-xml mphantom".split())
INTEGRATION = tuple("foreignobject desc title annotation-xml mi mo mn ms mtext".split())
BREAKOUT = frozenset(
    "b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li listing menu meta nobr ol p pre ruby s"
    " small span strong strike sub sup table tt u ul var".split()
)
#: Blocks with a blank line before and after, and blocks on lines of their own.
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl menu blockquote pre table figure fieldset hr".split())
LINES = frozenset(
    "address article aside body caption center dd details dialog dir div dt fieldset figcaption footer form header hgroup html legend li"
    " main nav option search section summary tbody tfoot thead tr".split()
)
BLOCKS = SPACED | LINES
LISTS = frozenset(("ul", "ol", "menu", "dir"))
CELLS = frozenset(("td", "th"))
#: A start tag closes the outermost open element named first, as far as the elements named second.
IMPLIED = {
    "li": (("li",), ("ul", "ol", "menu", "dir", "td", "th")),
    "dt": (("dt", "dd"), ("dl", "td", "th")),
    "dd": (("dt", "dd"), ("dl", "td", "th")),
    "td": (("td", "th"), ("tr", "table")),
    "th": (("td", "th"), ("tr", "table")),
    "tr": (("tr", "td", "th", "caption", "colgroup"), ("table",)),
    "thead": (("thead", "tbody", "tfoot", "tr", "td", "th", "caption", "colgroup"), ("table",)),
    "option": (("option",), ("select", "datalist")),
    "optgroup": (("option", "optgroup"), ("select",)),
}
IMPLIED |= {"tbody": IMPLIED["thead"], "tfoot": IMPLIED["thead"]}
HEADINGS = frozenset(f"h{n}" for n in range(1, 7))
#: Levels by which a line is indented at most. Deeper elements are opened and shown like any other; without a bound
#: on the blanks before a line, the text of nested lists would grow with the square of the page.
DEEPEST = 512
#: Cells up to this width are padded; a wider cell does not widen its column, lest one long cell pad every row (see README).
WIDEST_COLUMN = 40
MOST_SPAN = 1000

NAME = re.compile(r"[a-zA-Z][^\s/>]*")
ATTRIBUTE = re.compile(r"""[\s/]*+([^\s/>=][^\s/>=]*+)(?:\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s>]*+)))?""")
BLANKS = re.compile(r"[ \t\n\r\f]+")
HIDDEN = re.compile(r"(?:^|;)\s*(?:display\s*:\s*none|visibility\s*:\s*(?:hidden|collapse))", re.I)
RAW_END = {name: re.compile(rf"</{name}(?=[\s/>])", re.I) for name in RAW}


class Node:
    __slots__ = ("tag", "attributes", "children")

    def __init__(self, tag: str, attributes: dict[str, str]):
        self.tag, self.attributes, self.children = tag, attributes, []


def pieces(html: str, foreign: Callable[[], bool]) -> Iterator[tuple[str, object, object]]:
    """``("text", text, None)``, ``("start", name, attributes)`` and ``("end", name, None)`` in order.

    ``foreign`` tells whether what was given so far ends within svg or math: only
    there are sections of CDATA text, and are start tags with a slash also end tags.
    """
    at, n = 0, len(html)
    while at < n:
        cut = html.find("<", at)
        if cut < 0:
            yield "text", unescape(html[at:]), None
            return
        after = html[cut + 1 : cut + 2]
        if cut > at:
            yield "text", unescape(html[at:cut]), None
        if html.startswith("<![CDATA[", cut) and foreign():
            end = html.find("]]>", cut)
            yield "text", html[cut + 9 : end if end >= 0 else n], None
            at = end + 3 if end >= 0 else n
        elif after == "!" or after == "?":
            end = html.find("-->", cut + 4) if html.startswith("<!--", cut) else html.find(">", cut)
            if end < 0:
                return
            at = end + (3 if html.startswith("<!--", cut) else 1)
        elif after == "/":
            name, end = NAME.match(html, cut + 2), html.find(">", cut)
            if end < 0:
                return
            if name:
                yield "end", name[0].lower(), None
            at = end + 1
        elif name := NAME.match(html, cut + 1):
            tag, at, attributes = name[0].lower(), name.end(), {}
            while m := ATTRIBUTE.match(html, at):
                value = next((g for g in m.groups()[1:] if g is not None), "")
                attributes.setdefault(m[1].lower(), unescape(value))
                at = m.end()
            end = html.find(">", at)
            if end < 0:
                return
            closed = html[end - 1] == "/" and end > at and tag not in BREAKOUT and (tag in ("svg", "math") or foreign())
            at = end + 1
            yield "start", tag, attributes
            if closed:
                yield "end", tag, None
            elif tag in RAW:
                close = RAW_END[tag].search(html, at)
                stop = close.start() if close else n
                yield "text", unescape(html[at:stop]) if tag in ("textarea", "title") else html[at:stop], None
                yield "end", tag, None
                at = n if not close else (html.find(">", stop) + 1 or n)
        else:
            yield "text", "<", None
            at = cut + 1


def tree(html: str) -> Node:
    """The page as a tree, with implied end tags and table rows put in."""
    root = Node("#root", {})
    stack: list[Node] = [root]
    places: dict[str, list[int]] = defaultdict(list)  # of the open elements of each tag in the stack

    def last(tags: tuple) -> int:
        """Position of the innermost open element of some tags, 0 without one."""
        return max((places[t][-1] for t in tags if places[t]), default=0)

    def pop_to(i: int) -> None:
        for node in stack[i:]:
            places[node.tag].pop()
        del stack[i:]

    def close(tags: tuple, stops: tuple) -> None:
        stop = last(stops)
        found = [places[t][i] for t in tags if (i := bisect_right(places[t], stop)) < len(places[t])]
        if found:
            pop_to(min(found))

    def open_(tag: str, attributes: dict[str, str]) -> None:
        node = Node(tag, attributes)
        stack[-1].children.append(node)
        if tag not in VOID:
            places[tag].append(len(stack))
            stack.append(node)

    def foreign() -> bool:
        return last(("svg", "math")) > last(INTEGRATION)

    for kind, what, attributes in pieces(html, foreign):
        if kind == "text":
            if foreign() and last(("svg",)) > last(("text", "math")):
                continue  # svg draws what is in its text elements
            if stack[-1].tag == "head" and what.strip():
                pop_to(len(stack) - 1)
            stack[-1].children.append(what)
        elif kind == "start":
            while what in BREAKOUT and foreign():
                pop_to(last(("svg", "math")))
            if foreign():
                if what in UNDRAWN or attributes.get("display") == "none" or attributes.get("visibility") in ("hidden", "collapse"):
                    attributes["hidden"] = ""
                if what == "text":
                    attributes["display"] = "block"
                open_(what, attributes)
                continue
            if what not in HEAD and stack[-1].tag == "head":
                pop_to(len(stack) - 1)
            if what in BLOCKS:
                close(("p",), ("button", "td", "th", "caption", "object", "table"))
            if what in IMPLIED:
                close(*IMPLIED[what])
            if what in HEADINGS and stack[-1].tag in HEADINGS:
                pop_to(len(stack) - 1)
            if what in CELLS and places["table"] and stack[-1].tag in ("table", "tbody", "thead", "tfoot"):
                open_("tr", {})
            open_(what, attributes)
        elif places[what]:
            walls = ("table",) if what in CELLS or what == "tr" else () if what in ("table", "body", "html") else ("td", "th", "table")
            if places[what][-1] >= last(walls):
                pop_to(places[what][-1])
        elif what == "br":
            open_("br", {})
    return root


class Flow:
    """Lines of text under way."""

    def __init__(self):
        self.lines: list[str] = []
        self.parts: list[str] = []
        self.gap, self.blank, self.indent, self.marker = 0, False, 0, ""

    def text(self, text: str, pre: bool) -> None:
        if pre:
            first, *rest = text.replace("\r\n", "\n").split("\n")
            self.put(first)
            for line in rest:
                self.end(1, True)
                self.put(line)
            return
        words = BLANKS.split(text)
        self.blank |= not words[0] and len(words) > 1
        body = " ".join(w for w in words if w)
        if body:
            if self.parts and self.blank:
                self.parts.append(" ")
            self.put(body)
            self.blank = not words[-1]

    def put(self, body: str) -> None:
        if not body:
            return
        if not self.parts:
            if self.lines and self.gap > 1:
                self.lines.append("")
            indent = min(self.indent, DEEPEST)
            self.parts.append("  " * max(0, indent - 1) + self.marker if self.marker else "  " * indent)
            self.gap, self.marker = 0, ""
        self.parts.append(body)

    def end(self, gap: int, forced: bool = False) -> None:
        """End the line; ``gap`` 2 asks for a blank line before the next one."""
        if self.parts:
            self.lines.append("".join(self.parts).rstrip(" \t"))
            self.parts = []
        elif forced and self.lines:
            self.lines.append("")
        self.blank = False
        self.gap = max(self.gap, gap)

    def done(self) -> str:
        self.end(0)
        return "\n".join(self.lines).strip("\n")


def seen(node: Node) -> bool:
    a = node.attributes
    if node.tag in UNSEEN or "hidden" in a or HIDDEN.search(a.get("style", "")):
        return False
    return not (node.tag == "input" and a.get("type", "").lower() == "hidden") and not (node.tag == "dialog" and "open" not in a)


def span_of(node: Node) -> int:
    value = node.attributes.get("colspan", "1").strip()
    return min(max(int(value), 1), MOST_SPAN) if value.isdecimal() and len(value) < 9 else 1


def aligned(rows: list[list[str]]) -> list[str]:
    """Rows of cells, each column as wide as its widest cell of ordinary width."""
    widths: list[int] = []
    for row in rows:
        for i, cell in enumerate(row):
            if i == len(widths):
                widths.append(0)
            if len(cell) <= WIDEST_COLUMN:
                widths[i] = max(widths[i], len(cell))
    return [" | ".join(cell.ljust(widths[i]) if i + 1 < len(row) else cell for i, cell in enumerate(row)).rstrip() for row in rows]


def render(html: str) -> str:
    """The visible text of a page."""
    flows, tables, lists = [Flow()], [], []
    pre = 0
    work: list[tuple[Node | str, bool]] = [(tree(html), False)]
    while work:
        node, leaving = work.pop()
        flow = flows[-1]
        if isinstance(node, str):
            flow.text(node, pre > 0)
            continue
        tag = node.tag
        gap = 2 if tag in SPACED and not (tag in LISTS and len(lists) > (0 if not leaving else 1)) else 1 if tag in BLOCKS or tag in ("math", "text") and node.attributes.get("display") == "block" else 0
        if not leaving:
            if not seen(node):
                continue
            if gap:
                flow.end(gap)
            if tag == "br":
                flow.end(1, True)
            elif tag == "input":
                flow.text(node.attributes.get("value", "") if node.attributes.get("type", "text").lower() in ("text", "submit", "button", "reset", "search", "email", "url", "tel", "number") else "", False)
            elif tag in LISTS:
                lists.append([1 if tag == "ol" else 0])
                start = node.attributes.get("start", "")
                if tag == "ol" and start.isdecimal() and len(start) < 9:
                    lists[-1][0] = int(start)
                flow.indent += 1
            elif tag == "li":
                number = lists[-1][0] if lists else 0
                flow.marker = f"{number}. " if number else "- "
                if number:
                    lists[-1][0] += 1
            elif tag in ("blockquote", "dd"):
                flow.indent += 1
            elif tag in ("pre", "textarea"):
                pre += 1
            elif tag == "table":
                tables.append([])
            elif tag == "tr" and tables:
                tables[-1].append([])
            elif tag in CELLS and tables:
                flows.append(Flow())
            work.append((node, True))
            work.extend((child, False) for child in reversed(node.children))
            continue
        if tag in LISTS:
            lists.pop()
            flow.indent -= 1
        elif tag == "li":
            flow.marker = ""
        elif tag == "mtd":
            flow.blank = True
        elif tag in ("blockquote", "dd"):
            flow.indent -= 1
        elif tag in ("pre", "textarea"):
            pre -= 1
        elif tag in CELLS and tables:
            cell = " ".join(flows.pop().done().split("\n"))
            if not tables[-1]:
                tables[-1].append([])
            tables[-1][-1] += [cell, *[""] * (span_of(node) - 1)]
            continue
        elif tag == "table":
            rows = [row for row in tables.pop() if any(row)]
            for line in aligned(rows):
                flow.put(line)
                flow.end(1)
        if gap:
            flow.end(gap)
    return flows[0].done()


def extract(pages: DataFrame, id_column: str = "page_id", html_column: str = "html") -> DataFrame:
    """``id, text``: the visible text of each whole page.

    Null and empty pages give the empty text; anything else that is not HTML is
    text. Rows are independent: repeated rows repeat their result, and other
    columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(map(render, part.column(1).to_pylist()), pa.string())], ["id", "text"])

    source = pages.select(F.col(id_column).alias("id"), text_of(html_column).alias("html"))
    return source.mapInArrow(run, StructType([field_of(source, "id"), StructField("text", StringType())]))
