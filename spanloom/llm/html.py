"""HTML extraction: a tree with implied tags, rendered as the text that a reader would see.

The tokenizer takes any bytes and runs in time linear in their number. The tree builder
closes elements that HTML lets authors leave open (p, li, dt, dd, option, table parts)
and opens those it lets them omit (tbody and tr around cells). What stands in a table, but
in no cell or caption, goes before the table, as in browsers. The renderer leaves out
what isn't visible (head, scripts, templates, comments, hidden inputs, closed details,
``hidden``, ``display:none``, ``visibility:hidden``), collapses white space outside pre,
puts a blank line between paragraphs and one newline between other blocks, numbers or
marks list items with indentation by depth, and pads table cells to common widths.

Defined results: a null page has null text, an empty one ''. Markup that isn't closed
ends with the page. Character references that don't exist stay as they are written.
Rows are rendered each for itself; null or repeated keys and other columns don't matter.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, types as T

from . import textkit as tk
from .tables import key_type, map_arrow, table, two_columns

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style xmp iframe noembed noframes textarea title".split())
UNSEEN = frozenset("head title script style template noscript iframe noembed noframes datalist object video audio canvas svg math base link meta".split())
PARAGRAPH = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl blockquote pre table figure hr".split())
BLOCK = PARAGRAPH | frozenset("html body address article aside details dialog dd div dt fieldset figcaption footer form header hgroup legend li main menu nav option optgroup search section summary tbody thead tfoot tr caption center".split())
#: An opening tag of these ends an open paragraph.
ENDS_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre search section summary table ul li dd dt".split())
#: Tag: (open elements that it ends, elements beyond which none is ended).
IMPLIED = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "option": ({"option"}, {"select", "datalist"}),
    "optgroup": ({"option", "optgroup"}, {"select"}),
    "tr": ({"tr", "td", "th", "caption", "colgroup"}, {"table"}),
    "td": ({"td", "th"}, {"table", "tr"}),
    "th": ({"td", "th"}, {"table", "tr"}),
    "tbody": ({"tbody", "thead", "tfoot", "tr", "td", "th", "caption", "colgroup"}, {"table"}),
    "thead": ({"tbody", "thead", "tfoot", "tr", "td", "th", "caption", "colgroup"}, {"table"}),
    "tfoot": ({"tbody", "thead", "tfoot", "tr", "td", "th", "caption", "colgroup"}, {"table"}),
}
SCOPES = frozenset("table td th caption html template object".split())

#: In these, only parts of tables and what isn't seen may stand.
TABLE_PARTS = frozenset("table tbody thead tfoot tr colgroup".split())
IN_TABLE = frozenset("caption colgroup col tbody thead tfoot tr td th".split())

#: Elements are nested no deeper than this; those beyond it become siblings, as in browsers.
DEEPEST = 512

_NAME = re.compile(r"[a-zA-Z][^\s/>]*")
_ATTRIBUTE = re.compile(r"""[\s/]*([^\s/>=][^\s/>=]*)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"'][^\s>]*)))?""")
_SPACE = re.compile(r"[ \t\n\r\f]+")
_HIDING = re.compile(r"(?:display\s*:\s*none|visibility\s*:\s*(?:hidden|collapse))", re.I)


class Node:
    __slots__ = ("tag", "attrs", "children")

    def __init__(self, tag: str, attrs: dict[str, str]):
        self.tag, self.attrs, self.children = tag, attrs, []


def tokens(page: str) -> Iterator[tuple[str, object, dict | None]]:
    """("text", string), ("open", tag, attributes) and ("close", tag) in order; comments and declarations are left out."""
    at, n, find = 0, len(page), page.find
    missing: set[str] = set()  # ends of raw texts and comments that aren't found from here on

    def seek(mark: str, begin: int) -> int:
        if mark in missing:
            return -1
        if (k := find(mark, begin)) < 0:
            missing.add(mark)
        return k

    lower = None
    while at < n:
        open_at = find("<", at)
        if open_at < 0:
            yield "text", entities.unescape(page[at:]), None
            return
        if open_at > at:
            yield "text", entities.unescape(page[at:open_at]), None
        if page.startswith("<!--", open_at):
            end = seek("-->", open_at + 4) if page[open_at + 4 : open_at + 5] != ">" else open_at + 2
            at = n if end < 0 else end + 3
            continue
        closing = page.startswith("</", open_at)
        name = _NAME.match(page, open_at + 1 + closing)
        if not name:
            if page[open_at + 1 : open_at + 2] in ("!", "?") or closing and open_at + 2 < n:
                end = seek(">", open_at)
                at = n if end < 0 else end + 1
            else:
                yield "text", "<", None
                at = open_at + 1
            continue
        tag, at = name.group().lower(), name.end()
        attrs: dict[str, str] = {}
        while at < n and page[at] != ">":
            m = _ATTRIBUTE.match(page, at)
            if not m:
                at += 1
                continue
            at = m.end()
            if not closing:
                value = m[2] if m[2] is not None else m[3] if m[3] is not None else m[4]
                attrs.setdefault(m[1].lower(), value or "")
        at += 1
        if at > n:  # the page ends inside a tag
            return
        if closing:
            yield "close", tag, None
            continue
        yield "open", tag, attrs
        if tag in RAW:
            if lower is None:
                lower = page.lower() if len(page.lower()) == n else page
            end = -1 if f"</{tag}" in missing else lower.find(f"</{tag}", at)
            if end < 0:
                missing.add(f"</{tag}")
                end = n
            if end > at:
                yield "text", entities.unescape(page[at:end]) if tag in ("textarea", "title") else page[at:end], None
            at = end


def parse(page: str) -> Node:
    """The page's tree; elements that the page leaves out or doesn't close are implied."""
    root = Node("html", {})
    stack = [root]

    def close(tags: set[str] | frozenset[str], limit: set[str] | frozenset[str], last: bool) -> None:
        """End open elements up to the topmost of ``tags``, or up to the lowest where ``last``, but none beyond one of ``limit``."""
        cut = 0
        for i in range(len(stack) - 1, 0, -1):
            if stack[i].tag in tags:
                cut = i
                if not last:
                    break
            elif stack[i].tag in limit:
                break
        if cut:
            del stack[cut:]

    def add(child: Node | str, tag: str) -> None:
        """Put a child where it belongs: what can't stand in an open part of a table goes before the table."""
        if stack[-1].tag in TABLE_PARTS and tag not in IN_TABLE and tag not in UNSEEN:
            if stack[-1].tag == "colgroup":
                stack.pop()
            i = len(stack) - 1
            while i and stack[i].tag != "table":
                i -= 1
            if i:
                stack[i - 1].children.insert(len(stack[i - 1].children) - 1, child)  # an open table is its parent's last child
                return
        stack[-1].children.append(child)

    def push(tag: str, attrs: dict[str, str]) -> None:
        node = Node(tag, attrs)
        add(node, tag)
        if tag not in VOID and (len(stack) < DEEPEST or tag in UNSEEN):
            stack.append(node)

    opened: dict[str, int] = {}
    for kind, value, attrs in tokens(page):
        if kind == "text":
            add(value, "" if value.strip() else "col")
        elif kind == "open":
            if value == "html":
                root.attrs = {**attrs, **root.attrs}
                continue
            if value == "body":
                close({"head"}, frozenset(), False)
            if opened.get("p") and value in ENDS_P:
                close({"p"}, SCOPES, False)
            if value in IMPLIED:
                close(*IMPLIED[value], True)
                if value in ("td", "th") and stack[-1].tag in ("table", "tbody", "thead", "tfoot"):
                    push("tr", {})
            if value in IN_TABLE and opened.get("table"):
                i = len(stack) - 1
                outer, cells = ({"table"}, ()) if value in ("caption", "colgroup") else (TABLE_PARTS, ("td", "th", "caption"))
                while i and stack[i].tag not in outer and stack[i].tag not in cells:
                    i -= 1
                if stack[i].tag in outer:
                    del stack[i + 1 :]
                if value in ("td", "th") and stack[-1].tag in ("table", "tbody", "thead", "tfoot"):
                    push("tr", {})
            elif value == "table" and stack[-1].tag in TABLE_PARTS:
                close({"table"}, frozenset(), False)
            elif value == "form" and stack[-1].tag in TABLE_PARTS:
                continue  # its content stays in the table
            opened[value] = opened.get(value, 0) + 1
            push(value, attrs)
        elif opened.get(value):
            close({value}, frozenset() if value in ("body", "table") else SCOPES - {value}, False)
    return root


def _hidden(node: Node) -> bool:
    a = node.attrs
    return node.tag in UNSEEN or bool(a) and ("hidden" in a or node.tag == "input" and a.get("type", "").lower() == "hidden" or "style" in a and bool(_HIDING.search(a["style"])))


class _Page:
    """Lines of output, with the breaks that are due before the next text."""

    def __init__(self):
        self.parts: list[str] = []
        self.due, self.space, self.indent, self.mark = 0, False, 0, ""

    def block(self, breaks: int) -> None:
        self.due = max(self.due, breaks)
        self.space = False

    def text(self, value: str, pre: bool) -> None:
        if not pre:
            body = _SPACE.sub(" ", value)
            if body == " " or not body:
                self.space = self.space or bool(body) and not self.due
                return
            lead = body[0] == " "
            if lead and not self.due or self.space:
                self._begin()
                if self.parts and not self.parts[-1].endswith(("\n", " ")):
                    self.parts.append(" ")
            else:
                self._begin()
            self.space = body[-1] == " "
            self.parts.append(body.strip(" "))
        elif value:
            self._begin()
            if self.space and self.parts and not self.parts[-1].endswith("\n"):
                self.parts.append(" ")
            self.space = False
            self.parts.append(value.replace("\r\n", "\n").replace("\r", "\n").replace("\n", "\n" + "  " * self.indent))

    def _begin(self) -> None:
        if self.due and self.parts:
            self.parts.append("\n" * self.due)
            self.space = False
        if self.due or not self.parts:
            self.parts.append("  " * max(0, self.indent - bool(self.mark)) + self.mark if self.mark or self.indent else "")
            self.mark = ""
        self.due = 0

    def line(self) -> None:
        self._begin()
        self.due, self.space = 1, False

    def done(self) -> str:
        return "\n".join(x.rstrip(" ") for x in "".join(self.parts).split("\n")).strip("\n")


def _row_cells(table_node: Node) -> Iterator[list[Node]]:
    """The cells of each visible row of a table, those of tables inside it not among them."""
    for child in table_node.children:
        if isinstance(child, Node) and not _hidden(child):
            if child.tag == "tr":
                yield [c for c in child.children if isinstance(c, Node) and c.tag in ("td", "th") and not _hidden(c)]
            elif child.tag in ("tbody", "thead", "tfoot"):
                yield from _row_cells(child)


def _table_lines(node: Node, level: int) -> list[str]:
    """Rows of a table with cells padded to the widths of their columns; a cell's lines are joined by spaces."""
    rows = [[" ".join(render(Node("div", {}), c.children, level + 1).split()) for c in cells] for cells in _row_cells(node)]
    rows = [r for r in rows if any(r)]
    widths = [max(len(r[i]) if i < len(r) else 0 for r in rows) for i in range(max(map(len, rows), default=0))]
    return [" | ".join(c.ljust(w) for c, w in zip(r, widths)).rstrip() for r in rows]


#: Tables inside tables beyond this depth are rendered as plain blocks.
DEEPEST_TABLE = 20


def render(root: Node, children: list | None = None, level: int = 0) -> str:
    out = _Page()
    todo: list[tuple] = [("go", child, False, "", 0) for child in reversed(root.children if children is None else children)]
    while todo:
        what, node, pre, kind, number = todo.pop()
        if what == "end":
            node()
            continue
        if isinstance(node, str):
            out.text(node, pre)
            continue
        if _hidden(node):
            continue
        tag = node.tag
        if tag == "br":
            out.line()
            continue
        if tag == "table" and level < DEEPEST_TABLE:
            out.block(2)
            for child in node.children:
                if isinstance(child, Node) and child.tag == "caption" and not _hidden(child):
                    out.text(" ".join(render(child, None, level + 1).split()), False)
                    out.block(1)
            for line in _table_lines(node, level):
                out.text(line, True)
                out.block(1)
            out.block(2)
            continue
        breaks = 2 if tag in PARAGRAPH else 1 if tag in BLOCK else 0
        if tag in ("ul", "ol", "menu") and kind:
            breaks = 1  # a list inside a list
        if breaks:
            out.block(breaks)
            todo.append(("end", lambda b=breaks: out.block(b), False, "", 0))
        visible = node.children
        if tag == "details" and "open" not in node.attrs:
            visible = [c for c in node.children if isinstance(c, Node) and c.tag == "summary"][:1]
        if tag in ("ul", "ol", "menu", "dd", "blockquote"):
            out.indent += 1

            def back():
                out.indent -= 1

            todo.append(("end", back, False, "", 0))
        inner = tag if tag in ("ul", "ol", "menu") else kind
        count = int(node.attrs["start"]) if tag == "ol" and node.attrs.get("start", "").lstrip("-").isdecimal() and len(node.attrs["start"]) < 10 else 1
        items = []
        for child in visible:
            items.append(("go", child, pre or tag in ("pre", "textarea"), inner, count))
            count += isinstance(child, Node) and child.tag == "li" and not _hidden(child)
        if tag == "li":
            out.mark = f"{number}. " if kind == "ol" else "- "
            todo.append(("end", lambda: setattr(out, "mark", ""), False, "", 0))
        todo.extend(reversed(items))
    return out.done()


def to_text(page: str | None) -> str | None:
    return None if page is None else render(parse(page))


def extract(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """(key, text) of every page."""
    schema = T.StructType([T.StructField(id_col, key_type(pages, id_col)), T.StructField("text", T.StringType())])

    def make(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for part in tk.chunks(batch, "text"):
            yield pa.RecordBatch.from_arrays([part.column("key"), pa.array([to_text(x) for x in part.column("text").to_pylist()], pa.string())], schema.names)

    return map_arrow(two_columns(pages, id_col, html_col), make, schema)


def op9_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))
