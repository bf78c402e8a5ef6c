"""HTML to text by layout: a tree with implied tags, visibility rules, and a renderer for blocks, lists and tables.

All visible text is kept. Blocks are set apart by line breaks or blank lines, list items by their marker and indentation, table
cells are padded to aligned columns, and preformatted text keeps its spaces. Work and output grow in proportion to the page: cells of over
WIDEST characters do not widen their column, and nothing is padded beyond OFFSET characters from the left.
"""

from __future__ import annotations

import re
from html import escape, unescape

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ship, table

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*+>?|<(/?)([A-Za-z][^\s/>]*+)"
                    r"(?:((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|([^>]*+)(?:>|\Z))", re.S)
_ATTRIBUTE = re.compile(r"([^\s\"'<>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_SPACE = re.compile(r"[ \t\n\r\f]+")
_COMMENT = re.compile(r"/\*.*?(?:\*/|\Z)", re.S)
_DECLARATION = re.compile(r"((?:[^;\"'(]++|\"[^\"]*+\"?|'[^']*+'?|\([^)]*+\)?)+)")
#: Layout of tables: characters up to which a cell widens its column, characters from the left up to which is padded, cells that
#: span rows at a time (further ones are laid out as if they spanned one), tables within tables (further ones are laid out as blocks).
WIDEST, OFFSET, SPANS, NESTED = 60, 160, 200, 12

#: Element classes of the HTML standard (fixed values).
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
HIDDEN = frozenset("head script style template noscript title iframe noembed noframes datalist object audio video canvas "
                   "area base link meta param source track".split())
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl pre blockquote table figure hr fieldset".split())
BLOCK = SPACED | frozenset("html body address article aside center dd details dialog dir div dt fieldcaption figcaption "
                           "footer form header hgroup legend li main menu nav optgroup option search section summary "
                           "caption tr thead tbody tfoot".split())
#: Start tag -> open elements it closes, looked for up to the nearest of the stops.
CLOSES = {"li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
          "tr": ({"tr", "td", "th", "caption"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}),
          "th": ({"td", "th"}, {"tr", "table"}), "thead": ({"caption", "thead", "tbody", "tfoot"}, {"table"}),
          "tbody": ({"caption", "thead", "tbody", "tfoot"}, {"table"}),
          "tfoot": ({"caption", "thead", "tbody", "tfoot"}, {"table"}),
          "option": ({"option"}, {"select", "datalist", "optgroup"}), "optgroup": ({"option", "optgroup"}, {"select"}),
          "body": ({"head"}, set()), "colgroup": ({"caption"}, {"table"})}
#: What may stand in a head; any other tag, and text, ends it.
HEAD = frozenset("title meta base basefont bgsound link script style template noscript noframes".split())
#: Elements of svg and math that are not shown; those in which HTML goes on; HTML tags that end an svg or math left open.
UNSHOWN = {"svg": frozenset("desc defs metadata".split()), "math": frozenset("annotation annotation-xml mphantom".split())}
POINTS = frozenset("foreignobject desc mi mo mn ms mtext annotation-xml".split())
BREAKOUT = frozenset("b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li listing menu "
                     "meta nobr ol p pre ruby s small span strong strike sub sup table tt u ul var".split())
#: Scopes that an implied or unmatched end does not cross.
SCOPE = frozenset("td th caption table html button object template".split())
CLOSES_P = SPACED | frozenset("address article aside center details dialog dir div figcaption footer form header hgroup "
                              "main menu nav search section summary li dt dd".split())
PARENT = {"td": "tr", "th": "tr"}


class Node:
    __slots__ = ("tag", "children", "hidden", "start", "block", "inside", "shown", "span")

    def __init__(self, tag: str, hidden: bool = False, start: int = 1):
        self.tag, self.children, self.hidden, self.start, self.block = tag, [], hidden, start, tag in BLOCK
        self.inside = ""                        # the svg or math that its children belong to
        self.shown = None                       # its own visibility: its text and that of children that say nothing else
        self.span = (1, 1)                      # columns and rows of a table cell


def declarations(style: str) -> dict[str, str]:
    """Properties of a style attribute by name, in lower case; the last one counts, but for important ones."""
    found: dict[str, tuple[bool, str]] = {}
    for part in _DECLARATION.findall(_COMMENT.sub(" ", style)) if ":" in style else ():
        name, colon, value = part.partition(":")
        value, bang, word = value.strip().lower().partition("!")
        important = bang == "!" and word.strip() == "important"
        name = name.strip().lower()
        if colon and (important or not found.get(name, (False,))[0]):
            found[name] = (important, value.strip())
    return {name: value for name, (_, value) in found.items()}


def _look(node: Node, values: dict[str, str], drawn: bool) -> None:
    """Whether a node is displayed at all, and its own visibility, which children inherit unless they set theirs."""
    style = declarations(values.get("style", ""))
    display = style.get("display") or (values.get("display", "") if drawn else "")
    node.hidden |= display == "none" or "hidden" in values and not display
    visibility = style.get("visibility") or (values.get("visibility", "") if drawn else "")
    node.shown = {"visible": True, "hidden": False, "collapse": False}.get(visibility)


def _attributes(text: str) -> dict[str, str]:
    return {m[1].lower(): unescape(m[2] or m[3] or m[4] or "") for m in reversed(list(_ATTRIBUTE.finditer(text)))}


def parse(html: str) -> Node:
    """Tree of a page; end tags that HTML allows to be left out are implied, stray ones are dropped."""
    root = Node("#root")
    stack = [root]
    opened: dict[str, list[int]] = {}           # places on the stack of each open tag, and of scopes: nothing is searched for
    scopes: list[int] = []

    def push(node: Node) -> None:
        node.inside = "" if node.tag in POINTS else node.tag if node.tag in UNSHOWN else stack[-1].inside
        stack[-1].children.append(node)
        opened.setdefault(node.tag, []).append(len(stack))
        if node.tag in SCOPE:
            scopes.append(len(stack))
        stack.append(node)

    def close(k: int) -> None:
        while len(stack) > k:
            tag = stack.pop().tag
            opened[tag].pop()
            if tag in SCOPE:
                scopes.pop()

    def last(tags) -> int:
        """The highest place on the stack of any of these tags, 0 if none is open."""
        return max((opened[t][-1] for t in tags if opened.get(t)), default=0)

    def imply(tags, stops) -> None:
        k = last(tags)
        if k and k > last(stops):
            close(k)
            while len(stack) > 1 and stack[-1].tag in tags:
                close(len(stack) - 1)

    def add_text(text: str) -> None:
        if stack[-1].tag == "head" and text.strip(" \t\n\r\f"):
            close(len(stack) - 1)
        stack[-1].children.append(text)

    at, size = 0, len(html)
    while at < size:
        m = _TOKEN.search(html, at)
        if not m:
            add_text(html[at:])
            break
        if m.start() > at:
            add_text(html[at:m.start()])
        at = m.end()
        if m[2] is None:
            if m[0].startswith("<![CDATA[") and stack[-1].inside:       # text as it is
                end = html.find("]]>", m.start())
                stack[-1].children.append(escape(html[m.start() + 9:end if end >= 0 else size], quote=False))
                at = end + 3 if end >= 0 else size
            continue
        tag = m[2].lower()
        attributes = m[3] or m[4] or ""
        if m[1] and not opened.get(tag):
            if tag == "br":
                if stack[-1].tag == "head":
                    close(len(stack) - 1)
                stack[-1].children.append(Node("br"))
            continue
        if m[1]:
            k = opened[tag][-1]
            if tag in ("table", "tr", "tbody", "thead", "tfoot", "body", "html") or not scopes or k >= scopes[-1]:
                close(k)
            continue
        if stack[-1].inside and tag in BREAKOUT:
            k = len(stack)
            while stack[k - 1].inside:
                k -= 1
            close(k)
        inside = stack[-1].inside
        if stack[-1].tag == "head" and tag not in HEAD:
            close(len(stack) - 1)
        if tag in CLOSES:
            imply(*CLOSES[tag])
        if tag in CLOSES_P:
            imply({"p"}, SCOPE)
        if tag in PARENT and stack[-1].tag in ("table", "thead", "tbody", "tfoot"):
            push(Node(PARENT[tag]))
        values = _attributes(attributes) if attributes.strip() else {}
        begin = values.get("start", "")
        node = Node(tag, tag in HIDDEN or tag == "input", int(begin) if re.fullmatch(r"-?[0-9]{1,9}", begin) else 1)
        if values:
            _look(node, values, bool(inside) or tag == "svg")
        if tag in ("td", "th") and values:
            spans = (values.get(n, "") for n in ("colspan", "rowspan"))
            columns, rows = (int(x) if re.fullmatch(r"[0-9]{1,5}", x) else 1 for x in spans)
            node.span = (min(max(columns, 1), 1000), rows or 65534)
        if inside:
            node.hidden |= tag in UNSHOWN[inside]
            # labels stand apart, and so do the rows and cells of a formula
            node.block |= tag in ("text", "mtr") or tag == "tspan" and ("x" in values or "y" in values)
            if tag == "mtd":
                stack[-1].children.append(" ")
            if attributes.endswith("/"):
                stack[-1].children.append(node)
                continue
        if tag in RAW:
            stack[-1].children.append(node)
            end = re.compile(rf"</{tag}(?=[\s/>])[^>]*>", re.I).search(html, at)
            node.children.append(html[at:end.start() if end else size])
            at = end.end() if end else size
        elif tag not in VOID and not attributes.endswith("/") or tag in BLOCK - VOID:
            push(node)
        else:
            stack[-1].children.append(node)
    return root


class _Lines:
    """Text being laid out: finished lines, and the words of the line under way."""

    def __init__(self):
        self.lines: list[str] = []
        self.now: list[str] = []
        self.open = self.blank = False          # a space, a blank line is due before the next text
        self.marker, self.indent = "", 0

    def text(self, s: str) -> None:
        words = _SPACE.sub(" ", unescape(s) if "&" in s else s)
        if words == " " or not words:
            self.open |= bool(words)
            return
        if (self.open or words[0] == " ") and self.now:
            self.now.append(" ")
        self.now.append(words.strip(" "))
        self.open = words[-1] == " "

    def end_line(self, force: bool = False) -> None:
        if self.now or force:
            if self.blank and self.lines:
                self.lines.append("")
            self.blank = False
            pad = " " * max(0, self.indent - len(self.marker))
            self.lines.append((pad + self.marker + "".join(self.now)).rstrip(" "))
            self.marker = ""
        self.now, self.open = [], False

    def space(self) -> None:
        self.end_line()
        self.blank = True

    def add(self, lines: list[str]) -> None:
        self.end_line()
        if lines and self.blank and self.lines:
            self.lines.append("")
        self.blank = False
        self.lines += [(" " * self.indent + x).rstrip(" ") for x in lines]


class _Grid:
    """Cells of a table by column; cells that span rows keep their columns free below them."""

    def __init__(self):
        self.rows: list[list[tuple[int, list[str]]]] = []
        self.width: dict[int, int] = {}
        self.busy: list[list[int]] = []         # [first column, column behind, rows still spanned], by column
        self.next = 0

    def row(self) -> None:
        for b in self.busy:
            b[2] -= 1
        self.busy = [b for b in self.busy if b[2] > 0]
        self.rows.append([])
        self.next = 0

    def cell(self, lines: list[str], span: tuple[int, int]) -> None:
        if not self.rows:
            self.row()
        at = self.next
        for first, behind, _ in self.busy:
            if first <= at < behind:
                at = behind
        columns, rows = span
        self.next = at + columns
        if rows > 1 and len(self.busy) < SPANS:
            self.busy.append([at, at + columns, rows])
            self.busy.sort()
        self.width.setdefault(at, 0)
        if columns == 1:
            self.width[at] = max([self.width[at], *(len(x) for x in lines if len(x) <= WIDEST)])
        if lines:
            self.rows[-1].append((at, lines))

    def lines(self) -> list[str]:
        """A row has as many lines as its tallest cell; a line reaches to its last cell."""
        offset, at = {}, 0
        for k in sorted(self.width):
            offset[k] = min(at, OFFSET)
            at += self.width[k] + 2
        out = []
        for row in self.rows:
            made = [""] * max((len(lines) for _, lines in row), default=0)
            parts: list[list[str]] = [[] for _ in made]
            size = [0] * len(made)
            for k, lines in row:
                for n, line in enumerate(lines):
                    gap = max(offset[k] - size[n], 2 if size[n] else 0)
                    parts[n] += [" " * gap, line]
                    size[n] += gap + len(line)
            out += ["".join(p) for p in parts]
        return out


def _cell_lines(lines: list[str]) -> list[str]:
    """Lines of a cell without blank ones and without the indentation that all of them have."""
    full = [x for x in lines if x.strip()]
    common = min((len(x) - len(x.lstrip(" ")) for x in full), default=0)
    return [x[common:].rstrip(" ") for x in full]


def render(root: Node) -> str:
    """Text of a tree, walked without recursion."""
    out = _Lines()
    lists: list[list] = []                      # open lists: [ordered, next number]
    tables: list[tuple[_Grid, _Lines]] = []
    shown = [True]                              # visibility of the open nodes that set one
    pre = flat = 0                              # open pre elements; open tables that are laid out as blocks
    todo: list[tuple[bool, Node | str]] = [(True, root)]
    while todo:
        entering, node = todo.pop()
        if isinstance(node, str):
            if not shown[-1]:
                continue
            if pre:
                for k, part in enumerate(unescape(node).replace("\r\n", "\n").split("\n")):
                    if k:
                        out.end_line(force=True)
                    if part:
                        out.now.append(part)
            else:
                out.text(node)
            continue
        tag = node.tag
        if entering:
            if node.hidden:
                continue
            if tag == "br":
                out.end_line(force=True)
                continue
            if node.shown is not None:
                shown.append(node.shown)
            if tag in SPACED and not (tag in ("ul", "ol") and lists):
                out.space()
            elif node.block:
                out.end_line()
            if tag in ("ul", "ol", "menu"):
                lists.append([tag == "ol", node.start])
                out.indent += 4
            elif tag == "li":
                kind = lists[-1] if lists else [False, 0]
                out.marker = "" if not shown[-1] else f"{kind[1]}. " if kind[0] else "- "
                kind[1] += 1
            elif tag in ("dd", "blockquote"):
                out.indent += 4
            elif tag == "hr":
                out.add(["---"] if shown[-1] else [])
                out.blank = True
                if node.shown is not None:
                    shown.pop()
                continue
            elif tag == "pre":
                pre += 1
                if node.children and isinstance(node.children[0], str):
                    node.children[0] = node.children[0].removeprefix("\n")
            elif tag == "table":
                if flat or len(tables) >= NESTED:
                    flat += 1
                else:
                    tables.append((_Grid(), out))
            elif flat and tag in ("td", "th"):
                out.end_line()
            elif tag == "tr" and tables and not flat:
                tables[-1][0].row()
            elif tag in ("td", "th") and tables:
                out = _Lines()
            todo.append((False, node))
            todo += [(True, c) for c in reversed(node.children)]
            continue
        if node.shown is not None:
            shown.pop()
        if flat and tag in ("table", "td", "th"):
            flat -= tag == "table"
            out.end_line()
        elif tag == "table":
            grid, out = tables.pop()
            out.end_line()
            out.add(grid.lines())
            out.blank = True
        elif tag in ("td", "th") and tables:
            out.end_line()
            tables[-1][0].cell(_cell_lines(out.lines), node.span)
            out = tables[-1][1]
        else:
            if tag in SPACED and not (tag in ("ul", "ol") and len(lists) > 1):
                out.space()
            elif node.block:
                out.end_line()
            if tag in ("ul", "ol", "menu") and lists:
                lists.pop()
                out.indent -= 4
            elif tag in ("dd", "blockquote"):
                out.indent -= 4
            elif tag == "li":
                out.marker = ""
            elif tag == "pre":
                pre -= 1
    out.end_line()
    return "\n".join(out.lines)


def text_of(html: str | None) -> str:
    return render(parse(html)) if html else ""


def text_column(html: Column) -> Column:
    """Rendered text of an HTML column; null and empty pages give the empty text."""
    @F.arrow_udf("string")
    def of(pages: pa.Array) -> pa.Array:
        return pa.array((text_of(x.as_py()) for x in pages), pa.string())

    return of(html)


def extract_text(pages: DataFrame, html_col: str = "html", into: str = "text") -> DataFrame:
    """``pages`` with the rendered text.

    Null and empty pages give the empty text, broken markup is read as far as it goes; repeated rows render alike; an empty
    table stays empty; other columns pass through (one named as the new column is replaced).
    """
    ship(pages.sparkSession)
    return pages.withColumn(into, text_column(F.col(html_col).cast("string")))


def op3_html_text(spark, sf_dir):
    """Registered query: the text of the whole ``pages`` table."""
    return extract_text(table(spark, sf_dir, "pages").select("page_id", "url", "html")).select(
        "page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))
