"""Text of web pages as a browser lays it out: a tree with implied tags, then rendering of what is visible."""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .storage import prepare
from .words import groups

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is text up to their end tag.
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
HIDDEN = frozenset("head script style template noscript iframe object audio video canvas datalist noembed noframes title".split())
#: Cells of a table are aligned up to so many characters, and blocks are indented by so many of those around them.
ALIGNED = 60
INDENTS = 30
#: What an image or a formula hides.
DRAWING = {
    "svg": frozenset("defs desc metadata symbol clippath mask pattern marker lineargradient radialgradient filter".split()),
    "math": frozenset(["annotation", "annotation-xml"]),
}
_UNSEEN = frozenset().union(*DRAWING.values())
#: Elements that stand apart from what is beside them.
APART = frozenset(["text", "mtr", "mtd"])
#: Kinds of inputs that show their value.
BUTTONS = frozenset(["submit", "button", "reset"])
#: All that may stand in a head; other elements and text end it.
IN_HEAD = frozenset("base basefont bgsound link meta title noscript noframes style script template".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol option p pre section select summary table ul caption".split()
)
#: Blocks with an empty line before and after.
SPACED = frozenset("blockquote dl figure h1 h2 h3 h4 h5 h6 menu ol p pre table ul".split())
LISTS = frozenset(("ul", "ol", "menu"))
#: What an opening tag ends, and the elements beyond which it ends nothing.
CLOSES: dict[str, tuple[frozenset, frozenset]] = {
    "li": (frozenset(["li"]), LISTS),
    "dt": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "dd": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "tr": (frozenset(["tr", "td", "th", "caption", "colgroup"]), frozenset(["table"])),
    "td": (frozenset(["td", "th"]), frozenset(["tr", "table"])),
    "th": (frozenset(["td", "th"]), frozenset(["tr", "table"])),
    "option": (frozenset(["option"]), frozenset(["select", "datalist"])),
    "optgroup": (frozenset(["option", "optgroup"]), frozenset(["select"])),
} | {
    t: (frozenset(["thead", "tbody", "tfoot", "tr", "td", "th", "caption", "colgroup"]), frozenset(["table"]))
    for t in ("thead", "tbody", "tfoot", "caption", "colgroup")
}
#: Elements below which only parts of tables stand; all else that is found there stands before the table.
TABLE_PARTS = frozenset("table thead tbody tfoot tr colgroup".split())
CELLS = frozenset(["td", "th", "caption"])
_IN_TABLE = TABLE_PARTS | CELLS | {"col"}
_ENDS_P = BLOCK - {"body", "html", "option", "caption", "select"}
_P_SCOPE = frozenset(["table", "td", "th", "caption", "button", "object", "body", "html"])

_MARKUP = re.compile(
    r"<!--(?:-?>|.*?(?:--!?>|\Z))|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>?|"
    # a quote opens a value only after '='
    r"<(/?)([a-zA-Z][^\s/>]*)((?:[^>=]+|=\s*(?:\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z)|[^\s>]*))*)>?",
    re.S,
)
_ATTRIBUTE = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(\"[^\"]*\"?|'[^']*'?|[^\s>]+))?")
_SPACES = re.compile(r"[ \t\n\r\f]+")
_INVISIBLE = re.compile(r"display\s*:\s*none|visibility\s*:\s*(?:hidden|collapse)", re.I)
_RAW_END = {t: re.compile(rf"</{t}(?=[\s/>])", re.I) for t in RAW}


class Node:
    __slots__ = ("tag", "attributes", "children")

    def __init__(self, tag: str, attributes: str = "") -> None:
        self.tag, self.attributes = tag, attributes
        self.children: list = []  # nodes and strings

    def attribute(self, name: str) -> str | None:
        """Its value; empty if it has none; null if it is missing."""
        if name not in self.attributes.lower():
            return None
        for key, value in _ATTRIBUTE.findall(self.attributes):
            if key.lower() == name:
                return entities.unescape(value.strip("\"'"))
        return None

    def hidden(self) -> bool:
        if self.tag in HIDDEN or self.tag == "dialog" and self.attribute("open") is None:
            return True
        if not self.attributes:
            return False
        if self.tag == "input" and (self.attribute("type") or "").strip().lower() not in BUTTONS or self.attribute("hidden") is not None:
            return True
        return bool(_INVISIBLE.search(self.attribute("style") or ""))


class Open:
    """The open elements of a page, the innermost last, and where those of each tag stand."""

    def __init__(self, root: Node) -> None:
        self.nodes = [root]
        self.places: dict[str, list[int]] = {root.tag: [0]}

    def __getitem__(self, place: int) -> Node:
        return self.nodes[place]

    def __len__(self) -> int:
        return len(self.nodes)

    def append(self, node: Node) -> None:
        self.places.setdefault(node.tag, []).append(len(self.nodes))
        self.nodes.append(node)

    def pop(self) -> Node:
        node = self.nodes.pop()
        self.places[node.tag].pop()
        return node

    def keep(self, n: int) -> None:
        """End all but the outermost n."""
        while len(self.nodes) > n:
            self.pop()

    def innermost(self, tags: frozenset) -> int:
        """Place of the innermost of these; -1 if none is open."""
        found, places = -1, self.places
        for tag in tags:
            own = places.get(tag)
            if own and own[-1] > found:
                found = own[-1]
        return found


def parse(page: str) -> Node:
    """The tree of a page. End tags that are missing or wrong are mended as browsers do. The time for a tag does
    not grow with the depth at which it stands."""
    root = Node("html")
    stack = Open(root)
    at = 0

    def text(piece: str) -> None:
        if piece.strip():
            if stack[-1].tag == "head":
                stack.pop()
            _insert(stack, piece)
        elif piece:
            stack[-1].children.append(piece)

    while at < len(page):
        found = _MARKUP.search(page, at)
        if not found:
            text(entities.unescape(page[at:]))
            break
        text(entities.unescape(page[at : found.start()]))
        at = found.end()
        end, tag, attributes = found.groups()
        if tag is None:
            if found[0].startswith("<![CDATA["):
                text(found[0][9:].removesuffix("]]>"))
            continue
        tag = tag.lower()
        if end:
            if tag == "p" and not _in_scope(stack, frozenset(["p"]), _P_SCOPE):
                _insert(stack, Node("p"))  # an end without a beginning is an empty paragraph
            else:
                scope = frozenset(["table"]) if tag not in ("table", "body", "html") else frozenset()
                if _in_scope(stack, frozenset([tag]), scope) and tag != "html":
                    while stack[-1].tag != tag:
                        stack.pop()
                    stack.pop()
            continue
        if tag == "html" or tag == "body" and stack.places.get("body"):
            continue
        if tag == "head" and any(isinstance(c, Node) or c.strip() for c in root.children):
            continue  # not at the beginning
        if tag == "body":  # ends the head
            stack.keep(1)
        if tag in _ENDS_P and _in_scope(stack, frozenset(["p"]), _P_SCOPE):
            _close(stack, frozenset(["p"]), _P_SCOPE)
        if tag in CLOSES:
            _close(stack, *CLOSES[tag])
        if tag in _IN_TABLE:
            place = _table_place(stack)
            if place is not None:
                stack.keep(place + 1)  # ends what stands before the table
                if tag == "table":  # not in a cell: ends the table
                    while stack.pop().tag != "table":
                        pass
                elif stack[-1].tag == "colgroup" and tag != "col":
                    stack.pop()
        if tag in ("td", "th") and stack[-1].tag in ("table", "tbody", "thead", "tfoot"):
            _open(stack, Node("tr"))
        if stack[-1].tag == "head" and tag not in IN_HEAD:
            stack.pop()
        node = Node(tag, attributes)
        if tag in _IN_TABLE:
            stack[-1].children.append(node)
        else:
            _insert(stack, node)
            if tag == "form" and _table_of(stack, len(stack) - 1):  # empty: rows that follow are the table's
                continue
        if tag in RAW:
            close = _RAW_END[tag].search(page, at)
            stop = close.start() if close else len(page)
            raw = page[at:stop]
            node.children.append(entities.unescape(raw) if tag in ("textarea", "title") else raw)
            ending = page.find(">", stop)
            at = ending + 1 if close and ending >= 0 else len(page)
        elif tag not in VOID and not attributes.endswith("/"):
            stack.append(node)
    return root


def _open(stack: Open, node: Node) -> None:
    stack[-1].children.append(node)
    stack.append(node)


def _table_of(stack: Open, place: int) -> int:
    """Place of the table that the node at ``place`` is or is a part of, without a cell in between; 0 if there is none."""
    while stack[place].tag in TABLE_PARTS:
        if stack[place].tag == "table":
            return place
        place -= 1
    return 0


def _table_place(stack: Open) -> int | None:
    """Place of the innermost part of a table, if no cell is open in it."""
    place = stack.innermost(TABLE_PARTS)
    if place < 1 or stack.innermost(CELLS) > place:
        return None
    return place if _table_of(stack, place) else None


def _insert(stack: Open, child: Node | str) -> None:
    """Below the last open node; before the table if that is one or a part of one other than a cell."""
    table = _table_of(stack, len(stack) - 1)
    if table:
        above = stack[table - 1].children
        above.insert(len(above) - 1, child)  # an open table is the last child
    else:
        stack[-1].children.append(child)


def _in_scope(stack: Open, tags: frozenset, scope: frozenset) -> bool:
    """Whether one of the tags is open, with none of the scope inside it."""
    place = stack.innermost(tags)
    return place >= 0 and place > stack.innermost(scope)


def _close(stack: Open, tags: frozenset, scope: frozenset) -> None:
    while len(stack) > 1 and _in_scope(stack, tags, scope):
        stack.pop()


class _Page:
    """Lines in the making."""

    def __init__(self) -> None:
        self.lines: list[str] = []
        self.line: list[str] = []
        self.space = self.gap = False
        self.prefix: list[str] = []  # indents of the open blocks
        self.marker = ""

    def write(self, piece: str, pre: bool) -> None:
        if pre:
            first, *rest = piece.split("\n")
            self._put(first)
            for more in rest:
                self.end(True)
                self._put(more)
            return
        words = _SPACES.sub(" ", piece)
        if words.startswith(" "):
            self.space = True
            words = words[1:]
        if not words:
            return
        trailing = words.endswith(" ")
        self._put(words.rstrip(" "))
        self.space = trailing

    def _put(self, piece: str) -> None:
        if not piece:
            return
        if self.line:
            self.line.append(" " if self.space else "")
        else:
            if self.gap and self.lines:
                self.lines.append("")
            self.gap = False
            self.line.append("".join(self.prefix[:INDENTS]) + self.marker)
            if self.marker:
                self.prefix[-1] = " " * len(self.marker)
                self.marker = ""
        self.line.append(piece)
        self.space = False

    def end(self, always: bool = False) -> None:
        if self.line or always:
            self.lines.append("".join(self.line).rstrip())
        self.line, self.space = [], False


def _cells(table: Node) -> list[list[Node]]:
    """Visible cells of the rows of a table, not those of tables inside."""
    rows: list[list[Node]] = []
    stack = [iter(table.children)]
    while stack:
        node = next(stack[-1], None)
        if node is None:
            stack.pop()
        elif isinstance(node, Node) and not node.hidden():
            if node.tag == "tr":
                rows.append([c for c in node.children if isinstance(c, Node) and c.tag in ("td", "th") and not c.hidden()])
            elif node.tag in ("thead", "tbody", "tfoot"):
                stack.append(iter(node.children))
    return rows


def render(root: Node) -> str:
    """Visible text: blocks on lines of their own, an empty line around paragraphs, lists and the like, list
    items with a dash or number, cells of a table in aligned columns. The tree may be of any depth."""
    page = _Page()
    # (node, place among its children, preformatted, number of the next list item)
    stack: list[list] = []
    opened: Counter = Counter()  # tags of the stack
    lists: list[list] = []  # frames of lists
    outer: list[tuple] = []  # tables that wait for a cell to be rendered

    def push(frame: list) -> None:
        stack.append(frame)
        opened[frame[0].tag] += 1
        if frame[0].tag in LISTS:
            lists.append(frame)

    def pop() -> None:
        tag = stack.pop()[0].tag
        opened[tag] -= 1
        if tag in LISTS:
            lists.pop()

    def enter(node: Node, pre: bool) -> None:
        if node.tag == "br":
            page.end(True)
            return
        if node.tag == "input":
            page.write(f" {node.attribute('value') or ''} ", False)
            return
        page.space |= node.tag in APART
        if node.tag in BLOCK:
            page.end()
            page.gap |= node.tag in SPACED and not (node.tag in LISTS and opened["li"])
        if node.tag == "table":
            rows = _cells(node)
            loose = [c for c in node.children if isinstance(c, Node) and c.tag == "caption" and not c.hidden()]
            push([node, 0, pre, 1, (rows, [[] for _ in rows], loose, [0])])
            return
        if node.tag == "li":
            parent = lists[-1] if lists else None
            if parent is not None and parent[0].tag == "ol":
                page.marker = f"{parent[3]}. "
                parent[3] += 1
            else:
                page.marker = "- "
            page.prefix.append("")
        elif node.tag in ("blockquote", "dd"):
            page.prefix.append("  ")
        start = node.attribute("start") if node.tag == "ol" else None
        number = int(start) if start and re.fullmatch("[0-9]{1,9}", start) else 1
        push([node, 0, pre or node.tag in ("pre", "textarea"), number, None])

    def unseen(node: Node) -> bool:
        return node.tag in _UNSEEN and any(opened[tag] and node.tag in inside for tag, inside in DRAWING.items())

    def leave(node: Node) -> None:
        page.space |= node.tag in APART
        if node.tag in BLOCK:
            page.end()
            page.gap |= node.tag in SPACED and not (node.tag in LISTS and opened["li"])
        if node.tag == "li":
            page.prefix.pop()
            page.marker = ""
        elif node.tag in ("blockquote", "dd"):
            page.prefix.pop()

    enter(root, False)
    while stack:
        frame = stack[-1]
        node, place, pre, _, table = frame
        if table is not None:  # captions, then cells one by one, each on a page of its own
            rows, done, captions, at = table
            if captions:
                enter(captions.pop(0), pre)
                continue
            while at[0] < len(rows) and len(done[at[0]]) == len(rows[at[0]]):
                at[0] += 1
            if at[0] < len(rows):
                row = at[0]
                outer.append((page, frame, row))
                page = _Page()
                push([Node("#cell"), 0, False, 1, None])
                stack[-1][0].children = rows[row][len(done[row])].children
                continue
            pop()
            _write_table(page, [d for d in done if d])
            leave(node)
            continue
        if place >= len(node.children):
            pop()
            if node.tag == "#cell":
                page.end()
                content = page.lines
                page, waiting, row = outer.pop()
                waiting[4][1][row].append(" ".join(line.strip() for line in content if line.strip()))
            else:
                leave(node)
            continue
        frame[1] += 1
        child = node.children[place]
        if isinstance(child, str):
            page.write(child, pre)
        elif not child.hidden() and not unseen(child):
            enter(child, pre)
    page.end()
    return "\n".join(page.lines).strip("\n")


def _write_table(page: _Page, rows: list[list[str]]) -> None:
    """Columns as wide as their widest cell of at most ALIGNED characters; a longer cell runs over, so that the
    text of a table is no more than its cells and ALIGNED characters for each."""
    widths: list[int] = []
    for row in rows:
        widths += [0] * (len(row) - len(widths))
        for k, cell in enumerate(row):
            if len(cell) <= ALIGNED:
                widths[k] = max(widths[k], len(cell))
    for row in rows:
        page.write("  ".join(cell.ljust(width) for cell, width in zip(row, widths)).rstrip() or " ", True)
        page.end()


def page_text(page: str) -> str:
    return render(parse(page))


def extract_text(pages: DataFrame, html: str = "html") -> DataFrame:
    """``pages`` with a further column ``text`` in place of the raw ``html``; a column named ``text`` is replaced.

    Any bytes are a page: missing and wrong tags are mended. A null page has a null text, an empty one an
    empty text. Every row gives a row; an empty table stays empty. Other columns may have any names.
    """
    prepare(pages.sparkSession)
    kept = [c for c in pages.columns if c not in (html, "text")]
    columns = [F.col(f"`{c.replace('`', '``')}`") for c in kept]
    given = pages.select(F.struct(*columns).alias("kept"), F.col(html).alias("html"))
    if not kept:
        given = pages.select(F.struct(F.lit(0).alias("none")).alias("kept"), F.col(html).alias("html"))

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            valid = batch.column(1).is_valid().to_pylist()
            for first, texts in groups(batch, "html"):
                found = [page_text(t.decode()) if valid[first + i] else None for i, t in enumerate(texts)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, len(texts)), pa.array(found, pa.string())], ["kept", "text"])

    schema = T.StructType([given.schema["kept"], T.StructField("text", T.StringType())])
    rendered = given.mapInArrow(compute, schema)
    return rendered.select(*[F.col("kept")[c].alias(c) for c in kept], "text")


def op5_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_text(spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html"))
