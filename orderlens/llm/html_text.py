"""Layout-aware text of HTML pages: a tree builder with implied tags, and a renderer of all visible text.

The builder closes what HTML lets authors leave open (paragraphs, list items, rows, cells, options) and supplies the
rows and bodies that tables imply. The renderer walks the tree once, without recursion. It collapses white space, puts
blocks on lines of their own with blank lines around paragraphs, headings and the like, marks and indents list items,
keeps preformatted text, and lays table cells out in aligned columns, those over several columns or rows included.
Labels of drawings and formulas are text, their titles, descriptions and annotations are not.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderlens.llm.words import parts

TOKEN = re.compile(
    r"<!--.*?(?:-->|--!>|\Z)|<[!?][^>]*+(?:>|\Z)|</[a-zA-Z][^\s/>]*+[^>]*+(?:>|\Z)"
    r"|<[a-zA-Z][^\s/>]*+(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+[^>]*+(?:>|\Z)",
    re.DOTALL,
)
NAME = re.compile(r"</?([a-zA-Z][^\s/>]*)")
ATTRIBUTE = re.compile(r"""([^\s"'<>/=]++)(?:\s*+=\s*+("[^"]*+"|'[^']*+'|[^\s"'>]++))?""")
UNSEEN = re.compile(r"(?:display\s*:\s*none|visibility\s*:\s*(?:hidden|collapse))", re.IGNORECASE)

# Element names by how they behave.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
INVISIBLE = frozenset(
    "head script style template noscript noembed noframes iframe object audio video canvas title datalist "
    "desc metadata defs symbol annotation annotation-xml".split()
)
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl pre blockquote table figure form fieldset hr article section".split())
BLOCKS = SPACED | frozenset(
    "html body div li dt dd address aside nav header footer main center figcaption legend details summary dialog menu "
    "search hgroup option optgroup tr td th thead tbody tfoot caption svg text".split()
)
CLOSES_PARAGRAPH = SPACED | frozenset(
    "div address aside nav header footer main center figcaption details summary dialog menu search hgroup li dt dd".split()
)
# What a start tag closes first, and the elements beyond which it does not look.
CLOSED_BY = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "option": ({"option"}, {"select", "datalist"}),
    "optgroup": ({"option", "optgroup"}, {"select"}),
    "tr": ({"tr", "td", "th", "caption", "colgroup"}, {"table"}),
    "td": ({"td", "th", "caption"}, {"table", "tr"}),
    "th": ({"td", "th", "caption"}, {"table", "tr"}),
    "thead": ({"tr", "td", "th", "thead", "tbody", "tfoot", "caption"}, {"table"}),
    "tbody": ({"tr", "td", "th", "thead", "tbody", "tfoot", "caption"}, {"table"}),
    "tfoot": ({"tr", "td", "th", "thead", "tbody", "tfoot", "caption"}, {"table"}),
    "body": ({"head"}, {"html"}),
}
CELLS = frozenset({"td", "th"})
BARRIERS = frozenset({"td", "th", "caption", "table"})
HEAD_ONLY = frozenset("base link meta title style script noscript template head html".split())


MOST_COLUMNS, MOST_ROWS = 1000, 65534  # that a cell may span


class Node:
    __slots__ = ("tag", "hidden", "children", "start", "span")

    def __init__(self, tag: str, hidden: bool = False, start: int = 1, span: tuple[int, int] = (1, 1)):
        self.tag, self.hidden, self.start, self.span = tag, hidden, start, span
        self.children: list[Node | str] = []


def spanned(given: dict[str, str]) -> tuple[int, int]:
    """Columns and rows of a cell; 0 rows are all that follow. What is no number is 1."""
    columns, rows = (given.get(name, "1").strip() for name in ("colspan", "rowspan"))
    wide = int(columns) if re.fullmatch("[0-9]{1,9}", columns) else 1
    high = int(rows) if re.fullmatch("[0-9]{1,9}", rows) else 1
    return min(max(wide, 1), MOST_COLUMNS), min(high, MOST_ROWS) or MOST_ROWS


def tokens(page: str) -> Iterator[tuple[str, str]]:
    """(kind, content): text, start or end tags; comments and declarations are left out."""
    at, lowered = 0, None
    while at < len(page):
        found = TOKEN.search(page, at)
        if not found:
            yield "text", page[at:]
            return
        if found.start() > at:
            yield "text", page[at : found.start()]
        tag, at = found.group(), found.end()
        if tag[1:2] in "!?":
            continue
        if tag[1] == "/":
            yield "end", tag
            continue
        yield "start", tag
        name = NAME.match(tag).group(1).lower()
        if name in RAW:
            lowered = page.lower() if lowered is None else lowered
            stop = lowered.find(f"</{name}", at) if len(lowered) == len(page) else -1
            if stop < 0 and len(lowered) != len(page):
                again = re.compile(f"</{name}", re.IGNORECASE).search(page, at)
                stop = again.start() if again else -1
            stop = len(page) if stop < 0 else stop
            if stop > at:
                yield "text", page[at:stop]
            at = stop


def attributes(tag: str) -> dict[str, str]:
    inner = tag[NAME.match(tag).end() :].rstrip(">")
    return {name.lower(): unescape(value.strip("\"'")) for name, value in ATTRIBUTE.findall(inner)}


def build(page: str) -> Node:
    """The tree of a page. Bad nesting never fails: end tags without a start are ignored, the rest is closed at the end."""
    root = Node("html")
    stack = [root]
    open_tags: dict[str, int] = {"html": 1}

    def push(node: Node) -> None:
        stack[-1].children.append(node)
        stack.append(node)
        open_tags[node.tag] = open_tags.get(node.tag, 0) + 1

    def pop_to(size: int) -> None:
        while len(stack) > size:
            open_tags[stack.pop().tag] -= 1

    def close(names: set[str] | frozenset[str], limits: set[str] | frozenset[str]) -> None:
        """Close the outermost open element of ``names`` that stands inside the nearest of ``limits``."""
        if not any(open_tags.get(name) for name in names):
            return
        cut = None
        for i in range(len(stack) - 1, 0, -1):
            if stack[i].tag in limits:
                break
            if stack[i].tag in names:
                cut = i
        if cut is not None:
            pop_to(cut)

    for kind, content in tokens(page):
        if kind == "text":
            if stack[-1].tag == "head" and not content.isspace():
                close({"head"}, set())
            stack[-1].children.append(content)
            continue
        name = NAME.match(content).group(1).lower()
        if kind == "end":
            if name == "p" and not open_tags.get("p"):
                stack[-1].children.append(Node("p"))
            elif name == "br":
                stack[-1].children.append(Node("br"))
            elif name not in ("html", "body") and open_tags.get(name):
                limits = BARRIERS - {name} if name not in ("table", "tr", "thead", "tbody", "tfoot") else {"table"} - {name}
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i].tag == name:
                        pop_to(i)
                        break
                    if stack[i].tag in limits:
                        break
            continue
        if name == "html":
            continue
        if open_tags.get("head") and name not in HEAD_ONLY:
            close({"head"}, set())
        if name in CLOSES_PARAGRAPH and open_tags.get("p"):
            close({"p"}, BARRIERS)
        if name in CLOSED_BY:
            close(*CLOSED_BY[name])
        if name in CELLS and open_tags.get("table") and stack[-1].tag in ("table", "thead", "tbody", "tfoot"):
            push(Node("tr"))
        plain = content.find("=") < 0 and content.find(" hidden") < 0
        given = {} if plain else attributes(content)
        hidden = name in INVISIBLE or "hidden" in given or bool(UNSEEN.search(given.get("style", "")))
        start = given.get("start", "1")
        first = int(start) if name == "ol" and re.fullmatch(r"-?[0-9]{1,9}", start) else 1
        node = Node(name, hidden, first, spanned(given) if name in CELLS else (1, 1))
        if name in VOID:
            stack[-1].children.append(node)
        elif not (name == "body" and open_tags.get("body")):
            push(node)
    return root


class Canvas:
    """Lines of text under construction; spaces collapse, and breaks between blocks are made when text follows."""

    def __init__(self) -> None:
        self.lines: list[str] = []
        self.parts: list[str] = []
        self.gap = 0  # blank lines owed before the next text, plus one if the current line must end
        self.space = False
        self.indent = ""
        self.mark = ""

    def finish_line(self) -> None:
        if self.parts:
            self.lines.append("".join(self.parts).rstrip())
            self.parts = []
        self.space = False

    def block(self, gap: int) -> None:
        self.finish_line()
        self.gap = max(self.gap, gap)

    def line_break(self) -> None:
        if self.parts:
            self.finish_line()
        elif self.lines and not self.gap:
            self.lines.append("")

    def _begin(self) -> None:
        if not self.parts:
            if self.gap and self.lines:
                self.lines += [""] * (self.gap - 1)
            self.gap = 0
            self.parts.append(self.indent + self.mark)
            self.mark = ""
            self.space = False

    def text(self, content: str) -> None:
        words = content.split()
        if words:
            fresh = not self.parts
            self._begin()
            if not fresh and (self.space or content[0].isspace()):
                self.parts.append(" ")
            self.parts.append(" ".join(words))
            self.space = content[-1].isspace()
        elif content:
            self.space = True

    def preformatted(self, content: str) -> None:
        """Text as it is. It goes on in the current line; the first line end of a block is dropped."""
        for i, line in enumerate(content.split("\n")):
            if i and self.parts:
                self.finish_line()
            elif i and not self.gap:
                self.lines.append("")
            if line:
                self._begin()
                self.parts.append(line)

    def exact(self, lines: list[str]) -> None:
        """Whole lines as they are."""
        self.finish_line()
        for i, line in enumerate(lines):
            if line or self.gap == 0 or i:
                self._begin()
                self.parts.append(line)
                self.lines.append("".join(self.parts).rstrip())
                self.parts = []

    def done(self) -> list[str]:
        self.finish_line()
        first, last = 0, len(self.lines)
        while first < last and not self.lines[first]:
            first += 1
        while last > first and not self.lines[last - 1]:
            last -= 1
        return self.lines[first:last]


Cell = tuple[list[str], int, int]  # lines, columns, rows


def placed(rows: list[list[Cell]]) -> list[list[tuple[int, Cell]]]:
    """The cells of every row with their first column, beside cells that reach down from rows above."""
    down: dict[int, int] = {}  # column -> rows for which it is still taken
    out = []
    for row in rows:
        taken, down = down, {column: left - 1 for column, left in down.items() if left > 1}
        own, at = [], 0
        for cell in row:
            _, wide, high = cell
            while any(column in taken for column in range(at, at + wide)):
                at += 1
            own.append((at, cell))
            if high > 1:
                down |= dict.fromkeys(range(at, at + wide), high - 1)
            at += wide
        out.append(own)
    return out


def aligned(rows: list[list[Cell]]) -> list[str]:
    """Lines of a table, with every column as wide as its widest line. A cell over several columns widens the last of them
    if it needs to; a cell over several rows stands in the first.
    """
    table = placed(rows)
    widths: dict[int, int] = {}
    for at, (lines, wide, _) in sorted((one for row in table for one in row), key=lambda one: (one[1][1], one[0])):
        room = sum(widths.get(at + i, 0) for i in range(wide)) + 2 * (wide - 1)
        last = at + wide - 1
        widths[last] = widths.get(last, 0) + max(0, max(map(len, lines), default=0) - room)
    starts, place = [], 0
    for i in range(max(widths, default=-1) + 1):
        starts.append(place)
        place += widths.get(i, 0) + 2
    out = []
    for row in table:
        for k in range(max((len(lines) for _, (lines, _, _) in row), default=0)):
            line = ""
            for at, (lines, _, _) in row:
                if k < len(lines):
                    line = line.ljust(starts[at]) + lines[k]
            out.append(line.rstrip())
    return out


def render(page: str | None) -> str:
    """All visible text of a page; null and empty pages have none."""
    canvases = [Canvas()]
    tables: list[list[list[Cell]]] = []
    lists: list[list] = []
    pre = 0
    walk: list[tuple[Node, bool]] = [(build(page or ""), False)]
    while walk:
        node, leaving = walk.pop()
        canvas = canvases[-1]
        if isinstance(node, str):
            content = unescape(node)
            if not pre:
                canvas.text(content)
            elif content:
                canvas.preformatted(content)
            continue
        tag = node.tag
        if node.hidden:
            continue
        in_table = bool(tables)
        gap = 2 if tag in SPACED and not (tag in ("ul", "ol") and len(lists) > leaving) else 1
        if not leaving:
            if tag == "br":
                canvas.line_break()
                continue
            if tag in CELLS and in_table:
                canvases.append(Canvas())
            elif tag in BLOCKS:
                canvas.block(gap)
            if tag == "table":
                tables.append([])
                canvases.append(Canvas())  # text astray between cells
            elif tag == "tr" and in_table:
                tables[-1].append([])
            elif tag in ("ul", "ol", "menu"):
                lists.append([tag, node.start, canvas.indent, canvas])
                if len(lists) > 1 and lists[-2][3] is canvas:
                    canvas.indent += "  "
            elif tag == "li":
                if lists and lists[-1][0] == "ol":
                    canvas.mark = f"{lists[-1][1]}. "
                    lists[-1][1] += 1
                else:
                    canvas.mark = "- "
            elif tag == "pre":
                pre += 1
            walk.append((node, True))
            walk += [(child, False) for child in reversed(node.children)]
            continue
        if tag in CELLS and in_table:
            cell = canvases.pop().done()
            if not tables[-1]:
                tables[-1].append([])
            tables[-1][-1].append((cell, *node.span))
            continue
        if tag == "table":
            astray = canvases.pop().done()
            rows = tables.pop()
            canvas = canvases[-1]
            canvas.exact(astray + aligned(rows))
        elif tag in ("ul", "ol", "menu"):
            canvas.finish_line()
            canvas.indent = lists.pop()[2]
            canvas.mark = ""
        elif tag == "li":
            canvas.finish_line()
            canvas.mark = ""
        elif tag == "pre":
            pre -= 1
        if tag in BLOCKS:
            canvas.block(gap)
    return "\n".join(canvases[0].done())


def extract_text(pages: DataFrame, keep: tuple[str, ...] = ("page_id",), html: str = "html") -> DataFrame:
    """The columns in ``keep``, the ``text`` of each page, and ``n_chars``.

    One row per input row, repeated rows included. Null, empty and textless pages have the text "". Unclosed, misnested
    and unknown elements are tolerated; whole pages are rendered, whatever their length. Other columns are ignored.
    """
    fields = [T.StructField(f"k{i}", pages.schema[name].dataType) for i, name in enumerate(keep)]
    schema = T.StructType([*fields, T.StructField("body", T.StringType())])

    def run(batches) -> Iterator:
        import pyarrow as pa

        for batch in parts(batches):
            texts = [render(page) for page in batch.column(len(keep)).to_pylist()]
            arrays = [*(batch.column(i) for i in range(len(keep))), pa.array(texts, pa.string())]
            yield pa.RecordBatch.from_arrays(arrays, names=[f.name for f in schema])

    named = pages.select(*(F.col(f"`{name}`").alias(f"k{i}") for i, name in enumerate(keep)), F.col(f"`{html}`").alias("page"))
    done = named.mapInArrow(run, schema)
    return done.select(
        *(F.col(f"k{i}").alias(name) for i, name in enumerate(keep)),
        F.length("body").cast("long").alias("n_chars"),
        F.col("body").alias("text"),
    )
