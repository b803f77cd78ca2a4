"""Visible text of web pages by layout-aware rendering.

A tree is built from the markup with implied start and end tags. A walk over the visible part of
the tree then lays text out: paragraphs are parted by blank lines, list items are marked and
indented, table cells stand in aligned columns.
"""

from __future__ import annotations

import html
import re

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sequora.llm.common import slices, table

# Fixed values of HTML: element classes that decide nesting and layout.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style xmp iframe noembed noframes textarea title".split())
UNSEEN = frozenset("head script style template noscript title meta link base datalist iframe noembed noframes object video audio canvas annotation annotation-xml".split())
BLOCK = frozenset("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search section select summary table ul".split())
SPACED = frozenset("blockquote dl figure h1 h2 h3 h4 h5 h6 ol p pre table ul menu dir".split())
ENDS_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre search section table ul li dd dt".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
LISTS = frozenset("ul ol menu dir".split())
ROW_GROUPS = frozenset("thead tbody tfoot".split())
CELLS = frozenset("td th".split())
#: What a start tag ends, and where looking for it stops.
ENDS = {
    "li": (frozenset(["li"]), frozenset("ul ol menu dir table td th".split())),
    "dt": (frozenset("dt dd".split()), frozenset("dl table td th".split())),
    "dd": (frozenset("dt dd".split()), frozenset("dl table td th".split())),
    "option": (frozenset(["option"]), frozenset("select datalist optgroup".split())),
    "optgroup": (frozenset("option optgroup".split()), frozenset("select datalist".split())),
    "tr": (frozenset("tr td th caption colgroup".split()), frozenset(["table"])),
    "td": (frozenset("td th caption colgroup".split()), frozenset("table tr".split())),
    "th": (frozenset("td th caption colgroup".split()), frozenset("table tr".split())),
    "thead": (frozenset("thead tbody tfoot tr td th caption colgroup".split()), frozenset(["table"])),
    "tbody": (frozenset("thead tbody tfoot tr td th caption colgroup".split()), frozenset(["table"])),
    "tfoot": (frozenset("thead tbody tfoot tr td th caption colgroup".split()), frozenset(["table"])),
    "body": (frozenset(["head"]), frozenset()),
}
P_STOPS = frozenset("table td th caption button html".split())
#: Where an end tag stops looking for its start.
END_STOPS = (frozenset(["html"]), frozenset("html table".split()), frozenset("html table td th caption".split()))
ENDED_BY_TABLE_PARTS = CELLS | ROW_GROUPS | {"tr", "caption"}
AROUND_ROWS = ROW_GROUPS | {"table"}
#: Each rule of ENDS, and that of p, has a bit that says whether one of its elements is open within its stops.
RULES = [*dict.fromkeys(ENDS.values()), (frozenset(["p"]), P_STOPS)]
P_RULE = len(RULES) - 1
TABLE_PARTS = frozenset("caption col colgroup tbody td tfoot th thead tr".split())
IN_HEAD = frozenset("base link meta title style script template noscript".split())

#: Drawings and formulas: where HTML goes on inside them, what starts there end them, what shows text in a drawing, and what never does.
FOREIGN = ("svg", "math")
HTML_AGAIN = "foreignobject desc title mi mo mn ms mtext annotation-xml".split()
ENDS_FOREIGN = frozenset("b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li listing menu meta nobr ol p pre ruby s small span strong strike sub sup table tt u ul var".split())
DRAWN_TEXT = frozenset("text foreignobject".split())
NOT_DRAWN = frozenset("desc metadata defs symbol clippath mask pattern marker filter lineargradient radialgradient".split())
NAMED_IN_FOREIGN = UNSEEN | DRAWN_TEXT | NOT_DRAWN | frozenset([*FOREIGN, *HTML_AGAIN])

MARKUP = re.compile(r"<!--.*?(?:--!?>|\Z)|<[!?][^>]*>?|</([a-zA-Z][^\s/>]*)[^>]*>?|<([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)", re.DOTALL)
ATTRIBUTE = re.compile(r"([^\s=\"'/>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
SPACE = re.compile(r"[ \t\n\f\r]+")
UNQUOTED_END = re.compile(r"=\s*[^\s\"'=]+\Z")
CSS_COMMENT = re.compile(r"/\*.*?(?:\*/|\Z)", re.DOTALL)
NO_BOX = re.compile(r"(?:^|;)\s*display\s*:\s*none\b", re.IGNORECASE)
VISIBILITY = re.compile(r"(?:^|;)\s*visibility\s*:\s*(visible|hidden|collapse)\b", re.IGNORECASE)
WHOLE_NUMBER = re.compile(r"\s*([+-]?[0-9]{1,9})(?![0-9])")


class Node:
    __slots__ = ("tag", "attrs", "children", "parent", "depth", "open", "stops")

    def __init__(self, tag: str, attrs: str = "", parent: Node | None = None):
        self.tag, self.attrs, self.parent, self.children = tag, attrs, parent, []
        self.depth = parent.depth + 1 if parent else 0
        self.open, self.stops = parent.open if parent else 0, parent.stops if parent else (0, 0, 0)
        if tag in MARKS:
            keep, add, stops = MARKS[tag]
            self.open = self.open & keep | add
            if any(stops):
                self.stops = tuple(self.depth if x else old for x, old in zip(stops, self.stops, strict=True))

    def attributes(self) -> dict[str, str]:
        return {m[1].lower(): html.unescape(m[2] or m[3] or m[4] or "") for m in reversed(list(ATTRIBUTE.finditer(self.attrs)))} if self.attrs.strip() else {}


def _marks(tag: str) -> tuple[int, int, tuple[bool, ...]]:
    """For a tag that opens: the rules whose bits stay, those whose bits are set, and the end stops that it is."""
    keep = sum(1 << k for k, (_, stop) in enumerate(RULES) if tag not in stop)
    return keep, sum(1 << k for k, (tags, _) in enumerate(RULES) if tag in tags), tuple(tag in stop for stop in END_STOPS)


MARKS = {tag: _marks(tag) for tag in {t for tags, stop in RULES for t in tags | stop} | END_STOPS[2]}


class TreeBuilder:
    """Builds a tree from start tags, end tags and text in the order of the page.

    Each node knows which rules have an element open around it and where an end tag stops looking, and
    the open elements are listed by tag, so no step walks past elements that it doesn't close.
    """

    def __init__(self):
        self.root = Node("html")
        self.head, self.body = None, None
        self.here = self.root
        self.listed: dict[str, list[Node]] = {}

    def _open(self, tag: str, attrs: str = "") -> Node:
        node = Node(tag, attrs, self.here)
        self.here.children.append(node)
        self.here = node
        self.listed.setdefault(tag, []).append(node)
        return node

    def _back_to(self, node: Node) -> None:
        while self.here is not node:
            self.listed[self.here.tag].pop()
            self.here = self.here.parent

    def _end_nearest(self, rule: int) -> None:
        """Close the outermost open element of the rule's tags that lies inside the nearest stop."""
        node, found, tags, bit = self.here, None, RULES[rule][0], 1 << rule
        while node is not None and node.open & bit:
            if node.tag in tags:
                found = node
            node = node.parent
        if found is not None:
            self._back_to(found.parent)

    def _into_body(self) -> None:
        if self.body is None:
            self._back_to(self.root)
            self.body = self._open("body")

    def _foreign(self) -> Node | None:
        """The innermost drawing or formula around here, unless HTML goes on inside it."""
        if not any(self.listed.get(t) for t in FOREIGN):
            return None
        innermost = lambda tags: max((n[-1] for t in tags if (n := self.listed.get(t))), key=lambda n: n.depth, default=None)
        found, again = innermost(FOREIGN), innermost(HTML_AGAIN)
        return found if found is not None and (again is None or again.depth < found.depth) else None

    def start(self, tag: str, attrs: str) -> None:
        foreign = self._foreign()
        while foreign is not None and tag in ENDS_FOREIGN:
            self._back_to(foreign.parent)
            foreign = self._foreign()
        if foreign is not None or tag in FOREIGN:
            if self.body is None:
                self._into_body()
            tag = tag if tag in NAMED_IN_FOREIGN else f"*{tag}"  # a cell in a formula is no cell of a table
            if attrs.endswith("/") and not UNQUOTED_END.search(attrs):
                self.here.children.append(Node(tag, attrs, self.here))
            else:
                self._open(tag, attrs)
            return
        if self.here.tag == "colgroup" and tag not in ("col", "template"):
            self._back_to(self.here.parent)
        if tag in TABLE_PARTS and not self.listed.get("table"):
            return
        if tag == "html":
            self.root.attrs = self.root.attrs or attrs
            return
        if tag == "head":
            if self.head is None and self.body is None:
                self._back_to(self.root)
                self.head = self._open("head", attrs)
            return
        if tag == "body":
            if self.body is None:
                self._into_body()
                self.body.attrs = attrs
            return
        if self.body is None:
            if tag in IN_HEAD:
                if self.head is None:
                    self.head = self._open("head")
            else:
                self._into_body()
        if tag in ENDS_P:
            self._end_nearest(P_RULE)
        if tag in HEADINGS and self.here.tag in HEADINGS:
            self._back_to(self.here.parent)
        if tag in ENDS:
            self._end_nearest(RULES.index(ENDS[tag]))
        if tag in CELLS and self.here.tag in AROUND_ROWS:
            self._open("tr")
        if tag in VOID:
            self.here.children.append(Node(tag, attrs, self.here))
        else:
            self._open(tag, attrs)

    def end(self, tag: str) -> None:
        if tag in ("html", "body"):
            return
        if tag == "br":  # read as a start tag
            self.start("br", "")
            return
        foreign, starred = self._foreign(), self.listed.get(f"*{tag}")
        if foreign is not None and starred and starred[-1].depth > foreign.depth:
            self._back_to(starred[-1].parent)
            return
        stop = self.here.stops[0 if tag == "table" else 1 if tag in ENDED_BY_TABLE_PARTS else 2]
        found = self.listed.get(tag)
        if found and found[-1].depth >= stop:
            self._back_to(found[-1].parent)
        elif tag == "p":  # an end without a start is an empty paragraph
            self.start("p", "")
            self.end("p")

    def text(self, data: str, raw: bool = False) -> None:
        if not raw and self.body is None and self.here.tag in ("html", "head"):
            if not data.strip(" \t\n\f\r"):
                return
            self._into_body()
        if self.here.tag == "colgroup" and data.strip(" \t\n\f\r"):
            self._back_to(self.here.parent)
        if self.here.tag == "pre" and not self.here.children:
            data = re.sub(r"\A\r?\n", "", data)
        self.here.children.append(data)


def parse(page: str) -> Node:
    build, at = TreeBuilder(), 0
    find = MARKUP.search
    while True:
        m = find(page, at)
        if m is None:
            break
        if m.start() > at:
            build.text(html.unescape(page[at : m.start()]))
        at = m.end()
        if m[1]:
            build.end(m[1].lower())
        elif m[2]:
            tag = m[2].lower()
            build.start(tag, m[3])
            if tag in RAW and build.here.tag in (tag, f"*{tag}"):  # one that closes itself in a drawing has no text
                close = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>?", re.IGNORECASE).search(page, at)
                data = page[at : close.start() if close else len(page)]
                build.text(html.unescape(data) if tag in ("title", "textarea") else data, raw=True)
                build.end(tag)
                at = close.end() if close else len(page)
    if at < len(page):
        build.text(html.unescape(page[at:]))
    return build.root


def shown(node: Node, seen: bool) -> tuple[bool, bool]:
    """Whether an element has a box, and whether its text is seen; visibility is inherited, and may be taken back."""
    if node.tag in UNSEEN:
        return False, False
    if not node.attrs:
        return node.tag != "dialog", seen
    a = node.attributes()
    style = CSS_COMMENT.sub("", a.get("style", ""))
    if "hidden" in a or NO_BOX.search(style) or (node.tag == "dialog" and "open" not in a):
        return False, False
    said = VISIBILITY.findall(style)
    return True, said[-1].lower() == "visible" if said else seen


class Flow:
    """Lines of one column of text: words run on until a block ends."""

    def __init__(self):
        self.lines: list[str] = []
        self.words: list[str] = []
        self.space = False  # white space is due before the next word
        self.gap = False  # a blank line is due before the next line
        self.marks: list[str] = []  # indentation of the lists around
        self.bullet = ""

    def write(self, text: str, pre: bool = False) -> None:
        if pre:
            for k, part in enumerate(text.split("\n")):
                if k:
                    self.end_line(force=True)
                if part:
                    self.words.append(part)
            return
        parts = SPACE.split(text)
        if parts[0] == "" and len(parts) > 1:
            self.space = True
        for k, w in enumerate(p for p in parts if p):
            if (self.space or k) and self.words:
                self.words.append(" ")
            self.words.append(w)
            self.space = False
        if parts[-1] == "":
            self.space = True

    def end_line(self, force: bool = False) -> None:
        line = "".join(self.words).rstrip(" ")
        self.words, self.space = [], False
        if not line and not force:
            return
        if self.gap and self.lines:
            self.lines.append("")
        self.gap = False
        indent = "".join(self.marks)
        if self.bullet:
            indent = indent[: len(indent) - len(self.bullet)] + self.bullet
            self.bullet = ""
        self.lines.append((indent + line).rstrip(" ") if line else "")

    def done(self) -> list[str]:
        self.end_line()
        while self.lines and not self.lines[-1]:
            self.lines.pop()
        return self.lines


def grid(rows: list[list[tuple[int, int, list[str]]]]) -> list[str]:
    """Lines of a table: cells of (colspan, rowspan, lines) in columns as wide as their widest cell."""
    placed: list[dict[int, tuple[int, list[str]]]] = []
    held: dict[int, int] = {}  # column: rows for which a cell from above still fills it
    for row in rows:
        at, here, below = 0, {}, {c: n - 1 for c, n in held.items() if n > 1}
        for span, deep, lines in row:
            while at in held:
                at += 1
            here[at] = (span, lines)
            for c in range(at, at + span):
                if deep > 1:
                    below[c] = deep - 1
            at += span
        held = below
        placed.append(here)
    columns = max((c + s for r in placed for c, (s, _) in r.items()), default=0)
    width = [0] * columns
    for wide in (False, True):
        for r in placed:
            for c, (s, lines) in r.items():
                need = max(map(len, lines), default=0)
                if not wide and s == 1:
                    width[c] = max(width[c], need)
                elif wide and s > 1:
                    width[c + s - 1] += max(0, need - sum(width[c : c + s]) - 2 * (s - 1))
    left = [0] * columns
    used = [c for c in range(columns) if width[c]]
    for a, b in zip(used, used[1:]):
        left[b] = left[a] + width[a] + 2
    out = []
    for r in placed:
        for k in range(max((len(lines) for _, lines in r.values()), default=0)):
            line = ""
            for c, (_, lines) in sorted(r.items()):
                if k < len(lines) and lines[k]:
                    line = line.ljust(left[c]) + lines[k]
            out.append(line.rstrip(" "))
    return out


def number(text: str, low: int, high: int, default: int = 1) -> int:
    """A whole number as HTML reads it, held within bounds; the default if there is none of up to nine digits."""
    found = WHOLE_NUMBER.match(text)
    return min(high, max(low, int(found[1]))) if found else default


def render(root: Node) -> list[str]:
    """Lines of the visible text. The walk keeps its own stack, so nesting may be of any depth."""
    flows, tables, lists = [Flow()], [], []
    pre = 0
    drawn: list[bool] = []  # for each drawing, and each text in one: whether text shows
    stack: list[tuple[Node | str, bool, bool]] = [(root, False, True)]
    while stack:
        node, leaving, seen = stack.pop()
        flow = flows[-1]
        if isinstance(node, str):
            if seen and (not drawn or drawn[-1]) and not (tables and tables[-1][1] is flow and node.strip() == ""):
                flow.write(node.replace("\xa0", " ") if pre else node, pre > 0)
            continue
        tag = node.tag
        if not leaving:
            box, seen = shown(node, seen)
            if not box or (drawn and not drawn[-1] and tag in NOT_DRAWN):
                continue
            if tag == "br":
                if seen:
                    flow.end_line(force=True)
                continue
            if tag in VOID and tag != "hr":
                continue
            stack.append((node, True, seen))
            stack += [(c, False, seen) for c in reversed(node.children)]
            if tag in BLOCK:
                flow.end_line()
                flow.gap |= tag in SPACED and not (tag in LISTS and lists and lists[-1][0] is flow)
            if tag == "svg" or (drawn and tag in DRAWN_TEXT):
                drawn.append(tag != "svg")
                flow.space = True
            if tag == "pre":
                pre += 1
            elif tag in LISTS:
                a = node.attributes() if tag == "ol" else {}
                down = "reversed" in a
                first = sum(isinstance(c, Node) and c.tag == "li" for c in node.children) if down else 1
                lists.append([flow, tag, number(a.get("start", ""), -(10**9), 10**9, first), -1 if down else 1])
            elif tag == "li":
                mark = "- "
                if lists and lists[-1][0] is flow and lists[-1][1] == "ol":
                    lists[-1][2] = number(node.attributes().get("value", ""), -(10**9), 10**9, lists[-1][2])
                    mark = f"{lists[-1][2]}. "
                    lists[-1][2] += lists[-1][3]
                flow.marks.append(" " * len(mark))
                flow.bullet = mark if seen else ""
            elif tag in ("dd", "blockquote"):
                flow.marks.append("  ")
            elif tag == "table":
                tables.append([[], flow])
            elif tag == "tr" and tables and tables[-1][1] is flow:
                tables[-1][0].append([])
            elif tag in CELLS and tables and tables[-1][1] is flow:
                flows.append(Flow())
            continue
        if tag in CELLS and tables and flow is not tables[-1][1]:
            a = node.attributes()
            lines = flows.pop().done()
            if not tables[-1][0]:
                tables[-1][0].append([])
            tables[-1][0][-1].append((number(a.get("colspan", ""), 1, 1000), number(a.get("rowspan", ""), 1, 65534), lines))
            continue
        if tag == "caption":
            flow.end_line()
        elif tag == "table" and tables and tables[-1][1] is flow:
            rows = tables.pop()[0]
            flow.end_line()
            for line in grid(rows):
                flow.words = [line] if line else []
                flow.end_line(force=True)
        if tag in BLOCK:
            if tag == "li" and flow.bullet and "".join(flow.words) == "":
                flow.end_line(force=True)
            flow.end_line()
            flow.gap |= tag in SPACED and not (tag in LISTS and len(lists) > 1 and lists[-2][0] is flow)
        if tag == "svg" or (drawn and tag in DRAWN_TEXT):
            drawn.pop()
            flow.space = True
        if tag == "pre":
            pre -= 1
        elif tag in LISTS:
            lists.pop()
        elif tag in ("li", "dd", "blockquote"):
            flow.marks.pop()
            flow.bullet = ""
    return flows[0].done()


def page_text(page: str) -> str:
    return "\n".join(render(parse(page))).replace("\xa0", " ")


def extract(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """id_col and `text`, the visible text of every page.

    Elements without a box (by tag, the hidden attribute, or display in a style attribute) are left
    out with all that they hold; of elements with visibility:hidden the text is left out, but not that of
    elements in them that are visible again. Style sheets are not read. Formulas are text, and of drawings
    the texts in them, each a word apart. Table parts outside of a table are ignored, what they hold is not. Time grows with the length
    of a page, however long it is or deeply nested. Lines are joined by line feeds, blocks with margins parted by a
    blank line. Broken markup never fails: unclosed elements end with their parents, text outside
    of tags is text. Null pages give null, empty ones an empty text; null and repeated ids are kept.
    Extra columns are ignored, whatever their names. No rows: no rows.
    """
    rows = pages.select(F.col(id_col).alias("id"), F.col(html_col).cast("string").alias("html"))
    kind = rows.schema["id"].dataType.simpleString()

    def task(batches):
        for b in slices(batches):
            text = [None if x is None else page_text(x) for x in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(text, pa.string())], names=["id", "text"])

    return rows.mapInArrow(task, f"id {kind}, text string").withColumnRenamed("id", id_col)


def op10_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))
