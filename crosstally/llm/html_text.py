"""Visible text of HTML pages, laid out.

A tokenizer and tree builder (implied start and end tags, void elements, raw text) turn
a page into properly nested start, text and end events. A renderer keeps a stack of text
flows: blocks are set apart, list items get markers and indentation, table cells are
collected and aligned in columns, preformatted text keeps its spaces. Elements that a
browser does not show are left out with all they hold. No step recurses. Places of open
elements are kept by name, so that a tag costs the same at any depth; up to DEEP nested
items and cells are laid out in each other, those further in are lines of the last; columns
are at most WIDE characters and a cell is carried down in the first COLUMNS columns. So the
work is linear in the page, by factors that these bound.

Tables: cells line up by column, over `colspan` and `rowspan`. A cell that others follow is
wrapped at spaces beyond WIDE characters; a longer word stays whole and moves what follows
it on its line. The last cell of a row keeps its lines.

Results for odd input: a null or empty page gives an empty text; unclosed, misnested and
unknown tags are repaired; a page without tags is one paragraph; repeated rows are
rendered alike, row by row; other columns are ignored.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator
from html import unescape

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from crosstally.llm.common import ship_package

# Element names of HTML, by role: fixed values.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
HIDDEN = frozenset(
    "head script style title template noscript iframe noembed noframes object audio video canvas svg datalist".split()
)
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form"
    " h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary"
    " table ul xmp caption".split()
)
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 ul ol menu dir dl table blockquote pre figure hr xmp".split())
LISTS = frozenset("ul ol menu dir".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
HEAD_ONLY = frozenset("base link meta title style script template noscript".split())

#: The start of a key closes the open elements listed, up to a boundary element.
CLOSES = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "option": ("option",), "optgroup": ("option", "optgroup"),
    "tr": ("td", "th", "tr", "caption", "colgroup"), "td": ("td", "th"), "th": ("td", "th"),
    "tbody": ("td", "th", "tr", "tbody", "thead", "tfoot", "caption", "colgroup"),
    "thead": ("td", "th", "tr", "tbody", "thead", "tfoot", "caption", "colgroup"),
    "tfoot": ("td", "th", "tr", "tbody", "thead", "tfoot", "caption", "colgroup"),
}
BOUNDARY = {
    "li": LISTS | {"table", "td", "th"}, "dt": frozenset({"dl", "table"}), "dd": frozenset({"dl", "table"}),
    "option": frozenset({"select", "optgroup", "datalist"}), "optgroup": frozenset({"select"}),
    "tr": frozenset({"table"}), "td": frozenset({"table", "tr"}), "th": frozenset({"table", "tr"}),
    "tbody": frozenset({"table"}), "thead": frozenset({"table"}), "tfoot": frozenset({"table"}),
}
#: An open paragraph ends only inside these.
P_SCOPE = frozenset("table td th caption button object template html body".split())
TABLE_PARTS = frozenset("caption colgroup col thead tbody tfoot tr td th".split())

#: Characters at which the cells of a table wrap, but for the last of a row.
WIDE = 60
#: Items, quotes and cells that are laid out in each other.
DEEP = 32
#: Columns in which `rowspan` counts, and the columns and rows that a cell may span: limits of HTML.
COLUMNS, ROWS = 1000, 65534

#: A tag or comment that never ends takes the rest of the page.
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+(?:\"|\Z)|'[^']*+(?:'|\Z))*+)(?:>|\Z)"
    r"|<[!?/][^>]*+(?:>|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_INVISIBLE = re.compile(r"(?:^|;)\s*(?:display\s*:\s*none|visibility\s*:\s*(?:hidden|collapse))\b", re.I)
_SPACES = re.compile(r"[ \t\n\f\r]+")


def _tokens(page: str) -> Iterator[tuple[str, str, str]]:
    """("text", data, ""), ("start", name, attributes) and ("end", name, "") in order."""
    at = 0
    while match := _TOKEN.search(page, at):
        if match.start() > at:
            yield "text", unescape(page[at : match.start()]), ""
        at = match.end()
        if match[2] is None:
            continue
        name = match[2].lower()
        if match[1]:
            yield "end", name, ""
            continue
        yield "start", name, match[3]
        if name in RAW:
            close = re.compile(rf"</{name}(?=[\s/>])", re.I).search(page, at)
            end = close.start() if close else len(page)
            raw = page[at:end]
            yield "text", unescape(raw) if name in ("textarea", "title") else raw, ""
            at = end
        elif name == "plaintext":
            break
    if at < len(page):
        yield "text", unescape(page[at:]), ""


def _attributes(text: str) -> dict[str, str]:
    found: dict[str, str] = {}
    for name, double, single, bare in _ATTRIBUTE.findall(text):
        found.setdefault(name.lower(), unescape(double or single or bare))
    return found


def _is_hidden(name: str, attributes: dict[str, str]) -> bool:
    if name in HIDDEN or "hidden" in attributes or name == "dialog" and "open" not in attributes:
        return True
    return bool(_INVISIBLE.search(attributes.get("style", "")))


def events(page: str) -> Iterator[tuple[str, str, dict[str, str]]]:
    """The tree in order of its text: properly nested starts and ends, with implied tags put in."""
    stack: list[str] = []
    places: dict[str, list[int]] = {}  # of the open elements of a name, ascending

    def push(name: str, attributes: dict[str, str]) -> tuple[str, str, dict[str, str]]:
        places.setdefault(name, []).append(len(stack))
        stack.append(name)
        return "start", name, attributes

    def pop_to(depth: int) -> Iterator[tuple[str, str, dict[str, str]]]:
        while len(stack) > depth:
            name = stack.pop()
            places[name].pop()
            yield "end", name, {}

    def last(names) -> int:
        return max((places[n][-1] for n in names if places.get(n)), default=-1)

    def innermost(names, boundary) -> int | None:
        """Place of the innermost open element of `names`, none beyond a boundary."""
        at = last(names)
        return at if at >= 0 and at >= last(boundary) else None

    def outermost(names, boundary) -> int | None:
        """The same for the outermost such element within the boundary."""
        limit = last(boundary)
        held = (places[n] for n in names if places.get(n) and places[n][-1] > limit)
        return min((at[bisect_right(at, limit)] for at in held), default=None)

    for kind, value, raw in _tokens(page):
        if kind == "text":
            if places.get("head") and stack[-1] == "head" and value.strip():
                yield from pop_to(places["head"][0])
            yield "text", value, {}
        elif kind == "end":
            if value in ("p", "br") and not places.get(value):
                yield "start", value, {}
                yield "end", value, {}
                continue
            names = HEADINGS if value in HEADINGS else (value,)
            stop = frozenset() if value in ("table", "body", "html") else {"table"}
            if value in TABLE_PARTS:
                stop = {"table"}
            elif value not in BLOCKS:
                stop = {"table", "td", "th", "li"}
            if value in LISTS or value in ("html", "body") or (at := innermost(names, stop)) is not None:
                if value in LISTS:
                    at = innermost((value,), {"td", "th"})
                elif value in ("html", "body"):
                    at = None  # what follows still belongs to the page
                if at is not None:
                    yield from pop_to(at)
        else:
            in_raw = any(places.get(n) for n in RAW | {"template", "noscript"})
            if places.get("head") and value not in HEAD_ONLY and not in_raw:
                yield from pop_to(places["head"][0])
            if value in ("html", "body", "head") and places.get(value):
                continue
            if value in BLOCKS and (at := innermost(("p",), P_SCOPE)) is not None:
                yield from pop_to(at)
            if value in HEADINGS and stack and stack[-1] in HEADINGS:
                yield from pop_to(len(stack) - 1)
            if value in CLOSES and (at := outermost(CLOSES[value], BOUNDARY[value])) is not None:
                yield from pop_to(at)
            if value in ("td", "th") and places.get("table") and (not stack or stack[-1] != "tr"):
                if innermost(("tr",), {"table"}) is None:
                    yield push("tr", {})
            attributes = _attributes(raw) if raw.strip(" /\n\t") else {}
            if value in VOID:
                yield "start", value, attributes
                yield "end", value, {}
            else:
                yield push(value, attributes)
    yield from pop_to(0)


class _Flow:
    """Lines of one block of text; `gap` is the number of blank lines owed before the next line."""

    def __init__(self) -> None:
        self.lines: list[str] = []
        self.line: list[str] = []
        self.gap = 0
        self.spaced = True

    def text(self, value: str) -> None:
        value = _SPACES.sub(" ", value)
        if value.startswith(" ") and self.spaced:
            value = value[1:]
        if value:
            self.line.append(value)
            self.spaced = value.endswith(" ")

    def exact(self, value: str) -> None:
        first, *rest = value.split("\n")
        self.line.append(first)
        for part in rest:
            self.newline(True)
            self.line.append(part)
        self.spaced = False

    def newline(self, empty: bool = False) -> None:
        """End the line; an empty one counts only if asked."""
        line = "".join(self.line).rstrip()
        self.line, self.spaced = [], True
        if line or empty:
            if self.lines:
                self.lines += [""] * self.gap
            self.gap = 0
            self.lines.append(line)

    def block(self, spaced: bool) -> None:
        self.newline()
        self.gap = max(self.gap, int(spaced))

    def add(self, lines: list[str]) -> None:
        if lines:
            if self.lines:
                self.lines += [""] * self.gap
            self.gap = 0
            self.lines += lines

    def done(self) -> list[str]:
        self.newline()
        return self.lines


def wrapped(line: str) -> list[str]:
    """The line cut at spaces into lines of at most WIDE characters, where it has such spaces."""
    out, at = [], 0
    while len(line) - at > WIDE:
        cut = line.rfind(" ", at, at + WIDE + 1)
        if cut < 0 or not line[at:cut].strip():
            cut = line.find(" ", at + WIDE)
        if cut < 0:
            break
        out.append(line[at:cut].rstrip())
        at = cut + 1
    return [*out, line[at:]]


Cell = tuple[list[str], int, int]  # lines, columns and rows that it spans


def in_columns(rows: list[list[Cell]]) -> Iterator[list[tuple[list[str], int]]]:
    """The rows with an empty cell wherever a cell of an earlier row reaches down."""
    held: dict[int, tuple[int, int]] = {}  # by first column: columns, rows to come
    for row in rows:
        out: list[tuple[list[str], int]] = []
        begun, at = {}, 0
        for lines, span, down in row:
            while at in held:
                out.append(([], held[at][0]))
                at += held[at][0]
            out.append((lines, span))
            if down > 1 and at < COLUMNS:
                begun[at] = (span, down - 1)
            at += span
        held = {at: (span, left - 1) for at, (span, left) in held.items() if left > 1} | begun
        yield out


def aligned(rows: list[list[Cell]]) -> list[str]:
    """Lines of a table."""
    placed = [
        [([part for line in lines for part in wrapped(line)], span) for lines, span in row[:-1]] + row[-1:]
        for row in in_columns(rows)
    ]
    widths: dict[int, int] = {}
    for row in placed:
        at = 0
        for lines, span in row:
            if span == 1:
                widths[at] = max([widths.get(at, 0), *(len(x) for x in lines if len(x) <= WIDE)])
            at += span
    out = []
    for row in placed:
        cells, at = [], 0
        for lines, span in row:
            width = sum(widths.get(i, 0) for i in range(at, at + span)) + 3 * (span - 1)
            cells.append((lines, width))
            at += span
        for i in range(max((len(lines) for lines, _ in cells), default=0)):
            shown = [(lines[i] if i < len(lines) else "").ljust(width) for lines, width in cells]
            line = " | ".join(shown).rstrip()
            if line.strip(" |"):
                out.append(line)
    return out


def _spanned(attributes: dict[str, str], name: str, most: int) -> int:
    """How many columns or rows a cell spans; a rowspan of 0 reaches to the end."""
    text = attributes.get(name, "1")
    number = int(text) if re.fullmatch(r"\d{1,6}", text) else 1
    return most if number == 0 and name == "rowspan" else max(1, min(number, most))


def _marker(lists: list[list]) -> str:
    """The marker of the next item of the innermost list."""
    if not lists:
        return "- "
    numbered, number = lists[-1]
    lists[-1][1] += 1
    return f"{number}. " if numbered else "- "


def render(page: str | None) -> str:
    """The visible text of a page, laid out in lines."""
    flows = [_Flow()]
    hidden = pre = 0
    lists: list[list] = []  # per open list: is it numbered, next number
    tables: list[list] = []  # per open table: its rows
    own: list[tuple[int, int] | None] = []  # per open item, quote and cell: what it spans; none without a flow
    depth: list[tuple[str, bool]] = []
    for kind, name, attributes in events(page or ""):
        flow = flows[-1]
        if kind == "text":
            if not hidden:
                flow.exact(name) if pre else flow.text(name)
            continue
        if kind == "start":
            out_of_sight = hidden > 0 or _is_hidden(name, attributes)
            depth.append((name, out_of_sight))
            hidden += out_of_sight
            if out_of_sight:
                continue
            if name == "br":
                flow.newline(True)
            elif name == "img" and attributes.get("alt", "").strip():
                flow.text(attributes["alt"])
            elif name == "input" and attributes.get("type", "text").lower() in ("text", "submit", "button", "reset"):
                flow.text(attributes.get("value", ""))
            elif name in LISTS:
                flow.block(not lists)
                start = attributes.get("start", "1")
                lists.append([name == "ol", int(start) if re.fullmatch(r"-?\d{1,9}", start) else 1])
            elif name in ("li", "dd", "blockquote"):
                flow.block(name == "blockquote")
                own.append((1, 1) if len(flows) <= DEEP else None)
                if own[-1]:
                    flows.append(_Flow())
                elif name == "li":
                    flow.text(_marker(lists))
            elif name == "table":
                flow.block(True)
                tables.append([])
            elif name == "tr" and tables:
                tables[-1].append([])
            elif name in ("td", "th") and tables:
                spans = _spanned(attributes, "colspan", COLUMNS), _spanned(attributes, "rowspan", ROWS)
                own.append(spans if len(flows) <= DEEP else None)
                if own[-1]:
                    flows.append(_Flow())
                else:
                    flow.newline()
            elif name in BLOCKS:
                flow.block(name in SPACED)
            pre += name in ("pre", "xmp", "textarea")
            continue
        _, out_of_sight = depth.pop()
        hidden -= out_of_sight
        if out_of_sight:
            continue
        pre -= name in ("pre", "xmp", "textarea")
        if name in LISTS:
            lists.pop()
            flow.block(not lists)
        elif name in ("li", "dd", "blockquote"):
            if own.pop():
                lines = flows.pop().done()
                marker = _marker(lists) if name == "li" else "  "
                pad = " " * len(marker)
                shown = [(pad if i else marker) + x if x else "" for i, x in enumerate(lines)]
                flows[-1].add([x.rstrip() for x in shown])
            flows[-1].block(name == "blockquote")
        elif name == "table":
            rows = [row for row in tables.pop() if row]
            flow.newline()
            flow.add(aligned(rows))
            flow.block(True)
        elif name in ("td", "th") and tables:
            spans = own.pop()
            if spans is None:
                flow.newline()
                continue
            lines = flows.pop().done()
            if not tables[-1]:
                tables[-1].append([])
            tables[-1][-1].append((lines, *spans))
        elif name in BLOCKS:
            flow.block(name in SPACED)
        elif name == "select" or name == "option":
            flow.newline()
    return "\n".join(flows[0].done())


def extract(pages: DataFrame, page_id: str = "page_id", html: str = "html") -> DataFrame:
    """page_id, text, n_lines of every page."""
    ship_package(pages.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = [render(x) for x in batch["html"]]
            lines = [x.count("\n") + 1 if x else 0 for x in texts]
            yield pd.DataFrame({"page_id": batch["page_id"], "text": texts, "n_lines": lines})

    # Ids travel as text: pandas would turn integers beside nulls into floats.
    kind = pages.select(F.col(page_id)).dtypes[0][1]
    named = pages.select(F.col(page_id).cast("string").alias("page_id"), F.col(html).alias("html"))
    found = named.mapInPandas(run, "page_id string, text string, n_lines long")
    return found.withColumn("page_id", F.col("page_id").cast(kind))
