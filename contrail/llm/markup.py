"""Visible text of HTML pages, laid out: a tree builder with implied tags, visibility rules, and a renderer.

The tree follows the rules that matter for text: void and raw-text elements, start tags that close a paragraph,
list item, definition, option, cell, row or row group, end tags without a start. The renderer leaves out what a
browser doesn't show and keeps the shape of the rest: blank lines around paragraphs and headings, numbered and
marked lists with indents, preformatted text as it stands, tables with their cells aligned under each other.

Hidden are: metadata, scripts and fallback content, ``hidden`` elements, closed dialogs, closed details but for
their summary, and what the style attribute or a plain rule (tag, class or id) of a style element sets to
``display: none`` or ``visibility: hidden``. Of several such declarations the important, the more specific, the later
one holds; visibility is inherited, so descendants may set it to visible again. Rules within at-rules and rules with
other selectors are left out. Of a drawing (svg) the text elements and foreign objects are shown, definitions where they are used.

Defined cases: a null page has null text, an empty one empty text; text is never cut: elements deeper than
``DEPTH`` are taken as if they stood there, cells wider than ``CELL`` don't widen their column; broken markup is
read as far as browsers would; repeated rows are rendered alike; rows keep all their columns, whatever their names.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType

from contrail.llm.common import ship

DEPTH, CELL, SPAN = 150, 60, 1000
INDENT = 4

VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title xmp iframe noembed noframes".split())
BLOCK = set(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li listing main menu nav ol optgroup option p plaintext pre "
    "search section summary table ul xmp caption".split()
)
SPACED = set("p h1 h2 h3 h4 h5 h6 ul ol dl blockquote figure pre table hr fieldset menu dir listing xmp".split())
LISTS = {"ul", "ol", "menu", "dir"}
UNSEEN = set(
    "head script style template noscript iframe noembed noframes object audio video canvas datalist rp title "
    "area base link meta param source track map progress meter".split()
)
# Inputs whose value is no text on the page.
MUTE = set("hidden checkbox radio password file image range color".split())
# The keywords of the display property.
DISPLAYS = set(
    "none block inline inline-block flow flow-root flex inline-flex grid inline-grid table inline-table table-row "
    "table-cell table-caption table-column table-column-group table-row-group table-header-group table-footer-group "
    "list-item contents ruby ruby-base ruby-text run-in math inherit initial unset revert revert-layer".split()
)
KEPT_SPACE = {"pre", "textarea", "listing", "xmp", "plaintext"}
# What a start tag closes, and the elements beyond which it doesn't look.
CLOSES = {
    "li": ({"li"}, LISTS),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "option": ({"option"}, {"select", "datalist", "optgroup"}),
    "optgroup": ({"optgroup", "option"}, {"select"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tr": ({"tr", "caption", "colgroup"}, {"table", "thead", "tbody", "tfoot"}),
    "thead": ({"thead", "tbody", "tfoot", "caption", "colgroup"}, {"table"}),
    "tbody": ({"thead", "tbody", "tfoot", "caption", "colgroup"}, {"table"}),
    "tfoot": ({"thead", "tbody", "tfoot", "caption", "colgroup"}, {"table"}),
    "rt": ({"rt", "rp"}, {"ruby"}),
    "rp": ({"rt", "rp"}, {"ruby"}),
}
SCOPES = {"table", "td", "th", "caption", "html", "template", "button", "object"}
# Parts of a drawing that show no text where they stand, and start tags that end a drawing.
UNDRAWN = set("defs symbol clippath mask marker pattern lineargradient radialgradient filter desc title metadata".split())
ENDS_SVG = set(
    "b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li listing menu meta "
    "nobr ol p pre ruby s small span strong strike sub sup table tt u ul var".split()
)
IN_HEAD = set("base link meta title style script noscript template head".split())

_NAME = re.compile(r"[a-zA-Z][^\s/>]*")
_ATTRIBUTE = re.compile(r"[\s/]*([^\s/>=][^\s/>=]*)(\s*=\s*)?")
_BARE = re.compile(r"[^\s>]*")
_SPACE = re.compile(r"[ \t\n\r\f]+")
_COMMENT = re.compile(r"/\*.*?(?:\*/|\Z)", re.S)
_QUOTED = re.compile(r"\"[^\"\n]*\"|'[^'\n]*'")
_SIGN = re.compile(r"[{};]")
_AT = re.compile(r"\s*@")
_SIMPLE = re.compile(r"[.#]?[\w-]+")


class Node:
    __slots__ = ("tag", "attributes", "children")

    def __init__(self, tag: str, attributes: dict[str, str]):
        self.tag, self.attributes, self.children = tag, attributes, []


def tokens(html: str) -> Iterator[tuple[str, str, dict[str, str]]]:
    """(kind, tag or text, attributes): kind is "text", "raw", "start" or "end".

    A start tag that ends in a slash has the attribute "/", which no name in a page can be.
    """
    at, end, svg = 0, len(html), 0
    while at < end:
        less = html.find("<", at)
        if less < 0:
            yield "text", unescape(html[at:]), {}
            return
        if less > at:
            yield "text", unescape(html[at:less]), {}
        closing = html.startswith("/", less + 1)
        name = _NAME.match(html, less + 1 + closing)
        if not name:
            if html.startswith("<!--", less):
                stop = html.find("-->", less + 2)
                at = end if stop < 0 else stop + 3
            elif closing or html.startswith(("<!", "<?"), less):
                stop = html.find(">", less)
                at = end if stop < 0 else stop + 1
            else:
                yield "text", "<", {}
                at = less + 1
            continue
        tag, at, attributes = name.group().lower(), name.end(), {}
        while True:
            attribute = _ATTRIBUTE.match(html, at)
            if not attribute:
                if html.startswith("/", at):
                    attributes["/"] = ""
                stop = html.find(">", at)
                at = end if stop < 0 else stop + 1
                break
            at, value = attribute.end(), ""
            if attribute.group(2):
                if html.startswith(('"', "'"), at):
                    stop = html.find(html[at], at + 1)
                    stop = end if stop < 0 else stop  # an open quote swallows the rest
                    value, at = html[at + 1 : stop], stop + 1
                else:
                    bare = _BARE.match(html, at)
                    value, at = bare.group(), bare.end()
            attributes.setdefault(attribute.group(1).lower(), unescape(value))
        yield "end" if closing else "start", tag, attributes
        if tag == "plaintext" and not closing:  # nothing ends it
            yield "raw", html[at:], {}
            return
        if tag == "svg" and "/" not in attributes:
            svg = max(0, svg - 1) if closing else svg + 1
        if tag in RAW and not closing and not (svg and "/" in attributes):
            stop = re.compile(f"</{tag}(?=[\\s/>])", re.I).search(html, at)
            stop = stop.start() if stop else end
            raw = html[at:stop]
            yield "raw", unescape(raw) if tag in ("textarea", "title") else raw, {}
            at = stop


def tree(html: str) -> Node:
    root = Node("html", {})
    stack, too_deep, drawings = [root], [], False

    def close(tags: set[str], until: set[str]) -> None:
        for i in range(len(stack) - 1, 0, -1):
            if stack[i].tag in tags:
                del stack[i:]
                return
            if stack[i].tag in until:
                return

    for kind, name, attributes in tokens(html):
        if kind in ("text", "raw"):
            if kind == "text" and stack[-1].tag == "head" and name.strip():
                stack.pop()
            stack[-1].children.append(name)
        elif kind == "start":
            if name in ("html", "body"):
                close({"head"}, set())
                stack[-1 if len(stack) == 1 else 0].attributes.update(attributes)
                continue
            if stack[-1].tag == "head" and name not in IN_HEAD:
                stack.pop()
            drawing = 0
            if drawings:
                at = max((i for i, n in enumerate(stack) if n.tag in ("svg", "foreignobject")), default=0)
                drawing = at if stack[at].tag == "svg" else 0
                if drawing and name in ENDS_SVG and stack[-1].tag not in ("desc", "title"):
                    del stack[drawing:]
                    drawing = 0
            if name in CLOSES:
                close(*CLOSES[name])
            if name in ("tr", "thead", "tbody", "tfoot"):
                close(*CLOSES["td"])
                close(*CLOSES["tr"])
            if name in BLOCK:
                close({"p"}, SCOPES)
            if name[0] == "h" and name[1:].isdigit() and stack[-1].tag[0] == "h" and stack[-1].tag[1:].isdigit():
                stack.pop()
            node = Node(name, attributes)
            stack[-1].children.append(node)
            if name in VOID or "/" in attributes and (drawing or name == "svg"):
                continue
            drawings |= name == "svg"
            if len(stack) < DEPTH:
                stack.append(node)
            else:
                too_deep.append(name)
        elif name == "br":
            stack[-1].children.append(Node("br", {}))
        elif too_deep and name in too_deep:
            while too_deep.pop() != name:
                pass
        else:
            inside = {"table"} if name not in ("table", "html", "body") else set()
            if name == "p" and not any(n.tag == "p" for n in stack):
                stack[-1].children.append(Node("p", {}))
            close({name}, inside)
    return root


Rank = tuple[bool, int, int]  # whether it is important, how specific, and how late a rule is


class Rules:
    """What a page's style elements say of simple selectors (tag, .class, #id), and its elements by id."""

    def __init__(self, root: Node):
        self.stated: dict[str, dict[str, Stated]] = {"display": {}, "visibility": {}}  # by property and selector
        self.ids: dict[str, Node] = {}
        nodes, styles = [root], []
        while nodes:  # in the order of the page
            node = nodes.pop()
            if node.tag == "style":
                styles.append("".join(c for c in node.children if isinstance(c, str)))
            if "id" in node.attributes:
                self.ids.setdefault(node.attributes["id"], node)
            nodes += [c for c in reversed(node.children) if isinstance(c, Node)]
        for i, (selectors, body) in enumerate(rule for css in styles for rule in _rules(css)):
            declared = _declared(body)
            for name in {s.strip() for s in selectors.split(",")} if declared else ():
                if not _SIMPLE.fullmatch(name):
                    continue
                for of, (important, shows) in declared.items():
                    rank = important, 2 if name[0] == "#" else int(name[0] == "."), i
                    held = self.stated[of]
                    held[name] = max(held.get(name, (rank, shows)), (rank, shows))

    def shows(self, of: str, node: Node) -> bool | None:
        """Whether the page's styles show a node by the property ``of``; None if they don't say."""
        a, held = node.attributes, self.stated[of]
        found = []
        if held:
            names = [node.tag, "#" + a.get("id", ""), *("." + c for c in a.get("class", "").split())]
            found = [held[n] for n in names if n in held]
        if "style" in a and (own := _declared(_QUOTED.sub("", _COMMENT.sub("", a["style"]))).get(of)):
            found.append(((own[0], 3, 0), own[1]))
        return max(found)[1] if found else None


Stated = tuple[Rank, bool]  # and whether it shows what it is about


def _rules(css: str) -> Iterator[tuple[str, str]]:
    """(selectors, declarations) of the rules outside at-rules, in one pass over the braces."""
    css = _QUOTED.sub("", _COMMENT.sub("", css))
    depth, begin, selectors, skipped = 0, 0, "", bool(_AT.match(css))
    for sign in _SIGN.finditer(css):
        at = sign.start()
        if sign[0] == "{":
            depth += 1
            if depth == 1:
                selectors, begin = css[begin:at], at + 1
            continue
        if sign[0] == "}":
            if depth == 1 and not skipped:
                yield selectors, css[begin:at]
            depth = max(0, depth - 1)
        if depth == 0 and (skipped or sign[0] == "}"):
            begin, skipped = at + 1, bool(_AT.match(css, at + 1))
    if depth and not skipped:  # the end of the page ends a rule
        yield selectors, css[begin:]


def _declared(body: str) -> dict[str, tuple[bool, bool]]:
    """What declarations say of display and visibility: whether with importance, and whether they show."""
    found: dict[str, tuple[bool, bool]] = {}
    for part in body.split(";"):
        name, _, value = part.partition(":")
        name, words = name.strip().lower(), value.lower().replace("!", " !").split()
        important = words[-1:] == ["!important"] or words[-2:] == ["!", "important"]
        if important:
            words = words[: -1 if words[-1] == "!important" else -2]
        if name == "display" and words and DISPLAYS.issuperset(words):
            shows = words != ["none"]
        elif name == "visibility" and words in (["visible"], ["hidden"], ["collapse"]):
            shows = words == ["visible"]
        else:
            continue
        if important or not found.get(name, (False, False))[0]:
            found[name] = important, shows
    return found


class Page:
    """Lines of text; a block begins a new line, spacing puts one blank line between blocks."""

    def __init__(self):
        self.lines: list[str] = []
        self.line, self.first, self.gap = "", "", False
        self.indent = 0

    def text(self, text: str) -> None:
        text = _SPACE.sub(" ", text)
        if not self.line or self.line.endswith((" ", "\n")):
            text = text.lstrip(" ")
        self.line += text

    def as_it_is(self, text: str) -> None:
        for i, line in enumerate(text.replace("\r\n", "\n").split("\n")):
            if i:
                self.newline(always=True)
            self.line += line

    def newline(self, always: bool = False) -> None:
        if not self.line.strip() and not self.first:
            if always and self.lines:
                self.lines.append("")
            self.line = ""
            return
        if self.gap and self.lines and self.lines[-1]:
            self.lines.append("")
        self.gap = False
        marker = " " * max(0, self.indent - len(self.first)) + self.first
        self.lines.append((marker + self.line).rstrip(" "))
        self.line, self.first = "", ""

    def block(self, spaced: bool) -> None:
        if self.line.strip():
            self.newline()
        self.line = ""
        self.gap |= spaced and not self.first

    def finished(self) -> list[str]:
        self.newline() if self.line.strip() else None
        lines = [line.replace("\xa0", " ").rstrip() for line in self.lines]
        while lines and not lines[-1]:
            lines.pop()
        while lines and not lines[0]:
            lines.pop(0)
        return lines


class Renderer:
    def __init__(self, rules: Rules):
        self.rules = rules

    def shown(self, node: Node) -> bool:
        a = node.attributes
        if node.tag in UNSEEN:
            return False
        stated = self.rules.shows("display", node)
        return not ("hidden" in a or node.tag == "dialog" and "open" not in a) if stated is None else stated

    def seen(self, node: Node, visible: bool) -> bool:
        """The visibility of a node whose parent's is ``visible``."""
        stated = self.rules.shows("visibility", node)
        return visible if stated is None else stated

    def svg(self, node: Node, page: Page, visible: bool, used: frozenset[str] = frozenset()) -> None:
        for child in node.children:
            if isinstance(child, str) or child.tag in UNDRAWN or not self.shown(child):
                continue
            a = child.attributes
            if a.get("display", "").strip() == "none":
                continue
            plain = a.get("visibility", "").strip()
            seen = self.seen(child, plain == "visible" if plain in ("visible", "hidden", "collapse") else visible)
            if child.tag in ("text", "foreignobject"):
                text = Node(child.tag, a)
                text.children = [c for c in child.children if isinstance(c, str) or c.tag not in UNDRAWN]
                page.text(" ")
                self.children(text, page, seen, False, 0)
                page.text(" ")
            elif child.tag == "use":
                name = a.get("href", a.get("xlink:href", "")).strip().removeprefix("#")
                if name in self.rules.ids and name not in used:  # a definition may use itself
                    drawn = Node("g", {})
                    target = self.rules.ids[name]
                    drawn.children = target.children if target.tag == "symbol" else [target]
                    self.svg(drawn, page, seen, used | {name})
            else:
                self.svg(child, page, seen, used)

    def children(self, node: Node, page: Page, visible: bool, kept: bool, depth: int) -> None:
        for child in node.children:
            if isinstance(child, Node):
                self.node(child, page, visible, kept, depth)
            elif visible:
                page.as_it_is(child) if kept else page.text(child)
            elif child and not kept:  # takes room
                page.text(" ")

    def node(self, node: Node, page: Page, visible: bool, kept: bool, depth: int) -> None:
        tag = node.tag
        if not self.shown(node):
            return
        visible = self.seen(node, visible)
        if tag == "svg":
            self.svg(node, page, visible)
            return
        kept = kept or tag in KEPT_SPACE
        if tag == "br":
            if visible:
                page.newline(always=True)
            return
        if tag == "input":
            if visible and node.attributes.get("type", "").strip().lower() not in MUTE:
                page.text(node.attributes.get("value", ""))
            return
        if tag in ("table",):
            page.block(True)
            self.table(node, page, visible)
            page.block(True)
            return
        if tag in ("td", "th"):  # outside a table
            page.text(" ")
        block = tag in BLOCK or tag in ("tr", "thead", "tbody", "tfoot")
        spaced = tag in SPACED and not (tag in LISTS and depth)
        if block:
            page.block(spaced)
        if tag in LISTS:
            self.list(node, page, visible, kept, depth)
        elif tag in ("dd", "blockquote"):
            page.indent += INDENT
            self.children(node, page, visible, kept, depth)
            page.block(False)
            page.indent -= INDENT
        elif tag == "details" and "open" not in node.attributes:
            for child in node.children:
                if isinstance(child, Node) and child.tag == "summary":
                    self.node(child, page, visible, kept, depth)
        else:
            if tag == "li":  # outside a list
                self.item(node, page, "- ", visible, kept, depth)
            else:
                children = node.children
                if tag in ("pre", "listing") and children and isinstance(children[0], str):
                    node.children = [children[0].removeprefix("\n"), *children[1:]]
                self.children(node, page, visible, kept, depth)
        if block:
            page.block(spaced)

    def list(self, node: Node, page: Page, visible: bool, kept: bool, depth: int) -> None:
        a = node.attributes
        items = [c for c in node.children if isinstance(c, Node) and c.tag == "li" and self.shown(c)]
        back = "reversed" in a
        number = _whole(a.get("start"), len(items) if back else 1)
        for child in node.children:
            if not isinstance(child, Node):
                if visible and child.strip():
                    page.text(child)
            elif child.tag != "li":
                self.node(child, page, visible, kept, depth + 1)
            elif self.shown(child):
                number = _whole(child.attributes.get("value"), number)
                marker = f"{_numeral(number, a.get('type', '1'))}. " if node.tag == "ol" else "- "
                seen = self.seen(child, visible)
                self.item(child, page, marker if seen else " " * len(marker), seen, kept, depth + 1)
                number += -1 if back else 1

    def item(self, node: Node, page: Page, marker: str, visible: bool, kept: bool, depth: int) -> None:
        page.block(False)
        page.indent += len(marker)
        page.first = marker
        self.children(node, page, visible, kept, depth)
        page.block(False)
        page.first = ""
        page.indent -= len(marker)

    def table(self, node: Node, page: Page, visible: bool) -> None:
        rows: list[list[tuple[int, list[str]]]] = []  # (column, lines) of each cell
        taken: list[tuple[int, int, int]] = []  # (from, to, last row) of columns that cells above fill, in order
        parts = [(c, visible) for c in node.children]
        groups: list[tuple[Node, bool]] = []
        for part, seen in parts:
            if isinstance(part, str):
                if seen and part.strip():
                    page.text(part)
            elif part.tag in ("thead", "tbody", "tfoot", "colgroup"):
                if self.shown(part):
                    inside = self.seen(part, seen)
                    for child in part.children:
                        if isinstance(child, Node):
                            groups.append((child, inside))
                        elif inside and child.strip():  # stands before the table, as text in table does
                            page.text(child)
            elif part.tag in ("tr", "td", "th"):
                groups.append((part, seen))
            elif part.tag != "col":
                self.node(part, page, visible, False, 0)
        page.block(False)
        for row, seen in groups:
            if not self.shown(row) or row.tag == "col":
                continue
            seen = self.seen(row, seen)
            column, cells, passed, n = 0, [], 0, len(rows)
            taken = [span for span in taken if span[2] >= n]
            below = []
            for cell in row.children if row.tag == "tr" else [row]:
                if not isinstance(cell, Node) or not self.shown(cell):
                    if isinstance(cell, str) and seen and cell.strip():
                        page.text(cell)
                    continue
                while passed < len(taken) and taken[passed][0] <= column:
                    column = max(column, taken[passed][1])
                    passed += 1
                inner = Page()
                if cell.tag == "svg":
                    self.svg(cell, inner, self.seen(cell, seen))
                else:
                    self.children(cell, inner, self.seen(cell, seen), False, 0)
                cells.append((column, inner.finished()))
                wide = max(1, min(SPAN, _whole(cell.attributes.get("colspan"), 1)))
                high = max(1, min(SPAN, _whole(cell.attributes.get("rowspan"), 1)))
                if high > 1:
                    below.append((column, column + wide, n + high - 1))
                column += wide
            taken = sorted(taken + below) if below else taken
            rows.append(cells)
        width: dict[int, int] = {}
        for cells in rows:
            for column, lines in cells:
                width[column] = max([width.get(column, 0), *(len(x) for x in lines if len(x) <= CELL)])
        place, at = {}, 0
        for column in sorted(width):
            place[column] = at
            at += width[column] + 2 * (width[column] > 0)
        for cells in rows:
            for i in range(max((len(lines) for _, lines in cells), default=0)):
                line = ""
                for column, lines in cells:
                    if i < len(lines) and lines[i]:
                        line = line.ljust(place[column]) if len(line) < place[column] or not line else line + "  "
                        line += lines[i]
                if line.strip():
                    page.line = line
                    page.newline()


def _whole(text: str | None, default: int) -> int:
    found = re.match(r"\s*([+-]?\d{1,9})", text or "")
    return int(found[1]) if found else default


def _numeral(number: int, kind: str) -> str:
    if kind in ("a", "A") and number > 0:
        letters = ""
        while number:
            number, rest = divmod(number - 1, 26)
            letters = chr(97 + rest) + letters
        return letters if kind == "a" else letters.upper()
    if kind in ("i", "I") and 0 < number < 4000:
        roman = ""
        for value, sign in zip(
            (1000, 900, 500, 400, 100, 90, 50, 40, 10, 9, 5, 4, 1), "m cm d cd c xc l xl x ix v iv i".split()
        ):
            roman, number = roman + sign * (number // value), number % value
        return roman if kind == "i" else roman.upper()
    return str(number)


def render(html: str) -> str:
    root = tree(html)
    page = Page()
    Renderer(Rules(root)).children(root, page, True, False, 0)
    return "\n".join(page.finished())


def rendered(pages: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """(row, text): ``keep``, else all, of each row of ``pages`` (html, ...) as a struct, with its visible text."""
    ship(pages.sparkSession)

    def render_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                texts = [None if h is None else render(h) for h in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(texts, pa.string())], ["row", "text"])

    row = F.struct(*(F.col(f"`{c}`") for c in keep or pages.columns)).alias("row")
    ready = pages.select(row, F.col("`html`").alias("html"))
    return ready.mapInArrow(render_all, ready.select("row").schema.add("text", StringType()))


def op4_html(spark: SparkSession, folder: str) -> DataFrame:
    pages = spark.read.parquet(f"{folder}/pages.parquet")
    return rendered(pages, keep=["page_id"]).select("row.page_id", "text")
