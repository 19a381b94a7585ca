"""Visible text of HTML pages, laid out: a tree with implied tags, visibility rules, and block, list and table layout.

A page is one row and is rendered alone, in one pass over its markup and one over its tree, without recursion. Blocks
start on lines of their own, paragraphs and the like are set apart by a blank line, list items have markers and nest by
indents, and the cells of a table stand in columns. All visible text is there; only white space is changed.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Names of elements by the role that the HTML standard gives them.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style xmp iframe noembed noframes noscript".split())
ESCAPABLE = frozenset("textarea title".split())
NEVER_SEEN = frozenset(
    "head title script style template noscript noframes noembed iframe datalist object audio video canvas param".split()
)
OF_HEAD = frozenset("base basefont bgsound link meta noframes noscript script style template title".split())
ENDS_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 "
    "h4 h5 h6 header hgroup hr li main menu nav ol p pre search section summary table ul dd dt".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Blocks with a blank line around them, and those with a line end only.
APART = frozenset("p h1 h2 h3 h4 h5 h6 blockquote ul ol dl pre table figure fieldset menu dir hr article section".split())
BLOCKS = APART | ENDS_P | frozenset("html body tr caption legend option optgroup thead tbody tfoot".split())
SECTIONS = frozenset("tbody thead tfoot".split())
IN_TABLE = frozenset("caption colgroup col tbody thead tfoot tr td th".split())
LISTS = frozenset("ul ol menu dir".split())
#: An element outside of these is not closed from inside of them.
WALLS = frozenset("html table td th caption template button object".split())

SPACE = re.compile(r"[ \t\n\f\r]+")
NAME = re.compile(r"/?[a-zA-Z][^\s/>]*")
#: The rest of a tag: attributes with their quotes, or, if a quote never ends, whatever is before the next ">".
REST = re.compile(r"(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>")
ATTRIBUTE = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+)))?")
OF_USE = re.compile(r"hidden|style|class|id|open|start|value|span|reversed", re.I)
RULE = re.compile(r"([^{}]+)\{([^{}]*)\}")
SIMPLE = re.compile(r"([a-zA-Z][\w-]*|[.#][\w-]+)\Z")
#: Lines of a cell longer than this are not what a column is as wide as.
WIDEST = 60


class Node:
    __slots__ = ("tag", "attributes", "kids", "parent")

    def __init__(self, tag: str, attributes: dict[str, str], parent: Node | None) -> None:
        self.tag, self.attributes, self.parent = tag, attributes, parent
        self.kids: list[Node | str] = []


class Builder:
    """The tree of a page, with the end tags and table parts that authors may leave out."""

    def __init__(self) -> None:
        self.root = Node("html", {}, None)
        self.stack = [self.root]
        self.open: dict[str, int] = {}
        self.styles: list[str] = []

    def _pop(self) -> None:
        self.open[self.stack.pop().tag] -= 1

    def _close(self, tags: frozenset[str], walls: frozenset[str]) -> bool:
        """Close the innermost open element of ``tags`` and all inside it, unless a wall stands before it."""
        if not any(self.open.get(t) for t in tags):
            return False
        for i in range(len(self.stack) - 1, 0, -1):
            tag = self.stack[i].tag
            if tag in tags:
                while len(self.stack) > i:
                    self._pop()
                return True
            if tag in walls:
                return False
        return False

    def _until(self, tags: frozenset[str]) -> None:
        """Close what is open inside the innermost table, down to one of ``tags``."""
        while len(self.stack) > 1 and self.stack[-1].tag not in tags and self.stack[-1].tag != "table":
            self._pop()

    def _push(self, tag: str, attributes: dict[str, str]) -> None:
        top = self.stack[-1]
        if top.tag in SECTIONS | {"table", "tr"} and tag not in IN_TABLE | {"script", "style", "template"}:
            node = self._before_table(Node(tag, attributes, None))
        else:
            node = Node(tag, attributes, top)
            top.kids.append(node)
        if tag not in VOID:
            self.stack.append(node)
            self.open[tag] = self.open.get(tag, 0) + 1

    def _before_table(self, kid: Node | str) -> Node | str:
        """What has no place between cells stands before the table."""
        table = next(n for n in reversed(self.stack) if n.tag == "table")
        around = table.parent
        at = len(around.kids) - 1
        while around.kids[at] is not table:
            at -= 1
        around.kids.insert(at, kid)
        if isinstance(kid, Node):
            kid.parent = around
        return kid

    def text(self, text: str) -> None:
        top = self.stack[-1]
        if top.tag in SECTIONS | {"table", "tr", "colgroup"}:
            if text.strip(" \t\n\f\r") and self.open.get("table"):
                self._before_table(text)
            return
        if top.tag == "head":
            if not text.strip(" \t\n\f\r"):
                return
            self._pop()
        self.stack[-1].kids.append(text)

    def start(self, tag: str, attributes: dict[str, str]) -> None:
        if tag in ("html", "body"):
            if tag == "body" and self.open.get("head"):
                self._close(frozenset(["head"]), frozenset())
            self.root.attributes = self.root.attributes | attributes
            return
        if self.stack[-1].tag == "head" and tag not in OF_HEAD:
            self._pop()
        in_table = self.open.get("table")
        if tag in IN_TABLE:
            if not in_table:
                return
            if tag in ("td", "th"):
                self._until(frozenset(["tr"]) | SECTIONS)
                if self.stack[-1].tag != "tr":
                    self._push("tr", {})
            elif tag == "tr":
                self._until(SECTIONS)
            elif tag == "col":
                self._until(frozenset(["colgroup"]))
            else:
                self._until(frozenset())
        else:
            if tag in ENDS_P:
                self._close(frozenset(["p"]), WALLS)
            if tag == "li":
                self._close(frozenset(["li"]), WALLS | LISTS)
            elif tag in ("dd", "dt"):
                self._close(frozenset(["dd", "dt"]), WALLS | {"dl"})
            elif tag in HEADINGS and self.stack[-1].tag in HEADINGS:
                self._pop()
            elif tag in ("option", "optgroup"):
                if self.stack[-1].tag == "option":
                    self._pop()
                if tag == "optgroup" and self.stack[-1].tag == "optgroup":
                    self._pop()
        self._push(tag, attributes)

    def end(self, tag: str) -> None:
        if tag == "br":
            self._push("br", {})
        elif tag in IN_TABLE or tag == "table":
            self._close(frozenset([tag]), frozenset(["table"]) - {tag})
        elif tag in HEADINGS:
            self._close(HEADINGS, WALLS)
        elif tag == "p" and not self._close(frozenset(["p"]), WALLS):
            self._push("p", {})
            self._pop()
        elif tag not in ("p", "html", "body"):
            self._close(frozenset([tag]), WALLS - {tag})


def attributes_of(text: str) -> dict[str, str]:
    if not OF_USE.search(text):
        return {}
    found: dict[str, str] = {}
    for name, *values in ATTRIBUTE.findall(text):
        found.setdefault(name.lower(), unescape("".join(values)))
    return found


def parse(page: str) -> Builder:
    tree, at, size = Builder(), 0, len(page)
    lower = None
    while at < size:
        less = page.find("<", at)
        if less < 0:
            tree.text(unescape(page[at:]))
            break
        name = NAME.match(page, less + 1)
        if name is None:
            opener = page[less + 1 : less + 2]
            if opener not in ("!", "?", "/"):  # a plain character
                then = page.find("<", less + 1)
                then = size if then < 0 else then
                tree.text(unescape(page[at:then]))
                at = then
                continue
            if less > at:
                tree.text(unescape(page[at:less]))
            mark = "-->" if page.startswith("<!--", less) else "]]>" if page.startswith("<![CDATA[", less) else ">"
            if page.startswith(("<!-->", "<!--->"), less):
                mark = ">"
            over = page.find(mark, less + 2)
            at = size if over < 0 else over + len(mark)
            continue
        if less > at:
            tree.text(unescape(page[at:less]))
        rest = REST.match(page, name.end())
        over = rest.end() if rest else page.find(">", name.end()) + 1
        if not over:
            break  # the page ends inside a tag
        tag, at = name.group().lower(), over
        if tag[0] == "/":
            tree.end(tag[1:])
            continue
        inner = page[name.end() : over - 1]
        tree.start(tag, attributes_of(inner) if inner else {})
        if tag == "plaintext":
            tree.text(page[at:])
            break
        if tag in RAW or tag in ESCAPABLE:
            if lower is None:
                # Not lower(): it must keep every position.
                lower = page.translate(_FOLD) if not page.isascii() else page.lower()
            over = lower.find(f"</{tag}", at)
            over = size if over < 0 else over
            content = page[at:over]
            if tag == "style":
                tree.styles.append(content)
            tree.text(unescape(content) if tag in ESCAPABLE else content)
            tree.end(tag)
            at = page.find(">", over) + 1 or size
    return tree


_FOLD = {upper: upper + 32 for upper in range(65, 91)}


def declared(css: str) -> tuple[str | None, str | None]:
    """What declarations say of display and visibility."""
    display = visibility = None
    for part in css.lower().split(";"):
        name, _, value = part.partition(":")
        value = value.replace("!important", "").strip()
        if name.strip() == "display":
            display = value
        elif name.strip() == "visibility":
            visibility = value
    return display, visibility


def hiding_rules(styles: list[str]) -> dict[str, tuple[str | None, str | None]]:
    """Display and visibility by simple selector (element, .class or #id); other selectors and @-rules are not applied."""
    rules: dict[str, tuple[str | None, str | None]] = {}
    for css in styles:
        for selectors, body in RULE.findall(re.sub(r"/\*.*?\*/|@[^{};]*(?:;|\{(?:[^{}]*\{[^{}]*\})*[^{}]*\})", "", css, flags=re.S)):
            display, visibility = declared(body)
            if display or visibility:
                for selector in map(str.strip, selectors.split(",")):
                    if SIMPLE.match(selector):
                        old = rules.get(selector, (None, None))
                        rules[selector] = (display or old[0], visibility or old[1])
    return rules


class Out:
    """Lines being written: breaks and spaces wait until there is text to set apart."""

    def __init__(self) -> None:
        self.parts: list[str] = []
        self.breaks, self.space = 0, False
        self.indent, self.marker = "", ""

    def end_line(self, count: int = 1) -> None:
        self.breaks, self.space = max(self.breaks, count), False

    def _lead(self) -> None:
        if self.parts and self.breaks:
            self.parts.append("\n" * self.breaks)
        if self.breaks or not self.parts:
            self.parts.append(self.marker or self.indent)
            self.marker = ""
        elif self.space:
            self.parts.append(" ")
        self.breaks, self.space = 0, False

    def text(self, text: str) -> None:
        flat = SPACE.sub(" ", text)
        if flat[:1] == " ":
            self.space = True
        core = flat.strip(" ")
        if core:
            self._lead()
            self.parts.append(core)
            self.space = flat[-1] == " "

    def verbatim(self, text: str) -> None:
        for i, line in enumerate(text.replace("\r\n", "\n").split("\n")):
            if i:
                self.breaks += 1
            if line.strip():
                self.space = False
                self._lead()
                self.parts.append(line.rstrip())

    def result(self) -> str:
        return "".join(self.parts).replace("\xa0", " ")


def _number(text: str | None, default: int, most: int = 1000) -> int:
    return min(int(text), most) if text and text.strip().isascii() and text.strip().isdigit() else default


class Table:
    """Cells by row and column, as spans place them, and their layout in columns."""

    def __init__(self) -> None:
        self.rows: list[list[tuple[int, str]]] = []
        self.taken: dict[int, int] = {}  # column -> rows still covered from above
        self.captions: list[str] = []
        self.pending: dict[int, int] = {}  # the same, from cells of the open row
        self.after = 0

    def row(self) -> None:
        self.taken = {c: n - 1 for c, n in self.taken.items() if n > 1}
        self.rows.append([])

    def cell(self, text: str, across: int, down: int) -> None:
        if not self.rows:
            self.row()
        row = self.rows[-1]
        column = self.after if row else 0
        while column in self.taken:
            column += 1
        row.append((column, text))
        self.after = column + across
        if down > 1:
            self.pending |= dict.fromkeys(range(column, column + across), down)

    def close_row(self) -> None:
        self.taken |= self.pending
        self.pending = {}

    def lines(self) -> list[str]:
        widths: dict[int, int] = {}
        split = [[(c, t.split("\n")) for c, t in row] for row in self.rows]
        for row in split:
            for c, texts in row:
                widths[c] = max([widths.get(c, 0), *(len(t) for t in texts if len(t) <= WIDEST)])
        starts, at = {}, 0
        for c in range(max(widths, default=-1) + 1):
            starts[c] = at
            at += widths[c] + 2 if c in widths else 0
        out = [c for c in self.captions if c]
        for row in split:
            for i in range(max((len(t) for _, t in row), default=0)):
                line = ""
                for c, texts in row:
                    if i < len(texts) and texts[i]:
                        # A long cell pushes the next ones to the right; two spaces stay between them.
                        line = line.ljust(starts[c]) if len(line) + 2 <= starts[c] or not line else line + "  "
                        line += texts[i]
                if line.strip():
                    out.append(line.rstrip())
        return out


def _seen(node: Node, visible: bool, rules: dict) -> tuple[bool, bool]:
    """Whether the node's box exists, and whether text in it is visible."""
    tag, a = node.tag, node.attributes
    if tag in NEVER_SEEN or tag == "dialog" and "open" not in a:
        return False, False
    display = visibility = None
    if rules:
        for selector in (tag, *("." + c for c in a.get("class", "").split()), "#" + a.get("id", "")):
            found = rules.get(selector)
            if found:
                display, visibility = found[0] or display, found[1] or visibility
    if "hidden" in a and display is None:
        display = "none"
    if "style" in a:
        own = declared(a["style"])
        display, visibility = own[0] or display, own[1] or visibility
    if visibility in ("hidden", "collapse"):
        visible = False
    elif visibility == "visible":
        visible = True
    return display != "none", visible


def render(page: str | None) -> tuple[str, str]:
    """The title and the visible text of a page."""
    tree = parse((page or "").replace("\x00", ""))
    rules = hiding_rules(tree.styles) if tree.styles else {}
    title = ""
    out, tables, counters = Out(), [], []
    outs: list[Out] = []
    todo: list[tuple] = [("enter", tree.root, True, False)]
    while todo:
        what, node, visible, verbatim = todo.pop()
        if what == "text":
            if visible:
                out.verbatim(node) if verbatim else out.text(node)
            continue
        tag = node.tag
        if what == "leave":
            if tag in ("td", "th") and tables:
                cell, out = out, outs.pop()
                a = node.attributes
                tables[-1].cell(cell.result(), max(1, _number(a.get("colspan"), 1)), max(1, _number(a.get("rowspan"), 1, 65534)))
            elif tag == "caption" and tables:
                cell, out = out, outs.pop()
                tables[-1].captions.append(cell.result())
            elif tag == "tr" and tables:
                tables[-1].close_row()
            elif tag == "table":
                for line in tables.pop().lines():
                    out.end_line()
                    out._lead()
                    out.parts.append(line)
                out.end_line(2)
            elif tag in LISTS:
                counters.pop()
                out.end_line(1 if counters else 2)
            elif tag == "li":
                out.indent = out.indent[:-2]
                out.marker = ""
                out.end_line()
            elif tag == "dd":
                out.indent = out.indent[:-2]
                out.end_line()
            else:
                out.end_line(2 if tag in APART else 1)
            continue
        exists, visible = _seen(node, visible, rules)
        if not exists:
            if tag == "head" or tag == "title":
                inside = [node] if tag == "title" else [k for k in node.kids if isinstance(k, Node) and k.tag == "title"]
                title = title or SPACE.sub(" ", "".join(k for n in inside for k in n.kids if isinstance(k, str))).strip(" ")
            continue
        kids = node.kids
        if tag == "br":
            out.breaks, out.space = out.breaks + 1, False
            continue
        if tag in BLOCKS or tag in ("td", "th"):
            todo.append(("leave", node, visible, verbatim))
            if tag in ("td", "th", "caption") and tables:
                outs.append(out)
                out = Out()
            elif tag == "table":
                out.end_line(2)
                tables.append(Table())
            elif tag == "tr" and tables:
                tables[-1].row()
            elif tag in LISTS:
                out.end_line(1 if counters else 2)
                counters.append([tag, _number(node.attributes.get("start"), 1, 10**9), node.attributes])
            elif tag == "li":
                out.end_line()
                mark = "- "
                if counters and counters[-1][0] == "ol":
                    number = _number(node.attributes.get("value"), counters[-1][1], 10**9)
                    counters[-1][1] = number + 1
                    mark = f"{number}. "
                out.marker = out.indent + mark
                out.indent += "  "
            elif tag == "dd":
                out.end_line()
                out.indent += "  "
            else:
                out.end_line(2 if tag in APART else 1)
        if tag == "details" and "open" not in node.attributes:
            first = next((k for k in kids if isinstance(k, Node) and k.tag == "summary"), None)
            kids = [first] if first else []
        verbatim = verbatim or tag in ("pre", "textarea", "xmp", "plaintext", "listing")
        for kid in reversed(kids):
            todo.append(("text" if isinstance(kid, str) else "enter", kid, visible, verbatim))
    return title, out.result()


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, title, text of each page.

    Null or empty html gives empty texts. Broken markup never fails: a page that ends inside a tag ends there. Repeated
    rows each give a row; an empty table gives none. Other columns are ignored; null ids and urls stay null.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            made = [render(h) for h in rows["html"]]
            yield pd.DataFrame(
                {"page_id": rows["page_id"], "url": rows["url"], "title": [m[0] for m in made], "text": [m[1] for m in made]}
            )

    chosen = pages.select("page_id", F.col("url").cast("string"), F.col("html").cast("string"))
    id_type = chosen.schema["page_id"].dataType.simpleString()
    return chosen.mapInPandas(run, f"page_id {id_type}, url string, title string, text string")
