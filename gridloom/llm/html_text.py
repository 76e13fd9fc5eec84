"""Visible text of HTML pages as they would be laid out.

Tags are read in one pass over the page into a stack of open elements, with end tags implied
where HTML implies them; an element that is not displayed hides all inside it, and visibility
is inherited. Of style sheets those rules count that hold on every screen: blocks for print or
for screens of some size do not. Selectors of tags, classes and ids count, also several at once and
below others, by their specificity and importance; ones with attributes, states or siblings do not.
Text in svg and math is text, and so are the values that fields show.

Text runs into boxes: a list item, a table cell and the page are boxes of lines. A closed item
joins its parent behind its mark; a closed table joins with its columns aligned, wide characters
taking two. There is no recursion, so any depth of nesting does.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from html import unescape
from unicodedata import combining, east_asian_width

import pyarrow as pa
from pyspark.sql import DataFrame

from gridloom.llm.common import slices

# Fixed values of HTML: kinds of elements.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea xmp iframe noembed noframes noscript".split())
NOT_SHOWN = frozenset(
    "script style title template iframe noembed noframes noscript object video audio canvas datalist rp".split()
)
#: Inside svg and math these are not drawn, and those HTML tags end both.
UNDRAWN = frozenset(
    "defs symbol metadata desc clippath mask marker pattern lineargradient radialgradient annotation annotation-xml".split()
)
BREAKS_OUT = frozenset(
    "b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li menu nobr ol p pre ruby s "
    "small span strong strike sub sup table tt u ul var".split()
)
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre search section summary table ul".split()
)
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code del dfn em font i ins kbd label mark nobr q s samp small span strike strong "
    "sub sup tt u var".split()
)
SPACED = frozenset("blockquote dl figure h1 h2 h3 h4 h5 h6 hr menu ol p pre table ul".split())
#: A start tag closes an open p.
ENDS_P = BLOCKS - {"body", "html", "legend"}
HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))
LISTS = frozenset(("ul", "ol", "menu", "dir"))
#: A start tag closes these, up to the nearest of those.
CLOSES = {
    "li": ({"li"}, LISTS), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "option": ({"option"}, {"select", "datalist"}), "optgroup": ({"option", "optgroup"}, {"select"}),
    "td": ({"td", "th", "caption"}, {"table", "tr"}), "th": ({"td", "th", "caption"}, {"table", "tr"}),
    "tr": ({"td", "th", "tr", "caption"}, {"table"}),
    **{s: ({"td", "th", "tr", "caption", "thead", "tbody", "tfoot"}, {"table"}) for s in ("thead", "tbody", "tfoot")},
    **{h: (HEADINGS, {"section", "article", "div", "td", "th", "li"}) for h in HEADINGS},
}
#: An end tag inside these closes nothing outside.
BARRIERS = frozenset(("table", "td", "th", "caption", "html", "template"))
TABLE_PARTS = frozenset("table tr td th caption thead tbody tfoot html body".split())
BULLETS = ("•", "◦", "▪")
#: Displays that begin and end a line, elements that have one, and fields whose value is not shown.
AS_BLOCK = frozenset("block flex grid flow-root list-item table".split())
OWN_LINE = frozenset(("option", "optgroup"))
UNSHOWN_FIELDS = frozenset("hidden password checkbox radio file range color image".split())
BUTTONS = frozenset(("submit", "button", "reset"))

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<([a-zA-Z][^\s/>]*+)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>|</([a-zA-Z][^\s/>]*+)[^>]*+>?|<[!?/][^>]*+>?",
    re.S,
)
ATTRIBUTE = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+)))?")
WANTED = re.compile(r"hidden|style|type|open|span|start|value|class|id|placeholder", re.I)
SHOWING = re.compile(r"(?:^|[;{\s])(display|visibility)\s*:\s*([\w-]+)\s*(!\s*important)?", re.I)
SHEET = re.compile(r"<style\b([^>]*)>(.*?)(?:</style|\Z)", re.I | re.S)
MEDIA = re.compile(r"\bmedia\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+))", re.I)
COMMENT = re.compile(r"/\*.*?(?:\*/|\Z)", re.S)
BRACE = re.compile(r"([^{}]*)([{}])")
#: A slash at the end that belongs to an unquoted value.
VALUE_SLASH = re.compile(r"=\s*[^\s\"'>]*/\Z")
COMPOUND = re.compile(r"([a-z][a-z0-9-]*|\*)?((?:[.#][\w-]+)*)$", re.I)
NAME = re.compile(r"([.#])([\w-]+)")
SPACES = re.compile(r"[ \t\n\r\f]+")


class Box:
    """Lines of text, the last one open."""

    __slots__ = ("lines", "open", "gap")

    def __init__(self) -> None:
        self.lines: list[str] = []
        self.open: list[str] = []
        self.gap = False  # a blank line is due before the next text

    def text(self, words: str) -> None:
        """Adds collapsed text; a blank at a line's beginning or after another one is dropped."""
        if words[0] == " " and (not self.open or self.open[-1][-1] == " "):
            words = words[1:]
        if words:
            if not self.open:
                self._fill_gap()
            self.open.append(words)

    def _fill_gap(self) -> None:
        if self.gap and self.lines:
            self.lines.append("")
        self.gap = False

    def end_line(self, always: bool = False) -> None:
        if self.open or always:
            if not self.open:
                self._fill_gap()
            self.lines.append("".join(self.open).rstrip(" "))
            self.open = []

    def space(self) -> None:
        self.end_line()
        self.gap = True

    def add(self, lines: list[str]) -> None:
        self.end_line()
        if lines:
            self._fill_gap()
            self.lines += lines

    def close(self) -> list[str]:
        self.end_line()
        while self.lines and not self.lines[-1]:
            self.lines.pop()
        return self.lines


def columns(line: str) -> int:
    """Columns that a line takes: wide characters two, combining ones none."""
    if line.isascii():
        return len(line)
    return sum(0 if combining(c) else 2 if east_asian_width(c) in "WF" else 1 for c in line)


class Table:
    """Rows of (lines, columns spanned); ``held`` has the columns kept by cells of earlier rows."""

    def __init__(self) -> None:
        self.rows: list[list[tuple[list[str], int]]] = []
        self.held: dict[int, int] = {}
        self.taken: set[int] = set()  # of the open row
        self.caption: list[str] = []

    def start_row(self) -> None:
        self.rows.append([])
        self.taken = set(self.held)
        self.held = {at: n - 1 for at, n in self.held.items() if n > 1}

    def cell(self, lines: list[str], across: int, down: int) -> None:
        if not self.rows:
            self.start_row()
        row = self.rows[-1]
        at = sum(n for _, n in row)
        while at in self.taken:
            row.append(([], 1))
            at += 1
        row.append((lines, across))
        if down > 1:
            for k in range(at, at + across):
                self.held[k] = down - 1

    def render(self) -> list[str]:
        width: dict[int, int] = {}
        for row in self.rows:
            at = 0
            for lines, across in row:
                if across == 1:
                    width[at] = max(width.get(at, 0), *map(columns, lines)) if lines else width.get(at, 0)
                at += across
        out = list(self.caption)
        for row in self.rows:
            for k in range(max((len(lines) for lines, _ in row), default=0)):
                at, parts = 0, []
                for lines, across in row:
                    room = sum(width.get(c, 0) for c in range(at, at + across)) + 2 * (across - 1)
                    line = lines[k] if k < len(lines) else ""
                    parts.append(line + " " * (room - columns(line)))
                    at += across
                out.append("  ".join(parts).rstrip(" "))
        return out


class Element:
    __slots__ = ("tag", "box", "hidden", "unseen", "pre", "table", "list_depth", "number", "mark", "spans", "closed_details", "line", "names")

    def __init__(self, tag: str, parent: Element | None) -> None:
        self.tag = tag
        self.box = parent.box if parent else Box()
        self.hidden = parent.hidden if parent else False
        self.unseen = parent.unseen if parent else False  # a child may be seen again
        self.pre = parent.pre if parent else False
        self.table = parent.table if parent else None
        self.list_depth = parent.list_depth if parent else 0
        self.number: int | None = None  # of an ordered list's next item
        self.mark = ""
        self.spans = (1, 1)
        self.closed_details = False
        self.line = False  # an inline element that stands on lines of its own
        self.names: frozenset[str] = frozenset((tag,))  # tag, .class and #id, for selectors


def _for_screen(media: str) -> bool:
    """Holds on every screen; a query about its size need not."""
    return any(" ".join(q.lower().split()) in ("", "all", "screen", "only all", "only screen") for q in media.split(","))


def _applies(at_rule: str) -> bool:
    name, _, rest = at_rule.partition(" ")
    if name.lower().startswith("@media"):
        return _for_screen(at_rule[6:])
    return name.lower() == "@layer" or name.lower().startswith("@supports") and "not" not in rest.lower().split()


def _rules(sheet: str) -> Iterator[tuple[str, str]]:
    """(selectors, declarations) that hold on a screen."""
    around: list[str] = []
    for m in BRACE.finditer(COMMENT.sub(" ", sheet)):
        if m[2] == "{":
            around.append(m[1].rpartition(";")[2].strip())
        elif around:
            selectors = around.pop()
            if not selectors.startswith("@") and all(x.startswith("@") and _applies(x) for x in around):
                yield selectors, m[1]


#: (names, whether the next one is the parent) from the element outward
Selector = list[tuple[frozenset[str], bool]]
#: {name of the element: [(selector, property, rank, value)]}
Sheets = dict[str, list[tuple[Selector, str, tuple, str]]]


def _selector(text: str) -> tuple[Selector, tuple[int, int, int]] | None:
    """A selector of tags, classes and ids with its specificity; None for any other."""
    parts, found = text.replace(">", " > ").split(), []
    ids = classes = tags = 0
    child = False
    for part in reversed(parts):
        if part == ">":
            if not found or child:
                return None
            child = True
            continue
        m = COMPOUND.match(part)
        if not m:
            return None
        names = {kind + name for kind, name in NAME.findall(m[2])}
        ids, classes = ids + m[2].count("#"), classes + m[2].count(".")
        if m[1] and m[1] != "*":
            names.add(m[1].lower())
            tags += 1
        if found and child:
            found[-1] = (found[-1][0], True)
        child = False
        found.append((frozenset(names), False))
    return (found, (ids, classes, tags)) if found and not child else None


def _showing_rules(page: str) -> Sheets:
    """What the page's style sheets say of display and visibility; later rules replace earlier."""
    found: Sheets = {}
    if "display" in page or "visibility" in page:
        place = 0
        for sheet in SHEET.finditer(page):
            media = MEDIA.search(sheet[1])
            if media and not _for_screen(media[1] or media[2] or media[3] or ""):
                continue
            for selectors, body in _rules(sheet[2]):
                for name, value, important in SHOWING.findall(body):
                    place += 1
                    for text in selectors.split(","):
                        if read := _selector(text):
                            selector, weight = read
                            key = min(selector[0][0], key=lambda n: (n[0] != "#", n[0] != ".", n), default="")
                            rank = (bool(important), False, weight, place)
                            found.setdefault(key, []).append((selector, name.lower(), rank, value.lower()))
    return found


def _number(text: str | None, least: int = 1, most: int = 1000) -> int:
    return min(max(int(text), least), most) if text and text.strip().isascii() and text.strip().isdigit() else least


class Page:
    def __init__(self, page: str) -> None:
        self.rules = _showing_rules(page)
        root = Element("html", None)
        self.stack, self.count = [root], Counter(["html"])

    # Elements

    def open(self, tag: str, raw: str) -> None:
        attributes: dict[str, str] = {}
        if raw and WANTED.search(raw):
            for m in ATTRIBUTE.finditer(raw):
                value = m[2] if m[2] is not None else m[3] if m[3] is not None else m[4] or ""
                attributes.setdefault(m[1].lower(), unescape(value) if "&" in value else value)
        if tag in ("html", "body", "head"):
            top = self.stack[-1]
            top.names |= self._names(tag, attributes)
            showing = self._showing(top.names, self.stack[:-1], attributes)
            if self._not_shown(tag, attributes, showing):
                top.hidden = True
            top.unseen = self._unseen(top, showing)
            return
        if self.foreign and tag in BREAKS_OUT and not self.count["foreignobject"] and not self.count["desc"]:
            self._close_from(next(k for k, e in enumerate(self.stack) if e.tag in ("svg", "math")))
        self._imply(tag)
        parent = self.stack[-1]
        names = self._names(tag, attributes) if self.rules else frozenset()
        showing = self._showing(names, self.stack, attributes)
        line = tag not in BLOCKS and tag not in TABLE_PARTS and (tag in OWN_LINE or showing.get("display") in AS_BLOCK)
        hidden = parent.hidden or self._not_shown(tag, attributes, showing) or parent.closed_details and tag != "summary"
        if tag in BLOCKS and not hidden:
            parent.box.space() if tag in SPACED and not (tag in LISTS and parent.list_depth) else parent.box.end_line()
        if line and not hidden:
            parent.box.end_line()
        if tag in VOID:
            if not hidden and not self._unseen(parent, showing):
                self._void(tag, parent, attributes)
            return
        e = Element(tag, parent)
        e.hidden, e.unseen, e.line, e.names = hidden, self._unseen(parent, showing), line, names
        if tag == "text" and self.foreign and not hidden:
            e.box.end_line()
        if tag in ("pre", "textarea"):
            e.pre = True
        elif tag == "details":
            e.closed_details = "open" not in attributes
        elif tag in LISTS:
            e.list_depth += 1
            if tag == "ol":
                e.number = _number(attributes.get("start"), 1, 10**9)
        elif tag == "li":
            e.box = Box()
            around = next((x for x in reversed(self.stack[-3:]) if x.tag in LISTS), None)
            if around is not None and around.number is not None:
                if attributes.get("value"):
                    around.number = _number(attributes["value"], 1, 10**9)
                e.mark = f"{around.number}. "
                around.number += 1
            else:
                e.mark = BULLETS[min(max(e.list_depth, 1), len(BULLETS)) - 1] + " "
        elif tag in ("dd", "blockquote"):
            e.box, e.mark = Box(), "    " if tag == "dd" else "> "
        elif tag == "table":
            e.table = Table()
        elif tag == "tr" and e.table is not None and not e.hidden:
            e.table.start_row()
        elif tag in ("td", "th", "caption") and e.table is not None:
            e.box, e.list_depth = Box(), 0
            e.spans = _number(attributes.get("colspan"), 1, 100), _number(attributes.get("rowspan"), 1, 1000)
        elif tag in ("td", "th") and not e.hidden:
            e.box.text(" ")
        self.stack.append(e)
        self.count[tag] += 1

    @property
    def foreign(self) -> bool:
        return self.count["svg"] > 0 or self.count["math"] > 0

    def _names(self, tag: str, attributes: dict[str, str]) -> frozenset[str]:
        given = ["." + c for c in attributes.get("class", "").split()]
        return frozenset([tag, *given, "#" + attributes["id"]] if "id" in attributes else [tag, *given])

    def _showing(self, names: frozenset[str], around: list[Element], attributes: dict[str, str]) -> dict[str, str]:
        """display and visibility of an element, as far as it or a style sheet states them."""
        best: dict[str, tuple[tuple, str]] = {}
        if self.rules:
            for key in ("", *names):
                for selector, name, rank, value in self.rules.get(key, ()):
                    if (name not in best or rank > best[name][0]) and self._matches(selector, names, around):
                        best[name] = rank, value
        if "style" in attributes:
            for place, (name, value, important) in enumerate(SHOWING.findall(attributes["style"])):
                rank = (bool(important), True, (0, 0, 0), place)
                if name.lower() not in best or rank > best[name.lower()][0]:
                    best[name.lower()] = rank, value.lower()
        return {name: value for name, (_, value) in best.items()}

    @staticmethod
    def _matches(selector: Selector, names: frozenset[str], around: list[Element]) -> bool:
        wanted, parent = selector[0]
        if not wanted <= names:
            return False
        at = len(around) - 1
        for wanted, next_is_parent in selector[1:]:
            if parent:
                if at < 0 or not wanted <= around[at].names:
                    return False
            else:
                while at >= 0 and not wanted <= around[at].names:
                    at -= 1
                if at < 0:
                    return False
            at, parent = at - 1, next_is_parent
        return True

    def _not_shown(self, tag: str, attributes: dict[str, str], showing: dict[str, str]) -> bool:
        if tag in NOT_SHOWN or tag in UNDRAWN and self.foreign or tag == "dialog" and "open" not in attributes:
            return True
        return showing.get("display") == "none" or "hidden" in attributes and attributes["hidden"] != "until-found"

    def _unseen(self, parent: Element, showing: dict[str, str]) -> bool:
        value = showing.get("visibility")
        return value in ("hidden", "collapse") if value in ("hidden", "collapse", "visible", "initial") else parent.unseen

    def _void(self, tag: str, parent: Element, attributes: dict[str, str]) -> None:
        if tag == "br":
            parent.box.end_line(always=True)
        elif tag == "input" and (kind := attributes.get("type", "").lower()) not in UNSHOWN_FIELDS:
            value = attributes.get("value") or ("" if kind in BUTTONS else attributes.get("placeholder", ""))
            if shown := SPACES.sub(" ", value).strip():
                parent.box.text(shown if kind in BUTTONS else f" {shown} ")

    def _imply(self, tag: str) -> None:
        """Closes what the start of ``tag`` closes, and opens a row for a bare cell."""
        if tag in CLOSES:
            ended, within = CLOSES[tag]
            if any(self.count[t] for t in ended):
                for k in range(len(self.stack) - 1, 0, -1):
                    open_tag = self.stack[k].tag
                    if open_tag in within:
                        break
                    if open_tag in ended:
                        self._close_from(k)
                        if tag in ("li", "dt", "dd") or tag in HEADINGS:
                            break
        if self.count["p"] and tag in ENDS_P:
            for k in range(len(self.stack) - 1, 0, -1):
                if self.stack[k].tag in BARRIERS:
                    break
                if self.stack[k].tag == "p":
                    self._close_from(k)
                    break
        if tag == "a" and self.count["a"]:
            self.end("a")
        if tag in ("td", "th"):
            for e in reversed(self.stack):
                if e.tag == "tr":
                    break
                if e.tag == "table":
                    self.open("tr", "")
                    break

    def end(self, tag: str) -> None:
        if tag == "br":
            self.open("br", "")
        elif tag == "p" and not self.count["p"]:
            if not self.stack[-1].hidden:
                self.stack[-1].box.space()
        elif tag not in ("html", "body", "head") and self.count[tag]:
            for k in range(len(self.stack) - 1, 0, -1):
                if self.stack[k].tag == tag:
                    if tag in INLINE and not self.stack[k].hidden and any(e.tag in BLOCKS for e in self.stack[k + 1 :]):
                        del self.stack[k]  # blocks inside an inline element outlast it
                        self.count[tag] -= 1
                    else:
                        self._close_from(k)
                    break
                if self.stack[k].tag in BARRIERS and tag not in TABLE_PARTS:
                    break

    def _close_from(self, k: int) -> None:
        while len(self.stack) > k:
            e = self.stack.pop()
            self.count[e.tag] -= 1
            parent = self.stack[-1]
            if e.hidden:
                continue
            if e.tag in ("td", "th") and e.table is not None and e.box is not parent.box:
                e.table.cell(e.box.close(), *e.spans)
            elif e.tag == "caption" and e.table is not None:
                e.table.caption += e.box.close()
            elif e.tag == "table":
                parent.box.add(e.table.render())
                parent.box.space()
            elif e.tag in ("li", "dd", "blockquote"):
                indent = e.mark if e.tag == "blockquote" else " " * len(e.mark)
                lines = e.box.close()
                parent.box.add([(indent if i else e.mark) + line if line else "" for i, line in enumerate(lines)])
                if e.tag == "blockquote":
                    parent.box.space()
            elif e.tag == "text" and self.foreign or e.line:
                e.box.end_line()
            elif e.tag in BLOCKS:
                e.box.space() if e.tag in SPACED and not (e.tag in LISTS and e.list_depth > 1) else e.box.end_line()

    # Text

    def text(self, raw: str) -> None:
        top = self.stack[-1]
        if not raw or top.hidden or top.unseen or top.closed_details:
            return
        if top.tag in ("table", "tr", "thead", "tbody", "tfoot") and top.table is not None:
            if not raw.isspace():  # text between cells stands before the table
                table = next(k for k in range(len(self.stack) - 1, -1, -1) if self.stack[k].tag == "table")
                outer = self.stack[max(table - 1, 0)].box
                outer.text(SPACES.sub(" ", unescape(raw)))
            return
        shown = unescape(raw) if "&" in raw else raw
        if top.pre:
            first, *rest = shown.replace("\r\n", "\n").replace("\r", "\n").split("\n")
            if first:
                top.box.text(first) if first[0] != " " or top.box.open else top.box.open.append(first)
            for line in rest:
                top.box.end_line(always=True)
                if line:
                    top.box.open.append(line)
        elif shown := SPACES.sub(" ", shown):
            top.box.text(shown)

    def close(self) -> str:
        self._close_from(1)
        return "\n".join(self.stack[0].box.close()).replace("\xa0", " ")


def visible_text(page: str | None) -> str | None:
    """Text of a page in lines; null for null."""
    if page is None:
        return None
    reader, at, n = Page(page), 0, len(page)
    raw_ends: dict[str, re.Pattern[str]] = {}
    for m in iter(lambda: TOKEN.search(page, at), None):
        if m.start() > at:
            reader.text(page[at : m.start()])
        at = m.end()
        if m[1]:
            tag = m[1].lower()
            reader.open(tag, m[2])
            if reader.foreign and not reader.count["foreignobject"] and m[2].endswith("/") and not VALUE_SLASH.search(m[2]):
                reader.end(tag)
            elif tag in RAW:
                end = raw_ends.setdefault(tag, re.compile(f"</{tag}(?=[\\s/>])|\\Z", re.I)).search(page, at)
                content = page[at : end.start()]
                if tag == "textarea":
                    content = content.removeprefix("\n")
                reader.text(content)
                at = end.start()
            elif tag == "pre" and page.startswith("\n", at):
                at += 1
        elif m[3]:
            reader.end(m[3].lower())
    if at < n:
        reader.text(page[at:])
    return reader.close()


def extract_text(pages: DataFrame, html_col: str = "html", out_col: str = "text") -> DataFrame:
    """``pages`` with the visible text of ``html_col`` in ``out_col``, which is replaced if there.

    Null gives null, an empty page an empty text. Each page is read once and on its own, so
    repeated rows are alike and an empty table gives no rows.
    """
    names = [c for c in pages.columns if c != out_col]
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pages.schema.fields if f.name != out_col)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, html_col, 1 << 20):
            found = [visible_text(page.as_py()) for page in batch.column(html_col)]
            columns = [batch.column(c) for c in names]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(found, pa.string())], [*names, out_col])

    return pages.mapInArrow(run, f"{kept}, `{out_col}` string")
