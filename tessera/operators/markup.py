"""Markdown and HTML to units (survey C2-C6, H4, H5): sequential state, so Arrow batches through Python.

Both parsers read one document at a time and keep no state between documents."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame

UNITS = "document_id string, sequence_no int, unit_type string, text string, line_start int, line_end int, block_no int, paragraph_no int, row_no int, heading_path array<string>, css_selector string, xpath string, parent_sequence_no int"
_UNITS = pa.schema(
    [
        ("document_id", pa.string()), ("sequence_no", pa.int32()), ("unit_type", pa.string()), ("text", pa.string()), ("line_start", pa.int32()), ("line_end", pa.int32()),
        ("block_no", pa.int32()), ("paragraph_no", pa.int32()), ("row_no", pa.int32()), ("heading_path", pa.list_(pa.string())), ("css_selector", pa.string()),
        ("xpath", pa.string()), ("parent_sequence_no", pa.int32()),
    ]
)

#: Line forms of the supported Markdown. Fixed values.
HEADING = re.compile(r"^(#{1,6})\s+(.+?)\s*$")
LIST_ITEM = re.compile(r"^\s*(?:[-+*]|\d+[.)])\s+(.+?)\s*$")
FENCE = re.compile(r"^\s*(`{3,}|~{3,})(.*)$")
QUOTE = re.compile(r"^\s*>\s?(.*)$")


def _line_kinds(lines: list[str]) -> Iterator[tuple[int, str, str, str]]:
    """(line number, kind, text, marker) of each line; inside a fence everything is code until a closing line."""
    fence = ""
    for no, line in enumerate(lines, 1):
        if fence:
            closing = line.lstrip().startswith(fence)
            yield no, "fence_end" if closing else "code", line, ""
            fence = "" if closing else fence
        elif m := FENCE.match(line):
            fence = m[1]
            yield no, "fence", "", ""
        elif m := HEADING.match(line):
            yield no, "heading", m[2].strip(), m[1]
        elif m := QUOTE.match(line):
            yield no, "quote", m[1], ""
        elif m := LIST_ITEM.match(line):
            yield no, "list_item", m[1], ""
        else:
            yield no, "paragraph" if line.strip() else "blank", line, ""


def markdown_units(text: str) -> list[dict]:
    """Headings, paragraphs, list items, quotes and fenced code, with lines and heading path."""
    lines = text.split("\n")
    units: list[dict] = []
    path: list[str] = []
    open_block: dict | None = None

    def emit(kind: str, body: str, start: int, end: int) -> None:
        if body.strip():
            units.append({"sequence_no": len(units), "unit_type": kind, "text": body, "line_start": start, "line_end": end, "block_no": len(units) + 1, "heading_path": list(path)})

    def close(end: int) -> None:
        nonlocal open_block
        if open_block:
            emit(open_block["kind"], "\n".join(open_block["lines"]), open_block["start"], end)
        open_block = None

    for no, kind, body, marker in _line_kinds(lines):
        if kind == "code":
            open_block["lines"].append(body)
            continue
        if kind == "fence_end":
            close(no)
            continue
        if open_block and open_block["kind"] != kind:
            close(no - 1)
        if kind == "fence":
            open_block = {"kind": "code_block", "lines": [], "start": no}
        elif kind == "heading":
            path = [*path[: len(marker) - 1], body]
            emit("heading", body, no, no)
        elif kind == "list_item":
            emit("list_item", body, no, no)
        elif kind in ("quote", "paragraph"):
            open_block = open_block or {"kind": kind, "lines": [], "start": no}
            open_block["lines"].append(body)
    close(len(lines))
    return units


VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Tags that carry text units, and tags whose content is noise. Fixed values.
BLOCKS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6", "p", "li", "blockquote", "pre", "table"))
NOISE = frozenset(("script", "style", "noscript", "template", "form", "nav", "footer", "aside"))
KINDS = {"p": "paragraph", "li": "list_item", "blockquote": "quote", "pre": "code_block"} | {f"h{i}": "heading" for i in range(1, 7)}
#: A start tag of the key closes an open tag of the value first.
CLOSED_BY = {"li": ("li",), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",), "dt": ("dt", "dd"), "dd": ("dt", "dd")}


class Node:
    __slots__ = ("tag", "attrs", "parent", "children")

    def __init__(self, tag: str, attrs: dict[str, str | None], parent: Node | None):
        self.tag, self.attrs, self.parent, self.children = tag, attrs, parent, []

    def walk(self) -> Iterator[Node]:
        """Elements below in document order, without recursion."""
        stack = [iter(self.children)]
        while stack:
            node = next(stack[-1], None)
            if node is None:
                stack.pop()
            elif isinstance(node, Node):
                yield node
                stack.append(iter(node.children))

    def strings(self) -> Iterator[str]:
        stack = [iter(self.children)]
        while stack:
            node = next(stack[-1], None)
            if node is None:
                stack.pop()
            elif isinstance(node, Node):
                stack.append(iter(node.children))
            else:
                yield node

    def text(self) -> str:
        return " ".join(" ".join(s.strip() for s in self.strings() if s.strip()).split())

    def find(self, *tags: str) -> Node | None:
        return next((n for n in self.walk() if n.tag in tags), None)

    def ancestors(self) -> Iterator[Node]:
        node = self.parent
        while node:
            yield node
            node = node.parent


class _Tree(HTMLParser):
    """A tree from tags, with the usual closings left out by authors put in."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = self.at = Node("[document]", {}, None)

    def _close(self, tags: tuple[str, ...], until: tuple[str, ...]) -> None:
        node = self.at
        while node.parent and node.tag not in until:
            if node.tag in tags:
                self.at = node.parent
                return
            node = node.parent

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in BLOCKS or tag in ("div", "section", "article", "ul", "ol"):
            self._close(("p",), ("td", "th", "li", "blockquote", "div", "article", "section"))
        if tag in CLOSED_BY:
            while True:
                before = self.at
                self._close(CLOSED_BY[tag], ("table", "ul", "ol", "dl", "select"))
                if self.at is before:
                    break
        node = Node(tag, dict(attrs), self.at)
        self.at.children.append(node)
        if tag not in VOID:
            self.at = node

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.at.children.append(Node(tag, dict(attrs), self.at))

    def handle_endtag(self, tag: str) -> None:
        node = self.at
        while node.parent:
            if node.tag == tag:
                self.at = node.parent
                return
            node = node.parent

    def handle_data(self, data: str) -> None:
        self.at.children.append(data)


def html_tree(text: str) -> Node:
    tree = _Tree()
    tree.feed(text)
    tree.close()
    return tree.root


def _place(node: Node) -> int:
    siblings = [c for c in node.parent.children if isinstance(c, Node) and c.tag == node.tag] if node.parent else [node]
    return next(i for i, c in enumerate(siblings, 1) if c is node)


def locators(node: Node, root: Node) -> tuple[str, str]:
    """A CSS path and an XPath from the root to the node."""
    css, xpath = [], []
    for n in [node, *node.ancestors()]:
        if n.tag == "[document]":
            break
        place = _place(n)
        css.append(f"{n.tag}#{n.attrs['id']}" if n.attrs.get("id") else f"{n.tag}:nth-of-type({place})")
        xpath.append(f"{n.tag}[{place}]")
        if n is root:
            break
    return " > ".join(reversed(css)), "/" + "/".join(reversed(xpath))


def content_root(tree: Node, warnings: list[str], selector: str | None = None) -> Node:
    """The selected element (a tag, #id or .class), else article, main, body, or everything."""
    if selector:
        fits = {"#": lambda n: n.attrs.get("id") == selector[1:], ".": lambda n: selector[1:] in (n.attrs.get("class") or "").split()}.get(selector[0], lambda n: n.tag == selector.lower())
        if found := next((n for n in tree.walk() if fits(n)), None):
            return found
        warnings.append("HTML_SELECTOR_NOT_FOUND")
    for tag, warning in (("article", None), ("main", None), ("body", "HTML_FALLBACK_TO_BODY")):
        if found := tree.find(tag):
            warnings += [warning] if warning else []
            return found
    warnings.append("HTML_FALLBACK_TO_DOCUMENT")
    return tree


def _drop_noise(root: Node) -> None:
    for node in [n for n in root.walk() if n.tag in NOISE]:
        node.parent.children = [c for c in node.parent.children if c is not node]


def html_units(root: Node) -> list[dict]:
    """Blocks under the root in order; blocks inside blocks belong to the outer one."""
    units: list[dict] = []
    path: list[str] = []
    paragraphs = 0

    def emit(kind: str, text: str, css: str, xpath: str, **more: int) -> None:
        units.append({"sequence_no": len(units), "unit_type": kind, "text": text, "block_no": len(units) + 1, "heading_path": list(path), "css_selector": css, "xpath": xpath} | more)

    for node in root.walk():
        if node.tag not in BLOCKS:
            continue
        above = []
        for a in node.ancestors():
            if a is root:
                break
            above.append(a.tag)
        if node.tag == "table":
            _emit_table(node, root, emit, units)
        elif not BLOCKS.isdisjoint(above):
            continue
        elif text := node.text():
            if node.tag[0] == "h":
                path = [*path[: int(node.tag[1]) - 1], text]
            if node.tag == "pre":
                text = "\n".join(node.strings()).strip("\n")
            more = {}
            if node.tag == "p":
                paragraphs += 1
                more = {"paragraph_no": paragraphs}
            emit(KINDS[node.tag], text, *locators(node, root), **more)
    return units


def _emit_table(table: Node, root: Node, emit: Callable, units: list[dict]) -> None:
    rows = [[c.text() for c in tr.children if isinstance(c, Node) and c.tag in ("th", "td")] for tr in table.walk() if tr.tag == "tr"]
    rows = [r for r in rows if any(r)] or ([[table.text()]] if table.text() else [])
    if not rows:
        return
    caption = table.find("caption")
    title = [caption.text()] if caption and caption.text() else []
    css, xpath = locators(table, root)
    parent = len(units)
    emit("table", "\n".join([*title, *(" | ".join(r) for r in rows)]), css, xpath)
    for i, cells in enumerate(rows, 1):
        emit("table_row", " | ".join(cells), f"{css} tr:nth-of-type({i})", f"{xpath}//tr[{i}]", row_no=i, parent_sequence_no=parent)


def html_metadata(tree: Node, root: Node) -> dict[str, str | None]:
    """C4: title (og:title, title, first h1 or h2), canonical URL, site name, publication time, author, language."""
    clean = lambda s: " ".join((s or "").split()) or None
    meta = [n for n in tree.walk() if n.tag == "meta"]
    named = lambda attr, value: clean(next((n.attrs.get("content") for n in meta if n.attrs.get(attr) == value and n.attrs.get("content")), None))
    title, heading, page = tree.find("title"), root.find("h1", "h2"), tree.find("html")
    link = next((n.attrs.get("href") for n in tree.walk() if n.tag == "link" and "canonical" in (n.attrs.get("rel") or "").split() and n.attrs.get("href")), None)
    return {
        "title": named("property", "og:title") or (title and clean("".join(title.strings()))) or (heading and heading.text()) or None,
        "canonical_url": link,
        "site_name": named("property", "og:site_name"),
        "published_at": named("property", "article:published_time"),
        "author": named("name", "author"),
        "language": clean(page.attrs.get("lang")) if page else None,
    }


def _batches(parse: Callable[[str], list[dict]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[dict] = []
            for document_id, text in zip(batch.column("document_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                out += ({"document_id": document_id} | unit for unit in parse(text or ""))
                if len(out) >= 4096:
                    yield pa.RecordBatch.from_pylist(out, schema=_UNITS)
                    out = []
            yield pa.RecordBatch.from_pylist(out, schema=_UNITS)

    return run


def parse_markdown(docs: DataFrame) -> DataFrame:
    """Units of `docs` (document_id string, text)."""
    return docs.select("document_id", "text").mapInArrow(_batches(markdown_units), UNITS)


def _html(text: str, selector: str | None) -> list[dict]:
    root = content_root(html_tree(text), [], selector)
    _drop_noise(root)
    return html_units(root)


def parse_html(docs: DataFrame, selector: str | None = None) -> DataFrame:
    return docs.select("document_id", "text").mapInArrow(_batches(lambda text: _html(text, selector)), UNITS)


HTML_REPORT = "document_id string, title string, canonical_url string, site_name string, published_at string, author string, language string, warnings array<string>, parse_status string, element_count int, table_count int, table_row_count int"


def html_reports(docs: DataFrame, selector: str | None = None) -> DataFrame:
    """C4, C14: a row for each document: metadata, warnings, status and counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for document_id, text in zip(batch.column("document_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                warnings: list[str] = []
                tree = html_tree(text or "")
                root = content_root(tree, warnings, selector)
                _drop_noise(root)
                units = html_units(root)
                kinds = [u["unit_type"] for u in units]
                status = "failed" if not units else "partially_parsed" if warnings else "parsed"
                rows.append({"document_id": document_id, "warnings": warnings, "parse_status": status, "element_count": len(units), "table_count": kinds.count("table"), "table_row_count": kinds.count("table_row")} | html_metadata(tree, root))
            fields = [("document_id", pa.string()), *((n, pa.string()) for n in ("title", "canonical_url", "site_name", "published_at", "author", "language")), ("warnings", pa.list_(pa.string())), ("parse_status", pa.string()), *((n, pa.int32()) for n in ("element_count", "table_count", "table_row_count"))]
            yield pa.RecordBatch.from_pylist(rows, schema=pa.schema(fields))

    return docs.select("document_id", "text").mapInArrow(run, HTML_REPORT)
