"""HTML to Markdown.

Nesting (lists in lists, quotes, emphasis left open) needs a stack, which column
expressions have not got, so this is the one Python edge of the transforms. It
sees only the HTML column, in Arrow batches, and every row is on its own.
"""

from __future__ import annotations

import html
import re

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusflow.workers import ship_by_value, trim

_PIECE = re.compile(
    r"<!--.*?(?:-->|(?P<cut>\Z))|<(?P<raw>script|style|textarea)\b[^>]*>.*?(?:</(?P=raw)\s*>|(?P<open>\Z))"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][a-zA-Z0-9:-]*)"
    r"(?P<attrs>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+|[^>]*)>"
    r"|<[!?][^>]*>|(?P<text>[^<]+|<)",
    re.DOTALL | re.IGNORECASE,
)
_ATTRIBUTE = re.compile(r"([a-zA-Z_:][\w:.-]*)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")
_SPACE = re.compile(r"[ \t\n\r\f\v]+")
_ASCII_SPACE = " \t\n\r\f\v"

_INLINE = {"b": "**", "strong": "**", "i": "_", "em": "_", "code": "`", "a": ""}
#: Columns of indentation at most: deeper lists and quotes are written at that depth.
_DEEPEST = 60
_HEADINGS = {f"h{n}": "#" * n + " " for n in range(1, 7)}
_BLOCKS = set(
    "address article aside blockquote body dd details div dl dt fieldset figcaption figure footer form header "
    "hr html li main nav ol p pre section summary table tbody tfoot thead tr ul".split()
) | set(_HEADINGS)


class _Writer:
    """Blocks written so far, plus the block being filled."""

    def __init__(self) -> None:
        self.blocks: list[tuple[bool, str]] = []
        self.parts: list[str] = []
        self.open: list[tuple[str, str, int]] = []
        #: Inline tags opened again inside themselves: they add no marks, and their ends close nothing.
        self.nested: dict[str, int] = {}
        #: The last character written to the block; a new block starts as after a space.
        self.last = " "
        self.lists: list[list] = []
        self.width = 0
        self.marker = ""
        self.quotes = 0
        self.heading = ""
        self.verbatim = False

    def put(self, part: str) -> None:
        if part:
            self.parts.append(part)
            self.last = part[-1]

    def text(self, raw: str) -> None:
        if self.verbatim:
            self.put(html.unescape(raw))
            return
        collapsed = _SPACE.sub(" ", html.unescape(raw))
        self.put(collapsed.lstrip(" ") if self.last in " \n" else collapsed)

    def open_inline(self, tag: str, href: str) -> None:
        if any(entry[0] == tag for entry in self.open):
            self.nested[tag] = self.nested.get(tag, 0) + 1
            return
        self.open.append((tag, href, len(self.parts)))
        self.parts.append("")

    def close_inline(self) -> None:
        tag, href, start = self.open.pop()
        inner = "".join(self.parts[start:])
        core = inner.strip(_ASCII_SPACE)
        if core and not self.verbatim:
            lead = inner[: len(inner) - len(inner.lstrip(_ASCII_SPACE))]
            tail = inner[len(inner.rstrip(_ASCII_SPACE)) :]
            mark = _INLINE[tag]
            core = f"[{core}]({href})" if tag == "a" and href else mark + core + mark
            inner = lead + core + tail
        self.parts[start:] = [inner]
        self.last = inner[-1] if inner else self.last

    def flush(self) -> None:
        while self.open:
            self.close_inline()
        self.nested.clear()
        body = "".join(self.parts)
        self.parts = []
        self.last = " "
        if self.verbatim:
            body = "```\n" + body.strip("\n") + "\n```" if body.strip(_ASCII_SPACE) else ""
        else:
            body = body.strip(_ASCII_SPACE)
        if not body:
            return
        body = self.heading + body
        if self.lists:
            width = max(len(self.marker), min(self.width, _DEEPEST))
            lead = " " * (width - len(self.marker)) + self.marker if self.marker else " " * width
            body = lead + body.replace("\n", "\n" + " " * width)
        if self.quotes:
            bars = "> " * min(self.quotes, _DEEPEST // 2)
            body = "\n".join(bars + line for line in body.split("\n"))
        self.blocks.append((bool(self.marker), body))
        self.marker = ""

    def start(self, tag: str, attrs: str) -> None:
        if tag in _BLOCKS:
            self.flush()
            self.heading = _HEADINGS.get(tag, "")
        if tag in _INLINE:
            self.open_inline(tag, _attribute(attrs, "href").strip() if tag == "a" else "")
        elif tag in ("ul", "ol"):
            self.lists.append([tag == "ol", 0, ""])
        elif tag == "li":
            if not self.lists:
                self.lists.append([False, 0, ""])
            level = self.lists[-1]
            level[1] += 1
            self.width -= len(level[2])
            level[2] = self.marker = f"{level[1]}. " if level[0] else "* "
            self.width += len(level[2])
        elif tag == "blockquote":
            self.quotes += 1
        elif tag == "pre":
            self.verbatim = True
        elif tag == "br":
            self.put("\n" if self.verbatim else "  \n")
        elif tag == "hr":
            self.blocks.append((False, "* * *"))
        elif tag == "img":
            self.put(f"![{_attribute(attrs, 'alt')}]({_attribute(attrs, 'src').strip()})")
        elif tag in ("td", "th"):
            self.text(" ")

    def end(self, tag: str) -> None:
        if tag in _INLINE:
            if self.nested.get(tag):
                self.nested[tag] -= 1
            elif any(entry[0] == tag for entry in self.open):
                while self.open[-1][0] != tag:
                    self.close_inline()
                self.close_inline()
            return
        if tag not in _BLOCKS:
            return
        self.flush()
        self.heading = ""
        if tag in ("ul", "ol") and self.lists:
            self.width -= len(self.lists.pop()[2])
            self.marker = ""
        elif tag == "blockquote" and self.quotes:
            self.quotes -= 1
        elif tag == "pre":
            self.verbatim = False

    def result(self) -> str:
        self.flush()
        out: list[str] = []
        previous_item = False
        for is_item, body in self.blocks:
            if out:
                out.append("\n" if is_item and previous_item else "\n\n")
            out.append(body)
            previous_item = is_item
        return "".join(out)


def _attribute(attrs: str, wanted: str) -> str:
    for name, double, single, bare in _ATTRIBUTE.findall(attrs):
        if name.lower() == wanted:
            return html.unescape(double or single or bare)
    return ""


def convert(source: str) -> str:
    """Markdown of one HTML text."""
    writer = _Writer()
    in_head = False
    # No tag ends behind the last ">", so nothing is looked for there.
    end = source.rfind(">") + 1
    rest = source[end:].partition("<!--")[0]
    for piece in _PIECE.finditer(source, 0, end):
        if piece["cut"] is not None or piece["open"] is not None:
            rest = ""
        tag = piece["tag"]
        if tag:
            tag = tag.lower()
            if tag == "head":
                in_head = not piece["end"]
            elif tag == "body":
                in_head = False
            if in_head:
                continue
            if piece["end"]:
                writer.end(tag)
            else:
                writer.start(tag, piece["attrs"])
        elif piece["text"] and not in_head:
            writer.text(piece["text"])
    if rest and not in_head:
        writer.text(rest)
    return writer.result()


#: Texts that are Python strings at a time.
_FEW = 16


def converted(batch: pa.Array) -> pa.Array:
    """Markdown of a batch, of which only the Arrow columns and a few texts are held at a time."""
    parts = [pa.array([], pa.string())]
    for at in range(0, len(batch), _FEW):
        some = [convert(text.as_py()) if text.is_valid else None for text in batch.slice(at, _FEW)]
        parts.append(pa.array(some, pa.string()))
    return pa.concat_arrays(parts)


def html_to_markdown(column: Column) -> Column:
    """Markdown of an HTML column; null stays null."""

    @F.arrow_udf("string")
    def to_markdown(batch: pa.Array) -> pa.Array:
        out = converted(batch)
        trim()
        return out

    return to_markdown(column)


ship_by_value(__name__)
