"""The main text of web pages as the maximum-scoring run of words and tags.

A page is a sequence of words, which score positive or nothing by the element they stand
in, and of tags, which score negative by their name. Weights are log odds of
standing inside the content, counted on pages that mark their content themselves. One
scan finds the contiguous region of the highest score. Of it, elements that
are never content are left out, and the rest becomes one line for each block.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusflow.workers import ship_by_value

ship_by_value(__name__)

#: Pages whose weights are learned, at most, chosen by the hash of their id.
LABELLED_PAGES = 2000
#: Weights of what the labelled pages do not have, and bounds of those that they have.
WORD, TAG = 0.5, -1.0
WORD_BOUNDS, TAG_BOUNDS = (0.0, 4.0), (-8.0, -0.05)

#: Elements that end a block of text.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hr html li main menu nav ol optgroup option p pre section select summary table "
    "tbody td tfoot th thead title tr ul".split()
)
#: Elements that are not content wherever they stand.
NEVER = frozenset(
    "aside button canvas datalist dialog footer form head iframe input menu nav noscript object option script select "
    "style svg template textarea title".split()
)
#: Elements that hold what a page is about, and mark a page as labelled.
CONTENT = frozenset(("article", "main"))
#: Elements without an end tag.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = {name: re.compile(f"</{name}", re.I) for name in ("script", "style", "textarea", "title")}
#: Elements that are never left out, whatever their class.
WHOLE = CONTENT | {"html", "body"}
#: Whole classes, ids or roles that mark an element as something else than content.
SIDE = re.compile(
    r"(?:^|\s)(?:ad|ads|advert|advertisement|banner|breadcrumbs?|comments?|cookies?|disqus|menu|nav|navbar|newsletter|"
    r"notice|pagination|popup|promo|related|share|sharing|sidebar|social|sponsored|subscribe|toolbar|widget)(?:$|\s)",
    re.I,
)
_NAMED = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+))""", re.I)
_NAME = re.compile(r"/?([a-zA-Z][^\s/>]*)")
_STOP = re.compile(r"[\"'>]")


def _tag_end(page: str, at: int, unclosed: set[str]) -> int:
    """Behind the tag that begins before at; a > inside a quoted value does not end it."""
    while found := _STOP.search(page, at):
        mark, at = found.group(), found.end()
        if mark == ">":
            return at
        if mark not in unclosed and page[found.start() - 1] == "=":
            close = page.find(mark, at)
            if close < 0:
                unclosed.add(mark)
            else:
                at = close + 1
    return len(page)


def scan(page: str) -> Iterator[tuple[str, str, str]]:
    """(kind, name, body) of a page in order, in linear time: text, start and end tags; comments are skipped."""
    at, unclosed = 0, set()
    while at < len(page):
        begin = page.find("<", at)
        if begin < 0:
            yield "text", "", page[at:]
            return
        if begin > at:
            yield "text", "", page[at:begin]
        named = _NAME.match(page, begin + 1)
        if named:
            at = _tag_end(page, named.end(), unclosed)
            name = named.group(1).lower()
            if page[begin + 1] == "/":
                yield "end", name, ""
                continue
            yield "start", name, page[named.end() : at]
            if name in RAW:
                close = RAW[name].search(page, at)
                stop = close.start() if close else len(page)
                yield "text", "", page[at:stop]
                at = stop
        elif page.startswith("<!--", begin):
            stop = page.find("-->", begin + 4)
            at = len(page) if stop < 0 else stop + 3
        elif page[begin + 1 : begin + 2] in ("!", "?", "/"):
            stop = page.find(">", begin)
            at = len(page) if stop < 0 else stop + 1
        else:
            yield "text", "", "<"
            at = begin + 1


def items(page: str) -> list[tuple[str, str, str, str]]:
    """(type, kind, name, body): what scan gives, with the type that has a weight; words by their innermost block and link."""
    out, blocks, link = [], ["body"], 0
    for kind, name, body in scan(page):
        if kind == "text":
            out.append((f"word {blocks[-1]}" + (" a" if link else ""), kind, name, body))
            continue
        out.append((f"tag {name}" if kind == "start" else f"tag /{name}", kind, name, body))
        if name == "a":
            link = 1 if kind == "start" else 0
        elif name in BLOCKS or name in NEVER:
            if kind == "start" and name not in VOID:
                if blocks[-1] == "p" and name != "p":
                    pass
                elif blocks[-1] == name == "p":
                    blocks.pop()
                blocks.append(name)
            elif kind == "end" and name in blocks:
                while blocks.pop() != name:
                    pass
                blocks = blocks or ["body"]
    return out


def _words(kind: str, body: str) -> int:
    return len(body.split()) if kind == "text" else 1


def count_types(page: str) -> tuple[Counter, Counter] | None:
    """Types inside and outside the content of a page that marks it by one element; else None."""
    found = items(page)
    starts = [i for i, (_, kind, name, _) in enumerate(found) if kind == "start" and name in CONTENT]
    ends = [i for i, (_, kind, name, _) in enumerate(found) if kind == "end" and name in CONTENT]
    if not starts or not ends or len(starts) > 2:
        return None
    inside, outside = Counter(), Counter()
    for i, (type_, kind, name, body) in enumerate(found):
        if name not in CONTENT:
            (inside if starts[-1] < i < ends[0] else outside)[type_] += _words(kind, body)
    return inside, outside


def weights(counts: dict[str, tuple[int, int]]) -> dict[str, float]:
    """Log odds of each type from its counts inside and outside: words from nothing up, tags below nothing."""
    total = np.array([sum(c[i] for c in counts.values()) + 1.0 for i in (0, 1)])
    out = {}
    for name, seen in counts.items():
        odds = float(np.diff(np.log((np.array(seen[::-1]) + 0.5) / total[::-1]))[0])
        out[name] = float(np.clip(odds, *(WORD_BOUNDS if name.startswith("word") else TAG_BOUNDS)))
    return out


def region(found: list[tuple[str, str, str, str]], known: dict[str, float]) -> tuple[int, int]:
    """The contiguous stretch of items with the largest sum of weights; the first and shortest of equal ones."""
    best = total = 0.0
    begin = 0
    where = (0, 0)
    for i, (type_, kind, _, body) in enumerate(found):
        if kind == "text":
            weight = known.get(type_, WORD if not type_.endswith(" a") else 0.0) * _words(kind, body)
        else:
            weight = known.get(type_, TAG)
        if total <= 0:
            total, begin = 0.0, i
        total += weight
        if total > best:
            best, where = total, (begin, i + 1)
    return where


def _side(name: str, body: str) -> bool:
    """Whether an element's class, id or role says that it is no content."""
    if name in WHOLE or "=" not in body:
        return False
    return any(SIDE.search(a or b or c) for a, b, c in _NAMED.findall(body))


def _lines(found: list[tuple[str, str, str, str]], begin: int, end: int, kept: frozenset[int]) -> tuple[list[str], set[int]]:
    """Lines of a region, and where the elements start that hold all of it and are left out by their class.

    kept: starts of elements that are not left out.
    """
    lines, parts = [], []
    # Open elements, where they start, whether they are left out, and by class; the region may begin inside some.
    opened: list[tuple[str, int, bool, bool]] = []
    skipped = content = 0

    def flush() -> None:
        line = " ".join("".join(parts).split())
        if line:
            lines.append(line)
        parts.clear()

    for i, (_, kind, name, body) in enumerate(found[:end]):
        if kind == "text":
            if i >= begin and not skipped:
                parts.append(entities.unescape(body))
            continue
        if name in BLOCKS or name in NEVER:
            flush()
        elif name == "br":
            parts.append(" ")
        if name in VOID:
            continue
        if kind == "start":
            if name == "p" and opened and opened[-1][0] == "p":
                skipped -= opened.pop()[2]
            never = name in NEVER or (name == "header" and not content)
            side = not never and i not in kept and _side(name, body)
            out = never or side
            if out or name in BLOCKS or i in kept:
                opened.append((name, i, out, side))
                skipped += out
                content += name in CONTENT
        elif any(o[0] == name for o in opened):
            while True:
                last, _, out, _ = opened.pop()
                skipped -= out
                content -= last in CONTENT
                if last == name:
                    break
    flush()
    return lines, {i for _, i, _, side in opened if side and i < begin}


def main_text(page: str, known: dict[str, float]) -> str:
    """The content of a page: one line for each block, references decoded, runs of white space as one space.

    Inside the region, elements that are never content and those of a class that says so are left
    out; no class leaves out html, body, article, main or an element that holds the whole region.
    """
    found = items(page)
    begin, end = region(found, known)
    lines, around = _lines(found, begin, end, frozenset())
    if around:
        lines, _ = _lines(found, begin, end, frozenset(around))
    return "\n".join(lines)


def _pages(column: pa.Array) -> Iterator[str]:
    for value in column.cast(pa.large_binary()):
        raw = value.as_py()
        yield "" if raw is None else raw.decode("utf-8", "replace")


def _count_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        inside, outside = Counter(), Counter()
        for page in _pages(batch.column(0)):
            if counts := count_types(page):
                inside += counts[0]
                outside += counts[1]
        names = sorted({*inside, *outside})
        columns = [names, [inside[n] for n in names], [outside[n] for n in names]]
        types = [pa.string(), pa.int64(), pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["type", "inside", "outside"])


def learn(pages: DataFrame, page: str = "page_id", html: str = "html") -> dict[str, float]:
    """Weights from at most LABELLED_PAGES pages, of those that mark their content by one article or main element.

    Pages are chosen by the hash of their id; rows that share an id are chosen together, and rows without one take no
    part. Without labelled pages there are no weights, and every word and tag has the weight of the unknown.
    """
    ids = pages.where(F.col(page).isNotNull()).select(F.col(page).alias("_id")).distinct()
    # So few ids that they may go to every task.
    chosen = ids.orderBy(F.xxhash64("_id"), "_id").limit(LABELLED_PAGES)
    some = pages.select(F.col(page).alias("_id"), F.col(html).alias("_html")).join(F.broadcast(chosen), "_id", "left_semi")
    counted = some.select("_html").mapInArrow(_count_rows, "type string, inside long, outside long").groupBy("type")
    sums = counted.agg(F.sum("inside").alias("inside"), F.sum("outside").alias("outside"))
    # Types of at most LABELLED_PAGES pages, in an order that does not depend on the tasks.
    return weights({r["type"]: (r["inside"], r["outside"]) for r in sums.orderBy("type").collect()})


def extract(pages: DataFrame, known: dict[str, float], html: str = "html", out: str = "text") -> DataFrame:
    """pages with the main text of each in a column, empty where there is none.

    Null html counts as empty. A column of pages called as out, in any case, is replaced; rows are
    independent of each other.
    """
    names = [c for c in pages.columns if c.lower() != out.lower()]
    at = names.index(html)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(page, known) for page in _pages(batch.column(at))]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], [*names, out])

    kept = pages.select(*names)
    return kept.mapInArrow(run, T.StructType([*kept.schema.fields, T.StructField(out, T.StringType())]))
