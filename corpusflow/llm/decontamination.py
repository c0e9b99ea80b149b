"""Test items inside documents, by MinHash containment with sketches sized by the item.

Items are short and documents long, so a document's own minima would seldom be an
item's. Sketches are therefore taken of the items alone, and a document is asked
which of an item's sketch shingles it holds. An item's sketch is its smallest
shingle hashes; its size follows the item's: a document that holds enough of an item
lacks at most so many of its shingles, and the sketch has two more than that. So
two hits are due from every document that counts, and none is missed.

Documents are read once. A fixed-size bitmap of the sketches tells in the task which
documents can have a hit; only those send on the shingles that items have.
They are joined with the items' shingles, which counts sketch hits and verifies
the exact share at once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusflow.llm.near_duplicates import bitmap_hits, bitmap_of
from corpusflow.llm.words import ALPHANUMERIC, groups, shingle_hashes, shingles_of, word_hashes
from corpusflow.session import materialize
from corpusflow.workers import ship_by_value, trimmed

ship_by_value(__name__)

#: Sketch hits asked of a document, beyond the shingles that it may lack.
HITS = 2


def _length_rows(shingle: int):
    """The word counts of the rows that have fewer than a shingle's."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, data, offsets in groups(batch.column(1)):
                length = np.diff(word_hashes(data, offsets, ALPHANUMERIC)[3])
                yield pa.RecordBatch.from_arrays([pa.array(np.unique(length[(length > 0) & (length < shingle)]))], ["words"])

    return run


def _shingle_rows(shingle: int, sketch: np.ndarray | None, full: np.ndarray | None, short: tuple[int, ...] = ()):
    """id and distinct shingle hashes of each row; with bitmaps, of rows with a sketch hit those that items have.

    short: lengths of items that have fewer words than a shingle, at which rows are searched as well.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first_row, data, offsets in groups(batch.column(1)):
                words, _, _, first = word_hashes(data, offsets, ALPHANUMERIC)
                runs = shingle_hashes(words, shingle)
                # An item's words as one shingle are hashed with their number, so are all runs of that length.
                shorter = {n: shingle_hashes(words + np.uint64(n), n) for n in short}
                hit = None if sketch is None else np.concatenate([[0], np.cumsum(bitmap_hits(sketch, runs))])
                kept, sets = [], []
                for row, (begin, end) in enumerate(zip(first[:-1], first[1:], strict=True)):
                    if hit is not None and not short and end - begin >= shingle and hit[end - shingle + 1] == hit[begin]:
                        continue
                    parts = [r[begin : max(begin, end - n + 1)] for n, r in shorter.items()]
                    found = np.unique(np.concatenate([shingles_of(words, runs, begin, end, shingle), *parts]))
                    if sketch is not None:
                        if not bitmap_hits(sketch, found).any():
                            continue
                        found = found[bitmap_hits(full, found)]
                    kept.append(first_row + row)
                    sets.append(found.view(np.int64))
                if kept:
                    ids = batch.column(0).take(pa.array(kept))
                    yield pa.RecordBatch.from_arrays([ids, pa.array(sets, pa.list_(pa.int64()))], ["id", "hashes"])

    return run


def _shingles(rows: DataFrame, key: str, text: str, shingle: int, sketch=None, full=None, short=()) -> DataFrame:
    found = rows.select(F.col(key).cast("long"), F.col(text)).mapInArrow(
        trimmed(_shingle_rows(shingle, sketch, full, short)), "id long, hashes array<long>"
    )
    return found.select("id", F.explode("hashes").alias("hash")).distinct()


def sketched_items(items: DataFrame, item: str, text: str, shingle: int, percent: int) -> DataFrame:
    """item, hash, size, due, in_sketch: the shingles of the items, with their sketches marked."""
    sets = _shingles(items, item, text, shingle).groupBy("id").agg(F.sort_array(F.collect_list("hash")).alias("hashes"))
    size = F.size("hashes")
    lacking = F.floor(size * (100 - percent) / 100).cast("int")
    sized = sets.select(
        F.col("id").alias("item"), "hashes", size.alias("size"), F.least(F.lit(HITS), size - lacking).alias("due"), lacking.alias("lacking")
    )
    return sized.select("item", "size", "due", "lacking", F.posexplode("hashes").alias("place", "hash")).select(
        "item", "hash", "size", "due", (F.col("place") < F.col("lacking") + F.col("due")).alias("in_sketch")
    )


def contained_items(
    docs: DataFrame,
    items: DataFrame,
    doc: str = "doc_id",
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    shingle: int = 5,
    percent: int = 80,
) -> DataFrame:
    """(doc, item, n_common, n_item): the documents that hold at least percent of an item's shingles.

    Words are runs of ASCII letters and digits and of all that is not ASCII, A-Z
    lower-cased; an item's set holds its distinct runs of so many words, or all words as
    one run where it has fewer, which is then searched at its own length in every document. Null and
    blank texts have empty sets and match nothing. Rows that share an id are one document or item with the shingles of
    all of them, null being an id as well. Other columns are left out.
    """
    known = materialize(sketched_items(items, item, item_text, shingle, percent), "items")
    sketch = bitmap_of(known.where("in_sketch").select("hash"))
    full = bitmap_of(known.select("hash"))
    # At most one number for each length below a shingle's.
    lengths = items.select(F.col(item).cast("long"), F.col(item_text)).mapInArrow(trimmed(_length_rows(shingle)), "words long")
    short = tuple(sorted(r["words"] for r in lengths.distinct().collect()))
    held = _shingles(docs, doc, text, shingle, sketch, full, short)
    met = held.join(known, "hash").groupBy("id", "item", "size", "due").agg(
        F.count("*").alias("n_common"), F.count_if("in_sketch").alias("hits")
    )
    enough = met.where("hits >= due").where(100 * F.col("n_common") >= percent * F.col("size"))
    return enough.select(
        F.col("id").alias(doc), F.col("item").alias(item), "n_common", F.col("size").cast("long").alias("n_item")
    )
