"""Phrase mining by cohesion, with exact counts from counting quotient filters.

1. Texts become blocks of bounded size: local word numbers, 0 between pieces, and the block's vocabulary
   with counts. Vocabularies are summed per language and word; words below the threshold can be in no phrase.
2. Frequent words get global numbers. They come back to the blocks by a join with the block's own vocabulary,
   so no task holds more words than its block has. Rare words end a piece like punctuation.
3. Word pairs are counted, then runs of three and four whose pairs may all be frequent. Each task keeps sorted
   quotient filters (quotient_filter) of packed numbers and sends them cut by quotient; filters of
   a range are merged in order. The permutation deals phrases evenly, and a very
   frequent one is one entry of each filter, so no range is hot.
4. Cuts, scores, containment and ranks are joins over the frequent phrases.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusflow.llm import quotient_filter as qf
from corpusflow.llm.near_duplicates import bitmap_hits, bitmap_of
from corpusflow.llm.numbering import numbered
from corpusflow.llm.words import bounds, fold_case, groups, hash_spans, mix
from corpusflow.session import materialize
from corpusflow.workers import ship_by_value, trimmed

ship_by_value(__name__)

#: Bytes of text of a block, one longer text excepted; entries that a task's filters hold before they leave; entries of a range.
BLOCK_BYTES, HELD, RANGE = 4 << 20, 1 << 21, 1 << 20
#: Bits of the bitmap of frequent pairs: 16 for each, but no more than 32 megabytes. Fuller ones let more through, which changes no result.
PAIR_BITS, MOST_BITS = 16, 28
#: Words of a phrase.
LONGEST = 4

_BREAK = np.zeros(256, bool)
_BREAK[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
_INSIDE = ~_BREAK
_INSIDE[[0x20, 0x09]] = False
#: A block is a row for each of its words, and one row with its numbers.
_BLOCKS = "block long, place int, lang string, word string, n long, ids binary"


_BLOCK_NAMES = ["block", "place", "lang", "word", "n", "ids"]


def _arrow(column: np.ndarray | pa.Array) -> pa.Array:
    return pa.array(column) if isinstance(column, np.ndarray) else column


def _strings(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.Array:
    """The spans of bytes as an Arrow column of strings."""
    length = end - start
    offsets = np.concatenate([[0], np.cumsum(length)])
    at = np.arange(offsets[-1]) + np.repeat(start - offsets[:-1], length)
    return pa.LargeStringArray.from_buffers(len(start), pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data[at].tobytes()))


def _block_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    number = TaskContext.get().partitionId() << 32
    for batch in batches:
        langs = pc.fill_null(batch.column(0), "und").dictionary_encode()
        codes, names = langs.indices.to_numpy(zero_copy_only=False).astype(np.int64), langs.dictionary
        for first_row, data, offsets in groups(batch.column(1), BLOCK_BYTES):
            data = fold_case(data)
            start, end, first = bounds(data, offsets, _INSIDE)
            if not len(start):
                continue
            per_doc = np.diff(first)
            lang = np.repeat(codes[first_row : first_row + len(per_doc)], per_doc)
            keys = mix(hash_spans(data, start, end) ^ mix(lang.astype(np.uint64)))
            _, sample, local, counts = np.unique(keys, return_index=True, return_inverse=True, return_counts=True)
            # A word starts a piece if it is the first of its text or a break lies before it.
            breaks = np.cumsum(_BREAK[data], dtype=np.int64)
            starts = np.ones(len(start), bool)
            starts[1:] = breaks[start[1:] - 1] != breaks[end[:-1] - 1]
            starts[first[:-1][per_doc > 0]] = True
            ids = np.zeros(len(start) + int(starts.sum()), "<u4")
            ids[np.arange(len(start)) + np.cumsum(starts)] = local + 1
            words = _strings(data, start[sample], end[sample]).cast(pa.string())
            rows = np.arange(len(sample), dtype=np.int32)
            for i in range(0, len(sample), 1 << 14):
                some = slice(i, i + (1 << 14))
                size = len(rows[some])
                columns = [rows[some], names.take(pa.array(lang[sample[some]])).cast(pa.string()), words[some], counts[some], pa.nulls(size, pa.binary())]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(size, number)), *map(_arrow, columns)], _BLOCK_NAMES)
            nothing = [pa.nulls(1, kind) for kind in (pa.int32(), pa.string(), pa.string(), pa.int64())]
            yield pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), *nothing, pa.array([ids.tobytes()], pa.binary())], _BLOCK_NAMES)
            number += 1


def _translated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks in global numbers: columns ids, places (of the block's frequent words) and numbers."""
    for batch in batches:
        out = []
        for row in range(batch.num_rows):
            local = np.frombuffer(batch.column(0)[row].as_buffer(), "<u4")
            places, numbers = (batch.column(c)[row].values.to_numpy(zero_copy_only=False) for c in (1, 2))
            table = np.zeros(int(local.max(initial=0)) + 1, "<u4")
            table[places + 1] = numbers
            ids = table[local]
            # Only words with a neighbour matter, and one break between them is enough.
            there = np.concatenate([[False], ids > 0, [False]])
            near = (there[1:-1] & (there[2:] | there[:-2])) | (~there[1:-1] & there[:-2])
            out.append(ids[near].tobytes())
        yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["ids"])


def _packed(ids: np.ndarray, size: int, pairs: np.ndarray | None) -> tuple[np.ndarray, np.ndarray | None]:
    """hi and lo of every run of so many words; of longer ones than two only those whose pairs the bitmap knows."""
    two = (ids[:-1] << np.uint64(32)) | ids[1:]
    fits = (ids[:-1] > 0) & (ids[1:] > 0)
    if size == 2:
        return two[fits], None
    if pairs is not None:
        at = np.flatnonzero(fits)
        fits[at[~bitmap_hits(pairs, mix(two[at]))]] = False
    whole = fits[: len(ids) - size + 1].copy()
    for i in range(1, size - 1):
        whole &= fits[i : i + len(whole)]
    at = np.flatnonzero(whole)
    return two[at], two[at + 2] if size == 4 else ids[at + 2] << np.uint64(32)


def _filter_rows(sizes: list[int], bits: int, pairs: np.ndarray | None):
    """The quotient filters of a task's blocks, cut into ranges by the first bits of the quotient."""

    def cut(size: int, entries: qf.Entries) -> Iterator[tuple[int, int, bytes]]:
        prefix = (entries[0] >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(entries[0]), np.int64)
        places = np.flatnonzero(np.concatenate([[True], prefix[1:] != prefix[:-1], [True]])) if len(prefix) else [0]
        for begin, end in zip(places[:-1], places[1:], strict=True):
            yield size, int(prefix[begin]), qf.pack(tuple(x[begin:end] for x in entries), size, bits)

    def sent(held: dict[int, list[qf.Entries]]) -> Iterator[pa.RecordBatch]:
        for size, filters in held.items():
            rows = list(cut(size, qf.merged(filters))) if filters else []
            for i in range(0, len(rows), 4096):
                columns = zip(*rows[i : i + 4096], strict=True)
                kinds = pa.int32(), pa.int64(), pa.binary()
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["size", "range", "filter"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[qf.Entries]] = {size: [] for size in sizes}
        for batch in batches:
            for value in batch.column(0):
                ids = np.frombuffer(value.as_buffer(), "<u4").astype(np.uint64)
                for size in sizes:
                    if len(ids) >= size:
                        held[size].append(qf.counted(*_packed(ids, size, pairs)))
                if sum(len(e[0]) for filters in held.values() for e in filters) > HELD:
                    held = {size: [qf.merged(filters)] if filters else [] for size, filters in held.items()}
                    if 2 * sum(len(e[0]) for filters in held.values() for e in filters) > HELD:
                        yield from sent(held)
                        held = {size: [] for size in sizes}
        yield from sent(held)

    return run


def _merged_rows(least: int):
    def run(table: pa.Table) -> pa.Table:
        size, prefix = table["size"][0].as_py(), table["range"][0].as_py()
        keys, lo, counts = qf.merged(qf.unpack(raw.as_py(), prefix) for raw in table["filter"])
        often = counts >= least
        keys, lo, counts = keys[often], lo[often], counts[often]
        hi = qf.gathered(keys, lo)
        low = np.uint64(0xFFFFFFFF)
        numbers = np.stack([hi >> np.uint64(32), hi & low, lo >> np.uint64(32), lo & low], axis=1)[:, :size]
        ids = pa.FixedSizeListArray.from_arrays(pa.array(numbers.reshape(-1).astype(np.int64)), size).cast(pa.list_(pa.int64()))
        return pa.table({"ids": ids, "f": pa.array(counts, pa.int64()), "pair": pa.array(mix(hi).view(np.int64))})

    return run


def _frequent(blocks: DataFrame, sizes: list[int], least: int, words: int, pairs: np.ndarray | None) -> DataFrame:
    """ids, f, pair (hash of the first two words) of the phrases of these sizes that occur so often."""
    bits = max(0, (words // RANGE).bit_length())
    filters = blocks.mapInArrow(trimmed(_filter_rows(sizes, bits, pairs)), "size int, range long, filter binary")
    return filters.groupBy("size", "range").applyInArrow(_merged_rows(least), "ids array<long>, f long, pair long")


def _scored(phrases: DataFrame, words: DataFrame) -> DataFrame:
    """ids, a, l, r, score of every phrase of two words or more, by its lowest cut."""
    known = words.select(F.array("id").alias("ids"), "f").union(phrases)
    cut = phrases.select("ids", F.col("f").alias("a"), F.explode(F.sequence(F.lit(1), F.size("ids") - 1)).alias("k"))
    cut = cut.select("*", F.slice("ids", 1, F.col("k")).alias("first"), F.slice("ids", F.col("k") + 1, F.size("ids")).alias("rest"))
    cut = cut.join(known.toDF("first", "l"), "first").join(known.toDF("rest", "r"), "rest")
    # decimal * integer is exact, and `div` gives the floor of a positive quotient as a long.
    score = F.expr("(cast(a as decimal(20,0)) * 2000000) div (cast(l as decimal(20,0)) + r)")
    return cut.groupBy("ids", "a").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut")).select("ids", "a", "cut.l", "cut.r", "cut.score")


def _inside(phrases: DataFrame) -> DataFrame:
    """ids, longest: the count of the most frequent longer phrase that holds these two words or more in a row."""
    size = F.size("ids")
    spans = F.flatten(
        F.transform(
            F.sequence(F.lit(2), size - 1),
            lambda n: F.transform(F.sequence(F.lit(1), size - n + 1), lambda i: F.slice("ids", i, n)),
        )
    )
    return phrases.where(size > 2).select(F.explode(spans).alias("ids"), "f").groupBy("ids").agg(F.max("f").alias("longest"))


def _first_of(rows: DataFrame, key: str, order: list[Column], most: int) -> DataFrame:
    """The first so many rows of each key with their rank. Parts of a key are cut before they meet."""
    part = Window.partitionBy(key, F.pmod(F.xxhash64("phrase"), F.lit(64))).orderBy(*order)
    some = rows.withColumn("rank", F.row_number().over(part)).where(F.col("rank") <= most)
    return some.withColumn("rank", F.row_number().over(Window.partitionBy(key).orderBy(*order)).cast("long")).where(F.col("rank") <= most)


def collocations(
    docs: DataFrame, text: str = "text", lang: str = "lang", least: int = 30, covered: int = 80, most: int = 2000
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's most cohesive phrases of two to four words.

    A-Z is lower-cased; `.,;:!?` and line ends part pieces, spaces and tabs words. n counts all words of the
    language, a all occurrences of the phrase within pieces, overlapping ones too. Cutting a phrase in two gives l and r,
    the counts of the parts, and floor(2000000 * a / (l + r)); its lowest cut is its score, the first of equal ones. Phrases
    below `least` occurrences take no part. A phrase is dropped if it lies inside a longer one that has at
    least `covered` percent of its occurrences. Ties: more frequent first, then the bytes of the phrase.

    Null text counts as empty, null lang as `und`. Repeated rows count each time. Other columns are not
    read. No rows, or no phrase often enough, give no rows. Words are told apart by 64-bit hashes within a block.
    """
    source = docs.select(F.col(f"`{lang}`").alias("lang"), F.col(f"`{text}`").alias("text"))
    blocks = materialize(source.mapInArrow(trimmed(_block_rows), _BLOCKS), "phrase_blocks")
    entries = blocks.where(F.col("word").isNotNull())
    vocabulary = materialize(entries.groupBy("lang", "word").agg(F.sum("n").alias("f")), "phrase_vocabulary")
    totals = vocabulary.groupBy("lang").agg(F.sum("f").alias("n"))
    size = vocabulary.agg(F.sum("f")).first()[0] or 0

    words = numbered(vocabulary.where(F.col("f") >= least), [F.col("lang"), F.col("word")], "phrase_words", "id")
    words = materialize(words.withColumn("id", F.col("id") + 1), "phrase_numbers")
    known = entries.select("block", "place", "lang", "word").join(words.select("lang", "word", "id"), ["lang", "word"])
    own = known.groupBy("block").agg(F.collect_list(F.struct("place", "id")).alias("own"))
    met = blocks.where(F.col("ids").isNotNull()).select("block", "ids").join(own.hint("shuffle_hash"), "block")
    met = met.select("ids", F.col("own.place").alias("places"), F.col("own.id").alias("numbers"))
    runs = materialize(met.mapInArrow(trimmed(_translated), "ids binary"), "phrase_runs")

    pairs = materialize(_frequent(runs, [2], least, size, None), "phrase_pairs")
    bits = min(MOST_BITS, max(16, (PAIR_BITS * pairs.count()).bit_length()))
    longer = _frequent(runs, list(range(3, LONGEST + 1)), least, size, bitmap_of(pairs.select("pair"), bits))
    phrases = materialize(pairs.union(longer).select("ids", "f"), "phrases")

    scored = _scored(phrases, words).join(_inside(phrases), "ids", "left")
    kept = scored.where(F.col("longest").isNull() | (100 * F.col("longest") < covered * F.col("a"))).drop("longest")
    told = kept.select("ids", F.posexplode("ids").alias("at", "id")).join(words.select("id", "lang", "word"), "id")
    told = told.groupBy("ids").agg(F.max("lang").alias("lang"), F.sort_array(F.collect_list(F.struct("at", "word"))).alias("said"))
    named = kept.join(told.select("ids", "lang", F.array_join("said.word", " ").alias("phrase")), "ids")
    ranked = _first_of(named, "lang", [F.desc("score"), F.desc("a"), F.asc("phrase")], most)
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
