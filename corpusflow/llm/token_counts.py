"""Token counts of a corpus without token ids.

Texts fall into pre-tokens first, and a token never crosses one. So each distinct
pre-token of the corpus is tokenized once, and a document's count is the sum over
its pre-tokens.

1. The tasks find the distinct pre-tokens of each batch; grouped, they are the
   corpus vocabulary with the pieces of each.
2. The tasks count pre-tokens per document. Those of the most documents, a table of
   fixed size, are joined in the task; the others, of which each document has
   few, are joined with the vocabulary by a shuffle.
"""

from __future__ import annotations

import hashlib
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusflow.llm.words import mix
from corpusflow.session import materialize
from corpusflow.workers import ship_by_value

ship_by_value(__name__)

#: Pre-tokens joined in the task: at most so many, each of at most so many code points.
FREQUENT, FREQUENT_CHARS = 1 << 17, 64
#: Code points that are split together.
GROUP_CHARS = 1 << 20
#: Pre-tokens beyond this many code points are told apart by a digest.
LONG = 256

_OTHER, _LETTER, _NUMBER, _SPACE, _UNSEEN = range(5)
#: Unicode White_Space.
_WHITE = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
_K = np.array([0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93], np.uint64)


#: The classes of the code points met so far.
_KNOWN: dict[str, np.ndarray] = {}


def _kind(code: int) -> int:
    """The class of a code point; the library is asked where Python's Unicode ends."""
    kind = unicodedata.category(chr(code))
    if code in _WHITE:
        return _SPACE
    if kind != "Cn":
        return {"L": _LETTER, "N": _NUMBER}.get(kind[0], _OTHER)
    from tokenizers.pre_tokenizers import ByteLevel

    rule = ByteLevel(add_prefix_space=False)
    if len(rule.pre_tokenize_str("a" + chr(code))) == 1:
        return _LETTER
    return _NUMBER if len(rule.pre_tokenize_str("1" + chr(code))) == 1 else _OTHER


def _kinds(codes: np.ndarray) -> np.ndarray:
    """The class of each code point of a text: letter, number, white space or other."""
    if not _KNOWN:
        _KNOWN["kinds"] = np.full(0x110000, _UNSEEN, np.uint8)
    table = _KNOWN["kinds"]
    kinds = table[codes]
    unseen = kinds == _UNSEEN
    if unseen.any():
        for code in np.unique(codes[unseen]).tolist():
            table[code] = _kind(code)
        kinds = table[codes]
    return kinds


def _contractions(codes: np.ndarray, apart: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lengths of 's 't 'm 'd 're 've 'll at each apostrophe, else 0. apart: ends of texts."""
    at = np.flatnonzero(codes == 0x27)
    length = np.zeros(len(at), np.int64)
    padded = np.concatenate([codes, [0, 0]])
    ended = np.concatenate([apart, [True, True]])
    one, two = padded[at + 1], padded[at + 2]
    first, second = ~ended[at + 1], ~ended[at + 1] & ~ended[at + 2]
    pairs = np.isin(one.astype(np.int64) * 0x110000 + two, [ord(x) * 0x110000 + ord(y) for x, y in ("re", "ve", "ll")])
    length[second & pairs] = 3
    length[first & np.isin(one, [ord(x) for x in "stmd"])] = 2
    return at, length


def split(codes: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Starts of the pre-tokens of texts given as code points, by the rule of byte-level BPE.

    That is: contractions, an optional space and letters, numbers or other
    characters, and white space, of which the last one before a word goes to it if it is a space.
    """
    n = len(codes)
    if not n:
        return np.zeros(0, np.int64)
    kind = _kinds(codes)
    apart = np.zeros(n + 1, bool)
    apart[offsets] = True
    starts = np.ones(n, bool)
    starts[1:] = kind[1:] != kind[:-1]
    starts |= apart[:n]
    # An apostrophe begins a contraction where a match begins: where its run of other characters does, with no space before it.
    at, length = _contractions(codes, apart)
    for i, size in zip(at[length > 0], length[length > 0], strict=True):
        free = starts[i] and not (i and not apart[i] and codes[i - 1] == 0x20)
        if free:
            starts[i + 1 : i + size] = False
            if i + size < n:
                starts[i + size] = True
    # A run of white space before a word gives up its last character: to the word if it is a space, else as a piece of its own.
    last = np.flatnonzero((kind == _SPACE) & ~apart[1:] & (np.append(kind[1:], _SPACE) != _SPACE))
    space = codes[last] == 0x20
    starts[last] = True
    starts[last[space] + 1] = False
    return np.flatnonzero(starts)


def _hashes(codes: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each pre-token, two code points at a time over all at once."""
    padded = np.zeros(len(codes) + 2, "<u4")
    padded[: len(codes)] = codes
    lanes = np.ndarray((len(codes) + 1,), "<u8", padded, strides=(4,))
    low = np.uint64(0xFFFFFFFF)
    length = end - start
    h = mix(length.astype(np.uint64) + _K[0])
    for i in np.flatnonzero(length > LONG):
        digest = hashlib.blake2b(codes[start[i] : end[i]].tobytes(), digest_size=8).digest()
        h[i] = int.from_bytes(digest, "little")
    alive = np.flatnonzero(length <= LONG)
    at, rest = start[alive], length[alive]
    while len(at):
        lane = lanes[at]
        lane = np.where(rest == 1, lane & low, lane)
        h[alive] = mix(h[alive] ^ lane)
        more = rest > 2
        alive, at, rest = alive[more], at[more] + 2, rest[more] - 2
    return h


class Counted:
    """Distinct pre-tokens of some texts, and how often each document has each."""

    def __init__(self, texts: list[str]):
        whole = "".join(texts)
        codes = np.frombuffer(whole.encode("utf-32-le", "surrogatepass"), "<u4")
        offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
        start = split(codes, offsets)
        end = np.append(start[1:], len(codes))
        keys, first, which = np.unique(_hashes(codes, start, end), return_index=True, return_inverse=True)
        self.tokens = [whole[s:e] for s, e in zip(start[first].tolist(), end[first].tolist(), strict=True)]
        text = np.repeat(np.arange(len(texts)), np.diff(np.searchsorted(start, offsets)))
        cells, self.times = np.unique(text * max(1, len(keys)) + which, return_counts=True)
        self.text, self.token = np.divmod(cells, max(1, len(keys)))


def _texts(column: pa.Array) -> list[str]:
    return ["" if raw is None else raw.decode("utf-8", "replace") for raw in column.cast(pa.binary()).to_pylist()]


def _segments(text: str, specials: list[str]) -> tuple[list[str], list[str]]:
    """The stretches between special tokens, and the special tokens found."""
    found = []
    parts = [text]
    for special in specials:
        if special in text:
            parts = [piece for part in parts for piece in part.split(special)]
            found += [special] * text.count(special)
    return parts, found


def _grouped(batch: pa.RecordBatch, specials: list[str]) -> Iterator[tuple[int, int, list[str], list[int], np.ndarray]]:
    """(first row, rows, segments, row of each segment, special tokens of each row) of bounded groups of rows."""
    column = batch.column(1)
    row = 0
    while row < len(column):
        first, size, segments, owner, found = row, 0, [], [], []
        while row < len(column) and (size < GROUP_CHARS or row == first):
            (text,) = _texts(column.slice(row, 1))
            parts, seen = _segments(text, specials)
            segments += parts
            owner += [row - first] * len(parts)
            found.append(len(seen))
            size += len(text)
            row += 1
        yield first, row - first, segments, owner, np.array(found, np.int64)


def _vocabulary_rows(specials: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, segments, _, _ in _grouped(batch, specials):
                counted = Counted(segments)
                docs = np.bincount(counted.token, minlength=len(counted.tokens))
                yield pa.RecordBatch.from_arrays([pa.array(counted.tokens), pa.array(docs.astype("int64"))], ["token", "docs"])

    return run


def _piece_rows(path: str):
    """The number of pieces of each pre-token, by the tokenizers library."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        tokenizer.no_truncation()
        tokenizer.no_padding()
        for batch in batches:
            encoded = tokenizer.encode_batch_fast(batch.column(0).to_pylist(), add_special_tokens=False)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([len(e) for e in encoded], pa.int32())], ["token", "docs", "pieces"]
            )

    return run


def _document_rows(specials: list[str], frequent):
    """A row for each document with what its frequent pre-tokens sum to, and one for each rarer pre-token."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = frequent.value
        for batch in batches:
            for first, rows, segments, owner, found in _grouped(batch, specials):
                counted = Counted(segments)
                pieces = np.array([known.get(t, 0) for t in counted.tokens], np.int64)
                row = np.asarray(owner, np.int64)[counted.text]
                frequent_here = pieces[counted.token] > 0
                base = np.bincount(row, weights=(pieces[counted.token] * counted.times).astype(float), minlength=rows)
                ids = batch.column(0)
                size = pc.binary_length(pc.fill_null(batch.column(1).slice(first, rows).cast(pa.large_binary()), b""))
                yield _out(ids.slice(first, rows), pa.nulls(rows, pa.string()), np.zeros(rows), base + found, size)
                rare = np.flatnonzero(~frequent_here)
                token = pa.array(counted.tokens, pa.string()).take(pa.array(counted.token[rare]))
                none = np.zeros(len(rare), np.int64)
                yield _out(ids.take(pa.array(first + row[rare])), token, counted.times[rare], none, pa.array(none))

    def _out(ids, token, times, base, size) -> pa.RecordBatch:
        numbers = pa.array(np.asarray(times, "int64")), pa.array(np.asarray(base, "int64")), size.cast(pa.int64())
        return pa.RecordBatch.from_arrays([ids, token, *numbers], ["id", "token", "times", "base", "size"])

    return run


def _frequent(vocabulary: DataFrame) -> dict[str, int]:
    """Pieces of the pre-tokens of the most documents: as many whole classes of document counts as fit."""
    level = F.floor(F.log2("docs") * 8).cast("int")
    short = vocabulary.where(F.length("token") <= FREQUENT_CHARS).withColumn("level", level)
    least, room = None, FREQUENT
    for row in sorted(short.groupBy("level").agg(F.count("*").alias("n")).collect(), reverse=True):
        room -= row["n"]
        if room < 0:
            break
        least = row["level"]
    if least is None:
        return {}
    table = short.where(F.col("level") >= least).select("token", "pieces").toArrow()
    return dict(zip(table["token"].to_pylist(), table["pieces"].to_pylist(), strict=True))


def special_tokens(path: str) -> list[str]:
    """Texts that the tokenizer takes as one token wherever they stand, longest first."""
    from tokenizers import Tokenizer

    added = Tokenizer.from_file(path).get_added_tokens_decoder().values()
    return sorted((t.content for t in added), key=lambda t: (-len(t), t))


def count_tokens(docs: DataFrame, path: str, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc, n_bytes, n_tokens): one row for each id of docs, by the tokenizer file of a byte-level BPE.

    The counts are those of the tokenizers library without tokens added at the
    ends; special tokens in a text count as one. Null and empty texts have none.
    Rows that share an id are summed; null is an id as well. Other columns are
    left out. The file must lie on every machine at the same path.
    """
    specials = special_tokens(path)
    source = docs.select(F.col(doc).cast("long").alias("id"), F.col(text).alias("text"))
    tokens = source.mapInArrow(_vocabulary_rows(specials), "token string, docs long")
    grouped = tokens.groupBy("token").agg(F.sum("docs").alias("docs"))
    vocabulary = materialize(grouped.mapInArrow(_piece_rows(path), "token string, docs long, pieces int"), "vocabulary")
    frequent = docs.sparkSession.sparkContext.broadcast(_frequent(vocabulary))
    counted = source.mapInArrow(_document_rows(specials, frequent), "id long, token string, times long, base long, size long")
    # A document's own row has no pre-token to join; a key that nothing else has keeps such rows apart.
    keyed = counted.withColumn("token", F.coalesce("token", F.concat(F.lit("\0"), F.col("id").cast("string"), F.lit("\0"))))
    summed = keyed.join(vocabulary.select("token", "pieces"), "token", "left").groupBy("id").agg(
        F.sum(F.coalesce(F.col("times") * F.col("pieces"), F.lit(0)) + F.col("base")).alias("n_tokens"),
        F.sum("size").alias("n_bytes"),
    )
    return summed.select(F.col("id").alias(doc), "n_bytes", "n_tokens")
