"""Byte-level BPE by a local rank file, with tiktoken in the tasks.

Each task reads text in Arrow batches and works through them in small groups,
so memory is bounded by a group and the longest text. Long texts are cut where
no match of the pattern can cross, encoded piece by piece, and give the ids of
the whole.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusflow.workers import ship_by_value, trimmed

ship_by_value(__name__)

#: Code points of a piece of a long text, and bytes of text that leave the worker together.
PIECE, GROUP_BYTES = 1 << 18, 4 << 20
#: Fixed value: the characters that \s stands for in the pattern.
WHITE = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: Runs of so many are found ahead of the library, whose matcher has a limited stack for looking ahead.
RUN = 1 << 14


def encoding(ranks_path: str, pattern: str):
    """tiktoken's encoding of a rank file, without special tokens. The file must lie on every machine."""
    import tiktoken

    with open(ranks_path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, filter(bytes.strip, lines))}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def safe_pieces(text: str, size: int = PIECE) -> Iterator[str]:
    """Cut a text between a word character and a space or line feed.

    No match of the pattern holds white space behind another character, so
    matches end there in the whole text as well, and looking ahead from inside a
    run of white space stays inside it. A stretch without such a place is not cut.
    """
    boundary = re.compile(r"[A-Za-z0-9](?=[ \n])")
    start = 0
    while len(text) - start > size:
        cut = boundary.search(text, start + size)
        if cut is None:
            break
        yield text[start : cut.end()]
        start = cut.end()
    yield text[start:]


def split_text(text: str, size: int = PIECE, run: int = RUN) -> Iterator[tuple[str, bool]]:
    """Parts of a text, each encoded by itself, and whether it is one match of the pattern.

    A long run of white space is one match without its last character, which may begin the
    next match; at the end of the text it is one match as a whole. Nothing else in the pattern holds white space
    behind another character, so a match ends where such a run begins.
    """
    start = 0
    if len(text) >= run:
        for found in re.finditer(f"[{WHITE}]{{{run},}}", text):
            if found.start() > start:
                yield from ((p, False) for p in safe_pieces(text[start : found.start()], size))
            start = found.end() if found.end() == len(text) else found.end() - 1
            yield text[found.start() : start], True
    if start < len(text) or not text:
        yield from ((p, False) for p in safe_pieces(text[start:], size))


def _texts(column: pa.Array) -> Iterator[str]:
    for value in column.cast(pa.binary()):
        raw = value.as_py()
        yield "" if raw is None else raw.decode("utf-8", "replace")


def _without(schema: T.StructType, names: tuple[str, ...]) -> list[T.StructField]:
    """The fields that are not replaced; Spark tells names apart without case."""
    return [f for f in schema.fields if f.name.lower() not in {n.lower() for n in names}]


def _groups(batch: pa.RecordBatch, column: str, bound: int = GROUP_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with at most so many bytes in a column, or one row."""
    import pyarrow.compute as pc

    if not batch.num_rows:
        return
    values = batch.column(column)
    lengths = pc.list_value_length(values) if pa.types.is_list(values.type) else pc.binary_length(values.cast(pa.binary()))
    ends = np.cumsum(lengths.fill_null(0).to_numpy(zero_copy_only=False).astype("int64"))
    start = 0
    while start < len(ends):
        done = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, done + bound, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def _list(arrays: list[np.ndarray]) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(a) for a in arrays])]).astype("int32")
    flat = np.concatenate(arrays).astype("int32") if arrays else np.zeros(0, "int32")
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))


def encode(docs: DataFrame, text: str, ids: str, ranks_path: str, pattern: str, decoded: str | None = None) -> DataFrame:
    """docs with a column of token ids, as tiktoken gives them without special tokens.

    decoded names a further column for the bytes that these ids stand for, decoded from the ids in the same pass.

    Null text counts as empty and gives an empty array. Texts may hold runs of white space of any
    length. Columns of docs called as the new ones, in any case, are replaced; all others stay. Rows are independent
    of each other, and no rows give no rows.
    """
    new = (ids,) if decoded is None else (ids, decoded)
    kept = _without(docs.schema, new)
    given = docs.select(*[F.col(f"`{f.name}`") for f in kept], F.col(f"`{text}`").alias("_text_to_encode"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoding(ranks_path, pattern)

        def ids_of(part: str, one: bool) -> np.ndarray:
            if one:
                return np.array(encoder._encode_single_piece(part.encode()), np.uint32)
            return encoder.encode_to_numpy(part, disallowed_special=())

        for batch in batches:
            for group in _groups(batch, "_text_to_encode"):
                arrays = []
                for whole in _texts(group.column("_text_to_encode")):
                    parts = [ids_of(*p) for p in split_text(whole)]
                    arrays.append(parts[0] if len(parts) == 1 else np.concatenate(parts))
                columns = [*group.columns[:-1], _list(arrays)]
                if decoded is not None:
                    columns.append(pa.array([encoder.decode_bytes(a.tolist()) for a in arrays], pa.binary()))
                yield pa.RecordBatch.from_arrays(columns, [*group.schema.names[:-1], *new])

    fields = [T.StructField(ids, T.ArrayType(T.IntegerType(), False), False)]
    if decoded is not None:
        fields.append(T.StructField(decoded, T.BinaryType(), False))
    return given.mapInArrow(trimmed(run), T.StructType([*kept, *fields]))


def decode(docs: DataFrame, ids: str, out: str, ranks_path: str, pattern: str) -> DataFrame:
    """docs with the raw bytes that a column of token ids stands for.

    They are bytes, not a string: a cut of the ids may end inside a character.
    A null array gives no bytes. A column of docs called as out, in any case, is replaced.
    """
    kept = _without(docs.schema, (out,))
    given = docs.select(*[F.col(f"`{f.name}`") for f in kept], F.col(f"`{ids}`").alias("_ids_to_decode"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoding(ranks_path, pattern)
        for batch in batches:
            for group in _groups(batch, "_ids_to_decode", GROUP_BYTES // 4):
                values = [encoder.decode_bytes(v.as_py() or []) for v in group.column("_ids_to_decode")]
                yield pa.RecordBatch.from_arrays([*group.columns[:-1], pa.array(values, pa.binary())], [*group.schema.names[:-1], out])

    return given.mapInArrow(trimmed(run), T.StructType([*kept, T.StructField(out, T.BinaryType(), False)]))
