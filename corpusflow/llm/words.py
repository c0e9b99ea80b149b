"""Words and shingles of Arrow text columns as 64-bit hashes, computed on whole buffers with numpy.

Texts are taken in groups of bounded size, a longer text alone and in pieces,
so memory stays within a small multiple of one text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from corpusflow.workers import ship_by_value

ship_by_value(__name__)

GROUP_BYTES = 2 << 20
#: Words beyond this many bytes are hashed one by one.
LONG_WORD = 512

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: Bytes of words when only white space parts them.
BETWEEN_SPACES = ~_SPACE
#: Bytes of words made of ASCII letters, digits and all that is not ASCII.
ALPHANUMERIC = np.array([b >= 0x80 or chr(b).isalnum() for b in range(256)])

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[0x41:0x5B] += 32
_MASKS = np.array([(1 << (8 * n)) - 1 for n in range(8)] + [(1 << 64) - 1], np.uint64)
_C1, _C2 = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F], np.uint64)
_S1, _S2 = np.array([32, 29], np.uint64)


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of each 64-bit number."""
    h = h * _C1
    h ^= h >> _S1
    h *= _C2
    h ^= h >> _S2
    return h


def groups(column: pa.Array, bound: int = GROUP_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets) of consecutive rows with at most so many bytes, or one longer row.

    Nulls count as empty texts. offsets has one entry more than rows and starts at 0.
    """
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    if not len(column):
        return
    _, ends, data = column.buffers()
    ends = np.frombuffer(ends, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    row = 0
    while row < len(column):
        stop = max(row + 1, int(np.searchsorted(ends, ends[row] + bound, side="right")) - 1)
        yield row, data[ends[row] : ends[stop]], ends[row : stop + 1] - ends[row]
        row = stop


def fold_case(data: np.ndarray) -> np.ndarray:
    """A-Z lower-cased."""
    return _FOLD[data]


def bounds(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words, and the first word of each text (one entry more than texts)."""
    member = inside[data]
    if not len(member):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    before = np.zeros(len(member) + 1, bool)
    before[1:] = member
    before[offsets] = False
    start = np.flatnonzero(member & ~before[:-1])
    after = np.zeros(len(member) + 1, bool)
    after[:-1] = member
    after[offsets] = False
    end = np.flatnonzero(member & ~after[1:]) + 1
    return start, end, np.searchsorted(start, offsets)


def hash_spans(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span of bytes, eight bytes at a time over all spans at once."""
    padded = np.zeros(len(data) + 8, np.uint8)
    padded[: len(data)] = data
    lanes = np.ndarray((len(data) + 1,), "<u8", padded, strides=(1,))
    length = end - start
    h = mix(length.astype(np.uint64) + _C2)
    at, rest, alive = start, length, None
    if len(length) and length.max() > LONG_WORD:
        long = np.flatnonzero(length > LONG_WORD)
        alive = np.flatnonzero(length <= LONG_WORD)
        for i in long:
            digest = hashlib.blake2b(data[start[i] : end[i]].tobytes(), digest_size=8).digest()
            h[i] = int.from_bytes(digest, "little")
        at, rest = start[alive], length[alive]
    while len(at):
        lane = lanes[at] & _MASKS[np.minimum(rest, 8)]
        if alive is None:
            h = mix(h ^ lane)
        else:
            h[alive] = mix(h[alive] ^ lane)
        more = np.flatnonzero(rest > 8)
        alive = more if alive is None else alive[more]
        at, rest = at[more] + 8, rest[more] - 8
    return h


def word_hashes(
    data: np.ndarray, offsets: np.ndarray, inside: np.ndarray, piece: int = GROUP_BYTES
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hashes, starts, ends, first word of each text) of the case-folded words."""
    if len(data) <= 2 * piece or len(offsets) > 2:
        folded = fold_case(data)
        start, end, first = bounds(folded, offsets, inside)
        return hash_spans(folded, start, end), start, end, first
    parts, begin = [], 0
    while begin < len(data):
        stop = min(len(data), begin + piece)
        while stop < len(data) and inside[data[stop - 1]]:  # a cut is never inside a word
            gap = np.flatnonzero(~inside[data[stop : stop + piece]])
            stop = stop + int(gap[0]) + 1 if len(gap) else min(len(data), stop + piece)
        folded = fold_case(data[begin:stop])
        start, end, _ = bounds(folded, np.array([0, stop - begin]), inside)
        parts.append((hash_spans(folded, start, end), start + begin, end + begin))
        begin = stop
    h, start, end = (np.concatenate(x) for x in zip(*parts, strict=True))
    return h, start, end, np.array([0, len(h)])


def shingle_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """A hash for each run of so many words; runs may cross texts, which is for the caller to leave out."""
    count = len(words) - size + 1
    if count <= 0:
        return np.zeros(0, np.uint64)
    h = words[:count].copy()
    for i in range(1, size):
        h = mix(h + _C2) ^ words[i : count + i]
    return mix(h)


def shingles_of(words: np.ndarray, runs: np.ndarray, begin: int, end: int, size: int) -> np.ndarray:
    """The shingle hashes of the text with words begin to end; a shorter text's words are one shingle."""
    if end - begin >= size:
        return runs[begin : end - size + 1]
    if end == begin:
        return np.zeros(0, np.uint64)
    return shingle_hashes(words[begin:end] + np.uint64(end - begin), end - begin)
