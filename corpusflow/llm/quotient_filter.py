"""Counting quotient filters over packed keys of two, three or four 32-bit numbers.

A key is hi (its first two numbers) and lo (the others). An invertible permutation spreads hi, whose
high bits are the quotient. A filter keeps keys in order of quotient and stores no quotient: a bit row marks
which runs of entries belong to which quotient, then come the remainders in full, and counters of
one byte that overflow into a list. So a filter is compact and gives back every key with its exact count, and
filters of different shards are merged in order.
"""

from __future__ import annotations

import struct
from collections.abc import Iterable

import numpy as np

from corpusflow.llm.words import mix
from corpusflow.workers import ship_by_value

ship_by_value(__name__)

_HEADER = "<IBBBx"
_WIDE = 255
_SEED = np.uint64(0x5851F42D4C957F2D)
#: The multipliers of words.mix, inverted modulo 2 ** 64.
_UNDO1, _UNDO2 = (np.array([pow(c, -1, 1 << 64)], np.uint64) for c in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F))

#: Entries of a filter in order: spread keys, rest of the keys, counts.
Entries = tuple[np.ndarray, np.ndarray, np.ndarray]


def _unmix(h: np.ndarray) -> np.ndarray:
    """The numbers that words.mix spread."""
    # x ^ x >> 29 is undone by two further shifts, x ^ x >> 32 by one.
    h = h ^ (h >> np.uint64(29)) ^ (h >> np.uint64(58))
    h = h * _UNDO2
    h = h ^ (h >> np.uint64(32))
    return h * _UNDO1


def spread(hi: np.ndarray, lo: np.ndarray) -> np.ndarray:
    """hi permuted, in a way that depends on lo."""
    return mix(hi ^ mix(lo + _SEED))


def gathered(spread_hi: np.ndarray, lo: np.ndarray) -> np.ndarray:
    """The hi that spread made the permuted one of."""
    return _unmix(spread_hi) ^ mix(lo + _SEED)


def counted(hi: np.ndarray, lo: np.ndarray | None) -> Entries:
    """The entries of keys that may repeat. lo may be None where it is 0 throughout."""
    if lo is None:
        keys, counts = np.unique(spread(hi, np.zeros(1, np.uint64)), return_counts=True)
        return keys, np.zeros(len(keys), np.uint64), counts
    return _summed(spread(hi, lo), lo, np.ones(len(hi), np.int64))


def _summed(keys: np.ndarray, lo: np.ndarray, counts: np.ndarray) -> Entries:
    order = np.lexsort((lo, keys)) if lo.any() else np.argsort(keys, kind="stable")
    keys, lo, counts = keys[order], lo[order], counts[order]
    if not len(keys):
        return keys, lo, counts
    fresh = np.concatenate([[True], (keys[1:] != keys[:-1]) | (lo[1:] != lo[:-1])])
    first = np.flatnonzero(fresh)
    return keys[first], lo[first], np.add.reduceat(counts, first)


def merged(filters: Iterable[Entries]) -> Entries:
    """Entries of several filters as one; sorted runs make the sort a merge."""
    parts = list(filters)
    return parts[0] if len(parts) == 1 else _summed(*(np.concatenate(x) for x in zip(*parts, strict=True)))


def pack(entries: Entries, size: int, skip: int) -> bytes:
    """A filter of keys of so many numbers whose first skip bits are the same and are left to the reader."""
    keys, lo, counts = entries
    bits = min(max(len(keys) - 1, 1).bit_length(), 32)
    kept = 64 - skip - bits
    quotient = (keys << np.uint64(skip)) >> np.uint64(64 - bits)
    runs = np.zeros(len(keys) + (1 << bits), bool)
    runs[quotient.astype(np.int64) + np.arange(len(keys))] = True
    remainder = (keys & np.uint64((1 << kept) - 1)).astype("<u8").view(np.uint8).reshape(-1, 8)[:, : -(-kept // 8)]
    # Keys of three numbers have the third in the upper half of lo.
    rest = lo.astype("<u8").view(np.uint8).reshape(-1, 8)[:, 8 - 4 * (size - 2) :]
    wide = counts >= _WIDE
    small = np.where(wide, _WIDE, counts).astype(np.uint8)
    parts = [struct.pack(_HEADER, len(keys), bits, skip, size), np.packbits(runs), remainder, rest, small, counts[wide].astype("<i8")]
    return b"".join(p if isinstance(p, bytes) else np.ascontiguousarray(p).tobytes() for p in parts)


def unpack(raw: bytes, prefix: int) -> Entries:
    """The entries of a filter, given the skipped first bits of its keys as a number."""
    n, bits, skip, size = struct.unpack_from(_HEADER, raw)
    kept, at = 64 - skip - bits, struct.calcsize(_HEADER)

    def take(count: int) -> np.ndarray:
        nonlocal at
        at += count
        return np.frombuffer(raw, np.uint8, count, at - count)

    slots = n + (1 << bits)
    quotient = np.flatnonzero(np.unpackbits(take(-(-slots // 8)), count=slots)) - np.arange(n)

    def numbers(width: int, place: int) -> np.ndarray:
        out = np.zeros((n, 8), np.uint8)
        out[:, place : place + width] = take(n * width).reshape(n, width)
        return out.view("<u8").reshape(-1).astype(np.uint64)

    keys = numbers(-(-kept // 8), 0) | (quotient.astype(np.uint64) << np.uint64(kept))
    if skip:
        keys |= np.uint64(prefix << (64 - skip))
    lo = numbers(4 * (size - 2), 8 - 4 * (size - 2)) if size > 2 else np.zeros(n, np.uint64)
    counts = take(n).astype(np.int64)
    wide = counts == _WIDE
    counts[wide] = take(8 * int(wide.sum())).view("<i8")
    return keys, lo, counts
