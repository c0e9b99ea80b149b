"""Periodic runs of words by grammar compression.

1. A text in which no stretch of half the least run length recurs holds no run. For the others:
2. Re-Pair: pairs of symbols that recur become rules, round by round; of overlapping pairs
   the more frequent one goes first. What is left is halved into a tree, so that the whole text is one symbol.
3. The runs that cross the middle of a rule are found once, at one place of the text where the rule applies: a run
   of period q that crosses a place matches itself, at distance q, next to it or q before it. So a period is a
   candidate where one of two words agrees; longer agreement is measured by halving on prefix hashes.
4. Runs go to all places of their rule; the parts of a run that several rules saw are merged.

Texts are independent rows: one pass without a shuffle, in memory within a multiple of the longest text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusflow.llm.words import BETWEEN_SPACES, bounds, groups, hash_spans, mix, shingle_hashes
from corpusflow.workers import ship_by_value

ship_by_value(__name__)

#: Places that are compared at a time.
_STEP = 1 << 20
#: A prime and two bases of the prefix hashes.
_PRIME, _BASES = (1 << 31) - 1, (1_103_515_245, 747_796_405)

Runs = tuple[np.ndarray, np.ndarray, np.ndarray]


class Grammar:
    """Rules symbol -> left right over numbers below `terminals`, the last of which derives the whole text."""

    def __init__(self, words: np.ndarray):
        _, text = np.unique(words, return_inverse=True)
        text = text.astype(np.int64)
        self.terminals = self.symbols = int(text.max(initial=-1)) + 1
        #: Of each round: number of its first rule, left and right symbols.
        self.rounds: list[tuple[int, np.ndarray, np.ndarray]] = []
        while len(text) > 1 and (done := self._replaced(text)) is not None:
            text = done
        while len(text) > 1:
            rest = text[len(text) & ~1 :]
            text = np.concatenate([self._rules(text[:-1:2], text[1::2]), rest])
        self.length = np.ones(self.symbols, np.int64)
        self.place = np.zeros(self.symbols, np.int64)
        self.middle = np.zeros(self.symbols, np.int64)
        for first, left, right in self.rounds:
            here = slice(first, first + len(left))
            self.middle[here] = self.length[left]
            self.length[here] = self.length[left] + self.length[right]
        for first, left, right in reversed(self.rounds):
            here = slice(first, first + len(left))
            self.place[left] = self.place[here]
            self.place[right] = self.place[here] + self.middle[here]

    def _rules(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        self.rounds.append((self.symbols, left, right))
        self.symbols += len(left)
        return np.arange(self.symbols - len(left), self.symbols)

    def _replaced(self, text: np.ndarray) -> np.ndarray | None:
        """The text after one round of replacements, None if no pair recurs."""
        pairs = text[:-1] << 32 | text[1:]
        kinds, which = np.unique(pairs, return_inverse=True)
        # In a run of one symbol every second pair counts.
        at = np.arange(len(pairs))
        repeats = np.concatenate([[False], pairs[1:] == pairs[:-1]])
        usable = (at - np.maximum.accumulate(np.where(repeats, 0, at))) % 2 == 0
        count = np.bincount(which[usable], minlength=len(kinds))
        if count.max() < 2:
            return None
        rank = np.empty(len(kinds), np.int64)
        rank[np.lexsort((mix(kinds.astype(np.uint64)), count))] = np.arange(len(kinds))
        rank = np.where(usable & (count[which] > 1), rank[which], -1)
        chosen = rank >= 0
        chosen[1:] &= rank[1:] > rank[:-1]
        chosen[:-1] &= rank[:-1] > rank[1:]
        times = np.bincount(which[chosen], minlength=len(kinds))
        new = np.flatnonzero(times > 1)
        number = np.zeros(len(kinds), np.int64)
        number[new] = self._rules(kinds[new] >> 32, kinds[new] & 0xFFFFFFFF)
        chosen &= times[which] > 1
        text = text.copy()
        text[:-1][chosen] = number[which[chosen]]
        return text[np.concatenate([[True], ~chosen])]

    def everywhere(self, symbols: np.ndarray, runs: Runs) -> Runs:
        """Runs found at the place of a rule each, at every place where the rule derives."""
        own = np.bincount(symbols, minlength=self.symbols)
        wanted = own > 0
        for first, left, right in self.rounds:
            wanted[first : first + len(left)] |= wanted[left] | wanted[right]
        order = np.argsort(symbols, kind="stable")
        start, end, period = (x[order] for x in runs)
        offset = np.cumsum(own) - own
        symbol, place, found = np.array([self.symbols - 1]), np.zeros(1, np.int64), []
        for first, left, right in reversed(self.rounds):
            here = symbol >= first
            s, p = symbol[here], place[here]
            n = own[s]
            at = np.arange(n.sum()) + np.repeat(offset[s] - (np.cumsum(n) - n), n)
            by = np.repeat(p - self.place[s], n)
            found.append((start[at] + by, end[at] + by, period[at]))
            children = np.concatenate([left[s - first], right[s - first]])
            places = np.concatenate([p, p + self.middle[s]])
            go = wanted[children]
            symbol, place = np.concatenate([symbol[~here], children[go]]), np.concatenate([place[~here], places[go]])
        return tuple(np.concatenate(x) for x in zip(*found, strict=True))


class _Prefixes:
    """Hashes of all prefixes of a text, for the length of agreement of two places."""

    def __init__(self, words: np.ndarray):
        _, text = np.unique(words, return_inverse=True)
        self.hashes = []
        for base in _BASES:
            power, step = np.ones(1, np.int64), base
            while len(power) <= len(text):
                power = np.concatenate([power, power * step % _PRIME])
                step = step * step % _PRIME
            total = np.cumsum((text + 1) * power[: len(text)] % _PRIME)
            self.hashes.append((np.concatenate([[0], total % _PRIME]), power))

    def agree(self, first: np.ndarray, second: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Whether so many words from first on equal those from second on (first < second)."""
        out = np.ones(len(first), bool)
        for total, power in self.hashes:
            a = (total[first + length] - total[first]) % _PRIME * power[second - first] % _PRIME
            out &= a == (total[second + length] - total[second]) % _PRIME
        return out

    def common(self, first: np.ndarray, second: np.ndarray, most: np.ndarray, back: bool) -> np.ndarray:
        """How many words from two places on agree, or before them; most at most."""
        low, high = np.zeros(len(first), np.int64), most.copy()
        while (low < high).any():
            half = (low + high + 1) // 2
            fits = self.agree(first - half, second - half, half) if back else self.agree(first, second, half)
            low, high = np.where(fits, half, low), np.where(fits, high, half - 1)
        return low


def _crossing(words: np.ndarray, low: np.ndarray, middle: np.ndarray, high: np.ndarray, least: int) -> Iterator[tuple[np.ndarray, Runs]]:
    """(number of the window, runs) of the runs within windows low to high that cross their middle."""
    prefixes = None
    ends = np.cumsum(high - low)
    begin = 0
    while begin < len(low):
        done = ends[begin - 1] if begin else 0
        stop = max(begin + 1, int(np.searchsorted(ends, done + _STEP, side="right")))
        lo, mid, hi = low[begin:stop], middle[begin:stop], high[begin:stop]
        half = (hi - lo) // 2
        before, behind = np.minimum(mid - lo, half), np.minimum(hi - mid, half)
        candidates = []
        # Words q before the middle that equal the word behind it, then words q behind the word before it.
        for count, from_, to in ((before, mid - before, mid), (behind, mid, mid - 1)):
            window = np.repeat(np.arange(len(lo)), count)
            at = np.arange(count.sum()) + np.repeat(from_ - (np.cumsum(count) - count), count)
            anchor = to[window]
            same = words[at] == words[anchor]
            window, at, anchor = window[same], at[same], anchor[same]
            candidates.append((window, np.minimum(at, anchor), np.abs(at - anchor)))
        window, at, period = (np.concatenate(x) for x in zip(*candidates, strict=True))
        begin, base = stop, begin

        # Agreement must go on over half the least run at least: most candidates end here, word by word.
        need = -(-least // 2)
        length, right = np.ones(len(at), np.int64), at + 1
        for step, bound in ((1, hi), (-1, lo)):
            alive = np.arange(len(at))
            where = right if step > 0 else at - 1
            for _ in range(need):
                here = where[alive]
                inside = here + period[alive] < bound[window[alive]] if step > 0 else here >= bound[window[alive]]
                alive, here = alive[inside], here[inside]
                alive = alive[words[here] == words[here + period[alive]]]
                length[alive] += 1
                where[alive] += step
                if not len(alive):
                    break
        some = length >= need
        window, at, period = window[some], at[some], period[some]
        if not len(at):
            continue
        prefixes = prefixes or _Prefixes(words)
        first = at - prefixes.common(at, at + period, at - lo[window], back=True)
        last = at + period + prefixes.common(at, at + period, hi[window] - at - period, back=False)
        run = last - first >= np.maximum(least, 2 * period)
        window, first, last, period = window[run], first[run], last[run], period[run]
        # Of the periods of one stretch the smallest is the run's.
        order = np.lexsort((period, last, first, window))
        window, first, last, period = window[order], first[order], last[order], period[order]
        fresh = np.ones(len(window), bool)
        fresh[1:] = (window[1:] != window[:-1]) | (first[1:] != first[:-1]) | (last[1:] != last[:-1])
        yield window[fresh] + base, (first[fresh], last[fresh], period[fresh])


def _merged(runs: Runs) -> Runs:
    """Parts of one period that share a whole period are one run; of equal stretches the smallest period stays. By start, then period."""
    start, end, period = runs
    order = np.lexsort((-end, start, period))
    start, end, period = start[order], end[order], period[order]
    _, kind = np.unique(period, return_inverse=True)
    far = kind * (int(end.max()) + 1)
    reach = np.maximum.accumulate(end + far)
    fresh = np.ones(len(start), bool)
    fresh[1:] = (kind[1:] != kind[:-1]) | (start[1:] + far[1:] > reach[:-1] - period[1:])
    first = np.flatnonzero(fresh)
    start, end, period = start[first], np.maximum.reduceat(end, first), period[first]
    order = np.lexsort((period, end, start))
    start, end, period = start[order], end[order], period[order]
    once = np.ones(len(start), bool)
    once[1:] = (start[1:] != start[:-1]) | (end[1:] != end[:-1])
    start, end, period = start[once], end[once], period[once]
    order = np.lexsort((period, start))
    return start[order], end[order], period[order]


def find_runs(words: np.ndarray, least: int) -> Runs:
    """start, end, period of the runs of one text, given a number for each word."""
    none = np.zeros(0, np.int64)
    if len(words) < least:
        return none, none, none
    grammar = Grammar(words)
    rules = np.arange(grammar.terminals, grammar.symbols)
    rules = rules[grammar.length[rules] >= least]
    low = grammar.place[rules]
    found = list(_crossing(words, low, low + grammar.middle[rules], low + grammar.length[rules], least))
    if not sum(len(window) for window, _ in found):
        return none, none, none
    symbols = rules[np.concatenate([window for window, _ in found])]
    runs = tuple(np.concatenate(x) for x in zip(*(r for _, r in found), strict=True))
    return _merged(grammar.everywhere(symbols, runs))


def _recurring(words: np.ndarray, first: np.ndarray, size: int) -> np.ndarray:
    """Which texts hold a stretch of so many words twice."""
    shingles = shingle_hashes(words, size)
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    whole = text[: len(shingles)] == text[size - 1 :] if len(shingles) else np.zeros(0, bool)
    text = text[: len(shingles)][whole]
    keys = mix(shingles[whole] ^ mix(text.astype(np.uint64)))
    order = np.argsort(keys)
    twice = keys[order[1:]] == keys[order[:-1]]
    out = np.zeros(len(first) - 1, bool)
    out[text[order[1:][twice]]] = True
    return out


def _joined(data: np.ndarray, start: np.ndarray, end: np.ndarray, first: np.ndarray) -> pa.Array:
    """The words of each text, joined by one space."""
    length = end - start + 1
    length[first[1:][np.diff(first) > 0] - 1] -= 1
    offsets = np.concatenate([[0], np.cumsum(length)])
    padded, parts = np.append(data, np.uint8(0x20)), []
    for i in range(0, len(start), 1 << 18):
        n = length[i : i + (1 << 18)]
        own = np.cumsum(n)
        part = padded[np.arange(own[-1]) + np.repeat(start[i : i + (1 << 18)] - (own - n), n)]
        part[own[n > end[i : i + (1 << 18)] - start[i : i + (1 << 18)]] - 1] = 0x20
        parts.append(part)
    joined = np.concatenate(parts) if parts else np.zeros(0, np.uint8)
    return pa.LargeStringArray.from_buffers(len(first) - 1, pa.py_buffer(offsets[first].astype(np.int64)), pa.py_buffer(joined.tobytes()))


def _run_rows(least: int):
    names, kind = ["start", "length", "period"], pa.int64()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first_row, data, offsets in groups(batch.column(batch.num_columns - 1)):
                start, end, first = bounds(data, offsets, BETWEEN_SPACES)
                words = hash_spans(data, start, end)
                keep, found = np.ones(len(words), bool), [[] for _ in first[1:]]
                for row in np.flatnonzero(_recurring(words, first, -(-least // 2))):
                    begin, stop = first[row], first[row + 1]
                    runs = find_runs(words[begin:stop], least)
                    found[row] = runs
                    # Words inside a run, behind its first period.
                    depth = np.zeros(stop - begin + 1, np.int64)
                    if len(runs[0]):
                        np.add.at(depth, runs[0] + runs[2], 1)
                        np.add.at(depth, runs[1], -1)
                        keep[begin:stop] = np.cumsum(depth)[:-1] == 0
                ends = np.concatenate([[0], np.cumsum([len(r[0]) if len(r) else 0 for r in found])]).astype(np.int32)
                whole = [r for r in found if len(r)]
                flat = [np.concatenate([r[i] for r in whole]) if whole else np.zeros(0, np.int64) for i in range(3)]
                flat[1] = flat[1] - flat[0]
                runs = pa.ListArray.from_arrays(pa.array(ends), pa.StructArray.from_arrays([pa.array(x, kind) for x in flat], names))
                kept = np.concatenate([[0], np.cumsum(keep)])[first]
                text = _joined(data, start[keep], end[keep], kept).cast(pa.string())
                own = batch.slice(first_row, len(found))
                yield pa.RecordBatch.from_arrays([*own.columns[:-1], runs, text], [*own.schema.names[:-1], "runs", "collapsed"])

    return run


def periodic_runs(docs: DataFrame, text: str = "text", least: int = 12) -> DataFrame:
    """All rows and columns of docs, plus runs and collapsed.

    Words are runs of characters that are not ASCII white space, numbered from 0. A run is a stretch of words with smallest
    period q and a length of at least `least` and 2 * q that cannot be extended with this period. runs holds start, length
    and period of all of them, by start and then period; runs may overlap. collapsed is the text without the
    words that lie in a run behind its first q words, the others joined by one space.

    Null, empty and blank texts have no runs and an empty collapsed text. Rows are independent, repeated ones give
    equal results. Columns of docs called runs or collapsed, in any case, are replaced. No rows
    give no rows. Words are told apart by 64-bit hashes.
    """
    kept = [f for f in docs.schema.fields if f.name.lower() not in ("runs", "collapsed")]
    number = T.LongType()
    run = T.StructType([T.StructField(n, number) for n in ("start", "length", "period")])
    schema = T.StructType([*kept, T.StructField("runs", T.ArrayType(run)), T.StructField("collapsed", T.StringType())])
    given = docs.select(*[F.col(f"`{f.name}`") for f in kept], F.col(f"`{text}`").alias("collapsed"))
    return given.mapInArrow(_run_rows(least), schema)
