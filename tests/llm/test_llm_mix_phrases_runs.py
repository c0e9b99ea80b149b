"""Mixing, phrases and periodic runs on hard rows: nulls, empty and long texts, ties, repeats, empty tables, clashing names."""

import random
import sys
import time
from collections import Counter
from pathlib import Path

import numpy as np
import pytest

sys.path.insert(0, str(Path(__file__).parent))

import brute
from pyspark.sql import functions as F

from corpusflow.llm import mixing, numbering, phrases, quotient_filter, runs

NAMES = ["Copies", "TARGET", "rate", "copy", "source_size", "_range", "_before", "Runs", "collapsed", "n", "f", "id", "block", "word"]


@pytest.fixture(scope="module")
def docs(spark):
    def make(rows):
        schema = "doc_id long, text string, lang string, source string, " + ", ".join(f"`{n}` string" for n in NAMES)
        return spark.createDataFrame([(*r, *NAMES) for r in rows], schema)

    return make


def prose(seed, n, vocabulary=400):
    rnd = random.Random(seed)
    return " ".join(f"w{rnd.randrange(vocabulary)}" for _ in range(n))


# ---- mixing


def levels(sizes, percent=150, most=2):
    """Targets by sharing anew until none is above its bound, as the rule says it."""
    weights = {s: (5, 2, 1)[i % 3] for i, s in enumerate(sorted(sizes, key=lambda s: (s is None, s or "")))}
    want, held = percent * sum(sizes.values()) / 100, {}
    while True:
        free = [s for s in sizes if s not in held]
        level = (want - sum(held.values())) / max(sum(weights[s] for s in free), 1)
        above = [s for s in free if weights[s] * level > most * sizes[s]]
        if not above:
            return {s: float(held[s]) if s in held else weights[s] * level for s in sizes}
        held |= {s: most * sizes[s] for s in above}


def test_targets(docs):
    rnd = random.Random(3)
    for case in range(4):
        sizes = {s: rnd.choice([0, 1, 7, 40, 900]) for s in ["a", "B", "é", "z\U0001f600", "zz", "", None][: 3 + case]}
        rows = [(i, "x " * n, "en", s) for i, (s, n) in enumerate(sizes.items())]
        got = {r["source"]: r for r in mixing.source_targets(docs(rows)).collect()}
        want = levels(sizes)
        assert set(got) == set(want)
        assert all(got[s]["target"] == pytest.approx(want[s]) and got[s]["source_size"] == sizes[s] for s in want)


def test_mixture_rows(docs):
    rows = [(i, prose(i, 30), "en", "a" if i % 3 else None) for i in range(300)] + [(None, None, None, "z"), (None, "", "en", "z")] + [(7, "same text", "en", "q")] * 3
    table = docs(rows)
    rated = mixing.repetitions(table)
    assert rated.columns == [*[c for c in table.columns if c.lower() not in ("copies", "target", "rate", "source_size")], "source_size", "target", "rate", "copies"]
    got = rated.collect()
    assert len(got) == len(rows) and all(r["rate"] - 1 < r["copies"] < r["rate"] + 1 and r["copies"] <= 2 for r in got)
    assert all(r["copies"] == 0 and r["target"] == 0 for r in got if r["source"] == "z")
    assert len({r["copies"] for r in got if r["source"] == "q"}) == 1
    emitted = mixing.mixed(table).collect()
    assert Counter((r["doc_id"], r["text"]) for r in emitted) == sum((Counter({(r["doc_id"], r["text"]): r["copies"]}) for r in got), Counter())
    assert mixing.mixed(table).collect() == emitted
    other = {(r["doc_id"], r["copies"]) for r in mixing.repetitions(table, seed=1).collect()}
    assert other != {(r["doc_id"], r["copies"]) for r in got}


def test_mixture_of_nothing(docs):
    assert mixing.repetitions(docs([])).count() == 0 and mixing.mixed(docs([])).count() == 0
    assert [r["copies"] for r in mixing.repetitions(docs([(1, None, "en", "a"), (2, " \n", "en", None)])).collect()] == [0, 0]


def test_word_count(values):
    texts = [None, "", " \t\n\x0b\x0c\r ", "a", " a\x0bb\x0c\rc ", "é è x y", "x " * 300_000 + "y" * 300_000]
    assert values(texts, mixing.word_count) == [len(brute.words(t)) for t in texts]


def test_numbers_in_order(spark):
    rows = spark.range(5000, numPartitions=7).select((F.col("id") * 7919 % 5000).alias("x"))
    got = numbering.numbered(rows, [F.desc("x")], "test").collect()
    assert sorted((r["place"], r["x"]) for r in got) == [(i, 4999 - i) for i in range(5000)]


# ---- phrases


def test_filters_are_lossless():
    draws = np.random.default_rng(1)
    for size in (2, 3, 4):
        for n in (1, 2, 3, 5000):
            hi = draws.integers(0, 1 << 64, n, np.uint64)
            lo = draws.integers(0, 1 << (32 * (size - 2)), n, np.uint64, endpoint=False) if size > 2 else np.zeros(n, np.uint64)
            lo = lo << np.uint64(32) if size == 3 else lo
            assert (quotient_filter.gathered(quotient_filter.spread(hi, lo), lo) == hi).all()
            times = draws.integers(1, 400, n)
            keys = quotient_filter.counted(np.repeat(hi, times), None if size == 2 else np.repeat(lo, times))
            for skip in (0, 4):
                prefix = (keys[0] >> np.uint64(60)) if skip else np.zeros(len(keys[0]), np.uint64)
                parts = []
                for p in np.unique(prefix):
                    part = tuple(x[prefix == p] for x in keys)
                    parts.append(quotient_filter.unpack(quotient_filter.pack(part, size, skip), int(p)))
                whole = quotient_filter.merged([*parts, keys])
                got = zip(quotient_filter.gathered(whole[0], whole[1]).tolist(), whole[1].tolist(), whole[2].tolist(), strict=True)
                assert {(h, x): c for h, x, c in got} == {(h, x): 2 * t for h, x, t in zip(hi.tolist(), lo.tolist(), times.tolist(), strict=True)}


def plain_collocations(rows, least, covered, most):
    import re

    counts, totals = {}, Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(brute.UP)):
            w = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(w)
            for k in range(1, 5):
                for i in range(len(w) - k + 1):
                    counts.setdefault(lang, Counter())[tuple(w[i : i + k])] += 1
    out = []
    for lang, c in counts.items():
        found = [p for p, a in c.items() if len(p) > 1 and a >= least]
        inside = {}
        for p in found:
            for k in range(2, len(p)):
                for i in range(len(p) - k + 1):
                    inside[p[i : i + k]] = max(inside.get(p[i : i + k], 0), c[p])
        scored = []
        for p in found:
            a = c[p]
            if 100 * inside.get(p, 0) >= covered * a:
                continue
            score, k = min((2000000 * a // (c[p[:k]] + c[p[k:]]), k) for k in range(1, len(p)))
            scored.append((-score, -a, " ".join(p).encode(), c[p[:k]], c[p[k:]]))
        for i, (s, a, p, x, y) in enumerate(sorted(scored)[:most]):
            out.append((lang, i + 1, p.decode(), -a, x, y, totals[lang], -s))
    return sorted(out)


def test_phrases(docs, monkeypatch):
    rnd = random.Random(2)
    marks = [" ", " ", " ", "  ", "\t", ", ", ".", "\n", "\x0b", "!"]

    def text(seed):
        r = random.Random(seed)
        return "".join(r.choice(["New", "york", "city", "Hall", "é", "\x01", "a", "b", "x-y", f"r{r.randrange(9999)}"]) + r.choice(marks) for _ in range(r.randrange(60)))

    rows = [(i, text(i), rnd.choice(["en", "fr", None, "und"]), "s") for i in range(900)]
    rows += [(1, "of the of the of the", "en", "s")] * 40 + [(None, None, None, None), (None, "", "en", "s"), (2, "lone", "xx", "s")]
    rows += [(9, "tie one. " * 30 + "tie two. " * 30 + "big " * 3000 + "w" * 100_000, "de", "s"), (10, " ,;", "fr", "s")]
    plain = [(r[2], r[1]) for r in rows]
    for least, covered, most in ((30, 80, 2000), (3, 50, 10)):
        got = [tuple(r) for r in phrases.collocations(docs(rows), least=least, covered=covered, most=most).collect()]
        assert sorted(got) == plain_collocations(plain, least, covered, most)
    # Small blocks, filters that leave often and many ranges give the same.
    for name, value in (("BLOCK_BYTES", 2000), ("HELD", 50), ("RANGE", 64)):
        monkeypatch.setattr(phrases, name, value)
    got = [tuple(r) for r in phrases.collocations(docs(rows), least=3, covered=50, most=10).collect()]
    assert sorted(got) == plain_collocations(plain, 3, 50, 10)


def test_no_phrases(docs):
    assert phrases.collocations(docs([])).collect() == []
    assert phrases.collocations(docs([(1, None, "en", "s"), (2, "a b c", None, "s"), (3, "", "en", "s")])).collect() == []


# ---- runs


def test_runs_against_brute_force():
    rnd = random.Random(5)
    for _ in range(600):
        n, kinds = rnd.randrange(120), rnd.choice([1, 2, 3, 5, 30])
        words = [rnd.randrange(kinds) for _ in range(n)]
        for _ in range(rnd.randrange(3) if n else 0):
            start, period = rnd.randrange(n), rnd.randrange(1, 8)
            for i in range(max(start, period), min(n, start + rnd.randrange(60))):
                words[i] = words[i - period]
        least = rnd.choice([12, 12, 4, 5])
        start, end, period = (x.tolist() for x in runs.find_runs(np.array(words, np.uint64), least))
        assert [(s, e - s, q) for s, e, q in zip(start, end, period, strict=True)] == brute.runs(words, least)


def test_run_rows(docs):
    texts = [None, "", " \n\t ", "one", "a b " * 6, "A b a b " * 6, "x " * 12, "x " * 11, prose(1, 50) + " go on " * 7 + prose(2, 50), prose(3, 400)]
    texts += ["é  b\x0bc\x0c" * 9, "a b c d e f g h i j k l " * 2, ("p q r " * 5 + "z ") * 3]
    rows = [(i, t, "en", "s") for i, t in enumerate(texts)] + [(4, texts[4], "en", "s"), (None, texts[5], None, None)]
    table = docs(rows)
    out = runs.periodic_runs(table)
    assert out.columns == [*[c for c in table.columns if c.lower() not in ("runs", "collapsed")], "runs", "collapsed"]
    got = out.collect()
    assert Counter((r["doc_id"], r["text"], r["word"]) for r in got) == Counter((r[0], r[1], "word") for r in rows)
    import re

    for r in got:
        words = re.findall(r"[^\x20\x09-\x0D]+", r["text"] or "")
        want = brute.runs(words)
        assert [tuple(x) for x in r["runs"]] == want and r["collapsed"] == brute.collapsed(words, want)
    assert runs.periodic_runs(docs([])).count() == 0


def test_long_texts_are_quick(docs):
    texts = ["x " * 200_000, prose(1, 3000, 10**9) * 40, prose(2, 200_000)]
    begin = time.time()
    got = {r["doc_id"]: r for r in runs.periodic_runs(docs([(i, t, "en", "s") for i, t in enumerate(texts)])).collect()}
    assert time.time() - begin < 90
    assert [tuple(x) for x in got[0]["runs"]] == [(0, 200_000, 1)] and got[0]["collapsed"] == "x"
    assert len(got[1]["runs"]) == 1 and got[1]["runs"][0]["period"] == 2999
    assert got[2]["runs"] == [] and got[2]["collapsed"] == texts[2]
