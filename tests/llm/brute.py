"""Plain versions of the operators, for small inputs."""

import re
from collections import Counter

UP = {c: c + 32 for c in range(65, 91)}


def words(text, alphanumeric=False):
    pattern = r"[a-z0-9\x80-\U0010ffff]+" if alphanumeric else r"[^\x20\x09-\x0D]+"
    return re.findall(pattern, (text or "").translate(UP))


def shingles(text, size, alphanumeric=False):
    w = words(text, alphanumeric)
    return {tuple(w[i : i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else ({tuple(w)} if w else set())


def near_duplicates(rows, size, percent=80):
    """{id: (set size, component)} of (id, text) rows with different ids."""
    sets = {i: shingles(t, size) for i, t in rows}
    holders, parent = {}, {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, s in sets.items():
        for x in s:
            holders.setdefault(x, []).append(i)
    for i, s in sets.items():
        common = Counter(j for x in s for j in holders[x] if j > i)
        for j, n in common.items():
            if 100 * n >= percent * (len(s) + len(sets[j]) - n):
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    return {i: (len(s), root(i)) for i, s in sets.items()}


def contained(docs, items, size=5, percent=80):
    """{(doc, item): (common, item size)}; an item of fewer words is searched at its own length."""
    wanted = {i: (min(size, len(words(t, True))), shingles(t, size, True)) for i, t in items}
    out = {}
    for d, t in docs:
        w = words(t, True)
        held = {n: {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} for n in {n for n, _ in wanted.values()} if n}
        for i, (n, s) in wanted.items():
            common = len(s & held[n]) if s else 0
            if s and 100 * common >= percent * len(s):
                out[d, i] = (common, len(s))
    return out


def dedup_lines(rows, min_chars=20, min_docs=3):
    """{id: (text, lines, dropped)} of (id, text) rows with different ids."""
    def key(line):
        return line.strip(" \t\n\x0b\x0c\r").translate(UP)

    holders = {}
    for i, t in rows:
        for line in (t or "").split("\n"):
            if len(key(line)) >= min_chars:
                holders.setdefault(key(line), set()).add(i)
    common = {k: max(h) for k, h in holders.items() if len(h) >= min_docs}
    out = {}
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if common.get(key(x), i) == i]
        out[i] = ("\n".join(kept), len(lines), len(lines) - len(kept))
    return out


def runs(words, least=12):
    """[(start, length, period)] of all runs, by start and then period."""
    n, found = len(words), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            start = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            if i - start + q >= max(least, 2 * q):
                found.setdefault((start, i + q), q)
    return sorted(((s, e - s, q) for (s, e), q in found.items()), key=lambda r: (r[0], r[2]))


def collapsed(words, found):
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)
