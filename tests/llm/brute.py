"""Brute-force versions: plain Python, over all pairs or all windows."""

import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text, fold=False):
    return WORD.findall((text or "").translate(FOLD) if fold else text or "")


def shingles(text, n=5, whole=True):
    w = words(text, True)
    if len(w) >= n:
        return frozenset(tuple(w[k:k + n]) for k in range(len(w) - n + 1))
    return frozenset([tuple(w)]) if w and whole else frozenset()


def quality(text):
    w = words(text)
    windows = [tuple(w[k:k + 5]) for k in range(len(w) - 4)]
    covered = set()
    for k, g in enumerate(windows):
        if windows.count(g) > 1:
            covered |= set(range(k, k + 5))
    seen, again = set(), 0
    for line in (text or "").split("\n"):
        if WORD.search(line):
            again += line in seen
            seen.add(line)
    return (len(w), sum(map(len, w)), sum((text or "").count(c) for c in "#*$%&|<>"), again, len(covered),
            len(w) < 10 or 100 * len(covered) > 20 * len(w))


def classes(rows, percent=80):
    sets = {i: shingles(t) for i, t in rows}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: (len(s), find(i)) for i, s in sets.items()}


def without_repeats(rows, n=13):
    first = {}
    split = [(i, words(t)) for i, t in rows]
    for i, w in split:
        for k in range(len(w) - n + 1):
            g = tuple(w[k:k + n])
            first[g] = min(i, first.get(g, i))
    out = []
    for i, w in split:
        gone = set()
        for k in range(len(w) - n + 1):
            if first[tuple(w[k:k + n])] < i:
                gone |= set(range(k, k + n))
        out.append((i, len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)))
    return out
