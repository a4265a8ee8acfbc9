"""Spelling variants against plain Python over all pairs."""

import zlib
from collections import Counter

import pytest

from valora.llm.variants import (
    END, LEAST_GRAM, SHARED, START, decompose, gram_dictionary, near_words, spelling_variants, word_counts)
from valora.llm.variants import RUN, _pieces
from tests.llm.brute import FOLD

ALPHABET = "aabbcdeé"


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    a, b = sorted((a, b), key=len)
    k = next((i for i in range(len(a)) if a[i] != b[i]), len(a))
    return a[k + 1:] == b[k + 1:] if len(a) == len(b) else a[k:] == b[k + 1:]


def brute(rows, least=6, count=5, ratio=5, noise=199):
    n = Counter()
    for id_, text in rows:
        for run in RUN.findall((text or "").translate(FOLD)):
            h = zlib.crc32(f"{id_}:{run}".encode())
            if noise and id_ is not None and h % noise == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1:]
            n[run] += 1
    n = {w: c for w, c in n.items() if len(w) >= least and c >= count}
    near = {w: [v for v in n if one_edit(w, v)] for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= ratio * n[w] else None
    out = []
    for w in sorted(n):
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None))
    return out


def made(seed, words):
    """Words of few letters, many of them one edit apart, in skewed numbers."""
    rows, x = [], seed
    for k in range(words):
        x = (x * 6364136223846793005 + 1442695040888963407) % 2 ** 64
        size, y, word = 6 + (x >> 40) % 5, x, ""
        for _ in range(size):
            y = (y * 6364136223846793005 + 1442695040888963407) % 2 ** 64
            word += ALPHABET[(y >> 33) % (2 if k % 3 else len(ALPHABET))]
        rows.append((k, " ".join([word] * (1 + (x >> 50) % 40)) + (" " + word.upper() + "," if k % 2 else "\n1")))
    return rows


@pytest.mark.parametrize("noise", [199, 3])
def test_same_as_all_pairs(docs, noise):
    rows = made(11, 500) + [(1000, None), (1001, ""), (None, "unknown unknown unknown unknown unknown"),
                            (1002, "×÷×÷×÷ " * 9), (1003, "short " * 50), (1004, "aaaaaa " * 700), (1004, "aaaaab " * 30),
                            (1005, "chainaa " * 6 + "chainab " * 40 + "chainbb " * 300 + "chainbbb " * 1600)]
    got = spelling_variants(word_counts(docs(rows), min_count=5, noise=noise)).collect()
    assert sorted(map(tuple, got)) == brute(rows, noise=noise)
    assert noise == 3 or [r["root"] for r in got if r["word"] == "chainaa"] == ["chainbbb"]


def test_an_edit_affects_no_more_grams_than_the_bound(spark):
    words = [w for w, *_ in brute(made(5, 300), count=1, noise=None)]
    frequent = gram_dictionary(spark.createDataFrame([(w,) for w in words], "word string"))
    assert frequent
    for word in words:
        grams, bound = decompose(word, frequent)
        assert len(grams) == len(word) + 3 - LEAST_GRAM and len(grams) - bound >= SHARED
        mine = Counter((START + word + END)[a:b] for a, b in grams)
        for at in range(len(word) + 1):
            for edit in ("b", "zz"[:1]):
                for other in (word[:at] + edit + word[at:], word[:at] + edit + word[at + 1:], word[:at] + word[at + 1:]):
                    theirs, limit = decompose(other, frequent)
                    shared = sum((mine & Counter((START + other + END)[a:b] for a, b in theirs)).values())
                    assert shared >= max(len(grams) - bound, len(theirs) - limit)


def test_empty_tables_long_words_and_long_texts(spark, docs):
    assert spelling_variants(word_counts(docs([]))).count() == 0
    assert spelling_variants(word_counts(docs([(1, None), (2, "")]))).count() == 0
    long = "ab" * 200_000
    rows = [(1, " ".join([long + "x"] * 9)), (2, " ".join([long + "y"] * 50)), (3, "wording " * 900_000)]
    got = {r["word"][-3:]: r for r in spelling_variants(word_counts(docs(rows), min_count=5)).collect()}
    assert got["abx"]["form"][-1] == "y" and got["aby"]["n_near"] == 1 and got["ing"]["n"] == 900_000


def test_a_word_half_of_all_rows(spark):
    words = [("common" + chr(97 + k % 26) * (k // 26 + 1), 5) for k in range(300)] + [("commons", 10 ** 12)]
    frame = spark.createDataFrame(words + [("commonest", 3)], "word string, n long").dropDuplicates(["word"])
    pairs = {(r[0], r[2]) for r in near_words(frame).collect()}
    listed = sorted({w for w, _ in words} | {"commonest"})
    assert {tuple(sorted(p)) for p in pairs} == {(a, b) for a in listed for b in listed if a < b and one_edit(a, b)}


def test_pieces_are_cut_between_words():
    text = ("wörd " * 3_000_000).encode()
    parts = list(_pieces(text))
    assert len(parts) > 1 and b"".join(parts) == text and all(p.startswith(b" ") for p in parts[1:])
    assert list(_pieces(b"x" * 9_000_000)) == [b"x" * 9_000_000]
