"""Quality rules, substring dedup, n-gram join and decontamination against
brute force, on random texts over a small vocabulary and on edge cases."""

import random

import pytest
from pyspark.sql import functions as F

from tests.llm import brute
from valora.llm.decontaminate import drop_leaks, with_leaks
from valora.llm.graph import components
from valora.llm.ngram_join import keep_one, near_classes
from valora.llm.quality import keep_quality, with_quality
from valora.llm.substring_dedup import remove_repeats

HARD = [(1, None), (2, ""), (3, " \n\t "), (4, "one two"), (5, "One two"), (6, "é\x0bñ ü\r\nß 漢字 🙂 a b c d e f g h"),
        (7, "x " * 3000), (8, "same line\nsame line\nother\nsame line"), (9, "a\x00b c d   e"),
        (10, "w" * 200_000 + " tail of a very long word and some more words to come here now"), (11, "one two")]


def corpus(seed, count=60):
    r = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(400)]
    shared = [[r.choice(vocabulary) for _ in range(30)] for _ in range(3)]
    rows = []
    for i in range(count):
        kind = r.random()
        if rows and kind < 0.4:
            w = brute.words(r.choice(rows)[1])
            for _ in range(r.randint(0, 6)):
                if w:
                    w[r.randrange(len(w))] = r.choice(vocabulary)
        else:
            w = [r.choice(vocabulary) for _ in range(r.randint(0, 120))]
        if kind > 0.7:
            at = r.randint(0, len(w))
            w = w[:at] + r.choice(shared) + w[at:]
        text = "".join(x + r.choice([" ", " ", "\n", "  ", "\t"]) for x in w)
        rows.append((100 + i, text))
    r.shuffle(rows)
    return rows


@pytest.mark.parametrize("rows", [HARD, corpus(1)], ids=["hard", "random"])
def test_quality_counts(docs, rows):
    got = {r[0]: tuple(r)[1:] for r in with_quality(docs(rows)).select(
        "doc_id", *(f"quality.{c}" for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                                             "base_failed"))).collect()}
    assert got == {i: brute.quality(t) for i, t in rows}


def test_quality_verdicts_know_no_size(docs):
    """A salad of 30 words goes and prose stays, whatever their length."""
    r = random.Random(4)
    sizes = [500, 1999, 2000, 2001, 4000, 50_000]
    salad = [(n, " ".join(f"w{r.randrange(30)}" for _ in range(n))) for n in sizes]
    prose = [(n + 1, " ".join(f"w{int(30 * r.paretovariate(0.9))}" for _ in range(n))) for n in sizes]
    assert {x.doc_id for x in keep_quality(docs(salad + prose)).collect()} == {i for i, _ in prose}


def test_quality_verdicts(docs):
    r = random.Random(3)
    prose = lambda n: " ".join(f"w{r.randrange(3000)}" for _ in range(n))
    rows = [(1, prose(200)), (2, prose(9)), (3, " ".join(x + "###" for x in prose(100).split())),
            (4, " ".join(x for w in prose(20).split() for x in (w, w))), (5, "\n".join(["a line that comes again"] * 8 + [prose(60)])),
            (6, prose(5000)), (7, None)]
    df = docs(rows)
    kept = keep_quality(df)
    assert kept.columns == df.columns and {x.doc_id for x in kept.collect()} == {1, 6}


@pytest.mark.parametrize("rows", [HARD, corpus(2), corpus(3)], ids=["hard", "random", "random2"])
def test_substring_dedup(docs, rows):
    got = remove_repeats(docs(rows)).select("doc_id", "dedup.n_words", "dedup.n_removed", "dedup.kept")
    assert sorted(map(tuple, got.collect())) == sorted(brute.without_repeats(rows))


def test_substring_dedup_ids_and_columns(docs):
    long = " ".join(f"v{k}" for k in range(40))
    df = docs([(None, long), (5, long), (5, long), (5, long + " more"), (9, "x " + long), (9, "x " + long)])
    out = remove_repeats(df)
    assert out.columns == [*df.columns, "dedup"]
    got = sorted((r.doc_id or 0, r.dedup.n_removed) for r in out.collect())
    assert got == [(0, 0), (5, 0), (5, 0), (5, 0), (9, 40), (9, 40)]


@pytest.mark.parametrize("rows", [HARD, corpus(4), corpus(5, 90)], ids=["hard", "random", "random2"])
def test_ngram_join(docs, rows):
    got = {r[0]: (r[1], r[2]) for r in near_classes(docs(rows)).collect()}
    expected = brute.classes(rows)
    assert got == {i: (n, c) for i, (n, c) in expected.items()}


def test_ngram_join_chain_and_hub(docs):
    """A chain of small edits links its ends; a passage that all texts share
    links none."""
    r = random.Random(8)
    base = [f"b{k}" for k in range(120)]
    rows, w = [], list(base)
    for i in range(12):
        rows.append((i, " ".join(w)))
        w = list(w)
        w[(i * 9) % 120] = f"edit{i}"
    passage = [f"p{k}" for k in range(50)]
    rows += [(100 + i, " ".join([*passage, *(f"u{r.randrange(10 ** 6)}" for _ in range(80))])) for i in range(30)]
    got = {x[0]: (x[1], x[2]) for x in near_classes(docs(rows)).collect()}
    assert got == brute.classes(rows) and got[11][1] == 0


def test_keep_one_keeps_rows_whole(docs):
    text = " ".join(f"t{k}" for k in range(30))
    df = docs([(3, text), (1, text), (1, text), (7, "other text of its own right here"), (None, text), (8, None), (9, "")])
    out = keep_one(df)
    assert out.columns == df.columns
    assert sorted((x.doc_id or 0) for x in out.collect()) == [0, 1, 7, 8, 9]


def test_components(spark):
    pairs = [(1, 2), (2, 3), (9, 8), (8, 7), (3, 4), (5, 5), (None, 4), (20, 1)] + [(k, k + 1) for k in range(30, 60)]
    got = dict(map(tuple, components(spark.createDataFrame(pairs, "a long, b long"), "a", "b").collect()))
    assert got == {1: 1, 2: 1, 3: 1, 4: 1, 20: 1, 7: 7, 8: 7, 9: 7, **{k: 30 for k in range(30, 61)}}


@pytest.mark.parametrize("block_words", [2_000_000, 40])
def test_decontamination(spark, docs, block_words):
    r = random.Random(5)
    words = lambda n: [f"w{r.randrange(5000)}" for _ in range(n)]
    items = [(k, " ".join(words(n))) for k, n in enumerate([5, 6, 12, 15, 33, 59, 200, 4, 0])] + [(50, None), (51, "a b")]
    rows = []
    for i in range(40):
        w = words(r.choice([3, 30, 400, 3000]))
        q = r.choice(items)[1]
        part = brute.words(q)
        if part and r.random() < 0.6:
            part[r.randrange(len(part))] = "changed"
        at = r.randint(0, len(w))
        rows.append((i, " ".join(w[:at] + part + w[at:]).upper()))
    rows += [(90, None), (91, ""), (92, "A b")]
    test = spark.createDataFrame(items, "item_id long, text string")
    found = with_leaks(docs(rows), test, block_words=block_words)
    got = {(x.doc_id, x.l.item_id, x.l.n_shared, x.l.n_item)
           for x in found.select("doc_id", F.explode("leaks").alias("l")).collect()}
    expected = set()
    for i, t in rows:
        for k, q in items:
            s = brute.shingles(q, whole=False)
            n = len(s & brute.shingles(t, whole=False))
            if s and 100 * n >= 80 * len(s):
                expected.add((i, k, n, len(s)))
    assert got == expected and expected
    clean = drop_leaks(docs(rows), test, block_words=block_words)
    assert {x.doc_id for x in clean.collect()} == {i for i, _ in rows} - {x[0] for x in expected}


@pytest.mark.parametrize("block_words", [2_000_000, 8])
def test_decontamination_without_ids_and_of_short_items(spark, docs, block_words):
    items = [(None, "p q r s t u"), (1, "A b"), (2, "b"), (3, "a c"), (4, ""), (5, None), (None, "x y z v"), (6, "a B")]
    rows = [(1, "k a b k a b"), (2, "a k b"), (3, "p q r s t u v"), (4, None), (5, "w X y z V"), (6, "x y z"), (7, "a"), (8, "c")]
    test = spark.createDataFrame(items, "item_id long, text string")
    found = with_leaks(docs(rows), test, block_words=block_words, short=True)
    got = sorted(map(str, (tuple(x) for x in found.select("doc_id", F.explode("leaks").alias("l")).select("doc_id", "l.*").collect())))
    assert got == sorted(map(str, [(1, 1, 1, 1), (1, 6, 1, 1), (1, 2, 1, 1), (2, 2, 1, 1), (3, None, 2, 2), (5, None, 1, 1)]))
    assert {x.doc_id for x in drop_leaks(docs(rows), test, block_words=block_words, short=True).collect()} == {4, 6, 7, 8}


def test_empty_tables(spark, docs):
    none = docs([])
    items = spark.createDataFrame([], "item_id long, text string")
    assert with_quality(none).count() == 0 and remove_repeats(none).count() == 0
    assert near_classes(none).count() == 0 and with_leaks(none, items).count() == 0
    assert drop_leaks(docs(HARD), items).count() == len(HARD)


def test_keep_one_with_clashing_names(spark):
    """Columns may have the names that ``keep_one`` uses inside."""
    text = "one two three four five six seven"
    rows = [(3, text, 7, 1, "k", 2), (2, text, 8, 1, "k", 2), (2, text, 8, 1, "k", 2), (None, text, 9, 1, "k", 2), (5, None, 0, 1, "k", 2)]
    df = spark.createDataFrame(rows, "doc_id long, text string, __n int, __class_id int, __kept_id string, component_id long")
    kept = keep_one(df)
    assert kept.columns == df.columns
    assert sorted((x.doc_id or 0, x["__n"]) for x in kept.collect()) == [(0, 9), (2, 8), (5, 0)]
    assert keep_one(df.limit(0)).collect() == []
