"""Spelling variants: words that differ by one inserted, deleted or replaced
code point, found through an index of grams of variable length.

* ``word_counts``: runs of letters of whole texts, counted in the tasks before
  they are shuffled.
* Gram dictionary: a gram of two code points is extended to a third where it
  is frequent (more than 1 in ``DICTIONARY`` of all gram places), so a common
  gram gives way to longer, rarer ones.  The frequent grams, fewer than
  ``DICTIONARY`` short strings of each length whatever the number of words, are the dictionary every task gets.
* Decomposition: a word, with a mark before and after it, has one gram at each
  place: the shortest that is not frequent, or the longest.  Which one depends on its own code
  points alone, so an edit affects exactly the grams that cover its place.  A
  word's *affected-gram bound* is the largest number of its grams that cover
  one place: at most ``MOST_GRAM`` of ``length + 1``.
* List merging: two words one edit apart share all but the affected grams, so
  ``SHARED`` at least, those left of the edit along with the word's beginning, those
  right of it with its end.  In the order (rare first, then by hash) the first
  ``SHARED`` unaffected grams are among each word's first ``bound + SHARED``; only these
  are indexed.  A list's key has the places of a whole choice of them: the
  beginning up to the last one left of the edit and the end from the first one
  right of it.  Pairs that meet in a list are verified.

Hot lists: words are distinct, and a list holds those that share beginning,
end or both over ``SHARED`` of their rarest grams.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from valora.llm import words as W
from valora.llm.session import stored

#: The letters of a word.
RUN = re.compile("[a-zÀ-ÿ]+")
LEAST_GRAM, MOST_GRAM = 2, 3
#: Grams that any two words one edit apart share: a word of 6 code points has 7,
#: of which an edit affects ``MOST_GRAM`` at most.
SHARED = 4
LEAST_LENGTH = MOST_GRAM + SHARED - 1
#: A gram at more than one in so many places is frequent.
DICTIONARY = 20_000
#: Up to this length the edit distance is computed where a pair meets.
SHORT = 64
START, END = "\x02", "\x03"
#: Distinct words a task holds before it passes their counts on; bytes of text it cuts at once.
HELD, PIECE = 200_000, 1 << 22

_ASCII_LETTER = np.zeros(256, bool)
_ASCII_LETTER[65:91] = _ASCII_LETTER[97:123] = True
_FOLD = bytes(W.LOWER)


def _pieces(text: bytes) -> Iterator[bytes]:
    """``text`` cut before ASCII bytes that are no letters, so between words."""
    while len(text) > PIECE:
        rest = np.frombuffer(text, np.uint8, offset=PIECE)
        for at in range(0, len(rest), PIECE):
            part = rest[at:at + PIECE]
            stop = np.flatnonzero((part < 128) & ~_ASCII_LETTER[part])
            if len(stop):
                at += PIECE + int(stop[0])
                break
        else:
            break
        yield text[:at]
        text = text[at:]
    yield text


def _emit(tally: Counter) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(tally), pa.string()), pa.array(list(tally.values()), pa.int64())],
                                      ["word", "n"])


def _counter(least: int, noise: int | None) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tally: Counter = Counter()
        long = 0
        for batch in batches:
            ids = batch.column(0).to_pylist()
            for id_, value in zip(ids, batch.column(1).cast(pa.large_binary())):
                text = value.as_py()
                if text is None:
                    continue
                seed = zlib.crc32(f"{id_}:".encode()) if noise and id_ is not None else None
                for piece in _pieces(text):
                    for word, n in Counter(RUN.findall(piece.translate(_FOLD).decode("utf-8", "replace"))).items():
                        if len(word) < least:
                            continue
                        if seed is not None and not (h := zlib.crc32(word.encode(), seed)) % noise:
                            at = h % len(word)
                            word = word[:at] + word[at + 1:]
                            if len(word) < least:
                                continue
                        tally[word] += n
                        if len(word) > 1000:
                            long += len(word)
                    if len(tally) > HELD or long > PIECE:
                        yield _emit(tally)
                        tally, long = Counter(), 0
        yield _emit(tally)
    return run


def word_counts(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = LEAST_LENGTH,
                min_count: int = 1, noise: int | None = None) -> DataFrame:
    """``(word, n)``: maximal runs of ``[A-Za-z\\u00C0-\\u00FF]`` of whole texts,
    A-Z lower-cased, with at least ``min_length`` code points and ``min_count``
    occurrences.  ``noise``: where it divides the unsigned CRC-32 ``h`` of
    ``<id>:<run>``, the run loses its code point ``h % length``, as a source of
    misspellings.

    A null text has no words; rows with a null id lose nothing to ``noise``;
    repeated rows count again; other columns are not read."""
    slim = df.select(F.col(f"`{id_col}`").cast("string").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    counts = slim.mapInArrow(_counter(min_length, noise), "word string, n long")
    return counts.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= min_count)


def _gram_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    tally: Counter = Counter()
    for batch in batches:
        for word in batch.column(0).to_pylist():
            s = START + word + END
            for q in range(LEAST_GRAM, MOST_GRAM + 1):
                tally.update(s[k:k + q] for k in range(len(s) - q + 1))
            if len(tally) > HELD:
                yield _emit(tally)
                tally = Counter()
    yield _emit(tally)


def gram_dictionary(words: DataFrame) -> dict[str, int]:
    """The frequent grams of 2 to 5 code points of column ``word``, with their counts: fewer
    than ``DICTIONARY`` of each length, as each holds more than that share of the places."""
    counts = words.select("word").mapInArrow(_gram_counts, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    places = words.agg(F.sum(F.length("word") + 1)).first()[0] or 0
    return {r[0]: r[1] for r in counts.filter(F.col("n") > max(8, places // DICTIONARY)).collect()}


def decompose(word: str, frequent: dict[str, int]) -> tuple[list[tuple[int, int]], int]:
    """Places ``(start, end)`` of the grams of ``word`` between its marks, one
    from each start, and the largest number of them that an edit affects."""
    s = START + word + END
    grams, cover = [], [0] * (len(s) + 1)
    for at in range(len(s) - LEAST_GRAM + 1):
        end = at + LEAST_GRAM
        while end < len(s) and end - at < MOST_GRAM and s[at:end] in frequent:
            end += 1
        grams.append((at, end))
        cover[at] += 1
        cover[end] -= 1
    most = depth = 0
    for change in cover:
        depth += change
        most = max(most, depth)
    return grams, most


def list_keys(word: str, frequent: dict[str, int], rank: dict[str, tuple[int, int]], shared: int = SHARED) -> set[int]:
    """The lists a word is in.  An edit has ``k`` of the first ``shared``
    unaffected grams on its left and the others on its right, so the ``k``-th
    indexed gram at least ends, and the last but ``shared - k - 1`` at most begins, what is kept."""
    s = START + word + END
    grams, bound = decompose(word, frequent)
    ordered = sorted((rank.get(s[a:b]) or (0, xxhash.xxh3_64_intdigest(s[a:b])), a, b) for a, b in grams)
    first = sorted((a, b) for _, a, b in ordered[:bound + shared])
    keys, m = set(), len(first)
    for i, (a, b) in enumerate(first):
        if i >= shared - 1:
            keys.add(xxhash.xxh3_64_intdigest(s[:b], 1))
        if i <= m - shared:
            keys.add(xxhash.xxh3_64_intdigest(s[a:], 2))
        left = xxhash.xxh3_64(s[:b], 3)
        for j in range(i + 1, m):
            if first[j][0] >= b and i + 1 + m - j >= shared:
                both = left.copy()
                both.update(START + s[first[j][0]:])
                keys.add(both.intdigest())
    return keys


def _lists(frequent: dict[str, int]) -> Callable:
    rank = {g: (n, xxhash.xxh3_64_intdigest(g)) for g, n in frequent.items()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, of = [], []
            for row, word in enumerate(batch.column(0).to_pylist()):
                mine = list_keys(word, frequent, rank)
                keys += mine
                of += [row] * len(mine)
            take = pa.array(of, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.array(keys, np.uint64).view(np.int64)), *(batch.column(k).take(take) for k in (0, 1, 2))],
                ["key", "word", "n", "size"])
    return run


def _one_edit(a: str, b: str) -> bool:
    """Whether ``b``, not shorter than ``a``, is one edit away: behind the
    common beginning, found by halving, the rest is the same."""
    if a == b or len(b) - len(a) > 1:
        return False
    low, high = 0, len(a)
    while low < high:
        mid = (low + high + 1) // 2
        if a[low:mid] == b[low:mid]:
            low = mid
        else:
            high = mid - 1
    return a[low + (len(a) == len(b)):] == b[low + 1:]


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield batch.filter(pa.array([_one_edit(a, b) for a, b in zip(batch.column(0).to_pylist(),
                                                                     batch.column(2).to_pylist())], pa.bool_()))


def near_words(words: DataFrame) -> DataFrame:
    """Pairs ``(word, n, other, other_n)``, each once, of distinct words of
    ``words`` (word, n) at an edit distance of exactly one.  Words have at least
    6 code points."""
    frequent = gram_dictionary(words)
    index = (words.select("word", "n", F.length("word").alias("size"))
             .mapInArrow(_lists(frequent), "key long, word string, n long, size int").repartition("key"))
    other = index.select("key", F.col("word").alias("other"), F.col("n").alias("other_n"), F.col("size").alias("other_size"))
    longer = F.col("other_size") - F.col("size")
    ordered = ((longer == 1) | ((longer == 0) & (F.col("word") < F.col("other"))))
    # Spark's edit distance takes quadratic time; pairs of long words go on to ``_verify``
    near = F.when(F.col("size") <= SHORT, F.levenshtein("word", "other", 1) == 1).otherwise(True)
    met = index.join(other, "key").filter(ordered).filter(near).select("word", "n", "other", "other_n").distinct()
    return met.mapInArrow(_verify, "word string, n long, other string, other_n long")


def _roots(forms: DataFrame) -> DataFrame:
    """``(word, root)`` of ``(word, form)``: the last of the forms.  A form has
    a multiple of its word's occurrences, so there are no rings; each round
    doubles the steps taken."""
    current = stored(forms.select("word", F.col("form").alias("root")))
    while True:
        further = current.select(F.col("word").alias("root"), F.col("root").alias("beyond"))
        step = stored(current.join(further, "root", "left"))
        if step.filter(F.col("beyond").isNotNull()).isEmpty():
            return current
        current = step.select("word", F.coalesce("beyond", "root").alias("root"))


def spelling_variants(words: DataFrame, ratio: int = 5) -> DataFrame:
    """``words`` (word, n) with ``n_near`` (words one edit apart), ``form`` (of
    these the one with the largest n, ties to the smallest in code-point order,
    if its n is at least ``ratio`` times the word's), ``form_n`` and ``root`` (the last
    of a word's chain of forms, the word itself if it has none).

    ``words`` has one row a word, of 6 or more code points; no words give no rows."""
    if ratio < 2:
        raise ValueError("a form has at least twice its word's occurrences")
    words = stored(words.select("word", "n"))
    pairs = near_words(words)
    both = F.explode(F.array(
        F.struct(F.col("word"), F.col("n"), F.col("other"), F.col("other_n")),
        F.struct(F.col("other").alias("word"), F.col("other_n").alias("n"), F.col("word").alias("other"),
                 F.col("n").alias("other_n"))))
    best = F.min(F.struct((-F.col("p.other_n")).alias("less"), F.col("p.other").alias("word")))
    near = (pairs.select(both.alias("p")).groupBy("p.word").agg(F.count("*").alias("n_near"), best.alias("best")))
    joined = words.join(near, "word", "left")
    enough = -F.col("best.less") >= F.lit(ratio) * F.col("n")
    found = stored(joined.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(enough, F.col("best.word")).alias("form"), F.when(enough, -F.col("best.less")).alias("form_n")))
    roots = _roots(found.filter(F.col("form").isNotNull()))
    return (found.join(roots, "word", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"))
