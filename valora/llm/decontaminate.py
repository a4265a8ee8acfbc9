"""Benchmark decontamination: size-partitioned MinHash containment search.

Test items are short, documents long, so the Jaccard similarity of the two says
nothing.  Items are therefore partitioned by size (powers of two of their
number of 5-word shingles), and for each size a document is cut into windows of
about twice that size (two adjacent blocks, so that any passage as long as an
item lies in one window).  An item contained in a window to 0.8 then has a
Jaccard similarity of 0.19 or more with it, and shares one of ``HASHES``
minimum hash values with a probability above 0.999998.  Every item so found is
verified by exact containment of its shingles in the whole document.

Documents stay where they are: one Arrow function over the text column, no
shuffle.  Items reach the tasks in blocks of at most ``BLOCK_WORDS`` words (one
pass over the documents a block), so what is sent is bounded whatever the size
of the benchmark.

Defined cases: words are compared with A-Z folded; an item with fewer than
five words is never found, or with ``short`` where its word sequence is in a
document (one shingle, the whole item); an item without words is never found; the id of an
item plays no part in the search, and may be null; a document that is empty or
null contains nothing; items or documents given twice are found twice.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from valora.llm import words as W

HASHES = 64
BLOCK_WORDS = 2_000_000
_FACTORS = (W.mix(np.arange(1, HASHES + 1, dtype=W.U)) >> W.U(32)).astype(np.uint32) | np.uint32(1)
_KIND = pa.list_(pa.struct([("item_id", pa.int64()), ("n_shared", pa.int64()), ("n_item", pa.int64())]))


def _grams(texts: pa.Array, n: int):
    for a, b, data, offs in W.slices(texts):
        hashes, bounds = W.word_hashes(data, offs, lower=True)
        ok = W.inside(bounds, n)
        row = W.row_of(bounds)[: len(ok)][ok]
        yield a, b, row, W.rolling(hashes, n)[ok]


class _Index:
    """Items by size class: their shingles and minimum hash values."""

    def __init__(self, ids: list[int | None], texts: pa.Array, n: int, short: bool = False):
        self.ids, self.sets = ids, [np.zeros(0, W.U)] * len(ids)
        for a, b, row, values in _grams(texts, n):
            for k in range(b - a):
                self.sets[a + k] = np.unique(values[row == k])
        #: items too short for a shingle: by number of words, their hashes in order and the items
        self.short = []
        for m in range(1, n if short else 1):
            whole, of = [np.zeros(0, W.U)], [np.zeros(0, np.int64)]
            for a, b, data, offs in W.slices(texts):
                hashes, bounds = W.word_hashes(data, offs, lower=True)
                mine = np.flatnonzero(np.diff(bounds) == m)
                if len(mine):
                    whole.append(W.rolling(hashes, m)[bounds[mine]])
                    of.append(mine + a)
            whole, of = np.concatenate(whole), np.concatenate(of)
            if len(of):
                order = np.argsort(whole)
                self.short.append((m, whole[order], of[order]))
        size = np.array([len(s) for s in self.sets], np.int64)
        self.classes = []
        for c in np.unique(np.floor(np.log2(size[size > 0])).astype(int)):
            of = np.flatnonzero((size >= 1 << c) & (size < 2 << c))
            least = np.array([[(self.sets[i].astype(np.uint32) * f).min() for i in of] for f in _FACTORS], np.uint32)
            order = np.argsort(least, axis=1)
            maybe = np.zeros((HASHES, 1 << 16), bool)
            for k in range(HASHES):
                maybe[k, least[k] & 0xFFFF] = True
            self.classes.append((2 << c, of[order], np.take_along_axis(least, order, 1), maybe))

    def short_pairs(self, m: int, whole: np.ndarray, of: np.ndarray, texts: pa.Array) -> np.ndarray:
        """Sorted distinct (row, item) pairs of the items of ``m`` words, as row * items + item."""
        found = [np.zeros(0, np.int64)]
        for a, _, row, values in _grams(texts, m):
            first, last = np.searchsorted(whole, values, "left"), np.searchsorted(whole, values, "right")
            hit = np.flatnonzero(last > first)
            pairs = np.unique((row[hit] + a) * len(whole) + first[hit])  # one a text and distinct sequence
            row_of, start = np.divmod(pairs, len(whole))
            many = np.searchsorted(whole, whole[start], "right") - start
            which = np.repeat(start, many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
            found.append(np.repeat(row_of, many) * len(self.ids) + of[which])
        return np.unique(np.concatenate(found))

    def candidates(self, row: np.ndarray, values: np.ndarray, rows: int) -> np.ndarray:
        """Sorted distinct (row, item) pairs, as row * items + item."""
        found = [np.zeros(0, np.int64)]
        bounds = np.searchsorted(row, np.arange(rows + 1))
        place = np.arange(len(row)) - bounds[row]
        short = values.astype(np.uint32)
        cuts = []
        for size, *_ in self.classes:
            start = np.flatnonzero(place % size == 0)
            owner = row[start]
            cuts.append((start, owner, np.append(owner[1:] == owner[:-1], False)))
        for k, factor in enumerate(_FACTORS):
            hashed = short * factor
            for (_, items, least, maybe), (start, owner, paired) in zip(self.classes, cuts, strict=True):
                low = np.minimum.reduceat(hashed, start)
                low[:-1][paired[:-1]] = np.minimum(low[:-1], low[1:])[paired[:-1]]
                hit = np.flatnonzero(maybe[k][low & 0xFFFF])
                first = np.searchsorted(least[k], low[hit], "left")
                last = np.searchsorted(least[k], low[hit], "right")
                many = last - first
                which = np.repeat(first, many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
                found.append(np.repeat(owner[hit], many) * len(self.ids) + items[k][which])
        return np.unique(np.concatenate(found))


def _search(index: _Index, n: int, percent: int):
    @F.arrow_udf("array<struct<item_id: long, n_shared: long, n_item: long>>")
    def search(texts: pa.Array) -> pa.Array:
        sizes, out = [], []
        for a, b, row, values in _grams(texts, n):
            counts = np.zeros(b - a, np.int64)
            if len(values) and index.classes:
                last, mine = -1, None
                for pair in index.candidates(row, values, b - a):
                    r, i = divmod(int(pair), len(index.ids))
                    if r != last:
                        low, high = np.searchsorted(row, [r, r + 1])
                        last, mine = r, np.unique(values[low:high])
                    item = index.sets[i]
                    at = np.minimum(np.searchsorted(mine, item), len(mine) - 1)
                    shared = int((mine[at] == item).sum())
                    if 100 * shared >= percent * len(item):
                        counts[r] += 1
                        out.append((index.ids[i], shared, len(item)))
            sizes.append(counts)
        sizes = np.concatenate(sizes or [np.zeros(0, np.int64)])
        if index.short:
            pairs = np.concatenate([index.short_pairs(*of, texts) for of in index.short])
            rows, items = np.divmod(pairs, len(index.ids))
            out += [(index.ids[i], 1, 1) for i in items]
            every = np.concatenate([np.repeat(np.arange(len(sizes)), sizes), rows])
            out = [out[k] for k in np.argsort(every, kind="stable")]
            sizes = np.bincount(every, minlength=len(sizes))
        flat = pa.StructArray.from_arrays([pa.array([x[k] for x in out], pa.int64()) for k in range(3)],
                                          ["item_id", "n_shared", "n_item"])
        return pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(sizes)), pa.int32()), flat).cast(_KIND)

    return search


def with_leaks(df: DataFrame, items: DataFrame, text_col: str = "text", item_col: str = "item_id",
               item_text_col: str = "text", n: int = 5, percent: int = 80, out: str = "leaks",
               block_words: int = BLOCK_WORDS, short: bool = False) -> DataFrame:
    """``df`` with an array column ``out``: the items of which at least
    ``percent`` of the shingles are in the text, with the counts.  ``short``:
    items below ``n`` words too, as one exact word sequence."""
    test = items.select(F.col(item_col).cast("long").alias("id"), F.col(item_text_col).cast("string").alias("text"))
    total = test.agg(F.sum(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")))).first()[0] or 0
    blocks = max(1, -(-int(total) // block_words))
    text = F.col(f"`{text_col}`").cast("string")
    found = []
    for k in range(blocks):
        block = test.filter(F.pmod(F.xxhash64("id", "text"), F.lit(blocks)) == k).toArrow()
        index = _Index(block.column("id").to_pylist(), block.column("text").combine_chunks(), n, short)
        found.append(_search(index, n, percent)(text))
    return df.withColumn(out, F.concat(*found) if blocks > 1 else found[0])


def drop_leaks(df: DataFrame, items: DataFrame, **how) -> DataFrame:
    """The rows of ``df`` that contain no item, unchanged."""
    flag = "__leaks"
    while flag in df.columns:
        flag += "_"
    return with_leaks(df, items, out=flag, **how).filter(F.size(flag) == 0).drop(flag)
