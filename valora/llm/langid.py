"""Language identification by multilingual mixture inference.

Each word of a text is taken as written in one of the learned languages; its
likelihood in each comes from byte 3-grams (words padded by a space, A-Z
folded, 3-grams hashed to ``BUCKETS`` counts per language).
Expectation-maximisation estimates the proportions of the languages in the
text; then the language set is chosen by penalised likelihood: as long as
leaving out the weakest language costs less log-likelihood than half the log
of the number of words, it is left out.

Learning counts the 3-grams of all given texts on the executors; what reaches
the driver are ``BUCKETS`` numbers a language.

Defined cases: a null text, one without a letter, and any text when nothing
was learned are ``und`` with score 0; rows with a null language teach nothing;
equal proportions go to the language that comes first in the alphabet.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from valora.llm import words as W

BUCKETS = 1 << 16
ROUNDS = 6
SLICE_BYTES = 1 << 20
UNKNOWN = "und"

_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = True
_LETTER[128:] = True


def _grams(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(codes, begins, bounds)``: 3-gram buckets of all words, where each
    word's begin, and per row its first word.  A word of k bytes has k 3-grams;
    words without a letter are left out."""
    starts, ends, bounds = W.word_spans(data, offs)
    letters = np.concatenate([[0], np.cumsum(_LETTER[data], dtype=np.int32)])
    good = letters[ends] > letters[starts]
    kept = np.concatenate([[0], np.cumsum(good)])
    starts, ends, bounds = starts[good], ends[good], kept[bounds]
    sizes = ends - starts
    begins = np.cumsum(sizes) - sizes
    at = np.arange(int(sizes.sum())) + np.repeat(starts - begins, sizes)
    low = W.LOWER[data].astype(np.uint32)
    first = np.zeros(len(at), bool)
    first[begins] = True
    last = np.zeros(len(at), bool)
    last[begins + sizes - 1] = True
    before = np.where(first, 32, low[at - 1])
    after = np.where(last, 32, low[np.minimum(at + 1, max(len(low) - 1, 0))]) if len(at) else at.astype(np.uint32)
    code = ((before << 16) | (low[at] << 8) | after).astype(np.uint32) * np.uint32(2654435761)
    return code >> np.uint32(16), begins, bounds


def learn(df: DataFrame, text_col: str = "text", lang_col: str = "lang") -> tuple[list[str], np.ndarray]:
    """Languages and the log-probability of each 3-gram bucket in each."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}
        for batch in batches:
            names = np.array(batch.column(0).to_pylist(), object)
            for a, b, data, offs in W.slices(batch.column(1), SLICE_BYTES):
                codes, begins, bounds = _grams(data, offs)
                row = np.repeat(W.row_of(bounds), np.diff(np.append(begins, len(codes))))
                kinds, which = np.unique(names[a:b].astype(str), return_inverse=True)
                for k, name in enumerate(kinds):
                    mine = np.bincount(codes[which[row] == k], minlength=BUCKETS)
                    totals[name] = totals.get(name, 0) + mine
        for name, counts in totals.items():
            at = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(at)), pa.array(at, pa.int32()), pa.array(counts[at])],
                                             ["lang", "bucket", "n"])

    counted = (df.select(F.col(f"`{lang_col}`").cast("string").alias("lang"), F.col(f"`{text_col}`").cast("string").alias("text"))
               .filter("lang is not null").mapInArrow(count, "lang string, bucket int, n long")
               .groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow())  # at most BUCKETS rows a language
    lang = np.array(counted.column("lang").to_pylist(), object)
    names = sorted(set(lang))
    table = np.full((len(names), BUCKETS), 0.5)
    for k, name in enumerate(names):
        of = np.flatnonzero(lang == name)
        table[k, counted.column("bucket").to_numpy()[of]] += counted.column("n").to_numpy()[of]
    return names, np.log(table / table.sum(axis=1, keepdims=True)).astype(np.float32)


def _expect(like: np.ndarray, row: np.ndarray, bounds: np.ndarray, share: np.ndarray, rounds: int):
    """Proportions after some rounds of expectation-maximisation, and the
    log-likelihood of each row under them."""
    size = np.maximum(np.diff(bounds), 1)[:, None]
    full = np.flatnonzero(np.diff(bounds))
    sums = lambda x: np.add.reduceat(x, bounds[full], axis=0, dtype=np.float64)
    for step in range(rounds + 1):
        joint = like * share[row]
        total = joint.sum(axis=1, keepdims=True) + 1e-30
        if step == rounds:
            out = np.zeros(len(share))
            out[full] = sums(np.log(total[:, 0]))
            return share, out
        share = share.copy()
        share[full] = (sums(joint / total) / size[full])


def proportions(data: np.ndarray, offs: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Of each row: the proportion of each language (0 where not in its set)."""
    codes, begins, bounds = _grams(data, offs)
    rows, langs = len(offs) - 1, len(table)
    share = np.full((rows, langs), 1.0 / langs)
    if not len(codes):
        return share
    scores = np.stack([np.add.reduceat(line[codes], begins, dtype=np.float32) for line in table], axis=1)
    like = np.exp(np.maximum(scores - scores.max(axis=1, keepdims=True), -60.0))
    row = W.row_of(bounds)
    share, fit = _expect(like, row, bounds, share, ROUNDS)
    penalty = 0.5 * np.log(np.maximum(np.diff(bounds), 2))
    open_ = np.diff(bounds) > 0
    # several weak languages at once, then one after another
    for weak in (0.05, *[None] * (langs - 1)):
        if weak is None:
            masked = np.where(share > 0, share, np.inf)
            drop = np.zeros_like(share, bool)
            drop[np.arange(rows), masked.argmin(axis=1)] = True
        else:
            drop = (share < weak) & (share > 0)
        count = drop.sum(axis=1)
        able = open_ & (count > 0) & ((share > 0).sum(axis=1) > count)
        if weak is None:
            open_ = able
        if not able.any():
            continue
        ask = np.flatnonzero(able)
        size = np.diff(bounds)[ask]
        at = np.repeat(bounds[ask] - (np.cumsum(size) - size), size) + np.arange(size.sum())
        less = np.where(drop[ask], 0.0, share[ask])
        less /= less.sum(axis=1, keepdims=True)
        less, again = _expect(like[at], np.repeat(np.arange(len(ask)), size), np.append(0, np.cumsum(size)), less, 3)
        better = again >= fit[ask] - penalty[ask] * count[ask]
        share[ask[better]], fit[ask[better]] = less[better], again[better]
        if weak is None:
            open_[ask[~better]] = False
    return share


def _lettered(texts: pa.Array, data: np.ndarray, offs: np.ndarray, first: int) -> np.ndarray:
    ascii_letters = W.row_sums(_LETTER[data] & (data < 128), offs) > 0
    other = np.flatnonzero(~ascii_letters & (W.row_sums(data >= 128, offs) > 0))
    for k in other:
        ascii_letters[k] = any(c.isalpha() for c in (texts[first + int(k)].as_py() or ""))
    return ascii_letters


def with_language(df: DataFrame, model: tuple[list[str], np.ndarray], text_col: str = "text",
                  out: str = "language") -> DataFrame:
    """``df`` with a struct column ``out``: ``lang_pred``, ``score`` (the
    proportion of that language) and ``mixture`` (the chosen languages, largest
    first, with their proportions)."""
    names, table = model
    kept = df.sparkSession.sparkContext.broadcast(table)

    @F.arrow_udf("lang_pred string, score double, mixture array<struct<lang: string, share: double>>")
    def tell(texts: pa.Array) -> pa.Array:
        result = []
        for a, _, data, offs in W.slices(texts, SLICE_BYTES):
            known = _lettered(texts, data, offs, a)
            share = proportions(data, offs, kept.value) if names else np.zeros((len(known), 0))
            for ok, line in zip(known, share, strict=True):
                if not ok or not names:
                    result.append({"lang_pred": UNKNOWN, "score": 0.0, "mixture": []})
                    continue
                order = sorted(np.flatnonzero(line), key=lambda k: (-line[k], k))
                result.append({"lang_pred": names[order[0]], "score": float(min(1.0, line[order[0]])),
                               "mixture": [{"lang": names[k], "share": float(line[k])} for k in order]})
        part = pa.struct([("lang", pa.string()), ("share", pa.float64())])
        return pa.array(result, pa.struct([("lang_pred", pa.string()), ("score", pa.float64()), ("mixture", pa.list_(part))]))

    return df.withColumn(out, tell(F.col(f"`{text_col}`").cast("string")))
