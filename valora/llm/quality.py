"""Quality rules by repetition coverage.

Rolling hashes of several n-gram lengths give, for each text, the characters
that lie inside n-grams (and lines) occurring more than once in it.  One
Arrow function per batch of texts; no shuffle, no state across rows.

Defined cases: a null or empty text has zero words and fails the base rule;
repeated rows are judged alike; other columns, whatever their names, pass
through untouched (all results are one struct column, which replaces a column
of the same name).
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from valora.llm import words as W

SYMBOL = np.zeros(256, bool)
SYMBOL[list(b"#*$%&|<>")] = True
CONTINUATION = (np.arange(256) & 0xC0) == 0x80


@dataclass(frozen=True)
class Rules:
    """Base rule: at least ``min_words`` words, and at most
    ``max_repeat_words`` of the words inside 5-word windows found twice.
    Coverage: for each n-gram length, the largest share of word characters
    inside n-grams found twice; the largest share of lines, and of text
    characters, in lines equal to an earlier one; the most symbols a word;
    the largest share of words that repeat the word before them.
    Short n-grams recur the more often the longer a text is, so for lengths
    below 5 the limit rises with the number of words, without a step: it
    leaves ``1 - limit`` of a short text uncovered, and ``1 / sqrt(1 + (n_words /
    long_words)^2)`` of that in one of ``n_words``."""
    min_words: int = 10
    max_repeat_words: float = 0.20
    coverage: dict[int, float] = field(
        default_factory=lambda: {2: 0.60, 3: 0.60, 4: 0.55, 5: 0.30, 6: 0.28, 8: 0.26, 10: 0.25})
    long_words: int = 2000
    max_dup_lines: float = 0.45
    max_dup_line_chars: float = 0.30
    max_symbols: float = 0.10
    max_echo_words: float = 0.30


def _covered(hashes: np.ndarray, bounds: np.ndarray, row: np.ndarray, n: int) -> np.ndarray:
    """Words inside an n-word window that occurs twice in its row."""
    out = np.zeros(len(hashes), bool)
    grams = W.rolling(hashes, n)
    at = np.flatnonzero(W.inside(bounds, n))
    if not len(at):
        return out
    keys = W.mix(grams[at] ^ W.mix(row[at].astype(W.U) + W.U(1)))
    ordered = np.sort(keys)
    twice = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    if not len(twice):
        return out
    place = np.minimum(np.searchsorted(twice, keys), len(twice) - 1)
    hit = at[twice[place] == keys]
    change = np.zeros(len(hashes) + 1, np.int32)
    np.add.at(change, hit, 1)
    np.subtract.at(change, hit + n, 1)
    return np.cumsum(change[:-1]) > 0


def _lines(data: np.ndarray, offsets: np.ndarray, points: np.ndarray):
    """Per row: lines with a word, of these the ones equal to an earlier
    line, and the characters of the latter."""
    rows = len(offsets) - 1
    cut = np.flatnonzero(data == 0x0A)
    starts = np.unique(np.concatenate([offsets[:-1], cut + 1]))
    starts = starts[starts < len(data)]
    ends = np.searchsorted(offsets, starts, side="right")
    ends = offsets[np.minimum(ends, rows)]
    if len(cut):
        nxt = np.searchsorted(cut, starts)
        ends = np.where(nxt < len(cut), np.minimum(ends, cut[np.minimum(nxt, len(cut) - 1)]), ends)
    solid = np.concatenate([[0], np.cumsum(~W.SPACE[data], dtype=np.int64)])
    some = solid[ends] > solid[starts]
    starts, ends = starts[some], ends[some]
    row = np.searchsorted(offsets, starts, side="right") - 1
    keys = W.span_hashes(data, starts, ends)
    order = np.lexsort((starts, keys, row))
    again = np.zeros(len(starts), bool)
    if len(order):
        r, k = row[order], keys[order]
        again[order[1:]] = (r[1:] == r[:-1]) & (k[1:] == k[:-1])
    chars = np.concatenate([[0], np.cumsum(points, dtype=np.int64)])
    size = chars[ends] - chars[starts]
    count = lambda of, weight=None: np.bincount(row[of], weight, rows).astype(np.int64)
    return count(slice(None)), count(again), count(again, size[again])


def _measure(data: np.ndarray, offsets: np.ndarray, rules: Rules) -> dict[str, np.ndarray]:
    starts, ends, bounds = W.word_spans(data, offsets)
    hashes = W.span_hashes(data, starts, ends)
    row = W.row_of(bounds)
    points = ~CONTINUATION[data]
    in_words = points & ~W.SPACE[data]
    sizes = np.add.reduceat(in_words, starts, dtype=np.int64) if len(starts) else np.zeros(0, np.int64)
    n_words = np.diff(bounds)
    word_chars = W.row_sums(sizes, bounds)
    n_lines, dup_lines, dup_chars = _lines(data, offsets, points)
    out = {"n_words": n_words, "word_chars": word_chars, "n_symbols": W.row_sums(SYMBOL[data], offsets),
           "n_chars": W.row_sums(points, offsets), "n_lines": n_lines, "n_dup_lines": dup_lines,
           "dup_line_chars": dup_chars}
    for n in sorted({5, *rules.coverage}):
        covered = _covered(hashes, bounds, row, n)
        out[f"rep_chars_{n}"] = W.row_sums(np.where(covered, sizes, 0), bounds)
        if n == 5:
            out["n_repeat_words"] = W.row_sums(covered, bounds)
    echo = np.zeros(len(hashes), bool)
    echo[1:] = (hashes[1:] == hashes[:-1]) & (row[1:] == row[:-1])
    out["echo_words"] = W.row_sums(echo, bounds)
    bad = (n_words < rules.min_words) | (out["n_repeat_words"] > rules.max_repeat_words * n_words + 1e-9)
    out["base_failed"] = bad
    for n, most in rules.coverage.items():
        free = (1 - most) / np.sqrt(1 + (n_words / rules.long_words) ** 2) if n < 5 else 1 - most
        bad = bad | (word_chars - out[f"rep_chars_{n}"] < free * word_chars - 1e-9)
    bad = bad | (dup_lines > rules.max_dup_lines * n_lines) | (dup_chars > rules.max_dup_line_chars * out["n_chars"])
    bad = bad | (out["echo_words"] > rules.max_echo_words * n_words)
    out["kept"] = ~(bad | (out["n_symbols"] > rules.max_symbols * n_words))
    return out


def _fields(rules: Rules) -> list[str]:
    return ["n_words", "word_chars", "n_symbols", "n_chars", "n_lines", "n_dup_lines", "dup_line_chars",
            "n_repeat_words", "echo_words", *(f"rep_chars_{n}" for n in sorted({5, *rules.coverage}))]


def with_quality(df: DataFrame, text_col: str = "text", out: str = "quality", rules: Rules = Rules()) -> DataFrame:
    """``df`` with a struct column ``out``: the counts, ``base_failed`` and
    ``kept`` of each text."""
    longs, flags = _fields(rules), ["base_failed", "kept"]
    schema = ", ".join([*(f"{c} long" for c in longs), *(f"{c} boolean" for c in flags)])

    @F.arrow_udf(schema)
    def measure(texts: pa.Array) -> pa.Array:
        parts = [_measure(data, offs, rules) for _, _, data, offs in W.slices(texts)]
        join = lambda c, kind: np.concatenate([p[c].astype(kind) for p in parts] or [np.zeros(0, kind)])
        return pa.StructArray.from_arrays(
            [pa.array(join(c, np.int64)) for c in longs] + [pa.array(join(c, bool)) for c in flags], [*longs, *flags])

    return df.withColumn(out, measure(F.col(f"`{text_col}`").cast("string")))


def keep_quality(df: DataFrame, text_col: str = "text", rules: Rules = Rules()) -> DataFrame:
    """The rows of ``df`` whose text passes, unchanged."""
    flag = "__kept"
    while flag in df.columns:
        flag += "_"
    return (with_quality(df, text_col, flag, rules).filter(F.col(f"{flag}.kept")).drop(flag))
