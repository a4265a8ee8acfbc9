"""Words, span hashes and rolling n-gram hashes of Arrow text columns.

A word is a maximal run of bytes other than space and ``\\t\\n\\v\\f\\r``
(all ASCII, so UTF-8 text can be cut byte by byte).  Everything is computed
on the byte buffer of the Arrow column, without a Python object per row or
word.  Hashes are polynomials modulo 2**64 with odd bases (so a prefix sum
gives the hash of any span) followed by a mixing step.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U = np.uint64
SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

#: Bytes of text handled at once; a longer single text is one slice.
SLICE_BYTES = 2 << 20
#: Bytes whose prefix hashes are held at once.
BLOCK_BYTES = 1 << 19

BYTE_BASE = 0x9E3779B97F4A7C15
WORD_BASE = 0xD6E8FEB86659FD93


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit mixer (splitmix64 finaliser)."""
    x = x ^ (x >> U(30))
    x *= U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


_BYTE_CODE = mix(np.arange(1, 257, dtype=U) * U(0x9E3779B97F4A7C15))


class _Powers:
    """Powers of an odd base and of its inverse, grown on demand."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, U)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 1 << 16)
            for name, base in (("up", self.base), ("down", self.inverse)):
                steps = np.full(size, base, U)
                steps[0] = U(1)
                setattr(self, name, np.multiply.accumulate(steps))
        return self.up[:n], self.down[:n]


_BYTE_POWERS = _Powers(BYTE_BASE)
_WORD_POWERS = _Powers(WORD_BASE)


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes and row offsets of a string column (null: empty)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary()).fill_null(b"")
    _, offsets, data = column.buffers()
    n = len(column)
    if not n:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offs = np.frombuffer(offsets, np.int64, n + 1, column.offset * 8)
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[offs[0]:offs[-1]], offs - offs[0]


def slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``(first row, end row, bytes, offsets)`` of consecutive row ranges with
    at most ``limit`` bytes, or one row."""
    data, offs = buffers(column)
    row, rows = 0, len(offs) - 1
    while row < rows:
        end = max(row + 1, int(np.searchsorted(offs, offs[row] + limit, side="right")) - 1)
        end = min(end, rows)
        yield row, end, data[offs[row]:offs[end]], offs[row:end + 1] - offs[row]
        row = end


def row_sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sums of ``values[offsets[i]:offsets[i + 1]]`` as int64."""
    out = np.zeros(len(offsets) - 1, np.int64)
    full = offsets[1:] > offsets[:-1]
    if full.any():
        out[full] = np.add.reduceat(values, offsets[:-1][full], dtype=np.int64)
    return out


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(starts, ends, bounds)``: byte spans of all words, and per row the
    index of its first word (one more entry at the end)."""
    solid = ~SPACE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    begin = edge[:-1].copy()
    begin[1:] |= ~solid[:-1]
    begin &= solid
    finish = edge[1:].copy()
    finish[:-1] |= ~solid[1:]
    finish &= solid
    starts, ends = np.flatnonzero(begin), np.flatnonzero(finish) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of byte spans given in ascending order, without overlaps."""
    out = np.empty(len(starts), U)
    i = 0
    while i < len(starts):
        low = starts[i]
        j = max(i + 1, int(np.searchsorted(ends, low + BLOCK_BYTES, side="right")))
        part = data[low:ends[j - 1]]
        up, down = _BYTE_POWERS.get(len(part) + 1)
        sums = np.zeros(len(part) + 1, U)
        np.cumsum(_BYTE_CODE[part] * up[:-1], out=sums[1:])
        a, b = starts[i:j] - low, ends[i:j] - low
        out[i:j] = mix((sums[b] - sums[a]) * down[a] + (b - a).astype(U))
        i = j
    return out


def word_hashes(data: np.ndarray, offsets: np.ndarray, lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """``(hashes, bounds)`` of all words of the rows; ``lower`` folds A-Z."""
    if lower:
        data = LOWER[data]
    starts, ends, bounds = word_spans(data, offsets)
    return span_hashes(data, starts, ends), bounds


def rolling(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of every run of ``n`` consecutive entries (runs across rows are
    included; see ``inside``)."""
    m = len(hashes)
    if m < n:
        return np.zeros(0, U)
    up, down = _WORD_POWERS.get(m + 1)
    sums = np.zeros(m + 1, U)
    np.cumsum(hashes * up[:-1], out=sums[1:])
    return mix((sums[n:] - sums[:-n]) * down[: m - n + 1] + U(n))


def row_of(bounds: np.ndarray) -> np.ndarray:
    """Row index of every word."""
    return np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))


def inside(bounds: np.ndarray, n: int) -> np.ndarray:
    """Of the runs ``rolling`` hashes: those that lie in one row."""
    m = int(bounds[-1])
    if m < n:
        return np.zeros(0, bool)
    last = np.repeat(bounds[1:], np.diff(bounds))[: m - n + 1]
    return np.arange(m - n + 1) + n <= last


def shingle_sets(hashes: np.ndarray, bounds: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-word shingles of each row, ascending by hash: ``(values,
    bounds)``.  A row with fewer than ``n`` words, but some, has one shingle:
    its whole word sequence."""
    rows = len(bounds) - 1
    grams = rolling(hashes, n)
    ok = inside(bounds, n)
    row, values = row_of(bounds)[: len(grams)][ok], grams[ok]
    counts = np.diff(bounds)
    short = np.flatnonzero((counts > 0) & (counts < n))
    if len(short):
        whole = np.zeros(len(short), U)
        for k in range(1, n):
            of = counts[short] == k
            whole[of] = rolling(hashes, k)[bounds[short[of]]] if of.any() else 0
        row, values = np.concatenate([row, short]), np.concatenate([values, whole])
    order = np.lexsort((values, row))
    row, values = row[order], values[order]
    keep = np.ones(len(row), bool)
    keep[1:] = (row[1:] != row[:-1]) | (values[1:] != values[:-1])
    row, values = row[keep], values[keep]
    return values, np.searchsorted(row, np.arange(rows + 1))
