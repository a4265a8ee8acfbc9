"""Removal of word passages that an earlier document also has, by
difference-cover anchors.

A passage is a window of 13 consecutive words; a word goes when some window
covering it also starts in a document with a smaller id.  Hashing every window
of a corpus and moving all of them through a shuffle costs more than the
corpus itself, so:

1. *Anchors.*  Only the 7-word runs that start at cover positions (1, 2, 4
   modulo 7, a perfect difference cover) are hashed.  For any two residues
   some shift k of 0..6 puts both on the cover, so two equal 13-word windows
   contain, k words in, equal 7-word runs that are anchors in both documents.
   Anchors found in two documents mark the only windows that can repeat.
2. *Extension.*  Of marked windows the whole 13 words are compared (by 79
   hash bits), and for each the smallest document that has it is found.
3. The covered words are cut out.

Exact copies of a text are set aside first: all of a later copy's windows
repeat.  Within each Arrow batch, equal windows are resolved on the spot and
only one representative (the smallest and largest id) leaves it, so a passage
shared by a third of the corpus gives a few rows a task, not one an
occurrence.  What is resolved on the spot travels in the same shuffle as the
open questions (under keys of its own, spread evenly), so that a recomputed
task stays consistent.

Defined cases: a null or empty text has no words; rows with a null id take no
part and keep all words; rows with the same id are one document, so they
remove nothing from each other; repeated rows come back as often as they came.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from valora.llm import words as W
from valora.llm.session import stored

PERIOD, COVER = 7, (1, 2, 4)
#: Text combined before rows leave a task.
BATCH_BYTES = 8 << 20
_FOUND = "key long, more int, id long, at long, size int"


def _spread(id_: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Negative keys for rows that need no partner."""
    return -(W.mix(id_.astype(W.U) * W.U(31) + at.astype(W.U)) >> W.U(1)).astype(np.int64) - 1


def _runs(owner: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Unions of touching spans [low, high) of each owner."""
    if not len(owner):
        return owner, low, high
    order = np.lexsort((low, owner))
    owner, low, high = owner[order], low[order], high[order]
    shift = owner.astype(np.int64) << 32
    reach = np.maximum.accumulate(high + shift)
    first = np.ones(len(owner), bool)
    first[1:] = (low + shift)[1:] > reach[:-1]
    at = np.flatnonzero(first)
    last = np.append(at[1:], len(owner)) - 1
    return owner[at], low[at], (reach[last] - shift[last])


def _emit(key, more, id_, at, size) -> pa.RecordBatch:
    """``at``: 31 bits of the text's hash (rows of one id may differ) above the
    32 of the word position, so that rows stay short."""
    return pa.RecordBatch.from_arrays(
        [pa.array(key, pa.int64()), pa.array(more, pa.int32()), pa.array(id_, pa.int64()), pa.array(at, pa.int64()),
         pa.array(size, pa.int32())], ["key", "more", "id", "at", "size"])


def _anchors(window: int):
    """Per batch: an anchor's key and place."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, sigs = (batch.column(k).to_numpy() for k in (0, 1))
            for a, b, data, offs in W.slices(batch.column(2), BATCH_BYTES):
                hashes, bounds = W.word_hashes(data, offs)
                row = W.row_of(bounds)
                grams = W.rolling(hashes, PERIOD)
                place = np.arange(len(grams)) - bounds[row[: len(grams)]]
                long_enough = (np.diff(bounds) >= window)[row[: len(grams)]]
                on = np.flatnonzero(W.inside(bounds, PERIOD) & np.isin(place % PERIOD, COVER) & long_enough)
                if not len(on):
                    continue
                key, row, place = (grams[on] >> W.U(16)).astype(np.int64), row[on], place[on]
                id_, at = ids[a:b][row], (sigs[a:b][row] << 32) | place
                order = np.lexsort((id_, key))
                k, i = key[order], id_[order]
                new = np.append(True, k[1:] != k[:-1])
                start = np.flatnonzero(new)
                end = np.append(start[1:], len(k))
                several = i[start] != i[end - 1]
                shared = np.zeros(len(k), bool)
                shared[order] = several[np.cumsum(new) - 1]
                low, high = start[several], end[several] - 1
                key = np.where(shared, _spread(id_, at), key)
                some = np.zeros(2 * len(low), np.int64)
                yield _emit(np.concatenate([key, k[low], k[low]]), np.zeros(len(key) + len(some), np.int32),
                            np.concatenate([id_, i[low], i[high]]), np.concatenate([at, some - 1]),
                            np.ones(len(key) + len(some), np.int32))
    return run


def _spans(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, low, size) of a list column of ``low + size << 32``; null: none."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    counts = pc.list_value_length(column).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = column.flatten().to_numpy().astype(np.int64)
    return np.repeat(np.arange(len(column)), counts), flat & 0xFFFFFFFF, flat >> 32


def _marked(bounds: np.ndarray, row: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Words of the rows that lie in a span [low, high) of word positions."""
    change = np.zeros(int(bounds[-1]) + 1, np.int32)
    size = np.diff(bounds)[row]
    np.add.at(change, bounds[row] + np.clip(low, 0, size), 1)
    np.subtract.at(change, bounds[row] + np.clip(high, 0, size), 1)
    return np.cumsum(change[:-1]) > 0


def _windows(window: int):
    """Per batch: the marked windows' keys; a window that a smaller document
    of the batch has is settled."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, sigs = (batch.column(k).to_numpy() for k in (0, 1))
            of, low, _ = _spans(batch.column(3))
            for a, b, data, offs in W.slices(batch.column(2), BATCH_BYTES):
                hashes, bounds = W.word_hashes(data, offs)
                mine = (of >= a) & (of < b)
                marked = _marked(bounds, of[mine] - a, low[mine] - (window - PERIOD), low[mine] + 1)
                grams = W.rolling(hashes, window)
                at = np.flatnonzero(marked[: len(grams)] & W.inside(bounds, window))
                if not len(at):
                    continue
                key = (grams[at] >> W.U(1)).astype(np.int64)
                more = (W.rolling(W.mix(hashes), window)[at] >> W.U(48)).astype(np.int64)
                row = W.row_of(bounds)[at]
                place = at - bounds[row]
                id_ = ids[a:b][row]
                order = np.lexsort((id_, more, key))
                k, m, i = key[order], more[order], id_[order]
                new = np.append(True, (k[1:] != k[:-1]) | (m[1:] != m[:-1]))
                least = i[np.flatnonzero(new)][np.cumsum(new) - 1]
                ask, done = np.sort(order[i == least]), order[i != least]  # in text order: rows of one text compress well
                owner, lo, hi = _runs(row[done], place[done], place[done] + window)
                id_, where = np.concatenate([id_[ask], ids[a:b][owner]]), np.concatenate([place[ask], lo])
                where |= sigs[a:b][np.concatenate([row[ask], owner])] << 32
                settled = slice(len(ask), None)
                yield _emit(np.concatenate([key[ask], _spread(id_[settled], where[settled])]),
                            np.concatenate([more[ask], np.zeros(len(owner), np.int64)]), id_, where,
                            np.concatenate([np.full(len(ask), window), hi - lo]))
    return run


def _cut(window: int):
    @F.arrow_udf("n_words long, n_removed long, kept string")
    def cut(texts: pa.Array, spans: pa.Array, copies: pa.Array) -> pa.Array:
        of, low, run = _spans(spans)
        copy = copies.to_numpy(zero_copy_only=False).astype(bool)
        out = []
        for a, b, data, offs in W.slices(texts):
            starts, ends, bounds = W.word_spans(data, offs)
            size = np.diff(bounds)
            mine = (of >= a) & (of < b)
            row = W.row_of(bounds)
            gone = _marked(bounds, of[mine] - a, low[mine], (low + run)[mine]) | (copy[a:b] & (size >= window))[row]
            stay = np.flatnonzero(~gone)
            final = np.append(row[stay][1:] != row[stay][:-1], True)[: len(stay)]
            edges = np.zeros(len(data) + 2, np.int8)
            edges[starts[stay]] += 1
            np.subtract.at(edges, ends[stay] + ~final, 1)
            mask = np.cumsum(edges[:len(data)], dtype=np.int8) > 0
            text = data.copy()
            text[ends[stay][~final]] = 0x20
            places = np.concatenate([[0], np.cumsum(W.row_sums(mask, offs))])
            kept = pa.LargeStringArray.from_buffers(b - a, pa.py_buffer(places.astype(np.int64)),
                                                    pa.py_buffer(np.ascontiguousarray(text[mask])))
            out.append(pa.StructArray.from_arrays(
                [pa.array(size, pa.int64()), pa.array(W.row_sums(gone, bounds), pa.int64()), kept.cast(pa.string())],
                ["n_words", "n_removed", "kept"]))
        kind = pa.struct([("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept", pa.string())])
        return pa.concat_arrays(out) if out else pa.array([], kind)

    return cut


def _collected(found: DataFrame, hit: Column, place: Column) -> DataFrame:
    """Per text: the places of the rows that ``hit``."""
    return (found.filter(hit & (F.col("at") >= 0)).groupBy("id", F.shiftright("at", 32).alias("sig"))
            .agg(F.collect_list(place).alias("spans")))


def remove_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 13,
                   out: str = "dedup") -> DataFrame:
    """``df`` with a struct column ``out``: ``n_words``, ``n_removed`` and
    ``kept`` (the words that stay, joined by one space)."""
    if window < 2 * PERIOD - 1:
        raise ValueError(f"a window has at least {2 * PERIOD - 1} words")
    id_, sig, text = "__dedup_id", "__dedup_sig", F.col(f"`{text_col}`").cast("string")
    # a whole-number id moves once; the order of the columns is that of
    # ``texts``, so that all uses of the texts share one exchange
    rest = [c for c in df.columns if c != out and (c != id_col or dict(df.dtypes)[id_col] != "bigint")]
    keyed = df.select(F.col(f"`{id_col}`").cast("long").alias(id_),
                      F.shiftrightunsigned(F.xxhash64(text), 33).alias(sig), *(F.col(f"`{c}`") for c in rest))
    known = keyed.filter(F.col(id_).isNotNull())
    texts = known.select(F.col(id_).alias("id"), F.col(sig).alias("sig"), text.alias("text"))

    hashed = known.select(F.col(id_).alias("id"), F.col(sig).alias("sig"),
                          F.unhex(F.sha2(F.coalesce(text, F.lit("")), 256)).alias("same"))
    groups = (hashed.groupBy("same").agg(F.min("id").alias("first"), F.max("id").alias("last"))
              .filter(F.col("first") < F.col("last")))
    copies = stored(hashed.join(groups, "same").filter(F.col("id") > F.col("first")).select("id", "sig").distinct())

    single = texts.join(copies, ["id", "sig"], "left_anti").select("id", "sig", "text")
    anchors = (single.sortWithinPartitions("id", "sig").mapInArrow(_anchors(window), _FOUND)
               .select("key", "id", "at"))
    same = Window.partitionBy("key")
    anchors = anchors.withColumns({"least": F.min("id").over(same), "most": F.max("id").over(same)})
    low = F.col("at").bitwiseAND(F.lit(0xFFFFFFFF))
    # written, so that the anchors' shuffle files go before the windows' come;
    # the texts move once more for it
    marked = stored(_collected(anchors, (F.col("key") < 0) | (F.col("least") < F.col("most")), low.cast("int")))

    # an anchor marks the windows it can lie in
    windows = (single.join(marked, ["id", "sig"]).select("id", "sig", "text", "spans")
               .sortWithinPartitions("id", "sig").mapInArrow(_windows(window), _FOUND))
    covered = _collected(windows.withColumn("least", F.min("id").over(Window.partitionBy("key", "more"))),
                         (F.col("key") < 0) | (F.col("least") < F.col("id")),
                         low.bitwiseOR(F.shiftleft(F.col("size").cast("long"), 32)))

    info = (covered.withColumn("copy", F.lit(False))
            .unionByName(copies.withColumns({"spans": F.lit(None).cast("array<long>"),
                                             "copy": F.lit(True)})))
    info = info.select(F.col("id").alias(id_), F.col("sig").alias(sig), F.col("spans").alias("__spans"),
                       F.col("copy").alias("__copy"))
    none = {"__spans": F.lit(None).cast("array<long>"), "__copy": F.lit(False)}
    joined = (known.join(info, [id_, sig], "left")
              .unionByName(keyed.filter(F.col(id_).isNull()).withColumns(none)))
    cut = _cut(window)(text, F.col("__spans"), F.coalesce(F.col("__copy"), F.lit(False)))
    done = joined.withColumn(out, cut)
    if id_col not in keyed.columns:
        done = done.withColumnRenamed(id_, id_col)
    return done.select(*(F.col(f"`{c}`") for c in df.columns if c != out), out)
