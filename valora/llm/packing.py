"""Packing token ids into rows of fixed length, best fit decreasing.

Each text is encoded and closed with an end id; one longer than a row is cut
into pieces of full rows and a rest, losslessly.  Within a group of consecutive
texts (``GROUP_TOKENS`` tokens, so a task holds one group) the pieces are
placed longest first, each into the open row with the least room that still
holds it; a segment tree over the room sizes finds that row in logarithmic
time.  Nothing is shuffled.

Per row: ``ids`` (little-endian ``uint16`` or ``uint32``, padded with the pad
id to the row length), ``n_tokens``, and per segment its document, the number
of the piece in the document, the cumulative lengths (``cu_seqlens``, from 0)
and the places where positions start again from 0 (``position_resets``).

Defined cases: a null or empty text is its end id alone; a null id is kept as
null; repeated rows are packed as often as they come; an empty table gives
no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from valora.llm import tokens

ROW_TOKENS = 2048
GROUP_TOKENS = 1 << 20
SCHEMA = ("ids binary, n_tokens int, doc_ids array<long>, pieces array<int>, cu_seqlens array<int>, "
          "position_resets array<int>")


class _Rooms:
    """Open rows by room: a segment tree over room sizes 0..limit that tells the
    smallest size at or above a value that has a row."""

    def __init__(self, limit: int):
        self.width = 1 << limit.bit_length()
        self.tree = bytearray(2 * self.width)
        self.rows: list[list[int]] = [[] for _ in range(limit + 1)]

    def add(self, room: int, row: int) -> None:
        self.rows[room].append(row)
        node = room + self.width
        while node and not self.tree[node]:
            self.tree[node] = 1
            node >>= 1

    def take(self, size: int) -> int | None:
        """The row with the least room of at least ``size``, removed."""
        node = size + self.width
        if not self.tree[node]:
            while node > 1 and (node & 1 or not self.tree[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.width:
                node = 2 * node if self.tree[2 * node] else 2 * node + 1
        room = node - self.width
        row = self.rows[room].pop()
        if not self.rows[room]:
            while node:
                self.tree[node] = 0
                node >>= 1
                if node and (self.tree[2 * node] or self.tree[2 * node + 1]):
                    break
        return row


def best_fit(sizes: list[int], limit: int) -> list[list[int]]:
    """Indices of ``sizes`` in rows of at most ``limit``, by best fit
    decreasing (ties by index)."""
    rooms, rows, left = _Rooms(limit), [], []
    for k in sorted(range(len(sizes)), key=lambda k: (-sizes[k], k)):
        row = rooms.take(sizes[k])
        if row is None:
            row = len(rows)
            rows.append([])
            left.append(limit)
        rows[row].append(k)
        left[row] -= sizes[k]
        rooms.add(left[row], row)
    return rows


def _packed(pieces: list[tuple], limit: int, pad: int, kind) -> pa.RecordBatch:
    out = {c: [] for c in ("ids", "n_tokens", "doc_ids", "pieces", "cu_seqlens", "position_resets")}
    for row in best_fit([len(p[2]) for p in pieces], limit):
        parts = [pieces[k] for k in row]
        ends = np.cumsum([len(p[2]) for p in parts])
        ids = np.full(limit, pad, kind)
        ids[: ends[-1]] = np.concatenate([p[2] for p in parts])
        out["ids"].append(ids.tobytes())
        out["n_tokens"].append(int(ends[-1]))
        out["doc_ids"].append([p[0] for p in parts])
        out["pieces"].append([p[1] for p in parts])
        out["cu_seqlens"].append([0, *ends.tolist()])
        out["position_resets"].append([0, *ends[:-1].tolist()])
    kinds = [pa.binary(), pa.int32(), pa.list_(pa.int64()), *[pa.list_(pa.int32())] * 3]
    return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out.values(), kinds, strict=True)], list(out))


def pack(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", row_tokens: int = ROW_TOKENS,
         group_tokens: int = GROUP_TOKENS, vocabulary: str = tokens.VOCABULARY) -> DataFrame:
    """The packed rows of all texts of ``df``; the end id (also the pad id) is
    the first free id of the vocabulary."""
    data = df.sparkSession.sparkContext.broadcast(tokens.vocabulary(vocabulary))
    end = tokens.size(data.value)
    kind = np.dtype("<u2") if end < 1 << 16 else np.dtype("<u4")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code, pieces, held = tokens.encoder(data.value), [], 0
        for batch in batches:
            for id_, text in zip(batch.column(0), batch.column(1), strict=True):
                id_ = id_.as_py()
                ids = np.array(tokens.encode(code, text.as_py() or "") + [end], kind)
                for k, at in enumerate(range(0, len(ids), row_tokens)):
                    pieces.append((id_, k, ids[at:at + row_tokens]))
                held += len(ids)
                if held >= group_tokens:
                    yield _packed(pieces, row_tokens, end, kind)
                    pieces, held = [], 0
        if pieces:
            yield _packed(pieces, row_tokens, end, kind)

    return df.select(F.col(f"`{id_col}`").cast("long").alias("id"),
                     F.col(f"`{text_col}`").cast("string").alias("text")).mapInArrow(run, SCHEMA)


def unpack(packed: DataFrame, vocabulary: str = tokens.VOCABULARY) -> DataFrame:
    """``(doc_id, text)`` read back from packed rows: segments by document and
    piece, end ids off, decoded.  Texts of repeated ids run together."""
    data = packed.sparkSession.sparkContext.broadcast(tokens.vocabulary(vocabulary))
    end = tokens.size(data.value)
    kind = np.dtype("<u2") if end < 1 << 16 else np.dtype("<u4")

    @F.arrow_udf("array<binary>")
    def cut(ids: pa.Array, bounds: pa.Array) -> pa.Array:
        code = tokens.encoder(data.value)
        out = []
        for row, marks in zip(ids, bounds.to_pylist(), strict=True):
            values = np.frombuffer(row.as_py(), kind)
            out.append([code.decode_bytes([v for v in values[a:b].tolist() if v != end])
                        for a, b in zip(marks[:-1], marks[1:], strict=True)])
        return pa.array(out, pa.list_(pa.binary()))

    parts = packed.select(F.explode(F.arrays_zip("doc_ids", "pieces", cut("ids", "cu_seqlens").alias("bytes"))).alias("p"))
    ordered = F.array_sort(F.collect_list(F.struct("p.pieces", "p.bytes")))
    return parts.groupBy(F.col("p.doc_ids").alias("doc_id")).agg(
        F.decode(F.aggregate(ordered, F.lit(b""), lambda a, x: F.concat(a, x["bytes"])), "UTF-8").alias("text"))


def write_packed(packed: DataFrame, path: str) -> None:
    """Write the packed rows as Parquet: one matrix row a record."""
    packed.write.mode("overwrite").parquet(path)
