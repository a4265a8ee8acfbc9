"""Chat formatting by token-level assembly.

Role and text of a turn are encoded separately, and the template is put around
them as reserved ids that no text can encode to; the loss mask follows from
prefix sums over segment lengths (+1 where an assistant's text begins, -1 where
it ends).  Written out, the reserved ids are control strings; where a text
contains one of these, or a backslash, a backslash goes before it, so the
written form can be read back as well.

Turns are encoded where they lie; then a conversation's segments are brought
together in order of the turns by a sorted shuffle and assembled as a stream,
in chunks of at most ``CHUNK`` tokens plus a turn, so a conversation of any
length passes a task in bounded memory.

Defined cases: a null text or role is empty; a null turn comes first; turns
with the same number are ordered by role and text; rows with a null id are one
conversation; repeated rows are repeated turns; other columns play no part.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from valora.llm import tokens

#: Reserved ids count from the first id the vocabulary leaves free, in this
#: order: a turn begins, its text begins, it ends.
CONTROL = ("### ", ": ", "</turn>\n")
CHUNK = 1 << 16
CHUNKS = "conv_id long, chunk int, ids array<int>, mask array<byte>"

_TEXT = re.compile(r"\\|###|</turn>")
_ROLE = re.compile(r"\\|###|</turn>|:")
_ESCAPED = re.compile(r"\\(.)", re.S)


def escape(text: str, role: bool = False) -> str:
    return (_ROLE if role else _TEXT).sub(r"\\\g<0>", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def _encoder(data):
    @F.arrow_udf("role array<int>, body array<int>")
    def encode(roles: pa.Array, texts: pa.Array) -> pa.Array:
        code = tokens.encoder(data.value)
        rows = [{"role": tokens.encode(code, escape(r or "", True)), "body": tokens.encode(code, escape(t or ""))}
                for r, t in zip(roles.to_pylist(), texts.to_pylist(), strict=True)]
        return pa.array(rows, pa.struct([("role", pa.list_(pa.int32())), ("body", pa.list_(pa.int32()))]))
    return encode


def _assemble(first: int, chunk: int):
    def rows(conv, number, segments) -> pa.RecordBatch:
        sizes = np.array([len(s) for s, _ in segments])
        ends = np.cumsum(sizes)
        change = np.zeros(int(ends[-1]) + 1, np.int8)
        for (_, loss), a, b in zip(segments, ends - sizes, ends, strict=True):
            change[a] += loss
            change[b] -= loss
        ids = np.concatenate([np.asarray(s, np.int32) for s, _ in segments])
        mask = np.cumsum(change[:-1], dtype=np.int8)
        return pa.RecordBatch.from_arrays(
            [pa.array([conv], pa.int64()), pa.array([number], pa.int32()), pa.array([ids], pa.list_(pa.int32())),
             pa.array([mask], pa.list_(pa.int8()))], ["conv_id", "chunk", "ids", "mask"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, number, segments, held, begun = None, 0, [], 0, False
        for batch in batches:
            for id_, learn, role, body in zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True):
                if begun and (id_ != conv or held >= chunk):
                    yield rows(conv, number, segments)
                    number, segments, held = number + 1, [], 0
                if not begun or id_ != conv:
                    conv, number, begun = id_, 0, True
                segments += [([first], 0), (role, 0), ([first + 1], 0), (body, int(learn)), ([first + 2], 0)]
                held += len(role) + len(body) + 3
        if begun and segments:
            yield rows(conv, number, segments)
    return run


def format_chats(df: DataFrame, vocabulary: str = tokens.VOCABULARY, learn_role: str = "assistant",
                 id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
                 chunk: int = CHUNK) -> DataFrame:
    """Chunks of formatted conversations: ids and loss mask.  The chunks of one
    conversation follow each other in order in one partition."""
    data = df.sparkSession.sparkContext.broadcast(tokens.vocabulary(vocabulary))
    role, text = (F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in (role_col, text_col))
    turns = df.select(F.col(f"`{id_col}`").cast("long").alias("conv_id"), F.col(f"`{turn_col}`").cast("long").alias("turn"),
                      role.alias("role"), text.alias("text"))
    coded = turns.withColumn("code", _encoder(data)("role", "text"))
    return (coded.select("conv_id", "turn", "role", "text", (F.col("role") == learn_role).alias("learn"), "code")
            .repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
            .select("conv_id", "learn", "code.role", "code.body")
            .mapInArrow(_assemble(tokens.size(data.value), chunk), CHUNKS))


DIGESTS = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def digests(chats: DataFrame, vocabulary: str = tokens.VOCABULARY) -> DataFrame:
    """Read formatted conversations back: one row each, with counts and hashes
    of their turns, of the text under the loss mask, and the length of the
    written form."""
    data = chats.sparkSession.sparkContext.broadcast(tokens.vocabulary(vocabulary))
    first = tokens.size(data.value)

    class Reader:
        def __init__(self, conv):
            self.conv, self.turns, self.chars, self.loss_chars = conv, 0, 0, 0
            self.all, self.loss = hashlib.sha256(), hashlib.sha256()

        def segment(self, code, ids: list[int]) -> str:
            written = code.decode_bytes(ids).decode("utf-8")
            self.chars += len(written)
            return unescape(written)

        def read(self, code, ids: np.ndarray, mask: np.ndarray) -> None:
            marks = np.flatnonzero(ids >= first)
            before, part = 0, ""
            for at in marks:
                kind = int(ids[at]) - first
                self.chars += len(CONTROL[kind])
                if at > before or kind:
                    part = self.segment(code, ids[before:at].tolist())
                if kind == 1:
                    self.all.update(part.encode() + b"\n")
                elif kind == 2:
                    self.turns += 1
                    self.all.update(part.encode() + b"\n")
                before = at + 1
            edge = np.flatnonzero(np.diff(np.concatenate([[0], mask, [0]])))
            for a, b in zip(edge[::2], edge[1::2], strict=True):
                learned = unescape(code.decode_bytes(ids[a:b].tolist()).decode("utf-8"))
                self.loss_chars += len(learned)
                self.loss.update(learned.encode())

        def row(self) -> list:
            return [self.conv, self.turns, self.all.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars]

    names = [c.split()[0] for c in DIGESTS.split(", ")]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code, reader = tokens.encoder(data.value), None
        for batch in batches:
            done = []
            for k in range(batch.num_rows):
                conv = batch.column(0)[k].as_py()
                if reader is None or conv != reader.conv:
                    if reader is not None:
                        done.append(reader.row())
                    reader = Reader(conv)
                reader.read(code, batch.column(2)[k].values.to_numpy(), batch.column(3)[k].values.to_numpy())
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done), kinds, strict=True)], names)
        if reader is not None:
            yield pa.RecordBatch.from_arrays([pa.array([c], t) for c, t in zip(reader.row(), kinds, strict=True)], names)

    return chats.mapInArrow(run, DIGESTS)
