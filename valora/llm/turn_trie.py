"""The prefix trie of conversations, by a splitter skeleton.

Conversations are sequences of turns (role, text).  Sorted by these sequences
and dealt to shards by splitters, the members of a trie node are neighbours; a
node whose members lie in several shards is a prefix of the splitter between
them.  The trie of the splitters' own paths, the *skeleton*, is broadcast: a
shard finishes every other node on its own, with a stack over its sorted rows,
and gives partial aggregates of skeleton nodes, which are reduced and then
summed up along the skeleton.

Bounds: a shard streams its rows and holds one path.  The skeleton has at most
``shards * (segment + 1)`` nodes, which is what reaches the driver.  A path is cut into
segments of ``segment`` turns: a row is (prefix of the segment, its turns), and
sorting (segment, prefix, turns) keeps the argument above within a segment, so
no conversation, however long, is one row or one task.  What lies below a
segment is added by each conversation that goes on: of the nodes it is the
smallest member of (a tail of its path), the sums over its later segments.

Equality of turns and of prefixes stands on 128 bits of hashes.
"""

from __future__ import annotations

import bisect
import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from valora.llm.session import shuffle_partitions, stored

SEGMENT = 256
#: Rows sampled for each splitter.
OVERSAMPLE = 16
#: Code points of one piece of a list of ids that crosses shards.
PIECE = 1 << 16
#: A node with more than one in so many of all nodes as children is a hot key.
MANY = 1000
STEP = 16

_PATH = "s int, p1 long, p2 long, key binary, sizes binary, id long, more boolean"
_NODE = ("kind int, s int, depth long, h1 long, h2 long, u1 long, u2 long, size int, n long, least long, children long, "
         "leaves long, saved long, more boolean, ends string, shard int, place long")
NODE_KEY = ["s", "depth", "h1", "h2"]
_FINAL, _PARTIAL, _LIST = 0, 1, 2


def turn_rows(df: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
              text_col: str = "text") -> DataFrame:
    """``(id, pos, t1, t2, size)``: each turn's place in its conversation (from
    1), hash and code points of its text.

    Ordered by turn (null first), ties by the hash of role and text; null role or text is empty;
    repeated rows are turns of their own; rows with a null id are left out; other
    columns are not read.  A conversation's rows are numbered over range partitions, so
    a long one is not one task."""
    role, text = (F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in (role_col, text_col))
    slim = df.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{turn_col}`").alias("turn"),
                     F.xxhash64(role, text).alias("t1"), F.xxhash64(F.lit(1), text, role).alias("t2"),
                     F.char_length(text).alias("size")).filter(F.col("id").isNotNull())
    slim = slim.withColumn("apart", F.pmod(F.monotonically_increasing_id(), F.lit(1024)))
    order = [F.col("id"), F.asc_nulls_first("turn"), F.col("t1"), F.col("t2"), F.col("apart")]
    parts = shuffle_partitions(df.sparkSession)
    placed = stored(slim.repartitionByRange(parts, *order).sortWithinPartitions(*order)
                    .select("id", "t1", "t2", "size", F.spark_partition_id().alias("part"),
                            F.monotonically_increasing_id().alias("row")))
    starts = placed.groupBy("id", "part").agg(F.min("row").alias("first"), F.count("*").alias("rows"))
    before = F.sum("rows").over(Window.partitionBy("id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    starts = starts.select("id", "part", (F.col("first") - F.coalesce(before, F.lit(0)) - 1).alias("zero"))
    return (placed.join(starts, ["id", "part"])
            .select("id", (F.col("row") - F.col("zero")).alias("pos"), "t1", "t2", "size"))


def with_openings(turns: DataFrame, base: Column, is_base: Column, length: Column, most: int) -> DataFrame:
    """``turns`` where each conversation's first ``length`` turns are replaced by
    the first ``length`` (at most ``most``) of conversation ``base``; these and ``is_base`` are
    columns of ``id``.  A row with place 0 and no turn stands for each conversation, as some have no turns left."""
    fields = F.struct("pos", "t1", "t2", "size")
    opening = (turns.filter((F.col("pos") <= most) & is_base).groupBy(F.col("id").alias("base"))
               .agg(F.sort_array(F.collect_list(fields)).alias("opening")))
    ids = turns.select("id").distinct().withColumns({"base": base, "length": length.cast("int")})
    opened = (ids.join(opening, "base", "left")
              .withColumn("opening", F.when(F.col("length") > 0, F.slice("opening", 1, F.greatest("length", F.lit(1))))))
    count = F.coalesce(F.size(F.filter("opening", lambda t: t["pos"].isNotNull())), F.lit(0))
    opened = stored(opened.select("id", "length", F.greatest(count, F.lit(0)).alias("count"), "opening"))
    nothing = F.struct(F.lit(0).cast("long").alias("pos"), F.lit(0).cast("long").alias("t1"),
                       F.lit(0).cast("long").alias("t2"), F.lit(0).alias("size"))
    new = opened.select("id", F.explode(F.concat(F.array(nothing), F.coalesce("opening", F.array().cast(
        "array<struct<pos:bigint,t1:bigint,t2:bigint,size:int>>")))).alias("t")).select("id", "t.*")
    own = (turns.join(opened.select("id", "length", "count"), "id").filter(F.col("pos") > F.col("length"))
           .select("id", (F.col("pos") - F.col("length") + F.col("count")).alias("pos"), "t1", "t2", "size"))
    return own.unionByName(new)


def _paths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A segment's sorted turns as one binary key, 16 bytes a turn."""
    for batch in batches:
        lists = batch.column(4)
        flat = lists.flatten()
        a, b, size = (flat.field(k).to_numpy(zero_copy_only=False) for k in (1, 2, 3))
        codes = np.empty((len(a), 2), ">i8")
        codes[:, 0], codes[:, 1] = a, b
        at = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))]).astype(np.int64)
        raw, sizes = codes.tobytes(), size.astype("<i4").tobytes()
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(k) for k in (1, 2, 3)),
             pa.array([raw[STEP * x:STEP * y] for x, y in zip(at, at[1:])], pa.binary()),
             pa.array([sizes[4 * x:4 * y] for x, y in zip(at, at[1:])], pa.binary()), batch.column(0), batch.column(5)],
            ["s", "p1", "p2", "key", "sizes", "id", "more"])


def _segments(turns: DataFrame, segment: int) -> DataFrame:
    """One row a conversation and segment: prefix hash, path, whether it goes on.
    A turn's code is its hash with its place; a prefix's hash is their
    exclusive or."""
    place = F.greatest(F.col("pos") - 1, F.lit(0))
    coded = turns.select("id", F.floor(place / segment).cast("int").alias("s"), "pos",
                         F.xxhash64("pos", "t1", "t2").alias("c1"), F.xxhash64(F.lit(1), "t2", "pos", "t1").alias("c2"), "size")
    real = F.col("pos") > 0
    rows = coded.groupBy("id", "s").agg(
        F.sort_array(F.collect_list(F.when(real, F.struct("pos", "c1", "c2", "size")))).alias("turns"),
        *(F.coalesce(F.bit_xor(F.when(real, F.col(c))), F.lit(0).cast("long")).alias(f"x{c}") for c in ("c1", "c2")))
    along = Window.partitionBy("id").orderBy("s")
    before = along.rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.select("id", "s", *(F.coalesce(F.bit_xor(f"xc{k}").over(before), F.lit(0).cast("long")).alias(f"p{k}")
                                    for k in (1, 2)), "turns", F.lead("s").over(along).isNotNull().alias("more"))
    return rows.mapInArrow(_paths, _PATH)


def _ints(key: bytes) -> list[tuple[int, int]]:
    return [tuple(x) for x in np.frombuffer(key, ">i8").astype(np.int64).reshape(-1, 2).tolist()]


def _skeleton(splitters: list[tuple], segment: int) -> set[tuple]:
    """All prefixes of the splitters' paths: (segment, depth, hash)."""
    nodes = set()
    for s, p1, p2, key, _ in splitters:
        depth = s * segment
        nodes.add((s, depth, p1, p2))
        for a, b in _ints(key):
            depth, p1, p2 = depth + 1, p1 ^ a, p2 ^ b
            nodes.add((s, depth, p1, p2))
    return nodes


def _deal(splitters: list[tuple]) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            s, p1, p2, key, id_ = (batch.column(k).to_pylist() for k in (0, 1, 2, 3, 5))
            shard = [bisect.bisect_right(splitters, row) for row in zip(s, p1, p2, key, id_)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(shard, pa.int32())], [*batch.schema.names, "shard"])
    return run


class _Node:
    __slots__ = ("depth", "h1", "h2", "u1", "u2", "size", "n", "least", "children", "leaves", "saved", "more", "split",
                 "digest", "ended", "piece", "held")

    def __init__(self, depth, h1, h2, u1, u2, size, split):
        self.depth, self.h1, self.h2, self.u1, self.u2, self.size, self.split = depth, h1, h2, u1, u2, size, split
        self.n = self.children = self.leaves = self.saved = self.ended = self.held = 0
        self.least, self.more = None, False
        self.digest, self.piece = None, None


class _Shard:
    """The stack over a shard's sorted rows."""

    def __init__(self, skeleton: set[tuple], segment: int, out: list):
        self.skeleton, self.segment, self.out = skeleton, segment, out
        self.stack: list[_Node] = []
        self.s, self.key, self.root, self.shard = 0, b"", None, 0

    def _push(self, depth, h1, h2, u1, u2, size):
        self.stack.append(_Node(depth, h1, h2, u1, u2, size, (self.s, depth, h1, h2) in self.skeleton))

    def _list(self, x: _Node):
        self.out.append((_LIST, self.s, x.depth, x.h1, x.h2, None, None, None, None, None, None, None, None, None,
                         ",".join(map(str, x.piece)), self.shard, x.piece[0]))
        x.piece, x.held = [], 0

    def _end(self, x: _Node, id_: int):
        x.ended += 1
        if x.split:
            if x.piece is None:
                x.piece = []
            x.piece.append(id_)
            x.held += 8
            if x.held > PIECE:
                self._list(x)
        else:
            if x.digest is None:
                x.digest = hashlib.sha256()
            x.digest.update((f"{id_}" if x.ended == 1 else f",{id_}").encode())

    def _pop(self):
        x = self.stack.pop()
        if x.split:
            if x.piece:
                self._list(x)
            ends = None
        else:
            ends = (x.digest or hashlib.sha256()).hexdigest()
            x.saved += (x.n - 1) * x.size
            if not x.children and not x.more:
                x.leaves = 1
        self.out.append((_PARTIAL if x.split else _FINAL, self.s, x.depth, x.h1, x.h2, x.u1, x.u2, x.size, x.n, x.least,
                         x.children, x.leaves, x.saved, x.more, ends, None, None))
        if self.stack:
            up = self.stack[-1]
            up.n += x.n
            up.least = x.least if up.least is None else min(up.least, x.least)
            if not x.split:
                up.leaves += x.leaves
                up.saved += x.saved
                up.children += 1

    def finish(self):
        while self.stack:
            self._pop()

    def add(self, s, p1, p2, key, sizes, id_, more):
        if self.root != (s, p1, p2):
            self.finish()
            self.s, self.root, self.key = s, (s, p1, p2), b""
            self._push(s * self.segment, p1, p2, None, None, 0)
        if key != self.key:
            same, most = 0, min(len(key), len(self.key))
            while same < most and key[same:same + STEP] == self.key[same:same + STEP]:
                same += STEP
            while len(self.stack) > same // STEP + 1:
                self._pop()
            lengths = np.frombuffer(sizes, "<i4")[same // STEP:].tolist()
            for (a, b), size in zip(_ints(key[same:]), lengths):
                up = self.stack[-1]
                self._push(up.depth + 1, up.h1 ^ a, up.h2 ^ b, up.h1, up.h2, size)
            self.key = key
        top = self.stack[-1]
        top.n += 1
        top.least = id_ if top.least is None else min(top.least, id_)
        if more:
            top.more = True
        else:
            self._end(top, id_)


_TYPES = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(),
          pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.string(), pa.int32(), pa.int64()]
_NAMES = [f.split()[0] for f in _NODE.split(", ")]


def _rows(out: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), _TYPES)], _NAMES)


def _finish_shards(skeleton: set[tuple], segment: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list = []
        state = _Shard(skeleton, segment, out)
        for batch in batches:
            columns = [batch.column(k).to_pylist() for k in range(8)]
            for *row, shard in zip(*columns):
                state.shard = shard
                state.add(*row)
            if out:
                yield _rows(out)
                out.clear()
        state.finish()
        if out:
            yield _rows(out)
    return run


def _joined_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digest of each skeleton node's ids from its sorted pieces."""
    current, digest = None, None

    def row():
        return pa.RecordBatch.from_arrays([*(pa.array([v], t) for v, t in zip(current, _TYPES[1:5])),
                                           pa.array([digest.hexdigest()])], [*NODE_KEY, "ends"])
    for batch in batches:
        for *key, piece in zip(*(batch.column(k).to_pylist() for k in range(5))):
            if key != current:
                if current is not None:
                    yield row()
                current, digest = key, hashlib.sha256()
            else:
                digest.update(b",")
            digest.update(piece.encode())
    if current is not None:
        yield row()


def _along_skeleton(reduced: list) -> list[tuple]:
    """The skeleton's reduced partial aggregates, with what its own nodes add to
    those above them."""
    nodes = {(r["s"], r["depth"], r["h1"], r["h2"]): r.asDict() for r in reduced}
    for key in sorted(nodes, key=lambda k: (k[0], -k[1])):
        x = nodes[key]
        x["saved"] += (x["n"] - 1) * x["size"]
        if not x["children"] and not x["more"]:
            x["leaves"] = 1
        up = nodes.get((x["s"], x["depth"] - 1, x["u1"], x["u2"]))
        if up is not None:
            up["children"] += 1
            up["leaves"] += x["leaves"]
            up["saved"] += x["saved"]
    return [tuple(x[c] for c in _NAMES[1:14]) for x in nodes.values()]


def _below(segment: int) -> Callable:
    """For each row of a conversation that goes on: what it adds to each node
    of its path here."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for s, p1, p2, key, leaves, saved in zip(*(batch.column(k).to_pylist() for k in range(6))):
                depth = s * segment
                if not s:
                    out.append((depth, p1, p2, leaves, saved))
                for a, b in _ints(key):
                    depth, p1, p2 = depth + 1, p1 ^ a, p2 ^ b
                    out.append((depth, p1, p2, leaves, saved))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)],
                                                 ["depth", "h1", "h2", "more_leaves", "more_saved"])
    return run


def trie(turns: DataFrame, segment: int = SEGMENT, shards: int | None = None) -> DataFrame:
    """The nodes of the prefix trie of ``turns`` (``turn_rows``): ``conv_id``
    (smallest member), ``depth``, ``parent_conv_id`` (null for the root), ``n_convs``, ``n_children``,
    ``n_leaves``, ``saved_tokens`` and ``ends_sha256``.

    No conversations give no nodes; a conversation without turns (place 0) ends
    at the root; equal conversations end at one node."""
    spark = turns.sparkSession
    shards = shards or shuffle_partitions(spark)
    paths = stored(_segments(turns, segment))
    order = ["s", "p1", "p2", "key", "id"]
    sample = (paths.select(*order).orderBy(F.xxhash64("id", "s"), "s", "id").limit(OVERSAMPLE * shards).collect())
    sample = sorted((r[0], r[1], r[2], bytes(r[3]), r[4]) for r in sample)
    splitters = sorted({sample[k * len(sample) // shards] for k in range(1, shards)} if sample else [])
    skeleton = _skeleton(splitters, segment)
    dealt = (paths.mapInArrow(_deal(splitters), f"{_PATH}, shard int").repartitionById(shards, F.col("shard"))
             .sortWithinPartitions(*order))
    nodes = stored(dealt.mapInArrow(_finish_shards(skeleton, segment), _NODE))

    first = lambda c: F.first(c, ignorenulls=True).alias(c)
    reduced = (nodes.filter(F.col("kind") == _PARTIAL).groupBy(*NODE_KEY).agg(
        first("u1"), first("u2"), first("size"), F.sum("n").alias("n"), F.min("least").alias("least"),
        *(F.sum(c).alias(c) for c in ("children", "leaves", "saved")), F.max("more").alias("more")))
    columns = _NAMES[1:14]
    kinds = ", ".join(_NODE.split(", ")[1:14])
    summed = spark.createDataFrame(_along_skeleton(reduced.collect()), kinds)
    lists = (nodes.filter(F.col("kind") == _LIST).select(*NODE_KEY, "ends", "shard", "place")
             .repartition(shards, *NODE_KEY).sortWithinPartitions(*NODE_KEY, "shard", "place").drop("shard", "place")
             .mapInArrow(_joined_lists, "s int, depth long, h1 long, h2 long, ends string"))
    nobody = hashlib.sha256().hexdigest()
    summed = summed.join(lists, NODE_KEY, "left").withColumn("ends", F.coalesce("ends", F.lit(nobody)))
    every = nodes.filter(F.col("kind") == _FINAL).select(*columns, "ends").unionByName(summed.select(*columns, "ends"))

    # the first node of a later segment is the last of the one before: its children are that node's
    joint = (F.col("s") > 0) & (F.col("depth") == F.col("s") * segment)
    inner = ["u1", "u2", "size", "n", "least", "leaves", "saved", "ends"]
    merged = (every.groupBy("depth", "h1", "h2").agg(
        *(F.max(F.when(~joint, F.col(c))).alias(c) for c in inner), F.sum("children").alias("children"))
        .withColumn("s", F.floor(F.greatest(F.col("depth") - 1, F.lit(0)) / segment).cast("int")))
    merged = stored(merged)

    owned = (merged.filter(F.col("s") > 0).groupBy(F.col("least").alias("id"), "s").agg(
        F.sum(F.when(F.col("children") == 0, 1).otherwise(0)).alias("own_leaves"),
        F.sum((F.col("n") - 1) * F.col("size")).alias("own_saved")))
    later = Window.partitionBy("id").orderBy(F.desc("s")).rowsBetween(Window.unboundedPreceding, -1)
    long = paths.filter(F.col("more") | (F.col("s") > 0))
    after = (long.join(owned, ["id", "s"], "left").withColumns(
        {c: F.coalesce(F.sum(f"own_{c}").over(later), F.lit(0)) for c in ("leaves", "saved")})
        .filter(F.col("more") & ((F.col("leaves") > 0) | (F.col("saved") > 0))))
    added = (after.select("s", "p1", "p2", "key", "leaves", "saved").mapInArrow(
        _below(segment), "depth long, h1 long, h2 long, more_leaves long, more_saved long")
        .groupBy("depth", "h1", "h2").agg(F.sum("more_leaves").alias("more_leaves"), F.sum("more_saved").alias("more_saved")))
    whole = merged.join(added, ["depth", "h1", "h2"], "left")
    plus = lambda c: (F.col(c) + F.coalesce(f"more_{c}", F.lit(0))).cast("long")
    child = whole.select("depth", (F.col("depth") - 1).alias("up"), "h1", "u1", "u2", F.col("least").alias("conv_id"),
                         F.col("n").alias("n_convs"), F.col("children").alias("n_children"),
                         plus("leaves").alias("n_leaves"), plus("saved").alias("saved_tokens"), F.col("ends").alias("ends_sha256"))
    parent = (merged.filter(F.col("children") > 0)
              .select(F.col("depth").alias("up"), F.col("h1").alias("u1"), F.col("h2").alias("u2"), "children",
                      F.col("least").alias("parent_conv_id")))
    # fewer than MANY nodes have more than one in MANY of all nodes as children; the
    # children of the others meet their parents by a shuffle without hot keys
    many = F.broadcast(parent.filter(F.col("children") * MANY > merged.count())
                       .select("up", "u1", "u2", F.col("parent_conv_id").alias("known")))
    child = child.join(many, ["up", "u1", "u2"], "left").withColumn(
        "u1", F.when(F.col("known").isNull(), F.col("u1")).otherwise(F.col("h1")))
    return (child.join(parent.drop("children"), ["up", "u1", "u2"], "left")
            .select("conv_id", "depth", F.coalesce("known", "parent_conv_id").alias("parent_conv_id"), "n_convs",
                    F.col("n_children").cast("long").alias("n_children"), "n_leaves", "saved_tokens", "ends_sha256"))
