"""Nearest neighbours by inner product: a hierarchical k-means tree, searched
best bin first.

* Equal vectors are one row with their smallest ids (``k + 1``, so that a query may leave out its
  own), whatever their number.
* The tree is fitted on a bounded sample: the ``SAMPLE`` distinct vectors that come first by hash.
  A node with more than ``LEAF`` sampled vectors is split by k-means into up to ``BRANCH``
  children.  Every vector is then placed in a leaf, each time by the nearest centre.
* A query takes nodes from a priority queue, the largest inner product with the
  node's centre first; an inner node gives way to its children, a leaf is visited.
* How many leaves are visited is calibrated: for ``CALIBRATION`` queries, again
  the first by hash, the true nearest among all vectors are found by brute force, and the
  visits are widened until ``TARGET`` of them lie in visited leaves.
* The queries meet the vectors of their leaves by a shuffle, in blocks of bounded size on both sides:
  a crowded leaf, or one that many queries visit, is many blocks.

What reaches the driver is the sample, a row a leaf, and the calibration's
neighbours; the tree, at most ``2 * SAMPLE`` centres, goes to every task.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from valora.llm.session import stored

#: Distinct vectors the tree is fitted on; sampled vectors of a leaf at most; children of a node at most.
SAMPLE, LEAF, BRANCH = 16_384, 64, 16
#: Queries the visits are calibrated on, and the share of true neighbours they must reach.
CALIBRATION, TARGET = 256, 0.95
#: Vectors, and queries, of a block.
VECTORS, QUERIES = 8192, 2048
ROUNDS = 12
#: A vector of more than one in so many of all queries is a hot key.
MANY = 1000


class Tree:
    """Centres of all nodes, and each node's children (none: a leaf)."""

    def __init__(self, sample: np.ndarray, leaf: int = LEAF, branch: int = BRANCH, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.centres, self.children = [sample.mean(axis=0) if len(sample) else np.zeros(sample.shape[1])], [[]]
        todo = [(0, sample)]
        while todo:
            node, rows = todo.pop()
            if len(rows) <= leaf:
                continue
            parts = _k_means(rows, min(branch, math.ceil(len(rows) / leaf) + 1), rng)
            if len(parts) < 2:
                continue
            for part in parts:
                self.children[node].append(len(self.centres))
                todo.append((len(self.centres), part))
                self.centres.append(part.mean(axis=0))
                self.children.append([])
        self.centres = np.asarray(self.centres)
        self.leaves = sum(not c for c in self.children)

    def place(self, vectors: np.ndarray) -> np.ndarray:
        """The leaf of each vector."""
        at = np.zeros(len(vectors), np.int32)
        todo = [(0, np.arange(len(vectors)))]
        while todo:
            node, rows = todo.pop()
            kids = self.children[node]
            if not kids or not len(rows):
                at[rows] = node
                continue
            centres = self.centres[kids]
            nearest = np.argmin((centres ** 2).sum(1) - 2 * vectors[rows] @ centres.T, axis=1)
            todo += [(kid, rows[nearest == k]) for k, kid in enumerate(kids)]
        return at

    def visits(self, query: np.ndarray, most: int) -> list[int]:
        """The first ``most`` leaves, best bin first."""
        score = self.centres @ query
        queue, out = [(-score[0], 0)], []
        while queue and len(out) < most:
            _, node = heapq.heappop(queue)
            if self.children[node]:
                for kid in self.children[node]:
                    heapq.heappush(queue, (-score[kid], kid))
            else:
                out.append(node)
        return out


def _k_means(rows: np.ndarray, k: int, rng) -> list[np.ndarray]:
    centres = rows[rng.choice(len(rows), k, replace=False)]
    of = None
    for _ in range(ROUNDS):
        new = np.argmin((centres ** 2).sum(1) - 2 * rows @ centres.T, axis=1)
        if of is not None and (new == of).all():
            break
        of = new
        centres = np.array([rows[of == c].mean(axis=0) if (of == c).any() else centres[c] for c in range(len(centres))])
    return [rows[of == c] for c in range(k) if (of == c).any()]


def _matrix(column: pa.Array, size: int) -> np.ndarray:
    """Rows of a list column in double precision; shorter ones end in zeros."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    lengths = column.value_lengths().to_numpy(zero_copy_only=False)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    if (lengths == size).all():
        return flat.reshape(len(lengths), size)
    out = np.zeros((len(lengths), size))
    for k, end in enumerate(np.cumsum(lengths)):
        out[k, :lengths[k]] = flat[end - lengths[k]:end]
    return out


def _best(queries: np.ndarray, vectors: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, vector, inner product) of each query's ``k`` best vectors and all that tie with the last.
    Products are chosen by one matrix product and computed again one by one, so
    they don't depend on the blocks."""
    rough = queries @ vectors.T
    if vectors.shape[0] > k:
        last = np.partition(rough, vectors.shape[0] - k, axis=1)[:, vectors.shape[0] - k]
        norms = np.sqrt((queries ** 2).sum(1)) * np.sqrt((vectors ** 2).sum(1).max())
        q, v = np.nonzero(rough >= (last - 1e-12 * norms)[:, None])
    else:
        q, v = (x.ravel() for x in np.indices(rough.shape))
    return q, v, np.concatenate([(queries[q[a:a + 65536]] * vectors[v[a:a + 65536]]).sum(1) for a in range(0, len(q), 65536)]
                                or [np.zeros(0)])


def _placed(tree: Tree, size: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leaf = tree.place(_matrix(batch.column("vector"), size))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(leaf, pa.int32())], [*batch.schema.names, "leaf"])
    return run


def _visiting(tree: Tree, size: int, most: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leaves = [tree.visits(q, most) for q in _matrix(batch.column("vector"), size)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(leaves, pa.list_(pa.int32()))],
                                             [*batch.schema.names, "leaves"])
    return run


def _truth(queries: np.ndarray, size: int, k: int) -> Callable:
    """Each calibration query's best vectors of a partition, with their leaves."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = (np.zeros(0, np.int64), np.zeros(0, np.int32), np.zeros(0))
        for batch in batches:
            q, v, score = _best(queries, _matrix(batch.column(0), size), k)
            leaf = batch.column(1).to_numpy()[v]
            held = tuple(np.concatenate(x) for x in zip(held, (q, leaf, score)))
            order = np.lexsort((-held[2], held[0]))
            rank = np.arange(len(order)) - np.searchsorted(held[0][order], held[0][order])
            held = tuple(x[order[rank < k]] for x in held)
        yield pa.RecordBatch.from_arrays([pa.array(held[0], pa.int32()), pa.array(held[1], pa.int32()), pa.array(held[2])],
                                         ["query", "leaf", "score"])
    return run


def calibrated_visits(tree: Tree, queries: np.ndarray, truth: list[tuple[int, int]], target: float) -> int:
    """The fewest leaves whose visit finds ``target`` of the true neighbours,
    given as (query, leaf)."""
    if not truth:
        return 1
    rank = []
    for k in range(len(queries)):
        place = {leaf: i for i, leaf in enumerate(tree.visits(queries[k], tree.leaves))}
        rank += [place[leaf] for q, leaf in truth if q == k]
    return int(np.sort(rank)[math.ceil(target * len(rank)) - 1]) + 1


def _searched(size: int, k: int) -> Callable:
    """A block: rows without ``leaves`` are vectors, the others queries, which
    come first.  Holds a block's queries, and one batch of vectors."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, keys, rows, queries, best = None, [], [], None, None

        def done():
            if best is None or not len(best[0]):
                return []
            q, at, score = best
            return [pa.RecordBatch.from_arrays(
                [pa.array([keys[i][0] for i in q], pa.int64()), pa.array([keys[i][1] for i in q], pa.int64()),
                 pa.array(score), pa.array(list(at), pa.list_(pa.int64()))], ["h1", "h2", "score", "ids"])]

        for batch in batches:
            group = np.rec.fromarrays([batch.column(c).to_numpy() for c in range(3)])
            cuts = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
            for a, b in zip(cuts, np.append(cuts[1:], len(group))):
                part, name = batch.slice(a, b - a), tuple(group[a])
                if name != block:
                    yield from done()
                    block, keys, rows, queries, best = name, [], [], None, None
                asks = part.column(3).to_numpy(zero_copy_only=False).astype(bool)
                if asks.any():
                    some = part.filter(pa.array(asks))
                    keys += zip(some.column(4).to_pylist(), some.column(5).to_pylist())
                    rows.append(_matrix(some.column(6), size))
                    queries = None
                if keys and not asks.all():
                    if queries is None:
                        queries = np.concatenate(rows)
                    them = part.filter(pa.array(~asks))
                    q, v, score = _best(queries, _matrix(them.column(6), size), k)
                    ids = them.column(7).to_pylist()
                    best = _kept(best, q, [ids[x] for x in v], score, k)
        yield from done()
    return run


def _kept(best, q: np.ndarray, ids: list, score: np.ndarray, k: int):
    """The ``k`` best of each query; ties to the smallest id."""
    new = np.empty(len(ids), object)
    new[:] = ids
    if best is not None:
        q, new, score = np.concatenate([best[0], q]), np.concatenate([best[1], new]), np.concatenate([best[2], score])
    least = np.array([x[0] for x in new], np.int64) if len(new) else np.zeros(0, np.int64)
    order = np.lexsort((least, -score, q))
    rank = np.arange(len(order)) - np.searchsorted(q[order], q[order])
    keep = order[rank < k]
    return q[keep], new[keep], score[keep]


def _vectors(df: DataFrame, id_col: str, vector_col: str) -> tuple[DataFrame, str]:
    """``(h1, h2, id, vector)`` of the rows that take part, and the type of a vector."""
    kind = df.select(F.col(f"`{vector_col}`").alias("v")).dtypes[0][1]
    kind = kind if kind in ("array<float>", "array<double>") else "array<double>"
    v = F.col(f"`{vector_col}`").cast(kind)
    finite = F.forall(v, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    fine = finite & F.exists(v, lambda x: F.coalesce(x != 0, F.lit(False)))
    return (df.filter(F.coalesce(fine, F.lit(False)) & F.col(f"`{id_col}`").isNotNull())
            .select(F.xxhash64(v).alias("h1"), F.xxhash64(F.lit(1), v).alias("h2"),
                    F.col(f"`{id_col}`").cast("long").alias("id"), v.alias("vector")), kind)


def distinct_vectors(rows: DataFrame, k: int) -> DataFrame:
    """``(h1, h2, vector, ids)``: distinct vectors with their ``k`` smallest ids.
    The ids are cut down in two steps, the first by parts of a vector's rows, so a
    vector that very many rows share is no hot key."""
    for key in (["h1", "h2", F.pmod(F.xxhash64("id"), F.lit(16))], ["h1", "h2"]):
        rank = F.row_number().over(Window.partitionBy(*key).orderBy("id"))
        rows = rows.dropDuplicates(["h1", "h2", "id"]).withColumn("rank", rank).filter(F.col("rank") <= k).drop("rank")
    return rows.groupBy("h1", "h2").agg(F.first("vector").alias("vector"), F.sort_array(F.collect_list("id")).alias("ids"))


def _blocks(placed: DataFrame, visiting: DataFrame) -> DataFrame:
    """Vectors and queries of each leaf, dealt to the pairs of their blocks."""
    stay = placed.groupBy("leaf").agg(F.ceil(F.count("*") / VECTORS).cast("int").alias("nv"))
    come = visiting.select(F.explode("leaves").alias("leaf")).groupBy("leaf").agg(
        F.ceil(F.count("*") / QUERIES).cast("int").alias("nq"))
    counts = F.broadcast(stay.join(come, "leaf"))  # a row a leaf: at most SAMPLE
    h = F.xxhash64("h1", "h2")
    to = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    mine = placed.join(counts, "leaf").select(
        "leaf", F.pmod(h, "nv").cast("int").alias("v"), to("nq").alias("q"), F.lit(False).alias("asks"), "h1", "h2", "vector", "ids")
    theirs = (visiting.withColumn("leaf", F.explode("leaves")).join(counts, "leaf").select(
        "leaf", to("nv").alias("v"), F.pmod(h, "nq").cast("int").alias("q"), F.lit(True).alias("asks"), "h1", "h2", "vector",
        F.lit(None).cast("array<long>").alias("ids")))
    return (mine.unionByName(theirs).repartition("leaf", "v", "q")
            .sortWithinPartitions("leaf", "v", "q", F.desc("asks")))


def _found(blocks: DataFrame, size: int, k: int) -> DataFrame:
    """``(h1, h2, found)``: each distinct query's ``k`` best ``(less, id)``, best first."""
    best = blocks.mapInArrow(_searched(size, k), "h1 long, h2 long, score double, ids array<long>")
    rank = F.row_number().over(Window.partitionBy("h1", "h2").orderBy(F.desc("score"), F.col("ids")[0]))
    best = best.withColumn("rank", rank).filter(F.col("rank") <= k)
    each = F.transform("ids", lambda i: F.struct((-F.col("score")).alias("less"), i.alias("id")))
    return best.groupBy("h1", "h2").agg(
        F.slice(F.sort_array(F.flatten(F.collect_list(each))), 1, k).alias("found"))


def nearest(df: DataFrame, is_query, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 20,
            target: float = TARGET) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: for each row of ``df`` where ``is_query``
    (a column) holds, the ``k`` rows with the largest inner product among those its search
    visits, nearest first, ties to the smaller id.

    Vectors that are null, zero or hold null or non-finite components, and null ids, take no part;
    shorter vectors count as ending in zeros; rows with the query's own id are left out; a
    repeated row counts once; fewer than ``k`` other rows give them all."""
    rows, kind = _vectors(df, id_col, vector_col)
    groups = stored(distinct_vectors(rows, k + 1))
    asked = stored(_vectors(df.filter(is_query), id_col, vector_col)[0].withColumnRenamed("id", "query_id"))
    queries = asked.groupBy("h1", "h2").agg(F.countDistinct("query_id").alias("times"), F.first("vector").alias("vector"))

    size = groups.agg(F.max(F.size("vector"))).first()[0] or 1
    first = [F.xxhash64("h1", "h2"), "h1", "h2"]
    tree = Tree(_matrix(groups.orderBy(*first).limit(SAMPLE).select("vector").toArrow().column(0), size))
    placed = stored(groups.mapInArrow(_placed(tree, size), f"h1 long, h2 long, vector {kind}, ids array<long>, leaf int"))

    some = _matrix(queries.orderBy(*first).limit(CALIBRATION).select("vector").toArrow().column(0), size)
    truth = placed.select("vector", "leaf").mapInArrow(_truth(some, size, k), "query int, leaf int, score double")
    rank = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "leaf"))
    truth = truth.withColumn("rank", rank).filter(F.col("rank") <= k).select("query", "leaf").collect()
    most = calibrated_visits(tree, some, [tuple(r) for r in truth], target)

    visiting = stored(queries.mapInArrow(_visiting(tree, size, most),
                                         f"h1 long, h2 long, times long, vector {kind}, leaves array<int>"))
    found = stored(_found(_blocks(placed, visiting), size, k + 1))
    # fewer than MANY vectors have more than one in MANY of the queries; the others are no hot keys
    ids = asked.select("h1", "h2", "query_id").distinct()
    hot = visiting.filter(F.col("times") * MANY > asked.count()).select("h1", "h2")
    known = F.broadcast(found.join(F.broadcast(hot), ["h1", "h2"]).withColumnRenamed("found", "known"))
    ids = ids.join(known, ["h1", "h2"], "left").withColumn(
        "h1", F.when(F.col("known").isNull(), F.col("h1")).otherwise(F.xxhash64("query_id")))
    ids = ids.join(found, ["h1", "h2"], "left").withColumn("found", F.coalesce("known", "found"))
    others = F.slice(F.filter("found", lambda x: x["id"] != F.col("query_id")), 1, k)
    return (ids.select("query_id", F.posexplode(others).alias("at", "x"))
            .select("query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("x.id").alias("vec_id"),
                    (-F.col("x.less")).alias("score")))
