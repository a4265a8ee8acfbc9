"""Classes of documents whose 5-word shingle sets have a Jaccard similarity of
0.8 or more, by vertical partitioning.

The global order of the shingles (their 64-bit hashes) is cut into fragments;
overlaps are counted fragment by fragment and summed per pair.

1. Documents with the same shingle set become one node (128-bit set hash).
2. *First fragments.*  In ``PROBE`` of the ``FRAGMENTS`` fragments, count each
   node's shingles that another node has too.  Of a set of n shingles at most
   ``0.2 n`` may be missing from a partner; a node with more unshared shingles
   in these fragments alone has no partner, and leaves.
3. Of the nodes left, all shared shingles are ordered by document frequency,
   rarest first.  A partner must share one of the first ``0.2 n + 1``
   (unshared ones count as first).
4. *Pairs without all pairs.*  In the group of each such shingle every node is
   paired with one hub, the node with the smallest unshared share.  Overlaps
   per fragment are summed per pair; links give components.  In a group of
   near copies that settles nearly everything.  Then, among the nodes of one hub
   that are still in different components, those outside the hub's main
   component are paired with the members of other components, if the overlaps
   with the hub, fragment by fragment, leave room for a link, and counted in
   the same way.  Pairs inside one component are never made.
5. Components of both kinds of links.

The shingle groups are resolved within each Arrow batch first, so a shingle of
a third of all documents gives a few rows a task.  Links follow from hashes of
64 bits a shingle within a pair of documents.

Defined cases: a document without words (or with a null text) has an empty
set and no links; one with fewer than five words has its whole word sequence
as only shingle; rows with a null id are linked with nothing and have a null
class; rows that share an id are one document, of which the row with the
smallest set hash decides.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from valora.llm import words as W
from valora.llm.graph import components
from valora.llm.session import stored

FRAGMENTS, PROBE = 32, 12
FRAGMENT_BITS = 5
BATCH_BYTES = 8 << 20


def _set_hashes(values: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    sums = []
    for salt in (0x243F6A8885A308D3, 0x13198A2E03707344):
        total = np.zeros(len(values) + 1, W.U)
        np.cumsum(W.mix(values ^ W.U(salt)), out=total[1:])
        sums.append((total[bounds[1:]] - total[bounds[:-1]]).view(np.int64))
    return sums[0], sums[1]


def _shingles(data: np.ndarray, offs: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    hashes, bounds = W.word_hashes(data, offs, lower=True)
    return W.shingle_sets(hashes, bounds, n)


def _signatures(n: int):
    @F.arrow_udf("n long, s1 long, s2 long")
    def sign(texts: pa.Array) -> pa.Array:
        out = []
        for _, _, data, offs in W.slices(texts):
            values, bounds = _shingles(data, offs, n)
            s1, s2 = _set_hashes(values, bounds)
            out.append(pa.StructArray.from_arrays([pa.array(np.diff(bounds)), pa.array(s1), pa.array(s2)],
                                                  ["n", "s1", "s2"]))
        kind = pa.struct([("n", pa.int64()), ("s1", pa.int64()), ("s2", pa.int64())])
        return pa.concat_arrays(out) if out else pa.array([], kind)
    return sign


def _chosen(batch: pa.RecordBatch, n: int):
    """Slices of a batch (node, s1, text): node of each shingle, the shingle,
    and per row node and set size; rows whose set is not the node's are left
    out."""
    nodes, s1 = (batch.column(k).to_numpy() for k in (0, 1))
    for a, b, data, offs in W.slices(batch.column(2), BATCH_BYTES):
        values, bounds = _shingles(data, offs, n)
        right = _set_hashes(values, bounds)[0] == s1[a:b]
        row = W.row_of(bounds)
        yield row, values, nodes[a:b], np.diff(bounds), right


def _probe(n: int, miss: float):
    """Rows (key, node, found, need): shingles of the first fragments that need
    a partner elsewhere, and one row a node (negative key) with what the batch
    itself has found and how many must be found."""
    limit = W.U((1 << 64) * PROBE // FRAGMENTS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, values, nodes, size, right in _chosen(batch, n):
                mine = right[row] & (values < limit)
                row, key = row[mine], (values[mine] >> W.U(16)).astype(np.int64)
                order = np.lexsort((nodes[row], key))
                k, i = key[order], nodes[row][order]
                new = np.append(True, k[1:] != k[:-1])[: len(k)]
                start = np.flatnonzero(new)
                end = np.append(start[1:], len(k))[: len(start)]
                several = i[start] != i[end - 1]
                shared = np.zeros(len(k), bool)
                shared[order] = several[np.cumsum(new) - 1]
                low, high = start[several], end[several] - 1
                who = np.flatnonzero(right)
                found = np.bincount(row[shared], minlength=len(nodes))[who]
                need = np.bincount(row, minlength=len(nodes))[who] - np.floor(miss * size[who] + 1e-9).astype(np.int64)
                one = np.concatenate([row[~shared]])
                extra = np.zeros(2 * len(low), np.int64)
                keys = np.concatenate([key[~shared], k[low], k[high], -(W.mix(nodes[who].astype(W.U)) >> W.U(1)).astype(np.int64) - 1])
                yield pa.RecordBatch.from_arrays([
                    pa.array(keys), pa.array(np.concatenate([nodes[one], i[low], i[high], nodes[who]])),
                    pa.array(np.concatenate([np.ones(len(one), np.int64), extra, found]), pa.int32()),
                    pa.array(np.concatenate([np.zeros(len(one) + len(extra), np.int64), need]), pa.int32())],
                    ["key", "node", "found", "need"])
    return run


def _tokens(n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, values, nodes, _, right in _chosen(batch, n):
                mine = right[row]
                yield pa.RecordBatch.from_arrays([pa.array(values[mine].view(np.int64)), pa.array(nodes[row[mine]])],
                                                 ["key", "node"])
    return run


def _sum(column: Column) -> Column:
    return F.aggregate(column, F.lit(0).cast("long"), lambda a, x: a + x)


def _fits(percent: int) -> Column:
    """Whether two nodes with the same hub can overlap enough.  Overlap is at
    most what both have in common with the hub, and what of the rest either
    shares with anything; first by totals, then fragment by fragment."""
    n = F.col("n") + F.col("x_n")
    total = F.least("o", "x_o") + F.least(F.col("s") - F.col("o"), F.col("x_s") - F.col("x_o"))
    rest = lambda p: F.zip_with(f"{p}sf", f"{p}of", lambda s, o: s - o)
    least = lambda x, y: F.zip_with(x, y, lambda a, b: F.least(a, b))
    parts = _sum(least("of", "x_of")) + _sum(least(rest(""), rest("x_")))
    return (100 * total >= percent * (n - total)) & (100 * parts >= percent * (n - parts))


def _by_fragment(entries: Column) -> Column:
    """A map of counts by fragment as an array."""
    return F.transform(F.sequence(F.lit(0), F.lit(FRAGMENTS - 1)),
                       lambda f: F.coalesce(F.element_at(entries, f), F.lit(0)))


def _fragment(key: str) -> Column:
    return F.shiftrightunsigned(key, 64 - FRAGMENT_BITS).cast("int")


def _overlaps(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """``pairs`` (a, b) with their set sizes (na, nb) and ``overlap``, counted
    per fragment (``of``) and summed."""
    parts = sets.select("node", "n", F.explode("keys").alias("key")).groupBy(
        "node", "n", _fragment("key").alias("fragment")).agg(F.collect_list("key").alias("part"))
    left = parts.select(F.col("node").alias("a"), F.col("n").alias("na"), "fragment", F.col("part").alias("pa"))
    right = parts.select(F.col("node").alias("b"), F.col("n").alias("nb"), "fragment", F.col("part").alias("pb"))
    return (pairs.join(left, "a").join(right, ["b", "fragment"])
            .select("a", "b", "na", "nb", "fragment", F.size(F.array_intersect("pa", "pb")).alias("partial"))
            .groupBy("a", "b", "na", "nb").agg(
                F.sum("partial").alias("overlap"),
                _by_fragment(F.map_from_entries(F.collect_list(F.struct("fragment", "partial")))).alias("of")))


def _linked(overlaps: DataFrame, percent: int) -> DataFrame:
    union = F.col("na") + F.col("nb") - F.col("overlap")
    return overlaps.filter(100 * F.col("overlap") >= percent * union).select("a", "b")


def near_classes(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = 5,
                 percent: int = 80) -> DataFrame:
    """One row per row of ``df``: its id, ``n_shingles`` and ``component_id``,
    the smallest id in its class."""
    miss = 1 - percent / 100
    texts = df.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    signed = stored(texts.withColumn("sign", _signatures(n)("text")).select("id", "sign.*"))
    known = signed.filter(F.col("id").isNotNull())
    decided = known.groupBy("id").agg(F.min(F.struct("s1", "s2", "n")).alias("sign")).select("id", "sign.*")
    nodes = (decided.filter(F.col("n") > 0).groupBy("s1", "s2", "n").agg(F.min("id").alias("node")))

    base = (texts.filter(F.col("id").isNotNull()).join(nodes.select(F.col("node").alias("id"), "s1"), "id")
            .select("id", "s1", "text"))
    same = Window.partitionBy("key")
    probe = (base.sortWithinPartitions("id", "s1")
             .mapInArrow(_probe(n, miss), "key long, node long, found int, need int")
             .withColumns({"least": F.min("node").over(same), "most": F.max("node").over(same)}))
    shared = (F.col("key") < 0) | (F.col("least") < F.col("most"))
    left = (probe.filter(shared).groupBy("node").agg(F.sum("found").alias("found"), F.sum("need").alias("need"))
            .filter(F.col("found") >= F.col("need")).select(F.col("node").alias("id")))
    tokens = base.join(left, "id").select("id", "s1", "text").mapInArrow(_tokens(n), "key long, node long")
    often = (tokens.groupBy("key").agg(F.count("*").alias("df"), F.min("node").alias("low"), F.max("node").alias("high"))
             .filter(F.col("low") < F.col("high")).select("key", "df"))
    sets = (tokens.join(often, "key").groupBy("node").agg(F.array_sort(F.collect_set(F.struct("df", "key"))).alias("t"))
            .join(nodes.select("node", "n"), "node")
            .select("node", "n", F.col("t.key").alias("keys"), (F.col("n") - F.size("t")).alias("alone"),
                    F.floor(F.col("n") * miss + 1e-9).alias("spare"))
            .filter(F.col("alone") <= F.col("spare")))
    sets = stored(sets)

    first = sets.select("node", (F.col("alone") / F.col("n")).alias("far"),
                        F.explode(F.slice("keys", 1, (F.col("spare") + 1 - F.col("alone")).cast("int"))).alias("key"))
    hubs = first.groupBy("key").agg(F.min(F.struct("far", "node")).getField("node").alias("hub"),
                                    F.count("*").alias("c")).filter(F.col("c") > 1).select("key", "hub")
    near = first.join(hubs, "key").filter(F.col("node") != F.col("hub"))
    known_pairs = stored(_overlaps(near.select(F.col("node").alias("a"), F.col("hub").alias("b")).distinct(), sets))
    links = _linked(known_pairs, percent)
    groups = components(links, "a", "b")

    # what is left: of nodes that share a shingle of the first ones, and so a
    # hub, those in different components
    shape = ("n", "s", "o", "sf", "of")
    sizes = (sets.select("node", F.explode("keys").alias("key")).groupBy("node", _fragment("key").alias("f"))
             .agg(F.count("*").cast("int").alias("c")).groupBy("node")
             .agg(_by_fragment(F.map_from_entries(F.collect_list(F.struct("f", "c")))).alias("sf"), F.sum("c").alias("s")))
    placed = (known_pairs.select(F.col("a").alias("node"), F.col("b").alias("hub"), F.col("na").alias("n"),
                                 F.col("overlap").alias("o"), "of")
              .join(groups, "node", "left").withColumn("group", F.coalesce("component", "node")))
    main = (placed.groupBy("hub", "group").agg(F.count("*").alias("c")).groupBy("hub")
            .agg(F.max(F.struct("c", "group")).getField("group").alias("main"), F.count("*").alias("groups"))
            .filter(F.col("groups") > 1).select("hub", "main"))
    spread = placed.join(main, "hub").join(sizes, "node").select("hub", "main", "node", "group", *shape)
    other = spread.filter(F.col("group") != F.col("main")).select(
        F.col("hub").alias("x_hub"), *(F.col(c).alias(f"x_{c}") for c in ("node", "group", *shape)))
    more = (spread.join(other, (F.col("hub") == F.col("x_hub")) & (F.col("group") != F.col("x_group"))
                        & ((F.col("group") == F.col("main")) | (F.col("x_node") < F.col("node"))) & _fits(percent))
            .select(F.least("node", "x_node").alias("a"), F.greatest("node", "x_node").alias("b")).distinct())
    links = links.unionByName(_linked(_overlaps(more, sets), percent))
    groups = components(links, "a", "b").withColumnRenamed("component", "class")

    named = (decided.join(nodes.select("s1", "s2", "n", "node"), ["s1", "s2", "n"], "left")
             .join(groups, "node", "left")
             .select("id", F.col("n").alias("n_shingles"), F.coalesce("class", "node", "id").alias("component_id")))
    rows = signed.filter(F.col("id").isNotNull()).select("id").join(named, "id")
    rows = rows.unionByName(signed.filter(F.col("id").isNull()).select(
        "id", F.col("n").alias("n_shingles"), F.lit(None).cast("long").alias("component_id")))
    return rows.withColumnRenamed("id", id_col)


def keep_one(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Of each class the row with the smallest id (of rows that share this id,
    the one with the smallest hash of all columns); rows with a null id stay.
    Columns of ``df`` may have any names."""
    key, number, kept_id = "__class_id", "__n", "__kept_id"
    while {key, number, kept_id} & set(df.columns):
        key, number, kept_id = key + "_", number + "_", kept_id + "_"
    slim = df.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    keep = (near_classes(slim).filter(F.col("doc_id") == F.col("component_id"))
            .select(F.col("doc_id").alias(kept_id)).distinct())
    keyed = df.withColumn(key, F.col(f"`{id_col}`").cast("long"))
    order = Window.partitionBy(key).orderBy(F.xxhash64(*(F.col(f"`{c}`") for c in df.columns)))
    kept = (keyed.filter(F.col(key).isNotNull()).join(keep, F.col(key) == F.col(kept_id), "left_semi")
            .withColumn(number, F.row_number().over(order)).filter(F.col(number) == 1).drop(number))
    return kept.unionByName(keyed.filter(F.col(key).isNull())).drop(key)
