"""Resharding at least cost.

From the sizes of the old shards and the capacities of the new ones a
minimum-cost flow (bytes that stay cost nothing, bytes that move cost one
each, or what ``cost`` says) gives how many bytes go from each old shard to
each new one.  The network has one node a shard, so it is solved on the driver
whatever the size of the data; the transfers are then carried out as blocks:
the rows of an old shard, in a fixed order, are cut at the flow's byte
positions, and the files of the shards that a transfer changes are written anew
(``reshard_files``).  Byte positions and slots come from sums per (shard, range of
hashes) and a window within one range, so no shard is ordered in one task.
Rows above 1/64 of a shard come first in the order, so that cuts fall
between small rows and new shards end within about that of their capacity.

Defined cases: a null text has no bytes; a null old shard is old shard 0; equal
rows are told apart by nothing, so either may take either place; an empty table
gives an empty result; columns of ``df`` with the names of results are
replaced.  A layout is rewritten in place, shard by shard at the end of the
write: a reader has to wait for it.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from valora.llm.session import stored
from valora.session import checkpoint_dir

RANGE_BITS = 10
RESULTS = ("size", "old_shard", "shard", "slot")
NO_SHARD = "shard=__HIVE_DEFAULT_PARTITION__"


def min_cost_flow(supply: list[int], capacity: list[int], cost: Callable[[int, int], int]) -> list[list[int]]:
    """Flows from suppliers to receivers that move all supply at least cost:
    cheapest augmenting paths over the residual network, found by relaxing
    until nothing changes."""
    m, k = len(supply), len(capacity)
    if sum(supply) > sum(capacity):
        raise ValueError("the capacities are too small")
    flow = [[0] * k for _ in range(m)]
    left, room = list(supply), list(capacity)
    price = [[cost(i, j) for j in range(k)] for i in range(m)]
    while any(left):
        far_i = [0 if left[i] else None for i in range(m)]
        far_j: list[int | None] = [None] * k
        back_i, back_j = [None] * m, [None] * k
        changed = True
        while changed:
            changed = False
            for i in range(m):
                if far_i[i] is None:
                    continue
                for j in range(k):
                    d = far_i[i] + price[i][j]
                    if far_j[j] is None or d < far_j[j]:
                        far_j[j], back_j[j], changed = d, i, True
            for j in range(k):
                if far_j[j] is None:
                    continue
                for i in range(m):
                    if flow[i][j]:
                        d = far_j[j] - price[i][j]
                        if far_i[i] is None or d < far_i[i]:
                            far_i[i], back_i[i], changed = d, j, True
        j = min((j for j in range(k) if room[j]), key=lambda j: far_j[j])
        path, end = [], j
        while True:
            i = back_j[j]
            path.append((i, j, 1))
            if back_i[i] is None:
                break
            j = back_i[i]
            path.append((i, j, -1))
        amount = min([left[i], room[end], *(flow[a][b] for a, b, way in path if way < 0)])
        for a, b, way in path:
            flow[a][b] += way * amount
        left[i] -= amount
        room[end] -= amount
    return flow


def near_equal(total: int, shards: int) -> list[int]:
    return [total // shards + (k < total % shards) for k in range(shards)]


def _measured(df: DataFrame, old: Column, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    return (df.withColumns({"__old": F.coalesce(old.cast("int"), F.lit(0)), "__size": F.octet_length(text).cast("long") + 8,
                            "__h": F.xxhash64(F.col(f"`{id_col}`"), text)})
            .drop(*RESULTS).withColumnsRenamed({"__old": "old_shard", "__size": "size"}))


def _hash_range() -> Column:
    return F.shiftrightunsigned("__h", 64 - RANGE_BITS)


def _numbered(placed: DataFrame) -> DataFrame:
    """``placed`` with ``slot``, by (old shard, range, hash) within each shard."""
    group = ["shard", "old_shard", "__range"]
    running = Window.partitionBy("shard").orderBy("old_shard", "__range").rowsBetween(Window.unboundedPreceding, -1)
    ahead = (placed.groupBy(*group).agg(F.count("*").alias("n"))
             .withColumn("__ahead", F.coalesce(F.sum("n").over(running), F.lit(0))).drop("n"))
    number = F.row_number().over(Window.partitionBy(*group).orderBy("__h"))
    # a row a range and shard, however many documents
    return (placed.join(F.broadcast(ahead), group).withColumn("slot", (F.col("__ahead") + number - 1).cast("long"))
            .drop("__h", "__range", "__ahead"))


def reshard(df: DataFrame, old: Column, shards: int, capacities: list[int] | None = None,
            cost: Callable[[int, int], int] | None = None, id_col: str = "doc_id",
            text_col: str = "text") -> DataFrame:
    """``df`` with ``size`` (bytes of the text plus 8), ``old_shard``, ``shard``
    and ``slot`` (gapless within its shard, from 0)."""
    rows = _measured(df, old, id_col, text_col)
    sums = rows.groupBy("old_shard").agg(F.sum("size").alias("s")).collect()  # one row a shard
    sizes = {r["old_shard"]: r["s"] for r in sums}
    total = sum(sizes.values())
    capacities = capacities or near_equal(total, shards)
    olds = sorted(sizes)
    price = cost or (lambda i, j: int(i != j))
    flows = min_cost_flow([sizes[i] for i in olds], capacities, lambda a, j: price(olds[a], j))
    cuts = []
    for i, line in zip(olds, flows, strict=True):
        order = sorted((j for j in range(shards) if line[j]), key=lambda j: (j != i, j))
        ends, at = [], 0
        for j in order:
            at += line[j]
            ends.append(at)
        cuts.append((i, ends, order))
    spark = df.sparkSession
    blocks = spark.createDataFrame(cuts, "old_shard int, __ends array<long>, __to array<int>")

    big = max(1, total // shards // 64)
    rows = rows.withColumn("__range", F.when(F.col("size") > big, F.lit(-1).cast("long")).otherwise(
        _hash_range()))
    # the large rows are few (64 a shard at most) and come in one range
    running = Window.partitionBy("old_shard").orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    before = (rows.groupBy("old_shard", "__range").agg(F.sum("size").alias("s"))
              .withColumn("__before", F.coalesce(F.sum("s").over(running), F.lit(0))).drop("s"))
    within = Window.partitionBy("old_shard", "__range").orderBy("__h").rowsBetween(Window.unboundedPreceding, 0)
    # texts move once; a task has neighbouring ranges, so rows of few new shards
    placed = (rows.repartitionByRange("old_shard", "__range")
              .join(F.broadcast(before), ["old_shard", "__range"])  # a row a range and shard
              .withColumn("__mid", F.col("__before") + F.sum("size").over(within) - F.col("size") / 2)
              .join(F.broadcast(blocks), "old_shard"))  # one row a shard
    passed = F.size(F.filter("__ends", lambda e: e <= F.col("__mid")))
    placed = placed.withColumn("shard", F.element_at("__to", F.least(passed + 1, F.size("__to")).cast("int")))
    return _numbered(placed.drop("__before", "__mid", "__ends", "__to"))


def rewrite(resharded: DataFrame, path: str) -> DataFrame:
    """Write the rows of the shards that a transfer changes under ``path``, one
    folder a shard, and remove the folders of those left without rows; files of
    untouched shards stay as they are.  Returns the transfers: (old_shard,
    shard, rows, bytes).  ``resharded`` may read ``path`` itself."""
    spark = resharded.sparkSession
    resharded = stored(resharded, "zstd")  # old files, new files and this are there at once
    moves = resharded.groupBy("old_shard", "shard").agg(F.count("*").alias("rows"), F.sum("size").alias("bytes"))
    pairs = [(r["old_shard"], r["shard"]) for r in moves.select("old_shard", "shard").collect()]  # shards, not rows
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    below = lambda name: spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder, name)
    changed = {k for pair in pairs if pair[0] != pair[1] for k in pair}
    emptied = [f"shard={k}" for k in changed - {new for _, new in pairs}]
    if files.exists(below(NO_SHARD)):  # rows of no shard count as shard 0
        changed.add(0)
        emptied.append(NO_SHARD)
    (resharded.filter(F.col("shard").isin(*changed)).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("shard").parquet(path))
    for name in emptied:
        files.delete(below(name), True)
    return moves


def reshard_files(spark: SparkSession, path: str, schema: StructType, shards: int, capacities: list[int] | None = None,
                  cost: Callable[[int, int], int] | None = None, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """Reshard the layout under ``path`` (rows of ``schema`` in one folder
    ``shard=N`` a shard) in place.  Returns the rows as the files have them
    then, with ``size``, ``old_shard``, ``shard`` and ``slot``."""
    plain = StructType([f for f in schema if f.name not in RESULTS])
    old = spark.read.schema(StructType([*plain]).add("shard", "integer")).parquet(path)
    moves = rewrite(reshard(old, F.col("shard"), shards, capacities, cost, id_col, text_col), path)
    pairs = [(r["old_shard"], r["shard"]) for r in moves.select("old_shard", "shard").collect()]
    same = {new for _, new in pairs} - {k for a, b in pairs if a != b for k in (a, b)}
    full = StructType([*plain]).add("size", "long").add("old_shard", "integer").add("slot", "long").add("shard", "integer")
    rows = spark.read.schema(full).parquet(path)
    # untouched files have the columns of the old layout, their rows no slots
    untouched = _measured(rows.withColumn("__new", F.col("shard")), F.col("shard"), id_col, text_col)
    untouched = untouched.withColumnRenamed("__new", "shard").withColumn("__range", _hash_range())
    columns = [*(f"`{f.name}`" for f in plain), *RESULTS]
    written = rows.filter(~F.col("shard").isin(*same)).select(*columns)
    if not same:
        return written
    return written.unionByName(_numbered(untouched.filter(F.col("shard").isin(*same))).select(*columns))


def reshard_table(df: DataFrame, old: Column, shards: int, **how) -> DataFrame:
    """``reshard_files`` on a new layout of ``df`` by ``old``, in the shared
    checkpoint folder."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark)}/shards-{uuid.uuid4().hex}"
    laid = df.withColumn("__old", F.coalesce(old.cast("int"), F.lit(0))).drop(*RESULTS)
    laid.withColumnRenamed("__old", "shard").write.partitionBy("shard").parquet(path)
    return reshard_files(spark, path, df.schema, shards, **how)
