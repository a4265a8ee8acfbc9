"""Equi-joins whose frequent keys nobody knows beforehand  (J1, J5, D3, D4, D6, D8).

One pass over the left keys keeps a frequent-items sketch (``approx_top_k``, of
bounded size, merged from partial sketches), which names every key that holds more
than a task's share of the rows and how many shares it holds.  That table has
at most ``KEYS`` rows, so it is broadcast to both sides: left rows of such a key are
dealt to as many parts, and right rows of it are there once per part.  All
other keys meet as in any join; nothing is chosen by the driver.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Keys the sketch reports, and items it tracks (its error is 3.5 in so many of all rows).
KEYS, TRACKED = 512, 65_536
#: Keys whose right rows may be sent to all left rows, which then stay where they are.
STAYING = 4096


def frequent_keys(df: DataFrame, keys: list[str], parts: int) -> DataFrame:
    """``(__hash, __parts)`` of the keys with more rows than one in ``parts`` of
    all, and the number of such shares each holds, rounded up."""
    hashed = df.select(F.xxhash64(*[F.col(f"`{k}`") for k in keys]).alias("h"))
    sketch = hashed.agg(F.expr(f"approx_top_k(h, {KEYS}, {TRACKED})").alias("top"), F.count(F.lit(1)).alias("rows"))
    each = sketch.select("rows", F.explode("top").alias("t"))
    shares = F.ceil(F.col("t.count") * parts / F.col("rows")).cast("int")
    return each.select(F.col("t.item").alias("__hash"), shares.alias("__parts")).filter(F.col("__parts") > 1)


def of_frequent_keys(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """The rows of ``right``, which has one a key, of the ``STAYING`` keys that most rows of ``left`` have (by a
    sketch): few enough to be broadcast, however many rows of ``left`` that spares a shuffle."""
    hashed = left.select(F.xxhash64(*[F.col(f"`{k}`") for k in keys]).alias("h"))
    top = hashed.agg(F.expr(f"approx_top_k(h, {STAYING}, {TRACKED})").alias("top")).select(F.explode("top.item").alias("__hash"))
    return right.withColumn("__hash", F.xxhash64(*[F.col(f"`{k}`") for k in keys])).join(
        F.broadcast(top), "__hash", "left_semi").drop("__hash")


def skew_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner", null_safe: bool = False,
              parts: int | None = None, merge: bool = False) -> DataFrame:
    """``left`` joined to ``right`` (``inner`` or ``left``) on ``keys``, the left
    side's frequent keys dealt to several tasks.  ``null_safe``: NULL keys meet NULL keys;
    otherwise rows with one meet nothing and are spread.  ``parts``: shares the left side
    is seen as, the shuffle partitions by default.  ``merge``: neither side is broadcast, however
    small the files it is read from (Spark goes by their compressed size, and coordinates and cells
    compress so well that a table of a few MB may take a GB of the driver's memory)."""
    n = parts or int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    names = [f"__k{i}" for i in range(len(keys))]
    absent = F.lit(False) if null_safe else reduce(lambda a, b: a | b, [F.col(f"`{k}`").isNull() for k in keys])
    hot = F.broadcast(frequent_keys(left if null_safe else left.where(~absent), keys, n))
    key = F.xxhash64(*[F.col(f"`{k}`") for k in keys])
    # by the row's content and its input partition: the same again when a task is repeated
    spread = F.xxhash64(F.spark_partition_id(), *[F.col(f"`{c}`") for c in left.columns])
    lk = left.withColumn("__hash", key).join(hot, "__hash", "left").withColumn("__part", F.pmod(
        spread, F.when(absent, F.lit(n)).otherwise(F.coalesce("__parts", F.lit(1)))).cast("int")).drop("__hash", "__parts")
    # the right keys as the left side's types, so that equal keys have equal hashes
    kinds = {f.name: f.dataType for f in left.schema.fields}
    rkey = F.xxhash64(*[F.col(f"`{k}`").try_cast(kinds[k]) for k in keys])
    rk = (right.withColumn("__hash", rkey).join(hot, "__hash", "left")
          .withColumn("__part", F.explode(F.sequence(F.lit(0), F.coalesce("__parts", F.lit(1)) - 1))).drop("__hash", "__parts"))
    if merge:
        rk = rk.hint("merge")
    if not null_safe:
        return lk.join(rk, [*keys, "__part"], how).drop("__part")
    rk = rk.withColumnsRenamed(dict(zip(keys, names))).withColumnRenamed("__part", "__rpart")
    same = [F.col(f"`{k}`").eqNullSafe(F.col(name)) for k, name in zip(keys, names)]
    return lk.join(rk, reduce(lambda a, b: a & b, same, F.col("__part") == F.col("__rpart")), how).drop(
        "__part", "__rpart", *names)
