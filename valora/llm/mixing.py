"""Mixing sources to target weights by hierarchical budgeting.

Documents are the leaves of a domain - language - source tree.  A token budget
flows down: among siblings it is shared by weight, but no node gets more than
its subtree holds (its tokens times ``max_epochs``); what a node cannot take
goes to its siblings, and only what a whole family cannot take goes to the
family's siblings one level up.  Each level is a water level found with running
sums over the siblings, in Spark.

A leaf with a budget of e whole passes and a rest gives each of its documents
e times, and of pass e a prefix: the documents in the order of a seeded hash of
(seed, epoch, document) as long as they fit.  The end of the prefix is found
from token sums per hash range and then within one range, so no leaf, however
large, is ordered in one task, and the texts are not shuffled at all.

Defined cases: a null domain, language or source is a value of its own,
``(none)``; a null text has no tokens; documents given twice count twice;
documents without tokens are in a prefix if they come before its end; an empty
table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from valora.llm.session import stored

RANGE_BITS = 10
LEVELS = ("l_domain", "l_lang", "l_source")


def default_domain(source: Column) -> Column:
    """A domain for sources that have none: one of four, by name."""
    return F.concat(F.lit("d"), F.pmod(F.crc32(source.cast("binary")), F.lit(4)).cast("string"))


def _weight(weights: dict[tuple, float], path: list[Column]) -> Column:
    """Weight of a node among its siblings (1 where none is given)."""
    given = {k: v for k, v in weights.items() if len(k) == len(path)}
    out = F.lit(1.0)
    for key, value in given.items():
        match = F.lit(True)
        for column, part in zip(path, key, strict=True):
            match = match & (column == F.lit(part))
        out = F.when(match, F.lit(float(value))).otherwise(out)
    return out


def _share(nodes: DataFrame, parent: list[str], name: str) -> DataFrame:
    """``nodes`` (parent, name, cap, weight, budget of the parent) with
    ``given``: the budget shared by weight, none above its cap."""
    nodes = nodes.withColumn("cap", F.when(F.col("weight") > 0, F.col("cap")).otherwise(0.0))
    family = Window.partitionBy(*parent) if parent else Window.partitionBy(F.lit(0))
    order = family.orderBy(F.when(F.col("weight") > 0, F.col("cap") / F.col("weight")).otherwise(F.lit(-1.0)), name)
    before = F.coalesce(F.sum("cap").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    rest = F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing))
    nodes = (nodes.withColumn("level", F.when(rest > 0, (F.col("budget") - before) / rest).otherwise(0.0))
             .withColumn("full", F.col("cap") <= F.col("level") * F.col("weight"))
             .withColumn("rank", F.row_number().over(order)))
    level = F.min(F.when(~F.col("full"), F.struct("rank", "level"))).over(family).getField("level")
    return (nodes.withColumn("given", F.when(F.col("full"), F.col("cap")).otherwise(level * F.col("weight")))
            .withColumn("given", F.greatest(F.lit(0.0), F.least("given", "cap")))
            .drop("level", "full", "rank"))


def budgets(leaves: DataFrame, weights: dict[tuple, float], budget: Column, max_epochs: int) -> DataFrame:
    """``leaves`` (domain, language, source, tokens) with ``given``, their
    whole-number budgets.  ``budget``: an aggregate of ``tokens``."""
    total = leaves.agg(budget.cast("double").alias("budget"))
    state = total
    for depth in range(1, len(LEVELS) + 1):
        path = list(LEVELS[:depth])
        nodes = (leaves.groupBy(*path).agg((F.sum("tokens") * max_epochs).cast("double").alias("cap"))
                 .withColumn("weight", _weight(weights, [F.col(c) for c in path])))
        nodes = nodes.join(state, path[:-1]) if depth > 1 else nodes.withColumn(
            "budget", state.select("budget").scalar())
        shared = _share(nodes, path[:-1], path[-1])
        state = shared.select(*path, F.col("given").alias("budget"))
    return leaves.join(state.withColumn("given", F.floor(F.col("budget") + 1e-6)).drop("budget"), list(LEVELS))


def mix(df: DataFrame, weights: dict[tuple, float] | None = None, share: float = 0.5, max_epochs: int = 4,
        seed: int = 0, domain: Column | None = None, id_col: str = "doc_id", text_col: str = "text",
        lang_col: str = "lang", source_col: str = "source", epoch_col: str | None = "epoch") -> DataFrame:
    """The rows of ``df`` that the mixture takes, once per epoch taken, with
    the epoch in ``epoch_col`` (None: no such column).  The budget is ``share``
    of all tokens (words)."""
    named = lambda c: F.coalesce(c.cast("string"), F.lit("(none)"))
    source = F.col(f"`{source_col}`").cast("string")
    text = F.col(f"`{text_col}`").cast("string")
    leaf = {"l_domain": named(default_domain(source) if domain is None else domain),
            "l_lang": named(F.col(f"`{lang_col}`")), "l_source": named(source)}
    mark = F.xxhash64(text)
    order = lambda epoch, id_, mark_: F.xxhash64(F.lit(seed), epoch, id_, mark_)
    id_ = F.col(f"`{id_col}`").cast("long")
    slim = stored(df.select(*(c.alias(k) for k, c in leaf.items()), id_.alias("id"), mark.alias("mark"),
                            F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long").alias("tokens")))
    leaves = slim.groupBy(*LEVELS).agg(F.sum("tokens").alias("tokens"))
    plan = budgets(leaves, weights or {}, F.sum("tokens") * share, max_epochs)
    plan = stored(plan.withColumn("epochs", F.when(F.col("tokens") > 0, F.floor(F.col("given") / F.col("tokens")))
                                  .otherwise(F.lit(0)).cast("int"))
                  .withColumn("rest", F.col("given") - F.col("epochs") * F.col("tokens"))
                  .select(*LEVELS, "epochs", "rest"))

    placed = (slim.join(plan, list(LEVELS)).withColumn("h", order(F.col("epochs"), F.col("id"), F.col("mark")))
              .withColumn("range", F.shiftright("h", 64 - RANGE_BITS)))
    up_to = Window.partitionBy(*LEVELS).orderBy("range").rowsBetween(Window.unboundedPreceding, 0)
    ranges = (placed.groupBy(*LEVELS, "range", "rest").agg(F.sum("tokens").alias("sum"))
              .withColumn("after", F.sum("sum").over(up_to)))
    cut = (ranges.filter(F.col("after") > F.col("rest")).groupBy(*LEVELS)
           .agg(F.min(F.struct("range", (F.col("after") - F.col("sum")).alias("before"))).alias("c"))
           .select(*LEVELS, "c.range", "c.before"))
    within = Window.partitionBy(*LEVELS).orderBy("h", "mark", "id").rowsBetween(Window.unboundedPreceding, 0)
    first_out = (placed.join(cut, [*LEVELS, "range"])
                 .withColumn("end", F.col("before") + F.sum("tokens").over(within))
                 .filter(F.col("end") > F.col("rest")).groupBy(*LEVELS)
                 .agg(F.min(F.struct("h", "mark")).alias("out")))
    # one row a leaf, written: its size is known, so Spark broadcasts it when
    # it is small and shuffles when it is not
    final = stored(plan.join(first_out, list(LEVELS), "left")
                   .select(*(F.col(c).alias(f"__{c}") for c in LEVELS), F.col("epochs").alias("__epochs"),
                           F.col("out").alias("__out")))
    joined = df.withColumns({f"__x_{k}": c for k, c in leaf.items()}).join(
        final, [F.col(f"__x_{c}") == F.col(f"__{c}") for c in LEVELS])
    here = F.struct(order(F.col("__epochs"), id_, mark).alias("h"), mark.alias("mark"))
    whole = F.when(F.col("__epochs") > 0, F.sequence(F.lit(0), F.col("__epochs") - 1)).otherwise(F.array().cast("array<int>"))
    part = F.when(F.col("__out").isNull() | (here < F.col("__out")), F.array("__epochs")).otherwise(
        F.array().cast("array<int>"))
    part = F.when((F.col("__epochs") >= max_epochs), F.array().cast("array<int>")).otherwise(part)
    columns = [F.col(f"`{c}`") for c in df.columns if c != epoch_col]
    taken = joined.select(*columns, F.explode(F.concat(whole, part)).alias("__epoch"))
    return taken.drop("__epoch") if epoch_col is None else taken.withColumnRenamed("__epoch", epoch_col)
