"""Records matched to a reference by address  (D3, D4): first by the normalised
address, then, for what is left, the most similar street of the same commune and number."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from valora.functions.address import street_words
from valora.operators.dedup import latest_per_key
from valora.operators.skew import skew_join

KEY = ["commune", "number", "suffix", "street"]


def similar_streets(asked: DataFrame, known: DataFrame, similarity: float = 0.5, typos: int = 2) -> DataFrame:
    """For distinct addresses ``asked`` (``KEY``) the ``known`` one most like each:
    same commune, number and suffix, and a street that shares at least ``similarity`` of the telling words or
    is at most ``typos`` edits away.  Ties go to fewer edits, then to the smaller name.

    Candidates share the first three letters of a telling word, in the same
    commune and at the same number, so none but the few such streets are compared."""
    place = ["commune", "number", "suffix"]
    start = lambda w: F.array_distinct(F.transform(w, lambda x: F.substring(x, 1, 3)))
    side = lambda df, name: (df.select(*place, F.col("street").alias(name), street_words(F.col("street")).alias(f"{name}_words"))
                             .withColumn("start", F.explode(start(F.col(f"{name}_words")))))
    pairs = side(asked, "street").join(side(known, "other"), [*place, "start"]).drop("start").distinct()
    both = F.size(F.array_union("street_words", "other_words"))
    alike = F.size(F.array_intersect("street_words", "other_words")) / both
    edits = F.levenshtein("street", "other")
    pairs = pairs.select(*place, "street", "other", alike.alias("alike"), edits.alias("edits"))
    pairs = pairs.where((F.col("alike") >= similarity) | (F.col("edits") <= typos))
    return latest_per_key(pairs, [*place, "street"], [F.desc("alike"), "edits", "other"]).select(*place, "street", "other")


def match_addresses(df: DataFrame, reference: DataFrame, df_key: dict[str, Column], ref_key: dict[str, Column],
                    ref_order: list, ref_cols: list[str], how_alias: str = "address_match") -> DataFrame:
    """``df`` with ``ref_cols`` of the reference row at its address, or NULL  (left
    join: every row stays once).  Of several rows at an address the first in ``ref_order``.

    ``df_key`` and ``ref_key`` give ``commune``, ``number``, ``suffix`` and ``street`` (normalised).
    ``how_alias`` says how a row was matched: 'exact', 'similar' or NULL."""
    names = {k: f"__{k}" for k in KEY}
    keyed = df.withColumns({names[k]: df_key[k] for k in KEY})
    ref = reference.select(*[ref_key[k].alias(k) for k in KEY], *reference.columns)
    best = latest_per_key(ref, KEY, ref_order).select(*KEY, *ref_cols)
    known = best.select(*KEY)
    asked = keyed.select(*[F.col(n).alias(k) for k, n in names.items()]).dropna().distinct()
    near = similar_streets(asked.join(known, KEY, "left_anti"), known)
    # where each asked address is found: itself, or the similar one
    found = (asked.join(known, KEY, "left_semi").select(*KEY, F.col("street").alias("other"), F.lit("exact").alias(how_alias))
             .unionByName(near.select(*KEY, "other", F.lit("similar").alias(how_alias))))
    values = best.withColumnRenamed("street", "other")
    found = found.join(values, ["commune", "number", "suffix", "other"]).drop("other").withColumnsRenamed(names)
    return skew_join(keyed, found, list(names.values()), "left").select(*df.columns, *ref_cols, how_alias)
