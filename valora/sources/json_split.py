"""Objects of a large JSON document, read in splits.

A GeoJSON file or a JSON list may be one line of any length, so lines don't split
it.  Closing braces do: the file is read as the pieces between them.  Running
sums within a split, plus one row a split for what lies before it, tell whether a
piece begins inside a string (parity of quotes) and how deep it lies (braces
outside strings).  An object of the wanted depth begins in the piece where that
depth is first reached and ends in the one that falls below it; its pieces are
joined within the split, and only objects that a split's edge cuts are joined
again.  No task holds more than a split and the objects it cuts.

Defined cases: members that are objects (a ``crs``) are none, only elements of an
array or of the top level; elements that are no objects are left out; an empty
list gives no rows; the document has to be valid JSON, and a gzip file has one split.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Text up to the next brace outside strings.
_BEFORE = r'[^"{]*+(?:"[^"\\]*+(?:\\.[^"\\]*+)*+"[^"{]*+)*+'


def _braces(segments: Column, odd: int) -> Column:
    """Opening braces in every second segment between quotes."""
    text = F.array_join(F.filter(segments, lambda _, i: i % 2 == odd), "")
    return F.length(text) - F.length(F.replace(text, F.lit("{"), F.lit("")))


def read_objects(spark: SparkSession, path: str | list[str], depth: int) -> DataFrame:
    """(file, value): the text of each object at ``depth`` (1: the elements of a
    list, 2: those of a list in an object)."""
    split = ["file", "block"]
    bare = F.replace(F.replace("value", F.lit("\\\\"), F.lit("")), F.lit('\\"'), F.lit(""))
    segments = F.split(bare, '"', -1)
    pieces = (spark.read.option("lineSep", "}").text(path)
              .select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                      F.monotonically_increasing_id().alias("seq"), ((F.size(segments) - 1) % 2).alias("odd"),
                      _braces(segments, 0).alias("outer"), _braces(segments, 1).alias("inner")))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    so_far = lambda c: F.coalesce(F.sum(c).over(earlier), F.lit(0))
    quotes = pieces.groupBy(*split).agg(F.sum("odd").alias("n")).select(*split, so_far("n").alias("quotes"))

    order = Window.partitionBy(*split).orderBy("seq")
    ahead = order.rowsBetween(Window.unboundedPreceding, -1)
    inside = (F.col("quotes") + F.coalesce(F.sum("odd").over(ahead), F.lit(0))) % 2
    placed = (pieces.join(quotes, split).withColumn("inside", inside)
              .withColumn("opens", F.when(F.col("inside") == 1, F.col("inner")).otherwise(F.col("outer")))
              .withColumn("closes", 1 - (F.col("inside") + F.col("odd")) % 2)
              .withColumn("change", F.col("opens") - F.col("closes")))
    levels = placed.groupBy(*split).agg(F.sum("change").alias("n")).select(*split, so_far("n").alias("level"))
    begins = (F.col("level") < depth) & (F.col("top") >= depth)
    placed = (placed.join(levels, split)
              .withColumn("level", F.col("level") + F.coalesce(F.sum("change").over(ahead), F.lit(0)))
              .withColumn("top", F.col("level") + F.col("opens")).withColumn("begins", begins)
              .withColumn("opener", F.last(F.when(F.col("begins"), F.col("seq")), True).over(
                  order.rowsBetween(Window.unboundedPreceding, 0)))
              .filter(F.col("top") >= depth)
              .withColumn("ends", (F.col("top") == depth) & (F.col("closes") == 1))
              .withColumn("value", F.concat("value", F.lit("}"))))
    part = F.struct("block", "seq", "value")
    text = lambda c: F.array_join(F.transform(F.array_sort(F.collect_list(c)), lambda p: p["value"]), "")
    # pieces of an object that this split opens, or, before any, of one opened earlier
    parts = placed.groupBy(*split, "opener").agg(
        text(part).alias("value"), F.max("ends").alias("ends"), F.min("seq").alias("seq"),
        F.min(F.when(F.col("begins"), F.col("level"))).alias("level"))
    whole = parts.filter(F.col("ends") & F.col("opener").isNotNull()).select("file", "level", "value")
    last = (parts.groupBy(*split).agg(F.max("opener").alias("opener"))
            .select(*split, F.last("opener", True).over(earlier).alias("carried")))
    cut = (parts.filter(~F.col("ends") | F.col("opener").isNull()).join(last, split)
           .groupBy("file", F.coalesce("opener", "carried").alias("record"))
           .agg(F.min("level").alias("level"), text(part).alias("value")).select("file", "level", "value"))

    objects = whole.unionByName(cut)
    start, lead = F.lit(0), F.lit("")
    for k in range(1, depth + 1):  # the object is the k-th brace of its first piece
        lead_k = F.regexp_extract("value", "^" + r"\{".join([_BEFORE] * k), 0)
        here = F.col("level") == depth - k
        start, lead = F.when(here, F.length(lead_k)).otherwise(start), F.when(here, lead_k).otherwise(lead)
    return (objects.withColumns({"start": start, "before": F.regexp_extract(lead, r"(\S)\s*$", 1)})
            .filter(F.col("before").isin("[", ",", ""))
            .select("file", F.substring("value", F.col("start") + 1, F.length("value")).alias("value")))
