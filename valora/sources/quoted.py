"""Records of delimited files with line breaks inside quotes.

Such a file need not be read by one task.  Its lines are read in splits; a line
lies inside a quoted field where the number of quotes before it is odd, and that
number is a running sum within the split plus the parity of the splits before
it (one row a split).  A line that begins and ends outside quotes is a record
as it stands; only the others are brought together, by the line that opened
their record, and joined by line breaks again.

Defined cases: doubled quotes count twice, so they change nothing; the carriage
return before a record's end is no part of it; empty lines between records are
none; a quote that is never closed would make the rest of a file one record, so
a record takes at most ``max_lines`` lines of a split after the one that opens
it, and each line beyond is a record by itself (it parses or is rejected like
any other; no line is lost).  A gzip file has one split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Lines of one split that a record may go on for.
MAX_LINES = 10_000


def read_records(spark: SparkSession, paths: str | list[str], quote: str = '"', max_lines: int = MAX_LINES) -> DataFrame:
    """(file, first, value): one row per record, with its whole text and whether
    it is the first of its file."""
    quotes = F.length("value") - F.length(F.replace("value", F.lit(quote), F.lit("")))
    lines = (spark.read.option("lineSep", "\n").text(paths)
             .select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                     F.monotonically_increasing_id().alias("seq"), (quotes % 2).alias("odd")))
    split = ["file", "block"]
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    parity = (lines.groupBy(*split).agg(F.sum("odd").alias("n"))
              .select(*split, F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("carried")))

    in_order = Window.partitionBy(*split).orderBy("seq")
    before = F.coalesce(F.sum("odd").over(in_order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    up_to = in_order.rowsBetween(Window.unboundedPreceding, 0)
    placed = (lines.join(parity, split)
              .withColumns({"before": before, "at": F.row_number().over(in_order)})
              .withColumn("inside", (F.col("before") + F.col("carried")) % 2 == 1)
              .withColumn("open", (F.col("before") + F.col("carried") + F.col("odd")) % 2 == 1)
              .withColumn("opener", F.last(F.when(~F.col("inside"), F.struct("seq", "at")), True).over(up_to)))
    since = F.col("at") - F.coalesce(F.col("opener.at"), F.lit(0))
    first = (F.col("block") == 0) & (F.col("at") == 1)
    placed = placed.withColumn("alone", ~F.col("inside") & ~F.col("open") | F.col("inside") & (since > max_lines))
    whole = placed.filter("alone").select("file", first.alias("first"), "value")

    # the record that is open where a split begins was opened by the last
    # opening line of the splits before it
    last = (placed.groupBy(*split).agg(F.max(F.when(~F.col("inside"), F.col("seq"))).alias("seq"))
            .select(*split, F.last("seq", True).over(earlier).alias("carried_opener")))
    parts = (placed.filter(~F.col("alone")).select(*split, "seq", "value", first.alias("first"), F.col("opener.seq").alias("opener"))
             .join(last, split).withColumn("record", F.coalesce("opener", "carried_opener")))
    texts = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("block", "seq", "value"))), lambda p: p["value"]), "\n")
    joined = parts.groupBy("file", "record").agg(F.max("first").alias("first"), texts.alias("value")).drop("record")
    return (whole.unionByName(joined.select("file", "first", "value"))
            .withColumn("value", F.regexp_replace("value", "\r$", ""))
            .filter(F.trim("value") != ""))
