"""Landed JSON page sources.

The reference pages through HTTP APIs in one Python thread.  Here fetching
is out of scope (SURVEY "Not built"): pages are landed as files first and
Spark reads the whole directory in parallel with a declared schema.

* offset pages: ``{"results": [...]}`` per file  (S7)
* cursor pages sliced by region x year: ``{"total": n, "results": [...],
  "next": url}`` under ``region=<r>/year=<y>/`` folders; partition
  discovery turns the folders into columns  (S8)
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from valora.sources.json_split import read_objects

# Fixed value: fields the station pages carry (the reference's API field choice).
STATION_RECORD = T.StructType([
    T.StructField("code_uic", T.StringType()),
    T.StructField("libelle", T.StringType()),
    T.StructField("commune", T.StringType()),
    T.StructField("departemen", T.StringType()),
    T.StructField("c_geo", T.StructType([T.StructField("lon", T.DoubleType()),
                                         T.StructField("lat", T.DoubleType())])),
])

# Fields of a school record that are used.
SCHOOL_RECORD = T.StructType([
    T.StructField("identifiant", T.StringType()), T.StructField("nom", T.StringType()),
    T.StructField("longitude", T.DoubleType()), T.StructField("latitude", T.DoubleType()),
])


def page_schema(record: T.StructType, with_total: bool = False) -> T.StructType:
    fields = [T.StructField("results", T.ArrayType(record))]
    if with_total:
        fields += [T.StructField("total", T.LongType()), T.StructField("next", T.StringType())]
    return T.StructType(fields)


def read_offset_pages(spark: SparkSession, path: str, record: T.StructType) -> DataFrame:
    """All records of all landed pages, one row per record  (S7, U1).
    Empty pages contribute nothing (the reference's stop condition)."""
    pages = spark.read.schema(page_schema(record)).option("multiLine", True).json(path)
    return pages.select(F.inline(F.coalesce(F.col("results"), F.array().cast(T.ArrayType(record)))))


def read_slice_pages(spark: SparkSession, path: str, record: T.StructType,
                     slice_cols: tuple[str, ...] = ("region", "year")) -> DataFrame:
    """Landed pages of cursor-paged slices, one row a page, with the slice
    columns from the folder names."""
    schema = page_schema(record, with_total=True)
    for c in slice_cols:
        schema = schema.add(T.StructField(c, T.StringType()))
    return spark.read.schema(schema).option("multiLine", True).json(path)


def read_cursor_slices(spark: SparkSession, path: str, record: T.StructType,
                       slice_cols: tuple[str, ...] = ("region", "year")) -> DataFrame:
    """Records of cursor-paged slices with the slice columns from the
    folder names, plus the ``total`` announced by the slice's pages  (S8)."""
    pages = read_slice_pages(spark, path, record, slice_cols)
    return pages.select(*slice_cols, F.col("total").alias("_slice_total"),
                        F.inline(F.coalesce(F.col("results"), F.array().cast(T.ArrayType(record)))))


def slice_completeness(pages: DataFrame, slice_cols: tuple[str, ...] = ("region", "year")) -> DataFrame:
    """Per slice of landed pages: rows landed vs total announced, and whether
    it is complete.  Counted from the pages, so a slice that failed to load, or
    whose pages hold no record, shows up here (SURVEY Q18)."""
    return (pages.groupBy(*slice_cols)
            .agg(F.sum(F.greatest(F.coalesce(F.size("results"), F.lit(0)), F.lit(0)).cast("long")).alias("n_rows"),
                 F.max("total").alias("total"))
            .withColumn("complete", F.col("n_rows") == F.col("total")))


def stations_table(spark: SparkSession, path: str) -> DataFrame:
    """Station table: pages -> records -> lat/lon out of ``c_geo`` (NULL
    when it is not an object) -> drop ``c_geo``  (C14 = S7 + P6 + K6)."""
    recs = read_offset_pages(spark, path, STATION_RECORD)
    return (recs.withColumn("latitude", F.col("c_geo.lat")).withColumn("longitude", F.col("c_geo.lon"))
            .drop("c_geo"))


def read_points(spark: SparkSession, path: str, schema: T.StructType = SCHOOL_RECORD, lon: str = "longitude",
                lat: str = "latitude", multiline: bool = True) -> DataFrame:
    """A JSON list of records with coordinates -> rows with a point struct
    (S10, X17).  Records without both coordinates keep a NULL point.  The list may
    have any line breaks, or with ``multiline=False`` is one record a line;
    either is read in splits."""
    if multiline:
        df = read_objects(spark, path, 1).select(F.from_json("value", schema).alias("record")).select("record.*")
    else:
        df = spark.read.schema(schema).json(path)
    pt = F.when(F.col(lon).isNotNull() & F.col(lat).isNotNull(),
                F.struct(F.col(lon).cast("double").alias("lon"), F.col(lat).cast("double").alias("lat")))
    return df.withColumn("point", pt)
