"""Delimited-text sources.

* Multi-file reads are grouped by header: Spark's CSV reader maps columns
  by position, so files whose headers differ are read per header group and
  combined with ``unionByName(allowMissingColumns=True)`` (the reference's
  ``union_by_name``).
* Bad rows: PERMISSIVE parsing with a corrupt-record column, then a split
  into good rows and rejects (the reference's ``ignore_errors`` silently
  drops them; here they are kept for a count).
* Gzip files are not splittable, so a compressed read is repartitioned
  right after the scan.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from valora.functions import try_double
from valora.schemas import data_type
from valora.sources.quoted import read_records

CORRUPT = "_corrupt_record"
SOURCE = "_source_file"


def list_files(spark: SparkSession, path: str, glob: str | None = None) -> list[str]:
    """File paths under ``path`` (a directory or glob), from the file
    system Spark reads (local, HDFS, object store).  Only file metadata is
    listed; contents are not read."""
    reader = spark.read.format("binaryFile")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return sorted(r.path for r in reader.load(path).select("path").collect())


def header_of(spark: SparkSession, path: str, sep: str) -> tuple[str, ...]:
    """Column names of one delimited file (reads its first line only)."""
    return tuple(spark.read.option("header", True).option("sep", sep).option("inferSchema", False)
                 .option("quote", '"').option("escape", '"').csv(path).columns)


def typed_field(c: Column, kind: T.DataType) -> Column:
    """A text field as ``kind``, NULL where it is none; text such as ``12f`` is
    no number here, though Spark's cast reads it as one."""
    return try_double(c) if isinstance(kind, T.DoubleType) else c.try_cast(kind)


def _with_corrupt(schema: T.StructType) -> T.StructType:
    if CORRUPT in schema.fieldNames():
        return schema
    return T.StructType(list(schema.fields) + [T.StructField(CORRUPT, T.StringType(), True)])


def _parsed_records(records: DataFrame, text: T.StructType, sep: str, header: bool) -> DataFrame:
    """Whole records as text columns, with the record itself where it does not
    parse, and its file.  A header that has other names is an error, as it is
    to Spark's reader."""
    schema = ", ".join(f"`{f.name}` string" for f in _with_corrupt(text))
    options = {"sep": sep, "quote": '"', "escape": '"', "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT,
               "columnPruning": "false", "maxCharsPerColumn": "-1"}
    rows = records.select("first", F.col("file").alias(SOURCE), F.from_csv(
        F.regexp_replace("value", "^\ufeff", "") if header else F.col("value"), schema, options).alias("row"))
    if header:
        names = F.lower(F.concat_ws(sep, *(F.col("row").getField(f.name) for f in text)))
        same = names == F.lit(sep.join(text.fieldNames()).lower())
        other = F.raise_error(F.concat(F.lit("the header has other names than the schema: "), F.col(SOURCE)))
        rows = rows.filter(F.when(F.col("first"), F.when(same, F.lit(False)).otherwise(other.cast("boolean")))
                           .otherwise(F.lit(True)))
    return rows.select("row.*", SOURCE)


def read_delimited(spark: SparkSession, paths: str | list[str], sep: str = ",",
                   schema: T.StructType | None = None, header: bool = True,
                   all_text: bool = False, keep_rejects: bool = False,
                   partitions: int | None = None, encoding: str = "UTF-8",
                   multi_line: bool = False, flag: str | None = None) -> DataFrame | tuple[DataFrame, DataFrame]:
    """One delimited read with a declared schema  (S2, S3, S4, S6).

    ``schema=None`` reads every header column as STRING (the reference's
    ``all_varchar``; ``all_text`` says so explicitly).  A row is rejected
    when its field count does not match the header or when a non-empty
    field does not cast to its declared type.  Fields are read as text and
    cast with ``try_cast`` in the plan, so the reject test names every typed
    column and gives the same split whichever columns a later query reads
    (a pruned CSV scan would skip conversion of unread columns).  With
    ``keep_rejects=False`` only the good rows are returned.  ``partitions``
    repartitions after the scan (use it for gzip input, which is one split
    per file).  ``flag`` names a column that says of every row whether it is good, and
    none is left out: rejects can then be counted on the way.  A quote inside a quoted field is doubled; ``multi_line`` reads
    line breaks inside quotes: UTF-8 files in splits (``sources.quoted``), any other encoding one task a file."""
    if isinstance(paths, str):
        paths = [paths]
    if schema is None or all_text:
        names = schema.fieldNames() if schema is not None else list(header_of(spark, paths[0], sep))
        schema = T.StructType([T.StructField(n, T.StringType(), True) for n in names])
    text = T.StructType([T.StructField(f.name, T.StringType(), True) for f in schema.fields])
    source = F.input_file_name()
    if multi_line and encoding.upper() in ("UTF-8", "UTF8"):
        df, source = _parsed_records(read_records(spark, paths), text, sep, header), F.col(SOURCE)
    else:
        df = (spark.read.schema(_with_corrupt(text)).option("header", header).option("sep", sep)
              .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
              .option("encoding", encoding).option("enforceSchema", False)
              .option("quote", '"').option("escape", '"').option("multiLine", multi_line)
              .option("columnPruning", False).csv(paths))
    if partitions:
        df = df.repartition(partitions)
    typed, cast_ok = [], []
    for f in schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.StringType):
            typed.append(c)
        else:
            v = typed_field(c, f.dataType)
            typed.append(v.alias(f.name))
            cast_ok.append(c.isNull() | v.isNotNull())
    # Spark refuses a raw-file scan whose only required column is the
    # corrupt-record column (e.g. ``good.count()`` of an all-text read); an
    # always-true test on the first field keeps one real column in the scan.
    cast_ok.append(F.hash(F.col(f"`{schema.fields[0].name}`")).bitwiseOR(F.lit(1)) != F.lit(0))
    ok = reduce(lambda a, b: a & b, cast_ok) & F.col(CORRUPT).isNull()
    if flag:
        return df.select(*typed, ok.alias(flag))
    flagged = df.withColumn("__ok", ok)
    good = flagged.where(F.col("__ok")).select(*typed)
    if not keep_rejects:
        return good
    rejects = (flagged.where(~F.col("__ok"))
               .select(*[F.col(f"`{f.name}`") for f in schema.fields],
                       F.coalesce(F.col(CORRUPT), F.concat_ws(sep, *[F.coalesce(F.col(f"`{f.name}`"), F.lit(""))
                                                                    for f in schema.fields])).alias("raw_line"),
                       source.alias("source_file")))
    return good, rejects


def read_delimited_by_header(spark: SparkSession, path: str, sep: str = ";", glob: str | None = None,
                             types: dict[str, str] | None = None, keep_rejects: bool = False):
    """Multi-file scan with union by name  (S1, U2).

    Files are grouped by their header line; each group is one scan with
    that header's column list (typed from ``types``, else STRING); the
    groups are combined by column name, absent columns as NULL."""
    types = types or {}
    files = list_files(spark, path, glob)
    # one first-line read per file; the probes are independent small jobs,
    # submitted concurrently
    from concurrent.futures import ThreadPoolExecutor
    with ThreadPoolExecutor(max_workers=min(16, max(1, len(files)))) as pool:
        headers = list(pool.map(lambda f: header_of(spark, f, sep), files))
    groups: dict[tuple[str, ...], list[str]] = {}
    for f, h in zip(files, headers):
        groups.setdefault(h, []).append(f)
    goods, rejects = [], []
    for cols, fs in groups.items():
        schema = T.StructType([T.StructField(c, data_type(types.get(c, "string")), True)
                               for c in cols])
        good, bad = read_delimited(spark, fs, sep, schema, keep_rejects=True)
        goods.append(good)
        rejects.append(bad)
    if not goods:
        raise FileNotFoundError(f"no files under {path}")
    good = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), goods)
    if keep_rejects:
        return good, reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), rejects)
    return good


def stringify_all(df: DataFrame, empty: str = "") -> DataFrame:
    """Every column as text, NULL -> ''  (S12, the API loader's
    ``astype(str)``).  Kept for compatibility; typed reads are preferred
    because text sentinels hide missing values (SURVEY Q11)."""
    return df.select(*[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(empty)).alias(c) for c in df.columns])
