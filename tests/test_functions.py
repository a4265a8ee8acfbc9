"""Scalar functions against the reference engine's semantics (DuckDB)."""

import pytest
from pyspark.sql import functions as F

from valora.functions import (
    first_non_blank, first_word_key, is_missing, parse_fr_number, pct, threshold_label, trim_ws,
    try_double, try_int_rounded, upper_trim, with_default, year_in,
)

NBSP = "\u00a0"
TEXTS = ["1 234,5", f"1{NBSP}234,5", "", "n/a", "nan", "NaN", "inf", "-Infinity", "12f", "1d", "1_000",
         " 1.5 ", "1.", ".5", "+3", "1e5", "1E-2", "0x10", "abc", "1,5", "-0.0", "12.345", "1__0", "_1",
         "2.5", "-1.5", "0.5", "1e2", "99999999999", "\t7\t", None]


def _spark_col(spark, values, fn):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, s string")
    return [r[0] for r in df.select(fn(F.col("s"))).orderBy(F.col("i")).collect()] if False else \
        [r[1] for r in sorted(df.select("i", fn(F.col("s")).alias("o")).collect())]


def _duck(duck, values, expr):
    out = []
    for v in values:
        out.append(duck.execute(f"SELECT {expr}", [v]).fetchone()[0])
    return out


def _same(a, b):
    import math
    if a is None or b is None:
        return a is None and b is None
    if isinstance(a, float) and math.isnan(a):
        return isinstance(b, float) and math.isnan(b)
    return a == b


def test_try_double_matches_reference(spark, duck):
    got = _spark_col(spark, TEXTS, try_double)
    exp = _duck(duck, TEXTS, "TRY_CAST(CAST($1 AS VARCHAR) AS DOUBLE)")
    bad = [(t, g, e) for t, g, e in zip(TEXTS, got, exp) if not _same(g, e)]
    assert not bad, bad


def test_try_int_rounded_matches_reference(spark, duck):
    got = _spark_col(spark, TEXTS, try_int_rounded)
    exp = _duck(duck, TEXTS, "TRY_CAST(CAST($1 AS VARCHAR) AS INTEGER)")
    bad = [(t, g, e) for t, g, e in zip(TEXTS, got, exp) if not _same(g, e)]
    assert not bad, bad


def test_french_number(spark, duck):
    got = _spark_col(spark, TEXTS, parse_fr_number)
    exp = _duck(duck, TEXTS, "TRY_CAST(REPLACE(REPLACE(CAST($1 AS VARCHAR), ',', '.'), ' ', '') AS DOUBLE)")
    bad = [(t, g, e) for t, g, e in zip(TEXTS, got, exp) if not _same(g, e)]
    assert not bad, bad
    assert got[0] == 1234.5          # '1 234,5'
    assert got[1] is None            # no-break space is not removed


def test_trim_and_defaults(spark, duck):
    vals = [" a ", f"{NBSP}b{NBSP}", "\tc", "", "  ", None, " d e "]
    got = _spark_col(spark, vals, trim_ws)
    exp = _duck(duck, vals, "TRIM(CAST($1 AS VARCHAR))")
    assert got == exp
    got = _spark_col(spark, vals, with_default)
    exp = _duck(duck, vals, "COALESCE(NULLIF(TRIM(CAST($1 AS VARCHAR)), ''), 'NR')")
    assert got == exp
    assert _spark_col(spark, [" d ", "h", None], upper_trim) == ["D", "H", None]
    assert _spark_col(spark, ["", " ", None, "x"], is_missing) == [True, True, True, False]


def test_first_word_key(spark, duck):
    towns = ["Le Mans", "Le Havre", "Saint-Nazaire", "Saint Nazaire", " PARIS 12", None, "", "Évry"]
    got = _spark_col(spark, towns, first_word_key)
    exp = _duck(duck, towns, "LOWER(SPLIT_PART(TRIM(CAST($1 AS VARCHAR)), ' ', 1))")
    assert got == exp
    assert got[0] == got[1] == "le"           # the weak key the reference uses (Q4)


def test_first_non_blank(spark):
    df = spark.createDataFrame([(" ", "x"), (None, " "), ("a", "b"), (None, None)], "p string, r string")
    out = [r[0] for r in df.select(first_non_blank("p", "r")).collect()]
    assert out == ["x", "NR", "a", "NR"]


def test_pct_and_flag(spark):
    df = spark.createDataFrame([(25, 100), (6, 100), (1, 100), (1, 0)], "n long, t long")
    rows = df.select(pct("n", "t").alias("p"), threshold_label(pct("n", "t")).alias("f")).collect()
    assert [(r.p, r.f) for r in rows] == [(25.0, "high"), (6.0, "medium"), (1.0, ""), (None, "")]


def test_year_filter_is_pushed(spark, tmp):
    import datetime as dt
    df = spark.createDataFrame([(dt.date(2023, 12, 31),), (dt.date(2024, 1, 1),), (dt.date(2025, 12, 31),),
                                (dt.date(2026, 1, 1),), (None,)], "d date")
    df.write.parquet(f"{tmp}/d")
    r = spark.read.parquet(f"{tmp}/d")
    q = r.where(year_in(r, "d", [2024, 2025]))
    assert q.count() == 2
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(d), GreaterThanOrEqual(d,2024-01-01), LessThan(d,2026-01-01)]" in plan
