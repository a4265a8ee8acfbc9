"""Date predicates.

Year membership is rewritten as half-open ranges on the raw column so the
predicate reaches the Parquet scan as ``PushedFilters``; ``year(col) IN (...)``
would not be pushed.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from valora.functions._col import as_col


def _lit_as(df: DataFrame, column: str, value: str) -> Column:
    """A literal of the column's own type so the comparison needs no cast on
    the column side (keeps it pushable)."""
    dtype = df.schema[column].dataType
    return F.lit(value).cast(dtype)


def _merge_years(years) -> list[tuple[int, int]]:
    ys = sorted(set(int(y) for y in years))
    spans: list[tuple[int, int]] = []
    for y in ys:
        if spans and spans[-1][1] == y - 1:
            spans[-1] = (spans[-1][0], y)
        else:
            spans.append((y, y))
    return spans


def year_in(df: DataFrame, column: str, years) -> Column:
    """``year(column) IN years`` as OR-ed ranges ``[y0-01-01, y1+1-01-01)``."""
    spans = _merge_years(years)
    if not spans:
        return F.lit(False)
    c = F.col(column)
    pred = None
    for lo, hi in spans:
        p = (c >= _lit_as(df, column, f"{lo:04d}-01-01")) & (c < _lit_as(df, column, f"{hi + 1:04d}-01-01"))
        pred = p if pred is None else (pred | p)
    return pred


def day_between(df: DataFrame, column: str, start: str, end: str) -> Column:
    """Calendar days ``start <= date(column) <= end`` as a pushable half-open
    range on the raw column  (F3, the ``_gte`` / ``_lte`` slice bounds)."""
    end_next = (_dt.date.fromisoformat(end) + _dt.timedelta(days=1)).isoformat()
    c = F.col(column)
    return (c >= _lit_as(df, column, start)) & (c < _lit_as(df, column, end_next))


def to_date_safe(c) -> Column:
    """TRY_CAST(c AS DATE) for text or timestamps; unparsable -> NULL  (X10)."""
    return as_col(c).try_cast("date")


def ends_before_start(end, start) -> Column:
    """Both present and end < start  (F10)."""
    end, start = to_date_safe(end), to_date_safe(start)
    return end.isNotNull() & start.isNotNull() & (end < start)


def expired(c, as_of: str | None = None) -> Column:
    """DATE(c) < as_of (default CURRENT_DATE)  (F11, X12)."""
    ref = F.current_date() if as_of is None else F.lit(as_of).cast("date")
    return to_date_safe(c) < ref
