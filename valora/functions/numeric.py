"""Numeric scalar functions: tolerant text-to-number casts, French number
clean-up, sentinels, percentages and threshold labels (X1, X6, X8, X9, X14,
X15, C5).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from valora.functions._col import as_col

# Text the reference's TRY_CAST(... AS DOUBLE) accepts: optional sign, digits
# that may be grouped by single underscores, optional fraction, optional
# exponent; or nan / inf / infinity in any case; surrounded by optional ASCII
# whitespace.  Spark's own try_cast also accepts '1d' / '12f' and rejects
# '1_000', so its input is screened by this pattern first.
_DIGITS = r"[0-9]+(?:_[0-9]+)*"
NUMBER_TEXT = (
    r"^[ \t\n\r]*(?:[+-]?(?:" + _DIGITS + r"(?:\.(?:" + _DIGITS + r")?)?|\." + _DIGITS + r")"
    r"(?:[eE][+-]?[0-9]+)?|(?i:[+-]?(?:nan|inf|infinity)))[ \t\n\r]*$"
)

_INT_MIN, _INT_MAX = -(2 ** 31), 2 ** 31 - 1


def try_double(c) -> Column:
    """TRY_CAST(c AS DOUBLE) with the reference's accepted syntax  (X8)."""
    c = as_col(c).cast("string")
    cleaned = F.regexp_replace(F.trim(F.regexp_replace(c, r"[\t\n\r]", " ")), "_", "")
    return F.when(c.rlike(NUMBER_TEXT), cleaned.try_cast("double"))


# Unsigned hexadecimal / binary integer text ('0x1f', '0b101', digits may be
# grouped by underscores), which the reference's integer cast also accepts.
HEX_TEXT = r"^0[xX][0-9a-fA-F]+(?:_[0-9a-fA-F]+)*$"
BIN_TEXT = r"^0[bB][01]+(?:_[01]+)*$"


def try_int_rounded(c) -> Column:
    """TRY_CAST(c AS INTEGER) as the reference does it: the text is read as a
    number and rounded half away from zero ('1.5' -> 2, '1e2' -> 100), or as
    unsigned hex / binary ('0x10' -> 16); out of range, NaN or unparsable ->
    NULL  (X9)."""
    c = as_col(c).cast("string")
    digits = F.regexp_replace(F.substring(c, 3, 1 << 20), "_", "")
    based = (F.when(c.rlike(HEX_TEXT), F.conv(digits, 16, 10))
             .when(c.rlike(BIN_TEXT), F.conv(digits, 2, 10))).try_cast("decimal(38,0)")
    r = F.coalesce(based, F.round(try_double(c)).try_cast("decimal(38,0)"))
    return F.when(r.between(_INT_MIN, _INT_MAX), r.try_cast("int"))


def parse_fr_number(c) -> Column:
    """TRY_CAST(REPLACE(REPLACE(c, ',', '.'), ' ', '') AS DOUBLE): French
    decimal comma and thousands spaces  (X6 + X8).  Only U+0020 is removed,
    as in the reference, so a no-break space still fails the cast."""
    return try_double(F.replace(F.replace(as_col(c), F.lit(","), F.lit(".")), F.lit(" "), F.lit("")))


def with_sentinel(value: Column, sentinel) -> Column:
    """COALESCE(value, sentinel), e.g. coordinates -> -999, score -> 0.0  (C5)."""
    return F.coalesce(value, F.lit(sentinel))


def pct(n, total, scale: int = 2) -> Column:
    """ROUND(100 * n / total, scale); NULL when total is 0  (X14)."""
    n, total = as_col(n), as_col(total)
    return F.when(total != 0, F.round(F.lit(100.0) * n / total, scale))


def threshold_label(x, high: float = 20.0, low: float = 5.0,
                    high_label: str = "high", low_label: str = "medium",
                    none_label: str = "") -> Column:
    """Two-level label: > high, > low, else  (X15)."""
    x = as_col(x)
    return F.when(x > high, F.lit(high_label)).when(x > low, F.lit(low_label)).otherwise(F.lit(none_label))


def exact_money_sum(c) -> Column:
    """Sum of money amounts done in DECIMAL(18,2) and returned as DOUBLE so the
    result does not depend on the order rows are added in."""
    return F.sum(as_col(c).cast("decimal(18,2)")).cast("double")


def _split(a: Column) -> tuple[Column, Column]:
    # Veltkamp split: a = hi + lo with each half fitting 26 bits
    c = F.lit(134217729.0) * a
    hi = c - (c - a)
    return hi, a - hi


def fused_multiply_add(a, b, c) -> Column:
    """a * b + c with a single rounding (FMA), from double operations only:
    the product is made exact as p + e (Dekker's two-product), p + c is
    summed exactly as s + t (two-sum), and s + (t + e) rounded once more.
    Used where the reference engine's compiled arithmetic fuses the multiply
    and add (its continuous quantiles), so results agree bit for bit."""
    a, b, c = as_col(a), as_col(b), as_col(c)
    p = a * b
    ah, al = _split(a)
    bh, bl = _split(b)
    e = ((ah * bh - p) + ah * bl + al * bh) + al * bl
    s = p + c
    bb = s - p
    t = (p - (s - bb)) + (c - bb)
    exact = s + (t + e)
    # fall back to the plain expression where the split overflows
    return F.when(F.abs(a) < F.lit(1e290), exact).otherwise(p + c)
