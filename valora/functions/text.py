"""Text scalar functions.

All are Column -> Column built from JVM-side Spark SQL functions so they stay
inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from valora.functions._col import as_col

# Fixed value: the text sentinel the reference writes for "not provided".
NOT_PROVIDED = "NR"
# Fixed value: the default the reference writes for an unknown roof insulation.
UNKNOWN = "Inconnu"

# Fixed value: the Unicode space separators (category Zs), which the
# reference's TRIM strips at both ends: U+0020, U+00A0, U+1680, U+2000 to
# U+200A, U+202F, U+205F, U+3000.  Spark's one-argument ``trim`` strips only
# U+0020; tabs are kept by both.
SPACE_SEPARATORS = "".join(chr(c) for c in [0x20, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x202F, 0x205F, 0x3000])


def trim_ws(c) -> Column:
    """TRIM that strips every Unicode space separator at both ends."""
    return F.btrim(as_col(c), F.lit(SPACE_SEPARATORS))


def blank_to_null(c) -> Column:
    """NULLIF(TRIM(c), '')."""
    return F.nullif(trim_ws(c), F.lit(""))


def with_default(c, default: str = NOT_PROVIDED) -> Column:
    """COALESCE(NULLIF(TRIM(c), ''), default)  (C3)."""
    return F.coalesce(blank_to_null(c), F.lit(default))


def first_non_blank(*cols, default: str = NOT_PROVIDED) -> Column:
    """First non-blank of several text columns, else ``default``  (C4)."""
    return F.coalesce(*[blank_to_null(c) for c in cols], F.lit(default))


def upper_trim(c) -> Column:
    """UPPER(TRIM(c))  (X3 + X4)."""
    return F.upper(trim_ws(c))


def is_missing(c) -> Column:
    """Null or blank  (F5)."""
    c = as_col(c)
    return c.isNull() | (trim_ws(c) == F.lit(""))


def is_non_blank(c) -> Column:
    """Not null and not blank  (F4)."""
    return trim_ws(c) != F.lit("")


def first_word_key(c) -> Column:
    """LOWER(SPLIT_PART(TRIM(c), ' ', 1)): the town blocking key  (J3, X5, X7)."""
    return F.lower(F.split_part(trim_ws(c), F.lit(" "), F.lit(1)))


def lower_key(c) -> Column:
    """LOWER(c): case-normalised join key  (J2, X5)."""
    return F.lower(as_col(c))


def domain_violation(c, allowed) -> Column:
    """Not null and UPPER(TRIM(c)) outside ``allowed``  (F7)."""
    c = as_col(c)
    return c.isNotNull() & ~upper_trim(c).isin(list(allowed))
