"""Scalar Column -> Column functions."""

from valora.functions.text import (  # noqa: F401
    NOT_PROVIDED, UNKNOWN, trim_ws, blank_to_null, with_default, first_non_blank,
    upper_trim, is_missing, is_non_blank, first_word_key, lower_key, domain_violation,
)
from valora.functions.numeric import (  # noqa: F401
    try_double, try_int_rounded, parse_fr_number, with_sentinel, pct,
    threshold_label, exact_money_sum,
)
from valora.functions.dates import (  # noqa: F401
    year_in, day_between, to_date_safe, ends_before_start, expired,
)
from valora.functions.geo import sq_planar_distance, haversine_m, point, cell  # noqa: F401
