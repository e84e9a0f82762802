"""Column-expression helpers. All of them are Spark built-ins composed into
one expression tree, so they stay inside whole-stage codegen."""

from farebox.functions.keys import date_key, surrogate_key
from farebox.functions.numeric import (
    exact_mean_2dp,
    half_even_int,
    round_exact_ratio_2dp,
    round_numeric,
    money_2dp,
    money_sum,
)
from farebox.functions.temporal import (
    duration_minutes,
    duration_minutes_2dp,
    duration_us,
    iso_day_of_week,
    ntz_literal,
)

__all__ = [
    "date_key", "surrogate_key", "exact_mean_2dp", "half_even_int",
    "round_exact_ratio_2dp", "round_numeric", "money_2dp", "money_sum", "duration_minutes",
    "duration_minutes_2dp", "duration_us", "iso_day_of_week", "ntz_literal",
]
