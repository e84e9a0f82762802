"""Numeric casts and rounding with warehouse (numeric) semantics.

* ``x::int`` of a double rounds half to even, whereas a Spark cast truncates.
* ``round(x::numeric, 2)`` first turns the double into a 15-significant-digit
  numeric and then rounds half away from zero. Spark's own double->decimal
  cast keeps up to 17 digits, which rounds 12.344999999999999 to 12.34
  instead of 12.35, so the 15-digit text form is used explicitly.
* Means and ratios of decimal sums are rounded with integer arithmetic, so
  there is exactly one rounding step (decimal division in Spark would round
  at scale 6 first, and a double division would round in binary).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

RESULT_DECIMAL = "decimal(18,2)"


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def half_even_int(c: Column | str) -> Column:
    """double -> int rounding half to even (0.5 -> 0, 1.5 -> 2, 2.5 -> 2)."""
    return F.rint(_c(c)).cast("int")


def round_numeric(c: Column | str, scale: int = 2) -> Column:
    """``round(x::numeric, scale)`` for a double: 15 significant digits, then
    HALF_UP. NULL gives NULL; NaN, +-Infinity and values that do not fit
    ``decimal(18, scale)`` raise, so no sum over the result can lose a row.

    The 15-digit text is only needed where it can decide the rounding: within
    its own error of a tie. Everywhere else the plain decimal rounds alike."""
    x = _c(c)
    shifted = F.abs(x) * F.lit(float(10 ** scale))
    near_tie = F.abs(shifted - F.floor(shifted) - F.lit(0.5)) <= shifted * F.lit(1e-14) + F.lit(1e-9)
    large = shifted >= F.lit(1e14)  # also NaN and Infinity
    text = F.format_string("%.15g", x).cast("decimal(38,15)")
    return F.round(F.when(large | near_tie, text).otherwise(x.cast("decimal(38,15)")), scale).cast(
        f"decimal(18,{scale})")


def money_sum(c: Column | str) -> Column:
    """Exact sum of an amount, typed ``decimal(38,6)``; rounded by no one yet."""
    return F.sum(_c(c).cast("decimal(38,6)")).cast("decimal(38,6)")


def money_2dp(c: Column) -> Column:
    """An exact sum rounded once, HALF_UP, to 2 decimals."""
    return F.round(c, 2).cast("decimal(38,2)")


def _int_div(a: Column, b: Column) -> Column:
    # Spark's IntegralDivide (`a div b`): exact on decimals, bigint result.
    return F.call_function("div", a, b)


def _units_to_2dp(num: Column, den: Column) -> Column:
    """round(num / den) half away from zero, as hundredths -> decimal(18,2).
    ``num`` and ``den`` are integral decimals; NULL unless den > 0."""
    q = _int_div((F.abs(num) * 2 + den).cast("decimal(38,0)"),
                 (den * 2).cast("decimal(38,0)"))
    signed = F.when(num < 0, -q).otherwise(q)
    cents = F.when(den > 0, signed)
    return (cents.cast("decimal(18,0)") * F.lit(0.01).cast("decimal(3,2)")).cast(RESULT_DECIMAL)


def exact_mean_2dp(sum_col: Column, count_col: Column, scale: int) -> Column:
    """HALF_UP mean to 2 decimals from a decimal sum with ``scale`` decimals
    and a row count. One rounding step, no doubles. NULL when count is 0."""
    units = (sum_col * (10 ** scale)).cast("decimal(38,0)")
    den = (count_col.cast("decimal(38,0)") * (10 ** scale)).cast("decimal(38,0)")
    return _units_to_2dp((units * 100).cast("decimal(38,0)"), den)


def round_exact_ratio_2dp(num_col: Column, den_col: Column, scale: int,
                          factor: int = 1) -> Column:
    """HALF_UP ``num / den * factor`` to 2 decimals for two decimal sums of
    the same ``scale``. NULL when the denominator is not positive."""
    n = (num_col * (10 ** scale)).cast("decimal(38,0)")
    d = (den_col * (10 ** scale)).cast("decimal(38,0)")
    return _units_to_2dp((n * (100 * factor)).cast("decimal(38,0)"), d)
