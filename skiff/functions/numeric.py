"""Exact arithmetic helpers.

Money and measures stay DECIMAL inside plans: sums are exact and independent of
row order (so a 1000-task aggregation returns the same digits as a 1-task one),
and ``round`` on DECIMAL is HALF_UP on the exact value. Doubles appear only at
the edge of a plan (``plans.output.edge``).
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

# Money as it is loaded: 6 decimals, so nothing is rounded before results are; 18 digits
# are the widest that Spark keeps in a long.
MONEY = "decimal(18,6)"
# Accumulator type for averages (exact sums of measures with up to 8 decimals).
MEAN_ACC = "decimal(26,8)"


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def rounded_quotient(num: Column | str, den: Column | str, scale: int = 2) -> Column:
    """``round(num / den, scale)``, half away from zero, computed EXACTLY for DECIMAL
    or integer inputs; NULL when ``den`` is 0 or either side is NULL.

    ``round(num / den, scale)`` on DECIMALs would first round the quotient to the
    division's result scale — as few as 6 digits once the declared precisions are
    large, as they are for sums — and then round again, so a quotient just below a
    tie (x.xx5) can come out one unit too high. With groups of 10^11 rows or sums of
    10^14 (100 TB) that is reachable. Here, with DECIMAL ``%`` exact:
      rest  = |num| % |den|                          (exact, in [0, |den|))
      whole = (|num| - rest) / |den|                 (an exact integer)
      frac  = (2·rest·10^scale + |den|) div (2·|den|)  (integral division, 0..10^scale)
    and the result is ±(whole + frac / 10^scale).
    """
    one = F.lit(Decimal(1))  # integer inputs become DECIMAL, so "/" stays exact
    n, d = _c(num) * one, _c(den) * one
    n_abs, d_abs = F.abs(n), F.abs(d)
    k = 10 ** scale
    rest = n_abs % d_abs
    whole = (n_abs - rest) / d_abs
    frac = F.call_function("div", rest * F.lit(2 * k) + d_abs, d_abs * F.lit(2))
    mag = whole + frac.cast("decimal(38,0)") / F.lit(k).cast("decimal(38,0)")
    sign = F.when((n < 0) != (d < 0), F.lit(-1)).otherwise(F.lit(1))
    return F.when(d != 0, (mag * sign).cast(f"decimal(38,{scale})"))


def exact_mean(col: Column | str, scale: int = 2, acc: str = MEAN_ACC) -> Column:
    """Aggregate: ``round(sum(x) / count(x), scale)``, exact (``rounded_quotient``)."""
    x = _c(col).try_cast(acc)
    return rounded_quotient(F.sum(x), F.count(x), scale)


def percent_of(num: Column | str, den: Column | str, scale: int = 2) -> Column:
    """``round(num / den * 100, scale)``, exact; NULL when ``den`` is 0."""
    return rounded_quotient(_c(num) * F.lit(100), den, scale)


def row_percent_of(num: Column | str, den: Column | str, scale: int = 2) -> Column:
    """Per-row ``round(num / den * 100, scale)`` for two MONEY values (e.g. a line's
    profit margin), on Spark's decimal division: the quotient keeps 16 fractional
    digits, and a quotient that is not a tie lies at least 1 / (200 · |den in
    millionths|) from one, so the single rounding is exact for every
    |den| < 5·10^7. Cheaper than ``percent_of`` on hundreds of millions of rows;
    use ``percent_of`` for aggregated (unbounded) denominators."""
    return F.round(F.try_divide(_c(num) * F.lit(100), _c(den)), scale)


def ratio(num: Column | str, den: Column | str, scale: int = 2) -> Column:
    """``round(num / den, scale)``, exact; NULL when ``den`` is 0."""
    return rounded_quotient(num, den, scale)


def sql_rounded_quotient(num: str, den: str, scale: int = 2) -> str:
    """``rounded_quotient`` as Spark SQL text (for the SQL forms of the queries)."""
    k = 10 ** scale
    one = "CAST(1 AS DECIMAL(1,0))"  # integer inputs become DECIMAL, so "/" stays exact
    n, d = f"abs(({num}) * {one})", f"abs(({den}) * {one})"
    rest = f"({n} % {d})"
    mag = (
        f"(({n} - {rest}) / {d} + CAST((2 * {k} * {rest} + {d}) div (2 * {d}) AS DECIMAL(38,0))"
        f" / CAST({k} AS DECIMAL(38,0)))"
    )
    sign = f"(CASE WHEN ({num} < 0) <> ({den} < 0) THEN -1 ELSE 1 END)"
    return f"(CASE WHEN {den} <> 0 THEN CAST({mag} * {sign} AS DECIMAL(38,{scale})) END)"
