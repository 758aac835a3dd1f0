"""Numeric column helpers (J: round, percentages, safe divide, clip, money sums).

Averages and shares of integer columns are rounded *exactly*: the quotient of two
integer aggregates is rounded half away from zero on decimals, so results do not
depend on float summation order or on how an engine rounds a double that prints
as ``x.xx5``.  All helpers are plain Column expressions (codegen, no UDF).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_DEC = "decimal(38,0)"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def idiv(a: Column | str, b: Column | str | int) -> Column:
    """Exact floor division of integral columns (``a div b``) as long, for b > 0."""
    a = _col(a).cast(_DEC)
    b = (F.lit(b) if isinstance(b, int) else _col(b)).cast(_DEC)
    return ((a - F.pmod(a, b)) / b).cast("long")


def round_ratio(num: Column | str, den: Column | str, digits: int) -> Column:
    """``round(num / den, digits)`` computed exactly on integers; NULL when den is 0 or NULL."""
    num, den = _col(num), _col(den)
    scale = 10 ** digits
    n = F.abs(num.cast(_DEC)) * F.lit(2 * scale).cast(_DEC) + F.abs(den.cast(_DEC))
    d = F.abs(den.cast(_DEC)) * F.lit(2).cast(_DEC)
    q = ((n - F.pmod(n, d)) / d).cast(_DEC)  # exact: the division has no remainder
    signed = F.when((num < 0) != (den < 0), -q).otherwise(q)
    return F.when(den.isNull() | (den == 0), F.lit(None).cast("double")).otherwise(
        signed.cast("double") / F.lit(float(scale))
    )


def avg_rounded(c: Column | str, digits: int) -> Column:
    """``ROUND(AVG(int_col), digits)`` as one aggregate expression."""
    c = _col(c)
    return round_ratio(F.sum(c), F.count(c), digits)


def pct_rounded(part: Column, whole: Column, digits: int) -> Column:
    """``ROUND(100.0 * part / whole, digits)`` for integer aggregates."""
    return round_ratio(part.cast(_DEC) * F.lit(100).cast(_DEC), whole, digits)


# Money columns are declared to have at most this many decimals (prices have 2, tests go to 4).
MONEY_DECIMALS = 4
_MONEY_UNIT = 10 ** MONEY_DECIMALS


def money_units(c: Column | str) -> Column:
    """Money column (a double) as a whole number of its declared smallest unit; raises if it does not fit.

    Nothing is rounded per row: a value with more than ``MONEY_DECIMALS`` decimals is an error.
    """
    scaled = _col(c) * F.lit(float(_MONEY_UNIT))
    whole = F.rint(scaled)
    fits = F.abs(scaled - whole) <= F.greatest(F.lit(1e-3), F.abs(scaled) * F.lit(1e-12))
    too_fine = F.raise_error(F.lit(f"money value with more than {MONEY_DECIMALS} decimals")).cast("double")
    return F.when(scaled.isNull() | fits, whole).otherwise(too_fine).cast("long")


def money_sum(c: Column | str) -> Column:
    """Exact, order-independent SUM of a money column, in its smallest unit."""
    return F.sum(money_units(c))


def money_rounded(total_units: Column, digits: int) -> Column:
    """A :func:`money_sum` rendered as currency, rounded once to ``digits`` (0 or 2)."""
    return round_ratio(total_units, F.lit(_MONEY_UNIT), digits)


def avg_money_rounded(c: Column | str, digits: int = 2) -> Column:
    """``ROUND(AVG(money), digits)`` from the exact sum; NULLs ignored like AVG."""
    c = _col(c)
    return round_ratio(money_sum(c), F.count(c) * F.lit(_MONEY_UNIT), digits)


def safe_div(a: Column, b: Column) -> Column:
    """``a / NULLIF(b, 0)`` (ANSI-safe)."""
    return F.when(b == 0, F.lit(None).cast("double")).otherwise(a.cast("double") / b.cast("double"))


def clip_lower(c: Column | str, lo: float = 0.0) -> Column:
    """``np.clip(x, lo, None)``."""
    return F.greatest(_col(c), F.lit(lo))


def clip_upper(c: Column | str, hi) -> Column:
    """``Series.clip(upper=hi)``."""
    return F.least(_col(c), F.lit(hi))
