"""Column helpers: Columns in, Columns out, all JVM-side built-ins.

They pin down semantics that differ between engines (truncating decimal
conversion, guarded ratios, IEEE annualisation with a zero-day span).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def trunc_scaled(x: ColumnOrName, scale: int = 2) -> Column:
    """Truncate a double toward zero at ``scale`` decimals, returned as an
    integer count of 10**-scale units (e.g. cents for scale 2).

    A plain ``cast('decimal(18,2)')`` rounds (0.129 -> 0.13); the scoring
    rules truncate (0.129 -> 0.12). The product is taken in binary floating
    point first, so 0.29 gives 28 units, as in any IEEE engine.
    """
    return (_col(x) * F.lit(float(10**scale))).cast("bigint")


def trunc_decimal(x: ColumnOrName, scale: int = 2) -> Column:
    """``trunc_scaled`` as a ``DECIMAL(18, scale)`` value."""
    return units_to_decimal(trunc_scaled(x, scale), scale, precision=18)


def units_to_decimal(units: ColumnOrName, scale: int = 2, precision: int = 38,
                     digits: int | None = None) -> Column:
    """Exact ``DECIMAL(precision, digits)`` from an integer count of 10**-scale
    units; ``digits`` defaults to ``scale``."""
    return (
        _col(units).cast(f"decimal({precision},0)") / F.lit(10**scale)
    ).cast(f"decimal({precision},{scale if digits is None else digits})")


def money(units: ColumnOrName, scale: int = 2) -> Column:
    """A valuation: price decimals times token decimals, ``DECIMAL(38, 2*scale)``."""
    return units_to_decimal(units, scale, digits=2 * scale)


# Products are refused from here on: the next double below 2**63.
_BIGINT_LIMIT = 9.2e18


def _or_fail(result: Column, x: Column, y: Column) -> Column:
    """``result``; an error if it is NULL although neither operand is."""
    failed = F.raise_error(F.lit("amount exceeds 64 bits")).cast("bigint")
    return F.coalesce(result, F.when(x.isNotNull() & y.isNotNull(), failed))


def checked_product(a: ColumnOrName, b: ColumnOrName) -> Column:
    """BIGINT product that fails instead of wrapping, whatever the session's ANSI
    setting. It names its operands twice: pass columns, not long expressions."""
    x, y = _col(a), _col(b)
    return _or_fail(F.try_multiply(x, y), x, y)


def checked_sum(a: ColumnOrName, b: ColumnOrName) -> Column:
    """BIGINT sum that fails instead of wrapping, whatever the ANSI setting."""
    x, y = _col(a), _col(b)
    return _or_fail(F.try_add(x, y), x, y)


def checked_bigint(x: ColumnOrName) -> Column:
    """A decimal as BIGINT; fails instead of wrapping."""
    v = _col(x)
    return F.when(F.abs(v.cast("double")) >= _BIGINT_LIMIT, F.raise_error(
        F.lit("amount exceeds 64 bits")).cast("bigint")).otherwise(v.cast("bigint"))


def safe_ratio(n: ColumnOrName, d: ColumnOrName) -> Column:
    """``n / d`` in double, NULL when ``d`` is 0 (no ANSI error)."""
    return F.try_divide(_col(n).cast("double"), _col(d).cast("double"))


def ratio_or_zero(n: ColumnOrName, d: ColumnOrName) -> Column:
    """``if(d != 0, n / d, 0)`` in double."""
    return (
        F.when(_col(d) != 0, _col(n).cast("double") / _col(d).cast("double"))
        .otherwise(F.lit(0.0))
    )


def sum_if(cond: Column, x: ColumnOrName) -> Column:
    """Conditional sum that is 0, not NULL, when no row matches."""
    return F.coalesce(F.sum(F.when(cond, _col(x))), F.lit(0).cast("bigint"))


def day_diff(start: ColumnOrName, end: ColumnOrName) -> Column:
    """Calendar days between two timestamps (day boundaries crossed), so
    23:00 -> 01:00 next day is 1, not 0."""
    return F.datediff(F.to_date(_col(end)), F.to_date(_col(start)))


def annualise(growth: ColumnOrName, days: ColumnOrName, year_days: int = 365) -> Column:
    """``pow(growth, year_days / days)`` with IEEE semantics for ``days = 0``.

    ``year_days / 0`` is +inf, and ``pow(x, +inf)`` is 0 for |x| < 1, 1 for
    |x| = 1 and +inf for |x| > 1 (NaN stays NaN). Spark's ``power`` gives NaN
    for ``pow(±1, inf)`` and ANSI division raises on 0, so the zero-day case
    is spelled out.
    """
    x = _col(growth).cast("double")
    d = _col(days)
    zero_span = (
        F.when(F.isnan(x), F.lit(float("nan")))
        .when(F.abs(x) == 1.0, F.lit(1.0))
        .when(F.abs(x) < 1.0, F.lit(0.0))
        .otherwise(F.lit(float("inf")))
    )
    return F.when(d == 0, zero_span).otherwise(
        F.power(x, F.lit(float(year_days)) / d.cast("double"))
    )


def latest(order: list[ColumnOrName], values: list[ColumnOrName]) -> Column:
    """Aggregate: the ``values`` of the row with the greatest ``order``
    (lexicographic), as one struct, so every field comes from the same row.
    Fields are named after the columns; NULL rows are skipped."""
    fields = [_col(c) for c in order] + [_col(c) for c in values]
    return F.max(F.struct(*fields))


__all__ = [
    "annualise",
    "checked_bigint",
    "checked_product",
    "checked_sum",
    "day_diff",
    "latest",
    "money",
    "ratio_or_zero",
    "safe_ratio",
    "sum_if",
    "trunc_decimal",
    "trunc_scaled",
    "units_to_decimal",
]
