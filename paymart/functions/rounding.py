"""Exact ratio and average rounding as Column expressions.

Marts round ``n * 100 / d`` and ``avg(amount)`` half away from zero on exact
decimals.  Rounding a double instead disagrees between engines on ties
(1.005), so every rounded ratio here is computed from integers with an
integral division - identical in every engine - and only the final
``k / 10^digits`` is a double.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def idiv(a: Column, b: Column) -> Column:
    """SQL integral division (``a div b``), truncating toward zero."""
    return F.call_function("div", a, b)


def _round_quotient(num: Column, den: Column, digits: int) -> Column:
    """``round(num / den, digits)`` half away from zero, as a double.

    ``num`` is an exact number (integer or decimal without fractional part
    after scaling), ``den`` a positive integer; NULL when ``den`` is 0 or NULL.
    """
    scale = 10 ** digits
    d = F.nullif(den.cast("long"), F.lit(0))
    two_d = d * 2
    pos = idiv(num * (2 * scale) + d, two_d)
    neg = -idiv(-num * (2 * scale) + d, two_d)
    q = F.when(num < 0, neg).otherwise(pos)
    return q.cast("double") / F.lit(scale)


def pct(num: Column, den: Column, digits: int = 2) -> Column:
    """``round(num * 100.0 / nullif(den, 0), digits)`` for integer counts."""
    return _round_quotient(num.cast("decimal(38,0)") * 100, den, digits)


def ratio(num: Column, den: Column, digits: int = 2) -> Column:
    """``round(num * 1.0 / nullif(den, 0), digits)`` for integer counts."""
    return _round_quotient(num.cast("decimal(38,0)"), den, digits)


def round_avg_money(total: Column, n: Column, digits: int = 2) -> Column:
    """``round(avg(amount), digits)`` from ``sum(amount)`` (2-decimal money)
    and ``count(amount)``; the sum is scaled to integer cents first."""
    cents = (total * 100).cast("decimal(38,0)")
    return _round_quotient(cents, n.cast("long") * 100, digits)


def round_avg_int(total: Column, n: Column, digits: int = 2) -> Column:
    """``round(avg(x), digits)`` of an integer column from its sum and count."""
    return _round_quotient(total.cast("decimal(38,0)"), n, digits)


def round_double(x: Column, digits: int = 2) -> Column:
    """Half-up rounding of a non-negative double with plain IEEE steps
    (``floor(x * 10^k + 0.5) / 10^k``), reproducible in any engine."""
    scale = 10 ** digits
    return F.floor(x * F.lit(float(scale)) + F.lit(0.5)).cast("double") / F.lit(float(scale))


def safe_ratio(num: Column, den: Column) -> Column:
    """KPI-catalogue division: ``num / den`` as a double, 0 on a zero or NULL
    denominator (unlike the marts, which return NULL)."""
    d = den.cast("double")
    return F.when(d.isNull() | (d == 0), F.lit(0.0)).otherwise(num.cast("double") / d)


def money(x: Column) -> Column:
    """Decimal money column emitted as a double (exact for cents < 2^53)."""
    return x.cast("double")
