"""Exact aggregate expressions over money.

Amounts are added up as whole cents and squares as decimals, so a result does
not depend on the order in which partitions are merged, and every moment can be
combined from partial aggregates.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

CENTS = "amount_cents"


def cents(name: str) -> Column:
    """Whole cents of a money column."""
    return F.round(F.col(name) * 100).cast("bigint")


def square(value: Column) -> Column:
    exact = value.cast("decimal(19,0)")
    return (exact * exact).cast("decimal(38,0)")


def count_if(condition: Column) -> Column:
    """Rows for which the condition is true; nulls count as not true."""
    return F.coalesce(F.count_if(condition), F.lit(0))


def ratio(part: Column, whole: Column) -> Column:
    return part.cast("double") / F.nullif(whole, F.lit(0))


def percent(part: Column, whole: Column, digits: int = 2) -> Column:
    """``100 * part / whole`` rounded half up to ``digits`` in whole-number arithmetic."""
    scale = 10 ** (digits + 2)
    return (rounded(part * scale, whole)) / F.lit(10 ** digits)


def whole_div(value: Column, by: Column) -> Column:
    return F.call_function("div", value, by)


def rounded(value: Column, by: Column) -> Column:
    """Non-negative ``value / by`` rounded half up to a whole number; null for ``by = 0``."""
    return whole_div(2 * value + by, F.nullif(2 * by, F.lit(0)))


def money(total_cents: Column) -> Column:
    return total_cents / F.lit(100)


def total(name: str = CENTS) -> Column:
    return money(F.sum(name))


def total_if(condition: Column, name: str = CENTS) -> Column:
    return money(F.sum(F.when(condition, F.col(name)).otherwise(0)))


def average(sum_cents: Column, n: Column) -> Column:
    return sum_cents / F.lit(100) / F.nullif(n, F.lit(0))


def mean(name: str = CENTS) -> Column:
    return average(F.sum(name), F.count(name))


def mean_rounded(name: str = CENTS) -> Column:
    """Mean money amount, rounded half up to the cent (non-negative amounts)."""
    return rounded(F.sum(name), F.count(name)) / F.lit(100)


def co_moment(n: Column, sx: Column, sy: Column, sxy: Column) -> Column:
    """``n Σxy - Σx Σy`` of whole numbers from their exact sums, rounded once to a double.

    Where 38 digits do not hold the products, the sums are first centred on whole means, so two large numbers are still
    not subtracted after rounding.
    """
    n, sx, sy, sxy = (c.cast("decimal(38,0)") for c in (n, sx, sy, sxy))
    exact = F.try_subtract(F.try_multiply(n, sxy), F.try_multiply(sx, sy))
    x0, y0 = (whole_div(s, F.nullif(n, F.lit(0))).cast("decimal(19,0)") for s in (sx, sy))
    centred = sxy - x0 * sy - y0 * sx + n * x0 * y0
    rest = (sx - n * x0).cast("double") * (sy - n * y0).cast("double")
    return F.coalesce(exact.cast("double"), n.cast("double") * centred.cast("double") - rest)


def spread(n: Column, s1: Column, s2: Column) -> Column:
    """``n Σx² - (Σx)²`` from count, sum and sum of squares."""
    return co_moment(n, s1, s1, s2)


def deviation_of(n: Column, spread_: Column, sample: bool = True) -> Column:
    """Standard deviation in money from the count and ``spread``; null below two rows."""
    divisor = n.cast("double") * (n - 1 if sample else n)
    spread_ = F.when(spread_ < 0, F.lit(0.0)).otherwise(spread_)
    return F.when(n >= (2 if sample else 1), F.sqrt(spread_ / F.nullif(divisor, F.lit(0.0))) / 100)


def deviation(n: Column, s1: Column, s2: Column, sample: bool = True) -> Column:
    """Standard deviation in money from count, sum and sum of squares of cents; null below two rows."""
    return deviation_of(n, spread(n, s1, s2), sample)


def stdev(name: str = CENTS, sample: bool = True) -> Column:
    return deviation(F.count(name), F.sum(name), F.sum(square(F.col(name))), sample)
