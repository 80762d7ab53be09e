"""Amount arithmetic as Columns."""

from __future__ import annotations

from pyspark.sql import Column, WindowSpec
from pyspark.sql import functions as F

IQR_FENCE = 1.5


def lower_fence(q1: Column, q3: Column) -> Column:
    return q1 - F.lit(IQR_FENCE) * (q3 - q1)


def upper_fence(q1: Column, q3: Column) -> Column:
    return q3 + F.lit(IQR_FENCE) * (q3 - q1)


def impute_and_cap(amount: Column, median: Column, lower: Column, upper: Column) -> Column:
    """Not positive -> median, else clipped to the fences; NULL stays NULL, NaN is above ``upper``."""
    return (F.when(amount <= 0, median)
            .when(amount < lower, lower)
            .when(amount > upper, upper)
            .otherwise(amount))


def safe_ratio(amount: Column, average: Column) -> Column:
    """``amount / average`` with 1.0 in place of an average that is not positive."""
    return amount / F.when(average <= 0, F.lit(1.0)).otherwise(average)


#: Amounts in decimals: below 10^12, six places.
MONEY = "decimal(18,6)"


def as_money(amount: Column) -> Column:
    """The decimal that the double stands for; NULL where ``MONEY`` cannot hold it without rounding."""
    exact = amount.try_cast(MONEY)
    return F.when(exact.cast("double") == amount, exact)


def exact_sum(amount: Column, window: WindowSpec | None = None) -> Column:
    """Sum as a double, the same in any order of the rows: added in decimals, and rounded once at the end.

    Where an amount is no decimal of ``MONEY`` (NaN, very large, more places), doubles are added.
    """
    def over(column: Column) -> Column:
        return column if window is None else column.over(window)

    money = as_money(amount)
    whole = over(F.count(money)) == over(F.count(amount))
    return F.when(whole, over(F.sum(money)).cast("double")).otherwise(over(F.sum(amount)))


def above_mean(amount: Column, times: int, total: Column, count: Column) -> Column:
    """``amount > times * total / count`` without division, in decimals: an amount right at the limit is not above it."""
    left, right = as_money(amount) * count.cast("decimal(18,0)"), as_money(total) * F.lit(times).cast("decimal(9,0)")
    plain = amount > times * F.try_divide(total, count)
    return F.when(count > 0, F.coalesce(left > right, plain))
