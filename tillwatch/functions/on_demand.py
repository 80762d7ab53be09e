"""On-demand features: values computed at read time from view and request columns.

Inputs are widened to double first, as 32-bit inputs and integers are declared as 64-bit outputs.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

Inputs = Callable[[str], Column]

CONVERSION_WEIGHT = 0.6
ACCEPTANCE_WEIGHT = 0.4


def conversion_plus(request: str) -> Callable[[Inputs], Column]:
    return lambda x: x("conv_rate") + x(request)


def acceptance_gap(x: Inputs) -> Column:
    return x("acc_rate") - x("conv_rate")


def realtime_efficiency(x: Inputs) -> Column:
    return x("avg_daily_trips") * x("acc_rate")


def combined_rating(x: Inputs) -> Column:
    return x("conv_rate") * F.lit(CONVERSION_WEIGHT) + x("acc_rate") * F.lit(ACCEPTANCE_WEIGHT)


def performance_score(x: Inputs) -> Column:
    return combined_rating(x) * F.log1p(x("avg_daily_trips"))
