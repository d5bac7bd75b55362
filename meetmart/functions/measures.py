"""Measures shared by marts, serving queries and checks."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Six decimals hold micro-currency amounts exactly, so totals do not depend on the
# order in which tasks deliver their partial sums. Amounts that do not fit (NaN, infinity,
# 1e22 and more) count as unknown and are left out, a total that does not fit is unknown.
MONEY = "decimal(28,6)"


def money_total(amount: Column) -> Column:
    return F.try_sum(amount.try_cast(MONEY)).cast("double")


def per_unit(total: Column, units: Column) -> Column:
    """total / units, null where there are no units."""
    return F.when(units > 0, total / units)


def or_zero(amount: Column) -> Column:
    return F.coalesce(amount, F.lit(0.0))
