"""Text forms for report tables; apply them last, on small results."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BLANK = "—"


def money_text(amount: Column) -> Column:
    return F.coalesce(F.concat(F.lit("$"), F.format_number(amount, 2)), F.lit(BLANK))


def decimal_text(number: Column) -> Column:
    return F.coalesce(F.format_number(number, 2), F.lit(BLANK))


def count_text(number: Column) -> Column:
    return F.coalesce(F.format_number(number, 0), F.lit(BLANK))
