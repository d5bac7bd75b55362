"""Checks of the gold tables: one aggregate per table, results as rows."""

from __future__ import annotations

import dataclasses
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meetmart.functions.measures import per_unit
from meetmart.operators.dedupe import repeated_keys
from meetmart.schemas import MARTS

COMPLETE = 0.999  # fixed value: share of non-null values a required column must reach
CPB_TOLERANCE = 0.01  # fixed value: allowed absolute difference of cost per booking
# Columns that must not be negative wherever a table has them.
NON_NEGATIVE = (
    "booking_id", "total_bookings", "total_spend", "cpb", "meetings", "avg_meetings_per_week",
)
RESULT = "table_name string, check_name string, column_name string, value double, passed boolean, dt string"


@dataclasses.dataclass(frozen=True)
class TableRules:
    required: Sequence[str]
    not_null: Sequence[str]
    unique: Sequence[str] = ()


def _rules(mart: str, optional: Sequence[str] = (), unique: Sequence[str] = ()) -> TableRules:
    names = MARTS[mart].names
    return TableRules(names, [n for n in names if n not in optional], unique)


GOLD_RULES = {
    "bookings_by_source_day": _rules(
        "bookings_by_source_day", unique=("booking_date", "source", "booking_id")
    ),
    "bookings_trend_over_time": _rules("bookings_trend_over_time"),
    "bookings_by_timeslot": _rules("bookings_by_timeslot"),
    "cost_per_booking_by_channel": _rules(
        "cost_per_booking_by_channel", ("total_bookings", "total_spend", "cpb")
    ),
    "channel_attribution_leaderboard": _rules(
        "channel_attribution_leaderboard", ("total_bookings", "spend", "cpb")
    ),
    "meetings_per_employee_week": _rules(
        "meetings_per_employee_week", ("meetings", "avg_meetings_per_week")
    ),
}


class QualityError(RuntimeError):
    """Raised once with every failed check of a run."""


def missing_columns(df: DataFrame, required: Sequence[str]) -> list[str]:
    return [c for c in required if c not in df.columns]


def cpb_off(spend: str = "spend") -> Column:
    """Rows whose stored cost per booking differs from spend / bookings."""
    expected = per_unit(F.col(spend), F.col("total_bookings"))
    return F.coalesce(F.abs(F.col("cpb") - expected) > CPB_TOLERANCE, F.lit(False))


def table_checks(df: DataFrame, name: str, rules: TableRules, day: str) -> DataFrame:
    """Check results of one day of a table, from a single pass over it.

    An empty table fails `not_empty`; its other checks have nothing to object to. Null counts
    as non-negative: completeness is a check of its own.
    """
    rows = F.count(F.lit(1))
    checks: list[tuple[str, str, Column, Column]] = [
        ("not_empty", "", rows.cast("double"), rows > 0)
    ]
    for column in missing_columns(df, rules.required):
        checks.append(("present", column, F.lit(0.0), F.lit(False)))
    for column in rules.not_null:
        if column in df.columns:
            share = F.coalesce(per_unit(F.count(column), rows), F.lit(1.0))
            checks.append(("complete", column, share, share >= COMPLETE))
    for column in NON_NEGATIVE:
        if column in df.columns:
            bad = F.count_if(F.col(column) < 0)
            checks.append(("non_negative", column, bad.cast("double"), bad == 0))
    if {"spend", "total_bookings", "cpb"} <= set(df.columns):
        bad = F.count_if(cpb_off())
        checks.append(("cpb_matches", "cpb", bad.cast("double"), bad == 0))

    found = [
        F.struct(
            F.lit(check).alias("check_name"),
            F.lit(column).alias("column_name"),
            value.cast("double").alias("value"),
            passed.alias("passed"),
        )
        for check, column, value, passed in checks
    ]
    return (
        df.where(F.col("dt") == day)
        .agg(F.array(*found).alias("found"))
        .select(F.lit(name).alias("table_name"), F.inline("found"))
        .withColumn("dt", F.lit(day))
    )


def uniqueness_check(df: DataFrame, name: str, keys: Sequence[str], day: str) -> DataFrame:
    """Number of repeated keys of one day; zero passes."""
    repeated = repeated_keys(df.where(F.col("dt") == day), keys)
    return repeated.agg(F.count(F.lit(1)).cast("double").alias("value")).select(
        F.lit(name).alias("table_name"),
        F.lit("unique").alias("check_name"),
        F.lit(",".join(keys)).alias("column_name"),
        "value",
        (F.col("value") == 0).alias("passed"),
        F.lit(day).alias("dt"),
    )


def latest_day(tables: Mapping[str, DataFrame]) -> str | None:
    """Newest `dt` of the first table; all tables are checked for that day."""
    first = next(iter(tables.values()))
    return first.agg(F.max("dt")).first()[0]


def gold_checks(
    tables: Mapping[str, DataFrame],
    day: str,
    rules: Mapping[str, TableRules] = GOLD_RULES,
    uniqueness: bool = True,
) -> DataFrame:
    parts = [table_checks(tables[name], name, r, day) for name, r in rules.items()]
    if uniqueness:
        parts += [
            uniqueness_check(tables[name], name, r.unique, day)
            for name, r in rules.items()
            if r.unique
        ]
    return reduce(DataFrame.unionByName, parts)


def failed(checks: DataFrame) -> DataFrame:
    return checks.where(~F.col("passed"))


def raise_on_failure(checks: DataFrame) -> None:
    """The rows are one per check, so the failed ones may come to the driver."""
    rows = failed(checks).collect()
    if rows:
        lines = [f"{r.table_name}: {r.check_name}({r.column_name}) = {r.value}" for r in rows]
        raise QualityError("quality checks failed: " + "; ".join(sorted(lines)))


def empty_results(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], RESULT)
