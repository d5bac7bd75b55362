"""Report queries over the gold marts. Each takes a mart already cut to the wanted days.

The marts hold numbers of meetings in a column called `booking_id`. The reports add them up;
the `_asis` forms count its distinct values, as the first reports did.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from meetmart.functions.measures import money_total, per_unit
from meetmart.functions.timeparts import weekday_index
from meetmart.sources.readers import between_days, day_bounds


def date_bounds(mart: DataFrame) -> DataFrame:
    """First and last day of any frame, by a scan of its days; of a stored mart, `stored_date_bounds` needs none."""
    return mart.agg(F.min("dt").alias("min_dt"), F.max("dt").alias("max_dt"))


def stored_date_bounds(spark: SparkSession, path: str) -> DataFrame:
    """`date_bounds` of a stored mart, from the listing of its partitions."""
    return spark.createDataFrame([day_bounds(spark, path)], "min_dt string, max_dt string")


def for_days(mart: DataFrame, first: str | None = None, last: str | None = None) -> DataFrame:
    """Mart cut to a range of days; without a range to its latest day, as marts of several
    days each hold the whole history of their load and must not be added up blindly.

    The latest day is found inside the plan: nothing runs before the result is asked for. For a stored mart
    `readers.read_shown_days` takes it from the listing instead and reads no other partition.
    """
    if first is None and last is None:
        newest = mart.agg(F.max("dt").alias("dt"))  # one row
        return mart.join(newest, "dt", "left_semi").select(*mart.columns)
    return between_days(mart, first, last)


def latest_rows(table: DataFrame, n: int = 5) -> DataFrame:
    """The n newest rows by `dt`; the other columns make the cut repeatable."""
    rest = [F.col(c).asc_nulls_last() for c in table.columns if c != "dt"]
    return table.orderBy(F.desc("dt"), *rest).limit(n)


def _bookings(asis: bool) -> Column:
    counted = F.countDistinct("booking_id") if asis else F.sum("booking_id")
    return counted.alias("bookings")


# ---- daily bookings and trend


def daily_bookings(mart: DataFrame, asis: bool = False) -> DataFrame:
    return (
        mart.groupBy("booking_date", "source").agg(_bookings(asis)).orderBy("booking_date", "source")
    )


def daily_bookings_kpis(daily: DataFrame) -> DataFrame:
    return daily.agg(
        F.sum("bookings").alias("total_bookings"),
        F.countDistinct("booking_date").alias("active_days"),
        F.countDistinct("source").alias("active_sources"),
    )


def bookings_trend(mart: DataFrame, asis: bool = False) -> DataFrame:
    """Daily bookings with their running total per source; a source has one row per day."""
    so_far = (
        Window.partitionBy("source")
        .orderBy("booking_date")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    daily = mart.groupBy("booking_date", "source").agg(_bookings(asis))
    return daily.withColumn("cumulative_bookings", F.sum("bookings").over(so_far)).orderBy(
        "booking_date", "source"
    )


# ---- cost per booking


def channel_costs(mart: DataFrame) -> DataFrame:
    return (
        mart.groupBy("channel")
        .agg(
            money_total(F.col("total_spend")).alias("total_spend"),
            F.sum("total_bookings").alias("total_bookings"),
        )
        .withColumn("cpb", per_unit(F.col("total_spend"), F.col("total_bookings")))
        .orderBy(F.col("cpb").asc_nulls_last(), F.desc("total_bookings"), "channel")
    )


def channel_cost_kpis(costs: DataFrame) -> DataFrame:
    totals = costs.agg(
        F.sum("total_bookings").alias("total_bookings"),
        money_total(F.col("total_spend")).alias("total_spend"),
    )
    return totals.withColumn("average_cpb", per_unit(F.col("total_spend"), F.col("total_bookings")))


# ---- attribution


def source_leaderboard(mart: DataFrame, asis: bool = False) -> DataFrame:
    """Bookings and cost per source, best first.

    The mart repeats a channel's spend on each of its campaigns: it counts once per day here,
    while the `asis` form adds up every repetition.
    """
    if asis:
        per_day = mart.select("source", "total_bookings", "spend")
    else:
        per_day = mart.groupBy("source", "dt").agg(
            F.sum("total_bookings").alias("total_bookings"), F.max("spend").alias("spend")
        )
    return (
        per_day.groupBy("source")
        .agg(
            F.sum("total_bookings").alias("total_bookings"),
            money_total(F.col("spend")).alias("total_spend"),
        )
        .withColumn("cpb", per_unit(F.col("total_spend"), F.col("total_bookings")))
        .orderBy(F.desc("total_bookings"), F.col("cpb").asc_nulls_last(), "source")
    )


def source_campaigns(mart: DataFrame) -> DataFrame:
    return (
        mart.groupBy("source", "campaign")
        .agg(
            F.sum("total_bookings").alias("total_bookings"),
            money_total(F.col("spend")).alias("total_spend"),
        )
        .withColumn("cpb", per_unit(F.col("total_spend"), F.col("total_bookings")))
    )


def cost_pivot(campaigns: DataFrame, values: Sequence[str] | None = None) -> DataFrame:
    """Mean cost by source (rows) and campaign (columns); sources without any cost are left out.

    Without `values` every campaign that has a cost is a column; finding them runs a job while the plan is made.
    Spark refuses more than `spark.sql.pivotMaxValues` of them instead of dropping any.
    """
    priced = campaigns.where("cpb IS NOT NULL").groupBy("source")
    table = priced.pivot("campaign") if values is None else priced.pivot("campaign", list(values))
    return table.agg(F.avg("cpb")).orderBy("source")


def pivot_cells(table: DataFrame, key: str, column: str, value: str) -> DataFrame:
    """A pivot as one row per cell; cells without a value stay, as nulls."""
    cells = [F.col(f"`{c.replace('`', '``')}`") for c in table.columns if c != key]
    return table.unpivot([key], cells, column, value)


def top_sources(leaderboard: DataFrame, n: int = 10) -> DataFrame:
    return leaderboard.orderBy(
        F.desc("total_bookings"), F.col("cpb").asc_nulls_last(), "source"
    ).limit(n)


# ---- time slots


def timeslots(mart: DataFrame, asis: bool = False) -> DataFrame:
    return mart.groupBy("hour_of_day", "day_of_week", "source").agg(_bookings(asis))


def weekday_hour_cells(slots: DataFrame) -> DataFrame:
    """Bookings by weekday and hour in calendar order."""
    return (
        slots.groupBy("day_of_week", "hour_of_day")
        .agg(F.sum("bookings").alias("bookings"))
        .orderBy(weekday_index(F.col("day_of_week")), "hour_of_day")
    )


def bookings_by_hour(slots: DataFrame) -> DataFrame:
    return (
        slots.groupBy("hour_of_day").agg(F.sum("bookings").alias("bookings")).orderBy("hour_of_day")
    )


def weekday_share(slots: DataFrame) -> DataFrame:
    """Bookings by weekday and their share; the unpartitioned window sees at most eight rows."""
    by_day = slots.groupBy("day_of_week").agg(F.sum("bookings").alias("bookings"))
    total = F.sum("bookings").over(Window.partitionBy(F.lit(1)))
    return by_day.withColumn("share", per_unit(F.col("bookings"), total)).orderBy(
        weekday_index(F.col("day_of_week"))
    )


# ---- meetings per host


def host_meetings(mart: DataFrame) -> DataFrame:
    return (
        mart.groupBy("host_user_name")
        .agg(
            F.sum("meetings").alias("total_meetings"),
            F.avg(F.col("avg_meetings_per_week").cast("double")).alias("avg_meetings"),
        )
        .orderBy(F.desc("total_meetings"), "host_user_name")
    )


def by_mean_meetings(hosts: DataFrame) -> DataFrame:
    return hosts.orderBy(F.desc("avg_meetings"), "host_user_name")


def host_meeting_kpis(hosts: DataFrame) -> DataFrame:
    return hosts.agg(
        F.sum("total_meetings").alias("total_meetings"),
        F.max("total_meetings").alias("max_meetings"),
        F.min("total_meetings").alias("min_meetings"),
        F.avg("avg_meetings").alias("mean_week"),
    )
