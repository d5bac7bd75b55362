"""Gold marts: counts of distinct meetings by several keys, joined with spend where it applies.

Every mart takes silver events and, if `run_date` is given, stamps all rows with it; without it
the marts are computed per `dt`, so one job can fill many days.

Distinct counts shuffle on (keys, meeting) after a map-side distinct, hence neither a dominant
channel nor a meeting with very many invitees ends up in one task.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meetmart.functions.channels import known_channel, spend_channel
from meetmart.functions.measures import money_total, or_zero, per_unit
from meetmart.functions.timeparts import day, weekday_short

# mart -> keys its meetings are counted by
MART_KEYS = {
    "bookings_by_source_day": ("booking_date", "source"),
    "cost_per_booking_by_channel": ("source",),
    "channel_attribution_leaderboard": ("source", "campaign"),
    "bookings_by_timeslot": ("hour_of_day", "day_of_week", "source"),
    "meetings_per_employee_week": ("host_user_name", "year", "week_of_year"),
}
ALL_KEYS = tuple(dict.fromkeys(key for keys in MART_KEYS.values() for key in keys))


def _stamped(df: DataFrame, run_date: str | None) -> DataFrame:
    return df if run_date is None else df.withColumn("dt", F.lit(run_date))


def key_columns() -> dict[str, Column]:
    return {
        "booking_date": F.col("booking_date"),
        "source": known_channel(F.col("channel")),
        "campaign": F.col("event_type_id"),
        "hour_of_day": F.hour("event_start_local"),
        "day_of_week": weekday_short(F.col("event_start_local")),
        "host_user_name": F.col("host_user_name"),
        "year": F.year("booking_date"),
        "week_of_year": F.weekofyear("booking_date"),
    }


def _aliased(keys: Sequence[str]) -> list[Column]:
    columns = key_columns()
    return [columns[k].alias(k) for k in keys]


def count_meetings(events: DataFrame, mart: str, run_date: str | None = None) -> DataFrame:
    """Distinct meetings by the keys of one mart; a group whose meetings have no uri counts 0."""
    keys = MART_KEYS[mart]
    return (
        _stamped(events, run_date)
        .select("dt", "scheduled_event_uri", *_aliased(keys))
        .groupBy("dt", *keys)
        .agg(F.countDistinct("scheduled_event_uri").alias("meetings"))
    )


def count_meetings_all(events: DataFrame, run_date: str | None = None) -> DataFrame:
    """The counts of every mart in one job, told apart by the column `mart`.

    Each branch scans and shuffles its own few columns only. Grouping sets would scan once, but
    every row would carry all the keys five times through the shuffle; with mostly distinct
    meetings that took more than twice as long.
    """
    types = {f.name: f.dataType for f in events.select(*_aliased(ALL_KEYS)).schema.fields}

    def branch(mart: str) -> DataFrame:
        own = MART_KEYS[mart]
        keys = [F.col(k) if k in own else F.lit(None).cast(types[k]).alias(k) for k in ALL_KEYS]
        counts = count_meetings(events, mart, run_date)
        return counts.select(F.lit(mart).alias("mart"), "dt", *keys, "meetings")

    return reduce(DataFrame.unionByName, [branch(mart) for mart in MART_KEYS])


def counts_of(all_counts: DataFrame, mart: str) -> DataFrame:
    return all_counts.where(F.col("mart") == mart).select("dt", *MART_KEYS[mart], "meetings")


# ---- spend


def spend_by_day_channel(spend: DataFrame) -> DataFrame:
    return spend.groupBy(
        day(F.col("date")).alias("spend_date"),
        spend_channel(F.col("channel")).alias("spend_channel"),
    ).agg(money_total(F.col("spend")).alias("spend_total"))


def spend_by_channel(spend: DataFrame, run_date: str | None = None) -> DataFrame:
    return (
        _stamped(spend, run_date)
        .groupBy("dt", spend_channel(F.col("channel")).alias("source"))
        .agg(money_total(F.col("spend")).alias("total_spend"))
    )


def _with_spend(counts: DataFrame, spend: DataFrame) -> DataFrame:
    """Left join: channels without meetings drop out. The spend side has one row per channel and
    day; adaptive execution broadcasts it if its measured size allows, else it is shuffled."""
    joined = counts.join(spend, ["dt", "source"], "left")
    return joined.withColumn("total_spend", or_zero(F.col("total_spend"))).withColumn(
        "cpb", per_unit(F.col("total_spend"), F.col("meetings"))
    )


def unmatched_spend(
    events: DataFrame, spend: DataFrame, run_date: str | None = None
) -> DataFrame:
    """Spend that reaches no mart because its channel has no meetings (or no name)."""
    counts = count_meetings(events, "cost_per_booking_by_channel", run_date)
    return spend_by_channel(spend, run_date).join(counts, ["dt", "source"], "left_anti")


# ---- counts -> marts


def _daily(counts: DataFrame) -> DataFrame:
    return counts.select("booking_date", "source", F.col("meetings").alias("booking_id"), "dt")


def _cost(counts: DataFrame, spend: DataFrame) -> DataFrame:
    return _with_spend(counts, spend).select(
        F.col("source").alias("channel"),
        "total_spend",
        F.col("meetings").alias("total_bookings"),
        "cpb",
        "dt",
    )


def _attribution(counts: DataFrame, spend: DataFrame) -> DataFrame:
    return _with_spend(counts, spend).select(
        "source",
        "campaign",
        F.col("meetings").alias("total_bookings"),
        F.col("total_spend").alias("spend"),
        "cpb",
        "dt",
    )


def _timeslot(counts: DataFrame) -> DataFrame:
    return counts.select(
        "hour_of_day", "day_of_week", "source", F.col("meetings").alias("booking_id"), "dt"
    )


def _weekly(counts: DataFrame) -> DataFrame:
    return counts.select(
        "host_user_name",
        "year",
        "week_of_year",
        "meetings",
        F.col("meetings").cast("double").alias("avg_meetings_per_week"),
        "dt",
    )


def bookings_by_source_day(events: DataFrame, run_date: str | None = None) -> DataFrame:
    return _daily(count_meetings(events, "bookings_by_source_day", run_date))


def bookings_trend_over_time(events: DataFrame, run_date: str | None = None) -> DataFrame:
    """The same rows as `bookings_by_source_day`; kept as a mart of its own for its readers."""
    return bookings_by_source_day(events, run_date)


def cost_per_booking_by_channel(
    events: DataFrame, spend: DataFrame, run_date: str | None = None
) -> DataFrame:
    """Which bookings and which spend belong together is the caller's choice of frames."""
    counts = count_meetings(events, "cost_per_booking_by_channel", run_date)
    return _cost(counts, spend_by_channel(spend, run_date))


def channel_attribution_leaderboard(
    events: DataFrame, spend: DataFrame, run_date: str | None = None
) -> DataFrame:
    counts = count_meetings(events, "channel_attribution_leaderboard", run_date)
    return _attribution(counts, spend_by_channel(spend, run_date))


def bookings_by_timeslot(events: DataFrame, run_date: str | None = None) -> DataFrame:
    return _timeslot(count_meetings(events, "bookings_by_timeslot", run_date))


def meetings_per_employee_week(events: DataFrame, run_date: str | None = None) -> DataFrame:
    return _weekly(count_meetings(events, "meetings_per_employee_week", run_date))


def marts_from_counts(
    all_counts: DataFrame, spend: DataFrame, run_date: str | None = None
) -> dict[str, DataFrame]:
    """All six marts from the output of `count_meetings_all`."""
    totals = spend_by_channel(spend, run_date)
    counts = {mart: counts_of(all_counts, mart) for mart in MART_KEYS}
    daily = _daily(counts["bookings_by_source_day"])
    return {
        "bookings_by_source_day": daily,
        "bookings_trend_over_time": daily,
        "cost_per_booking_by_channel": _cost(counts["cost_per_booking_by_channel"], totals),
        "channel_attribution_leaderboard": _attribution(
            counts["channel_attribution_leaderboard"], totals
        ),
        "bookings_by_timeslot": _timeslot(counts["bookings_by_timeslot"]),
        "meetings_per_employee_week": _weekly(counts["meetings_per_employee_week"]),
    }


# ---- flat events (the older tables)


def events_by_type(events: DataFrame) -> DataFrame:
    """Number and mean duration of flat events by type."""
    return events.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("total_events"),
        F.avg("event_duration").alias("avg_duration_seconds"),
    )


def events_by_type_day(events: DataFrame) -> DataFrame:
    """As `events_by_type`, by day: of creation if the table has it, else of the start.

    Tables without a type are grouped by the organizer instead.
    """
    when = "created_at" if "created_at" in events.columns else "event_start_time"
    kind = "event_type" if "event_type" in events.columns else "organizer_email"
    return events.groupBy(F.col(kind).alias("event_type"), F.to_date(when).alias("event_date")).agg(
        F.count(F.lit(1)).alias("total_events"),
        F.avg("event_duration").alias("avg_duration_seconds"),
    )
