import datetime as dt

import pytest
from pyspark.sql import functions as F

from meetmart import schemas
from meetmart.operators import marts

RUN = "2025-07-10"
EVENTS = (
    "scheduled_event_uri string, channel string, event_type_id string, booking_date date, "
    "event_start_local timestamp_ntz, host_user_name string, dt string"
)


def booking(uri, channel="facebook", campaign="c1", day=(2025, 7, 9), hour=14, host="Ann", run=RUN):
    when = None if day is None else dt.datetime(*day, hour)
    return (uri, channel, campaign, when and when.date(), when, host, run)


@pytest.fixture(scope="module")
def events(spark):
    rows = [
        booking("e1"), booking("e1"), booking("e2", campaign="c2"), booking("e3", "FaceBook"),
        booking("e4", None, None), booking(None, "ghost"), booking("e5", "youtube", "", day=(2024, 12, 30)),
        booking("e6", "youtube", "c1", day=None, host=None),
    ]
    return spark.createDataFrame(rows, EVENTS)


@pytest.fixture(scope="module")
def spend(spark):
    rows = [
        ("2025-07-10", "facebook_paid_ads", 60.0, RUN), ("2025-07-09", "facebook", 30.0, RUN),
        ("2025-07-10", "TikTok", 5.0, RUN), ("2025-07-10", None, 7.0, RUN),
    ]
    return spark.createDataFrame(rows, schemas.SILVER_SPEND)


def rows(df, *keys):
    return {tuple(r[k] for k in keys): r for r in df.collect()}


def test_daily_and_trend(events):
    day = dt.date(2025, 7, 9)
    got = rows(marts.bookings_by_source_day(events, RUN), "booking_date", "source")
    assert got[(day, "facebook")].booking_id == 3
    assert got[(day, "unknown")].booking_id == 1
    assert got[(day, "ghost")].booking_id == 0
    assert got[(None, "youtube")].booking_id == 1
    trend = marts.bookings_trend_over_time(events, RUN)
    assert rows(trend, "booking_date", "source") == got


def test_cost_per_booking(events, spend):
    got = rows(marts.cost_per_booking_by_channel(events, spend, RUN), "channel")
    assert got[("facebook",)][1:4] == (90.0, 3, 30.0)
    assert got[("youtube",)][1:4] == (0.0, 2, 0.0)
    assert got[("ghost",)][1:4] == (0.0, 0, None)
    assert ("tiktok",) not in got and (None,) not in got
    lost = rows(marts.unmatched_spend(events, spend, RUN), "source")
    assert {k[0]: r.total_spend for k, r in lost.items()} == {"tiktok": 5.0, None: 7.0}


def test_attribution_repeats_channel_spend(events, spend):
    got = rows(marts.channel_attribution_leaderboard(events, spend, RUN), "source", "campaign")
    assert got[("facebook", "c1")][2:5] == (2, 90.0, 45.0)
    assert got[("facebook", "c2")][2:5] == (1, 90.0, 90.0)
    assert got[("youtube", "")][2:5] == (1, 0.0, 0.0)
    assert ("unknown", None) in got


def test_timeslots_and_weeks(events):
    slots = rows(marts.bookings_by_timeslot(events, RUN), "hour_of_day", "day_of_week", "source")
    assert slots[(14, "Wed", "facebook")].booking_id == 3
    assert slots[(None, None, "youtube")].booking_id == 1
    weeks = rows(marts.meetings_per_employee_week(events, RUN), "host_user_name", "year", "week_of_year")
    assert weeks[("Ann", 2025, 28)][3:5] == (4, 4.0)
    assert weeks[("Ann", 2024, 1)].meetings == 1
    assert weeks[(None, None, None)].meetings == 1


def test_shared_counts_give_the_same_marts(events, spend):
    counts = marts.count_meetings_all(events, RUN)
    shared = marts.marts_from_counts(counts, spend, RUN)
    single = {
        "bookings_by_source_day": marts.bookings_by_source_day(events, RUN),
        "bookings_trend_over_time": marts.bookings_trend_over_time(events, RUN),
        "cost_per_booking_by_channel": marts.cost_per_booking_by_channel(events, spend, RUN),
        "channel_attribution_leaderboard": marts.channel_attribution_leaderboard(events, spend, RUN),
        "bookings_by_timeslot": marts.bookings_by_timeslot(events, RUN),
        "meetings_per_employee_week": marts.meetings_per_employee_week(events, RUN),
    }
    assert shared.keys() == single.keys() == schemas.MARTS.keys()
    for name, frame in shared.items():
        assert [(f.name, f.dataType) for f in frame.schema] == [
            (f.name, f.dataType) for f in schemas.MARTS[name]
        ], name
        assert sorted(map(repr, frame.collect())) == sorted(map(repr, single[name].collect())), name


def test_marts_of_several_days_at_once(spark):
    both = spark.createDataFrame([booking("e1", run="d1"), booking("e1", run="d2")], EVENTS)
    got = rows(marts.bookings_by_source_day(both), "dt", "source")
    assert {k: r.booking_id for k, r in got.items()} == {
        ("d1", "facebook"): 1, ("d2", "facebook"): 1,
    }


def test_counts_shuffle_on_the_meeting_not_on_the_channel_alone(spark, events):
    counts = marts.count_meetings(events, "cost_per_booking_by_channel", RUN)
    plan = counts._jdf.queryExecution().executedPlan().toString()
    first = [l for l in plan.splitlines() if "Exchange hashpartitioning" in l][-1]
    assert "scheduled_event_uri" in first


def test_flat_summaries(spark):
    rows_ = [
        ("a", "2025-01-02 00:30:00", "2025-01-01 10:00:00", "x@t", 60),
        ("a", "2025-01-02 00:30:00", "2025-01-01 10:00:00", "y@t", None),
        ("b", None, "2025-01-01 10:00:00", "x@t", 30),
    ]
    flat = spark.createDataFrame(
        rows_,
        "event_type string, created_at string, event_start_time string, organizer_email string, "
        "event_duration long",
    ).withColumns({c: F.to_timestamp(c) for c in ("created_at", "event_start_time")})
    got = rows(marts.events_by_type(flat), "event_type")
    assert got[("a",)][1:] == (2, 60.0) and got[("b",)][1:] == (1, 30.0)
    days = rows(marts.events_by_type_day(flat), "event_type", "event_date")
    assert set(days) == {("a", dt.date(2025, 1, 2)), ("b", None)}
    narrow = flat.drop("event_type", "created_at")
    days = rows(marts.events_by_type_day(narrow), "event_type", "event_date")
    assert days[("x@t", dt.date(2025, 1, 1))][2:] == (2, 45.0)
