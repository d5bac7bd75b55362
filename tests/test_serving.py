import datetime as dt

import pytest
from pyspark.sql import functions as F

from meetmart import schemas
from meetmart.operators import serving
from meetmart.sources.readers import between_days, clean_names

D1, D2 = dt.date(2025, 7, 1), dt.date(2025, 7, 2)


def tuples(df):
    return [tuple(r) for r in df.collect()]


@pytest.fixture(scope="module")
def daily(spark):
    rows = [
        (D1, "a", 3, "r1"), (D2, "a", 5, "r1"), (D2, "b", 2, "r1"), (D2, "a", 5, "r2"),
        (D2, "b", 0, "r2"),
    ]
    return spark.createDataFrame(rows, schemas.MARTS["bookings_by_source_day"])


def test_days(daily):
    assert tuples(serving.date_bounds(daily)) == [("r1", "r2")]
    assert serving.for_days(daily).count() == 2
    assert serving.for_days(daily, "r1", "r1").count() == 3
    assert between_days(daily, "r2", "r1").count() == 5
    assert between_days(daily, "r2", None).count() == 2
    assert between_days(daily, None, "r1").count() == 3
    assert [r.dt for r in serving.latest_rows(daily, 3).collect()] == ["r2", "r2", "r1"]


def test_daily_bookings(daily):
    one = daily.where("dt = 'r1'")
    assert tuples(serving.daily_bookings(one)) == [(D1, "a", 3), (D2, "a", 5), (D2, "b", 2)]
    assert [r.bookings for r in serving.daily_bookings(one, asis=True).collect()] == [1, 1, 1]
    assert tuples(serving.daily_bookings_kpis(serving.daily_bookings(one))) == [(10, 2, 2)]


def test_trend(daily):
    got = tuples(serving.bookings_trend(daily))
    assert got == [(D1, "a", 3, 3), (D2, "a", 10, 13), (D2, "b", 2, 2)]


def test_costs(spark):
    rows = [
        ("a", 10.0, 5, 2.0, "r1"), ("a", 30.0, 5, 6.0, "r2"), ("b", 0.0, 0, None, "r1"),
        ("c", 8.0, 2, 4.0, "r1"), ("d", 40.0, 10, 4.0, "r1"),
    ]
    mart = spark.createDataFrame(rows, schemas.MARTS["cost_per_booking_by_channel"])
    costs = serving.channel_costs(mart)
    assert tuples(costs) == [
        ("a", 40.0, 10, 4.0), ("d", 40.0, 10, 4.0), ("c", 8.0, 2, 4.0), ("b", 0.0, 0, None),
    ]
    assert tuples(serving.channel_cost_kpis(costs)) == [(22, 88.0, 4.0)]
    none = serving.channel_cost_kpis(costs.where("channel = 'b'"))
    assert tuples(none) == [(0, 0.0, None)]


def test_attribution(spark):
    rows = [
        ("a", "x", 2, 90.0, 45.0, "r1"), ("a", "y", 1, 90.0, 90.0, "r1"),
        ("b", "x", 3, 0.0, 0.0, "r1"), ("c", "z", 0, 5.0, None, "r1"),
    ]
    mart = spark.createDataFrame(rows, schemas.MARTS["channel_attribution_leaderboard"])
    board = serving.source_leaderboard(mart)
    assert tuples(board) == [("b", 3, 0.0, 0.0), ("a", 3, 90.0, 30.0), ("c", 0, 5.0, None)]
    assert tuples(serving.source_leaderboard(mart, asis=True))[1] == ("a", 3, 180.0, 60.0)
    assert [r.source for r in serving.top_sources(board, 2).collect()] == ["b", "a"]
    campaigns = serving.source_campaigns(mart)
    assert campaigns.count() == 4
    pivot = serving.cost_pivot(campaigns, ["x", "y"])
    assert pivot.columns == ["source", "x", "y"]
    assert tuples(pivot) == [("a", 45.0, 90.0), ("b", 0.0, None)]


def test_slots(spark):
    rows = [
        (9, "Wed", "a", 4, "r"), (9, "Mon", "a", 1, "r"), (9, "Mon", "b", 2, "r"),
        (8, "Sun", "a", 1, "r"),
    ]
    mart = spark.createDataFrame(rows, schemas.MARTS["bookings_by_timeslot"])
    slots = serving.timeslots(mart)
    assert tuples(serving.weekday_hour_cells(slots)) == [
        ("Mon", 9, 3), ("Wed", 9, 4), ("Sun", 8, 1),
    ]
    assert tuples(serving.bookings_by_hour(slots)) == [(8, 1), (9, 7)]
    assert tuples(serving.weekday_share(slots)) == [
        ("Mon", 3, 3 / 8), ("Wed", 4, 0.5), ("Sun", 1, 0.125),
    ]


def test_hosts(spark):
    rows = [("Ann", 2025, 1, 4, 4.0, "r"), ("Ann", 2025, 2, 1, 1.0, "r"), ("Bo", 2025, 1, 4, 4.0, "r")]
    mart = spark.createDataFrame(rows, schemas.MARTS["meetings_per_employee_week"])
    hosts = serving.host_meetings(mart)
    assert tuples(hosts) == [("Ann", 5, 2.5), ("Bo", 4, 4.0)]
    assert [r.host_user_name for r in serving.by_mean_meetings(hosts).collect()] == ["Bo", "Ann"]
    assert tuples(serving.host_meeting_kpis(hosts)) == [(9, 5, 4, 3.25)]


def test_clean_names(spark):
    assert clean_names(spark.range(1).select(F.col("id").alias(" ID "))).columns == ["id"]
