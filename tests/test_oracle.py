import pytest
from oracle import connect, differences

import __spark_entry__ as entry
from conftest import TESTDATA

SF = f"{TESTDATA}/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_sql_belongs_to_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_agrees_with_sql(spark, con, name):
    frame = entry.queries()[name](spark, SF)
    assert differences(frame, con, entry.oracle_sql()[name]) == ""
    plan = frame._jdf.queryExecution().executedPlan().toString()
    for slow in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "collect_list"):
        assert slow not in plan


_PLACE = "CASE day_of_week WHEN 'Mon' THEN 1 WHEN 'Tue' THEN 2 WHEN 'Wed' THEN 3 WHEN 'Thu' THEN 4 " \
    "WHEN 'Fri' THEN 5 WHEN 'Sat' THEN 6 ELSE 7 END"
ORDERS = {
    "channel_distribution": "count DESC, channel NULLS FIRST",
    "serve_daily_calls": "booking_date, source NULLS FIRST",
    "serve_trend_cumulative": "booking_date, source NULLS FIRST",
    "serve_cpb": "cpb NULLS LAST, total_bookings DESC, channel NULLS FIRST",
    "serve_leaderboard": "total_bookings DESC, cpb NULLS LAST, source NULLS FIRST",
    "serve_cpb_pivot": "source NULLS FIRST, campaign",
    "serve_heatmap": f"{_PLACE}, hour_of_day",
    "serve_by_hour": "hour_of_day",
    "serve_weekday_share": _PLACE,
    "serve_meetings": "avg_meetings DESC, host_user_name NULLS FIRST",
}


@pytest.mark.parametrize("name", sorted(ORDERS))
def test_rows_come_in_order(spark, con, name):
    """The position of each row is compared as one of its columns."""
    frame = entry.queries()[name](spark, SF)
    numbered = f"SELECT *, row_number() OVER (ORDER BY {ORDERS[name]}) - 1 AS place FROM ({entry.oracle_sql()[name]})"
    got = [(*r, i) for i, r in enumerate(frame.collect())]
    listed = spark.createDataFrame(got, frame.schema.add("place", "long"))
    assert differences(listed, con, numbered) == ""


def test_gold_checks_pass_on_computed_marts(spark):
    rows = entry.queries()["quality_gold_tables"](spark, SF).collect()
    failed = {(r.table_name, r.check_name, r.column_name) for r in rows if not r.passed}
    assert len(rows) == 40 and failed == set()


def test_entry(spark):
    assert entry.entry(spark).count() > 0
