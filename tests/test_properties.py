"""Random small inputs against plain Python."""

import datetime as dt
from collections import defaultdict

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from meetmart import schemas
from meetmart.operators import dedupe, marts, serving
from meetmart.sources import readers, scratch, writers

few = settings(
    max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
maybe = st.none() | st.sampled_from(["a", "b", "C"])
bookings = st.lists(
    st.tuples(
        st.none() | st.sampled_from(["e1", "e2", "e3", "e4"]),
        maybe,
        st.sampled_from(["x", "y"]),
        st.none() | st.datetimes(dt.datetime(2024, 12, 28), dt.datetime(2025, 1, 3)),
        maybe,
    ),
    min_size=1,
    max_size=30,
)
EVENTS = (
    "scheduled_event_uri string, channel string, event_type_id string, "
    "event_start_local timestamp_ntz, host_user_name string, booking_date date, dt string"
)
RUN = "2025-01-03"


def frame(spark, rows):
    full = [(*r, r[3] and r[3].date(), RUN) for r in rows]
    return spark.createDataFrame(full, EVENTS).repartition(3)


def distinct_by(rows, key):
    groups = defaultdict(set)
    for row in rows:
        groups[key(row)].update([row[0]] if row[0] else [])
    return {k: len(v) for k, v in groups.items()}


def channel(row):
    return (row[1] or "unknown").lower()


@few
@given(rows=bookings)
def test_counts_match_plain_python(spark, rows):
    events = frame(spark, rows)
    daily = marts.bookings_by_source_day(events)
    got = {(r.booking_date, r.source): r.booking_id for r in daily.collect()}
    assert got == distinct_by(rows, lambda r: (r[3] and r[3].date(), channel(r)))

    slots = marts.bookings_by_timeslot(events)
    got = {(r.hour_of_day, r.day_of_week, r.source): r.booking_id for r in slots.collect()}
    assert got == distinct_by(
        rows, lambda r: (r[3] and r[3].hour, r[3] and r[3].strftime("%a"), channel(r))
    )

    weeks = marts.meetings_per_employee_week(events)
    got = {(r.host_user_name, r.year, r.week_of_year): r.meetings for r in weeks.collect()}
    assert got == distinct_by(
        rows, lambda r: (r[4], r[3] and r[3].year, r[3] and r[3].isocalendar()[1])
    )


@few
@given(rows=bookings)
def test_running_total_ends_at_the_sum(spark, rows):
    dated = [r for r in rows if r[3]] or [("e1", "a", "x", dt.datetime(2025, 1, 1), None)]
    trend = serving.bookings_trend(marts.bookings_trend_over_time(frame(spark, dated))).collect()
    for source in {r.source for r in trend}:
        own = [r for r in trend if r.source == source]
        assert own[-1].cumulative_bookings == sum(r.bookings for r in own)
        assert [r.booking_date for r in own] == sorted(r.booking_date for r in own)


@few
@given(
    rows=st.lists(st.tuples(maybe, st.integers(0, 5), st.integers(0, 99)), min_size=1, max_size=30),
    seed=st.randoms(),
)
def test_keep_latest_ignores_input_order(spark, rows, seed):
    order = [F.desc("n"), F.desc("v")]
    mixed = list(rows)
    seed.shuffle(mixed)
    results = []
    for data in (rows, mixed):
        df = spark.createDataFrame(data, "k string, n int, v int").repartition(3)
        latest = dedupe.keep_latest(df, ["k"], order)
        results.append(sorted(map(repr, latest.collect())))
        again = dedupe.keep_latest(latest, ["k"], order)
        assert sorted(map(repr, again.collect())) == results[-1]
    assert results[0] == results[1]
    best = {}
    for k, n, v in rows:
        best[k] = max(best.get(k, (-1, -1)), (n, v))
    assert len(results[0]) == len(best)
    assert {r for r in results[0]} == {f"Row(k={k!r}, n={n}, v={v})" for k, (n, v) in best.items()}


@settings(few, max_examples=3)
@given(
    loads=st.lists(
        st.dictionaries(
            st.tuples(st.sampled_from(["2025-01-01", "2025-01-02"]), maybe),
            st.integers(0, 9).map(float),
            min_size=1,
        ),
        min_size=1,
        max_size=3,
    )
)
def test_upserts_behave_like_a_dictionary(spark, loads):
    path = scratch.shared_dir(spark, "upserts")
    model = {}
    for load in loads:
        model.update(load)
        rows = [(day, name, spend, day) for (day, name), spend in load.items()]
        df = spark.createDataFrame(rows, schemas.SILVER_SPEND)
        writers.upsert_days(df, path, schemas.SILVER_SPEND, ["date", "channel"])
    stored = readers.read_table(spark, path, schemas.SILVER_SPEND).collect()
    assert {(r.date, r.channel): r.spend for r in stored} == model and len(stored) == len(model)
