import datetime as dt

import pytest
from pyspark.sql import functions as F
from webhooks import frame, webhook

from meetmart import schemas
from meetmart.operators import dedupe, silver
from meetmart.plans import registry

RUN = "2025-07-10"


def test_silver_columns_match_the_schema(spark):
    got = silver.silver_events(frame(spark, [webhook()]), RUN)
    assert [(f.name, f.dataType) for f in got.schema] == [
        (f.name, f.dataType) for f in schemas.SILVER_EVENTS
    ]
    row = got.first()
    assert row.event_start_local == dt.datetime(2025, 7, 8, 22, 30)
    assert (row.booking_date, row.booking_hour) == (dt.date(2025, 7, 8), 22)
    assert (row.day_of_week, row.channel, row.dt) == ("Tuesday", "facebook", RUN)
    assert (row.host_user_name, row.invitee_name) == ("Host One", "Ada Example")
    assert row.questions_and_answers_json == (
        '[{"question":"Topic?","answer":"Data","position":0}]'
    )


def test_flatten_without_event_or_hosts(spark):
    rows = silver.flatten_webhooks(
        frame(
            spark,
            [
                webhook(payload__scheduled_event=...),
                webhook(payload__scheduled_event__event_memberships=[]),
                webhook(payload__tracking={}),
            ],
        )
    ).collect()
    assert rows[0].scheduled_event_uri is None and rows[0].host_user_name is None
    assert rows[1].host_user_name is None and rows[1].scheduled_event_uri is not None
    assert rows[2].utm_source is None


def test_malformed_times_become_null(spark):
    row = silver.silver_events(
        frame(spark, [webhook(payload__scheduled_event__start_time="soon")]), RUN
    ).first()
    assert row.event_start_ts is None and row.booking_date is None and row.event_end_ts is not None


@pytest.mark.parametrize("flip", [False, True])
def test_latest_invitee_by_time_then_update(spark, flip):
    late = "2025-07-08T17:41:00.500000Z"
    bodies = [
        webhook(payload__name="old", payload__created_at="2025-07-08T17:41:00Z"),
        webhook(payload__name="new", payload__created_at=late),
        webhook(payload__name="null", payload__created_at=None),
        webhook(payload__uri="I2", payload__name="created"),
        webhook(
            payload__uri="I2", payload__name="gone", event="invitee.canceled",
            payload__updated_at="2025-07-10T00:00:00Z",
        ),
        webhook(payload__uri=None, payload__name="a", payload__status="x"),
        webhook(payload__uri=None, payload__name="b", payload__status="x"),
        webhook(payload__uri=None, payload__email="bob@mail.test", payload__name="bob"),
    ]
    bodies = bodies[::-1] if flip else bodies
    flat = silver.flatten_webhooks(frame(spark, bodies).repartition(4))
    latest = silver.latest_invitees(flat)
    assert sorted(r.invitee_name for r in latest.collect()) == ["a", "bob", "gone", "new"]
    again = silver.latest_invitees(latest)
    assert sorted(r.invitee_name for r in again.collect()) == ["a", "bob", "gone", "new"]


def test_keep_latest_thins_a_hot_key_before_the_shuffle(spark):
    rows = spark.range(1000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), F.col("id").alias("v")
    )
    latest = dedupe.keep_latest(rows, ["k"], [F.desc("v")])
    plan = latest._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    assert latest.where("k = 0").first().v == 999
    assert latest.count() == rows.select("k").distinct().count()


def test_silver_spend(spark):
    rows = [
        ("2031-04-17", "a", 1.0), ("2031-04-17", "a", 3.0), ("2031-04-17", "a", None),
        ("2031-04-17", "b", None), ("bad", "a", 2.0), ("2031-04-18", None, 4.0),
    ]
    raw = spark.createDataFrame(rows, schemas.SPEND)
    got = {(r.date, r.channel): (r.spend, r.dt) for r in silver.silver_spend(raw).collect()}
    assert got == {
        ("2031-04-17", "a"): (3.0, "2031-04-17"),
        ("2031-04-17", "b"): (None, "2031-04-17"),
        ("bad", "a"): (2.0, None),
        ("2031-04-18", None): (4.0, "2031-04-18"),
    }


def _vendor(spark, **changes):
    row = {
        "source": "bing_ads", "granularity": None, "date": "2031-02-03", "timezone": None,
        "ids": {"account_id": "1", "campaign_id": "2"}, "names": {"account_name": "Nimbus"},
        "metrics": {"spend": 10.0, "clicks": None}, "currency": "USD",
        "attribution": {"window": "30d", "model": "last"},
        "provenance": {"load_id": "L", "source_file": "f", "extracted_at": "2031-02-04T01:00:00Z"},
        "extra": {"zone": "q"},
    }
    return {**row, **changes}


def test_vendor_spend(spark):
    later = {"load_id": "L", "source_file": "g", "extracted_at": "2031-02-04T01:00:00.5Z"}
    raw = spark.createDataFrame(
        [_vendor(spark), _vendor(spark, provenance=later, metrics={"spend": 11.0})],
        schemas.VENDOR_SPEND,
    )
    flat = silver.flatten_vendor_spend(raw)
    first = flat.first()
    assert (first.granularity, first.date, first.clicks) == ("day", dt.date(2031, 2, 3), 0.0)
    assert (first.account_id, first.account_name, first.attribution_model) == ("1", "Nimbus", "last")
    latest = silver.latest_vendor_spend(flat).collect()
    assert [(r.spend, r.source_file) for r in latest] == [(11.0, "g")]


def test_event_duration_needs_both_ends(spark):
    rows = [("2025-01-01T10:00:00Z", "2025-01-01T10:30:30Z"), ("bad", "2025-01-01T10:30:00Z")]
    both = spark.createDataFrame(rows, "event_start_time string, event_end_time string")
    assert [r.event_duration for r in silver.add_event_duration(both).collect()] == [1830, None]
    one = silver.add_event_duration(both.drop("event_end_time"))
    assert one.columns == ["event_start_time"]


def test_data_dictionary_describes_every_leaf(spark):
    rows = schemas.data_dictionary(spark).collect()
    assert all(r.description for r in rows)
    fields = {(r.table_name, r.field) for r in rows}
    for leaf in ("event", "payload.uri", "payload.questions_and_answers[].answer",
                 "payload.tracking.utm_term", "payload.scheduled_event.event_memberships[].user_name"):
        assert ("webhook", leaf) in fields
    for leaf in ("ids.creative_id", "metrics.leads", "provenance.extracted_at", "extra"):
        assert ("vendor_spend", leaf) in fields


def test_webhooks_are_parsed_once_per_load(spark, tmp_path):
    """The filter that tells the loads apart does not build and parse bodies of its own."""
    spark.range(60).selectExpr(
        "id AS event_id", "timestamp_ntz'2024-01-05 10:00:00' + make_dt_interval(0, 0, int(id)) AS ts",
        "id % 7 AS user_id", "'click' AS event_type", "1.0D AS value", "concat('{\"k\": ', id % 9, '}') AS props",
    ).write.parquet(f"{tmp_path}/events.parquet")
    loads = registry.silver_in_two_loads(spark, str(tmp_path))
    assert loads._jdf.queryExecution().optimizedPlan().toString().count("from_json(") == 2
    assert sorted(loads.collect()) == sorted(registry.silver_from_webhooks(spark, str(tmp_path)).collect())
    assert loads.count() == 7
