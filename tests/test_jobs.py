import json
import os
from dataclasses import replace

import pytest
from webhooks import webhook

from meetmart import schemas
from meetmart.__main__ import main
from meetmart.config import RunConfig
from meetmart.operators.quality import QualityError
from meetmart.plans import jobs
from meetmart.sources import writers

RUN = "2025-07-10"


@pytest.fixture(scope="module")
def cfg(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("lake")
    zone = root / "bronze" / "webhooks"
    zone.mkdir(parents=True)
    for i in range(6):
        event = f"https://api.test/scheduled_events/E{i}"
        body = webhook(payload__uri=f"{event}/invitees/I", payload__scheduled_event__uri=event)
        if i % 2:
            body["payload"]["scheduled_event"]["event_type"] = f"https://api.test/event_types/T{i}"
        (zone / f"{i}.json").write_text(json.dumps(body, indent=2))
    gone = webhook(
        event="invitee.canceled", payload__uri="https://api.test/scheduled_events/E0/invitees/I",
        payload__scheduled_event=...,
    )
    (zone / "gone.json").write_text(json.dumps(gone))
    (zone / "broken.json").write_text("{")
    for file in zone.iterdir():
        os.utime(file, (1_752_140_000, 1_752_140_000))  # the run date
    money = root / "bronze" / "marketing_spend"
    money.mkdir()
    (money / "s.json").write_text(
        json.dumps([{"date": RUN, "channel": "facebook_paid_ads", "spend": 90.0},
                    {"date": "2025-07-01", "channel": "facebook_paid_ads", "spend": 10.0}])
    )
    flat = root / "bronze" / "events"
    flat.mkdir()
    (flat / "e.json").write_text(
        json.dumps({"event_type": "booked", "event_start_time": "2031-05-06T08:15:00Z",
                    "event_end_time": "2031-05-06T08:45:00Z", "created_at": "2031-05-06T08:01:00Z"})
    )
    paths = {
        name: str(root / getattr(RunConfig(RUN), name))
        for name in RunConfig.__dataclass_fields__
        if name.endswith("_path")
    }
    return RunConfig(RUN, database="lake_test", **paths)


def contents(spark, cfg):
    return {m: sorted(map(repr, df.collect())) for m, df in jobs.read_marts(spark, cfg).items()}


def test_pipeline_twice_gives_the_same_tables(spark, cfg):
    states = []
    for _ in range(2):
        rows = jobs.run_silver(spark, cfg)
        assert rows == {"events": 7, "spend": 2}
        written = jobs.run_gold(spark, cfg)
        assert written.keys() == schemas.MARTS.keys()
        states.append(contents(spark, cfg))
    assert states[0] == states[1]

    cost = jobs.read_marts(spark, cfg)["cost_per_booking_by_channel"].collect()
    got = {r.channel: (r.total_bookings, r.total_spend, r.cpb) for r in cost}
    assert got["facebook"] == (3, 90.0, 30.0) and got["newsletter"] == (3, 0.0, 0.0)

    wide = replace(cfg, spend_from="2025-07-01", active_only=True, gold_path=cfg.gold_path + "_active")
    jobs.run_gold(spark, wide)
    cost = jobs.read_marts(spark, wide)["cost_per_booking_by_channel"].collect()
    assert {r.channel: (r.total_bookings, r.cpb) for r in cost}["facebook"] == (2, 50.0)


def test_compact_register_validate(spark, cfg):
    """A canceled webhook without its meeting leaves nulls, so only the active gold is complete."""
    with pytest.raises(QualityError):
        jobs.run_validate(spark, cfg)
    cfg = replace(cfg, active_only=True, gold_path=cfg.gold_path + "_active",
                  metrics_path=cfg.metrics_path + "_active")
    jobs.run_gold(spark, cfg)
    before = contents(spark, cfg)
    jobs.run_compact(spark, cfg)
    assert contents(spark, cfg) == before
    jobs.run_register(spark, cfg)
    jobs.run_repair(spark, cfg)
    assert spark.table("lake_test.gold_bookings_by_timeslot").count() == len(
        before["bookings_by_timeslot"]
    )
    spark.sql("DROP DATABASE lake_test CASCADE")

    for _ in range(2):
        checks = jobs.run_validate(spark, cfg)
    history = spark.read.parquet(cfg.metrics_path)
    assert history.count() == checks.count() and checks.where("NOT passed").isEmpty()

    bad = jobs.read_marts(spark, cfg)["bookings_by_timeslot"].selectExpr(
        "hour_of_day", "day_of_week", "source", "-1L AS booking_id", "'2025-07-11' AS dt"
    )
    writers.write_days(bad, jobs.mart_path(cfg, "bookings_by_timeslot"))
    with pytest.raises(QualityError) as error:
        jobs.run_validate(spark, cfg, "2025-07-11")
    assert "bookings_by_timeslot: non_negative" in str(error.value)
    assert "bookings_by_source_day: not_empty" in str(error.value)
    assert not spark.read.parquet(cfg.metrics_path).where("dt = '2025-07-11' AND NOT passed").isEmpty()


def test_ingest_feeds_silver(spark, cfg):
    jobs.run_ingest(spark, cfg)
    rows = jobs.run_silver(spark, replace(cfg, landed=True))
    assert rows["events"] == 7


def test_vendor_spend(spark, cfg, tmp_path):
    def record(load, extracted, spend, **more):
        return {
            "source": "bing_ads", "date": "2031-02-03", "ids": {"account_id": "1", "campaign_id": "2"},
            "metrics": {"spend": spend}, "currency": "USD", "extra": {"zone": "q"},
            "provenance": {"load_id": load, "extracted_at": extracted}, **more,
        }

    records = [
        record("L1", "2031-02-04T01:00:00Z", 10.0), record("L1", "2031-02-04T02:00:00Z", 12.0),
        record("L2", "2031-02-04T01:00:00Z", 5.0, currency="usd"),
    ]
    (tmp_path / "a.json").write_text(json.dumps(records, indent=1))
    (tmp_path / "b.json").write_text("[{")
    cfg = replace(cfg, vendor_spend_path=str(tmp_path))
    for _ in range(2):
        totals = jobs.run_vendor_spend(spark, cfg).collect()
    stored = spark.read.schema(schemas.SILVER_VENDOR_SPEND).parquet(cfg.silver_vendor_path).collect()
    assert [(r.spend, r.load_id, r.dt, r.extra) for r in stored] == [
        (12.0, "L1", "2031-02-03", '{"zone":"q"}')
    ]
    assert [(r.bronze_spend, r.silver_spend, r.within) for r in totals] == [(12.0, 12.0, True)]
    letters = spark.read.parquet(cfg.vendor_landed_path).where("route = 'dead_letter'").collect()
    assert sorted(tuple(r.reasons) for r in letters) == [("format:currency",), ("malformed",)]


def test_vendor_rerun_leaves_no_stale_letters_and_lost_rows_fail(spark, cfg, tmp_path, monkeypatch):
    def land(**changes):
        row = {"source": "bing_ads", "date": "2031-02-03", "ids": {"campaign_id": "2"}, "metrics": {"spend": 4.0},
               "currency": "USD", "provenance": {"load_id": "L1"}, **changes}
        (tmp_path / "a.json").write_text(json.dumps(row))

    cfg = replace(cfg, vendor_spend_path=str(tmp_path / "a.json"), vendor_landed_path=str(tmp_path / "landed"),
                  silver_vendor_path=str(tmp_path / "silver"), vendor_totals_path=str(tmp_path / "totals"))
    land(currency="usd")
    jobs.run_vendor_spend(spark, cfg)
    land()
    jobs.run_vendor_spend(spark, cfg)
    landed = spark.read.parquet(cfg.vendor_landed_path).collect()
    assert [(r.route, list(r.reasons)) for r in landed] == [("bronze", [])]
    land(metrics={"spend": 8.0})
    monkeypatch.setattr(jobs.writers, "upsert_days", lambda *a, **k: 0)  # a write that loses its rows
    with pytest.raises(QualityError):
        jobs.run_vendor_spend(spark, cfg)
    kept = spark.read.parquet(cfg.vendor_totals_path).collect()
    assert [(r.bronze_spend, r.silver_spend, r.within) for r in kept] == [(8.0, 4.0, False)]


def test_one_bad_element_costs_no_other(spark, cfg, tmp_path):
    (tmp_path / "w.json").write_text(json.dumps([webhook(), webhook(payload__canceled="yes")]))
    (tmp_path / "s.json").write_text(
        json.dumps([{"date": RUN, "channel": "a", "spend": 1.5}, {"date": RUN, "channel": "b", "spend": "12.5"},
                    {"date": "2031", "channel": "c", "spend": 2}])
    )
    (tmp_path / "e.json").write_text(json.dumps([{"event_type": "x"}, {"event_type": 5}, 7]))
    mine = replace(cfg, webhooks_path=str(tmp_path / "w.json"), spend_path=str(tmp_path / "s.json"),
                   flat_events_path=str(tmp_path / "e.json"), judged_path=str(tmp_path / "judged"),
                   silver_events_path=str(tmp_path / "events"), silver_spend_path=str(tmp_path / "spend"),
                   flat_silver_path=str(tmp_path / "flat"))
    assert jobs.run_silver(spark, mine) == {"events": 1, "spend": 1}
    jobs.run_flat_silver(spark, mine)
    letters = {k: sorted(r.reasons[0] for r in jobs.batch_dead_letters(spark, mine, k).collect())
               for k in ("webhooks", "spend", "flat_events")}
    assert letters == {
        "webhooks": ["type:payload.canceled"], "spend": ["format:date", "type:spend"],
        "flat_events": ["type:body", "type:event_type"],
    }
    assert spark.read.parquet(mine.flat_silver_path).count() == 1


def test_a_mart_without_a_column_fails_its_check(spark, cfg):
    gold = replace(cfg, gold_path=cfg.gold_path + "_narrow", metrics_path=cfg.metrics_path + "_narrow", active_only=True)
    jobs.run_gold(spark, gold)
    mart = "cost_per_booking_by_channel"
    narrow = jobs.read_marts(spark, gold)[mart].drop("total_spend", "cpb")
    narrow = spark.createDataFrame(narrow.collect(), narrow.schema)
    narrow.write.mode("overwrite").partitionBy("dt").parquet(jobs.mart_path(gold, mart))
    with pytest.raises(QualityError) as error:
        jobs.run_validate(spark, gold)
    assert f"{mart}: present(cpb)" in str(error.value) and f"{mart}: present(total_spend)" in str(error.value)


def test_new_arrivals_merge_into_the_day_before(spark, tmp_path):
    zone = tmp_path / "zone"
    zone.mkdir()
    cfg = RunConfig(
        "2025-06-16", webhooks_path=str(zone), landed_path=str(tmp_path / "landed"),
        checkpoint_path=str(tmp_path / "checkpoint"), silver_events_path=str(tmp_path / "events"),
        silver_spend_path=str(tmp_path / "spend"), spend_path=str(tmp_path / "none.json"),
        judged_path=str(tmp_path / "judged"), landed=True,
    )
    (tmp_path / "none.json").write_text("[]")
    day = 1_750_000_000  # 2025-06-15 15:06:40 UTC

    def land(name, at, **changes):
        path = zone / name
        path.write_text(json.dumps(webhook(**changes)))
        os.utime(path, (at, at))

    land("a", day, payload__name="first")
    land("b", day, payload__uri="I2")
    jobs.run_ingest(spark, cfg)
    jobs.run_silver(spark, replace(cfg, run_date="2025-06-15"))
    land("c", day + 86400, payload__name="second", payload__created_at="2025-07-09T00:00:00Z")
    land("d", day + 86400, payload__uri="I3")
    jobs.run_ingest(spark, cfg)
    states = []
    for rebuild in (False, True, False):
        assert jobs.run_silver(spark, replace(cfg, rebuild=rebuild))["events"] == 3
        table = spark.read.parquet(cfg.silver_events_path).where("dt = '2025-06-16'")
        states.append(sorted(map(repr, table.collect())))
    assert states[0] == states[1] == states[2] and "second" in "".join(states[0])


def test_back_dated_and_late_arrivals_reach_silver(spark, tmp_path):
    zone = tmp_path / "zone"
    zone.mkdir()
    cfg = RunConfig(
        "2025-06-16", webhooks_path=str(zone), landed_path=str(tmp_path / "landed"),
        checkpoint_path=str(tmp_path / "checkpoint"), silver_events_path=str(tmp_path / "events"),
        silver_spend_path=str(tmp_path / "spend"), spend_path=str(tmp_path / "none.json"),
        judged_path=str(tmp_path / "judged"), landed=True,
    )
    (tmp_path / "none.json").write_text("[]")
    day = 1_750_000_000  # 2025-06-15 15:06:40 UTC

    def land(uri, at):
        path = zone / uri
        path.write_text(json.dumps(webhook(payload__uri=uri)))
        os.utime(path, (at, at))
        jobs.run_ingest(spark, cfg)

    def rows(run_date):
        jobs.run_silver(spark, replace(cfg, run_date=run_date))
        table = spark.read.parquet(cfg.silver_events_path).where(f"dt = '{run_date}'")
        return sorted(map(repr, table.collect()))

    land("I1", day)
    assert len(rows("2025-06-15")) == 1
    land("I2", day + 60)  # later on a day that silver has read
    land("I3", day - 30 * 86400)  # back-dated
    assert len(rows("2025-06-16")) == 3
    assert jobs.run_compact_landed(spark, replace(cfg, run_date="2025-06-15")) == 2
    assert len(rows("2025-06-17")) == 3
    land("I4", day + 120)  # joins a day that is compacted again
    assert jobs.run_compact_landed(spark, replace(cfg, run_date="2025-06-15")) == 3
    merged = rows("2025-06-18")
    jobs.run_silver(spark, replace(cfg, run_date="2025-06-18", rebuild=True))
    table = spark.read.parquet(cfg.silver_events_path).where("dt = '2025-06-18'")
    assert len(merged) == 4 and merged == sorted(map(repr, table.collect()))


def test_flat_tables(spark, cfg):
    jobs.run_flat_silver(spark, cfg)
    jobs.run_flat_gold(spark, cfg)
    by_day = spark.read.parquet(cfg.flat_gold_path).collect()
    assert [(r.event_type, str(r.event_date), r.total_events, r.avg_duration_seconds) for r in by_day] == [
        ("booked", "2031-05-06", 1, 1800.0)
    ]
    jobs.run_flat_gold(spark, replace(cfg, by_day=False))
    assert spark.read.parquet(cfg.flat_gold_path).columns == [
        "event_type", "total_events", "avg_duration_seconds",
    ]


def test_backfill(spark, cfg):
    assert jobs.run_backfill(spark, cfg) == 7
    assert spark.read.orc(cfg.backfill_path).where(f"dt = '{RUN}'").count() == 7


def test_unknown_job():
    with pytest.raises(SystemExit):
        main(["shoe"])
