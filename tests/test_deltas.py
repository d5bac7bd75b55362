from dataclasses import replace

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from webhooks import frame, webhook

from meetmart.config import RunConfig
from meetmart.operators import deltas, marts, silver
from meetmart.plans import jobs
from meetmart.sources import buckets


@pytest.fixture
def cfg(tmp_path):
    return RunConfig("2025-07-10", silver_events_path=str(tmp_path / "silver"), gold_state_path=str(tmp_path / "state"), buckets=4)


def booking(n, meeting=None, source="Newsletter", created="2025-07-08T17:41:00Z"):
    event = f"E{n if meeting is None else meeting}"
    return webhook(
        payload__uri=f"I{n}", payload__scheduled_event__uri=event, payload__tracking__utm_source=source,
        payload__scheduled_event__event_type="https://api.test/event_types/T", payload__created_at=created,
    )


def load(spark, cfg, day, hooks):
    cfg = replace(cfg, run_date=day)
    before = buckets.state_before(spark, cfg.silver_events_path, day)
    events, kept = jobs.silver_load(spark, cfg, before, silver.flatten_webhooks(frame(spark, hooks)))
    buckets.write_load(events, cfg.silver_events_path, day, kept, None)
    return check(spark, cfg)


def check(spark, cfg):
    """The counts moved on and those counted anew, which must agree."""
    moved = jobs.incremental_counts(spark, cfg).drop("facts", "silver")
    full = marts.count_meetings_all(jobs._events(spark, cfg))
    moved, full = (sorted(map(str, f.select(*sorted(f.columns)).collect())) for f in (moved, full))
    assert moved == full
    return moved


def test_loads_add_replace_and_withdraw(spark, cfg):
    load(spark, cfg, "2025-07-10", [booking(n, meeting=n // 2) for n in range(12)])
    later = "2025-07-09T00:00:00Z"
    # the only booking of a source moves to another: its group goes; one of two bookings of a meeting moves: both have it
    changes = [booking(0, meeting=0, source="other", created=later), booking(20, source="solo")]
    load(spark, cfg, "2025-07-11", changes)
    counts = load(spark, cfg, "2025-07-12", [booking(20, source="duo", created=later)])
    assert "solo" not in str(counts) and "duo" in str(counts)
    load(spark, cfg, "2025-07-13", [booking(20, source="solo")])  # an older record changes nothing
    assert check(spark, replace(cfg, run_date="2025-07-13")) == check(spark, replace(cfg, run_date="2025-07-13"))


def test_meetings_without_a_uri_keep_their_group(spark, cfg):
    load(spark, cfg, "2025-07-10", [webhook(payload__uri="I1", payload__scheduled_event__uri=None), booking(2)])
    load(spark, cfg, "2025-07-11", [webhook(payload__uri="I3", payload__scheduled_event__uri=None)])


def test_a_silver_load_run_again_is_counted_anew(spark, cfg):
    load(spark, cfg, "2025-07-10", [booking(1)])
    mine = replace(cfg, run_date="2025-07-10")
    flat = silver.flatten_webhooks(frame(spark, [booking(5, source="again")]))
    buckets.write_load(jobs.silver_load(spark, mine, None, flat)[0], cfg.silver_events_path, "2025-07-10", None, None)
    load(spark, cfg, "2025-07-11", [booking(2)])  # the counts of the day before were made from another run
    load(spark, replace(cfg, buckets=3), "2025-07-12", [booking(3)])


def test_a_quiet_load_reads_no_silver(spark, cfg, monkeypatch):
    load(spark, cfg, "2025-07-10", [booking(n) for n in range(9)])
    load(spark, cfg, "2025-07-11", [])
    asked = []
    real = buckets.rows_of
    monkeypatch.setattr(buckets, "rows_of", lambda *a, **k: (asked.append(a[4] if len(a) > 4 else None), real(*a, **k))[1])
    jobs.incremental_counts(spark, replace(cfg, run_date="2025-07-11"))
    assert all(not names for names in asked)


def test_changes_that_do_not_belong_to_the_facts_are_an_error(spark, cfg):
    events = silver.silver_events(frame(spark, [booking(1)]), "2025-07-10")
    gone = deltas.fact_changes(events, events.where(F.lit(False)))
    with pytest.raises(PySparkException):
        deltas.changed_facts(gone.where("false"), gone).collect()


def test_gold_from_moved_counts(spark, cfg):
    load(spark, cfg, "2025-07-10", [booking(1), booking(2)])
    mine = replace(cfg, silver_spend_path=cfg.gold_state_path + "_none", incremental=True)
    frames = jobs.gold_frames(spark, mine)
    assert [r.total_bookings for r in frames["cost_per_booking_by_channel"].collect()] == [2]
    with pytest.raises(ValueError):
        jobs.gold_frames(spark, replace(mine, active_only=True))
