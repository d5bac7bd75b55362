import json
import os
from dataclasses import replace

import pytest
from pyspark.sql import functions as F
from webhooks import webhook

from meetmart import schemas
from meetmart.config import RunConfig
from meetmart.plans import jobs
from meetmart.sources import buckets

DAY = 1_750_000_000  # 2025-06-15 15:06:40 UTC


@pytest.fixture
def lake(spark, tmp_path):
    zone = tmp_path / "zone"
    zone.mkdir()
    (tmp_path / "none.json").write_text("[]")
    cfg = RunConfig(
        "2025-06-15", webhooks_path=str(zone), landed_path=str(tmp_path / "landed"),
        checkpoint_path=str(tmp_path / "checkpoint"), silver_events_path=str(tmp_path / "events"),
        silver_spend_path=str(tmp_path / "spend"), spend_path=str(tmp_path / "none.json"),
        judged_path=str(tmp_path / "judged"), landed=True, buckets=8,
    )

    def land(at, *uris, **changes):
        for uri in uris:
            path = zone / f"{uri}-{at}"
            path.write_text(json.dumps(webhook(payload__uri=uri, **changes)))
            os.utime(path, (at, at))
        jobs.run_ingest(spark, cfg)

    return cfg, land


def state(spark, cfg, day, **changes):
    mine = replace(cfg, run_date=day, **changes)
    written = jobs.run_silver(spark, mine)["events"]
    return written, sorted(map(repr, jobs._events(spark, mine).collect()))


def folders(cfg, day):
    path = f"{cfg.silver_events_path}/dt={day}"
    return sorted(os.listdir(path)) if os.path.isdir(path) else []


def test_a_load_reads_and_writes_only_the_buckets_it_touches(spark, lake, monkeypatch):
    cfg, land = lake
    land(DAY, *(f"I{n}" for n in range(40)))
    written, first = state(spark, cfg, "2025-06-15")
    assert written == len(first) == 40 and len(folders(cfg, "2025-06-15")) == 8
    land(DAY + 86400, "I3", payload__name="second", payload__created_at="2025-07-09T00:00:00Z")
    read = []
    real = buckets.rows_of

    def watched(*args, **kwargs):
        rows = real(*args, **kwargs)
        if len(args) > 4:  # the rows that the load merges with
            read.extend(r[0] for r in rows.select(F.input_file_name()).distinct().collect())
        return rows

    monkeypatch.setattr(buckets, "rows_of", watched)
    written, second = state(spark, cfg, "2025-06-16")
    assert len(folders(cfg, "2025-06-16")) == 1 and written < 40
    assert {p.split("/bucket=")[1].split("/")[0] for p in read} == {folders(cfg, "2025-06-16")[0].removeprefix("bucket=")}
    assert len(second) == 40 and sum("second" in r for r in second) == 1
    # a load without arrivals writes nothing and has the state before it
    written, third = state(spark, cfg, "2025-06-17")
    assert written == 0 and folders(cfg, "2025-06-17") == []
    assert [r.replace("2025-06-17", "2025-06-16") for r in third] == second
    # the state of an earlier day is still there, and all agree with a rebuild
    assert sorted(map(repr, jobs._events(spark, cfg).collect())) == first
    assert state(spark, cfg, "2025-06-17", rebuild=True) == (40, third)
    assert state(spark, cfg, "2025-06-17")[1] == third


def test_another_number_of_buckets_rewrites_the_state(spark, lake):
    cfg, land = lake
    land(DAY, *(f"I{n}" for n in range(10)))
    state(spark, cfg, "2025-06-15")
    land(DAY + 60, "J")
    written, rows = state(spark, cfg, "2025-06-16", buckets=3)
    assert written == len(rows) == 11
    assert all(name.endswith("-of-00003") for name in folders(cfg, "2025-06-16"))
    land(DAY + 120, "K")
    written, rows = state(spark, cfg, "2025-06-17", buckets=3)
    assert written < len(rows) == 12


def test_a_load_that_breaks_off_changes_no_state(spark, lake, monkeypatch):
    cfg, land = lake
    land(DAY, "I1", "I2")
    first = state(spark, cfg, "2025-06-15")
    land(DAY + 60, "I3")

    def broken(*args, **kwargs):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(buckets, "write_days", broken)
        with pytest.raises(RuntimeError):
            jobs.run_silver(spark, replace(cfg, run_date="2025-06-16"))
    assert buckets.load_days(spark, cfg.silver_events_path) == ["2025-06-15"]
    assert sorted(map(repr, jobs._events(spark, cfg).collect())) == first[1]
    assert len(state(spark, cfg, "2025-06-17")[1]) == 3  # what the lost load had read is read again


def test_an_earlier_day_run_again_costs_later_loads_nothing(spark, lake):
    cfg, land = lake
    land(DAY, "I1")
    state(spark, cfg, "2025-06-15")
    land(DAY + 2 * 86400, "I2")
    state(spark, cfg, "2025-06-17")
    land(DAY + 60, "I3")  # late; only the rerun of the earlier day reads it now
    assert len(state(spark, cfg, "2025-06-16")[1]) == 2
    assert buckets.state_of(spark, cfg.silver_events_path, "2025-06-17").base is None
    assert len(state(spark, cfg, "2025-06-18")[1]) == 3


def test_no_state_and_bad_settings(spark, lake):
    cfg, _ = lake
    assert buckets.state_before(spark, cfg.silver_events_path, "2025-06-15") is None
    assert jobs._events(spark, cfg).schema.names == schemas.SILVER_EVENTS.names
    with pytest.raises(ValueError):
        replace(cfg, buckets=0)
