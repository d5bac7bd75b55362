import datetime as dt
import glob
import json
import uuid

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from webhooks import webhook

from meetmart import schemas
from meetmart.operators import serving, silver
from meetmart.sources import catalog, readers, scratch, writers

DAILY = schemas.MARTS["bookings_by_source_day"]


def daily(spark, rows):
    return spark.createDataFrame([(dt.date(2025, 7, 1), s, n, d) for s, n, d in rows], DAILY)


def stored(spark, path, schema=DAILY):
    return sorted((r.source, r.booking_id, r.dt) for r in readers.read_table(spark, path, schema).collect())


def test_multi_line_json(spark, tmp_path):
    folder = tmp_path / "dt=2025-07-09"
    folder.mkdir()
    (folder / "a.json").write_text(json.dumps(webhook(), indent=2))
    (folder / "b.json").write_text('{"event": "invitee.cre')
    got = readers.read_webhooks(spark, str(tmp_path / "*")).cache()
    assert got.where("payload.uri IS NOT NULL").count() == 1
    assert got.where(f"{schemas.CORRUPT} IS NOT NULL").count() == 1
    assert silver.flatten_webhooks(got).where("invitee_name = 'Ada Example'").count() == 1


def test_spend_array_and_json_lines(spark, tmp_path):
    rows = [{"date": "2031-04-17", "channel": "a", "spend": 1.5}, {"date": "2031-04-17", "channel": "b"}]
    (tmp_path / "array.json").write_text(json.dumps(rows, indent=2))
    got = readers.read_spend(spark, str(tmp_path / "array.json"))
    assert [tuple(r)[:3] for r in got.collect()] == [("2031-04-17", "a", 1.5), ("2031-04-17", "b", None)]
    (tmp_path / "lines.json").write_text("\n".join(map(json.dumps, rows)))
    lines = readers.read_spend(spark, str(tmp_path / "lines.json"), multiline=False)
    assert lines.count() == 2


def test_flat_events_both_layouts(spark, tmp_path):
    event = {
        "event_type": "booked", "event_start_time": "2031-05-06T08:15:00Z",
        "event_end_time": "2031-05-06T08:45:00Z", "organizer_email": "h@test",
    }
    (tmp_path / "one.json").write_text(json.dumps(event, indent=1))
    (tmp_path / "lines.json").write_text(json.dumps(event))
    for name, multiline in (("one", True), ("lines", False)):
        raw = readers.read_flat_events(spark, str(tmp_path / f"{name}.json"), multiline)
        assert silver.add_event_duration(raw).first().event_duration == 1800


def test_dt_stays_text_and_prunes(spark, tmp_path):
    path = str(tmp_path / "t")
    writers.write_days(daily(spark, [("a", 1, "2025-07-01"), ("a", 2, "2025-07-02")]), path)
    one = readers.read_days(spark, path, DAILY, "2025-07-02", "2025-07-02")
    assert [(r.booking_id, r.dt) for r in one.collect()] == [(2, "2025-07-02")]
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dt" in plan


def test_missing_table_is_empty_but_other_errors_raise(spark, tmp_path):
    got = readers.read_days_or_empty(spark, str(tmp_path / "none"), schemas.SILVER_SPEND, "d", "d")
    assert got.columns == ["date", "channel", "spend", "dt"] and got.isEmpty()
    with pytest.raises(AnalysisException):
        readers.read_days(spark, str(tmp_path / "none"), schemas.SILVER_SPEND)
    with pytest.raises(ValueError):
        readers.require_columns(got, "date", "shoe")


def test_write_replaces_only_its_days(spark, tmp_path):
    path = str(tmp_path / "t")
    first = [("a", 1, "d1"), ("b", 2, "d1"), ("a", 3, "d2")]
    assert writers.write_days(daily(spark, first), path) == 3
    assert writers.write_days(daily(spark, [("c", 9, "d1")]), path) == 1
    assert stored(spark, path) == [("a", 3, "d2"), ("c", 9, "d1")]
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").upper() == "STATIC"


def test_empty_writes(spark, tmp_path):
    path = str(tmp_path / "t")
    assert writers.write_days(daily(spark, [("a", 1, "d1")]).where("booking_id > 5"), path) == 0
    writers.write_days(daily(spark, [("a", 1, "d1")]), path)
    assert writers.write_days(spark.createDataFrame([], DAILY), path) == 0
    assert stored(spark, path) == [("a", 1, "d1")]


def test_bodies_of_arrays_and_lines(spark, tmp_path):
    (tmp_path / "a.json").write_text('[{"a": 1},\n {"a": 2}]')
    (tmp_path / "b.json").write_text("[{")
    whole = readers.read_bodies(spark, str(tmp_path))
    assert sorted(r.body for r in whole.collect()) == ["[{", '{"a":1}', '{"a":2}']
    (tmp_path / "lines").write_text('{"a":1}\n{"a":2}')
    lines = readers.read_bodies(spark, str(tmp_path / "lines"), multiline=False)
    assert lines.count() == 2


def test_upsert_is_idempotent_and_newest_wins(spark, tmp_path):
    path = str(tmp_path / "spend")
    schema = schemas.SILVER_SPEND

    def load(*rows):
        frame = silver.silver_spend(spark.createDataFrame(list(rows), schemas.SPEND))
        writers.upsert_days(frame, path, schema, ["date", "channel"])
        return sorted(
            (str(r.date), str(r.channel), r.spend)
            for r in readers.read_table(spark, path, schema).collect()
        )

    a, b = ("2031-04-17", "a", 1.0), ("2031-04-18", "a", 2.0)
    assert load(a, b) == [a, b]
    assert load(a, b) == [a, b]
    assert load(("2031-04-17", "a", 0.5)) == [("2031-04-17", "a", 0.5), b]
    none, bad = ("2031-04-17", None, 4.0), ("bad", "a", 5.0)
    everything = [("2031-04-17", "None", 4.0), ("2031-04-17", "a", 0.5), b, bad]
    assert load(none, bad) == everything
    assert load(none) == everything and load(bad) == everything


def test_compaction_keeps_rows_and_other_days(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = [("s%d" % i, i, "d1" if i % 2 else "d2") for i in range(40)]
    daily(spark, rows).repartition(8).write.partitionBy("dt").parquet(path)
    files = {d: len(glob.glob(f"{path}/dt={d}/*.parquet")) for d in ("d1", "d2")}
    assert writers.compact_day(spark, path, "d1") == 20
    assert len(glob.glob(f"{path}/dt=d1/*.parquet")) <= 2 < files["d1"]
    assert len(glob.glob(f"{path}/dt=d2/*.parquet")) == files["d2"]
    assert stored(spark, path) == sorted(rows)
    assert writers.compact_day(spark, path, "d9") == 0


def test_backfill_needs_dt(spark, tmp_path):
    source, target = str(tmp_path / "s"), str(tmp_path / "t")
    daily(spark, [("a", 1, "2025-07-01"), ("b", 2, "2025-07-02")]).write.partitionBy("dt").parquet(source)
    assert writers.backfill_days(spark, source, target, fmt="orc") == 2
    got = readers.read_table(spark, target, DAILY, "orc")
    assert sorted(r.dt for r in got.collect()) == ["2025-07-01", "2025-07-02"]
    spark.range(1).write.parquet(str(tmp_path / "plain"))
    with pytest.raises(ValueError):
        writers.backfill_days(spark, str(tmp_path / "plain"), target)


def test_catalog_finds_new_partitions(spark, tmp_path):
    path, database = str(tmp_path / "t"), "db_" + uuid.uuid4().hex
    writers.write_days(daily(spark, [("a", 1, "d1")]), path)
    for _ in range(2):
        catalog.register_table(spark, database, "daily", path, DAILY)
    assert spark.table(f"{database}.daily").count() == 1
    writers.write_days(daily(spark, [("a", 1, "d2")]), path)
    assert spark.table(f"{database}.daily").count() == 1
    catalog.repair_partitions(spark, database, ["daily"])
    assert spark.table(f"{database}.daily").count() == 2
    comments = {r.col_name: r.comment for r in spark.sql(f"DESCRIBE {database}.daily").collect()}
    assert comments["source"] == "channel"
    spark.sql(f"DROP DATABASE {database} CASCADE")


def test_unpartitioned_overwrite(spark, tmp_path):
    path = str(tmp_path / "t")
    for n in (3, 2):
        writers.write_table(spark.range(n), path)
    assert spark.read.parquet(path).count() == 2


def test_scratch_lies_below_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    assert scratch.shared_dir(spark, "x").startswith(shared + "/x-")
    kept = scratch.materialized(spark.range(5).withColumn("t", F.lit("a")), "kept")
    assert kept.count() == 5 and shared in kept.inputFiles()[0]


def test_compaction_and_upsert_keep_columns_beyond_the_schema(spark, tmp_path):
    path = str(tmp_path / "t")
    daily(spark, [("a", 1, "d1"), ("b", 2, "d1")]).withColumn("note", F.col("source")).write.partitionBy("dt").parquet(path)
    assert writers.compact_day(spark, path, "d1") == 2
    assert {(r.source, r.note) for r in readers.read_stored(spark, path).collect()} == {("a", "a"), ("b", "b")}
    writers.upsert_days(daily(spark, [("a", 9, "d1")]).withColumn("more", F.lit(1)), path, DAILY, ["source"])
    got = {r.source: (r.booking_id, r.note, r.more) for r in readers.read_stored(spark, path).collect()}
    assert got == {"a": (9, None, 1), "b": (2, "b", None)}


def test_a_rerun_without_rows_empties_its_partition(spark, tmp_path):
    path = str(tmp_path / "t")
    writers.write_days(daily(spark, [("a", 1, "d1"), ("b", 2, "d2")]), path)
    for kept in ([("c", 3, "d1")], []):
        frame = daily(spark, kept) if kept else spark.createDataFrame([], DAILY)
        writers.write_days(frame, path, replaces=[{"dt": "d1"}, {"dt": "d9"}])
        assert stored(spark, path) == sorted([*kept, ("b", 2, "d2")])


def test_scratch_is_removed_at_the_end_of_a_job(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(scratch, "_made", [])
    kept = scratch.materialized(spark.range(3), "gone").inputFiles()[0].removeprefix("file://")
    other = tmp_path / "other"
    other.mkdir()
    assert glob.glob(kept)
    scratch.clear(spark)
    assert not glob.glob(kept) and other.exists() and scratch._made == []


def test_days_of_a_stored_table_come_from_its_listing(spark, tmp_path):
    """No file is opened: these are none that could be read."""
    path = str(tmp_path / "mart")
    assert readers.day_bounds(spark, path) == (None, None)
    assert readers.partition_values(spark, path, "dt") == []
    for day in ("2025-01-03", "2024-12-30", "2025-01-01", "__HIVE_DEFAULT_PARTITION__", "a%2Fb"):
        (tmp_path / "mart" / f"dt={day}").mkdir(parents=True)
        (tmp_path / "mart" / f"dt={day}" / "part-0.parquet").write_text("no parquet")
    (tmp_path / "mart" / "dt=2031-01-01").mkdir()  # emptied
    (tmp_path / "mart" / "_SUCCESS").write_text("")
    assert readers.partition_values(spark, path, "dt") == ["2024-12-30", "2025-01-01", "2025-01-03", "a/b"]
    assert serving.stored_date_bounds(spark, path).first() == ("2024-12-30", "a/b")


def test_only_the_newest_day_is_read(spark, tmp_path):
    path = str(tmp_path / "mart")
    rows = [(dt.date(2025, 1, 1), "s", n, f"2025-01-0{n}") for n in (1, 2, 3)]
    schema = schemas.MARTS["bookings_by_source_day"]
    spark.createDataFrame(rows, schema).write.partitionBy("dt").parquet(path)
    shown = readers.read_shown_days(spark, path, schema)
    assert [r.booking_id for r in shown.collect()] == [3]
    plan = shown._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dt" in plan and "Aggregate" not in plan
    assert readers.read_shown_days(spark, path, schema, "2025-01-02").count() == 2
    assert readers.read_shown_days(spark, str(tmp_path / "none"), schema).count() == 0


def test_compaction_leaves_files_that_fit_with_no_other(spark, tmp_path):
    path = str(tmp_path / "t")
    large = [("%064x" % (7**50 * i), i, "d1") for i in range(3000)]
    small = [("s%d" % i, i, "d1") for i in range(12)]
    daily(spark, large).coalesce(1).write.partitionBy("dt").parquet(path)
    (name,) = glob.glob(f"{path}/dt=d1/*.parquet")
    daily(spark, small).repartition(6).write.mode("append").partitionBy("dt").parquet(path)
    assert writers.compact_day(spark, path, "d1", mb=0.01) == 3012
    after = set(glob.glob(f"{path}/dt=d1/*.parquet"))
    assert name in after and len(after) == 2
    assert stored(spark, path) == sorted(large + small)
    assert writers.compact_day(spark, path, "d1", mb=0.01) == 3012
    assert set(glob.glob(f"{path}/dt=d1/*.parquet")) == after


def test_files_are_packed_by_size():
    assert writers._merged({"a": 90, "b": 60, "c": 30, "d": 20, "e": 200}, 100) == ["b", "c"]
    assert writers._merged({"a": 50, "b": 51}, 100) == [] == writers._merged({}, 100)
    assert sorted(writers._merged({"a": 0, "b": 0, "c": 100}, 100)) == ["a", "b", "c"]


def test_a_broken_off_compaction_is_finished(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    rows = [("s%d" % i, i, "d1") for i in range(40)]
    for broken in ("move_all", "delete"):
        daily(spark, rows).repartition(8).write.mode("overwrite").partitionBy("dt").parquet(path)
        with monkeypatch.context() as patch:

            def stop(*_):
                raise InterruptedError

            patch.setattr(writers._Folder, broken, stop)
            with pytest.raises(InterruptedError):
                writers.compact_day(spark, path, "d1")
        assert writers.compact_day(spark, path, "d1") == 40
        assert stored(spark, path) == rows or stored(spark, path) == sorted(rows)
        assert len(glob.glob(f"{path}/dt=d1/*.parquet")) == 1
