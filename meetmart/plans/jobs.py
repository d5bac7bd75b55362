"""One function per job. `python -m meetmart <job> key=value ...` runs them."""

from __future__ import annotations

import logging
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meetmart import schemas
from meetmart.config import RunConfig
from meetmart.operators import contracts, deltas, marts, quality, silver
from meetmart.sources import buckets, catalog, readers, scratch, writers
from meetmart.streaming import ingest

log = logging.getLogger("meetmart")


def mart_path(cfg: RunConfig, mart: str) -> str:
    return f"{cfg.gold_path.rstrip('/')}/{mart}"


def run_ingest(spark: SparkSession, cfg: RunConfig) -> None:
    """Landing zone -> bronze and dead letters, everything there is now."""
    query = ingest.start_ingest(
        spark,
        cfg.webhooks_path,
        cfg.landed_path,
        cfg.checkpoint_path,
        whole_text=cfg.multiline,
        memory=cfg.dedupe_memory,
        max_file_age=cfg.max_file_age,
        max_bytes=cfg.max_batch_bytes,
    )
    query.awaitTermination()


def judged(
    spark: SparkSession, cfg: RunConfig, kind: str, path: str, reasons: Callable[..., DataFrame]
) -> DataFrame:
    """Records of a batch path, each judged by its contract and kept by route and run date.

    Arrays give a row per element, so one bad element costs no other. Returns the accepted ones;
    those refused stay in the dead-letter route with their reasons, and both are counted.
    """
    seen = Observation()
    route = contracts.route_of(contracts.REASONS)
    bodies = reasons(readers.read_bodies(spark, path, cfg.multiline)).withColumns(
        {"route": route, "dt": F.lit(cfg.run_date)}
    )
    accepted = F.col("route") == contracts.BRONZE
    counted = bodies.observe(
        seen, F.count_if(accepted).alias("accepted"), F.count_if(~accepted).alias("dead_letters")
    )
    target = f"{cfg.judged_path.rstrip('/')}/{kind}"
    both = [{"route": r, "dt": cfg.run_date} for r in (contracts.BRONZE, contracts.DEAD_LETTER)]
    writers.write_days(counted, target, by=("route", "dt"), replaces=both)
    log.info("%s: %s", kind, readers.observed(seen))
    landed = readers.read_days_or_empty(spark, target, _JUDGED, cfg.run_date, cfg.run_date)
    return landed.where(F.col("route") == contracts.BRONZE)


def batch_dead_letters(spark: SparkSession, cfg: RunConfig, kind: str) -> DataFrame:
    """What the contract of a batch path refused on the run date, with the reasons."""
    path = f"{cfg.judged_path.rstrip('/')}/{kind}"
    landed = readers.read_days_or_empty(spark, path, _JUDGED, cfg.run_date, cfg.run_date)
    return landed.where(F.col("route") == contracts.DEAD_LETTER).select("body", contracts.REASONS)


def _records(accepted: DataFrame, schema: T.StructType) -> DataFrame:
    return accepted.select(F.from_json("body", schema).alias("r")).select("r.*")


def run_silver(spark: SparkSession, cfg: RunConfig) -> dict[str, int]:
    """Bronze -> silver events of this run date and silver spend of the days in the files.

    From the landed table, only the files that the load before has not read are read, whatever their day, and
    merged into its state: just the buckets that they have keys in are read and written (see
    `sources.buckets`). `rebuild` reads all arrivals up to the run date instead. Returns the rows written. The files that
    loads have read are kept in a table, and joined there: none of their names comes to the driver. A load that
    breaks off leaves files that are read again, which changes nothing.
    """
    path, before, base, unread = cfg.silver_events_path, None, None, None
    if not cfg.landed:
        accepted = judged(spark, cfg, "webhooks", cfg.webhooks_path, contracts.webhook_reasons)
        webhooks = _records(accepted, schemas.WEBHOOK)
    else:
        before = None if cfg.rebuild else buckets.state_before(spark, path, cfg.run_date)
        unread = ingest.unread_files(spark, cfg.landed_path, cfg.run_date, _files_read(spark, cfg, before))
        webhooks = ingest.webhooks_of(spark, cfg.landed_path, unread)
        base = (before and before.base) or cfg.run_date
    _log_rules(webhooks)
    events, kept = silver_load(spark, cfg, before, silver.flatten_webhooks(webhooks))
    _keep_files_read(spark, cfg, unread)
    # A single bucket comes sized out of the shuffle of the duplicate removal: no second shuffle for its files.
    rows = {"events": buckets.write_load(events, path, cfg.run_date, kept, base, cfg.fmt, sized=cfg.buckets > 1)}
    written = _events(spark, cfg)
    # Free-text tags may make the list long, so it comes partition by partition.
    for row in silver.channel_distribution(written).toLocalIterator():
        log.info("channel %s: %s", row["channel"], row["count"])

    spend = judged(spark, cfg, "spend", cfg.spend_path, contracts.flat_spend_reasons)
    rows["spend"] = writers.upsert_days(
        silver.silver_spend(_records(spend, schemas.SPEND)),
        cfg.silver_spend_path,
        schemas.SILVER_SPEND,
        ["date", "channel"],
        fmt=cfg.fmt,
    )
    log.info("silver rows written: %s", rows)
    return rows


def _log_rules(webhooks: DataFrame) -> None:
    """Doubtful times, unlinked reschedules and unpaired cancellations: reported, not removed.

    Repeated webhooks need no rule of their own here: silver keeps the newest per invitee.
    """
    flagged = contracts.webhook_flags(webhooks)
    flags = flagged.select(F.explode("flags").alias("flag")).groupBy("flag").count()
    for row in flags.collect():  # a handful of kinds
        log.info("flag %s: %s webhooks", row["flag"], row["count"])
    for row in contracts.reschedule_pairs(webhooks).groupBy("paired").count().collect():
        log.info("reschedules, paired %s: %s", row["paired"], row["count"])


def silver_load(
    spark: SparkSession, cfg: RunConfig, before: buckets.State | None, flat: DataFrame
) -> tuple[DataFrame, buckets.State | None]:
    """Silver events, with their bucket, of the buckets that new records fall into; and the state that stays.

    A state with another number of buckets is rewritten as a whole.
    """
    def placed(rows: DataFrame) -> DataFrame:
        return rows.withColumn(buckets.BUCKET, buckets.bucket_of(silver.invitee_keys(), cfg.buckets))

    if before is None:
        return placed(silver.add_booking_columns(silver.latest_invitees(flat), cfg.zone)), None
    new = scratch.materialized(placed(silver.latest_invitees(flat)), "silver-new")
    touched = [r[0] for r in new.select(buckets.BUCKET).distinct().collect()]  # no more than buckets
    if not _same_buckets(before, cfg.buckets):
        touched, kept = list(before.versions), None
    else:
        kept = before
    known = buckets.rows_of(spark, cfg.silver_events_path, schemas.SILVER_EVENTS, before, touched, cfg.fmt)
    return placed(silver.merged_invitees(known, new.drop(buckets.BUCKET), cfg.run_date, cfg.zone)), kept


def _reads_path(cfg: RunConfig) -> str:
    return f"{cfg.silver_events_path.rstrip('/')}_reads"


def _files_read(spark: SparkSession, cfg: RunConfig, before: buckets.State | None) -> DataFrame:
    """Landed files that a state stands for; none where that is not known."""
    if before is None or before.base is None:
        return spark.createDataFrame([], _READ).select("file")
    rows = readers.read_days_or_empty(spark, _reads_path(cfg), _READ, before.base, before.day)
    return rows.select("file").distinct()


def _keep_files_read(spark: SparkSession, cfg: RunConfig, files: DataFrame | None) -> None:
    """The files that this load adds to those of the loads before it."""
    if files is not None:
        rows = files.select("file", F.lit(cfg.run_date).alias("dt"))
        writers.write_days(rows, _reads_path(cfg), replaces=[{"dt": cfg.run_date}])


def run_vendor_spend(spark: SparkSession, cfg: RunConfig) -> DataFrame:
    """Vendor spend -> bronze or dead letters -> one silver contract; returns the totals check.

    Bronze is kept by run date and route. Silver takes the accepted rows of this run. The check
    compares the newest accepted rows with what silver holds for them afterwards; its result is
    kept, and the run fails if a total is off.
    """
    landing = readers.read_bodies(spark, cfg.vendor_spend_path, cfg.multiline)
    bodies = contracts.spend_reasons(landing).withColumns(
        {"route": contracts.route_of(contracts.REASONS), "dt": F.lit(cfg.run_date)}
    )
    both = [{"route": r, "dt": cfg.run_date} for r in (contracts.BRONZE, contracts.DEAD_LETTER)]
    writers.write_days(bodies, cfg.vendor_landed_path, by=("route", "dt"), replaces=both)
    landed = readers.read_days_or_empty(
        spark, cfg.vendor_landed_path, _JUDGED, cfg.run_date, cfg.run_date
    )
    accepted = landed.where(F.col("route") == contracts.BRONZE)
    flat = silver.flatten_vendor_spend(_records(accepted, schemas.VENDOR_SPEND))
    latest = scratch.materialized(silver.latest_vendor_spend(flat), "vendor-spend")
    writers.upsert_days(
        latest.withColumn("dt", F.date_format("date", "yyyy-MM-dd")),
        cfg.silver_vendor_path,
        schemas.SILVER_VENDOR_SPEND,
        silver.VENDOR_KEYS,
        fmt=cfg.fmt,
    )
    totals = scratch.materialized(stored_totals(spark, cfg, latest), "totals")
    writers.write_days(
        totals.withColumn("dt", F.lit(cfg.run_date)), cfg.vendor_totals_path,
        replaces=[{"dt": cfg.run_date}],
    )
    off = totals.where("NOT within").count()
    if off:
        raise quality.QualityError(f"{off} spend totals differ between bronze and silver")
    return totals


def stored_totals(spark: SparkSession, cfg: RunConfig, latest: DataFrame) -> DataFrame:
    """Totals of the newest accepted rows against the rows silver stores under their keys."""
    stored = readers.read_table(
        spark, cfg.silver_vendor_path, schemas.SILVER_VENDOR_SPEND, cfg.fmt
    )
    keys = latest.select(*[F.col(k).alias(f"_{k}") for k in silver.VENDOR_KEYS]).distinct()
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in silver.VENDOR_KEYS]
    return contracts.spend_totals_check(latest, stored.join(keys, same, "left_semi"))


_JUDGED = T.StructType(
    [
        T.StructField("body", T.StringType()),
        T.StructField(contracts.REASONS, T.ArrayType(T.StringType())),
        T.StructField("route", T.StringType()),
        T.StructField("dt", T.StringType()),
    ]
)


_READ = T.StructType([T.StructField("file", T.StringType()), T.StructField("dt", T.StringType())])


def _events(spark: SparkSession, cfg: RunConfig, day: str = "") -> DataFrame:
    """Silver events as the load of a day left them, by default of the run date; none without such a load."""
    state = buckets.state_of(spark, cfg.silver_events_path, day or cfg.run_date)
    if state is None:
        return spark.createDataFrame([], schemas.SILVER_EVENTS)
    return buckets.rows_of(spark, cfg.silver_events_path, schemas.SILVER_EVENTS, state, fmt=cfg.fmt)


def _gold_spend(spark: SparkSession, cfg: RunConfig) -> DataFrame:
    first, last = cfg.spend_from or cfg.run_date, cfg.spend_to or cfg.run_date
    return readers.read_days_or_empty(
        spark, cfg.silver_spend_path, schemas.SILVER_SPEND, first, last, cfg.fmt
    ).dropDuplicates()


_KEY_TYPES = {
    "booking_date": T.DateType(), "hour_of_day": T.IntegerType(), "year": T.IntegerType(), "week_of_year": T.IntegerType(),
}


def gold_frames(spark: SparkSession, cfg: RunConfig) -> dict[str, DataFrame]:
    """The six marts of the run date.

    Events are counted for all marts in one job, or with `incremental` moved on from the counts of an earlier load.
    Full-row duplicates in silver events cannot
    change a distinct count, so they are not removed first; in spend they would.
    """
    events = _events(spark, cfg)
    if cfg.active_only:
        events = contracts.active_bookings(events)
    spend = _gold_spend(spark, cfg)
    if cfg.incremental:
        counts = incremental_counts(spark, cfg).withColumn("dt", F.lit(cfg.run_date))
    else:
        counts = scratch.materialized(marts.count_meetings_all(events, cfg.run_date), "mart-counts")
    return marts.marts_from_counts(counts, spend, cfg.run_date)


_COUNTS = T.StructType(
    [
        *[T.StructField(k, _KEY_TYPES.get(k, T.StringType())) for k in deltas.KEYS],
        T.StructField("meetings", T.LongType()),
        T.StructField("facts", T.LongType()),
        T.StructField("silver", T.StringType()),
        T.StructField("dt", T.StringType()),
    ]
)
_FACTS = T.StructType(
    [*_COUNTS.fields[: len(deltas.KEYS)], T.StructField("meeting", T.StringType()),
     T.StructField("copies", T.LongType()), T.StructField("dt", T.StringType())]
)


def incremental_counts(spark: SparkSession, cfg: RunConfig) -> DataFrame:
    """Counts of all marts after the silver load of the run date, moved on from those of an earlier load.

    Only silver buckets that changed between the two loads are read, before and after, and only buckets of facts
    that these changes fall into are read and written. Without earlier counts, or where the load that they were made
    from has been run again since, all is counted anew. `facts` and `counts` lie below `gold_state_path`.
    """
    if cfg.active_only:
        raise ValueError("a canceled record takes away others: active_only needs a full count")
    path = f"{cfg.gold_state_path.rstrip('/')}/facts"
    counts_path = f"{cfg.gold_state_path.rstrip('/')}/counts"
    now = buckets.state_of(spark, cfg.silver_events_path, cfg.run_date)
    if now is None:
        return spark.createDataFrame([], _COUNTS)
    known = buckets.state_before(spark, path, cfg.run_date)
    then = buckets.state_of(spark, cfg.silver_events_path, known.day) if known else None
    if then is None or known.base != then.made or not _same_buckets(known, cfg.buckets):
        known = then = None
    changed = buckets.changed_buckets(then, now)

    def silver_rows(state: buckets.State | None) -> DataFrame:
        if state is None:
            return spark.createDataFrame([], schemas.SILVER_EVENTS)
        return buckets.rows_of(spark, cfg.silver_events_path, schemas.SILVER_EVENTS, state, changed, cfg.fmt)

    place = buckets.bucket_of(deltas.FACT, cfg.buckets)
    changes = deltas.fact_changes(silver_rows(then), silver_rows(now)).withColumn(buckets.BUCKET, place)
    changes = scratch.materialized(changes, "fact-changes")
    touched = [r[0] for r in changes.select(buckets.BUCKET).distinct().collect()]  # no more than buckets
    facts = spark.createDataFrame([], _FACTS)
    counts = spark.createDataFrame([], _COUNTS)
    if known:
        facts = buckets.rows_of(spark, path, _FACTS, known, touched, cfg.fmt)
        counts = readers.read_days(spark, counts_path, _COUNTS, known.day, known.day, cfg.fmt)
    moved = scratch.materialized(deltas.changed_facts(facts, changes), "changed-facts")
    after = deltas.moved_counts(counts, deltas.count_changes(moved))
    stamped = after.withColumns({"silver": F.lit(now.made), "dt": F.lit(cfg.run_date)})
    writers.write_days(stamped, counts_path, fmt=cfg.fmt, replaces=[{"dt": cfg.run_date}])
    left = moved.where("copies > 0").select(*deltas.FACT, "copies").withColumn(buckets.BUCKET, place)
    buckets.write_load(left, path, cfg.run_date, known, now.made, cfg.fmt)
    return readers.read_days(spark, counts_path, _COUNTS, cfg.run_date, cfg.run_date, cfg.fmt)


def _same_buckets(state: buckets.State, number: int) -> bool:
    return all(name.endswith(f"-of-{number:05d}") for name in state.versions)


def run_gold(spark: SparkSession, cfg: RunConfig) -> dict[str, int]:
    rows = {}
    for mart, frame in gold_frames(spark, cfg).items():
        rows[mart] = writers.write_days(
            frame, mart_path(cfg, mart), fmt=cfg.fmt, replaces=[{"dt": cfg.run_date}]
        )
        log.info("%s: %s rows for %s", mart, rows[mart], cfg.run_date)
    spend = _gold_spend(spark, cfg)
    lost = marts.unmatched_spend(_events(spark, cfg), spend, cfg.run_date)
    for row in lost.collect():  # one row per channel
        log.info("spend without bookings: %s %s", row["source"], row["total_spend"])
    return rows


def read_marts(spark: SparkSession, cfg: RunConfig) -> dict[str, DataFrame]:
    """The marts as stored, so that a column that a file lacks is absent and not null."""
    return {
        mart: readers.read_stored(spark, mart_path(cfg, mart), cfg.fmt) for mart in schemas.MARTS
    }


def run_validate(spark: SparkSession, cfg: RunConfig, day: str | None = None) -> DataFrame:
    """Check the newest day of the gold tables, keep the results, fail if any check failed."""
    tables = read_marts(spark, cfg)
    day = day or readers.day_bounds(spark, mart_path(cfg, next(iter(schemas.MARTS))))[1]
    if day is None:
        raise quality.QualityError("gold is empty")
    checks = scratch.materialized(quality.gold_checks(tables, day), "checks")
    writers.write_days(checks, cfg.metrics_path)
    quality.raise_on_failure(checks)
    return checks


def run_compact(spark: SparkSession, cfg: RunConfig) -> dict[str, int]:
    return {
        mart: writers.compact_day(spark, mart_path(cfg, mart), cfg.run_date, fmt=cfg.fmt)
        for mart in schemas.MARTS
    }


def run_compact_landed(spark: SparkSession, cfg: RunConfig) -> int:
    """The landed batches of the run date become one partition per route."""
    return ingest.compact_landed(spark, cfg.landed_path, cfg.run_date)


def run_register(spark: SparkSession, cfg: RunConfig) -> None:
    for mart, schema in schemas.MARTS.items():
        path = mart_path(cfg, mart)
        catalog.register_table(spark, cfg.database, f"gold_{mart}", path, schema, fmt=cfg.fmt)


def run_repair(spark: SparkSession, cfg: RunConfig) -> None:
    catalog.repair_partitions(spark, cfg.database, [f"gold_{mart}" for mart in schemas.MARTS])


def run_backfill(spark: SparkSession, cfg: RunConfig) -> int:
    """Copy silver events into another format, the state of each load as one `dt`."""
    return sum(
        writers.write_days(_events(spark, cfg, day), cfg.backfill_path, fmt=cfg.backfill_fmt)
        for day in buckets.load_days(spark, cfg.silver_events_path)
    )


def run_flat_silver(spark: SparkSession, cfg: RunConfig) -> None:
    """Flat events -> unpartitioned silver table with the duration added."""
    accepted = judged(spark, cfg, "flat_events", cfg.flat_events_path, contracts.flat_event_reasons)
    events = _records(accepted, schemas.FLAT_EVENT)
    writers.write_table(silver.add_event_duration(events), cfg.flat_silver_path, cfg.fmt)


def run_flat_gold(spark: SparkSession, cfg: RunConfig) -> None:
    events = readers.read_table(spark, cfg.flat_silver_path, fmt=cfg.fmt)
    log.info("silver schema: %s", events.schema.simpleString())
    summary = marts.events_by_type_day if cfg.by_day else marts.events_by_type
    writers.write_table(summary(events), cfg.flat_gold_path, cfg.fmt)


JOBS = {
    "ingest": run_ingest,
    "silver": run_silver,
    "vendor-spend": run_vendor_spend,
    "gold": run_gold,
    "validate": run_validate,
    "compact": run_compact,
    "compact-landed": run_compact_landed,
    "register": run_register,
    "repair": run_repair,
    "backfill": run_backfill,
    "flat-silver": run_flat_silver,
    "flat-gold": run_flat_gold,
}
