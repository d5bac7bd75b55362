"""Landed records -> silver tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meetmart.config import REPORT_ZONE
from meetmart.functions.channels import booking_channel, uri_tail
from meetmart.functions.timeparts import day, instant, local_wall, seconds_between, weekday_name
from meetmart.operators.dedupe import keep_latest

# Silver column -> place in the webhook.
WEBHOOK_COLUMNS = {
    "webhook_created_at": "created_at",
    "webhook_created_by": "created_by",
    "webhook_event": "event",
    "invitee_name": "payload.name",
    "invitee_email": "payload.email",
    "invitee_timezone": "payload.timezone",
    "invitee_uri": "payload.uri",
    "cancel_url": "payload.cancel_url",
    "reschedule_url": "payload.reschedule_url",
    "invitee_status": "payload.status",
    "scheduling_method": "payload.scheduling_method",
    "is_rescheduled": "payload.rescheduled",
    "invitee_created_at": "payload.created_at",
    "invitee_updated_at": "payload.updated_at",
    "questions_and_answers_json": "payload.questions_and_answers",
    "scheduled_event_uri": "payload.scheduled_event.uri",
    "scheduled_event_name": "payload.scheduled_event.name",
    "event_type_uri": "payload.scheduled_event.event_type",
    "event_start_time_utc": "payload.scheduled_event.start_time",
    "event_end_time_utc": "payload.scheduled_event.end_time",
    "event_status": "payload.scheduled_event.status",
    "host_user_uri": "user",
    "host_user_email": "user_email",
    "host_user_name": "user_name",
    "utm_source": "payload.tracking.utm_source",
    "utm_medium": "payload.tracking.utm_medium",
    "utm_campaign": "payload.tracking.utm_campaign",
    "utm_term": "payload.tracking.utm_term",
    "utm_content": "payload.tracking.utm_content",
}


def flatten_webhooks(webhooks: DataFrame) -> DataFrame:
    """Nested webhooks -> one flat row each; the host is the first member, if there is one."""
    host = F.get("payload.scheduled_event.event_memberships", F.lit(0))

    def source(name: str, path: str) -> Column:
        if name.startswith("host_"):
            return host[path]
        if name == "questions_and_answers_json":
            return F.to_json(path)
        return F.col(path)

    return webhooks.select(*[source(n, p).alias(n) for n, p in WEBHOOK_COLUMNS.items()])


def invitee_keys() -> list[Column]:
    """What tells invitees and their meetings apart."""
    who = F.coalesce("invitee_uri", F.concat_ws("_", "invitee_email", "event_start_time_utc"))
    return [who, F.col("scheduled_event_uri")]


def latest_invitees(flat: DataFrame) -> DataFrame:
    """Newest record per invitee and meeting, by parsed time (text order misplaces fractions).

    Equal creation times are common, as they belong to the invitee and not to the webhook, so
    update and send time decide next and the remaining columns make the order total.
    """
    times = ("invitee_created_at", "invitee_updated_at", "webhook_created_at")
    rest = [c for c in flat.columns if c not in ("invitee_uri", "scheduled_event_uri", "webhook_event")]
    order = [
        *[instant(F.col(c)).desc_nulls_last() for c in times],
        *[F.col(c).asc_nulls_last() for c in ("webhook_event", *rest)],
    ]
    return keep_latest(flat, invitee_keys(), order)


def add_booking_columns(flat: DataFrame, zone: str = REPORT_ZONE) -> DataFrame:
    """Instants, local times, link id and channel of each booking."""
    start, end = instant(F.col("event_start_time_utc")), instant(F.col("event_end_time_utc"))
    return (
        flat.withColumns({"event_start_ts": start, "event_end_ts": end})
        .withColumns(
            {
                "event_start_local": local_wall(F.col("event_start_ts"), zone),
                "event_end_local": local_wall(F.col("event_end_ts"), zone),
            }
        )
        .withColumns(
            {
                "booking_date": F.to_date("event_start_local"),
                "booking_hour": F.hour("event_start_local"),
                "day_of_week": weekday_name(F.col("event_start_local")),
                "event_type_id": uri_tail(F.col("event_type_uri")),
            }
        )
        .withColumn("channel", booking_channel(F.col("event_type_id"), F.col("utm_source")))
    )


def silver_events(webhooks: DataFrame, run_date: str, zone: str = REPORT_ZONE) -> DataFrame:
    """Webhooks -> silver events of one load. Duplicates go before columns are added."""
    latest = latest_invitees(flatten_webhooks(webhooks))
    return add_booking_columns(latest, zone).withColumn("dt", F.lit(run_date))


def merged_silver_events(
    before: DataFrame, webhooks: DataFrame, run_date: str, zone: str = REPORT_ZONE
) -> DataFrame:
    """Silver events of the day before and newly arrived webhooks -> silver events of one load.

    The same as one load of all webhooks so far: keeping the newest of what was kept and what
    is new loses nothing, and a webhook that comes twice changes nothing.
    """
    return merged_invitees(before, flatten_webhooks(webhooks), run_date, zone)


def merged_invitees(
    before: DataFrame, flat: DataFrame, run_date: str, zone: str = REPORT_ZONE
) -> DataFrame:
    """`merged_silver_events` for new records that are flat already."""
    latest = latest_invitees(before.select(*WEBHOOK_COLUMNS).unionByName(flat))
    return add_booking_columns(latest, zone).withColumn("dt", F.lit(run_date))


def silver_spend(raw: DataFrame) -> DataFrame:
    """One row per day and channel, dated by the day; of several amounts the largest is kept.

    Keeping the maximum is an aggregate: it combines on the map side and needs no sort.
    """
    return (
        raw.groupBy("date", "channel")
        .agg(F.max("spend").alias("spend"))
        .withColumn("dt", F.date_format(day(F.col("date")), "yyyy-MM-dd"))
    )


def flatten_vendor_spend(raw: DataFrame) -> DataFrame:
    """Vendor spend with its structs spread out; the grain defaults to day, null metrics to 0."""
    parts = raw.select(
        "source",
        F.coalesce("granularity", F.lit("day")).alias("granularity"),
        day(F.col("date")).alias("date"),
        "timezone",
        "ids.*",
        "names.*",
        "metrics.*",
        "currency",
        F.col("attribution.window").alias("attribution_window"),
        F.col("attribution.model").alias("attribution_model"),
        "provenance.*",
        F.to_json("extra").alias("extra"),
    )
    metrics = raw.schema["metrics"].dataType.names
    return parts.withColumns({m: F.coalesce(m, F.lit(0.0)) for m in metrics})


VENDOR_KEYS = ("source", "date", "campaign_id", "currency", "granularity", "load_id")


def latest_vendor_spend(flat: DataFrame) -> DataFrame:
    """Last extracted row per source, day, campaign, currency, grain and load."""
    rest = [c for c in flat.columns if c not in (*VENDOR_KEYS, "extracted_at")]
    order = [instant(F.col("extracted_at")), *[F.col(c) for c in ("extracted_at", *rest)]]
    return keep_latest(flat, VENDOR_KEYS, [c.desc_nulls_last() for c in order])


def add_event_duration(events: DataFrame) -> DataFrame:
    """Flat events: parse the time columns there are and add the duration in seconds if both ends exist."""
    times = [c for c in ("event_start_time", "event_end_time", "created_at") if c in events.columns]
    texts = [c for c in times if dict(events.dtypes)[c] == "string"]
    typed = events.withColumns({c: instant(F.col(c)) for c in texts})
    if not {"event_start_time", "event_end_time"} <= set(times):
        return typed
    seconds = seconds_between(F.col("event_start_time"), F.col("event_end_time"))
    return typed.withColumn("event_duration", seconds)


def channel_distribution(events: DataFrame) -> DataFrame:
    """Rows per channel, most frequent first."""
    return (
        events.groupBy("channel")
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy(F.desc("count"), "channel")
    )
