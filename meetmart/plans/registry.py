"""Every operator as a query over the given tables, with SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meetmart import schemas
from meetmart.config import RunConfig
from meetmart.functions import display, timeparts
from meetmart.functions.channels import LINK_CHANNELS, booking_channel, spend_channel, uri_tail
from meetmart.operators import chains, contracts, dedupe, marts, quality, serving, silver
from meetmart.plans import inputs, jobs
from meetmart.sources import buckets, catalog, readers, scratch, writers
from meetmart.streaming import ingest

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

RUN = "2024-01-31"


def query(sql: str, name: str = "") -> Callable[[Query], Query]:
    def add(function: Query) -> Query:
        QUERIES[name or function.__name__] = function
        SQL[name or function.__name__] = sql
        return function

    return add


def as_text(df: DataFrame) -> DataFrame:
    """Dates and times as text, so that engines compare by value and not by type."""
    forms = {T.DateType(): "yyyy-MM-dd", T.TimestampNTZType(): "yyyy-MM-dd HH:mm:ss"}
    return df.select(
        *[
            F.date_format(f.name, forms[f.dataType]).alias(f.name)
            if f.dataType in forms
            else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )


# ---- SQL building blocks

_L1, _L2, _L3 = LINK_CHANNELS
EVENTS = f"""
e AS (
  SELECT event_id, ts, user_id, event_type, value,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS k
  FROM events),
s AS (
  SELECT event_id, ts, user_id, event_type, k,
    'host_' || CAST(user_id % 20 AS VARCHAR) AS host_user_name,
    CASE WHEN k % 25 <> 24 THEN 'scheduled_events/' || CAST(event_id // 2 AS VARCHAR) END
      AS scheduled_event_uri,
    CASE k WHEN 1 THEN '{_L1}' WHEN 2 THEN '{_L2}' WHEN 3 THEN '{_L3}' WHEN 7 THEN ''
      ELSE CAST(k AS VARCHAR) END AS campaign,
    CASE WHEN k = 1 THEN 'facebook' WHEN k = 2 THEN 'youtube' WHEN k = 3 THEN 'tiktok'
      WHEN k = 5 THEN 'unknown' ELSE event_type END AS source,
    timezone('America/New_York', ts AT TIME ZONE 'UTC') AS local,
    strftime(timezone('America/New_York', ts AT TIME ZONE 'UTC'), '%Y-%m-%d') AS booking_date,
    strftime(ts, '%Y-%m-%d') AS dt
  FROM e)"""
SPEND = """
p AS (
  SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS date, o_totalprice AS spend,
    CASE o_orderpriority WHEN '1-URGENT' THEN 'facebook' WHEN '2-HIGH' THEN 'youtube'
      WHEN '3-MEDIUM' THEN 'tiktok' WHEN '4-NOT SPECIFIED' THEN 'click'
      ELSE CASE WHEN o_orderstatus <> 'P' THEN 'billboard' END END AS source,
    strftime(DATE '2024-01-01' + CAST(o_orderkey % 30 AS INTEGER), '%Y-%m-%d') AS dt
  FROM orders)"""


def money(column: str) -> str:
    return f"CAST(sum(CAST({column} AS DECIMAL(28,6))) AS DOUBLE)"


_MEETINGS = "count(DISTINCT scheduled_event_uri)"


def _ratio(total: str, units: str) -> str:
    return f"CASE WHEN {units} > 0 THEN {total} / {units} END"


def _cost(keys: str, day: str) -> str:
    """Counts by keys joined with spend by channel; `day` is a column or a literal."""
    return f"""
  SELECT b.*, coalesce(x.total_spend, 0.0) AS total_spend,
         {_ratio('coalesce(x.total_spend, 0.0)', 'b.total_bookings')} AS cpb
  FROM (SELECT {day} AS dt, {keys}, {_MEETINGS} AS total_bookings FROM s GROUP BY ALL) b
  LEFT JOIN (SELECT {day} AS dt, source, {money('spend')} AS total_spend FROM p GROUP BY ALL) x
    ON b.dt = x.dt AND b.source = x.source"""


DAILY_DAYS = f"m AS (SELECT booking_date, source, {_MEETINGS} AS booking_id, dt FROM s GROUP BY ALL)"
SLOT_DAYS = f"""m AS (
  SELECT CAST(hour(local) AS INTEGER) AS hour_of_day, strftime(local, '%a') AS day_of_week, source,
         {_MEETINGS} AS booking_id, dt FROM s GROUP BY ALL)"""
WEEK_DAYS = f"""m AS (
  SELECT host_user_name, year(local) AS year, week(local) AS week_of_year,
         {_MEETINGS} AS meetings, dt FROM s GROUP BY ALL)"""
COST_DAYS = f"m AS ({_cost('source', 'dt')})"
ATTR_DAYS = f"m AS ({_cost('source, campaign', 'dt')})"


def _bookings(spark, sf_dir):
    return inputs.silver_events(spark, sf_dir)


def _daily_mart(spark, sf_dir):
    return marts.bookings_by_source_day(_bookings(spark, sf_dir))


def _trend_mart(spark, sf_dir):
    return marts.bookings_trend_over_time(_bookings(spark, sf_dir))


def _cost_mart(spark, sf_dir):
    return marts.cost_per_booking_by_channel(_bookings(spark, sf_dir), inputs.spend(spark, sf_dir))


def _attribution_mart(spark, sf_dir):
    return marts.channel_attribution_leaderboard(_bookings(spark, sf_dir), inputs.spend(spark, sf_dir))


def _slot_mart(spark, sf_dir):
    return marts.bookings_by_timeslot(_bookings(spark, sf_dir))


def _week_mart(spark, sf_dir):
    return marts.meetings_per_employee_week(_bookings(spark, sf_dir))


# ---- gold marts


@query(f"WITH {EVENTS}, {SPEND}, m AS ({_cost('source', f"'{RUN}'")}) "
       "SELECT source AS channel, total_spend, total_bookings, cpb, dt FROM m")
def cpb_by_channel(spark, sf_dir):
    return marts.cost_per_booking_by_channel(
        _bookings(spark, sf_dir), inputs.spend(spark, sf_dir), RUN
    )


@query(f"WITH {EVENTS} SELECT booking_date, source, {_MEETINGS} AS booking_id, '{RUN}' AS dt "
       "FROM s GROUP BY ALL")
def daily_calls_by_source(spark, sf_dir):
    return as_text(marts.bookings_by_source_day(_bookings(spark, sf_dir), RUN))


@query(SQL["daily_calls_by_source"])
def bookings_trend(spark, sf_dir):
    return as_text(marts.bookings_trend_over_time(_bookings(spark, sf_dir), RUN))


@query(f"WITH {EVENTS}, {SPEND}, m AS ({_cost('source, campaign', f"'{RUN}'")}) "
       "SELECT source, campaign, total_bookings, total_spend AS spend, cpb, dt FROM m")
def channel_attribution(spark, sf_dir):
    return marts.channel_attribution_leaderboard(
        _bookings(spark, sf_dir), inputs.spend(spark, sf_dir), RUN
    )


@query(f"WITH {EVENTS} SELECT CAST(hour(local) AS INTEGER) AS hour_of_day, "
       f"strftime(local, '%a') AS day_of_week, source, {_MEETINGS} AS booking_id, '{RUN}' AS dt "
       "FROM s GROUP BY ALL")
def bookings_timeslot(spark, sf_dir):
    return marts.bookings_by_timeslot(_bookings(spark, sf_dir), RUN)


@query(f"WITH {EVENTS} SELECT host_user_name, CAST(year(local) AS INTEGER) AS year, "
       f"CAST(week(local) AS INTEGER) AS week_of_year, {_MEETINGS} AS meetings, "
       f"CAST({_MEETINGS} AS DOUBLE) AS avg_meetings_per_week, '{RUN}' AS dt "
       "FROM s GROUP BY host_user_name, year(local), week(local)")
def meetings_per_employee_week(spark, sf_dir):
    return marts.meetings_per_employee_week(_bookings(spark, sf_dir), RUN)


_ALL_COUNTS = f"""
WITH {EVENTS}, g AS (
  SELECT booking_date, source, campaign, CAST(hour(local) AS INTEGER) AS hour_of_day,
         strftime(local, '%a') AS day_of_week, host_user_name, CAST(year(local) AS INTEGER) AS year,
         CAST(week(local) AS INTEGER) AS week_of_year, scheduled_event_uri, dt FROM s)
SELECT 'bookings_by_source_day' AS mart, dt, booking_date, source, NULL AS campaign,
  NULL AS hour_of_day, NULL AS day_of_week, NULL AS host_user_name, NULL AS year,
  NULL AS week_of_year, {_MEETINGS} AS meetings FROM g GROUP BY dt, booking_date, source
UNION ALL
SELECT 'cost_per_booking_by_channel', dt, NULL, source, NULL, NULL, NULL, NULL, NULL, NULL,
  {_MEETINGS} FROM g GROUP BY dt, source
UNION ALL
SELECT 'channel_attribution_leaderboard', dt, NULL, source, campaign, NULL, NULL, NULL, NULL, NULL,
  {_MEETINGS} FROM g GROUP BY dt, source, campaign
UNION ALL
SELECT 'bookings_by_timeslot', dt, NULL, source, NULL, hour_of_day, day_of_week, NULL, NULL, NULL,
  {_MEETINGS} FROM g GROUP BY dt, source, hour_of_day, day_of_week
UNION ALL
SELECT 'meetings_per_employee_week', dt, NULL, NULL, NULL, NULL, NULL, host_user_name, year,
  week_of_year, {_MEETINGS} FROM g GROUP BY dt, host_user_name, year, week_of_year"""


@query(_ALL_COUNTS)
def all_mart_counts(spark, sf_dir):
    """Every mart's counts for every day, in one job."""
    return as_text(marts.count_meetings_all(_bookings(spark, sf_dir)))


@query(f"WITH {EVENTS}, {SPEND}, m AS ({_cost('source', f"'{RUN}'")}) "
       f"SELECT source, {money('spend')} AS total_spend, '{RUN}' AS dt FROM p "
       "WHERE source IS NULL OR source NOT IN (SELECT source FROM m) GROUP BY source")
def unmatched_spend(spark, sf_dir):
    return marts.unmatched_spend(_bookings(spark, sf_dir), inputs.spend(spark, sf_dir), RUN)


@query(f"WITH {SPEND} SELECT date AS spend_date, source AS spend_channel, "
       f"{money('spend')} AS spend_total FROM p GROUP BY date, source")
def spend_by_day_channel(spark, sf_dir):
    return as_text(marts.spend_by_day_channel(inputs.spend(spark, sf_dir)))


# ---- flat events

_FLAT = """
WITH f AS (
  SELECT event_type, ts, k, CASE WHEN k <> 9 THEN k * 60 END AS seconds FROM (
    SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events))"""


def _timed(spark, sf_dir):
    return silver.add_event_duration(inputs.flat_events(spark, sf_dir))


@query(f"{_FLAT} SELECT event_type, count(*) AS total_events, avg(seconds) AS avg_duration_seconds "
       "FROM f GROUP BY event_type")
def events_by_type(spark, sf_dir):
    return marts.events_by_type(_timed(spark, sf_dir))


@query(f"{_FLAT} SELECT event_type, strftime(ts, '%Y-%m-%d') AS event_date, "
       "count(*) AS total_events, avg(seconds) AS avg_duration_seconds FROM f GROUP BY ALL")
def events_by_type_day(spark, sf_dir):
    return as_text(marts.events_by_type_day(_timed(spark, sf_dir)))


@query("""
SELECT 'host_' || CAST(user_id % 20 AS VARCHAR) AS event_type,
  CASE WHEN CAST(json_extract_string(props, '$.k') AS INTEGER) <> 9
    THEN strftime(ts, '%Y-%m-%d') END AS event_date,
  count(*) AS total_events,
  avg(CASE WHEN CAST(json_extract_string(props, '$.k') AS INTEGER) <> 9
    THEN CAST(json_extract_string(props, '$.k') AS BIGINT) * 60 END) AS avg_duration_seconds
FROM events GROUP BY ALL""")
def events_by_organizer_day(spark, sf_dir):
    """The same summary where the table has neither a type nor a creation time."""
    narrow = inputs.flat_events(spark, sf_dir).drop("event_type", "created_at")
    return as_text(marts.events_by_type_day(silver.add_event_duration(narrow)))


@query(f"{_FLAT} SELECT event_type, strftime(ts, '%Y-%m-%d %H:%M:%S') AS at, seconds FROM f")
def event_duration(spark, sf_dir):
    return _timed(spark, sf_dir).select(
        "event_type",
        F.date_format("created_at", "yyyy-MM-dd HH:mm:ss").alias("at"),
        F.col("event_duration").alias("seconds"),
    )


# ---- silver


@query("""
SELECT event_type, user_id, event_id, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS n
  FROM events) WHERE n = 1""")
def dedupe_latest(spark, sf_dir):
    events = inputs.table(spark, sf_dir, "events").select(
        "event_type", "user_id", "event_id", "value", "ts"
    )
    latest = dedupe.keep_latest(
        events, ["user_id", "event_type"], [F.desc("ts"), F.desc("event_id")]
    )
    return latest.drop("ts")


@query("SELECT DISTINCT user_id, event_type FROM events")
def distinct_rows(spark, sf_dir):
    return dedupe.distinct_rows(
        inputs.table(spark, sf_dir, "events").select("user_id", "event_type")
    )


_WEBHOOK = f"""
WITH {EVENTS}, w AS (
  SELECT event_id, user_id, event_type, k, ts, campaign, host_user_name, local, source,
    'invitees/' || CAST(user_id AS VARCHAR) AS invitee_uri,
    'scheduled_events/' || CAST(user_id AS VARCHAR) || '-' || event_type AS scheduled_event_uri
  FROM s)"""


_SENT = "strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ')"
_WEBHOOK_VALUES = {
    "webhook_created_at": _SENT,
    "webhook_event": "'invitee.created'",
    "invitee_name": "'person_' || CAST(user_id AS VARCHAR)",
    "invitee_uri": "invitee_uri",
    "invitee_created_at": _SENT,
    "invitee_updated_at": _SENT,
    "questions_and_answers_json": """'[{"question":"How many?","answer":"' || CAST(k AS VARCHAR) || '"}]'""",
    "scheduled_event_uri": "scheduled_event_uri",
    "event_type_uri": "'event_types/' || campaign",
    "event_start_time_utc": _SENT,
    "event_end_time_utc": "strftime(ts + to_minutes(k), '%Y-%m-%dT%H:%M:%S.%fZ')",
    "host_user_uri": "CASE WHEN k % 25 <> 24 THEN 'users/' || CAST(user_id % 20 AS VARCHAR) END",
    "host_user_name": "CASE WHEN k % 25 <> 24 THEN host_user_name END",
    "utm_source": "CASE WHEN k <> 5 THEN upper(event_type) END",
}
_WEBHOOK_SELECT = ", ".join(
    f"{_WEBHOOK_VALUES.get(c, 'CAST(NULL AS VARCHAR)')} AS {c}"
    if c != "is_rescheduled"
    else "CAST(NULL AS BOOLEAN) AS is_rescheduled"
    for c in silver.WEBHOOK_COLUMNS
)


@query(f"{_WEBHOOK} SELECT {_WEBHOOK_SELECT} FROM w")
def flatten_webhook(spark, sf_dir):
    return silver.flatten_webhooks(inputs.webhooks(spark, sf_dir))


_SILVER = f"""{_WEBHOOK}
SELECT invitee_uri, scheduled_event_uri, campaign AS event_type_id, source AS channel,
  strftime(local, '%Y-%m-%d') AS booking_date, CAST(hour(local) AS INTEGER) AS booking_hour,
  strftime(local, '%A') AS day_of_week, strftime(local, '%Y-%m-%d %H:%M:%S') AS event_start_local,
  '{RUN}' AS dt
FROM (SELECT *, row_number() OVER (PARTITION BY invitee_uri, scheduled_event_uri
        ORDER BY ts DESC, event_id DESC) AS n FROM w) WHERE n = 1"""
_SILVER_COLUMNS = (
    "invitee_uri", "scheduled_event_uri", "event_type_id", "channel", "booking_date",
    "booking_hour", "day_of_week", "event_start_local", "dt",
)


@query(_SILVER)
def silver_from_webhooks(spark, sf_dir):
    """JSON text to silver: parse, flatten, keep the latest, local time, channel."""
    frame = silver.silver_events(inputs.webhooks(spark, sf_dir), RUN)
    return as_text(frame.select(*_SILVER_COLUMNS))


@query(_SILVER)
def silver_in_two_loads(spark, sf_dir):
    """What arrives later is merged into the silver events of the load before."""
    hooks = inputs.webhooks(spark, sf_dir)
    later = F.crc32("payload.created_at") % 3 == 0
    before = silver.silver_events(hooks.where(~later), "2024-01-30")
    both = silver.merged_silver_events(before, hooks.where(later), RUN)
    return as_text(both.select(*_SILVER_COLUMNS))


@query(_SILVER)
def silver_in_buckets(spark, sf_dir):
    """Three loads into silver kept by key, each reading and writing only the buckets it has keys in."""
    cfg = RunConfig(RUN, silver_events_path=scratch.shared_dir(spark, "silver"), buckets=16)
    hooks = inputs.webhooks(spark, sf_dir)
    part = F.crc32("payload.created_at") % 3
    state = None
    for number, day in enumerate(("2024-01-29", "2024-01-30", RUN)):
        load = replace(cfg, run_date=day)
        flat = silver.flatten_webhooks(hooks.where(part == number))
        events, kept = jobs.silver_load(spark, load, state, flat)
        buckets.write_load(events, cfg.silver_events_path, day, kept, base=None)
        state = buckets.state_of(spark, cfg.silver_events_path, day)
    rows = buckets.rows_of(spark, cfg.silver_events_path, schemas.SILVER_EVENTS, state)
    return as_text(rows.select(*_SILVER_COLUMNS))


# the newest webhook per invitee and meeting, as the bookings that marts count
_LATEST_BOOKINGS = f"""{EVENTS.replace("scheduled_event_uri", "other_uri").replace("s AS (", "all_bookings AS (")}, s AS (
  SELECT * EXCLUDE (host_user_name, dt), CASE WHEN k % 25 <> 24 THEN host_user_name END AS host_user_name, '{RUN}' AS dt,
    'scheduled_events/' || CAST(user_id AS VARCHAR) || '-' || event_type AS scheduled_event_uri
  FROM all_bookings
  QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1)"""


@query(_ALL_COUNTS.replace(EVENTS, _LATEST_BOOKINGS))
def incremental_marts(spark, sf_dir):
    """Counts of all marts moved on over three loads; later loads replace records of earlier ones."""
    root = scratch.shared_dir(spark, "incremental")
    cfg = RunConfig(RUN, silver_events_path=f"{root}/silver", gold_state_path=f"{root}/state", buckets=8)
    hooks = inputs.webhooks(spark, sf_dir)
    part = F.crc32("payload.created_at") % 3
    for number, day in enumerate(("2024-01-29", "2024-01-30", RUN)):
        load = replace(cfg, run_date=day)
        before = buckets.state_before(spark, cfg.silver_events_path, day)
        events, kept = jobs.silver_load(spark, load, before, silver.flatten_webhooks(hooks.where(part == number)))
        buckets.write_load(events, cfg.silver_events_path, day, kept, base=None)
        counts = jobs.incremental_counts(spark, load)
    return as_text(counts.drop("facts", "silver"))


@query(f"""{_WEBHOOK}
SELECT CASE WHEN user_id % 3 <> 0 THEN invitee_uri END AS invitee_uri, scheduled_event_uri, {_SENT} AS start
FROM (SELECT *, row_number() OVER (
    PARTITION BY CASE WHEN user_id % 3 <> 0 THEN invitee_uri ELSE {_SENT} END, scheduled_event_uri
    ORDER BY ts DESC, event_id DESC) AS n FROM w) WHERE n = 1""")
def latest_without_uri(spark, sf_dir):
    """Invitees without a uri are told apart by mail address and start."""
    flat = silver.flatten_webhooks(inputs.webhooks(spark, sf_dir))
    user = F.substring_index("invitee_uri", "/", -1).cast("long")
    some = flat.withColumn("invitee_uri", F.when(user % 3 != 0, F.col("invitee_uri")))
    return silver.latest_invitees(some).select(
        "invitee_uri", "scheduled_event_uri", F.col("event_start_time_utc").alias("start")
    )


@query(f"""{_WEBHOOK}
SELECT source AS channel, count(*) AS count FROM (SELECT *, row_number() OVER (
  PARTITION BY invitee_uri, scheduled_event_uri ORDER BY ts DESC, event_id DESC) AS n FROM w)
WHERE n = 1 GROUP BY source""")
def channel_distribution(spark, sf_dir):
    return silver.channel_distribution(silver.silver_events(inputs.webhooks(spark, sf_dir), RUN))


@query(f"WITH {EVENTS} SELECT event_id, campaign AS tail FROM s", name="uri_tail")
def uri_tail_of_links(spark, sf_dir):
    return _bookings(spark, sf_dir).select(
        "event_id", uri_tail(F.col("event_type_uri")).alias("tail")
    )


@query(f"WITH {EVENTS} SELECT event_id, source AS channel FROM s")
def channel_coalesce(spark, sf_dir):
    events = _bookings(spark, sf_dir)
    channel = booking_channel(F.col("event_type_id"), F.col("utm_source"))
    return events.select("event_id", channel.alias("channel"))


@query(f"WITH {SPEND} SELECT o_orderkey, source AS channel FROM p")
def spend_channel_names(spark, sf_dir):
    return inputs.spend(spark, sf_dir).select(
        "o_orderkey", spend_channel(F.col("channel")).alias("channel")
    )


@query("""
SELECT date, source AS channel, max(spend) AS spend, date AS dt FROM (
  SELECT strftime(o_orderdate, '%Y-%m-%d') AS date, o_totalprice AS spend,
    CASE o_orderpriority WHEN '1-URGENT' THEN 'facebook_paid_ads' WHEN '2-HIGH' THEN 'youtube_paid_ads'
      WHEN '3-MEDIUM' THEN 'tiktok_paid_ads' WHEN '4-NOT SPECIFIED' THEN 'Click'
      ELSE CASE WHEN o_orderstatus <> 'P' THEN 'billboard' END END AS source FROM orders)
GROUP BY date, source""")
def silver_spend(spark, sf_dir):
    return silver.silver_spend(inputs.spend(spark, sf_dir))


@query(f"""WITH {EVENTS}
SELECT event_id, strftime(local, '%Y-%m-%d %H:%M:%S') AS local, booking_date,
  CAST(hour(local) AS INTEGER) AS hour, strftime(local, '%A') AS weekday,
  strftime(local, '%a') AS short, CAST(isodow(local) AS INTEGER) AS place FROM s""")
def local_time_parts(spark, sf_dir):
    iso = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"
    text = inputs.table(spark, sf_dir, "events").select(
        "event_id", F.date_format("ts", iso).alias("text")
    )
    at = timeparts.local_wall(timeparts.instant(F.col("text")), inputs.REPORT_ZONE)
    local = F.col("local")
    return as_text(
        text.select("event_id", at.alias("local")).select(
            "event_id",
            "local",
            F.to_date("local").alias("booking_date"),
            F.hour("local").alias("hour"),
            timeparts.weekday_name(local).alias("weekday"),
            timeparts.weekday_short(local).alias("short"),
            timeparts.weekday_index(timeparts.weekday_short(local)).alias("place"),
        )
    )


@query("""
SELECT CAST(year(o_orderdate) AS INTEGER) AS year, CAST(week(o_orderdate) AS INTEGER) AS week_of_year,
  CAST(isoyear(o_orderdate) AS INTEGER) AS iso_year, count(*) AS orders FROM orders GROUP BY ALL""")
def iso_week(spark, sf_dir):
    day = F.col("o_orderdate")
    return (
        inputs.table(spark, sf_dir, "orders")
        .groupBy(
            F.year(day).alias("year"),
            F.weekofyear(day).alias("week_of_year"),
            timeparts.iso_year(day).alias("iso_year"),
        )
        .agg(F.count(F.lit(1)).alias("orders"))
    )


_VENDOR = """
WITH v AS (
  SELECT o_orderkey, o_custkey % 10 AS breach,
    CASE WHEN o_orderkey % 6 = 1 THEN 'meta_ads' ELSE 'google_ads' END AS source,
    CASE WHEN o_orderkey % 4 <> 0 THEN 'campaign' ELSE 'day' END AS granularity,
    strftime(o_orderdate, '%Y-%m-%d') AS date, CAST(o_orderkey % 20 AS VARCHAR) AS account_id,
    CAST(o_custkey % 50 AS VARCHAR) AS campaign_id,
    CASE WHEN o_custkey % 10 IN (3, 4) THEN 0.0 ELSE o_totalprice END AS spend,
    CASE WHEN o_custkey % 10 = 1 THEN -4.0 ELSE 0.0 END AS clicks,
    CASE WHEN o_custkey % 10 = 0 THEN 'usd' ELSE 'USD' END AS currency,
    'load-' || CAST(o_orderkey % 5 AS VARCHAR) AS load_id, o_orderkey % 24 AS hour
  FROM orders)"""


@query(f"{_VENDOR} SELECT source, granularity, date, account_id, campaign_id, "
       "CAST(spend AS DOUBLE) AS spend, CAST(clicks AS DOUBLE) AS clicks, 0.0::DOUBLE AS leads, "
       "currency, load_id FROM v")
def vendor_spend_flat(spark, sf_dir):
    flat = silver.flatten_vendor_spend(inputs.vendor_spend(spark, sf_dir))
    return as_text(
        flat.select(
            "source", "granularity", "date", "account_id", "campaign_id", "spend", "clicks",
            "leads", "currency", "load_id",
        )
    )


@query(f"""{_VENDOR}
SELECT source, date, campaign_id, currency, granularity, load_id, hour, account_id FROM (
  SELECT *, row_number() OVER (
    PARTITION BY source, date, campaign_id, currency, granularity, load_id
    ORDER BY hour DESC, account_id DESC) AS n FROM v) WHERE n = 1""")
def spend_dedupe_latest(spark, sf_dir):
    latest = silver.latest_vendor_spend(
        silver.flatten_vendor_spend(inputs.vendor_spend(spark, sf_dir))
    )
    hour = F.hour(timeparts.utc_wall(timeparts.instant(F.col("extracted_at"))))
    return as_text(
        latest.select(
            "source", "date", "campaign_id", "currency", "granularity", "load_id",
            hour.cast("long").alias("hour"), "account_id",
        )
    )


# ---- serving


@query(f"WITH {EVENTS}, {DAILY_DAYS} SELECT min(dt) AS min_dt, max(dt) AS max_dt FROM m")
def date_bounds(spark, sf_dir):
    return serving.date_bounds(marts.bookings_by_source_day(_bookings(spark, sf_dir)))


@query(f"WITH {EVENTS}, {DAILY_DAYS} SELECT * FROM m WHERE dt BETWEEN '2024-01-05' AND '2024-01-12'")
def date_range(spark, sf_dir):
    mart = marts.bookings_by_source_day(_bookings(spark, sf_dir))
    return as_text(readers.between_days(mart, "2024-01-12", "2024-01-05"))


@query(f"WITH {EVENTS}, {DAILY_DAYS} SELECT * FROM m WHERE dt = (SELECT max(dt) FROM m)")
def latest_day(spark, sf_dir):
    return as_text(serving.for_days(marts.bookings_by_source_day(_bookings(spark, sf_dir))))


def _stored_daily(spark, sf_dir) -> str:
    path = scratch.shared_dir(spark, "daily")
    writers.write_days(marts.bookings_by_source_day(_bookings(spark, sf_dir)), path)
    return path


@query(SQL["date_bounds"])
def stored_date_bounds(spark, sf_dir):
    """Bounds of a stored mart, from the listing of its partitions."""
    return serving.stored_date_bounds(spark, _stored_daily(spark, sf_dir))


@query(SQL["latest_day"])
def stored_latest_day(spark, sf_dir):
    """The newest day of a stored mart; no other partition is read."""
    path = _stored_daily(spark, sf_dir)
    return as_text(readers.read_shown_days(spark, path, schemas.MARTS["bookings_by_source_day"]))


@query(f"WITH {EVENTS}, {DAILY_DAYS} SELECT * FROM m "
       "ORDER BY dt DESC, booking_date, source, booking_id LIMIT 5")
def latest_rows(spark, sf_dir):
    return as_text(
        serving.latest_rows(marts.bookings_by_source_day(_bookings(spark, sf_dir)))
    )


_SUM = "CAST(sum(booking_id) AS BIGINT) AS bookings"
_NUM = "count(DISTINCT booking_id) AS bookings"


@query(f"WITH {EVENTS}, {DAILY_DAYS} SELECT booking_date, source, {_SUM} FROM m GROUP BY ALL")
def serve_daily_calls(spark, sf_dir):
    return as_text(serving.daily_bookings(_daily_mart(spark, sf_dir)))


@query(f"WITH {EVENTS}, {DAILY_DAYS} SELECT booking_date, source, {_NUM} FROM m "
       "GROUP BY booking_date, source")
def serve_daily_calls_asis(spark, sf_dir):
    return as_text(serving.daily_bookings(_daily_mart(spark, sf_dir), asis=True))


@query(f"WITH {EVENTS}, {DAILY_DAYS} SELECT CAST(sum(booking_id) AS BIGINT) AS total_bookings, "
       "count(DISTINCT booking_date) AS active_days, count(DISTINCT source) AS active_sources FROM m")
def serve_daily_kpis(spark, sf_dir):
    return serving.daily_bookings_kpis(serving.daily_bookings(_daily_mart(spark, sf_dir)))


def _trend_sql(measure: str) -> str:
    return f"""WITH {EVENTS}, {DAILY_DAYS},
d AS (SELECT booking_date, source, {measure} FROM m GROUP BY booking_date, source)
SELECT booking_date, source, bookings, CAST(sum(bookings) OVER (PARTITION BY source
  ORDER BY booking_date ROWS UNBOUNDED PRECEDING) AS BIGINT) AS cumulative_bookings FROM d"""


@query(_trend_sql(_SUM))
def serve_trend_cumulative(spark, sf_dir):
    return as_text(serving.bookings_trend(_trend_mart(spark, sf_dir)))


@query(_trend_sql(_NUM))
def serve_trend_cumulative_asis(spark, sf_dir):
    return as_text(serving.bookings_trend(_trend_mart(spark, sf_dir), asis=True))


_COSTS = f"""
WITH {EVENTS}, {SPEND}, {COST_DAYS}, t AS (
  SELECT source AS channel, {money('total_spend')} AS total_spend,
         CAST(sum(total_bookings) AS BIGINT) AS total_bookings FROM m GROUP BY source),
c AS (SELECT *, {_ratio('total_spend', 'total_bookings')} AS cpb FROM t)"""


@query(f"{_COSTS} SELECT * FROM c")
def serve_cpb(spark, sf_dir):
    return serving.channel_costs(_cost_mart(spark, sf_dir))


@query(f"{_COSTS} SELECT total_bookings, total_spend, {_ratio('total_spend', 'total_bookings')} "
       f"AS average_cpb FROM (SELECT CAST(sum(total_bookings) AS BIGINT) AS total_bookings, "
       f"{money('total_spend')} AS total_spend FROM c)")
def serve_cpb_kpis(spark, sf_dir):
    return serving.channel_cost_kpis(serving.channel_costs(_cost_mart(spark, sf_dir)))


@query(f"{_COSTS} SELECT channel, format('${{:,.2f}}', total_spend) AS total_spend, "
       "format('{:,}', total_bookings) AS total_bookings, "
       "coalesce(format('${:,.2f}', cpb), '—') AS cpb FROM c")
def serve_cpb_display(spark, sf_dir):
    return serving.channel_costs(_cost_mart(spark, sf_dir)).select(
        "channel",
        display.money_text(F.col("total_spend")).alias("total_spend"),
        display.count_text(F.col("total_bookings")).alias("total_bookings"),
        display.money_text(F.col("cpb")).alias("cpb"),
    )


def _leader_sql(spend_rows: str) -> str:
    return f"""
WITH {EVENTS}, {SPEND}, {ATTR_DAYS}, r AS ({spend_rows}), t AS (
  SELECT source, CAST(sum(total_bookings) AS BIGINT) AS total_bookings,
         {money('spend')} AS total_spend FROM r GROUP BY source),
c AS (SELECT *, {_ratio('total_spend', 'total_bookings')} AS cpb FROM t)"""


_LEADERS = _leader_sql(
    "SELECT source, dt, sum(total_bookings) AS total_bookings, max(total_spend) AS spend "
    "FROM m GROUP BY source, dt"
)
_LEADERS_ASIS = _leader_sql("SELECT source, total_bookings, total_spend AS spend FROM m")


@query(f"{_LEADERS} SELECT * FROM c")
def serve_leaderboard(spark, sf_dir):
    return serving.source_leaderboard(_attribution_mart(spark, sf_dir))


@query(f"{_LEADERS_ASIS} SELECT * FROM c")
def serve_leaderboard_asis(spark, sf_dir):
    return serving.source_leaderboard(_attribution_mart(spark, sf_dir), asis=True)


@query(f"{_LEADERS} SELECT * FROM c ORDER BY total_bookings DESC, cpb NULLS LAST, source LIMIT 10")
def serve_top10(spark, sf_dir):
    return serving.top_sources(serving.source_leaderboard(_attribution_mart(spark, sf_dir)))


_CAMPAIGNS = f"""
WITH {EVENTS}, {SPEND}, {ATTR_DAYS}, t AS (
  SELECT source, campaign, CAST(sum(total_bookings) AS BIGINT) AS total_bookings,
         {money('total_spend')} AS total_spend FROM m GROUP BY source, campaign),
c AS (SELECT *, {_ratio('total_spend', 'total_bookings')} AS cpb FROM t)"""


@query(f"{_CAMPAIGNS} SELECT * FROM c")
def serve_source_campaign(spark, sf_dir):
    return serving.source_campaigns(_attribution_mart(spark, sf_dir))


@query(f"""{_CAMPAIGNS}, r AS (
  SELECT source, 'cpb_' || campaign AS campaign, cpb FROM c WHERE cpb IS NOT NULL)
SELECT rows.source, columns.campaign, avg(r.cpb) AS cpb
FROM (SELECT DISTINCT source FROM r) AS rows CROSS JOIN (SELECT DISTINCT campaign FROM r) AS columns
LEFT JOIN r ON r.source IS NOT DISTINCT FROM rows.source AND r.campaign = columns.campaign
GROUP BY rows.source, columns.campaign""")
def serve_cpb_pivot(spark, sf_dir):
    """One column per campaign there is, compared cell by cell, empty ones included."""
    campaigns = serving.source_campaigns(_attribution_mart(spark, sf_dir))
    table = serving.cost_pivot(campaigns.withColumn("campaign", F.concat(F.lit("cpb_"), "campaign")))
    return serving.pivot_cells(table, "source", "campaign", "cpb")


_SLOTS = f"WITH {EVENTS}, {SLOT_DAYS}"
_SLOT_ROWS = f"SELECT hour_of_day, day_of_week, source, {_SUM} FROM m GROUP BY ALL"


@query(f"{_SLOTS} {_SLOT_ROWS}")
def serve_timeslot(spark, sf_dir):
    return serving.timeslots(_slot_mart(spark, sf_dir))


@query(f"{_SLOTS} SELECT hour_of_day, day_of_week, source, {_NUM} FROM m "
       "GROUP BY hour_of_day, day_of_week, source")
def serve_timeslot_asis(spark, sf_dir):
    return serving.timeslots(_slot_mart(spark, sf_dir), asis=True)


@query(f"{_SLOTS} SELECT day_of_week, hour_of_day, {_SUM} FROM m GROUP BY ALL")
def serve_heatmap(spark, sf_dir):
    return serving.weekday_hour_cells(serving.timeslots(_slot_mart(spark, sf_dir)))


@query(f"{_SLOTS} SELECT hour_of_day, {_SUM} FROM m GROUP BY ALL")
def serve_by_hour(spark, sf_dir):
    return serving.bookings_by_hour(serving.timeslots(_slot_mart(spark, sf_dir)))


@query(f"{_SLOTS}, d AS (SELECT day_of_week, {_SUM} FROM m GROUP BY ALL) "
       "SELECT day_of_week, bookings, bookings / (SELECT sum(bookings) FROM d) AS share FROM d")
def serve_weekday_share(spark, sf_dir):
    return serving.weekday_share(serving.timeslots(_slot_mart(spark, sf_dir)))


_HOSTS = f"""
WITH {EVENTS}, {WEEK_DAYS}, h AS (
  SELECT host_user_name, CAST(sum(meetings) AS BIGINT) AS total_meetings,
         avg(CAST(meetings AS DOUBLE)) AS avg_meetings FROM m GROUP BY host_user_name)"""


@query(f"{_HOSTS} SELECT * FROM h")
def serve_meetings(spark, sf_dir):
    return serving.by_mean_meetings(serving.host_meetings(_week_mart(spark, sf_dir)))


@query(f"{_HOSTS} SELECT CAST(sum(total_meetings) AS BIGINT) AS total_meetings, "
       "max(total_meetings) AS max_meetings, min(total_meetings) AS min_meetings, "
       "round(avg(avg_meetings), 6) AS mean_week FROM h")
def serve_meetings_kpis(spark, sf_dir):
    kpis = serving.host_meeting_kpis(serving.host_meetings(_week_mart(spark, sf_dir)))
    return kpis.withColumn("mean_week", F.round("mean_week", 6))


# ---- quality


@query(f"""WITH {EVENTS},
r AS (SELECT count(*) AS n, count(scheduled_event_uri) AS u, count(source) AS c FROM s)
SELECT 'bookings' AS table_name, 'not_empty' AS check_name, '' AS column_name,
  CAST(n AS DOUBLE) AS value, n > 0 AS passed, '{RUN}' AS dt FROM r
UNION ALL SELECT 'bookings', 'present', 'meeting_room', 0.0, false, '{RUN}' FROM r
UNION ALL SELECT 'bookings', 'complete', 'scheduled_event_uri', u / n, u / n >= 0.999, '{RUN}' FROM r
UNION ALL SELECT 'bookings', 'complete', 'channel', c / n, c / n >= 0.999, '{RUN}' FROM r""")
def quality_completeness(spark, sf_dir):
    events = _bookings(spark, sf_dir).withColumn("dt", F.lit(RUN))
    rules = quality.TableRules(
        required=("channel", "meeting_room"), not_null=("scheduled_event_uri", "channel")
    )
    return quality.table_checks(events, "bookings", rules, RUN)


@query(f"""WITH {EVENTS}, c AS (
  SELECT CAST(count(*) FILTER (WHERE k % 10 = 3) AS DOUBLE) AS bad, count(*) AS n FROM s)
SELECT 'events' AS table_name, 'not_empty' AS check_name, '' AS column_name,
  CAST(n AS DOUBLE) AS value, true AS passed, '{RUN}' AS dt FROM c
UNION ALL SELECT 'events', 'non_negative', 'total_bookings', bad, bad = 0, '{RUN}' FROM c""")
def quality_nonnegative(spark, sf_dir):
    amount = F.when(F.col("k") % 10 == 3, F.lit(-1)).when(F.col("k") != 4, F.lit(1))
    events = inputs.numbered_events(spark, sf_dir).select(
        amount.alias("total_bookings"), F.lit(RUN).alias("dt")
    )
    return quality.table_checks(events, "events", quality.TableRules((), ()), RUN)


@query(f"""WITH {EVENTS}, {SPEND}, m AS ({_cost('source, campaign', f"'{RUN}'")})
SELECT source, campaign FROM m
WHERE cpb IS NOT NULL AND campaign IN ('13', '23', '33', '43', '53', '63', '73', '83', '93')""")
def quality_cpb_tolerance(spark, sf_dir):
    """Every campaign ending in 3 is put off by 0.02, every one ending in 4 by less than allowed."""
    last = F.substring("campaign", -1, 1)
    small = F.length("campaign") == 2
    wrong = (
        F.col("cpb")
        + F.when(small & (last == "3"), 0.02).when(small & (last == "4"), 0.005).otherwise(0.0)
    )
    return channel_attribution(spark, sf_dir).withColumn("cpb", wrong).where(
        quality.cpb_off()
    ).select("source", "campaign")


@query("SELECT event_type, user_id, count(*) AS copies FROM events GROUP BY ALL HAVING count(*) > 1")
def quality_uniqueness(spark, sf_dir):
    return dedupe.repeated_keys(inputs.table(spark, sf_dir, "events"), ["event_type", "user_id"])


def _gold_checks_sql() -> str:
    """The checks of every mart spelled out from the rules."""
    keys = {
        "bookings_by_source_day": "booking_date, source",
        "bookings_trend_over_time": "booking_date, source",
        "bookings_by_timeslot": "hour(local) AS hour_of_day, strftime(local, '%a') AS day_of_week, source",
        "meetings_per_employee_week": "host_user_name, year(local) AS year, week(local) AS week_of_year",
    }
    tables = {m: f"SELECT {k}, {_MEETINGS} AS booking_id, {_MEETINGS} AS meetings, {_MEETINGS} AS "
                 f"avg_meetings_per_week, '{RUN}' AS dt FROM s GROUP BY ALL" for m, k in keys.items()}
    for mart, by in (("cost_per_booking_by_channel", "source"),
                     ("channel_attribution_leaderboard", "source, campaign")):
        tables[mart] = (f"SELECT *, source AS channel, total_spend AS spend FROM "
                        f"({_cost(by, f"'{RUN}'")})")
    parts = []
    for mart, rules in quality.GOLD_RULES.items():
        def check(name, column, value, passed, source=mart):
            parts.append(f"SELECT '{source}' AS table_name, '{name}' AS check_name, '{column}' AS "
                         f"column_name, CAST({value} AS DOUBLE) AS value, {passed} AS passed, "
                         f"'{RUN}' AS dt FROM {source}")

        check("not_empty", "", "count(*)", "count(*) > 0")
        for c in rules.not_null:
            check("complete", c, f"count({c}) / count(*)", f"count({c}) / count(*) >= 0.999")
        for c in quality.NON_NEGATIVE:
            if c in rules.required:
                bad = f"count(*) FILTER (WHERE {c} < 0)"
                check("non_negative", c, bad, f"{bad} = 0")
        if {"spend", "cpb"} <= set(rules.required):
            bad = "count(*) FILTER (WHERE abs(cpb - spend / total_bookings) > 0.01)"
            check("cpb_matches", "cpb", bad, f"{bad} = 0")
        if rules.unique:
            columns = ",".join(rules.unique)
            again = f"(SELECT 1 FROM {mart} GROUP BY {columns} HAVING count(*) > 1)"
            check("unique", columns, "count(*)", "count(*) = 0", source=mart)
            parts[-1] = parts[-1].removesuffix(f"FROM {mart}") + f"FROM {again}"
    views = ", ".join(f"{m} AS ({sql})" for m, sql in tables.items())
    return f"WITH {EVENTS}, {SPEND}, {views} " + " UNION ALL ".join(parts)


@query(_gold_checks_sql())
def quality_gold_tables(spark, sf_dir):
    """All checks of all six marts, computed from shared counts."""
    counts = scratch.materialized(marts.count_meetings_all(_bookings(spark, sf_dir), RUN), "counts")
    tables = marts.marts_from_counts(counts, inputs.spend(spark, sf_dir), RUN)
    return quality.gold_checks(tables, RUN)


def _daily_checks(day: str, source: str, name: str = "bookings_by_source_day", missing: str = "") -> str:
    """Checks of the daily mart in SQL; `source` is a relation of one day."""
    head = f"SELECT '{name}' AS table_name"
    parts = [f"{head}, 'not_empty' AS check_name, '' AS column_name, CAST(count(*) AS DOUBLE) AS value, "
             f"count(*) > 0 AS passed, '{day}' AS dt FROM {source}"]
    for column in ("booking_date", "source", "booking_id", "dt"):
        if column == missing:
            parts.append(f"{head}, 'present', '{column}', 0.0, false, '{day}'")
        else:
            share = f"coalesce(count({column}) / nullif(count(*), 0), 1.0)"
            parts.append(f"{head}, 'complete', '{column}', {share}, {share} >= 0.999, '{day}' FROM {source}")
    bad = "count(*) FILTER (WHERE booking_id < 0)"
    parts.append(f"{head}, 'non_negative', 'booking_id', CAST({bad} AS DOUBLE), {bad} = 0, '{day}' FROM {source}")
    return " UNION ALL ".join(parts)


_ONE_DAY = f"WITH {EVENTS}, d AS (SELECT booking_date, source, {_MEETINGS} AS booking_id, '{RUN}' AS dt FROM s GROUP BY ALL)"
_DAILY_RULES = quality.GOLD_RULES["bookings_trend_over_time"]


@query(f"{_ONE_DAY} {_daily_checks(RUN, 'd', missing='source')}")
def quality_missing_column(spark, sf_dir):
    """A stored mart that lacks a column fails `present`."""
    path = scratch.shared_dir(spark, "narrow")
    writers.write_days(marts.bookings_by_source_day(_bookings(spark, sf_dir), RUN).drop("source"), path)
    stored = readers.read_stored(spark, path)
    return quality.table_checks(stored, "bookings_by_source_day", _DAILY_RULES, RUN)


@query(f"{_ONE_DAY}, x AS (SELECT * FROM d LIMIT 0), bad AS (SELECT * REPLACE (-1 AS booking_id) FROM d) "
       f"{_daily_checks('2024-01-30', 'x')} UNION ALL {_daily_checks(RUN, 'bad')}")
def quality_history(spark, sf_dir):
    """Check results are kept by day; a second check of a day replaces its results."""
    path = scratch.shared_dir(spark, "history")
    mart = marts.bookings_by_source_day(_bookings(spark, sf_dir), RUN)
    for frame, day in ((mart, "2024-01-30"), (mart, RUN), (mart.withColumn("booking_id", F.lit(-1)), RUN)):
        checks = quality.table_checks(frame, "bookings_by_source_day", _DAILY_RULES, day)
        writers.write_days(checks, path)
    return readers.read_stored(spark, path)


@query(f"WITH {EVENTS}, {DAILY_DAYS}, x AS (SELECT max(dt) AS dt FROM m) "
       "SELECT x.dt, count(*) AS rows, sum(m.booking_id)::BIGINT AS bookings FROM m JOIN x ON m.dt = x.dt GROUP BY x.dt")
def quality_latest_day(spark, sf_dir):
    """The day that a validation without a day checks."""
    mart = marts.bookings_by_source_day(_bookings(spark, sf_dir))
    day = quality.latest_day({"bookings_by_source_day": mart})
    return mart.where(F.col("dt") == day).groupBy("dt").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("booking_id").alias("bookings")
    )


@query(f"{_ONE_DAY}, bad AS (SELECT * REPLACE (-1 AS booking_id, CAST(NULL AS VARCHAR) AS source) FROM d) "
       f"SELECT check_name, column_name FROM ({_daily_checks(RUN, 'bad')}) WHERE NOT passed")
def quality_failures(spark, sf_dir):
    """What the error of a failed validation names."""
    mart = marts.bookings_by_source_day(_bookings(spark, sf_dir), RUN)
    bad = mart.withColumns({"booking_id": F.lit(-1), "source": F.lit(None).cast("string")})
    checks = quality.table_checks(bad, "bookings_by_source_day", _DAILY_RULES, RUN)
    return quality.failed(checks).select("check_name", "column_name")


# ---- contracts

_KIND = "CASE WHEN event_type = 'error' THEN 'value:event' END"
_BREACH = """CASE WHEN k % 10 = 1 OR k % 50 IN (25, 26, 27) THEN 'format:created_at'
    WHEN k % 10 = 0 THEN 'missing:payload.uri' WHEN k % 10 = 2 THEN 'value:payload.status'
    WHEN k % 10 = 3 THEN 'type:payload.canceled' END"""


@query(f"""WITH {EVENTS}
SELECT event_id, CASE WHEN k % 10 = 4 THEN 'malformed' ELSE concat_ws(',', {_KIND}, {_BREACH}) END AS reasons
FROM s""")
def contract_webhook_reasons(spark, sf_dir):
    judged = contracts.webhook_reasons(inputs.contract_bodies(spark, sf_dir))
    return judged.select("event_id", F.concat_ws(",", contracts.REASONS).alias("reasons"))


@query(f"""WITH {EVENTS}, r AS (
  SELECT CASE WHEN k % 10 = 4 THEN 'malformed' ELSE {_BREACH} END AS reason FROM s
  UNION ALL SELECT 'value:event' FROM s WHERE event_type = 'error' AND k % 10 <> 4)
SELECT reason, count(*) AS rows FROM r WHERE reason IS NOT NULL GROUP BY reason""")
def contract_reason_counts(spark, sf_dir):
    judged = contracts.webhook_reasons(inputs.contract_bodies(spark, sf_dir))
    return contracts.reason_counts(judged)


#: A contract of the orders, as a user would write one.
_ORDER_DOCUMENT = {
    "title": "order",
    "type": "object",
    "required": ["id", "status", "total", "customer"],
    "additionalProperties": False,
    "properties": {
        "id": {"type": "integer", "minimum": 10},
        "status": {"type": "string", "enum": ["O", "F"]},
        "total": {"type": "number", "minimum": 1000, "maximum": 400000},
        "priority": {"type": ["string", "null"], "pattern": "^[1-3]-", "maxLength": 8},
        "order day": {"type": "string", "format": "date"},
        "customer": {
            "type": "object",
            "required": ["key", "name"],
            "additionalProperties": False,
            "properties": {"key": {"type": "integer", "maximum": 300}, "name": {"type": ["string", "number"]}},
        },
    },
}


@query("""
SELECT o_orderkey, concat_ws(',',
  CASE WHEN o_orderkey < 10 THEN 'range:id' END,
  CASE WHEN o_orderstatus NOT IN ('O', 'F') THEN 'value:status' END,
  CASE WHEN o_totalprice < 1000 OR o_totalprice > 400000 THEN 'range:total' END,
  CASE WHEN NOT regexp_matches(o_orderpriority, '^[1-3]-') THEN 'pattern:priority' END,
  CASE WHEN length(o_orderpriority) > 8 THEN 'length:priority' END,
  CASE WHEN o_orderkey % 7 = 0 THEN 'format:order day' END,
  CASE WHEN o_orderkey % 13 = 0 THEN 'unknown_key:customer' END,
  CASE WHEN o_custkey % 2 = 1 THEN 'type:customer.key' END,
  CASE WHEN o_custkey / 2.0 > 300 THEN 'range:customer.key' END,
  CASE WHEN o_orderkey % 11 = 0 THEN 'missing:customer.name' WHEN o_orderkey % 11 = 1 THEN 'type:customer.name' END
) AS reasons FROM orders""")
def contract_by_document(spark, sf_dir):
    """Orders as JSON, judged by a schema document."""
    odd = F.when(F.expr("o_orderkey % 13 = 0"), "?").alias("note")
    name = F.expr("CASE o_orderkey % 11 WHEN 0 THEN NULL WHEN 1 THEN 'true' WHEN 2 THEN '7' ELSE '\"c\"' END")
    fields = F.to_json(F.struct((F.col("o_custkey") / 2).alias("key"), odd))
    customer = F.concat(F.expr("left(f, length(f) - 1)"), F.coalesce(F.concat(F.lit(',"name":'), name), F.lit("")), F.lit("}"))
    order = F.to_json(F.struct(
        F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("status"), F.col("o_totalprice").alias("total"),
        F.col("o_orderpriority").alias("priority"),
        F.when(F.expr("o_orderkey % 7 = 0"), "soon").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("order day"),
    ))
    whole = F.concat(F.expr("left(o, length(o) - 1)"), F.lit(',"customer":'), customer, F.lit("}"))
    orders = inputs.table(spark, sf_dir, "orders").withColumns({"f": fields, "o": order}).withColumn("body", whole)
    judged = contracts.schema_reasons(orders, _ORDER_DOCUMENT)
    return judged.select("o_orderkey", F.concat_ws(",", contracts.REASONS).alias("reasons"))


@query("""
SELECT o_orderkey, coalesce(CASE o_custkey % 10 WHEN 2 THEN 'unknown_key:body'
  WHEN 3 THEN 'missing:metrics.spend' WHEN 4 THEN 'type:metrics.spend'
  WHEN 0 THEN 'format:currency' WHEN 1 THEN 'negative:metrics.clicks' END, '') AS reasons
FROM orders""")
def contract_spend_reasons(spark, sf_dir):
    judged = contracts.spend_reasons(inputs.vendor_spend_bodies(spark, sf_dir))
    return judged.select("o_orderkey", F.concat_ws(",", contracts.REASONS).alias("reasons"))


_RESCHEDULE = """
WITH e AS (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events),
gone AS (SELECT event_id FROM e WHERE event_type = 'view'),
made AS (SELECT event_id, event_type FROM e WHERE event_type <> 'view'),
links AS (
  SELECT event_id AS a, event_id + 1 AS b FROM gone
  UNION SELECT event_id - 1, event_id FROM made WHERE event_type = 'click')"""


@query(f"""{_RESCHEDULE}
SELECT 'invitees/' || CAST(a AS VARCHAR) AS canceled_uri, 'invitees/' || CAST(b AS VARCHAR)
  AS created_uri, b IN (SELECT event_id FROM made) AS paired
FROM links WHERE a IN (SELECT event_id FROM gone)""")
def reschedule_pairs(spark, sf_dir):
    return contracts.reschedule_pairs(inputs.reschedules(spark, sf_dir))


@query(f"""{_RESCHEDULE.replace("WITH e", "WITH RECURSIVE e")},
one AS (SELECT a, b FROM links WHERE a IN (SELECT event_id FROM gone)),
walk AS (
  SELECT a AS first, b AS last, 2 AS length FROM one WHERE a NOT IN (SELECT b FROM one)
  UNION ALL SELECT first, one.b, length + 1 FROM walk JOIN one ON one.a = walk.last)
SELECT 'invitees/' || CAST(first AS VARCHAR) AS first_uri, 'invitees/' || CAST(last AS VARCHAR) AS last_uri,
  CAST(length AS BIGINT) AS length, last IN (SELECT event_id FROM made) AS active, false AS cycle
FROM walk WHERE last NOT IN (SELECT a FROM one)""")
def reschedule_chains(spark, sf_dir):
    """First and last booking of each chain of reschedules, however long."""
    return chains.reschedule_chains(inputs.reschedules(spark, sf_dir))


@query(f"{_RESCHEDULE} SELECT 'invitees/' || CAST(event_id AS VARCHAR) AS uri FROM made")
def active_invitees(spark, sf_dir):
    return contracts.active_invitees(inputs.reschedules(spark, sf_dir))


@query(f"""{_RESCHEDULE}
SELECT 'invitees/' || CAST(event_id AS VARCHAR) AS uri, concat_ws(',',
  CASE WHEN k = 13 THEN 'time:created_at' WHEN k % 10 > 7 THEN 'skew:created_at' END,
  CASE WHEN k = 11 AND event_type NOT IN ('view', 'click') THEN 'reschedule_unlinked' END) AS flags
FROM e""")
def webhook_flags(spark, sf_dir):
    flagged = contracts.webhook_flags(inputs.reschedules(spark, sf_dir))
    return flagged.select(F.col("payload.uri").alias("uri"), F.concat_ws(",", "flags").alias("flags"))


@query(f"""{_WEBHOOK}
SELECT invitee_uri AS uri, 'invitee.created' AS event, {_SENT} AS created_at,
  scheduled_event_uri AS meeting, 'event_types/' || campaign AS link
FROM (SELECT *, row_number() OVER (PARTITION BY invitee_uri ORDER BY ts, event_id) AS n FROM w) WHERE n = 1""")
def unique_webhooks(spark, sf_dir):
    unique = contracts.unique_webhooks(inputs.webhooks(spark, sf_dir))
    meeting = F.col("payload.scheduled_event")
    return unique.select(
        "payload.uri", "event", "created_at", meeting["uri"].alias("meeting"), meeting["event_type"].alias("link")
    )


@query("""
SELECT event_id, CASE WHEN user_id % 3 <> 0 THEN 'ok' ELSE 'failed' END AS enrichment_status
FROM events""")
def enrichment_status(spark, sf_dir):
    events = inputs.table(spark, sf_dir, "events").select(
        "event_id", F.concat(F.lit("m/"), F.col("user_id").cast("string")).alias("scheduled_event_uri"),
        "user_id",
    )
    meetings = events.where("user_id % 3 <> 0").select(F.col("scheduled_event_uri").alias("uri"))
    marked = contracts.with_enrichment_status(events.drop("user_id"), meetings)
    return marked.select("event_id", "enrichment_status")


@query(f"""{_VENDOR}, b AS (
  SELECT source, date, account_id, {money('spend')} AS bronze_spend FROM v
  WHERE breach <> 8 GROUP BY ALL),
z AS (
  SELECT source, date, account_id, {money('CASE WHEN breach = 7 THEN spend + 2500 ELSE spend END')}
    AS silver_spend FROM v WHERE breach <> 9 GROUP BY ALL),
j AS (
  SELECT source, date, account_id, coalesce(bronze_spend, 0.0) AS bronze_spend,
    coalesce(silver_spend, 0.0) AS silver_spend
  FROM b FULL JOIN z USING (source, date, account_id))
SELECT *, abs(silver_spend - bronze_spend) <= abs(bronze_spend) * 0.02 AS within FROM j""")
def spend_reconcile(spark, sf_dir):
    rows = inputs.vendor_spend(spark, sf_dir)
    raised = F.col("metrics").withField("spend", F.col("metrics.spend") + 2500)
    changed = rows.withColumn("metrics", F.when(F.col("breach") == 7, raised).otherwise(F.col("metrics")))
    bronze = silver.flatten_vendor_spend(rows.where("breach <> 8"))
    stored = silver.flatten_vendor_spend(changed.where("breach <> 9"))
    return as_text(contracts.spend_totals_check(bronze, stored))


# ---- sources, sinks and streams: written below the shared folder and read back


@query("SELECT DISTINCT strftime(ts, '%Y-%m-%d') AS dt, "
       """md5('{"kind":"' || event_type || '","user":' || CAST(user_id AS VARCHAR) || '}') AS body_md5 """
       "FROM events")
def ingest_hash_dedupe(spark, sf_dir):
    return dedupe.distinct_bodies(inputs.message_bodies(spark, sf_dir)).select("dt", "body_md5")


@query(_SILVER)
def scan_webhook_json(spark, sf_dir):
    """JSON files scanned with the fixed schema and taken to silver."""
    path = scratch.shared_dir(spark, "webhooks")
    inputs.webhook_bodies(spark, sf_dir).select(F.col("body").alias("value")).write.text(path)
    frame = silver.silver_events(readers.read_webhooks(spark, path, multiline=False), RUN)
    return as_text(frame.select(*_SILVER_COLUMNS))


@query(f"WITH {SPEND} SELECT date, source AS channel, spend FROM p")
def scan_spend_json(spark, sf_dir):
    path = scratch.shared_dir(spark, "spend")
    inputs.spend(spark, sf_dir).select("date", "channel", "spend").write.json(path)
    rows = readers.read_spend(spark, path, multiline=False)
    return rows.select("date", spend_channel(F.col("channel")).alias("channel"), "spend")


@query(SQL["events_by_type"])
def scan_flat_json(spark, sf_dir):
    path = scratch.shared_dir(spark, "flat")
    inputs.flat_events(spark, sf_dir).write.json(path)
    rows = readers.read_flat_events(spark, path, multiline=False)
    return marts.events_by_type(silver.add_event_duration(rows))


def _routed(bodies: DataFrame, reasons: Callable[[DataFrame], DataFrame]) -> DataFrame:
    judged = reasons(bodies).withColumn("route", contracts.route_of(contracts.REASONS))
    return scratch.materialized(judged, "judged")


@query(f"""WITH {SPEND} SELECT CASE WHEN o_orderkey % 11 = 0 THEN 'dead_letter' ELSE 'bronze' END AS route,
  CASE WHEN o_orderkey % 11 <> 0 THEN date END AS date, CASE WHEN o_orderkey % 11 <> 0 THEN source END AS channel,
  CASE WHEN o_orderkey % 11 <> 0 THEN spend END AS spend FROM p""")
def scan_spend_array(spark, sf_dir):
    """Arrays of spend, one per file, with broken elements: the others of an array are kept."""
    path = scratch.shared_dir(spark, "spend-arrays")
    broken = F.col("o_orderkey") % 11 == 0
    text = F.when(broken, F.lit('{"date":"2024-01-01","spend":"much"}')).otherwise(
        F.to_json(F.struct("date", "channel", "spend"))
    )
    rows = inputs.spend(spark, sf_dir).withColumn("body", text)
    inputs.write_documents(inputs.json_arrays(rows, "o_orderkey", "body"), path)
    judged = _routed(readers.read_bodies(spark, path), contracts.flat_spend_reasons)
    good = F.col("route") == contracts.BRONZE
    record = judged.select("route", F.when(good, F.from_json("body", schemas.SPEND)).alias("r"))
    return record.select("route", "r.date", spend_channel(F.col("r.channel")).alias("channel"), "r.spend")


@query(f"""WITH {EVENTS}, r AS (
  SELECT CASE WHEN k % 10 = 4 THEN 'malformed' ELSE concat_ws(',', {_KIND}, {_BREACH}) END AS reasons FROM s)
SELECT CASE WHEN reasons = '' THEN 'bronze' ELSE 'dead_letter' END AS route, reasons, count(*) AS rows
FROM r GROUP BY reasons""")
def scan_webhook_documents(spark, sf_dir):
    """Multi-line webhook documents, and broken ones landed a line each; each element is judged on its own."""
    path = scratch.shared_dir(spark, "webhook-documents")
    bodies = inputs.contract_bodies(spark, sf_dir)
    whole = F.col("body").endswith("}}")
    inputs.write_documents(inputs.json_arrays(bodies.where(whole), "event_id", "body"), f"{path}/documents")
    bodies.where(~whole).select("body").write.text(f"{path}/lines")
    landed = readers.read_bodies(spark, f"{path}/documents").unionByName(
        readers.read_bodies(spark, f"{path}/lines", multiline=False)
    )
    judged = _routed(landed, contracts.webhook_reasons)
    reasons = F.concat_ws(",", contracts.REASONS).alias("reasons")
    return judged.groupBy("route", reasons).agg(F.count(F.lit(1)).alias("rows"))


@query(f"""{_FLAT}, r AS (SELECT event_id % 13 = 0 AS broken, event_type, seconds FROM (
  SELECT event_id, event_type, k, CASE WHEN k <> 9 THEN k * 60 END AS seconds FROM (
    SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events)))
SELECT CASE WHEN broken THEN 'dead_letter' ELSE 'bronze' END AS route,
  CASE WHEN NOT broken THEN event_type END AS event_type, count(*) AS total_events,
  avg(CASE WHEN NOT broken THEN seconds END) AS avg_duration_seconds FROM r GROUP BY ALL""")
def scan_flat_document(spark, sf_dir):
    """Multi-line flat events with broken elements."""
    path = scratch.shared_dir(spark, "flat-documents")
    flat = inputs.flat_events(spark, sf_dir, "event_id")
    text = F.when(F.col("event_id") % 13 == 0, F.lit('{"event_type":5}')).otherwise(
        F.to_json(F.struct(*[c for c in flat.columns if c != "event_id"]))
    )
    inputs.write_documents(inputs.json_arrays(flat.withColumn("body", text), "event_id", "body"), path)
    judged = _routed(readers.read_bodies(spark, path), contracts.flat_event_reasons)
    good = F.col("route") == contracts.BRONZE
    rows = judged.select("route", F.when(good, F.from_json("body", schemas.FLAT_EVENT)).alias("r")).select("route", "r.*")
    return silver.add_event_duration(rows).groupBy("route", "event_type").agg(
        F.count(F.lit(1)).alias("total_events"), F.avg("event_duration").alias("avg_duration_seconds")
    )


@query("SELECT DISTINCT strftime(ts, '%Y-%m-%d') AS dt, "
       """md5(CASE WHEN event_id % 17 = 0 THEN '{}' ELSE '{"kind":"' || event_type || '","user":' || """
       "CAST(user_id AS VARCHAR) || '}' END) AS body_md5 FROM events")
def ingest_empty_bodies(spark, sf_dir):
    """A message without a body counts as an empty object."""
    bodies = inputs.message_bodies(spark, sf_dir, empty_every=17)
    return dedupe.distinct_bodies(bodies).select("dt", "body_md5")


@query(f"WITH {EVENTS}, {DAILY_DAYS} SELECT * FROM m WHERE dt >= '2024-01-20'")
def read_day_range(spark, sf_dir):
    """Stored days from one on, pruned by partition."""
    path = scratch.shared_dir(spark, "daily")
    writers.write_days(marts.bookings_by_source_day(_bookings(spark, sf_dir)), path)
    schema = schemas.MARTS["bookings_by_source_day"]
    return as_text(readers.read_days(spark, path, schema, first="2024-01-20"))


@query("SELECT DISTINCT user_id, event_type FROM events")
def unpartitioned_table(spark, sf_dir):
    """A table without partitions is replaced as a whole."""
    path = scratch.shared_dir(spark, "whole")
    rows = inputs.table(spark, sf_dir, "events").select("user_id", "event_type")
    for frame in (rows, dedupe.distinct_rows(rows)):
        writers.write_table(frame, path)
    return readers.read_table(spark, path)


@query(f"WITH {EVENTS}, {DAILY_DAYS} SELECT booking_date, source, booking_id + "
       "CASE WHEN dt = '2024-01-10' THEN 100 ELSE 0 END AS booking_id, dt FROM m WHERE dt <> '2024-01-11'")
def write_days_again(spark, sf_dir):
    """A second write of one day replaces that day and leaves the others; one without rows empties it."""
    schema = schemas.MARTS["bookings_by_source_day"]
    path = scratch.shared_dir(spark, "daily")
    mart = marts.bookings_by_source_day(_bookings(spark, sf_dir))
    writers.write_days(mart, path)
    one_day = mart.where("dt = '2024-01-10'").withColumn("booking_id", F.col("booking_id") + 100)
    writers.write_days(one_day, path)
    writers.write_days(mart.where("false"), path, replaces=[{"dt": "2024-01-11"}])
    return as_text(readers.read_table(spark, path, schema))


@query("SELECT *, CASE WHEN day(CAST(date AS DATE)) % 2 = 0 THEN 'old' END AS note "
       f"FROM ({SQL['silver_spend']})")
def upsert_spend(spark, sf_dir):
    """Stale amounts of every other day are replaced by the load; loading twice, or nothing, changes
    nothing; a column that only the table has stays."""
    path = scratch.shared_dir(spark, "silver-spend")
    rows = silver.silver_spend(inputs.spend(spark, sf_dir))
    stale = rows.where("day(date(date)) % 2 = 0").withColumn("spend", F.col("spend") + 1)
    kept = rows.withColumn("note", F.when(F.expr("day(date(date)) % 2 = 0"), "old"))
    for load in (stale, kept, rows.where("false"), kept):
        by_year = load.withColumn("dt", F.substring("date", 1, 4))
        writers.upsert_days(by_year, path, schemas.SILVER_SPEND, ["date", "channel"])
    return readers.read_stored(spark, path).withColumn("dt", F.col("date"))


@query(f"WITH {EVENTS}, {SLOT_DAYS} SELECT *, source AS note FROM m")
def compact_days(spark, sf_dir):
    """Compaction keeps a column that no schema names."""
    path = scratch.shared_dir(spark, "slots")
    mart = marts.bookings_by_timeslot(_bookings(spark, sf_dir)).withColumn("note", F.col("source"))
    mart.repartition(8).write.partitionBy("dt").parquet(path)
    writers.compact_day(spark, path, "2024-01-10")
    return readers.read_stored(spark, path)


@query(f"WITH {EVENTS}, {SLOT_DAYS} SELECT *, hour_of_day % 8 <> 0 AS in_large FROM m WHERE dt = '2024-01-10'")
def compact_small_files(spark, sf_dir):
    """Of one day, a file of the target size stays under its name; small ones beside it become one."""
    path = scratch.shared_dir(spark, "slots")
    mart = marts.bookings_by_timeslot(_bookings(spark, sf_dir)).where("dt = '2024-01-10'")
    mart = scratch.materialized(mart, "slots-of-a-day")
    mart.where("hour_of_day % 8 <> 0").coalesce(1).write.partitionBy("dt").parquet(path)
    (large,) = readers.read_stored(spark, path).select("_metadata.file_name", "_metadata.file_size").distinct().collect()
    mart.where("hour_of_day % 8 = 0").repartition(4).write.mode("append").partitionBy("dt").parquet(path)
    writers.compact_day(spark, path, "2024-01-10", mb=large.file_size / 2**20)
    return readers.read_stored(spark, path).withColumn("in_large", F.col("_metadata.file_name") == large.file_name)


@query(f"WITH {EVENTS}, {SLOT_DAYS} SELECT * FROM m")
def backfill_days(spark, sf_dir):
    schema = schemas.MARTS["bookings_by_timeslot"]
    path = scratch.shared_dir(spark, "slots")
    marts.bookings_by_timeslot(_bookings(spark, sf_dir)).write.partitionBy("dt").parquet(path)
    target = scratch.shared_dir(spark, "slots-orc")
    writers.backfill_days(spark, path, target, fmt="orc")
    return readers.read_table(spark, target, schema, "orc")


@query(f"WITH {EVENTS}, {SLOT_DAYS} SELECT * FROM m")
def registered_table(spark, sf_dir):
    """External table whose partitions are found on disk, read by name."""
    schema = schemas.MARTS["bookings_by_timeslot"]
    path = scratch.shared_dir(spark, "slots")
    writers.write_days(marts.bookings_by_timeslot(_bookings(spark, sf_dir)), path)
    name = "slots_" + path.rsplit("-", 1)[1]
    catalog.register_table(spark, "default", name, path, schema)
    rows = scratch.materialized(readers.clean_names(spark.table(f"default.{name}")), "by-name")
    spark.sql(f"DROP TABLE default.{name}")  # the external files stay
    return rows


@query(f"""{_WEBHOOK} SELECT invitee_uri, scheduled_event_uri, source AS channel FROM (
  SELECT *, row_number() OVER (PARTITION BY invitee_uri, scheduled_event_uri
    ORDER BY ts DESC, event_id DESC) AS n FROM w) WHERE n = 1""")
def stream_ingest_to_silver(spark, sf_dir):
    """Bodies landed twice are streamed into bronze once, then taken to silver."""
    root = scratch.shared_dir(spark, "ingest")
    bodies = inputs.webhook_bodies(spark, sf_dir).select(F.col("body").alias("value"))
    bodies.union(bodies).write.text(f"{root}/landing")
    ingest.start_ingest(
        spark, f"{root}/landing", f"{root}/landed", f"{root}/checkpoint", whole_text=False
    ).awaitTermination()
    events = silver.silver_events(ingest.landed_webhooks(spark, f"{root}/landed"), RUN)
    return events.select("invitee_uri", "scheduled_event_uri", "channel")


@query(f"""WITH {EVENTS}, r AS (
  SELECT DISTINCT event_type = 'error' AS bad, k % 10 AS breach, CASE WHEN k % 50 IN (25, 26, 27) THEN k % 50 END AS odd,
    CASE WHEN k % 10 <> 1 AND k % 50 NOT IN (25, 26, 27) THEN ts END AS sent, CASE WHEN k % 10 <> 0 THEN user_id END AS who FROM s)
SELECT CASE WHEN bad OR breach < 5 OR odd IS NOT NULL THEN 'dead_letter' ELSE 'bronze' END AS route,
  count(*) AS rows FROM r GROUP BY ALL""")
def stream_ingest_routes(spark, sf_dir):
    """Bodies that break the contract are kept in the dead-letter route."""
    root = scratch.shared_dir(spark, "routes")
    bodies = inputs.contract_bodies(spark, sf_dir).select(F.col("body").alias("value"))
    bodies.write.text(f"{root}/landing")
    ingest.start_ingest(
        spark, f"{root}/landing", f"{root}/landed", f"{root}/checkpoint", whole_text=False
    ).awaitTermination()
    metrics = ingest.landing_metrics(spark, f"{root}/landed")
    return metrics.groupBy("route").agg(F.sum("rows").alias("rows"))


@query(SQL["stream_ingest_routes"])
def stream_batch_metrics(spark, sf_dir):
    """The same counts from what each batch kept, without a scan of the landed table."""
    root = scratch.shared_dir(spark, "metrics")
    bodies = inputs.contract_bodies(spark, sf_dir).select(F.col("body").alias("value"))
    bodies.write.text(f"{root}/landing")
    ingest.start_ingest(
        spark, f"{root}/landing", f"{root}/landed", f"{root}/checkpoint", whole_text=False
    ).awaitTermination()
    metrics = ingest.batch_metrics(spark, f"{root}/landed")
    return metrics.groupBy("route").agg(F.sum("rows").alias("rows"))
