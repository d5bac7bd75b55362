"""Fixed schemas of every table, with a comment on each column (the data dictionary).

Reads never infer: inference costs a pass and fails when no file holds a nested field.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

STR, BOOL, LONG, INT = T.StringType(), T.BooleanType(), T.LongType(), T.IntegerType()
DBL, DATE, TS, NTZ = T.DoubleType(), T.DateType(), T.TimestampType(), T.TimestampNTZType()

CORRUPT = "_corrupt_record"


def _fields(*columns: tuple) -> T.StructType:
    return T.StructType([T.StructField(n, t, True, {"comment": c}) for n, t, c in columns])


_QUESTION = _fields(
    ("question", STR, "text of the question on the booking form"),
    ("answer", STR, "text the invitee entered"),
    ("position", LONG, "order on the form, from 0"),
)
_TRACKING = _fields(
    ("utm_campaign", STR, "campaign tag of the link"),
    ("utm_source", STR, "source tag of the link"),
    ("utm_medium", STR, "medium tag of the link"),
    ("utm_content", STR, "content tag of the link"),
    ("utm_term", STR, "search term tag of the link"),
    ("salesforce_uuid", STR, "id in the sales system"),
)
_MEMBERSHIP = _fields(
    ("user", STR, "uri of the host"),
    ("user_email", STR, "mail address of the host"),
    ("user_name", STR, "name of the host"),
)
_SCHEDULED_EVENT = _fields(
    ("uri", STR, "uri of the meeting"),
    ("name", STR, "title of the meeting"),
    ("event_type", STR, "uri of the scheduling link"),
    ("status", STR, "active or canceled"),
    ("start_time", STR, "start, ISO-8601 with offset"),
    ("end_time", STR, "end, ISO-8601 with offset"),
    ("created_at", STR, "creation of the meeting, ISO-8601"),
    ("updated_at", STR, "last change of the meeting, ISO-8601"),
    ("event_memberships", T.ArrayType(_MEMBERSHIP), "hosts of the meeting"),
    ("event_guests", T.ArrayType(STR), "further guests"),
    (
        "invitees_counter",
        _fields(
            ("total", LONG, "invitees ever booked"),
            ("active", LONG, "invitees now booked"),
            ("limit", LONG, "seats"),
        ),
        "seat counts",
    ),
    (
        "location",
        _fields(("location", STR, "place or link"), ("type", STR, "kind of place")),
        "where the meeting is held",
    ),
    ("meeting_notes_html", STR, "notes as HTML"),
    ("meeting_notes_plain", STR, "notes as text"),
)
_PAYLOAD = _fields(
    ("uri", STR, "uri of the invitee, the id of this record"),
    ("event", STR, "uri of the scheduled event"),
    ("email", STR, "mail address of the invitee"),
    ("name", STR, "full name of the invitee"),
    ("first_name", STR, "first name of the invitee"),
    ("last_name", STR, "last name of the invitee"),
    ("timezone", STR, "zone of the invitee at booking"),
    ("text_reminder_number", STR, "phone number for reminders"),
    ("status", STR, "active or canceled"),
    ("canceled", BOOL, "whether the invitee canceled"),
    ("cancel_url", STR, "page to cancel"),
    ("reschedule_url", STR, "page to reschedule"),
    ("rescheduled", BOOL, "whether the record is part of a reschedule"),
    ("new_invitee", STR, "uri of the invitee that replaces this one"),
    ("old_invitee", STR, "uri of the invitee this one replaces"),
    ("scheduling_method", STR, "how the meeting was booked"),
    ("invitee_scheduled_by", STR, "uri of the user who booked"),
    ("no_show", STR, "no-show record"),
    ("payment", STR, "payment record"),
    ("reconfirmation", STR, "reconfirmation record"),
    ("routing_form_submission", STR, "uri of the routing form answer"),
    ("questions_and_answers", T.ArrayType(_QUESTION), "booking form answers"),
    ("tracking", _TRACKING, "tags of the link that was followed"),
    ("scheduled_event", _SCHEDULED_EVENT, "the meeting"),
    ("created_at", STR, "creation of the invitee, ISO-8601"),
    ("updated_at", STR, "last change of the invitee, ISO-8601"),
)
WEBHOOK = _fields(
    ("created_at", STR, "when the webhook was sent, ISO-8601"),
    ("created_by", STR, "uri of the acting user"),
    ("event", STR, "kind of webhook"),
    ("payload", _PAYLOAD, "the invitee and its meeting"),
)

FLAT_EVENT = _fields(
    ("event_type", STR, "kind of event"),
    ("event_start_time", STR, "start, ISO-8601"),
    ("event_end_time", STR, "end, ISO-8601"),
    ("created_at", STR, "creation, ISO-8601"),
    ("organizer_email", STR, "mail address of the organizer"),
    ("invitee_email", STR, "mail address of the invitee"),
)

SPEND = _fields(
    ("date", STR, "day the money was spent, yyyy-MM-dd"),
    ("channel", STR, "name of the ad platform"),
    ("spend", DBL, "amount spent that day"),
)

_ID_NAMES = ("account", "campaign", "adset", "adgroup", "ad", "creative")
_METRICS = ("spend", "impressions", "clicks", "reach", "video_views", "conversions", "revenue", "leads")
VENDOR_SPEND = _fields(
    ("source", STR, "ad platform"),
    ("granularity", STR, "grain of the record, day by default"),
    ("date", STR, "day of the activity in the platform's zone, yyyy-MM-dd"),
    ("timezone", STR, "zone of the report"),
    ("ids", _fields(*[(f"{n}_id", STR, f"{n} id at the platform") for n in _ID_NAMES]), "native ids"),
    ("names", _fields(*[(f"{n}_name", STR, f"{n} label at the platform") for n in _ID_NAMES]), "labels"),
    ("metrics", _fields(*[(m, DBL, f"{m} of the day") for m in _METRICS]), "measures"),
    ("currency", STR, "three-letter currency code"),
    (
        "attribution",
        _fields(("window", STR, "attribution window"), ("model", STR, "attribution model")),
        "how conversions were attributed",
    ),
    (
        "provenance",
        _fields(
            ("load_id", STR, "id of the load"),
            ("source_file", STR, "file the record came from"),
            ("extracted_at", STR, "time of extraction, ISO-8601"),
        ),
        "where the record came from",
    ),
    ("extra", T.MapType(STR, STR), "vendor fields passed through"),
)

SILVER_EVENTS = _fields(
    ("webhook_created_at", STR, "when the webhook was sent"),
    ("webhook_created_by", STR, "uri of the acting user"),
    ("webhook_event", STR, "kind of webhook"),
    ("invitee_name", STR, "full name of the invitee"),
    ("invitee_email", STR, "mail address of the invitee"),
    ("invitee_timezone", STR, "zone of the invitee"),
    ("invitee_uri", STR, "uri of the invitee"),
    ("cancel_url", STR, "page to cancel"),
    ("reschedule_url", STR, "page to reschedule"),
    ("invitee_status", STR, "active or canceled"),
    ("scheduling_method", STR, "how the meeting was booked"),
    ("is_rescheduled", BOOL, "whether the record is part of a reschedule"),
    ("invitee_created_at", STR, "creation of the invitee"),
    ("invitee_updated_at", STR, "last change of the invitee"),
    ("questions_and_answers_json", STR, "booking form answers as JSON"),
    ("scheduled_event_uri", STR, "uri of the meeting"),
    ("scheduled_event_name", STR, "title of the meeting"),
    ("event_type_uri", STR, "uri of the scheduling link"),
    ("event_start_time_utc", STR, "start as received"),
    ("event_end_time_utc", STR, "end as received"),
    ("event_status", STR, "status of the meeting"),
    ("host_user_uri", STR, "uri of the first host"),
    ("host_user_email", STR, "mail address of the first host"),
    ("host_user_name", STR, "name of the first host"),
    ("utm_source", STR, "source tag"),
    ("utm_medium", STR, "medium tag"),
    ("utm_campaign", STR, "campaign tag"),
    ("utm_term", STR, "search term tag"),
    ("utm_content", STR, "content tag"),
    ("event_start_ts", TS, "start as an instant"),
    ("event_end_ts", TS, "end as an instant"),
    ("event_start_local", NTZ, "start as wall time in the report zone"),
    ("event_end_local", NTZ, "end as wall time in the report zone"),
    ("booking_date", DATE, "local day the meeting starts (not the day it was booked)"),
    ("booking_hour", INT, "local hour the meeting starts"),
    ("day_of_week", STR, "full local weekday name"),
    ("event_type_id", STR, "last segment of the scheduling link"),
    ("channel", STR, "marketing channel the booking is credited to"),
    ("dt", STR, "run date of the load"),
)

SILVER_SPEND = T.StructType(SPEND.fields + _fields(("dt", STR, "day the money was spent")).fields)

SILVER_VENDOR_SPEND = _fields(
    ("source", STR, "ad platform"),
    ("granularity", STR, "grain of the record"),
    ("date", DATE, "day of the activity"),
    ("timezone", STR, "zone of the report"),
    *[(f"{n}_id", STR, f"{n} id at the platform") for n in _ID_NAMES],
    *[(f"{n}_name", STR, f"{n} label at the platform") for n in _ID_NAMES],
    *[(m, DBL, f"{m} of the day, 0 if unknown") for m in _METRICS],
    ("currency", STR, "three-letter currency code"),
    ("attribution_window", STR, "attribution window"),
    ("attribution_model", STR, "attribution model"),
    ("load_id", STR, "id of the load"),
    ("source_file", STR, "file the record came from"),
    ("extracted_at", STR, "time of extraction, ISO-8601"),
    ("extra", STR, "vendor fields passed through, as JSON"),
    ("dt", STR, "day of the activity"),
)

_DT = ("dt", STR, "run date")
_BOOKINGS_BY_DAY = _fields(
    ("booking_date", DATE, "local day the meeting starts"),
    ("source", STR, "channel"),
    ("booking_id", LONG, "number of meetings (the name is historical)"),
    _DT,
)
MARTS = {
    "bookings_by_source_day": _BOOKINGS_BY_DAY,
    "bookings_trend_over_time": _BOOKINGS_BY_DAY,
    "cost_per_booking_by_channel": _fields(
        ("channel", STR, "channel"),
        ("total_spend", DBL, "money spent"),
        ("total_bookings", LONG, "number of meetings"),
        ("cpb", DBL, "money spent per meeting"),
        _DT,
    ),
    "channel_attribution_leaderboard": _fields(
        ("source", STR, "channel"),
        ("campaign", STR, "scheduling link id"),
        ("total_bookings", LONG, "number of meetings"),
        ("spend", DBL, "money spent on the whole channel, repeated per campaign"),
        ("cpb", DBL, "channel money per meeting of the campaign"),
        _DT,
    ),
    "bookings_by_timeslot": _fields(
        ("hour_of_day", INT, "local hour"),
        ("day_of_week", STR, "short local weekday name"),
        ("source", STR, "channel"),
        ("booking_id", LONG, "number of meetings (the name is historical)"),
        _DT,
    ),
    "meetings_per_employee_week": _fields(
        ("host_user_name", STR, "host"),
        ("year", INT, "calendar year of the day"),
        ("week_of_year", INT, "ISO week"),
        ("meetings", LONG, "number of meetings"),
        ("avg_meetings_per_week", DBL, "the same number as double; averaged when served"),
        _DT,
    ),
}

TABLES = {
    "webhook": WEBHOOK,
    "flat_event": FLAT_EVENT,
    "spend": SPEND,
    "vendor_spend": VENDOR_SPEND,
    "silver_events": SILVER_EVENTS,
    "silver_spend": SILVER_SPEND,
    "silver_vendor_spend": SILVER_VENDOR_SPEND,
    **MARTS,
}


def _leaves(schema: T.StructType, prefix: str = ""):
    for field in schema.fields:
        path = prefix + field.name
        kind = field.dataType
        inner = kind.elementType if isinstance(kind, T.ArrayType) else kind
        if isinstance(inner, T.StructType):
            yield from _leaves(inner, path + ("[]." if inner is not kind else "."))
        else:
            yield path, kind.simpleString(), field.metadata.get("comment", "")


def data_dictionary(spark: SparkSession) -> DataFrame:
    """One row per leaf column of every table: table_name, field, type, description."""
    rows = [(t, *leaf) for t, schema in TABLES.items() for leaf in _leaves(schema)]
    return spark.createDataFrame(
        rows, "table_name string, field string, type string, description string"
    )
