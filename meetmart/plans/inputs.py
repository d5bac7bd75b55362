"""The given tables in the shapes the operators read.

`events` stands for bookings and `orders` for spend. A number in the event properties (k) spreads
the special cases: mapped links, an empty link id, missing tags, meetings without a uri.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meetmart import schemas
from meetmart.config import REPORT_ZONE
from meetmart.functions.channels import LINK_CHANNELS, SPEND_CHANNELS, booking_channel, uri_tail
from meetmart.functions.timeparts import zone_wall

LINKS = list(LINK_CHANNELS)
PLATFORMS = list(SPEND_CHANNELS)
_ISO = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"


_TABLES = {
    "events": "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, "
    "props string",
    "orders": "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(_TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def numbered_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.get_json_object("props", "$.k").cast("int")
    return table(spark, sf_dir, "events").withColumn("k", k)


def _link_uri() -> Column:
    link = F.when(F.col("k") == 7, F.lit(""))
    for place, link_id in enumerate(LINKS, start=1):
        link = link.when(F.col("k") == place, F.lit(link_id))
    return F.concat(F.lit("event_types/"), link.otherwise(F.col("k").cast("string")))


def _tag() -> Column:
    return F.when(F.col("k") != 5, F.upper("event_type"))


def silver_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver events: two events share a meeting, every 25th k has none; `dt` is the UTC day."""
    meeting = F.concat(F.lit("scheduled_events/"), F.expr("event_id div 2").cast("string"))
    local = zone_wall(F.col("ts"), REPORT_ZONE)
    return (
        numbered_events(spark, sf_dir)
        .select(
            "event_id",
            F.concat(F.lit("invitees/"), F.col("user_id").cast("string")).alias("invitee_uri"),
            F.when(F.col("k") % 25 != 24, meeting).alias("scheduled_event_uri"),
            _link_uri().alias("event_type_uri"),
            _tag().alias("utm_source"),
            F.concat(F.lit("host_"), (F.col("user_id") % 20).cast("string")).alias("host_user_name"),
            local.alias("event_start_local"),
            F.date_format("ts", "yyyy-MM-dd").alias("dt"),
        )
        .withColumns(
            {
                "event_type_id": uri_tail(F.col("event_type_uri")),
                "booking_date": F.to_date("event_start_local"),
            }
        )
        .withColumn("channel", booking_channel(F.col("event_type_id"), F.col("utm_source")))
    )


def spend(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spend rows; `dt` spreads them over the days of the bookings."""
    channel = (
        F.when(F.col("o_orderpriority") == "1-URGENT", PLATFORMS[0])
        .when(F.col("o_orderpriority") == "2-HIGH", PLATFORMS[1])
        .when(F.col("o_orderpriority") == "3-MEDIUM", PLATFORMS[2])
        .when(F.col("o_orderpriority") == "4-NOT SPECIFIED", "Click")
        .when(F.col("o_orderstatus") != "P", "billboard")
    )
    day = F.date_add(F.lit("2024-01-01").cast("date"), (F.col("o_orderkey") % 30).cast("int"))
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("date"),
        channel.alias("channel"),
        F.col("o_totalprice").alias("spend"),
        F.date_format(day, "yyyy-MM-dd").alias("dt"),
    )


def webhook_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Webhook JSON text: a user has one meeting per event type, every 25th k has no host."""
    user = F.col("user_id").cast("string")
    sent = F.date_format("ts", _ISO)
    no_host = F.col("k") % 25 == 24
    host = F.struct(
        F.concat(F.lit("users/"), (F.col("user_id") % 20).cast("string")).alias("user"),
        F.concat(F.lit("host_"), (F.col("user_id") % 20).cast("string")).alias("user_name"),
    )
    meeting = F.struct(
        F.concat(F.lit("scheduled_events/"), user, F.lit("-"), F.col("event_type")).alias("uri"),
        _link_uri().alias("event_type"),
        sent.alias("start_time"),
        F.date_format(F.expr("ts + make_dt_interval(0, 0, k)"), _ISO).alias("end_time"),
        F.when(no_host, F.expr("array()").cast("array<struct<user:string,user_name:string>>"))
        .otherwise(F.array(host))
        .alias("event_memberships"),
    )
    payload = F.struct(
        F.concat(F.lit("invitees/"), user).alias("uri"),
        F.concat(F.lit("person_"), user).alias("name"),
        F.struct(_tag().alias("utm_source")).alias("tracking"),
        F.array(
            F.struct(F.lit("How many?").alias("question"), F.col("k").cast("string").alias("answer"))
        ).alias("questions_and_answers"),
        meeting.alias("scheduled_event"),
        sent.alias("created_at"),
        sent.alias("updated_at"),
    )
    body = F.struct(
        sent.alias("created_at"), F.lit("invitee.created").alias("event"), payload.alias("payload")
    )
    return numbered_events(spark, sf_dir).select(F.to_json(body).alias("body"))


def webhooks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bodies parsed, once per row: a filter on webhooks is not moved below the generator, where it would build and
    parse each body again, for itself."""
    parsed = F.from_json("body", schemas.WEBHOOK)
    return webhook_bodies(spark, sf_dir).select(F.inline(F.array(parsed)))


def reschedules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Webhooks of reschedules: a view cancels and names its successor, a click its predecessor."""
    def invitee(step: int) -> Column:
        return F.concat(F.lit("invitees/"), (F.col("event_id") + step).cast("string"))

    kind = F.col("event_type")
    rescheduled = kind.isin("view", "click") | (F.col("k") == 11)
    late = F.date_format(F.expr("ts - make_interval(0, 0, 0, k % 10)"), _ISO)
    payload = F.struct(
        invitee(0).alias("uri"),
        rescheduled.alias("rescheduled"),
        F.when(kind == "view", invitee(1)).alias("new_invitee"),
        F.when(kind == "click", invitee(-1)).alias("old_invitee"),
        F.when(F.col("k") == 13, F.lit("noon")).otherwise(late).alias("created_at"),
        F.lit(None).cast("string").alias("updated_at"),
    )
    return numbered_events(spark, sf_dir).select(
        F.date_format("ts", _ISO).alias("created_at"),
        F.when(kind == "view", "invitee.canceled").otherwise("invitee.created").alias("event"),
        payload.alias("payload"),
    )


def flat_events(spark: SparkSession, sf_dir: str, *more: str) -> DataFrame:
    iso = "yyyy-MM-dd'T'HH:mm:ss'Z'"
    return numbered_events(spark, sf_dir).select(
        *more,
        "event_type",
        F.when(F.col("k") == 9, F.lit("soon")).otherwise(F.date_format("ts", iso)).alias("event_start_time"),
        F.date_format(F.expr("ts + make_dt_interval(0, 0, k)"), iso).alias("event_end_time"),
        F.date_format("ts", iso).alias("created_at"),
        F.concat(F.lit("host_"), (F.col("user_id") % 20).cast("string")).alias("organizer_email"),
    )


def vendor_spend_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vendor spend JSON text with contract breaches spread over the customers."""
    key, breach = F.col("o_orderkey"), F.col("o_custkey") % 10
    amount = F.col("o_totalprice").cast("decimal(18,2)").cast("string")
    taken = F.date_format(
        F.expr("o_orderdate + make_dt_interval(1, cast(o_orderkey % 24 as int))"),
        "yyyy-MM-dd'T'HH:mm:ss'Z'",
    )

    def either(condition: Column, yes: str, no: str) -> Column:
        return F.when(condition, F.lit(yes)).otherwise(F.lit(no))

    text = F.concat(
        either(key % 6 == 1, '{"source":"meta_ads",', '{"source":"google_ads",'),
        either(key % 4 != 0, '"granularity":"campaign",', ""),
        either(breach == 2, '"surprise":1,', ""),
        F.lit('"date":"'),
        F.date_format("o_orderdate", "yyyy-MM-dd"),
        F.lit('","ids":{"account_id":"'),
        (key % 20).cast("string"),
        F.lit('","campaign_id":"'),
        (F.col("o_custkey") % 50).cast("string"),
        F.lit('"},"metrics":{'),
        F.when(breach == 3, F.lit(""))
        .when(breach == 4, F.lit('"spend":"much",'))
        .otherwise(F.concat(F.lit('"spend":'), amount, F.lit(","))),
        either(breach == 1, '"clicks":-4', '"clicks":null'),
        either(breach == 0, '},"currency":"usd",', '},"currency":"USD",'),
        F.lit('"provenance":{"load_id":"load-'),
        (key % 5).cast("string"),
        F.lit('","extracted_at":"'),
        taken,
        F.lit('"}}'),
    )
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", breach.alias("breach"), text.alias("body")
    )


def vendor_spend(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = F.from_json("body", schemas.VENDOR_SPEND)
    return vendor_spend_bodies(spark, sf_dir).select("breach", parsed.alias("r")).select(
        "breach", "r.*"
    )


def contract_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Webhook JSON text with contract breaches spread over k, among them parts of a time."""
    breach, odd = F.col("k") % 10, F.col("k") % 50
    kind = F.when(F.col("event_type") == "error", "invitee.unknown").otherwise("invitee.created")
    text = F.concat(
        F.lit('{"event":"'),
        kind,
        F.when(breach == 1, F.lit('","created_at":"noon",'))
        .when(odd == 25, F.lit('","created_at":"2024",'))
        .when(odd == 26, F.lit('","created_at":"12:30:00",'))
        .when(odd == 27, F.lit('","created_at":"2024-01-05T10:00:00",'))
        .otherwise(F.concat(F.lit('","created_at":"'), F.date_format("ts", _ISO), F.lit('",'))),
        F.lit('"payload":{'),
        F.when(breach == 0, F.lit(""))
        .otherwise(F.concat(F.lit('"uri":"invitees/'), F.col("user_id").cast("string"), F.lit('",'))),
        F.when(breach == 2, F.lit('"status":"maybe",')).otherwise(F.lit('"status":null,')),
        F.when(breach == 3, F.lit('"canceled":"yes"')).otherwise(F.lit('"canceled":false')),
        F.when(breach == 4, F.lit("")).otherwise(F.lit("}}")),
    )
    return numbered_events(spark, sf_dir).select("event_id", text.alias("body"))


def json_arrays(rows: DataFrame, key: str, body: str) -> DataFrame:
    """JSON texts `body` as arrays of neighbouring rows, a thousand `key`s each."""
    file = F.expr(f"{key} div 1000")
    texts = F.array_join(F.collect_list(body), ",\n")
    return rows.groupBy(file.alias("file")).agg(F.concat(F.lit("["), texts, F.lit("]")).alias("value"))


def write_documents(documents: DataFrame, path: str) -> None:
    """One file per JSON document."""
    documents.select("value").write.option("maxRecordsPerFile", 1).text(path)


def message_bodies(spark: SparkSession, sf_dir: str, empty_every: int = 0) -> DataFrame:
    """Small messages that repeat, with spacing and key order varying; `dt` is the UTC day."""
    kind, user = F.col("event_type"), F.col("user_id").cast("string")
    one = F.concat(F.lit('{"kind":"'), kind, F.lit('","user":'), user, F.lit("}"))
    other = F.concat(F.lit('{ "user" : '), user, F.lit(', "kind" : "'), kind, F.lit('" }'))
    body = F.when(F.col("event_id") % 2 == 0, one).otherwise(other)
    if empty_every:
        body = F.when(F.col("event_id") % empty_every != 0, body)
    return table(spark, sf_dir, "events").select(
        body.alias("body"),
        F.date_format("ts", "yyyy-MM-dd").alias("dt"),
    )
