import datetime as dt

import pytest
from pyspark.sql import functions as F

from meetmart.functions import channels, display, landing, measures, timeparts
from meetmart.functions.channels import LINK_CHANNELS

NY = "America/New_York"


def values(spark, rows, schema, *columns):
    return [tuple(r) for r in spark.createDataFrame(rows, schema).select(*columns).collect()]


def test_uri_tail(spark):
    rows = [("https://x/y/Abc",), ("plain",), ("https://x/y/",), ("",), (None,)]
    got = values(spark, rows, "u string", channels.uri_tail(F.col("u")))
    assert [g[0] for g in got] == ["Abc", "plain", "", "", None]


def test_booking_channel_precedence(spark):
    link = next(iter(LINK_CHANNELS))
    rows = [(link.upper(), "Google"), ("other", "GooGLE"), ("", "x"), (None, None), ("", None)]
    got = values(
        spark, rows, "i string, u string", channels.booking_channel(F.col("i"), F.col("u"))
    )
    assert [g[0] for g in got] == ["facebook", "google", "x", "unknown", "unknown"]


def test_channel_names(spark):
    rows = [("facebook_paid_ads",), ("FACEBOOK_paid_ads",), ("Click",), (None,)]
    got = values(
        spark,
        rows,
        "c string",
        channels.spend_channel(F.col("c")),
        channels.known_channel(F.col("c")),
    )
    assert got == [
        ("facebook", "facebook_paid_ads"),
        ("facebook_paid_ads", "facebook_paid_ads"),
        ("click", "click"),
        (None, "unknown"),
    ]


@pytest.mark.parametrize("zone", ["UTC", NY, "Asia/Tokyo"])
def test_local_wall_does_not_depend_on_the_session_zone(spark, zone):
    cases = {
        "2025-07-09T02:30:00Z": "2025-07-08 22:30:00",
        "2025-07-09T02:30:00.250000Z": "2025-07-08 22:30:00.25",
        "2025-07-09T02:30:00+02:00": "2025-07-08 20:30:00",
        "2025-03-09T06:59:00Z": "2025-03-09 01:59:00",
        "2025-03-09T07:00:00Z": "2025-03-09 03:00:00",
        "2025-11-02T05:30:00Z": "2025-11-02 01:30:00",
        "2025-11-02T06:30:00Z": "2025-11-02 01:30:00",
        "2025-13-45T00:00:00Z": None,
        "noon": None,
    }
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        wall = timeparts.local_wall(timeparts.instant(F.col("s")), NY).cast("string")
        got = values(spark, [(s,) for s in cases], "s string", "s", wall)
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert dict(got) == cases


def test_weekdays_and_weeks(spark):
    rows = [(dt.date(2024, 12, 30),), (dt.date(2023, 1, 1),)]
    got = values(
        spark,
        rows,
        "d date",
        F.year("d"),
        F.weekofyear("d"),
        timeparts.iso_year(F.col("d")),
        timeparts.weekday_index(timeparts.weekday_name(F.col("d"))),
        timeparts.weekday_index(timeparts.weekday_short(F.col("d"))),
    )
    assert got == [(2024, 1, 2025, 1, 1), (2023, 52, 2022, 7, 7)]
    assert values(spark, [("Noday",)], "n string", timeparts.weekday_index(F.col("n"))) == [(None,)]


def test_measures(spark):
    rows = [(10.0, 4), (10.0, 0), (None, 4), (10.0, None)]
    got = values(
        spark,
        rows,
        "s double, n int",
        measures.per_unit(F.col("s"), F.col("n")),
        measures.or_zero(F.col("s")),
    )
    assert got == [(2.5, 10.0), (None, 10.0), (None, 0.0), (None, 10.0)]
    amounts = spark.createDataFrame([(0.1,), (0.2,), (0.000001,)], "s double")
    assert amounts.agg(measures.money_total(F.col("s"))).first()[0] == 0.300001


def test_display(spark):
    rows = [(1234567.891, 1234567), (None, None), (0.0, 0)]
    got = values(
        spark,
        rows,
        "m double, n long",
        display.money_text(F.col("m")),
        display.decimal_text(F.col("m")),
        display.count_text(F.col("n")),
    )
    assert got == [
        ("$1,234,567.89", "1,234,567.89", "1,234,567"),
        ("—", "—", "—"),
        ("$0.00", "0.00", "0"),
    ]


def test_text_behind_the_value_is_malformed(spark):
    good = ['{"a":1}', ' {"a":1}\n', "[1]", '"x"', "{}"]
    bad = ['{"a":1} x', '{"a":1}]', '{"a":1}}', '{"a":1},{"b":2}', '1,"x":2', '{"a":1}{"b":2}', "", "{"]
    rows = [(t,) for t in good + bad]
    got = values(spark, rows, "b string", landing.parsed_body(F.col("b")).isNotNull())
    assert [g[0] for g in got] == [True] * len(good) + [False] * len(bad)


def test_body_md5(spark):
    bodies = ['{"a":1,"b":[2]}', '{ "b" : [2], "a" : 1 }', '{"a":2}', "broken", "broken!", None, "{}"]
    got = [v[0] for v in values(spark, [(b,) for b in bodies], "b string", landing.body_md5(F.col("b")))]
    assert got[0] == got[1] and len({got[0], got[2], got[3], got[4], got[5]}) == 5
    assert got[5] == got[6] == "99914b932bd37a50b983c5e7c90ae93b"


def test_usual_times_and_their_near_misses_agree_with_the_patterns(spark):
    """What the check of single characters lets through is what the patterns let through."""
    from meetmart.functions import timeparts as tp

    base = "2024-01-05T10:20:30.123456Z"
    texts = {base[:k] + c + base[k + j :] for k in range(len(base)) for c in ("", "N", "1", "+", " ", ":", "-", "Z", "é") for j in (0, 1)}
    texts |= {"2024-01-05T10:20:30" + f + z for f in ("", ".", ".1", ".123456789", ".1234567890", ".1N", ".+01:0") for z in ("Z", "NZ", "z", "", "+0100", "UTC1Z")}
    frame = spark.createDataFrame([(t,) for t in sorted(texts)], "t string")
    text = F.col("t")
    zoned = F.when(text.rlike(f"{tp._OFFSET}$"), text).otherwise(F.concat(text, F.lit("Z")))
    slow = F.when(text.rlike(f"{tp._TIME}{tp._OFFSET}?$"), F.try_to_timestamp(zoned))
    both = frame.select(text, slow.alias("want"), tp.instant(text).alias("got"))
    assert both.where("NOT (want <=> got)").collect() == []
    assert both.where("got IS NOT NULL").count() > 20 and both.where("got IS NULL").count() > 100
