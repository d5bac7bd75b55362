import datetime as dt

import pytest
from pyspark.sql import functions as F

from meetmart import schemas
from meetmart.operators import quality

DAY = "2025-07-10"


def results(df):
    return {(r.check_name, r.column_name): (r.value, r.passed) for r in df.collect()}


@pytest.mark.parametrize("missing,passed", [(2, False), (1, True), (0, True)])
def test_completeness(spark, missing, passed):
    name = F.when(F.col("id") >= missing, "n")
    df = spark.range(1000).select(name.alias("n"), F.lit(DAY).alias("dt"))
    got = results(quality.table_checks(df, "t", quality.TableRules(("n", "x"), ("n",)), DAY))
    assert got[("complete", "n")] == (1 - missing / 1000, passed)
    assert got[("present", "x")] == (0.0, False)
    assert got[("not_empty", "")] == (1000.0, True)


def test_values_and_cost(spark):
    rows = [
        ("a", "c", 4, 10.0, 2.5, DAY), ("b", "c", 4, 10.0, 2.52, DAY), ("c", "c", 0, 10.0, 3.0, DAY),
        ("d", "c", -1, 10.0, None, DAY), ("e", "c", 4, 10.0, 9.0, "2025-07-09"),
    ]
    df = spark.createDataFrame(rows, schemas.MARTS["channel_attribution_leaderboard"])
    rules = quality.GOLD_RULES["channel_attribution_leaderboard"]
    got = results(quality.table_checks(df, "t", rules, DAY))
    assert got[("cpb_matches", "cpb")] == (1.0, False)
    assert got[("non_negative", "total_bookings")] == (1.0, False)
    assert got[("non_negative", "cpb")] == (0.0, True)
    assert ("complete", "cpb") not in got


def test_empty_day_fails(spark):
    df = spark.createDataFrame([], schemas.MARTS["bookings_by_source_day"])
    rules = quality.GOLD_RULES["bookings_by_source_day"]
    got = results(quality.table_checks(df, "t", rules, DAY))
    assert got[("not_empty", "")] == (0.0, False)
    assert all(ok for key, (_, ok) in got.items() if key[0] != "not_empty")


def test_uniqueness_and_single_failure(spark):
    day = dt.date(2025, 7, 9)
    rows = [(day, "a", 1, DAY), (day, "a", 1, DAY), (day, "b", -1, DAY)]
    daily = spark.createDataFrame(rows, schemas.MARTS["bookings_by_source_day"])
    tables = {"bookings_by_source_day": daily}
    rules = {"bookings_by_source_day": quality.GOLD_RULES["bookings_by_source_day"]}
    assert quality.latest_day(tables) == DAY
    checks = quality.gold_checks(tables, DAY, rules)
    got = results(checks)
    assert got[("unique", "booking_date,source,booking_id")] == (1.0, False)
    with pytest.raises(quality.QualityError) as error:
        quality.raise_on_failure(checks)
    assert "unique" in str(error.value) and "non_negative" in str(error.value)
    quality.raise_on_failure(checks.where("passed"))


def test_checks_read_the_table_once(spark):
    df = spark.createDataFrame([], schemas.MARTS["bookings_by_source_day"])
    rules = quality.GOLD_RULES["bookings_by_source_day"]
    plan = quality.table_checks(df, "t", rules, DAY)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate") == 1
