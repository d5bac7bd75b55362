"""Duplicate removal."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meetmart.functions.landing import body_md5


def keep_latest(df: DataFrame, keys: Sequence[str | Column], newest_first: Sequence[Column]) -> DataFrame:
    """First row per key in the given order.

    The `= 1` filter lets Spark keep one row per key and map task before the shuffle, so a key
    with a large share of the rows reaches its reducer already thinned out.
    """
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*newest_first))
    return df.withColumn("_place", place).where("_place = 1").drop("_place")


def distinct_rows(df: DataFrame) -> DataFrame:
    return df.dropDuplicates()


def repeated_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys held by more than one row, with their number of rows."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).where("copies > 1")


def distinct_bodies(landed: DataFrame) -> DataFrame:
    """One row per day and content of a message, however its JSON text is laid out."""
    return landed.withColumn("body_md5", body_md5(F.col("body"))).dropDuplicates(["dt", "body_md5"])
