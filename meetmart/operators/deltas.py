"""Distinct counts of meetings kept up to date by what a load changes.

A fact is a meeting under the keys of a mart, with the number of silver rows that stand behind it. Since silver keeps
the newest record per invitee, a load may take rows away as well as add some: its change is the facts after it less
those before it, and a meeting counts for a group as long as its number is above zero. Meetings without a uri are
facts too: they count nothing, but keep their group.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meetmart.operators.marts import ALL_KEYS, MART_KEYS, key_columns

KEYS = ("mart", *ALL_KEYS)
FACT = (*KEYS, "meeting")


def _facts(events: DataFrame, sign: int) -> DataFrame:
    """One row per event and mart; no shuffle."""
    columns = key_columns()
    types = dict(events.select(*[c.alias(k) for k, c in columns.items()]).dtypes)

    def branch(mart: str) -> DataFrame:
        own = MART_KEYS[mart]
        keys = [(columns[k] if k in own else F.lit(None).cast(types[k])).alias(k) for k in ALL_KEYS]
        meeting = F.col("scheduled_event_uri").alias("meeting")
        return events.select(F.lit(mart).alias("mart"), *keys, meeting, F.lit(sign).cast("long").alias("copies"))

    return reduce(DataFrame.unionByName, [branch(mart) for mart in MART_KEYS])


def fact_changes(before: DataFrame, after: DataFrame) -> DataFrame:
    """Facts by how much their number of rows goes up or down. Rows in both frames cancel out on the map side."""
    both = _facts(before, -1).unionByName(_facts(after, 1))
    return both.groupBy(*FACT).agg(F.sum("copies").alias("copies")).where("copies <> 0")


def changed_facts(facts: DataFrame, changes: DataFrame) -> DataFrame:
    """(fact, old, copies): the numbers before and after; `facts` need only hold those that change.

    A number below zero means that facts and changes do not belong together, and is an error.
    """
    zero = F.lit(0).cast("long")
    both = facts.select(*FACT, F.col("copies").alias("old"), zero.alias("change")).unionByName(
        changes.select(*FACT, zero.alias("old"), F.col("copies").alias("change"))
    )
    summed = both.groupBy(*FACT).agg(F.sum("old").alias("old"), (F.sum("old") + F.sum("change")).alias("copies"))
    fault = F.raise_error(F.concat(F.lit("more rows withdrawn than counted: "), F.coalesce("meeting", F.lit("no uri"))))
    return summed.withColumn("copies", F.when(F.col("copies") < 0, fault.cast("long")).otherwise(F.col("copies")))


def count_changes(changed: DataFrame) -> DataFrame:
    """(keys, meetings, facts): by how much the counts and the facts of a group change."""
    def shift(there: Column) -> Column:
        now, then = ((F.col(c) > 0).cast("long") for c in ("copies", "old"))
        return F.sum(F.when(there, now - then).otherwise(F.lit(0)))

    counted = changed.groupBy(*KEYS).agg(
        shift(F.col("meeting").isNotNull()).alias("meetings"), shift(F.lit(True)).alias("facts")
    )
    return counted.where("meetings <> 0 OR facts <> 0")


def moved_counts(counts: DataFrame, changes: DataFrame) -> DataFrame:
    """Counts after a change; a group without facts is gone."""
    both = counts.select(*KEYS, "meetings", "facts").unionByName(changes.select(*KEYS, "meetings", "facts"))
    summed = both.groupBy(*KEYS).agg(F.sum("meetings").alias("meetings"), F.sum("facts").alias("facts"))
    return summed.where("facts > 0")
