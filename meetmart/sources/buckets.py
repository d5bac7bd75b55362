"""Tables kept by key: a load rewrites only the buckets its keys fall into.

A bucket is a partition below the day of the load that wrote it. A second, small table says for each load which
day each bucket was last written on, so a load's state is the set of buckets it names. It is written last: a load that
breaks off names nothing, and the state before it stays what it was.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meetmart.sources.readers import partition_values, read_days_or_empty
from meetmart.sources.scratch import materialized
from meetmart.sources.writers import write_days

BUCKET = "bucket"
_TEXT = T.StringType()
_VERSIONS = T.StructType([T.StructField(c, _TEXT) for c in (BUCKET, "version", "base", "made", "dt")])


class State(NamedTuple):
    """A load: its day, the day of each bucket's rows, and the load since which all reads are known, if any.

    `made` is another for each run, also of the same day, so that tables derived from a state can tell whether it is
    still the one they were derived from.
    """

    day: str
    versions: dict[str, str]
    base: str | None
    made: str


def bucket_of(keys: Sequence[str | Column], buckets: int) -> Column:
    """Name of the bucket of a key; it holds the number of buckets, so that states with other numbers differ."""
    number = F.lpad(F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("string"), 5, "0")
    return F.concat(number, F.lit(f"-of-{buckets:05d}"))


def _versions_path(path: str) -> str:
    return f"{path.rstrip('/')}_versions"


def load_days(spark: SparkSession, path: str) -> list[str]:
    """Days of all loads, from the listing."""
    return sorted(partition_values(spark, _versions_path(path), "dt"))


def state_of(spark: SparkSession, path: str, day: str) -> State | None:
    """The state after the load of a day; no more rows than buckets come to the driver."""
    rows = read_days_or_empty(spark, _versions_path(path), _VERSIONS, day, day).collect()
    if not rows:
        return None
    return State(day, {r[BUCKET]: r.version for r in rows if r[BUCKET] is not None}, rows[0].base, rows[0].made)


def state_before(spark: SparkSession, path: str, day: str) -> State | None:
    earlier = [d for d in load_days(spark, path) if d < day]
    return state_of(spark, path, earlier[-1]) if earlier else None


def changed_buckets(before: State | None, after: State) -> set[str]:
    """Buckets whose rows differ between two states."""
    old = before.versions if before else {}
    names = old.keys() | after.versions.keys()
    return {b for b in names if old.get(b) != after.versions.get(b)}


def rows_of(
    spark: SparkSession, path: str, schema: T.StructType, state: State, only: Iterable[str] | None = None, fmt: str = "parquet"
) -> DataFrame:
    """Rows of a state, or of some of its buckets; the filter prunes all other partitions. `dt` is the state's day."""
    by_day: dict[str, list[str]] = {}
    for bucket in state.versions if only is None else set(only) & state.versions.keys():
        by_day.setdefault(state.versions[bucket], []).append(bucket)
    if not by_day:
        return spark.createDataFrame([], schema)
    wanted = F.lit(False)
    for day, names in by_day.items():
        wanted = wanted | ((F.col("dt") == day) & F.col(BUCKET).isin(names))
    full = T.StructType([*schema.fields, T.StructField(BUCKET, _TEXT)])
    rows = spark.read.format(fmt).schema(full).load(path).where(wanted)
    return rows.withColumn("dt", F.lit(state.day)).select(schema.names)


def write_load(
    rows: DataFrame, path: str, day: str, before: State | None, base: str | None, fmt: str = "parquet", sized: bool = True
) -> int:
    """Stores a load's rows (with `bucket`); buckets that it has no rows for stay as in `before`. Returns the rows.

    The partitions that an earlier run of the same day wrote, and this one does not, are emptied. Loads of later
    days were made without what this one has read now: they are marked, so that the next one reads all anew.
    """
    spark = rows.sparkSession
    own = f"{path.rstrip('/')}/dt={day}"
    stale = [{"dt": day, BUCKET: b} for b in partition_values(spark, own, BUCKET)]
    stamped = rows.withColumn("dt", F.lit(day))
    count = write_days(stamped, path, by=("dt", BUCKET), fmt=fmt, rebalance=sized, replaces=stale)
    versions = dict(before.versions) if before else {}
    versions |= dict.fromkeys(partition_values(spark, own, BUCKET), day)
    made = uuid.uuid4().hex
    listed = [(b, v, base, made, day) for b, v in versions.items()] or [(None, None, base, made, day)]
    later = [d for d in load_days(spark, path) if d > day]
    if later:
        table = read_days_or_empty(spark, _versions_path(path), _VERSIONS, later[0], later[-1])
        write_days(materialized(table.withColumn("base", F.lit(None).cast("string")), "versions"), _versions_path(path))
    write_days(spark.createDataFrame(listed, _VERSIONS), _versions_path(path))
    return count
