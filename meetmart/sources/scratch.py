"""Intermediate tables in the folder all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"
_made: list[str] = []


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new path below the cluster's checkpoint folder; a local folder only in local mode."""
    root = spark.conf.get(_SETTING, None)
    if not root:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError(f"set {_SETTING} to a folder all executors share")
        root = tempfile.mkdtemp(prefix="meetmart-")
    path = f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    _made.append(path)
    return path


def clear(spark: SparkSession) -> None:
    """Removes the intermediate tables this process made; frames read from them end with it."""
    context = spark.sparkContext
    while _made:
        place = context._jvm.org.apache.hadoop.fs.Path(_made.pop())
        place.getFileSystem(context._jsc.hadoopConfiguration()).delete(place, True)


def materialized(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write `df` once and read it back: later uses neither recompute it nor lose it with an executor."""
    path = shared_dir(df.sparkSession, name)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
