"""Database, external tables and their partitions."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import SparkSession
from pyspark.sql import types as T


def register_table(
    spark: SparkSession,
    database: str,
    name: str,
    path: str,
    schema: T.StructType,
    partitioned: bool = True,
    fmt: str = "parquet",
) -> None:
    """Create database and external table where missing, and pick up the partitions on disk."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    columns = ", ".join(_column_ddl(f) for f in schema.fields)
    layout = "PARTITIONED BY (dt)" if partitioned else ""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS `{database}`.`{name}` ({columns}) USING {fmt} {layout} "
        f"LOCATION '{path}'"
    )
    if partitioned:
        repair_partitions(spark, database, [name])


def repair_partitions(spark: SparkSession, database: str, names: Iterable[str]) -> None:
    for name in names:
        spark.sql(f"MSCK REPAIR TABLE `{database}`.`{name}`")


def _column_ddl(field: T.StructField) -> str:
    comment = field.metadata.get("comment", "").replace("'", "\\'")
    return f"`{field.name}` {field.dataType.simpleString()} COMMENT '{comment}'"
