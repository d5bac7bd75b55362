"""Table and landing-zone reads with fixed schemas."""

from __future__ import annotations

from collections.abc import Iterable

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meetmart import schemas
from meetmart.functions.landing import parsed_body


def read_json(
    spark: SparkSession, path: str | list[str], schema: T.StructType, multiline: bool = True
) -> DataFrame:
    """JSON documents (`multiline`) or JSON lines; unreadable text is kept in a corrupt column.

    Multi-line files cannot be split across tasks, so large inputs belong in JSON lines
    or in the Parquet table that the streaming ingest writes.
    """
    full = T.StructType([*schema.fields, T.StructField(schemas.CORRUPT, T.StringType())])
    return (
        spark.read.schema(full)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", schemas.CORRUPT)
        .option("multiLine", multiline)
        .json(path)
    )


def read_webhooks(spark: SparkSession, path: str | list[str], multiline: bool = True) -> DataFrame:
    return read_json(spark, path, schemas.WEBHOOK, multiline)


def read_spend(spark: SparkSession, path: str | list[str], multiline: bool = True) -> DataFrame:
    """Spend files: a JSON array gives one row per element."""
    return read_json(spark, path, schemas.SPEND, multiline)


def read_bodies(spark: SparkSession, path: str | list[str], multiline: bool = True) -> DataFrame:
    """JSON documents as text, one row each; an array of documents gives a row per element.

    Text that is no JSON stays as it is, for the contract checks to judge.
    """
    text = spark.read.text(path, wholetext=multiline).select(F.col("value").alias("raw"))
    parsed = text.withColumn("_parsed", parsed_body(F.col("raw")))
    parts = F.coalesce(
        F.try_variant_get("_parsed", "$", "array<variant>"), F.array(F.col("_parsed"))
    )
    each = parsed.select("raw", F.explode(parts).alias("_part"))
    return each.select(F.coalesce(F.to_json("_part"), F.col("raw")).alias("body"))


def read_flat_events(
    spark: SparkSession,
    path: str | list[str],
    multiline: bool = True,
    schema: T.StructType = schemas.FLAT_EVENT,
) -> DataFrame:
    """Flat events; pass a narrower schema where the files lack optional fields."""
    return read_json(spark, path, schema, multiline)


def readable(documents: DataFrame, seen: Observation | None = None) -> DataFrame:
    """Documents that could be parsed; `seen` counts them and the others during the same pass."""
    broken = F.col(schemas.CORRUPT).isNotNull()
    if seen is not None:
        documents = documents.observe(
            seen, F.count(F.lit(1)).alias("documents"), F.count_if(broken).alias("unreadable")
        )
    return documents.where(~broken).drop(schemas.CORRUPT)


def observed(seen: Observation) -> dict[str, int]:
    """Metrics of a finished action; none if Spark found the input empty and dropped them."""
    try:
        return seen.get
    except Py4JJavaError:
        return {}


def read_table(
    spark: SparkSession, path: str, schema: T.StructType | None = None, fmt: str = "parquet"
) -> DataFrame:
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path)


def read_stored(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """A table by `dt` with every column that any of its files has; `dt` is text.

    Fixed schemas hide columns that a table lacks and columns it has beyond them. Checks and
    rewrites must see both.
    """
    stored = spark.read.format(fmt).option("mergeSchema", True).load(path)
    return stored.withColumn("dt", F.col("dt").cast("string")) if "dt" in stored.columns else stored


def read_stored_or_none(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame | None:
    """As `read_stored`; None for a table not written yet. Other errors are raised."""
    try:
        return read_stored(spark, path, fmt)
    except AnalysisException as error:
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None


def read_days(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    first: str | None = None,
    last: str | None = None,
    fmt: str = "parquet",
) -> DataFrame:
    """Partitions `first`..`last` of a table by `dt`; reads the root so that `dt` stays a column."""
    return between_days(read_table(spark, path, schema, fmt), first, last)


def read_days_or_empty(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    first: str | None = None,
    last: str | None = None,
    fmt: str = "parquet",
) -> DataFrame:
    """As `read_days`, with an empty frame for a table not written yet. Other errors are raised."""
    try:
        return read_days(spark, path, schema, first, last, fmt)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def partition_values(spark: SparkSession, path: str, name: str) -> list[str]:
    """Values of a table's first partition column, from the listing of its folder; no file is opened.

    Null partitions are left out, and so are folders that hold nothing. A table not written yet has none.
    """
    context = spark.sparkContext
    folder = context._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(context._jsc.hadoopConfiguration())
    if not files.exists(folder):
        return []
    unescape = context._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName
    found = []
    for status in files.listStatus(folder):
        key, _, value = status.getPath().getName().partition("=")
        if key == name and value and status.isDirectory() and files.listStatus(status.getPath()):
            found.append(unescape(value))
    return sorted(v for v in found if v != "__HIVE_DEFAULT_PARTITION__")


def day_bounds(spark: SparkSession, path: str) -> tuple[str | None, str | None]:
    """First and last `dt` of a stored table, from the listing of its folder; nulls where there is none."""
    days = partition_values(spark, path, "dt")
    return (days[0], days[-1]) if days else (None, None)


def read_shown_days(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    first: str | None = None,
    last: str | None = None,
    fmt: str = "parquet",
) -> DataFrame:
    """A stored mart cut to a range of days, or without a range to its newest one, which the listing tells: other
    partitions are pruned before anything runs."""
    if first is None and last is None:
        first = last = day_bounds(spark, path)[1]
        if first is None:
            return spark.createDataFrame([], schema)
    return read_days(spark, path, schema, first, last, fmt)


def between_days(df: DataFrame, first: str | None, last: str | None) -> DataFrame:
    """Inclusive range on `dt`; either end may be open and reversed ends are swapped."""
    if first and last and first > last:
        first, last = last, first
    if first:
        df = df.where(F.col("dt") >= first)
    if last:
        df = df.where(F.col("dt") <= last)
    return df


def day_in(days: Iterable[str | None]) -> Column:
    """Whether `dt` is one of `days`, a null day included where it is listed."""
    days = list(days)
    named = F.col("dt").isin([d for d in days if d is not None])
    return named | F.col("dt").isNull() if None in days else named


def require_columns(df: DataFrame, *names: str) -> DataFrame:
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")
    return df


def clean_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[name.strip().lower() for name in df.columns])
