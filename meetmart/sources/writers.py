"""Idempotent writes of partitioned tables, and their upkeep."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meetmart.operators.dedupe import keep_latest
from meetmart.sources.readers import (
    day_in,
    observed,
    read_stored,
    read_stored_or_none,
    read_table,
    require_columns,
)
from meetmart.sources.scratch import materialized


def write_days(
    df: DataFrame,
    path: str,
    by: Sequence[str] = ("dt",),
    fmt: str = "parquet",
    mb: int = 128,
    rebalance: bool = True,
    replaces: Sequence[Mapping[str, str]] = (),
    **options: str,
) -> int:
    """Replace the partitions present in `df`, leave the others, return the rows written.

    `replaces` names partitions that `df` is the whole content of (a value for each column of
    `by`): those it has no rows for are emptied, so a rerun leaves nothing of the run before.

    The rebalance hint lets adaptive execution size the output: small partitions come out as
    one file, large ones are split into tasks of about `mb` megabytes, so a hot day is never
    one task. It costs a shuffle: switch it off for one large day that comes out of a shuffle
    anyway, whose tasks already have that size. The overwrite mode is set on the write itself:
    in static mode the same call would delete the whole table. Other `options` are those of the format.
    """
    seen = Observation()
    sized = df.observe(seen, F.count(F.lit(1)).alias("rows"))
    if rebalance:
        sized = sized.hint("rebalance", *by)
    folders = [_Folder(df.sparkSession, path, by, values) for values in replaces]
    with _file_size(df.sparkSession, mb):
        (
            sized.write.format(fmt)
            .mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .options(**options)
            .partitionBy(*by)
            .save(path)
        )
    for folder in folders:
        folder.drop_if_unchanged()
    return observed(seen).get("rows", 0)


class _Folder:
    """Folder of one partition, and the files that are in it before a write."""

    def __init__(self, spark: SparkSession, path: str, by: Sequence[str], values: Mapping[str, str]):
        context = spark.sparkContext
        hadoop = context._jvm.org.apache.hadoop.fs
        place = "/".join([path.rstrip("/"), *[f"{name}={values[name]}" for name in by]])
        self.place = hadoop.Path(place)
        self.files = self.place.getFileSystem(context._jsc.hadoopConfiguration())
        self.before = self.names()

    def names(self) -> set[str]:
        if not self.files.exists(self.place):
            return set()
        return {status.getPath().getName() for status in self.files.listStatus(self.place)}

    def sizes(self) -> dict[str, int]:
        """Bytes of the data files; names that Spark hides are left out."""
        if not self.files.exists(self.place):
            return {}
        found = {s.getPath().getName(): s.getLen() for s in self.files.listStatus(self.place) if s.isFile()}
        return {name: size for name, size in found.items() if name[0] not in "._"}

    def _child(self, name: str):
        return self.place.suffix(f"/{name}")

    def has(self, name: str) -> bool:
        return self.files.exists(self._child(name))

    def delete(self, names: Sequence[str]) -> None:
        for name in names:
            self.files.delete(self._child(name), False)

    def move_all(self, child: str, target: _Folder) -> None:
        """Moves the data files of a folder within this one; those a run before has moved are gone already."""
        place = self._child(child)
        found = [s.getPath() for s in self.files.listStatus(place)] if self.files.exists(place) else []
        for file in found:
            if file.getName()[0] not in "._" and not self.files.rename(file, target._child(file.getName())):
                raise RuntimeError(f"{file} could not be moved")

    def drop_if_unchanged(self) -> None:
        """A partition that was written holds new files only; an old one in it is left over."""
        if self.before and self.names() == self.before:
            self.files.delete(self.place, True)


def upsert_days(
    incoming: DataFrame, path: str, schema: T.StructType, keys: Sequence[str], fmt: str = "parquet"
) -> int:
    """Add rows to the `dt` partitions they touch; a row replaces an older one with the same keys.

    Running the same load again changes nothing. The load is written aside first, so that its
    days and its rows come from one and the same reading of the source. Only the touched days
    of the table are read: their list is bounded by the calendar, so it may pass through the
    driver. Columns beyond `schema` that the table or the load has are kept, null where a row
    lacks them.
    """
    spark = incoming.sparkSession
    incoming = materialized(incoming, "upsert")
    days = [row["dt"] for row in incoming.select("dt").distinct().collect()]
    merged = _typed(incoming, schema).withColumn("_load", F.lit(1))
    stored = read_stored_or_none(spark, path, fmt)
    if stored is not None:
        old = _typed(stored.where(day_in(days)), schema).withColumn("_load", F.lit(0))
        merged = merged.unionByName(old, allowMissingColumns=True)
    rest = [c for c in merged.columns if c not in (*keys, "dt", "_load")]
    comparable = [F.to_json(c) if _is_nested(merged, c) else F.col(c) for c in rest]
    newest = [F.col("_load").desc(), *[c.desc_nulls_last() for c in comparable]]
    return write_days(keep_latest(merged, ["dt", *keys], newest).drop("_load"), path, fmt=fmt)


def _typed(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns of `schema` with their types, null where absent, then all others as they are."""
    known = [
        (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in schema.fields
    ]
    return df.select(*known, *[c for c in df.columns if c not in schema.names])


def _is_nested(df: DataFrame, column: str) -> bool:
    return isinstance(df.schema[column].dataType, (T.StructType, T.MapType, T.ArrayType))


def write_table(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Replace an unpartitioned table."""
    df.write.format(fmt).mode("overwrite").save(path)


def backfill_days(
    spark: SparkSession, source: str, target: str, source_fmt: str = "parquet", fmt: str = "parquet"
) -> int:
    """Copy a table into another format or place, with `dt` as text."""
    table = require_columns(read_table(spark, source, fmt=source_fmt), "dt")
    return write_days(table.withColumn("dt", F.col("dt").cast("string")), target, fmt=fmt)


_FILE_FORMATS = ("parquet", "orc")  # a table is its files; others keep a log of them


def compact_day(spark: SparkSession, path: str, day: str, mb: float = 128, fmt: str = "parquet") -> int:
    """Merge the small files of one day into files of up to about `mb` megabytes; returns the day's rows, 0 if none.

    Files are packed by the sizes in the listing of the day's folder. Only those that share a bin with another are
    rewritten; all others stay as they are, under their names. All columns that the files have are kept. Merged files
    are written into a hidden folder and counted, then moved into the day before the small ones go. A run that broke
    off in between is finished by the next one, from the list of small files it left. Tables in formats that keep a
    log of their files are rewritten by the day.
    """
    if fmt not in _FILE_FORMATS:
        return _rewrite_day(spark, path, day, int(mb), fmt)
    folder = _Folder(spark, path, ("dt",), {"dt": day})
    hidden = _Folder(spark, f"{path.rstrip('/')}/_compact", ("dt",), {"dt": day})
    _finish_compaction(spark, folder, hidden)
    small = _merged(folder.sizes(), int(mb * 2**20))
    if small:
        names = [f"{folder.place}/{name}" for name in small]
        rows = spark.read.format(fmt).option("mergeSchema", True).option("basePath", path).load(names).drop("dt")
        with _packed_reads(spark, int(mb * 2**20)):
            rows.write.format(fmt).mode("overwrite").save(f"{hidden.place}/files")
        before, after = rows.count(), spark.read.format(fmt).load(f"{hidden.place}/files").count()
        if before != after:
            raise RuntimeError(f"{path}: {before} rows in small files of {day}, {after} in their copy")
        spark.createDataFrame([(name,) for name in small], "name string").coalesce(1).write.json(f"{hidden.place}/merged")
        _finish_compaction(spark, folder, hidden)
    return read_stored(spark, path, fmt).where(F.col("dt") == day).count() if folder.sizes() else 0


def _merged(sizes: Mapping[str, int], target: int) -> list[str]:
    """Files that share a bin of `target` bytes with another, first fit by falling size."""
    bins: list[tuple[int, list[str]]] = []
    for name, size in sorted(sizes.items(), key=lambda f: (-f[1], f[0])):
        place = next((k for k, (used, _) in enumerate(bins) if used + size <= target), None)
        if place is None:
            bins.append((size, [name]))
        else:
            bins[place] = (bins[place][0] + size, [*bins[place][1], name])
    return [name for _, names in bins if len(names) > 1 for name in names]


def _finish_compaction(spark: SparkSession, folder: _Folder, hidden: _Folder) -> None:
    """Puts merged files in the place of small ones, if the list of these is whole; drops what is unfinished."""
    if hidden.has("merged/_SUCCESS"):
        small = [row.name for row in spark.read.schema("name string").json(f"{hidden.place}/merged").collect()]
        hidden.move_all("files", folder)
        folder.delete(small)
    hidden.files.delete(hidden.place, True)


def _rewrite_day(spark: SparkSession, path: str, day: str, mb: int, fmt: str) -> int:
    """The whole day anew. Its rows are written aside and counted first, so a failed copy never costs a row."""
    one_day = read_stored(spark, path, fmt).where(F.col("dt") == day)
    seen = Observation()
    aside = materialized(one_day.observe(seen, F.count(F.lit(1)).alias("rows")), "compact")
    before, copied = observed(seen).get("rows", 0), aside.count()
    if before != copied:
        raise RuntimeError(f"{path}: {before} rows of {day}, {copied} in its copy")
    if not before:
        return 0
    written = write_days(aside, path, mb=mb, fmt=fmt)
    if written != before:
        raise RuntimeError(f"{path}: {before} rows before compaction of {day}, {written} after")
    return written


class _settings:
    """Settings of the session while a block runs."""

    def __init__(self, spark: SparkSession, values: Mapping[str, str]):
        self.conf, self.values = spark.conf, values

    def __enter__(self):
        self.old = {key: self.conf.get(key, None) for key in self.values}
        for key, value in self.values.items():
            self.conf.set(key, value)

    def __exit__(self, *exc):
        for key, value in self.old.items():
            self.conf.unset(key) if value is None else self.conf.set(key, value)


def _packed_reads(spark: SparkSession, target: int) -> _settings:
    """Tasks that read up to `target` bytes of whole files each, and so write one file without a shuffle."""
    return _settings(
        spark,
        {
            "spark.sql.files.maxPartitionBytes": str(target),
            "spark.sql.files.openCostInBytes": "0",
            "spark.sql.files.minPartitionNum": "1",
        },
    )


def _file_size(spark: SparkSession, mb: int) -> _settings:
    """The task size that adaptive execution aims for while a write runs."""
    return _settings(spark, {"spark.sql.adaptive.advisoryPartitionSizeInBytes": f"{mb}m"})
