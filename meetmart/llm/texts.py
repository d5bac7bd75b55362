"""Reading (id, text) rows in Arrow batches inside tasks, and the word splits the operators share."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

_SEPARATORS = bytes([*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)])
_FOLD = bytes.maketrans(
    bytes(range(0x41, 0x5B)) + _SEPARATORS, bytes(range(0x61, 0x7B)) + b" " * len(_SEPARATORS)
)
#: Characters that Unicode calls white space.
UNICODE_SPACE = "\t-\r \x85\xa0  -     　"


#: Rows that Spark hands to a task's Python at a time; its default of 10,000 is meant for rows of numbers.
BATCH_ROWS = 1000
_BATCH_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"
_shipped: set[str] = set()


def in_tasks(df: DataFrame, run: Callable, schema: str | StructType) -> DataFrame:
    """`run` over the Arrow batches of each partition; the package is sent to the executors first.

    Texts are long, so batches are made short, unless the session has a size of its own.
    """
    spark = df.sparkSession
    ship(spark)
    if spark.conf.get(_BATCH_SETTING) == "10000":
        spark.conf.set(_BATCH_SETTING, BATCH_ROWS)
    return df.mapInArrow(run, schema)


def ship(spark: SparkSession) -> None:
    """Sends this package's source to all executors, once per application, as --py-files would."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="package-"), "meetmart_source.zip")
    with zipfile.ZipFile(path, "w") as file:
        for folder, _, names in os.walk(package):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    file.write(full, os.path.relpath(full, os.path.dirname(package)))
    context.addPyFile(path)
    _shipped.add(context.applicationId)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_and_text(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Only the two columns an operator reads, so that others cannot clash with its own."""
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def utf8(column: pa.Array) -> list[bytes]:
    """The texts of a batch as UTF-8, null as empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def folded_words(raw: bytes) -> list[bytes]:
    """Words of ASCII digits, letters (lower-cased) and all characters beyond ASCII."""
    return raw.translate(_FOLD).split()


def map_batches(
    docs: DataFrame, rows: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str | StructType
) -> DataFrame:
    """`rows` applied to each Arrow batch of `docs`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield rows(batch)

    return in_tasks(docs, run, schema)


def most_frequent(counts: DataFrame, size: int, least: int = 1) -> list[tuple]:
    """(word, n) of the most frequent words, `size` at most, by falling n, then by word.

    The border is a count, so nothing is ranked: counts fall into steps of about 2 %, whose number is
    bounded, and as many of the highest steps are taken as hold no more than `size` words together.
    """
    step = F.floor(F.log2("n") * 32).cast("int")
    steps = counts.where(F.col("n") >= least).groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("words"))
    total, border = 0, None
    for row in sorted(steps.collect(), reverse=True):
        total += row.words
        if total > size:
            break
        border = row.step
    if border is None:
        return []
    table = counts.where((F.col("n") >= least) & (step >= border)).select("word", "n").toArrow()
    rows = zip(table.column("word").to_pylist(), table.column("n").to_pylist())
    return sorted(rows, key=lambda r: (-r[1], r[0]))


def in_share(doc_id: Column, modulus: int, remainder: int) -> Column:
    """Whether the checksum of the id as text falls on `remainder`; a null id never does."""
    return F.coalesce(
        F.crc32(doc_id.cast("string").cast("binary")) % modulus == remainder, F.lit(False)
    )
