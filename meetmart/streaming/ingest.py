"""Landing zone -> bronze table, as a stream.

Each new body is stored once per UTC day of arrival, keyed by the hash of its content. Bodies
that break the webhook contract go to the `dead_letter` route of the same table, with reasons,
so nothing that landed is lost.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from meetmart import schemas
from meetmart.functions.landing import body_md5
from meetmart.functions.timeparts import day_text
from meetmart.operators.contracts import BRONZE, DEAD_LETTER, REASONS, route_of, webhook_reasons
from meetmart.operators.dedupe import keep_latest
from meetmart.sources.readers import between_days, day_in, partition_values, read_days_or_empty
from meetmart.sources.scratch import materialized
from meetmart.sources.writers import write_days

_BY = ("route", "dt", "batch_id")
#: Route under which metrics count bodies that the table held already.
COPY = "copy"
#: Bodies and what is parsed out of them are kept side by side; as text they pack well.
_PACKED = {"compression": "zstd"}
_COMPACTED = -1  # stands for all batches of a day that was compacted

_TEXT = T.StringType()
LANDED = T.StructType(
    [
        T.StructField("body", _TEXT),
        T.StructField("arrived_at", T.TimestampType()),
        T.StructField("file_path", _TEXT),
        T.StructField("body_md5", _TEXT),
        T.StructField(REASONS, T.ArrayType(_TEXT)),
        T.StructField("webhook", schemas.WEBHOOK),
        T.StructField("route", _TEXT),
        T.StructField("dt", _TEXT),
        T.StructField("batch_id", T.LongType()),
    ]
)


def read_landing(
    spark: SparkSession,
    path: str,
    whole_text: bool = True,
    max_file_age: str = "36500d",
    max_bytes: int = 0,
    max_files: int = 0,
) -> DataFrame:
    """Stream of bodies: one per file (`whole_text`), or one per line for busy landing zones.

    The file source skips files older than `max_file_age` against the newest one; the default
    of a century keeps back-dated files. The setting also bounds the list of seen files on the
    driver: lower it where very many files land and none is back-dated. `max_bytes` and
    `max_files` bound what one batch takes of a backlog.
    """
    reader = (
        spark.readStream.format("text")
        .option("wholetext", whole_text)
        .option("maxFileAge", max_file_age)
    )
    if max_bytes:
        reader = reader.option("maxBytesPerTrigger", max_bytes)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path).select(
        F.col("value").alias("body"),
        F.col("_metadata.file_modification_time").alias("arrived_at"),
        F.col("_metadata.file_path").alias("file_path"),
    )


def first_copies(landed: DataFrame) -> DataFrame:
    """First copy of each body per day of arrival within a batch, in an order that a replay repeats.

    Bodies are shuffled once. Many copies of one body, also those of one file, are thinned out to one per task before
    that. The hash travels as bytes, in half the space of its text.
    """
    keyed = landed.withColumns({"dt": day_text(F.col("arrived_at")), "_hash": F.unhex(body_md5(F.col("body")))})
    first = keep_latest(keyed, ["dt", "_hash"], [F.col("arrived_at"), F.col("file_path"), F.col("body")])
    return first.withColumn("body_md5", F.lower(F.hex("_hash"))).drop("_hash")


def _earlier(batch: DataFrame, table: str, batch_id: int) -> DataFrame | None:
    """(dt, body_md5, stored_at) that the table holds for the days in a batch, from batches that were started before
    it and from what was compacted out of them; None for a table not written yet.

    Only those days are read, and of them the hashes only. Days come to the driver, bounded by the calendar.
    """
    spark = batch.sparkSession
    if not partition_values(spark, table, "route"):
        return None
    days = [row["dt"] for row in batch.select("dt").distinct().collect()]
    stored = read_landed(spark, table).where(day_in(days) & (F.col("batch_id") < batch_id))
    return stored.select("dt", "body_md5", F.col("_metadata.file_modification_time").alias("stored_at"))


def not_landed(batch: DataFrame, table: str, batch_id: int) -> DataFrame:
    """Bodies of a batch that the table does not hold for their day yet.

    Rows of this very batch do not count: a batch that is replayed must find what it found the first time.
    """
    earlier = _earlier(batch, table, batch_id)
    return batch if earlier is None else batch.join(earlier, ["dt", "body_md5"], "left_anti").select(*batch.columns)


def routed(landed: DataFrame) -> DataFrame:
    """Adds contract reasons, the route they decide, and the parsed webhook."""
    parsed = F.from_json("body", schemas.WEBHOOK)
    return webhook_reasons(landed).withColumns({"route": route_of(REASONS), "webhook": parsed})


def start_ingest(
    spark: SparkSession,
    landing: str,
    table: str,
    checkpoint: str,
    whole_text: bool = True,
    memory: str = "7 days",
    max_file_age: str = "36500d",
    max_bytes: int = 0,
    max_files: int = 0,
    **trigger,
) -> StreamingQuery:
    """Start the ingest; by default it takes all there is and stops.

    A batch owns its `batch_id` partitions and overwrites them, so a batch that is replayed
    after a failure replaces its rows instead of adding them again. A body that the table holds already for its day is
    not stored again, however long ago it came; the table is all that is remembered, the stream keeps no state. Copies of
    bodies that were stored within `memory` are left out without being counted. The other settings are those of
    `read_landing`.
    """

    def store(batch: DataFrame, batch_id: int) -> None:
        first = materialized(first_copies(batch), "batch", **_PACKED)  # bodies are shuffled once
        rows = routed(not_landed(first, table, batch_id).drop("_seen_at")).withColumn("batch_id", F.lit(batch_id))
        write_days(rows, table, by=_BY, rebalance=False, **_PACKED)  # its tasks come sized out of the shuffle
        _keep_metrics(first, table, batch_id, memory)

    bodies = read_landing(spark, landing, whole_text, max_file_age, max_bytes, max_files)
    return (
        bodies.withColumn("_seen_at", F.current_timestamp())  # the same for all rows of a batch, and when it is replayed
        .writeStream.foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


_METRICS = T.StructType(
    [
        T.StructField("route", _TEXT),
        T.StructField("dt", _TEXT),
        T.StructField("rows", T.LongType()),
        T.StructField("batch_id", T.LongType()),
    ]
)


def _metrics_path(table: str) -> str:
    return f"{table.rstrip('/')}_metrics"


def _keep_metrics(batch: DataFrame, table: str, batch_id: int, memory: str) -> None:
    """Rows of one batch by route and day, and the copies it left out of bodies that were stored more than `memory`
    before, beside the table; a replay replaces them.

    Only the batch's own partitions are counted, which their footers tell.
    """
    spark = batch.sparkSession
    own = read_days_or_empty(spark, table, LANDED).where(F.col("batch_id") == batch_id)
    counts = own.groupBy("route", "dt").agg(F.count(F.lit(1)).alias("rows"))
    earlier = _earlier(batch, table, batch_id)
    if earlier is not None:
        seen = batch.select("dt", "body_md5", (F.col("_seen_at") - F.lit(memory).cast("interval")).alias("since"))
        same = [seen[c] == earlier[c] for c in ("dt", "body_md5")]
        forgotten = seen.join(earlier, [*same, F.col("stored_at") < F.col("since")], "left_semi")
        copies = forgotten.groupBy("dt").agg(F.count(F.lit(1)).alias("rows"))
        counts = counts.unionByName(copies.withColumn("route", F.lit(COPY)))
    counts = counts.withColumn("batch_id", F.lit(batch_id).cast("long"))
    write_days(counts, _metrics_path(table), by=("batch_id",), replaces=[{"batch_id": str(batch_id)}])


def batch_metrics(spark: SparkSession, table: str) -> DataFrame:
    """(route, dt, rows, batch_id) as kept with each batch: accepted, dead letters, and copies that came too late for
    the ingest's memory. Added up over batches they are the `landing_metrics`, without a look at the table."""
    return read_days_or_empty(spark, _metrics_path(table), _METRICS)


def compact_landed(spark: SparkSession, table: str, day: str) -> int:
    """Puts the batches of a day that is over into one partition per route; returns the rows kept.

    A body is stored once per day, so a compaction that broke off between writing and removing,
    and left rows twice, is mended by running it again. Only batches that have ended may be
    compacted: a batch that is replayed would store its rows again.
    """
    rows = read_landed(spark, table).where(F.col("dt") == day)
    batches = [r.asDict() for r in rows.select(*_BY).distinct().collect()]  # partition names
    if not batches:
        return 0
    order = [F.col("batch_id"), F.col("arrived_at"), F.col("file_path")]
    single = keep_latest(rows, ["dt", "body_md5"], order).withColumn("batch_id", F.lit(_COMPACTED))
    aside = materialized(single, "compact-landed")
    gone = [b for b in batches if b["batch_id"] != _COMPACTED]
    return write_days(aside, table, by=_BY, replaces=gone, **_PACKED)


def read_landed(spark: SparkSession, table: str) -> DataFrame:
    return spark.read.schema(LANDED).parquet(table)


def landed_webhooks(
    spark: SparkSession, table: str, first: str | None = None, last: str | None = None
) -> DataFrame:
    """Accepted webhooks that arrived on these days, in the shape of `schemas.WEBHOOK`."""
    accepted = read_landed(spark, table).where(F.col("route") == BRONZE)
    return between_days(accepted, first, last).select("webhook.*")


_PLACE = rf"/(route={BRONZE}/dt=[^/]+/batch_id=[^/]+/[^/]+)$"


def landed_files(spark: SparkSession, table: str, last: str) -> DataFrame:
    """(file, dt, batch_id) of the files of accepted webhooks that arrived up to a day, from the listing.

    A file never changes: batches that are replayed or compacted come out as new files. No file is opened: of the
    columns that the source offers, only the path is asked for.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(table)
    accepted = files.where((F.col("route") == BRONZE) & (F.col("dt").cast("string") <= last))
    return accepted.select(
        F.regexp_extract("path", _PLACE, 1).alias("file"), F.col("dt").cast("string").alias("dt"), "batch_id"
    )


def unread_files(spark: SparkSession, table: str, last: str, known: DataFrame) -> DataFrame:
    """Those of the `landed_files` that are not among the files of `known` (column `file`), written aside."""
    return materialized(landed_files(spark, table, last).join(known, "file", "left_anti"), "unread")


def webhooks_of(spark: SparkSession, table: str, files: DataFrame) -> DataFrame:
    """Webhooks of some of the `landed_files`, in the shape of `schemas.WEBHOOK`.

    Only the partitions that hold such files are read. The driver gets their names, one per batch and day.
    """
    by_day: dict[str, list[int]] = {}
    for row in files.select("dt", "batch_id").distinct().collect():
        by_day.setdefault(row["dt"], []).append(row["batch_id"])
    wanted = F.lit(False)
    for day, batches in by_day.items():
        wanted = wanted | ((F.col("dt") == day) & F.col("batch_id").isin(batches))
    rows = read_landed(spark, table).where((F.col("route") == BRONZE) & wanted)
    rows = rows.select("webhook", F.regexp_extract("_metadata.file_path", _PLACE, 1).alias("file"))
    return rows.join(files.select("file"), "file", "left_semi").select("webhook.*")


def dead_letters(spark: SparkSession, table: str) -> DataFrame:
    return (
        read_landed(spark, table)
        .where(F.col("route") == DEAD_LETTER)
        .select("dt", "body", "body_md5", REASONS, "file_path")
    )


def landing_metrics(spark: SparkSession, table: str) -> DataFrame:
    """Rows by route and day; reads no data columns."""
    return (
        read_landed(spark, table).groupBy("route", "dt").agg(F.count(F.lit(1)).alias("rows"))
    )
