"""Incremental ingest: JSON files that arrived since the last run, staged by system, event type and day.

The loader is a Structured Streaming query over the landing folder, run with
``availableNow``: the file source keeps a log of the files it has read in its
checkpoint, so a run reads the new files only, and a run without new files
reads nothing. The parquet sink keeps a log of its own, so a run that is
stopped half way and started again writes each file's events once; readers
of the staged folder see committed files only.

Staged rows are partitioned by ``system``, ``event_type`` and ``event_month``
(the first day of the month), so that a loader reading one type of some months
opens those folders only; ``event_day`` is a column. The rows of a run are
dealt by folder before they are written, and the many rows of a large folder to
several tasks: the number of files does not grow with the number of tasks.
A run stages what has arrived in batches of ``batch_bytes`` of files as they
lie in the landing folder, so that the disk its shuffle needs is bounded; the
shuffle files of a batch go when the batch is committed. Every batch has files
of its own in each folder it meets: smaller batches need less disk at a time
and make more files.
Unreadable lines stay rows with their text in ``_corrupt_record`` and no
type (``on_bad="quarantine"``), or are dropped (``"drop"``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from freightloom.functions.dates import parse_moment
from freightloom.session import SHUFFLES_END, settings
from freightloom.sources.events import CORRUPT, EVENT_SCHEMA

#: Layout of the landing folder: one folder per system, any folders below it.
LANDING_GLOB = "*/*"
PARTITIONS = ["system", "event_type", "event_month"]
#: Bytes of landed files that are staged at a time: what a run shuffles and sorts at once does not grow with what has landed.
BATCH_BYTES = 128 * 2**20


def landed_events(
    spark: SparkSession, landing: str, on_bad: str = "quarantine", multi_line: bool = False, batch_bytes: int = BATCH_BYTES
) -> DataFrame:
    """The streaming scan of ``<landing>/<system>/<folder>/*.json*`` with the system of each file."""
    if on_bad not in ("quarantine", "drop"):
        raise ValueError("on_bad must be 'quarantine' or 'drop'")
    reader = spark.readStream.option("multiLine", multi_line).option("pathGlobFilter", "*.json*")
    reader = reader.option("maxBytesPerTrigger", batch_bytes)
    if on_bad == "drop":
        reader = reader.schema(EVENT_SCHEMA).option("mode", "DROPMALFORMED")
    else:
        schema = T.StructType(EVENT_SCHEMA.fields + [T.StructField(CORRUPT, T.StringType())])
        reader = reader.schema(schema).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
    events = reader.json(f"{landing.rstrip('/')}/{LANDING_GLOB}")
    path = F.col("_metadata.file_path")
    system = F.substring_index(F.substring_index(path, "/", -3), "/", 1)
    day = F.to_date(parse_moment("timestamp"))
    return events.select(
        "*",
        system.alias("system"),
        path.alias("source_file"),
        day.alias("event_day"),
        F.trunc(day, "month").alias("event_month"),
    )


def ingest(
    spark: SparkSession, landing: str, staged: str, checkpoint: str, on_bad: str = "quarantine", batch_bytes: int = BATCH_BYTES
) -> int:
    """Stage what arrived since the last run with this checkpoint; the number of rows read in this run."""
    events = landed_events(spark, landing, on_bad, batch_bytes=batch_bytes).hint("rebalance", *PARTITIONS)
    writer = (
        events.writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .option("compression", "zstd")
        .partitionBy(*PARTITIONS)
        .trigger(availableNow=True)
    )
    with settings(spark, SHUFFLES_END):  # the query takes the settings along as it starts
        query = writer.start(staged)
    rows: dict[int, int] = {}
    ended = False
    while not ended:  # the query remembers its last hundred batches only
        ended = query.awaitTermination(1)
        for p in query.recentProgress:
            rows[p["batchId"]] = max(rows.get(p["batchId"], 0), p.get("numInputRows", 0))
    if query.exception() is not None:
        raise query.exception()
    return sum(rows.values())


def staged_events(spark: SparkSession, staged: str) -> DataFrame:
    """The staged events (committed files only); an empty table before the first run."""
    return spark.read.parquet(staged)


def quarantine(events: DataFrame) -> DataFrame:
    """The unreadable lines with their file."""
    if CORRUPT not in events.columns:
        return events.limit(0).select("system", "source_file", F.lit(None).cast("string").alias(CORRUPT))
    return events.where(F.col(CORRUPT).isNotNull()).select("system", "source_file", CORRUPT)
