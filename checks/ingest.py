"""Incremental ingest over JSON files written from the check tables, in three portions with broken files."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from checks.adapter import Driver
from checks.registry import add
from freightloom.session import SHUFFLES_END, settings, shared_dir
from freightloom.sources.events import CORRUPT
from freightloom.streaming.ingest import ingest, staged_events

PORTIONS = 3
#: Lines of the broken file planted in each portion of each system.
BROKEN = ["{\"event_type\": \"OrderCreated\", ", "[1, 2"]
SYSTEMS = ("erp", "wms", "tms")


def _put(spark, path: str, text: str) -> None:
    """A file written by the file system of the path, as a source system would drop it."""
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    out = target.getFileSystem(spark._jsc.hadoopConfiguration()).create(target, True)
    out.write(bytearray(text.encode("utf-8")))
    out.close()


def _arrive(events: DataFrame, path: str) -> None:
    """The events as lines of JSON in ``<path>/portion=<k>``; the portion of an event follows from its line."""
    lines = events.select(F.to_json(F.struct("*")).alias("value"))
    portion = F.pmod(F.xxhash64("value"), F.lit(PORTIONS)).alias("portion")
    writer = lines.select("value", portion).write.mode("append").partitionBy("portion")
    writer.options(**{"compression": "gzip", "zlib.compress.level": "EIGHT"}).text(path)  # files that stay; the default makes them a fifteenth larger


def _land(spark, arrived: str, landing: str) -> None:
    """Puts the files of one portion into the landing folder, as JSON files by their names."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs = path(landing).getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(path(landing))
    if not fs.exists(path(arrived)):
        return
    for file in fs.listStatus(path(arrived)):
        name = file.getPath().getName()
        if not fs.rename(file.getPath(), path(f"{landing}/{name.removesuffix('.txt.gz')}.json.gz")):
            raise OSError(f"{arrived}/{name} was not put into {landing}")


def land_and_ingest(d: Driver, on_bad: str) -> tuple[DataFrame, list[int]]:
    """Events of each system land in three portions; a run of the loader follows each, and a fourth at the end."""
    spark = d.spark
    base = f"{shared_dir(spark).rstrip('/')}/ingest-{uuid.uuid4().hex}"
    arrived, landing, staged, checkpoint = f"{base}/arrived", f"{base}/landing", f"{base}/staged", f"{base}/checkpoint"
    # a writer a portion, else every task sorts its lines by portion
    with settings(spark, {"spark.sql.maxConcurrentOutputFileWriters": str(PORTIONS)} | SHUFFLES_END):
        for system in SYSTEMS:
            for part in getattr(d, f"{system}_parts")():  # one at a time: the shuffles of one are gone before the next
                _arrive(part, f"{arrived}/{system}")
    d.unstage()
    read = []
    for portion in range(PORTIONS):
        for system in SYSTEMS:
            _land(spark, f"{arrived}/{system}/portion={portion}", f"{landing}/{system}/portion-{portion}")
            _put(spark, f"{landing}/{system}/broken-{portion}/events.json", "\n".join(BROKEN) + "\n")
        read.append(ingest(spark, landing, staged, checkpoint, on_bad))
    read.append(ingest(spark, landing, staged, checkpoint, on_bad))
    return staged_events(spark, staged), read


def _counts(events: DataFrame) -> DataFrame:
    kind = F.col("event_type")
    if CORRUPT in events.columns:
        kind = F.when(F.col(CORRUPT).isNotNull(), F.lit("(unreadable)")).otherwise(kind)
    return events.groupBy("system", kind.alias("event_type")).agg(F.count(F.lit(1)).alias("events"))


_ROUTED = """SELECT 'erp' AS system, 'SupplierCreated' AS event_type, COUNT(*) + COUNT(*) FILTER (WHERE s_suppkey % 10 = 0) AS events FROM supplier
    UNION ALL SELECT 'erp', 'CustomerCreated', COUNT(*) FROM customer WHERE c_custkey % 50 <> 0
    UNION ALL SELECT 'erp', 'ProductCreated', COUNT(*) FROM part
    UNION ALL SELECT 'erp', 'OrderCreated', COUNT(*) FROM v_orders JOIN v_customers USING (customer_id)
    UNION ALL SELECT 'erp', 'BatchHarvested', COUNT(*) FROM v_batches
    UNION ALL SELECT 'wms', 'WarehouseSKUCreated', COUNT(*) FROM part
    UNION ALL SELECT 'wms', 'NodeProcessed', COUNT(*) FROM v_hops
    UNION ALL SELECT 'tms', 'CarrierCreated', COUNT(*) FROM v_carriers
    UNION ALL SELECT 'tms', 'TransportProductReferenceCreated', COUNT(*) FROM v_transport_product_references
    UNION ALL SELECT 'tms', 'TransportStarted', COUNT(*) FROM v_shipments WHERE shipment_id % 40 <> 1
    UNION ALL SELECT 'tms', 'ShipmentPositionUpdated', COUNT(*) FROM events
    UNION ALL SELECT 'tms', 'TransportCompleted', COUNT(*) FROM v_transport_completions
    UNION ALL SELECT 'tms', 'DeliveryCompleted', COUNT(*) FROM v_deliveries"""

add(
    "SRC-1_incremental_ingest",
    "system:s event_type:s events:i",
    lambda d: _counts(land_and_ingest(d, "quarantine")[0]),
    _ROUTED + "\n    UNION ALL SELECT system, '(unreadable)', 6 FROM (VALUES ('erp'), ('wms'), ('tms')) AS s(system)",
)

add(
    "SRC-2_ingest_dropping_bad_lines",
    "system:s event_type:s events:i",
    lambda d: _counts(land_and_ingest(d, "drop")[0]),
    _ROUTED,
)
