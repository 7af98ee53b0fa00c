"""Streaming counterparts of the live state.

No event is ever too late. The latest value of a key is a maximum and a count
per day a sum, so neither needs a watermark, and files may arrive in any order.
Members of lists are passed on as they come, without state; repetitions are
dropped within a micro-batch and settled over all batches when the written rows
are read (``settled``). What has outlived its time is filtered out on reading,
as in the batch form, and never by dropping state.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from freightloom.functions.dates import date_key, plus_seconds
from freightloom.functions.numbers import breaks_cold_chain
from freightloom.operators.live import SHIPMENT, active_shipments, route_members, status_ttl, violation_members
from freightloom.session import shared_dir
from freightloom.sources.events import EVENT_SCHEMA


def read_event_stream(
    spark: SparkSession, directory: str, multi_line: bool = True, files_per_trigger: int | None = None
) -> DataFrame:
    """Stream of the JSON events that arrive in a folder."""
    reader = spark.readStream.schema(EVENT_SCHEMA).option("multiLine", multi_line).option("pathGlobFilter", "*.json*")
    if files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.json(directory)


def with_event_time(stream: DataFrame, column: str = "event_timestamp") -> DataFrame:
    """Add the event time a window needs; it takes no zone-free timestamp."""
    return stream.withColumn("event_time", F.col(column).cast("timestamp"))


def stream_latest(stream: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """Last values per key, for update mode."""
    return (
        stream.groupBy(key)
        .agg(F.max(F.struct("event_timestamp", *fields)).alias("v"))
        .select(key, F.col("v.event_timestamp").alias("updated_at"), *[F.col(f"v.{f}").alias(f) for f in fields])
    )


def stream_shipment_status(events: DataFrame) -> DataFrame:
    """Status updates from one stream of transport starts and deliveries.

    ``events`` has shipment_identifier, event_type, delivery_status and
    event_timestamp.
    """
    kind = F.col("event_type")
    changes = events.filter(kind.isin("TransportStarted", "DeliveryCompleted")).select(
        SHIPMENT,
        "event_timestamp",
        F.when(kind == "TransportStarted", 0).otherwise(1).alias("rank"),
        F.when(kind == "TransportStarted", "IN_TRANSIT")
        .otherwise(F.coalesce("delivery_status", F.lit("UNKNOWN")))
        .alias("status"),
    )
    return stream_latest(changes, SHIPMENT, ["rank", "status"])


def stream_shipment_info(starts: DataFrame) -> DataFrame:
    """Updates of route, mode and carrier; takes ``flat_starts`` of a stream."""
    fields = ["transport_mode", "source_node", "target_node", "carrier_id"]
    return stream_latest(starts, SHIPMENT, fields)


def stream_latest_position(positions: DataFrame) -> DataFrame:
    """Updates of the last known position."""
    fields = ["latitude", "longitude", "container_temperature", "speed_kmh"]
    return stream_latest(positions, SHIPMENT, fields)


def stream_temperature_alerts(positions: DataFrame) -> DataFrame:
    """Updates of the last breach per shipment."""
    bad = positions.filter(breaks_cold_chain("container_temperature"))
    return stream_latest(bad, SHIPMENT, [])


#: What makes two written members the same.
POINT_KEYS, VIOLATION_KEYS, EVENT_KEYS = (SHIPMENT, "member"), ("day", "member"), (SHIPMENT, "event_type", "event_timestamp")


def stream_route_points(positions: DataFrame) -> DataFrame:
    """Points of routes for append mode; ``settled`` by POINT_KEYS when read.

    The list of a route is put together from the written points.
    """
    return route_members(positions, repeated=True)


def stream_violations(positions: DataFrame) -> DataFrame:
    """Breaches by day for append mode; ``settled`` by VIOLATION_KEYS when read."""
    return violation_members(positions)


def stream_changes(events: DataFrame) -> DataFrame:
    """Starts and deliveries for append mode, from which active shipments are counted."""
    return events.filter(F.col("event_type").isin("TransportStarted", "DeliveryCompleted")).select(
        SHIPMENT, "event_type", "event_timestamp"
    )


def stream_counters(events: DataFrame) -> DataFrame:
    """Deliveries by status, alerts and starts per day, for update mode.

    ``events`` has event_type, delivery_status, container_temperature and
    event_timestamp.
    """
    kind = F.col("event_type")
    counter = (
        F.when(kind == "TransportStarted", F.lit("started"))
        .when(
            kind == "DeliveryCompleted",
            F.concat(F.lit("deliveries_"), F.lower(F.coalesce("delivery_status", F.lit("UNKNOWN")))),
        )
        .when(
            (kind == "ShipmentPositionUpdated") & breaks_cold_chain("container_temperature"), F.lit("temperature_alerts")
        )
    )
    counted = with_event_time(events).withColumn("counter", counter).filter(F.col("counter").isNotNull())
    return (
        counted.groupBy(F.window("event_time", "1 day").alias("day"), "counter")
        .agg(F.count("*").alias("value"))
        .select(F.col("day.start").alias("day"), "counter", "value")
    )


def stream_orders_per_day(orders: DataFrame) -> DataFrame:
    """Orders per day of the event, for update mode."""
    return (
        with_event_time(orders)
        .groupBy(F.window("event_time", "1 day").alias("day"))
        .agg(F.count("*").alias("orders"))
        .select(date_key("day.start").alias("day_key"), F.col("day.start").alias("day"), "orders")
    )


def stream_order_state(orders: DataFrame) -> DataFrame:
    """Updates of order status and meta data."""
    flat = orders.select(
        "order_reference",
        "event_timestamp",
        F.coalesce("customer.customer_number", F.lit("")).alias("customer_number"),
        F.coalesce("customer.customer_name", F.lit("")).alias("customer_name"),
        F.col("delivery_priority").alias("priority"),
    )
    fields = ["customer_number", "customer_name", "priority"]
    return stream_latest(flat, "order_reference", fields)


# --- writing and reading ------------------------------------------------------------------


def start(
    stream: DataFrame, table: str, checkpoint: str, mode: str = "update", unique: tuple[str, ...] = ()
) -> StreamingQuery:
    """Write what a stream yields as one folder per micro-batch, then stop.

    A micro-batch that is run again replaces its own folder. Rows that repeat
    the columns ``unique`` within a micro-batch are written once.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = batch.dropDuplicates(list(unique)) if unique else batch
        rows.write.mode("overwrite").parquet(f"{table}/batch={batch_id}")

    return (
        stream.writeStream.outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(write)
        .start()
    )


def run(stream: DataFrame, name: str, mode: str = "update", unique: tuple[str, ...] = ()) -> DataFrame:
    """Process what is available and return the written updates with their batch."""
    spark = stream.sparkSession
    base = f"{shared_dir(spark)}/streams/{name}-{uuid.uuid4().hex}"
    schema = stream.schema
    start(stream, f"{base}/table", f"{base}/checkpoint", mode, unique).awaitTermination()
    return spark.read.schema(schema.add("batch", "long")).option("basePath", f"{base}/table").parquet(f"{base}/table")


def settled(written: DataFrame, unique: tuple[str, ...]) -> DataFrame:
    """Written rows without repetitions, whichever batches they came in."""
    return written.drop("batch").dropDuplicates(list(unique))


def active_from(changes: DataFrame) -> DataFrame:
    """Active shipments from the written starts and deliveries."""
    kind = F.col("event_type")
    return active_shipments(changes.filter(kind == "TransportStarted"), changes.filter(kind == "DeliveryCompleted"))


def last_updates(updates: DataFrame, keys: list[str]) -> DataFrame:
    """The last update per key and day."""
    values = [c for c in updates.columns if c not in (*keys, "batch")]
    return (
        updates.groupBy(*keys)
        .agg(F.max(F.struct("batch", *values)).alias("u"))
        .select(*keys, *[F.col(f"u.{c}").alias(c) for c in values])
    )


def latest_of_updates(updates: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """Current values per key from the updates of all batches."""
    return (
        updates.groupBy(key)
        .agg(F.max(F.struct("updated_at", *fields)).alias("v"))
        .select(key, F.col("v.updated_at").alias("updated_at"), *[F.col(f"v.{f}").alias(f) for f in fields])
    )


def expiring(state: DataFrame, ttl: Column | int) -> DataFrame:
    """Add the moment each state row expires."""
    return state.withColumn("expires_at", plus_seconds("updated_at", ttl))


def current_status(updates: DataFrame) -> DataFrame:
    """Current shipment status from the written updates."""
    return expiring(latest_of_updates(updates, SHIPMENT, ["rank", "status"]).drop("rank"), status_ttl())


def counter_totals(updates: DataFrame) -> DataFrame:
    """Counters over all days from the written updates."""
    last = last_updates(updates, ["day", "counter"])
    return last.groupBy("counter").agg(F.sum("value").alias("value"))
