"""Lifecycle documents: nested rows folded from events.

Events are folded in the order of their own time, transport starts first.
Embedded lists come in parts of bounded size; an entity with an ordinary
history has the single part 0.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from freightloom import constants as C
from freightloom.functions.dates import date_key, moment, plus_seconds
from freightloom.functions.keys import normalize_key
from freightloom.functions.numbers import within_cold_chain
from freightloom.operators.skew import bounded_lists, first_per_key
from freightloom.operators.writes import insert_ignore


def _element(kind: str, rank: int, **given: Column) -> Column:
    """One embedded event; fields an event type lacks are NULL."""
    fields = {
        "latitude": "decimal(9,6)",
        "longitude": "decimal(9,6)",
        "container_temperature": "decimal(5,2)",
        "speed_kmh": "decimal(6,2)",
        "arrival_node": "string",
        "delay_minutes": "int",
        "delivery_status": "string",
        "received_by": "string",
    }
    values = [given.get(n, F.lit(None)).cast(t).alias(n) for n, t in fields.items()]
    return F.struct(given["timestamp"].alias("timestamp"), F.lit(rank).alias("rank"), F.lit(kind).alias("event_type"), *values)


KEY = "shipment_identifier"


def _firsts(started: DataFrame, completed: DataFrame, delivered: DataFrame) -> DataFrame:
    """First start, completion and delivery of each started shipment, as structs s, d and f."""
    first_start = started.groupBy(KEY).agg(
        F.min(
            F.struct(
                "event_timestamp", "cargo_product_reference", "source_node", "target_node", "transport_mode", "carrier",
                "estimated_arrival",
            )
        ).alias("s")
    )
    first_done = completed.groupBy(KEY).agg(F.min(F.struct("event_timestamp", "arrival_node", "delay_minutes")).alias("d"))
    first_final = delivered.groupBy(KEY).agg(
        F.min(F.struct("event_timestamp", "delivery_status", "received_by")).alias("f")
    )
    return first_start.join(first_done, KEY, "left").join(first_final, KEY, "left")


def shipment_lifecycle(
    started: DataFrame, positions: DataFrame, completed: DataFrame, delivered: DataFrame
) -> DataFrame:
    """One document per started shipment; its events are rows of ``shipment_events``.

    The first start, completion and delivery count. The status runs from
    IN_TRANSIT over TRANSPORT_COMPLETED to the final status, which nothing
    overwrites.
    """
    c = F.col
    last_position = positions.groupBy(KEY).agg(F.max("event_timestamp").alias("p"))
    return _firsts(started, completed, delivered).join(last_position, KEY, "left").select(
        KEY,
        normalize_key("s.cargo_product_reference").alias("cargo_product_reference"),
        "s.source_node",
        "s.target_node",
        "s.transport_mode",
        "s.carrier",
        "s.estimated_arrival",
        c("s.event_timestamp").alias("started_at"),
        F.when(c("f").isNotNull(), c("f.delivery_status"))
        .when(c("d").isNotNull(), "TRANSPORT_COMPLETED")
        .otherwise("IN_TRANSIT")
        .alias("delivery_status"),
        c("d.delay_minutes").alias("delay_minutes"),
        c("d.event_timestamp").alias("completed_at"),
        c("s.event_timestamp").alias("created_at"),
        F.coalesce(F.greatest("p", "d.event_timestamp", "f.event_timestamp"), "s.event_timestamp").alias("updated_at"),
    )


def shipment_events(
    started: DataFrame, positions: DataFrame, completed: DataFrame, delivered: DataFrame
) -> DataFrame:
    """Events of each started shipment in order of time, one list a day.

    The first start, completion and delivery count, and one position per time.
    """
    c = F.col
    firsts = _firsts(started, completed, delivered)
    points = first_per_key(
        positions.select(KEY, "event_timestamp", "latitude", "longitude", "container_temperature", "speed_kmh"),
        [KEY, "event_timestamp"],
        [],
    ).join(firsts.select(KEY), KEY, "left_semi")
    elements = points.select(
        KEY,
        _element(
            "ShipmentPositionUpdated", 1, timestamp=c("event_timestamp"), latitude=c("latitude"),
            longitude=c("longitude"), container_temperature=c("container_temperature"), speed_kmh=c("speed_kmh"),
        ).alias("event"),
    ).unionByName(
        firsts.select(
            KEY,
            F.explode(
                F.array_compact(
                    F.array(
                        _element("TransportStarted", 0, timestamp=c("s.event_timestamp")),
                        F.when(
                            c("d").isNotNull(),
                            _element(
                                "TransportCompleted", 2, timestamp=c("d.event_timestamp"),
                                arrival_node=c("d.arrival_node"), delay_minutes=c("d.delay_minutes"),
                            ),
                        ),
                        F.when(
                            c("f").isNotNull(),
                            _element(
                                "DeliveryCompleted", 3, timestamp=c("f.event_timestamp"),
                                delivery_status=c("f.delivery_status"), received_by=c("f.received_by"),
                            ),
                        ),
                    )
                )
            ).alias("event"),
        )
    )
    return bounded_lists(elements, [KEY], c("event"), "events", date_key("event.timestamp"))


def node_documents(processings: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """One document per batch and station, the first event counts.

    Takes NodeProcessed events.
    """
    ok = within_cold_chain("temperature")
    documents = processings.select(
        "batch_reference",
        "supply_chain_node",
        "sku",
        normalize_key(F.coalesce("sku", F.lit(""))).alias("canonical_product_code"),
        "temperature",
        ok.alias("temperature_within_range"),
        "status",
        F.col("event_timestamp").alias("processed_at"),
        F.struct(
            ok.alias("temperature_ok"),
            F.lit(C.COLD_CHAIN_MIN).cast("decimal(5,2)").alias("min_allowed"),
            F.lit(C.COLD_CHAIN_MAX).cast("decimal(5,2)").alias("max_allowed"),
        ).alias("quality_flags"),
    )
    return insert_ignore(documents, existing, ["batch_reference", "supply_chain_node"], ["processed_at"])


def batch_documents(batches: DataFrame, processings: DataFrame, nodes: DataFrame) -> DataFrame:
    """One document per batch; the stations it passed are rows of ``batch_stations``.

    Takes BatchHarvested and NodeProcessed events. A batch known only from
    a processing gets a document without harvest data. The current node is
    the one of the latest processing, the later station in the flow if two
    share a time.
    """
    key = "batch_identifier"
    c = F.col
    base = batches.groupBy(key).agg(
        F.min(
            F.struct(
                "event_timestamp", "product_code", "wms_sku", "tms_product_reference", "origin_country", "quantity",
                "supply_chain_node",
            )
        ).alias("b")
    )
    order = nodes.select(c("node_code").alias("supply_chain_node"), "sequence_order")
    latest = (
        processings.withColumnRenamed("batch_reference", key)
        .join(order, "supply_chain_node", "left")
        .groupBy(key)
        .agg(F.max(F.struct("event_timestamp", "sequence_order", "supply_chain_node")).alias("l"))
    )
    return base.join(latest, key, "full").select(
        key,
        normalize_key("b.product_code").alias("erp_product_code"),
        "b.wms_sku",
        "b.tms_product_reference",
        "b.origin_country",
        "b.quantity",
        c("b.event_timestamp").alias("harvested_at"),
        F.coalesce("l.supply_chain_node", "b.supply_chain_node").alias("current_node"),
        c("l.event_timestamp").alias("updated_at"),
    )


def batch_stations(processings: DataFrame) -> DataFrame:
    """Stations that each batch passed in order of time, one list a day."""
    c = F.col
    entry = F.struct(
        c("event_timestamp").alias("processed_at"), c("supply_chain_node").alias("node"), "temperature", "status"
    )
    entries = processings.select(c("batch_reference").alias("batch_identifier"), entry.alias("entry")).distinct()
    return bounded_lists(entries, ["batch_identifier"], c("entry"), "nodes_processed", date_key("entry.processed_at"))


def order_documents(orders: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """One document per order, the first event with customer and items embedded."""
    return insert_ignore(orders, existing, ["order_reference"], ["event_timestamp"])


def unexpired_documents(documents: DataFrame, as_of: datetime, column: str = "created_at") -> DataFrame:
    """Documents younger than their 90 days."""
    end = plus_seconds(column, C.TTL_SECONDS["lifecycle_document"])
    return documents.filter(end > moment(as_of))


# --- questions to the documents ------------------------------------------------------


def delayed_shipments(documents: DataFrame, minutes: int = C.LATE_MINUTES) -> DataFrame:
    """Shipments delayed by more than so many minutes."""
    return documents.filter(F.col("delay_minutes") > minutes).select(
        "shipment_identifier", "source_node", "target_node", "delay_minutes"
    )


def cool_batches(documents: DataFrame, node: str, below: float) -> DataFrame:
    """Batches that passed a station below a temperature."""
    return documents.filter((F.col("supply_chain_node") == node) & (F.col("temperature") < below)).select(
        "batch_reference", "temperature", "processed_at"
    )


def range_violations(documents: DataFrame) -> DataFrame:
    """Station documents outside the corridor or without measurement."""
    return documents.filter(~F.col("temperature_within_range")).select(
        "batch_reference", "supply_chain_node", "temperature"
    )
