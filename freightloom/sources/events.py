"""JSON events of the three source systems.

Every scalar that a source may spell badly (numbers, times) is read as text
and converted by ``route``, so that one bad field costs that field and not
the whole event.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from freightloom.constants import DEFAULT_PRIORITY, DESTINATION_NODE
from freightloom.functions.dates import parse_moment
from freightloom.functions.numbers import safe_decimal, safe_int

CORRUPT = "_corrupt_record"

_TEXT_FIELDS = [
    "event_type", "timestamp",
    "supplier_code", "supplier_name", "country",
    "customer_number", "customer_name", "city",
    "product_code", "product_name", "category", "supplier_reference",
    "order_reference", "delivery_priority",
    "supply_chain_node", "wms_sku", "tms_product_reference", "batch_identifier", "origin_country",
    "quantity", "unit_price",
    "erp_product_code", "sku", "batch_reference", "temperature", "status",
    "carrier_id", "carrier_name", "transport_product_reference",
    "shipment_identifier", "source_node", "target_node", "transport_mode", "cargo_product_reference",
    "estimated_arrival", "container_temperature", "speed_kmh",
    "arrival_node", "delay_minutes", "delivery_status", "received_by",
]


def _texts(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


EVENT_SCHEMA = T.StructType(
    _texts(*_TEXT_FIELDS).fields
    + [
        T.StructField("customer", _texts("customer_number", "customer_name", "city", "country")),
        T.StructField("items", T.ArrayType(_texts("product_code", "description", "quantity", "unit_price"))),
        T.StructField("carrier", _texts("carrier_id", "carrier_name")),
        T.StructField("current_route", _texts("source", "target")),
        T.StructField("coordinates", _texts("latitude", "longitude")),
    ]
)

#: Event types by source system.
SYSTEM_EVENTS = {
    "erp": ["SupplierCreated", "CustomerCreated", "ProductCreated", "OrderCreated", "BatchHarvested"],
    "wms": ["WarehouseSKUCreated", "NodeProcessed"],
    "tms": [
        "CarrierCreated", "TransportProductReferenceCreated", "TransportStarted",
        "ShipmentPositionUpdated", "TransportCompleted", "DeliveryCompleted",
    ],
}


def read_events(
    spark: SparkSession,
    directory: str,
    system: str | None = None,
    on_bad: str = "quarantine",
    multi_line: bool = True,
) -> DataFrame:
    """Scan the events of one system (or of ``directory`` itself).

    ``on_bad="quarantine"`` keeps unreadable files as rows whose text stands
    in ``_corrupt_record``; ``"drop"`` leaves them out. Line-delimited files,
    the form to prefer for large volumes since they split, are read with
    ``multi_line=False``.
    """
    if on_bad not in ("quarantine", "drop"):
        raise ValueError("on_bad must be 'quarantine' or 'drop'")
    path = f"{directory.rstrip('/')}/{system}" if system else directory
    reader = spark.read.option("multiLine", multi_line).option("pathGlobFilter", "*.json*")
    if on_bad == "drop":
        events = reader.schema(EVENT_SCHEMA).option("mode", "DROPMALFORMED").json(path)
    else:
        schema = T.StructType(EVENT_SCHEMA.fields + [T.StructField(CORRUPT, T.StringType())])
        reader = reader.schema(schema).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
        events = reader.json(path)
    return events.withColumn("source_file", F.col("_metadata.file_path"))


def corrupt_events(events: DataFrame) -> DataFrame:
    """The unreadable inputs, with the file each came from.

    The event type is kept as well: Spark refuses a query on raw JSON that
    reads the corrupt record alone.
    """
    return events.filter(F.col(CORRUPT).isNotNull()).select("source_file", "event_type", CORRUPT)


_AT = parse_moment


def _fields(event_type: str) -> dict[str, Column]:
    c = F.col
    at = {"event_timestamp": _AT("timestamp")}
    if event_type == "SupplierCreated":
        return {n: c(n) for n in ("supplier_code", "supplier_name", "country")} | at
    if event_type == "CustomerCreated":
        return {n: c(n) for n in ("customer_number", "customer_name", "city", "country")} | at
    if event_type == "ProductCreated":
        names = ("product_code", "product_name", "category", "supplier_reference")
        return {n: c(n) for n in names} | {"unit_price": safe_decimal("unit_price", 10, 2)} | at
    if event_type == "OrderCreated":
        return {
            "order_reference": c("order_reference"),
            "customer": c("customer"),
            "items": F.transform(
                "items",
                lambda i: F.struct(
                    i.product_code.alias("product_code"),
                    i.description.alias("description"),
                    safe_int(i.quantity).alias("quantity"),
                    safe_decimal(i.unit_price, 10, 2).alias("unit_price"),
                ),
            ),
            "delivery_priority": F.coalesce(c("delivery_priority"), F.lit(DEFAULT_PRIORITY)),
        } | at
    if event_type == "BatchHarvested":
        names = (
            "supply_chain_node", "product_code", "wms_sku", "tms_product_reference",
            "batch_identifier", "origin_country",
        )
        return {n: c(n) for n in names} | {"quantity": safe_int("quantity")} | at
    if event_type == "WarehouseSKUCreated":
        return {n: c(n) for n in ("erp_product_code", "sku")} | at
    if event_type == "NodeProcessed":
        names = ("supply_chain_node", "batch_reference", "sku", "status")
        return {n: c(n) for n in names} | {"temperature": safe_decimal("temperature", 5, 2)} | at
    if event_type == "CarrierCreated":
        return {"carrier_code": c("carrier_id"), "carrier_name": c("carrier_name")} | at
    if event_type == "TransportProductReferenceCreated":
        return {n: c(n) for n in ("erp_product_code", "transport_product_reference")} | at
    if event_type == "TransportStarted":
        names = (
            "shipment_identifier", "source_node", "target_node", "transport_mode",
            "cargo_product_reference", "carrier",
        )
        return {n: c(n) for n in names} | {"estimated_arrival": _AT("estimated_arrival")} | at
    if event_type == "ShipmentPositionUpdated":
        return {
            "shipment_identifier": c("shipment_identifier"),
            "cargo_product_reference": c("cargo_product_reference"),
            "current_route": c("current_route"),
            "latitude": safe_decimal("coordinates.latitude", 9, 6),
            "longitude": safe_decimal("coordinates.longitude", 9, 6),
            "container_temperature": safe_decimal("container_temperature", 5, 2),
            "speed_kmh": safe_decimal("speed_kmh", 6, 2),
        } | at
    if event_type == "TransportCompleted":
        names = ("shipment_identifier", "cargo_product_reference", "arrival_node")
        return {n: c(n) for n in names} | {"delay_minutes": safe_int("delay_minutes")} | at
    if event_type == "DeliveryCompleted":
        names = ("shipment_identifier", "cargo_product_reference", "delivery_status", "received_by")
        node = F.coalesce(c("supply_chain_node"), F.lit(DESTINATION_NODE))
        return {n: c(n) for n in names} | {"supply_chain_node": node} | at
    raise ValueError(f"unknown event type {event_type!r}")


def route(events: DataFrame, event_type: str) -> DataFrame:
    """The events of one type as a typed relation.

    The filter and the column list reach the scan, so thirteen relations on
    one columnar event table read only what each needs.
    """
    fields = _fields(event_type)
    return events.filter(F.col("event_type") == event_type).select(*[v.alias(k) for k, v in fields.items()])


def event_counts(events: DataFrame) -> DataFrame:
    """Number of events by type, unknown and missing types included."""
    return events.groupBy("event_type").agg(F.count("*").alias("events"))
