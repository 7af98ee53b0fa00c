"""Operational tables from routed events.

Each builder returns ``(rows, rejects)``. ``rows`` are the new rows with
assigned keys, to be appended; ``rejects`` are the events that point to
nothing, with the reason. Pass the stored table as ``existing`` to load
into it; loading the same events again then yields no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from freightloom.constants import ORIGIN_NODE
from freightloom.functions.keys import normalize_key, tms_key, wms_key
from freightloom.functions.numbers import safe_decimal
from freightloom.operators.skew import matched
from freightloom.operators.writes import assign_keys, insert_ignore, insert_missing, split_unresolved

Built = tuple[DataFrame, DataFrame | None]


def _new(rows: DataFrame, existing: DataFrame | None, key: str, id_column: str, order: list[str | Column]) -> DataFrame:
    return assign_keys(insert_ignore(rows, existing, [key], order), key, id_column, existing)


def _composite(rows: DataFrame, existing: DataFrame | None, keys: list[str], id_column: str, order: list[str]) -> DataFrame:
    fresh = insert_ignore(rows, existing, keys, order)
    text = F.concat_ws("\u0001", *[F.col(k).cast("string") for k in keys])
    numbered = assign_keys(fresh.withColumn("_key", text), "_key", id_column, existing)
    return numbered.drop("_key")


def _id_of(df: DataFrame, lookup: DataFrame, key: str, lookup_key: str, id_column: str) -> DataFrame:
    """Left lookup of a surrogate key; NULL where the reference is unknown."""
    ref = lookup.select(F.col(lookup_key).alias("_lookup"), F.col(id_column))
    return df.join(ref, df[key] == ref["_lookup"], "left").drop("_lookup")


def build_suppliers(events: DataFrame, existing: DataFrame | None = None) -> Built:
    return _new(events, existing, "supplier_code", "supplier_id", ["event_timestamp"]), None


def build_customers(events: DataFrame, existing: DataFrame | None = None) -> Built:
    return _new(events, existing, "customer_number", "customer_id", ["event_timestamp"]), None


def build_products(events: DataFrame, suppliers: DataFrame, existing: DataFrame | None = None) -> Built:
    """An unknown supplier leaves ``supplier_id`` NULL, the product is kept."""
    rows = events.withColumn("product_code", normalize_key("product_code"))
    first = insert_ignore(rows, existing, ["product_code"], ["event_timestamp"])
    linked = _id_of(first, suppliers, "supplier_reference", "supplier_code", "supplier_id")
    columns = ["product_code", "product_name", "category", "supplier_id", "event_timestamp"]
    return assign_keys(linked.select(*columns), "product_code", "product_id", existing), None


def build_warehouse_skus(events: DataFrame, existing: DataFrame | None = None) -> Built:
    """The SKU keeps its spelling, the product code becomes canonical."""
    rows = events.select(normalize_key("erp_product_code").alias("erp_product_code"), "sku", "event_timestamp")
    return _new(rows, existing, "sku", "sku_id", ["event_timestamp"]), None


def build_carriers(events: DataFrame, existing: DataFrame | None = None) -> Built:
    return _new(events, existing, "carrier_code", "carrier_id", ["event_timestamp"]), None


def build_transport_references(events: DataFrame, existing: DataFrame | None = None) -> Built:
    rows = events.select(
        normalize_key("erp_product_code").alias("erp_product_code"), "transport_product_reference", "event_timestamp"
    )
    return _new(rows, existing, "transport_product_reference", "ref_id", ["event_timestamp"]), None


def build_orders(events: DataFrame, customers: DataFrame, existing: DataFrame | None = None) -> Built:
    """Orders of unknown customers are rejected."""
    rows = events.select(
        "order_reference",
        F.col("customer.customer_number").alias("customer_number"),
        "delivery_priority",
        F.col("event_timestamp").alias("order_timestamp"),
    )
    known, rejected = split_unresolved(rows, customers, {"customer_number": "customer_number"}, "order_without_customer")
    first = insert_ignore(known, existing, ["order_reference"], ["order_timestamp"])
    linked = _id_of(first, customers, "customer_number", "customer_number", "customer_id")
    columns = ["order_reference", "customer_id", "delivery_priority", "order_timestamp"]
    return assign_keys(linked.select(*columns), "order_reference", "order_id", existing), rejected


def order_lines(events: DataFrame) -> DataFrame:
    """The items of each order with their position; orders without items vanish."""
    return events.select("order_reference", "event_timestamp", F.posexplode("items").alias("position", "item")).select(
        "order_reference",
        "event_timestamp",
        "position",
        normalize_key("item.product_code").alias("product_code"),
        "item.description",
        "item.quantity",
        "item.unit_price",
    )


def build_order_items(
    events: DataFrame, orders: DataFrame, products: DataFrame, existing: DataFrame | None = None
) -> Built:
    """One line per order and product, the first by position.

    Only the event an order was created from brings lines, and lines of
    unknown products are rejected.
    """
    creating = insert_ignore(events, None, ["order_reference"], ["event_timestamp"])
    lines = order_lines(creating)
    known, rejected = split_unresolved(lines, products, {"product_code": "product_code"}, "line_without_product")
    linked = _id_of(known, products, "product_code", "product_code", "product_id")
    linked = linked.join(orders.select("order_reference", "order_id"), "order_reference")
    rows = linked.select("order_id", "product_id", "quantity", "unit_price", "position")
    first = insert_missing(rows, existing, ["order_id", "product_id"], "position").drop("position")
    key = F.concat_ws("\u0001", F.col("order_id").cast("string"), F.col("product_id").cast("string"))
    numbered = assign_keys(first.withColumn("_key", key), "_key", "item_id", existing)
    return numbered.drop("_key"), rejected


def build_batches(events: DataFrame, products: DataFrame, existing: DataFrame | None = None) -> Built:
    """Batches with warehouse and transport spellings derived from the product."""
    rows = events.select(
        "batch_identifier",
        normalize_key("product_code").alias("product_code"),
        "origin_country",
        "quantity",
        F.coalesce("supply_chain_node", F.lit(ORIGIN_NODE)).alias("supply_chain_node"),
        F.col("event_timestamp").alias("harvested_at"),
    )
    first = insert_ignore(rows, existing, ["batch_identifier"], ["harvested_at"])
    linked = _id_of(first, products, "product_code", "product_code", "product_id").select(
        "batch_identifier",
        "product_id",
        "origin_country",
        "quantity",
        "supply_chain_node",
        wms_key("product_code").alias("wms_sku"),
        tms_key("product_code").alias("tms_product_reference"),
        "harvested_at",
    )
    return assign_keys(linked, "batch_identifier", "batch_id", existing), None


def build_node_processings(events: DataFrame, nodes: DataFrame, existing: DataFrame | None = None) -> Built:
    """One processing per batch and station; unknown stations are rejected."""
    known, rejected = split_unresolved(events, nodes, {"supply_chain_node": "node_code"}, "processing_without_node")
    rows = _id_of(known, nodes, "supply_chain_node", "node_code", "node_id").select(
        "node_id", "batch_reference", "sku", "temperature", "status", F.col("event_timestamp").alias("processed_at")
    )
    return _composite(rows, existing, ["batch_reference", "node_id"], "processing_id", ["processed_at"]), rejected


def build_shipments(events: DataFrame, carriers: DataFrame, existing: DataFrame | None = None) -> Built:
    """An unknown carrier leaves ``carrier_id`` NULL."""
    rows = events.select(
        "shipment_identifier",
        "source_node",
        "target_node",
        "transport_mode",
        "cargo_product_reference",
        F.col("carrier.carrier_id").alias("carrier_code"),
        "estimated_arrival",
        F.col("event_timestamp").alias("started_at"),
    )
    first = insert_ignore(rows, existing, ["shipment_identifier"], ["started_at"])
    linked = _id_of(first, carriers, "carrier_code", "carrier_code", "carrier_id").drop("carrier_code")
    return assign_keys(linked, "shipment_identifier", "shipment_id", existing), None


def _of_shipment(events: DataFrame, shipments: DataFrame, reason: str) -> tuple[DataFrame, DataFrame]:
    known = events.join(shipments.select("shipment_identifier", "shipment_id"), "shipment_identifier")
    on = {"shipment_identifier": "shipment_identifier"}
    rejected = matched(events, shipments, on, keep=False).withColumn("reason", F.lit(reason))
    return known, rejected


def build_positions(events: DataFrame, shipments: DataFrame, existing: DataFrame | None = None) -> Built:
    """One position per shipment and time."""
    known, rejected = _of_shipment(events, shipments, "position_without_shipment")
    rows = known.select(
        "shipment_id",
        "latitude",
        "longitude",
        "container_temperature",
        "speed_kmh",
        F.col("event_timestamp").alias("recorded_at"),
    )
    return _composite(rows, existing, ["shipment_id", "recorded_at"], "position_id", []), rejected


def build_completions(events: DataFrame, shipments: DataFrame, existing: DataFrame | None = None) -> Built:
    """One completion per shipment, the first."""
    known, rejected = _of_shipment(events, shipments, "completion_without_shipment")
    rows = known.select("shipment_id", "arrival_node", "delay_minutes", F.col("event_timestamp").alias("completed_at"))
    return _new(rows, existing, "shipment_id", "completion_id", ["completed_at"]), rejected


def build_deliveries(events: DataFrame, shipments: DataFrame, existing: DataFrame | None = None) -> Built:
    """One delivery per shipment, the first."""
    known, rejected = _of_shipment(events, shipments, "delivery_without_shipment")
    rows = known.select(
        "shipment_id",
        "supply_chain_node",
        "delivery_status",
        "received_by",
        "cargo_product_reference",
        F.col("event_timestamp").alias("delivered_at"),
    )
    return _new(rows, existing, "shipment_id", "delivery_id", ["delivered_at"]), rejected


def line_value(items: DataFrame) -> Column:
    """Value of an order line."""
    return safe_decimal(items["quantity"] * items["unit_price"], 18, 2)
