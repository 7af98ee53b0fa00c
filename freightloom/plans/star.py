"""Star schema: seven dimensions and the fulfilment fact."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from freightloom.constants import HOPS_PER_FULFILLMENT
from freightloom.functions.dates import date_key
from freightloom.functions.numbers import mean
from freightloom.operators.writes import assign_keys, insert_ignore


def _dimension(rows: DataFrame, key: str, sk: str, existing: DataFrame | None) -> DataFrame:
    return assign_keys(insert_ignore(rows, existing, [key]), key, sk, existing)


def dim_customer(customers: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    rows = customers.select(
        "customer_number", "customer_name", "city", "country", F.col("event_timestamp").alias("source_created_at")
    )
    return _dimension(rows, "customer_number", "customer_sk", existing)


def dim_supplier(suppliers: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    rows = suppliers.select(
        "supplier_code", "supplier_name", "country", F.col("event_timestamp").alias("source_created_at")
    )
    return _dimension(rows, "supplier_code", "supplier_sk", existing)


def dim_product(products: DataFrame, suppliers: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """Products with their supplier folded in, NULL where there is none."""
    folded = suppliers.select(
        "supplier_id", "supplier_code", "supplier_name", F.col("country").alias("supplier_country")
    )
    rows = products.join(folded, "supplier_id", "left").select(
        "product_code", "product_name", "category", "supplier_code", "supplier_name", "supplier_country"
    )
    return _dimension(rows, "product_code", "product_sk", existing)


def dim_carrier(carriers: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    rows = carriers.select("carrier_code", "carrier_name", F.col("event_timestamp").alias("source_created_at"))
    return _dimension(rows, "carrier_code", "carrier_sk", existing)


def dim_supply_chain_node(nodes: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    rows = nodes.select("node_code", "node_name", "node_type", "region", "sequence_order")
    return _dimension(rows, "node_code", "node_sk", existing)


@dataclass(frozen=True)
class Dimensions:
    """The dimensions the fact refers to by surrogate key."""

    customer: DataFrame
    product: DataFrame
    supplier: DataFrame
    carrier: DataFrame
    node: DataFrame
    status: DataFrame


def first_order_per_product(
    order_items: DataFrame, orders: DataFrame, customers: DataFrame, products: DataFrame, suppliers: DataFrame
) -> DataFrame:
    """The earliest order line of each product that has a supplier.

    The minimum over a struct is taken before the shuffle too, so a product
    with a third of all lines does not gather in one task. The customer is
    looked up for the rows that are left; orders without one are rejected when
    they are loaded.
    """
    lines = order_items.join(orders, "order_id")
    first = lines.groupBy("product_id").agg(
        F.min(
            F.struct(
                "order_timestamp", "item_id", "order_reference", "delivery_priority", "customer_id", "quantity", "unit_price",
            )
        ).alias("o")
    )
    supplied = products.join(suppliers.select("supplier_id", "supplier_code"), "supplier_id").select(
        "product_id", "product_code", "supplier_code"
    )
    named = first.join(supplied, "product_id").withColumn("customer_id", F.col("o.customer_id"))
    return named.join(customers.select("customer_id", "customer_number"), "customer_id").select(
        "product_code",
        "supplier_code",
        "customer_number",
        "o.order_reference",
        "o.delivery_priority",
        date_key("o.order_timestamp").alias("order_date_sk"),
        "o.quantity",
        "o.unit_price",
        (F.col("o.quantity") * F.col("o.unit_price")).cast("decimal(12,2)").alias("total_value"),
    )


def product_temperature(batches: DataFrame, products: DataFrame, processings: DataFrame) -> DataFrame:
    """Average temperature per product with a batch, over all its processings."""
    per_batch = processings.groupBy(F.col("batch_reference").alias("batch_identifier")).agg(
        F.sum(F.col("temperature").cast("decimal(18,2)")).alias("t_sum"), F.count("temperature").alias("t_count")
    )
    per_product = (
        batches.select("batch_identifier", "product_id")
        .join(per_batch, "batch_identifier", "left")
        .groupBy("product_id")
        .agg(F.sum("t_sum").alias("t_sum"), F.sum("t_count").alias("t_count"))
    )
    return per_product.join(products.select("product_id", "product_code"), "product_id").select(
        "product_code", mean(F.col("t_sum"), F.col("t_count"), 2).cast("decimal(5,2)").alias("avg_temperature")
    )


def first_batch_per_product(batches: DataFrame, products: DataFrame) -> DataFrame:
    """The earliest batch of each product."""
    first = batches.groupBy("product_id").agg(F.min(F.struct("harvested_at", "batch_id", "batch_identifier")).alias("b"))
    return first.join(products.select("product_id", "product_code"), "product_id").select(
        "product_code", "b.batch_identifier"
    )


def delivered_shipments(
    shipments: DataFrame, deliveries: DataFrame, carriers: DataFrame, completions: DataFrame
) -> DataFrame:
    """Final deliveries with product, carrier, day and delay."""
    return (
        shipments.join(deliveries.select("shipment_id", "delivery_status", "delivered_at"), "shipment_id")
        .join(completions.select("shipment_id", "delay_minutes"), "shipment_id", "left")
        .join(carriers.select("carrier_id", "carrier_code"), "carrier_id", "left")
        .select(
            "shipment_identifier",
            "target_node",
            F.upper("cargo_product_reference").alias("product_code"),
            "carrier_code",
            "delivery_status",
            date_key("delivered_at").alias("delivery_date_sk"),
            F.coalesce("delay_minutes", F.lit(0)).alias("delay_minutes"),
        )
    )


def fact_fulfillment(
    orders: DataFrame,
    order_items: DataFrame,
    customers: DataFrame,
    products: DataFrame,
    suppliers: DataFrame,
    shipments: DataFrame,
    deliveries: DataFrame,
    completions: DataFrame,
    carriers: DataFrame,
    batches: DataFrame,
    processings: DataFrame,
    dims: Dimensions,
) -> DataFrame:
    """One row per final delivery, valued with the first order of its product.

    All product-level inputs are merged into one row per product with its
    surrogate keys first; the deliveries then meet them in a single join.
    """
    profile = (
        first_order_per_product(order_items, orders, customers, products, suppliers)
        .join(product_temperature(batches, products, processings), "product_code")
        .join(first_batch_per_product(batches, products), "product_code", "left")
        .join(dims.customer.select("customer_number", "customer_sk"), "customer_number")
        .join(dims.product.select("product_code", "product_sk"), "product_code")
        .join(dims.supplier.select("supplier_code", "supplier_sk"), "supplier_code")
    )
    delivered = (
        delivered_shipments(shipments, deliveries, carriers, completions)
        .join(dims.carrier.select("carrier_code", "carrier_sk"), "carrier_code", "left")
        .join(
            dims.node.select(F.col("node_code").alias("target_node"), F.col("node_sk").alias("destination_node_sk")),
            "target_node",
            "left",
        )
        .join(
            dims.status.select(
                F.col("status_code").alias("delivery_status"), F.col("status_sk").alias("delivery_status_sk")
            ),
            "delivery_status",
        )
    )
    on_time = (F.col("delivery_status") == "SUCCESSFUL") & (F.col("delay_minutes") == 0)
    return delivered.join(profile, "product_code").select(
        "customer_sk",
        "product_sk",
        "supplier_sk",
        "carrier_sk",
        "destination_node_sk",
        "order_date_sk",
        "delivery_date_sk",
        "delivery_status_sk",
        "order_reference",
        "batch_identifier",
        "shipment_identifier",
        "quantity",
        "unit_price",
        "total_value",
        "delay_minutes",
        "avg_temperature",
        F.lit(HOPS_PER_FULFILLMENT).alias("num_supply_chain_hops"),
        F.col("delivery_priority").alias("delivery_priority_code"),
        on_time.alias("on_time_flag"),
    )
