"""Reports over the operational tables.

Sorting is left to whoever shows a report: pass the result through
``orderBy`` with the columns named in ``SORT_ORDER``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from freightloom.constants import LATE_MINUTES
from freightloom.functions.numbers import breaks_cold_chain, count_where, exact, half_up, mean
from freightloom.operators.writes import load_statistics

#: Presentation order of each report: column, descending.
SORT_ORDER = {
    "table_counts": [("table_name", False)],
    "suppliers_by_country": [("country", False), ("supplier_code", False)],
    "customers_by_country": [("country", False), ("customer_name", False)],
    "products_with_supplier": [("product_code", False)],
    "orders_with_customer": [("order_timestamp", True)],
    "order_line_values": [("order_timestamp", True), ("product_code", False)],
    "customer_volume": [("total_value_eur", True)],
    "batches_with_product": [("harvested_at", True)],
    "skus": [("sku", False)],
    "nodes_in_sequence": [("sequence_order", False)],
    "processings_per_node": [("sequence_order", False)],
    "processings_with_node": [("processed_at", True)],
    "carriers": [("carrier_code", False)],
    "transport_references": [("erp_product_code", False)],
    "shipments_with_carrier": [("started_at", True)],
    "carrier_delay": [("avg_delay_minutes", True)],
    "delivery_status_counts": [("deliveries", True)],
    "positions_with_shipment": [("recorded_at", True)],
    "product_keys": [("erp_product_code", False)],
    "batch_tracking": [("batch_identifier", False), ("sequence_order", False)],
}


def in_order(report: DataFrame, name: str) -> DataFrame:
    """A report in its presentation order."""
    return report.orderBy(*[F.col(c).desc() if down else F.col(c).asc() for c, down in SORT_ORDER[name]])


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows of each table."""
    return load_statistics(tables)


def suppliers_by_country(suppliers: DataFrame) -> DataFrame:
    return suppliers.select("supplier_code", "supplier_name", "country")


def customers_by_country(customers: DataFrame) -> DataFrame:
    return customers.select("customer_number", "customer_name", "city", "country")


def products_with_supplier(products: DataFrame, suppliers: DataFrame) -> DataFrame:
    """Products that have a supplier, with its name and country."""
    names = suppliers.select("supplier_id", "supplier_name", F.col("country").alias("origin"))
    return products.join(names, "supplier_id").select(
        "product_code", "product_name", "category", "supplier_name", "origin"
    )


def orders_with_customer(orders: DataFrame, customers: DataFrame) -> DataFrame:
    return orders.join(customers.select("customer_id", "customer_name"), "customer_id").select(
        "order_reference", "customer_name", "delivery_priority", "order_timestamp"
    )


def order_line_values(order_items: DataFrame, orders: DataFrame, products: DataFrame) -> DataFrame:
    """Order lines with product and line value."""
    return (
        order_items.join(orders.select("order_id", "order_reference", "order_timestamp"), "order_id")
        .join(products.select("product_id", "product_code", "product_name"), "product_id")
        .select(
            "order_reference",
            "product_code",
            "product_name",
            "quantity",
            "unit_price",
            half_up(F.col("quantity") * F.col("unit_price"), 2).alias("line_value_eur"),
            "order_timestamp",
        )
    )


def customer_volume(customers: DataFrame, orders: DataFrame, order_items: DataFrame) -> DataFrame:
    """Orders, quantity and value per customer name.

    Lines are summed per order first, which leaves one row per order; the
    orders of a customer then need no distinct count.
    """
    per_order = order_items.groupBy("order_id").agg(
        F.sum("quantity").alias("q"), F.sum(exact(F.col("quantity") * F.col("unit_price"))).alias("v")
    )
    per_customer = (
        per_order.join(orders.select("order_id", "customer_id"), "order_id")
        .groupBy("customer_id")
        .agg(F.count("*").alias("n"), F.sum("q").alias("q"), F.sum("v").alias("v"))
    )
    return (
        per_customer.join(customers.select("customer_id", "customer_name"), "customer_id")
        .groupBy("customer_name")
        .agg(
            F.sum("n").alias("orders"),
            F.sum("q").alias("total_quantity"),
            half_up(F.sum("v"), 2, 28).alias("total_value_eur"),
        )
    )


def batches_with_product(batches: DataFrame, products: DataFrame) -> DataFrame:
    return batches.join(products.select("product_id", "product_code", "product_name"), "product_id").select(
        "batch_identifier", "product_code", "product_name", "origin_country", "quantity", "wms_sku",
        "tms_product_reference", "harvested_at",
    )


def skus(warehouse_skus: DataFrame) -> DataFrame:
    return warehouse_skus.select("sku", "erp_product_code", "event_timestamp")


def nodes_in_sequence(nodes: DataFrame) -> DataFrame:
    return nodes.select("node_code", "node_name", "node_type", "region", "sequence_order")


def processings_per_node(nodes: DataFrame, processings: DataFrame) -> DataFrame:
    """Processings per station, stations without any included."""
    counts = processings.groupBy("node_id").agg(F.count("*").alias("processings"))
    return nodes.join(counts, "node_id", "left").select(
        "node_name", "sequence_order", F.coalesce("processings", F.lit(0)).alias("processings")
    )


def processings_with_node(processings: DataFrame, nodes: DataFrame) -> DataFrame:
    return processings.join(nodes.select("node_id", "node_name"), "node_id").select(
        "batch_reference", "sku", "node_name", "status", "temperature", "processed_at"
    )


def warehouse_breaches(processings: DataFrame, nodes: DataFrame) -> DataFrame:
    """Processings outside the temperature corridor."""
    bad = processings.filter(breaks_cold_chain("temperature"))
    return bad.join(nodes.select("node_id", "node_name"), "node_id").select(
        "batch_reference", "sku", "node_name", "temperature", "processed_at"
    )


def carrier_list(carriers: DataFrame) -> DataFrame:
    return carriers.select("carrier_code", "carrier_name", "event_timestamp")


def transport_references(references: DataFrame) -> DataFrame:
    return references.select("erp_product_code", "transport_product_reference")


def shipments_with_carrier(shipments: DataFrame, carriers: DataFrame) -> DataFrame:
    return shipments.join(carriers.select("carrier_id", "carrier_name"), "carrier_id").select(
        "shipment_identifier", "source_node", "target_node", "transport_mode", "cargo_product_reference",
        "carrier_name", "started_at", "estimated_arrival",
    )


def _delay_per_carrier(completions: DataFrame, shipments: DataFrame, carriers: DataFrame) -> DataFrame:
    per_carrier = (
        completions.select("shipment_id", "delay_minutes")
        .join(shipments.filter(F.col("carrier_id").isNotNull()).select("shipment_id", "carrier_id"), "shipment_id")
        .groupBy("carrier_id")
        .agg(
            F.count("*").alias("n"),
            F.sum("delay_minutes").alias("s"),
            F.count("delay_minutes").alias("c"),
            F.max("delay_minutes").alias("m"),
            count_where(F.col("delay_minutes") > LATE_MINUTES).alias("late"),
        )
    )
    return (
        per_carrier.join(carriers.select("carrier_id", "carrier_name"), "carrier_id")
        .groupBy("carrier_name")
        .agg(*[F.sum(x).alias(x) for x in ("n", "s", "c", "late")], F.max("m").alias("m"))
    )


def carrier_delay(completions: DataFrame, shipments: DataFrame, carriers: DataFrame) -> DataFrame:
    """Completed transports with average and largest delay per carrier."""
    return _delay_per_carrier(completions, shipments, carriers).select(
        "carrier_name",
        F.col("n").alias("completed_transports"),
        mean(F.col("s"), F.col("c"), 2).alias("avg_delay_minutes"),
        F.col("m").alias("max_delay_minutes"),
    )


def carrier_lateness(completions: DataFrame, shipments: DataFrame, carriers: DataFrame) -> DataFrame:
    """The same with the number of transports more than an hour late."""
    return _delay_per_carrier(completions, shipments, carriers).select(
        "carrier_name",
        F.col("n").alias("transports"),
        mean(F.col("s"), F.col("c"), 1).alias("avg_delay"),
        F.col("m").alias("max_delay"),
        F.col("late").alias("much_delayed"),
    )


def worst_carrier(completions: DataFrame, shipments: DataFrame, carriers: DataFrame) -> DataFrame:
    """The carrier with the largest average delay; the name breaks ties."""
    return carrier_lateness(completions, shipments, carriers).orderBy(F.col("avg_delay").desc(), "carrier_name").limit(1)


def delivery_status_counts(deliveries: DataFrame) -> DataFrame:
    return deliveries.groupBy("delivery_status").agg(F.count("*").alias("deliveries"))


def delivery_status_shares(deliveries: DataFrame) -> DataFrame:
    """Deliveries by status with their share of all deliveries in percent."""
    counts = delivery_status_counts(deliveries)
    total = deliveries.agg(F.count("*").alias("total"))
    share = half_up(
        F.try_divide((F.col("deliveries") * 100).cast("decimal(28,6)"), F.col("total").cast("decimal(20,0)")), 0, 3
    )
    return counts.crossJoin(total).select("delivery_status", "deliveries", share.cast("int").alias("share_pct"))


def positions_with_shipment(positions: DataFrame, shipments: DataFrame) -> DataFrame:
    return positions.join(shipments.select("shipment_id", "shipment_identifier"), "shipment_id").select(
        "shipment_identifier", "latitude", "longitude", "container_temperature", "speed_kmh", "recorded_at"
    )


def transit_breaches(positions: DataFrame, shipments: DataFrame) -> DataFrame:
    """Positions outside the temperature corridor."""
    bad = positions.filter(breaks_cold_chain("container_temperature"))
    return bad.join(shipments.select("shipment_id", "shipment_identifier"), "shipment_id").select(
        "shipment_identifier", "container_temperature", "latitude", "longitude", "recorded_at"
    )


def product_keys(products: DataFrame, warehouse_skus: DataFrame, references: DataFrame) -> DataFrame:
    """The three system keys of each product side by side."""
    wms = warehouse_skus.select(F.col("erp_product_code").alias("product_code"), F.col("sku").alias("wms_sku"))
    tms = references.select(
        F.col("erp_product_code").alias("product_code"),
        F.col("transport_product_reference").alias("tms_product_reference"),
    )
    return (
        products.select("product_code", "product_name")
        .join(wms, "product_code", "left")
        .join(tms, "product_code", "left")
        .withColumnRenamed("product_code", "erp_product_code")
    )


def batch_tracking(
    batches: DataFrame,
    products: DataFrame,
    processings: DataFrame,
    nodes: DataFrame,
    batch_identifier: str | None = None,
) -> DataFrame:
    """Batches with every station they passed; one batch when named."""
    chosen = batches
    if batch_identifier is not None:
        chosen = batches.filter(F.col("batch_identifier") == batch_identifier)
        processings = processings.filter(F.col("batch_reference") == batch_identifier)
    stations = nodes.select("node_id", "node_name", "sequence_order")
    passed = processings.join(stations, "node_id", "left").select(
        F.col("batch_reference").alias("batch_identifier"), "node_name", "sequence_order", "status", "temperature",
        "processed_at",
    )
    return (
        chosen.select("batch_identifier", "product_id")
        .join(products.select("product_id", "product_code", "product_name"), "product_id")
        .join(passed, "batch_identifier", "left")
        .drop("product_id")
    )


def shipments_per_route(shipments: DataFrame) -> DataFrame:
    return shipments.groupBy("source_node", "target_node", "transport_mode").agg(F.count("*").alias("shipments"))


def completion_counts(completions: DataFrame) -> DataFrame:
    """Completed shipments and completions; the shipments are counted in two steps."""
    per_shipment = completions.groupBy("shipment_id").agg(F.count("*").alias("n"))
    return per_shipment.agg(
        F.count("*").alias("completed_shipments"), F.coalesce(F.sum("n"), F.lit(0)).alias("total_completions")
    )


def temperature_per_node(processings: DataFrame, nodes: DataFrame) -> DataFrame:
    """Average, range and breaches per station with processings."""
    per_node = processings.groupBy("node_id").agg(
        F.count("*").alias("processings"),
        F.sum(exact("temperature")).alias("s"),
        F.count("temperature").alias("c"),
        F.min("temperature").alias("min_temp"),
        F.max("temperature").alias("max_temp"),
        count_where(breaks_cold_chain("temperature")).alias("breaches"),
    )
    return per_node.join(nodes.select("node_id", "node_name"), "node_id").select(
        "node_name", "processings", mean(F.col("s"), F.col("c"), 2).alias("avg_temp"), "min_temp", "max_temp", "breaches"
    )


def temperature_quartiles(processings: DataFrame, nodes: DataFrame) -> DataFrame:
    """Quartiles of the temperature per station, exact and interpolated."""
    values = processings.filter(F.col("temperature").isNotNull())
    per_node = values.groupBy("node_id").agg(
        F.percentile(F.col("temperature").cast("double"), F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))).alias("q")
    )
    return per_node.join(nodes.select("node_id", "node_name"), "node_id").select(
        "node_name",
        *[F.round(F.col("q")[i], 6).alias(name) for i, name in enumerate(("q1", "median", "q3"))],
    )


def fulfilment_orders(orders: DataFrame, customers: DataFrame, warehouses: DataFrame) -> DataFrame:
    """Orders with customer and warehouse."""
    who = customers.select("customer_id", "customer_name", "city", "country")
    where = warehouses.select("warehouse_id", F.col("name").alias("warehouse"), F.col("city").alias("warehouse_city"))
    return orders.join(who, "customer_id").join(where, "warehouse_id").select(
        "order_id", "customer_name", "city", "country", "warehouse", "warehouse_city"
    )


def fulfilment_lines(order_items: DataFrame, products: DataFrame) -> DataFrame:
    """Order lines with product name and price."""
    return order_items.join(products.select("product_id", "product_name"), "product_id").select(
        "order_id", "product_name", F.col("unit_price").alias("price"), "quantity", "product_id"
    )
