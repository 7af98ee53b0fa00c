"""Loads: events into operational tables, master data and the star schema.

A load runs table by table in the order of the references. Every table is
written before the next one looks keys up in it, so lineage stays short and
a lost executor repeats one table at most. Running a load again adds
nothing.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from freightloom.operators import lifecycle, manifest, mdm, quality
from freightloom.operators import operational as ops
from freightloom.operators.writes import append, load_statistics
from freightloom.plans import star
from freightloom.sources import relations as R
from freightloom.sources.events import CORRUPT, corrupt_events, route


class TableStore:
    """Parquet tables under one folder all executors reach.

    Appended tables live in ``<name>/``. Replaced tables are written beside
    their predecessor as ``<name>/v=<n>`` and read in their newest complete
    version.
    """

    def __init__(self, spark: SparkSession, base: str):
        self.spark = spark
        self.base = base.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.base}/{name}"

    def read(self, name: str) -> DataFrame | None:
        """The table, or None if nothing was written yet."""
        version = self._newest(name)
        if version is not None:
            return self.spark.read.parquet(f"{self.path(name)}/v={version}")
        return self.spark.read.parquet(self.path(name)) if self._appended(name) else None

    def table(self, name: str) -> DataFrame:
        """The table; an error if it is missing."""
        df = self.read(name)
        if df is None:
            raise LookupError(f"table {name!r} was not loaded")
        return df

    def append(self, name: str, rows: DataFrame, partition_by: list[str] = ()) -> None:
        append(rows, self.path(name), partition_by)

    def replace(self, name: str, rows: DataFrame, partition_by: list[str] = ()) -> None:
        version = (self._newest(name) or 0) + 1
        rows.write.mode("overwrite").partitionBy(*partition_by).parquet(f"{self.path(name)}/v={version}")

    def _listed(self, name: str) -> list:
        """Paths in the folder of a table, and the file system; nothing if there is no folder."""
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(self.path(name))
        fs = folder.getFileSystem(self.spark._jsc.hadoopConfiguration())
        return [(s.getPath(), fs) for s in fs.listStatus(folder)] if fs.exists(folder) else []

    def _newest(self, name: str) -> int | None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path
        versions = [
            int(p.getName()[2:])
            for p, fs in self._listed(name)
            if p.getName().startswith("v=") and fs.exists(path(p, "_SUCCESS"))
        ]
        return max(versions, default=None)

    def _appended(self, name: str) -> bool:
        """Whether an append was ever finished: there is a file or partition besides markers and versions."""
        names = [p.getName() for p, _ in self._listed(name)]
        return any(not n.startswith(("_", ".", "v=")) for n in names)


def stage_events(store: TableStore, events: DataFrame) -> None:
    """Write parsed events by type, so that each loader reads its own type only.

    Unreadable inputs go to the quarantine table with their file. Each file is
    staged once: what is in either table already is left out, so staging the
    same folder again adds nothing.
    """

    def fresh(rows: DataFrame, name: str) -> DataFrame:
        staged = store.read(name)
        return rows if staged is None else rows.join(staged.select("source_file").distinct(), "source_file", "left_anti")

    if CORRUPT in events.columns:
        store.append("quarantine", fresh(corrupt_events(events), "quarantine"))
        events = events.filter(F.col(CORRUPT).isNull()).drop(CORRUPT)
    store.append("events", fresh(events, "events"), ["event_type"])


def _events(store: TableStore, event_type: str) -> DataFrame:
    return route(store.table("events"), event_type)


#: What an event must name to be loaded.
KEYS = {
    "SupplierCreated": "supplier_code",
    "CustomerCreated": "customer_number",
    "ProductCreated": "product_code",
    "WarehouseSKUCreated": "sku",
    "CarrierCreated": "carrier_code",
    "TransportProductReferenceCreated": "transport_product_reference",
    "OrderCreated": "order_reference",
    "BatchHarvested": "batch_identifier",
    "NodeProcessed": "batch_reference",
    "TransportStarted": "shipment_identifier",
    "ShipmentPositionUpdated": "shipment_identifier",
    "TransportCompleted": "shipment_identifier",
    "DeliveryCompleted": "shipment_identifier",
}


#: Tables whose allowed values are checked on the events, which have the same columns.
CONSTRAINED = {
    "OrderCreated": "orders",
    "BatchHarvested": "batches",
    "NodeProcessed": "node_processings",
    "TransportStarted": "shipments",
    "ShipmentPositionUpdated": "shipment_positions",
    "TransportCompleted": "transport_completions",
    "DeliveryCompleted": "deliveries",
}


def load_operational(store: TableStore) -> None:
    """Load the operational tables from the staged events."""
    nodes = R.supply_chain_nodes(store.spark)
    if store.read("supply_chain_nodes") is None:
        store.append("supply_chain_nodes", nodes)

    rejected_events: list[DataFrame] = []

    def load(name: str, built: ops.Built) -> None:
        rows, rejects = built
        store.append(name, rows)
        if rejects is not None:
            rejected_events.append(rejects.select(F.lit(name).alias("table_name"), "reason", "event_timestamp"))

    def of(event_type: str) -> DataFrame:
        """Events of one type that name their key and satisfy the constraints of their table; the others are rejected.

        They are rejected before the first event of a key is chosen, so a
        later valid event of the same key is loaded.
        """
        events, key = _events(store, event_type), KEYS[event_type]
        reason = F.when(F.col(key).isNull(), F.lit(f"missing_{key}"))
        if event_type in CONSTRAINED:
            for column, broken in quality.constraint_rules()[CONSTRAINED[event_type]].items():
                reason = reason.when(broken, F.lit(f"invalid_{column}"))
        tagged = events.withColumn("reason", reason)
        rejected_events.append(
            tagged.filter("reason IS NOT NULL").select(F.lit(event_type).alias("table_name"), "reason", "event_timestamp")
        )
        return tagged.filter("reason IS NULL").drop("reason")

    load("suppliers", ops.build_suppliers(of("SupplierCreated"), store.read("suppliers")))
    load("customers", ops.build_customers(of("CustomerCreated"), store.read("customers")))
    load("products", ops.build_products(of("ProductCreated"), store.table("suppliers"), store.read("products")))
    load("warehouse_skus", ops.build_warehouse_skus(of("WarehouseSKUCreated"), store.read("warehouse_skus")))
    load("carriers", ops.build_carriers(of("CarrierCreated"), store.read("carriers")))
    load(
        "transport_product_references",
        ops.build_transport_references(of("TransportProductReferenceCreated"), store.read("transport_product_references")),
    )
    order_events = of("OrderCreated")
    orders, rejected = ops.build_orders(order_events, store.table("customers"), store.read("orders"))
    load("orders", (orders, rejected.withColumnRenamed("order_timestamp", "event_timestamp")))
    items, rejected = ops.build_order_items(order_events, store.table("orders"), store.table("products"), store.read("order_items"))
    items, broken = quality.enforce("order_items", items)
    load("order_items", (items, rejected))
    rejected_events.append(
        broken.select(
            F.lit("order_items").alias("table_name"), F.concat(F.lit("invalid_"), "reason").alias("reason"),
            F.lit(None).cast("timestamp_ntz").alias("event_timestamp"),
        )
    )
    load("batches", ops.build_batches(of("BatchHarvested"), store.table("products"), store.read("batches")))
    load("node_processings", ops.build_node_processings(of("NodeProcessed"), nodes, store.read("node_processings")))
    load("shipments", ops.build_shipments(of("TransportStarted"), store.table("carriers"), store.read("shipments")))
    ships = store.table("shipments")
    load("shipment_positions", ops.build_positions(of("ShipmentPositionUpdated"), ships, store.read("shipment_positions")))
    load(
        "transport_completions", ops.build_completions(of("TransportCompleted"), ships, store.read("transport_completions"))
    )
    load("deliveries", ops.build_deliveries(of("DeliveryCompleted"), ships, store.read("deliveries")))
    # the staged events are read whole each time, so the rejects are too
    store.replace("rejects", reduce(DataFrame.unionByName, rejected_events))


def load_master_data(store: TableStore) -> None:
    """Load golden records and source mappings from the operational tables."""
    names = ("products", "customers", "suppliers", "carriers", "supply_chain_nodes")
    golden = mdm.golden_records(*[store.table(n) for n in names], existing=store.read("golden_records"))
    store.append("golden_records", golden)
    store.append("source_mappings", mdm.source_mappings(store.table("golden_records"), store.read("source_mappings")))


def load_star(store: TableStore) -> None:
    """Extend the dimensions, refresh the fact, one folder per order month."""
    t = store.table
    store.append("dim_customer", star.dim_customer(t("customers"), store.read("dim_customer")))
    store.append("dim_supplier", star.dim_supplier(t("suppliers"), store.read("dim_supplier")))
    store.append("dim_product", star.dim_product(t("products"), t("suppliers"), store.read("dim_product")))
    store.append("dim_carrier", star.dim_carrier(t("carriers"), store.read("dim_carrier")))
    store.append(
        "dim_supply_chain_node", star.dim_supply_chain_node(t("supply_chain_nodes"), store.read("dim_supply_chain_node"))
    )
    moments = t("orders").select(F.col("order_timestamp").alias("at")).unionByName(t("deliveries").select(F.col("delivered_at").alias("at")))
    store.replace("dim_date", R.calendar_of(moments, "at"))
    store.replace("dim_delivery_status", R.delivery_statuses(store.spark))
    dims = star.Dimensions(
        t("dim_customer"), t("dim_product"), t("dim_supplier"), t("dim_carrier"), t("dim_supply_chain_node"),
        t("dim_delivery_status"),
    )
    fact = star.fact_fulfillment(
        t("orders"), t("order_items"), t("customers"), t("products"), t("suppliers"), t("shipments"), t("deliveries"),
        t("transport_completions"), t("carriers"), t("batches"), t("node_processings"), dims,
    )
    month = (F.col("order_date_sk") / 100).cast("int")
    store.replace("fact_fulfillment", fact.withColumn("order_month", month), ["order_month"])


def load_documents(store: TableStore) -> None:
    """Refresh the lifecycle documents and the document manifest."""

    def of(event_type: str) -> DataFrame:
        return _events(store, event_type)

    started, delivered, processed = of("TransportStarted"), of("DeliveryCompleted"), of("NodeProcessed")
    shipment = (started, of("ShipmentPositionUpdated"), of("TransportCompleted"), delivered)
    store.replace("shipment_documents", lifecycle.shipment_lifecycle(*shipment))
    store.replace("shipment_events", lifecycle.shipment_events(*shipment))
    store.append("node_documents", lifecycle.node_documents(processed, store.read("node_documents")))
    store.append("order_documents", lifecycle.order_documents(of("OrderCreated"), store.read("order_documents")))
    store.replace(
        "batch_documents", lifecycle.batch_documents(of("BatchHarvested"), processed, store.table("supply_chain_nodes"))
    )
    store.replace("batch_stations", lifecycle.batch_stations(processed))
    store.replace("document_references", manifest.manifest(started, delivered, processed, store.read("document_references")))


def statistics(store: TableStore, names: list[str]) -> DataFrame:
    """Rows of the loaded tables."""
    return load_statistics({n: store.table(n) for n in names})


