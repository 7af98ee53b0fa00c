"""Views that give the check tables the shape of the operational tables.

The operators know nothing of this module. ``Driver`` builds the relations
with Spark, ``VIEWS`` states the same derivations as SQL.
"""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from freightloom import constants as C
from freightloom.operators import mdm
from freightloom.operators.quality import Period
from freightloom.session import configure, shared_dir
from freightloom.sources import relations as R
from freightloom.sources.constant import constant
from freightloom.sources.events import EVENT_SCHEMA

AS_OF = datetime(2001, 12, 31)
PERIOD = Period(datetime(1996, 1, 1), AS_OF)
LIVE_AS_OF = datetime(2024, 1, 31)

CARRIER_NAMES = ["DHL", "Maersk", "MSC", "DB Schenker", "Hapag Lloyd"]
CARRIERS = [(101 + i, f"CAR-{101 + i}", name) for i, name in enumerate(CARRIER_NAMES)]

_L1_ORDER = [
    "l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_discount", "l_tax", "l_returnflag",
    "l_linestatus",
]

_NODE = "element_at(array(" + ", ".join(f"'{n[0]}'" for n in C.NODES) + "), {})"
_HOURS = "element_at(array(" + ", ".join(str(h[3]) for h in C.TOPOLOGY) + "), {})"


def _node(expr: str) -> str:
    return _NODE.format(expr)


class Driver:
    """Operational relations over one folder of check tables."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = configure(spark)
        self.folder = folder.rstrip("/")
        self._built: dict[str, DataFrame] = {}
        self._staged: list[str] = []

    def base(self, name: str) -> DataFrame:
        key = f"base {name}"
        if key not in self._built:
            self._built[key] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return self._built[key]

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            self._built[name] = getattr(self, f"_{name}")()
        return self._built[name]

    def stage(self, name: str, build) -> DataFrame:
        """A parent table written to the shared folder and read back, as a load does."""
        key = f"staged {name}"
        if key not in self._built:
            path = f"{shared_dir(self.spark)}/{name}-{uuid.uuid4().hex}"
            df = build()
            df.write.parquet(path)
            self._staged.append(path)
            self._built[key] = self.spark.read.schema(df.schema).parquet(path)
        return self._built[key]

    def unstage(self) -> None:
        """Deletes the staged tables, once nothing reads them any more; what was built from them is built anew if asked for."""
        self._built.clear()
        while self._staged:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(self._staged.pop())
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

    @property
    def tables(self) -> "Driver":
        """The relations by name, each built when first asked for."""
        return self

    # --- master data ---------------------------------------------------------

    def _places(self) -> DataFrame:
        region = self.base("region")
        nation = self.base("nation")
        return nation.join(region, nation["n_regionkey"] == region["r_regionkey"]).select(
            "n_nationkey", F.col("n_name").alias("country"), F.col("r_name").alias("city")
        )

    def _customers(self) -> DataFrame:
        c = self.base("customer").join(self["places"], F.col("c_nationkey") == F.col("n_nationkey"))
        return c.selectExpr(
            "c_custkey AS customer_id", "concat('CUST-', c_custkey) AS customer_number", "c_name AS customer_name",
            "city", "country", _stamp("c_custkey"),
        )

    def _suppliers(self) -> DataFrame:
        s = self.base("supplier").join(self["places"], F.col("s_nationkey") == F.col("n_nationkey"))
        return s.selectExpr(
            "s_suppkey AS supplier_id", "concat('SUP-', s_suppkey) AS supplier_code", "s_name AS supplier_name",
            "country", _stamp("s_suppkey"),
        )

    def _products(self) -> DataFrame:
        size = self.base("supplier").agg(F.count("*").alias("n"))
        return self.base("part").crossJoin(size).selectExpr(  # one row on the right
            "p_partkey AS product_id", "concat('BAN-', p_partkey) AS product_code", "p_name AS product_name",
            "p_type AS category", "CASE WHEN p_partkey % 97 <> 0 THEN p_partkey % n END AS supplier_id",
            _stamp("p_partkey"),
        )

    def _warehouse_skus(self) -> DataFrame:
        return self.base("part").selectExpr(
            "p_partkey AS sku_id", "concat('BAN-', p_partkey) AS erp_product_code", "concat('BAN_', p_partkey) AS sku",
            _stamp("p_partkey"),
        )

    def _transport_product_references(self) -> DataFrame:
        return self.base("part").filter("p_partkey % 211 <> 0").selectExpr(
            "p_partkey AS ref_id", "concat('BAN-', p_partkey) AS erp_product_code",
            "concat('ban-', p_partkey) AS transport_product_reference", _stamp("p_partkey"),
        )

    def _carriers(self) -> DataFrame:
        rows = constant(self.spark, CARRIERS, "carrier_id long, carrier_code string, carrier_name string")
        return rows.selectExpr("*", _stamp("carrier_id"))

    def _supply_chain_nodes(self) -> DataFrame:
        return R.supply_chain_nodes(self.spark)

    def _golden_records(self) -> DataFrame:
        return mdm.golden_records(
            self["products"], self["customers"], self["suppliers"], self["carriers"], self["supply_chain_nodes"]
        )

    def _source_mappings(self) -> DataFrame:
        known = self["products"].filter("product_id % 211 <> 0")
        golden = mdm.golden_records(
            known, self["customers"], self["suppliers"], self["carriers"], self["supply_chain_nodes"]
        )
        return mdm.source_mappings(golden)

    # --- movements -------------------------------------------------------------

    def _lines(self) -> DataFrame:
        return self.base("lineitem")

    def _l1(self) -> DataFrame:
        """One row per order and line number, staged: every relation made from the lines reads it, none sorts them again."""
        window = Window.partitionBy("l_orderkey", "l_linenumber").orderBy(*_L1_ORDER)
        first = self["lines"].withColumn("_rn", F.row_number().over(window)).filter("_rn = 1")
        kept = ["l_orderkey", "l_linenumber", *[c for c in _L1_ORDER if c != "l_extendedprice"]]
        return self.stage("lines", lambda: first.select(*kept)).withColumn("hop", F.col("l_linenumber"))

    def _last_hops(self) -> DataFrame:
        """The lines of the last hop; the filter on the line number reaches the scan."""
        window = Window.partitionBy("l_orderkey", "l_linenumber").orderBy(*_L1_ORDER)
        lines = self["lines"].filter("l_linenumber = 6").withColumn("_rn", F.row_number().over(window)).filter("_rn = 1").drop("_rn")
        return lines.selectExpr("*", "l_linenumber AS hop", "l_orderkey * 8 + l_linenumber AS shipment_id")

    def _orders(self) -> DataFrame:
        return self.base("orders").selectExpr(
            "o_orderkey AS order_id", "concat('ORD-', o_orderkey) AS order_reference", "o_custkey AS customer_id",
            "CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'HIGH' WHEN '2' THEN 'HIGH' WHEN '3' THEN 'NORMAL' "
            "WHEN '5' THEN 'LOW' ELSE 'UNSPECIFIED' END AS delivery_priority",
            "o_orderdate AS order_timestamp",
        )

    def _order_items(self) -> DataFrame:
        return self["l1"].selectExpr(
            "l_orderkey * 8 + l_linenumber AS item_id", "l_orderkey AS order_id", "l_partkey AS product_id",
            "CAST(l_quantity AS INT) - CASE WHEN l_partkey % 501 = 0 THEN 60 ELSE 0 END AS quantity",
            "CASE WHEN l_suppkey % 97 <> 0 THEN CAST((100 + l_partkey % 500) * 0.01BD AS DECIMAL(10,2)) END AS unit_price",
        )

    def _hops(self) -> DataFrame:
        """Seven stations make six hops: a seventh line of an order is an order line, and no leg of its batch."""
        return self["l1"].filter("hop <= 6").selectExpr("*", "l_orderkey * 8 + hop AS shipment_id")

    def _shipments(self) -> DataFrame:
        started = self.base("orders").select("o_orderkey", "o_orderdate")
        return self["hops"].join(started, F.col("l_orderkey") == F.col("o_orderkey")).selectExpr(
            "shipment_id", "concat('SHIP-', l_orderkey, '-', hop) AS shipment_identifier",
            f"{_node('hop')} AS source_node", f"{_node('hop + 1')} AS target_node",
            "CASE WHEN hop = 4 THEN 'SEA_FREIGHT' ELSE 'TRUCK' END AS transport_mode",
            "concat('ban-', l_partkey) AS cargo_product_reference",
            "CASE WHEN l_suppkey % 53 <> 0 THEN 101 + l_suppkey % 5 END AS carrier_id",
            f"o_orderdate + make_dt_interval(0, {_HOURS.format('hop')}) AS estimated_arrival",
            "o_orderdate AS started_at",
        )

    def _transport_completions(self) -> DataFrame:
        return self["hops"].filter("CAST(l_tax AS DECIMAL(4,2)) <> 0.08BD").selectExpr(
            "shipment_id AS completion_id", "shipment_id", f"{_node('hop + 1')} AS arrival_node",
            "CAST(CAST(l_discount AS DECIMAL(4,2)) * 100 AS INT) * 20 AS delay_minutes", "l_shipdate AS completed_at",
        )

    def _deliveries(self) -> DataFrame:
        return self["last_hops"].selectExpr(
            "shipment_id AS delivery_id", "shipment_id", "'RETAIL_STORE' AS supply_chain_node",
            "CASE WHEN l_suppkey % 89 = 0 THEN 'UNKNOWN' WHEN l_returnflag = 'N' THEN 'SUCCESSFUL' "
            "WHEN l_returnflag = 'A' THEN 'DELAYED' ELSE 'FAILED' END AS delivery_status",
            "CASE WHEN NOT (l_linestatus = 'O' AND CAST(l_tax AS DECIMAL(4,2)) = 0) "
            "THEN concat('EMP-', l_orderkey % 99 + 1) END AS received_by",
            "concat('ban-', l_partkey) AS cargo_product_reference", "l_shipdate AS delivered_at",
        )

    def _batches(self) -> DataFrame:
        return (
            self["l1"]
            .filter("l_orderkey % 307 <> 0")
            .groupBy("l_orderkey")
            .agg(
                F.min("l_partkey").alias("p"),
                F.sum(F.col("l_quantity").cast("int")).cast("int").alias("quantity"),
                F.min("l_shipdate").alias("harvested_at"),
            )
            .selectExpr(
                "l_orderkey AS batch_id", "concat('BATCH-', l_orderkey) AS batch_identifier", "p AS product_id",
                "'Ghana' AS origin_country", "quantity", "'BANANA_PLANTATION' AS supply_chain_node",
                "concat(CASE WHEN p % 211 = 0 THEN 'ban_' ELSE 'BAN_' END, p) AS wms_sku",
                "concat('ban-', p) AS tms_product_reference", "harvested_at",
            )
        )

    def _node_processings(self) -> DataFrame:
        return self["hops"].selectExpr(
            "shipment_id AS processing_id", "hop AS node_id", "concat('BATCH-', l_orderkey) AS batch_reference",
            "concat('BAN_', l_partkey) AS sku",
            "CASE WHEN l_suppkey % 50 <> 0 THEN CAST(9.5BD + CAST(l_quantity AS INT) % 6 + CAST(l_tax AS DECIMAL(4,2)) * 10 "
            "AS DECIMAL(5,2)) END AS temperature",
            "CASE WHEN l_linestatus = 'F' THEN 'COMPLETED' ELSE 'PENDING' END AS status", "l_shipdate AS processed_at",
        )

    def _shipment_positions(self) -> DataFrame:
        return self.base("events").selectExpr(
            "event_id AS position_id", "user_id * 8 + event_id % 6 + 1 AS shipment_id", *_MEASURES, "ts AS recorded_at"
        )

    # --- live events -------------------------------------------------------------

    def _of_type(self, *types: str) -> DataFrame:
        return self.base("events").filter(F.col("event_type").isin(*types))

    def _started(self) -> DataFrame:
        return started(self._of_type("signup"))

    def _positions(self) -> DataFrame:
        return positions(self._of_type("view", "click"))

    def _completed(self) -> DataFrame:
        return self._of_type("purchase").selectExpr(
            _SHIP, "concat('ban-', event_id % 100) AS cargo_product_reference",
            f"{_node('CAST(event_id % 6 AS INT) + 2')} AS arrival_node", "CAST(event_id % 200 AS INT) AS delay_minutes",
            "ts AS event_timestamp",
        )

    def _delivered(self) -> DataFrame:
        return self._of_type("error").selectExpr(
            _SHIP, "concat('ban-', event_id % 100) AS cargo_product_reference", f"{_STATUS} AS delivery_status",
            "CASE WHEN event_id % 7 <> 0 THEN concat('EMP-', event_id % 99) END AS received_by",
            "'RETAIL_STORE' AS supply_chain_node", "ts AS event_timestamp",
        )

    def live_stream(self) -> DataFrame:
        """The events table as a stream."""
        schema = self.base("events").schema
        return (
            self.spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(self.folder)
        )

    # --- business events of the order side --------------------------------------------

    def _order_events(self) -> DataFrame:
        lines = (
            self["l1"]
            .selectExpr(
                "l_orderkey",
                "named_struct('position', l_linenumber, 'product_code', concat('BAN_', l_partkey), 'description', "
                "concat('Part ', l_partkey), 'quantity', CAST(l_quantity AS INT), 'unit_price', "
                "CAST((100 + l_partkey % 500) * 0.01BD AS DECIMAL(10,2))) AS item",
            )
            .groupBy("l_orderkey")
            .agg(F.array_sort(F.collect_list("item")).alias("items"))  # line numbers are 1..7
        )
        customers = self["customers"].selectExpr(
            "customer_id", "struct(customer_number, customer_name, city, country) AS customer"
        )
        orders = self["orders"].join(customers, "customer_id")
        return orders.join(lines, F.col("order_id") == F.col("l_orderkey"), "left").selectExpr(
            "order_reference", "customer",
            "transform(coalesce(items, array()), i -> struct(i.product_code, i.description, i.quantity, i.unit_price)) AS items",
            "delivery_priority", "order_timestamp AS event_timestamp",
        )

    def _product_events(self) -> DataFrame:
        return self["products"].filter("product_id % 3 = 0").selectExpr(
            "concat(' ban_', product_id, ' ') AS product_code", "product_name", "category",
            "CAST(NULL AS DECIMAL(10,2)) AS unit_price", "event_timestamp",
        )

    def _batch_events(self) -> DataFrame:
        return self["batches"].selectExpr(
            "batch_identifier", "concat('ban-', product_id) AS product_code", "wms_sku", "tms_product_reference",
            "origin_country", "quantity", "supply_chain_node", "harvested_at AS event_timestamp",
        )

    def _processing_events(self) -> DataFrame:
        return self["node_processings"].selectExpr(
            "batch_reference", f"{_node('node_id')} AS supply_chain_node", "sku", "temperature", "status",
            "processed_at AS event_timestamp",
        )

    # --- raw events for the loaders -----------------------------------------------------

    def raw(self, event_type: str, df: DataFrame, timestamp: str, **columns: str) -> DataFrame:
        """Rows as raw events: all scalars as text, missing fields NULL."""
        given = {k: F.expr(v) for k, v in columns.items()}
        given |= {"event_type": F.lit(event_type), "timestamp": F.date_format(F.expr(timestamp), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")}
        return df.select(
            *[given.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in EVENT_SCHEMA.fields]
        )

    def _raw_erp(self) -> DataFrame:
        return _all(self.erp_parts())

    def _raw_wms(self) -> DataFrame:
        return _all(self.wms_parts())

    def _raw_tms(self) -> DataFrame:
        return _all(self.tms_parts())

    def erp_parts(self) -> list[DataFrame]:
        """The raw events of the system, a relation for each source of an event type."""
        first = "event_timestamp"
        later = "event_timestamp + INTERVAL '1' DAY"
        suppliers, customers, products = self["suppliers"], self["customers"], self["products"]
        code = (
            "CASE WHEN product_id % 101 = 0 THEN concat('BANANA-', product_id) WHEN product_id % 4 = 1 THEN "
            "concat('BAN_', product_id) WHEN product_id % 4 = 2 THEN concat('ban-', product_id) WHEN product_id % 4 = 3 "
            "THEN concat('BAN-', product_id, ' ') ELSE product_code END"
        )
        supplier_key = "CASE WHEN supplier_id IS NULL THEN 'SUP-NONE' ELSE concat('SUP-', supplier_id) END"
        return [
            self.raw("SupplierCreated", suppliers, first, supplier_code="supplier_code", supplier_name="supplier_name", country="country"),
            self.raw("SupplierCreated", suppliers.filter("supplier_id % 10 = 0"), later, supplier_code="supplier_code", supplier_name="'renamed'", country="country"),
            self.raw("CustomerCreated", customers.filter("customer_id % 50 <> 0"), first, customer_number="customer_number", customer_name="customer_name", city="city", country="country"),
            self.raw("ProductCreated", products, first, product_code=code, product_name="product_name", category="category", supplier_reference=supplier_key),
            self.raw(
                "OrderCreated", self["order_events"], first, order_reference="order_reference", customer="customer",
                items="transform(items, i -> struct(i.product_code, i.description, CAST(i.quantity AS STRING) AS quantity, CAST(i.unit_price AS STRING) AS unit_price))",
                delivery_priority="CASE WHEN delivery_priority <> 'UNSPECIFIED' THEN delivery_priority END",
            ),
            self.raw(
                "BatchHarvested", self["batches"], "harvested_at", batch_identifier="batch_identifier",
                product_code="concat('BAN_', product_id)", origin_country="origin_country",
                quantity="CASE WHEN batch_id % 13 = 0 THEN 'many' ELSE CAST(quantity AS STRING) END",
                supply_chain_node="supply_chain_node", wms_sku="wms_sku",
            ),
        ]

    def wms_parts(self) -> list[DataFrame]:
        processed = self["processing_events"]
        return [
            self.raw("WarehouseSKUCreated", self["warehouse_skus"], "event_timestamp", sku="sku", erp_product_code="lower(erp_product_code)"),
            self.raw(
                "NodeProcessed", processed, "event_timestamp", batch_reference="batch_reference", sku="sku", status="status",
                supply_chain_node="CASE WHEN supply_chain_node = 'COLLECTION_CENTER' THEN 'COLLECTION_POINT' ELSE supply_chain_node END",
                temperature="CAST(temperature AS STRING)",
            ),
        ]

    def tms_parts(self) -> list[DataFrame]:
        ships = self["shipments"]
        codes = ships.select("shipment_id", "shipment_identifier")
        on = "shipment_id"
        carrier = "named_struct('carrier_id', CASE WHEN carrier_id IS NULL THEN 'CAR-999' ELSE concat('CAR-', carrier_id) END, 'carrier_name', 'any')"
        return [
            self.raw("CarrierCreated", self["carriers"], "event_timestamp", carrier_id="carrier_code", carrier_name="carrier_name"),
            self.raw(
                "TransportProductReferenceCreated", self["transport_product_references"], "event_timestamp",
                erp_product_code="transport_product_reference", transport_product_reference="transport_product_reference",
            ),
            self.raw(
                "TransportStarted", ships.filter("shipment_id % 40 <> 1"), "started_at", shipment_identifier="shipment_identifier",
                source_node="source_node", target_node="target_node", transport_mode="transport_mode",
                cargo_product_reference="cargo_product_reference", carrier=carrier,
                estimated_arrival="date_format(estimated_arrival, \"yyyy-MM-dd'T'HH:mm:ss\")",
            ),
            self.raw(
                "ShipmentPositionUpdated", self["shipment_positions"].join(codes, on, "left"), "recorded_at",
                shipment_identifier="coalesce(shipment_identifier, 'SHIP-LOST')",
                coordinates="struct(CAST(latitude AS STRING) AS latitude, CAST(longitude AS STRING) AS longitude)",
                container_temperature="CAST(container_temperature AS STRING)", speed_kmh="CAST(speed_kmh AS STRING)",
            ),
            self.raw(
                "TransportCompleted", self["transport_completions"].join(codes, on), "completed_at",
                shipment_identifier="shipment_identifier", arrival_node="arrival_node", delay_minutes="CAST(delay_minutes AS STRING)",
            ),
            self.raw(
                "DeliveryCompleted", self["deliveries"].join(codes, on), "delivered_at", shipment_identifier="shipment_identifier",
                delivery_status="delivery_status", received_by="received_by", cargo_product_reference="cargo_product_reference",
            ),
        ]


def _all(parts: list[DataFrame]) -> DataFrame:
    union = parts[0]
    for part in parts[1:]:
        union = union.unionByName(part)
    return union


def _stamp(key: str) -> str:
    return (
        "TIMESTAMP_NTZ '1995-12-01 00:00:00' + make_dt_interval(CAST(" + key + " % 2500 AS INT)) AS event_timestamp"
    )


_SHIP = "concat('SHIP-', user_id) AS shipment_identifier"
_STATUS = "element_at(array('SUCCESSFUL', 'DELAYED', 'FAILED', 'SUCCESSFUL'), CAST(event_id % 4 AS INT) + 1)"
_MEASURES = [
    "CAST(2 * CAST(get_json_object(props, '$.k') AS INT) - 90 AS DECIMAL(9,6)) AS latitude",
    "CAST(event_id % 360 - 180 AS DECIMAL(9,6)) AS longitude",
    "CAST(9 + CAST(value AS DECIMAL(9,2)) % 7 AS DECIMAL(5,2)) AS container_temperature",
    "CAST(value AS DECIMAL(6,2)) AS speed_kmh",
]


def positions(events: DataFrame) -> DataFrame:
    """Events as position updates; works on a stream as well."""
    return events.selectExpr(_SHIP, *_MEASURES, "ts AS event_timestamp")


def started(events: DataFrame) -> DataFrame:
    """Events as transport starts; works on a stream as well."""
    hop = "CAST(event_id % 6 AS INT)"
    return events.selectExpr(
        _SHIP, f"{_node(hop + ' + 1')} AS source_node", f"{_node(hop + ' + 2')} AS target_node",
        f"CASE WHEN {hop} = 3 THEN 'SEA_FREIGHT' ELSE 'TRUCK' END AS transport_mode",
        "concat('ban-', event_id % 100) AS cargo_product_reference",
        "named_struct('carrier_id', concat('CAR-', 101 + event_id % 5), 'carrier_name', concat('Carrier ', event_id % 5)) AS carrier",
        "ts + INTERVAL '1' DAY AS estimated_arrival", "ts AS event_timestamp",
    )


def status_events(events: DataFrame) -> DataFrame:
    """Events as starts, positions and deliveries in one relation, for streams."""
    return events.filter("event_type IN ('signup', 'error', 'view', 'click')").selectExpr(
        _SHIP,
        "CASE event_type WHEN 'signup' THEN 'TransportStarted' WHEN 'error' THEN 'DeliveryCompleted' "
        "ELSE 'ShipmentPositionUpdated' END AS event_type",
        f"CASE WHEN event_type = 'error' THEN {_STATUS} END AS delivery_status", *_MEASURES, "ts AS event_timestamp",
    )


# --- the same views as SQL ----------------------------------------------------------------

_LIST = "[" + ", ".join(f"'{n[0]}'" for n in C.NODES) + "]"
_SQL_HOURS = "[" + ", ".join(str(h[3]) for h in C.TOPOLOGY) + "]"


def _sql_stamp(key: str) -> str:
    return f"TIMESTAMP '1995-12-01 00:00:00' + to_days(CAST({key} % 2500 AS INTEGER)) AS event_timestamp"


_SQL_MEASURES = """CAST(2 * CAST(json_extract_string(props, '$.k') AS INTEGER) - 90 AS DECIMAL(9,6)) AS latitude,
  CAST(event_id % 360 - 180 AS DECIMAL(9,6)) AS longitude,
  CAST(9 + CAST(value AS DECIMAL(9,2)) % 7 AS DECIMAL(5,2)) AS container_temperature,
  CAST(value AS DECIMAL(6,2)) AS speed_kmh"""

_SQL_STATUS = "['SUCCESSFUL', 'DELAYED', 'FAILED', 'SUCCESSFUL'][event_id % 4 + 1]"

VIEWS: dict[str, str] = {
    "v_places": "SELECT n_nationkey, n_name AS country, r_name AS city FROM nation JOIN region ON n_regionkey = r_regionkey",
    "v_customers": f"SELECT c_custkey AS customer_id, 'CUST-' || c_custkey AS customer_number, c_name AS customer_name, city, country, {_sql_stamp('c_custkey')} FROM customer JOIN v_places ON c_nationkey = n_nationkey",
    "v_suppliers": f"SELECT s_suppkey AS supplier_id, 'SUP-' || s_suppkey AS supplier_code, s_name AS supplier_name, country, {_sql_stamp('s_suppkey')} FROM supplier JOIN v_places ON s_nationkey = n_nationkey",
    "v_products": f"SELECT p_partkey AS product_id, 'BAN-' || p_partkey AS product_code, p_name AS product_name, p_type AS category, CASE WHEN p_partkey % 97 <> 0 THEN p_partkey % (SELECT COUNT(*) FROM supplier) END AS supplier_id, {_sql_stamp('p_partkey')} FROM part",
    "v_warehouse_skus": f"SELECT p_partkey AS sku_id, 'BAN-' || p_partkey AS erp_product_code, 'BAN_' || p_partkey AS sku, {_sql_stamp('p_partkey')} FROM part",
    "v_transport_product_references": f"SELECT p_partkey AS ref_id, 'BAN-' || p_partkey AS erp_product_code, 'ban-' || p_partkey AS transport_product_reference, {_sql_stamp('p_partkey')} FROM part WHERE p_partkey % 211 <> 0",
    "v_carriers": "SELECT carrier_id, carrier_code, carrier_name, "
    + _sql_stamp("carrier_id")
    + " FROM (VALUES "
    + ", ".join(f"({i}, '{c}', '{n}')" for i, c, n in CARRIERS)
    + ") AS t(carrier_id, carrier_code, carrier_name)",
    "v_supply_chain_nodes": "SELECT * FROM (VALUES "
    + ", ".join(f"({n[4]}, '{n[0]}', '{n[1]}', '{n[2]}', '{n[3]}', {n[4]}, '{C.GRAPH_NODE_NAMES[n[0]]}')" for n in C.NODES)
    + ") AS t(node_id, node_code, node_name, node_type, region, sequence_order, graph_name)",
    "v_topology": "SELECT * FROM (VALUES "
    + ", ".join(f"('{a}', '{b}', '{m}', {h})" for a, b, m, h in C.TOPOLOGY)
    + ") AS t(source_node, target_node, transport_mode, typical_hours)",
    "v_carrier_node_types": "SELECT * FROM (VALUES "
    + ", ".join(f"('{a}', '{m}', '{k}')" for a, m, k in C.CARRIER_NODE_TYPES)
    + ") AS t(carrier_code, transport_mode, node_type)",
    "v_statuses": "SELECT * FROM (VALUES "
    + ", ".join(f"('{a}', '{b}', {c}, '{d}')" for a, b, c, d in C.DELIVERY_STATUSES)
    + ") AS t(status_code, status_name, is_successful, description)",
    "v_entity_types": "SELECT * FROM (VALUES "
    + ", ".join(f"('{a}', '{b}', '{c}')" for a, b, c in C.ENTITY_TYPES)
    + ") AS t(entity_type_code, entity_type_name, source_schema)",
    "v_golden": """SELECT 'PRODUCT' AS entity_type, product_code AS canonical_key, product_name AS canonical_name, 'ACTIVE' AS status, 0.95 AS quality_score FROM v_products
  UNION ALL SELECT 'CUSTOMER', customer_number, customer_name, 'ACTIVE', 1.00 FROM v_customers
  UNION ALL SELECT 'SUPPLIER', supplier_code, supplier_name, 'ACTIVE', 1.00 FROM v_suppliers
  UNION ALL SELECT 'CARRIER', carrier_code, carrier_name, 'ACTIVE', 1.00 FROM v_carriers
  UNION ALL SELECT 'SUPPLY_CHAIN_NODE', node_code, node_name, 'ACTIVE', 1.00 FROM v_supply_chain_nodes""",
    "v_mappings": """SELECT entity_type, canonical_key, source_system, source_key, lower(replace(trim(source_key), '_', '-')) AS normalized_key, is_canonical FROM (
  SELECT 'PRODUCT' AS entity_type, product_code AS canonical_key, 'ERP' AS source_system, product_code AS source_key, TRUE AS is_canonical FROM v_products WHERE product_id % 211 <> 0
  UNION ALL SELECT 'PRODUCT', product_code, 'WMS', replace(product_code, '-', '_'), FALSE FROM v_products WHERE product_id % 211 <> 0
  UNION ALL SELECT 'PRODUCT', product_code, 'TMS', lower(product_code), FALSE FROM v_products WHERE product_id % 211 <> 0
  UNION ALL SELECT 'CUSTOMER', customer_number, 'ERP', customer_number, TRUE FROM v_customers
  UNION ALL SELECT 'SUPPLIER', supplier_code, 'ERP', supplier_code, TRUE FROM v_suppliers
  UNION ALL SELECT 'CARRIER', carrier_code, 'TMS', carrier_code, TRUE FROM v_carriers
  UNION ALL SELECT 'SUPPLY_CHAIN_NODE', node_code, 'WMS', node_code, TRUE FROM v_supply_chain_nodes
  UNION ALL SELECT 'SUPPLY_CHAIN_NODE', node_code, 'TMS', node_code, FALSE FROM v_supply_chain_nodes)""",
    "v_l1": "SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY "
    + ", ".join(_L1_ORDER)
    + ") AS rn FROM lineitem) WHERE rn = 1",
    "v_orders": """SELECT o_orderkey AS order_id, 'ORD-' || o_orderkey AS order_reference, o_custkey AS customer_id,
  CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'HIGH' WHEN '2' THEN 'HIGH' WHEN '3' THEN 'NORMAL' WHEN '5' THEN 'LOW' ELSE 'UNSPECIFIED' END AS delivery_priority,
  o_orderdate AS order_timestamp FROM orders""",
    "v_order_items": """SELECT l_orderkey * 8 + l_linenumber AS item_id, l_orderkey AS order_id, l_partkey AS product_id,
  CAST(l_quantity AS INTEGER) - CASE WHEN l_partkey % 501 = 0 THEN 60 ELSE 0 END AS quantity,
  CASE WHEN l_suppkey % 97 <> 0 THEN CAST((100 + l_partkey % 500) * 0.01 AS DECIMAL(10,2)) END AS unit_price FROM v_l1""",
    "v_hops": "SELECT *, l_orderkey * 8 + l_linenumber AS shipment_id, l_linenumber AS hop FROM v_l1 WHERE l_linenumber <= 6",
    "v_shipments": f"""SELECT shipment_id, 'SHIP-' || l_orderkey || '-' || hop AS shipment_identifier, {_LIST}[hop] AS source_node, {_LIST}[hop + 1] AS target_node,
  CASE WHEN hop = 4 THEN 'SEA_FREIGHT' ELSE 'TRUCK' END AS transport_mode, 'ban-' || l_partkey AS cargo_product_reference,
  CASE WHEN l_suppkey % 53 <> 0 THEN 101 + l_suppkey % 5 END AS carrier_id, o_orderdate + to_hours({_SQL_HOURS}[hop]) AS estimated_arrival, o_orderdate AS started_at
  FROM v_hops JOIN orders ON l_orderkey = o_orderkey""",
    "v_transport_completions": f"""SELECT shipment_id, {_LIST}[hop + 1] AS arrival_node, CAST(CAST(l_discount AS DECIMAL(4,2)) * 100 AS INTEGER) * 20 AS delay_minutes, l_shipdate AS completed_at
  FROM v_hops WHERE CAST(l_tax AS DECIMAL(4,2)) <> 0.08""",
    "v_deliveries": """SELECT shipment_id, 'RETAIL_STORE' AS supply_chain_node,
  CASE WHEN l_suppkey % 89 = 0 THEN 'UNKNOWN' WHEN l_returnflag = 'N' THEN 'SUCCESSFUL' WHEN l_returnflag = 'A' THEN 'DELAYED' ELSE 'FAILED' END AS delivery_status,
  CASE WHEN NOT (l_linestatus = 'O' AND CAST(l_tax AS DECIMAL(4,2)) = 0) THEN 'EMP-' || (l_orderkey % 99 + 1) END AS received_by,
  'ban-' || l_partkey AS cargo_product_reference, l_shipdate AS delivered_at FROM v_hops WHERE hop = 6""",
    "v_batches": """SELECT l_orderkey AS batch_id, 'BATCH-' || l_orderkey AS batch_identifier, p AS product_id, 'Ghana' AS origin_country, quantity, 'BANANA_PLANTATION' AS supply_chain_node,
  CASE WHEN p % 211 = 0 THEN 'ban_' ELSE 'BAN_' END || p AS wms_sku, 'ban-' || p AS tms_product_reference, harvested_at
  FROM (SELECT l_orderkey, MIN(l_partkey) AS p, SUM(CAST(l_quantity AS INTEGER)) AS quantity, MIN(l_shipdate) AS harvested_at FROM v_l1 WHERE l_orderkey % 307 <> 0 GROUP BY l_orderkey)""",
    "v_node_processings": """SELECT shipment_id AS processing_id, hop AS node_id, 'BATCH-' || l_orderkey AS batch_reference, 'BAN_' || l_partkey AS sku,
  CASE WHEN l_suppkey % 50 <> 0 THEN CAST(9.5 + CAST(l_quantity AS INTEGER) % 6 + CAST(l_tax AS DECIMAL(4,2)) * 10 AS DECIMAL(5,2)) END AS temperature,
  CASE WHEN l_linestatus = 'F' THEN 'COMPLETED' ELSE 'PENDING' END AS status, l_shipdate AS processed_at FROM v_hops""",
    "v_shipment_positions": f"SELECT event_id AS position_id, user_id * 8 + event_id % 6 + 1 AS shipment_id, {_SQL_MEASURES}, ts AS recorded_at FROM events",
    "v_started": f"""SELECT event_id, 'SHIP-' || user_id AS shipment_identifier, {_LIST}[event_id % 6 + 1] AS source_node, {_LIST}[event_id % 6 + 2] AS target_node,
  CASE WHEN event_id % 6 = 3 THEN 'SEA_FREIGHT' ELSE 'TRUCK' END AS transport_mode, 'ban-' || (event_id % 100) AS cargo_product_reference,
  'CAR-' || (101 + event_id % 5) AS carrier_id, 'Carrier ' || (event_id % 5) AS carrier_name, ts + INTERVAL 1 DAY AS estimated_arrival, ts AS event_timestamp
  FROM events WHERE event_type = 'signup'""",
    "v_positions": f"SELECT 'SHIP-' || user_id AS shipment_identifier, {_SQL_MEASURES}, ts AS event_timestamp FROM events WHERE event_type IN ('view', 'click')",
    "v_completed": f"""SELECT 'SHIP-' || user_id AS shipment_identifier, {_LIST}[event_id % 6 + 2] AS arrival_node, event_id % 200 AS delay_minutes, ts AS event_timestamp
  FROM events WHERE event_type = 'purchase'""",
    "v_delivered": f"""SELECT 'SHIP-' || user_id AS shipment_identifier, 'ban-' || (event_id % 100) AS cargo_product_reference, {_SQL_STATUS} AS delivery_status,
  CASE WHEN event_id % 7 <> 0 THEN 'EMP-' || (event_id % 99) END AS received_by, ts AS event_timestamp FROM events WHERE event_type = 'error'""",
}

_PRODUCT_TEMPERATURE = """SELECT b.product_id, SUM(CAST(n.temperature * 100 AS BIGINT)) AS s, COUNT(n.temperature) AS c
  FROM v_batches b LEFT JOIN v_node_processings n ON n.batch_reference = b.batch_identifier GROUP BY b.product_id"""

VIEWS |= {
    "v_first_order": """SELECT * FROM (SELECT i.product_id, i.quantity, i.unit_price, o.order_reference, o.delivery_priority, o.order_timestamp, c.customer_number,
  ROW_NUMBER() OVER (PARTITION BY i.product_id ORDER BY o.order_timestamp, i.item_id) AS rn
  FROM v_order_items i JOIN v_orders o ON o.order_id = i.order_id JOIN v_customers c ON c.customer_id = o.customer_id) WHERE rn = 1""",
    "v_product_temperature": _PRODUCT_TEMPERATURE,
    "v_first_batch": """SELECT * FROM (SELECT product_id, batch_identifier, ROW_NUMBER() OVER (PARTITION BY product_id ORDER BY harvested_at, batch_id) AS rn FROM v_batches) WHERE rn = 1""",
    "v_fact": """SELECT op.customer_number, p.product_code, s.supplier_code, ca.carrier_code, nd.node_code AS destination_node,
  CAST(strftime(op.order_timestamp, '%Y%m%d') AS INTEGER) AS order_date_sk, CAST(strftime(d.delivered_at, '%Y%m%d') AS INTEGER) AS delivery_date_sk,
  d.delivery_status, op.order_reference, fb.batch_identifier, sh.shipment_identifier, op.quantity, op.unit_price, op.quantity * op.unit_price AS total_value,
  COALESCE(tc.delay_minutes, 0) AS delay_minutes, CASE WHEN pt.c > 0 THEN CAST(((2 * pt.s + pt.c) // (2 * pt.c)) / 100.0 AS DECIMAL(5,2)) END AS avg_temperature,
  6 AS num_supply_chain_hops, op.delivery_priority AS delivery_priority_code, (d.delivery_status = 'SUCCESSFUL' AND COALESCE(tc.delay_minutes, 0) = 0) AS on_time_flag
  FROM v_shipments sh JOIN v_deliveries d ON d.shipment_id = sh.shipment_id
  LEFT JOIN v_carriers ca ON ca.carrier_id = sh.carrier_id LEFT JOIN v_transport_completions tc ON tc.shipment_id = sh.shipment_id
  LEFT JOIN v_supply_chain_nodes nd ON nd.node_code = sh.target_node
  JOIN v_products p ON p.product_code = upper(sh.cargo_product_reference) JOIN v_suppliers s ON s.supplier_id = p.supplier_id
  JOIN v_first_order op ON op.product_id = p.product_id JOIN v_product_temperature pt ON pt.product_id = p.product_id
  LEFT JOIN v_first_batch fb ON fb.product_id = p.product_id JOIN v_statuses st ON st.status_code = d.delivery_status""",
}
