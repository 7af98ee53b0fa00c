"""Checked queries: sources, writes, functions, loaders, reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from checks.adapter import AS_OF, Driver
from checks.registry import add, average, percent
from freightloom.functions import dates, keys, numbers, texts
from freightloom.operators import operational as ops
from freightloom.operators import skew, writes
from freightloom.plans import reports as rpt
from freightloom.sources import relations as R
from freightloom.sources.events import event_counts, route

# --- sources -------------------------------------------------------------------------

add(
    "SRC-3_event_routing",
    "system:s event_type:s events:i",
    lambda d: event_counts(d["raw_erp"]).select(F.lit("erp").alias("system"), "event_type", "events").unionByName(
        event_counts(d["raw_wms"]).select(F.lit("wms").alias("system"), "event_type", "events")
    ).unionByName(event_counts(d["raw_tms"]).select(F.lit("tms").alias("system"), "event_type", "events")),
    """SELECT 'erp' AS system, 'SupplierCreated' AS event_type, COUNT(*) + COUNT(*) FILTER (WHERE s_suppkey % 10 = 0) AS events FROM supplier
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
    UNION ALL SELECT 'tms', 'DeliveryCompleted', COUNT(*) FROM v_deliveries""",
)

add(
    "SRC-3_routed_processings",
    "supply_chain_node:s batch_reference:s sku:s temperature:d status:s event_timestamp:t",
    lambda d: route(d["raw_wms"], "NodeProcessed"),
    """SELECT CASE WHEN node_code = 'COLLECTION_CENTER' THEN 'COLLECTION_POINT' ELSE node_code END AS supply_chain_node, batch_reference, sku, temperature, status, processed_at AS event_timestamp
    FROM v_node_processings JOIN v_supply_chain_nodes USING (node_id)""",
)

add(
    "SRC-4_statuses_in_use",
    "status_code:s status_name:s is_successful:b deliveries:i",
    lambda d: R.delivery_statuses(d.spark)
    .join(
        d["deliveries"].groupBy(F.col("delivery_status").alias("status_code")).agg(F.count("*").alias("deliveries")),
        "status_code", "left",
    )
    .na.fill(0, ["deliveries"]),
    """SELECT status_code, status_name, is_successful, (SELECT COUNT(*) FROM v_deliveries WHERE delivery_status = status_code) AS deliveries FROM v_statuses""",
)

_DATE_PARTS = """CAST(strftime(full_date, '%Y%m%d') AS INTEGER) AS date_sk, full_date, year(full_date) AS year, quarter(full_date) AS quarter, month(full_date) AS month,
    monthname(full_date) AS month_name, weekofyear(full_date) AS week_of_year, day(full_date) AS day_of_month, dayofweek(full_date) + 1 AS day_of_week, dayname(full_date) AS day_name,
    dayofweek(full_date) IN (0, 6) AS is_weekend"""
_DATE_SPEC = (
    "date_sk:i full_date:D year:i quarter:i month:i month_name:s week_of_year:i day_of_month:i day_of_week:i day_name:s is_weekend:b"
)

add(
    "SRC-5_order_calendar",
    "first_day:D last_day:D days:i",
    lambda d: R.calendar_of(d["orders"], "order_timestamp").agg(
        F.min("full_date").alias("first_day"), F.max("full_date").alias("last_day"), F.count("*").alias("days")
    ),
    """SELECT make_date(lo, 1, 1) AS first_day, make_date(hi, 12, 31) AS last_day, date_diff('day', make_date(lo, 1, 1), make_date(hi, 12, 31)) + 1 AS days
    FROM (SELECT MIN(year(o_orderdate)) AS lo, MAX(year(o_orderdate)) AS hi FROM orders)""",
)

add(
    "DWH-6_dim_date",
    _DATE_SPEC,
    lambda d: R.calendar_of(d["orders"], "order_timestamp"),
    f"""SELECT {_DATE_PARTS} FROM (SELECT CAST(UNNEST(generate_series(make_date(lo, 1, 1), make_date(hi, 12, 31), INTERVAL 1 DAY)) AS DATE) AS full_date
    FROM (SELECT MIN(year(o_orderdate)) AS lo, MAX(year(o_orderdate)) AS hi FROM orders))""",
)

# --- writes --------------------------------------------------------------------------

_LINES = "l_orderkey:i l_linenumber:i l_partkey:i l_suppkey:i l_quantity:d l_extendedprice:d l_discount:d l_tax:d l_returnflag:s l_linestatus:s l_shipdate:t"
_BY_DATE = ["l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_discount", "l_tax", "l_returnflag", "l_linestatus"]
_ORDER_SQL = ", ".join(_BY_DATE)

add(
    "SNK-1_insert_ignore",
    _LINES,
    lambda d: writes.insert_ignore(
        d.base("lineitem"),
        d.base("lineitem").filter("l_linestatus = 'F'"),
        ["l_orderkey", "l_linenumber"],
        _BY_DATE,
    ),
    """SELECT * FROM v_l1 n WHERE NOT EXISTS (SELECT 1 FROM lineitem t WHERE t.l_linestatus = 'F' AND t.l_orderkey = n.l_orderkey AND t.l_linenumber = n.l_linenumber)""",
)

add(
    "SNK-2_upsert_last",
    _LINES,
    lambda d: writes.upsert_last(
        d.base("lineitem").filter("l_linestatus = 'O'"),
        d.base("lineitem").filter("l_linestatus = 'F'"),
        ["l_orderkey", "l_linenumber"],
        _BY_DATE,
    ),
    f"""SELECT * EXCLUDE (r) FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY CASE WHEN l_linestatus = 'O' THEN 1 ELSE 0 END DESC,
    CASE WHEN l_linestatus = 'O' THEN l_shipdate END DESC, CASE WHEN l_linestatus = 'F' THEN l_shipdate END DESC,
    {", ".join(c + " DESC" for c in _BY_DATE[1:])}) AS r FROM lineitem) WHERE r = 1""",
)

add(
    "SNK-3_full_refresh",
    "l_returnflag:s row_count:i",
    lambda d: _refreshed(d).groupBy("l_returnflag").agg(F.count("*").alias("row_count")),
    "SELECT l_returnflag, COUNT(*) AS row_count FROM lineitem GROUP BY l_returnflag",
)


def _refreshed(d: Driver) -> DataFrame:
    import uuid

    from freightloom.session import shared_dir

    path = f"{shared_dir(d.spark)}/refresh-{uuid.uuid4().hex}"
    lines = d.base("lineitem").select("l_orderkey", "l_returnflag")
    writes.full_refresh(lines.filter("l_returnflag = 'A'"), path)
    writes.full_refresh(lines, path)
    return d.spark.read.schema(lines.schema).parquet(path)


add(
    "SNK-4_fill_missing_supplier",
    "product_code:s supplier_id:i",
    lambda d: writes.fill_missing(
        d["products"],
        d["order_items"].join(d.base("supplier").select(F.col("s_suppkey")), F.col("product_id") % 1000 == F.col("s_suppkey"))
        .groupBy("product_id").agg(F.min("s_suppkey").alias("supplier_id")),
        {"product_id": "product_id"},
        "supplier_id",
    ),
    """SELECT product_code, COALESCE(p.supplier_id, f.supplier_id) AS supplier_id FROM v_products p LEFT JOIN (SELECT product_id, MIN(s_suppkey) AS supplier_id FROM v_order_items JOIN supplier ON product_id % 1000 = s_suppkey GROUP BY product_id) f ON f.product_id = p.product_id""",
)

add(
    "SNK-5_insert_missing_lines",
    "order_id:i product_id:i item_id:i quantity:i unit_price:d",
    lambda d: writes.insert_missing(
        d["order_items"],
        d["order_items"].filter("quantity <= 0").select("order_id", "product_id"),
        ["order_id", "product_id"],
        "item_id",
    ),
    """SELECT order_id, product_id, item_id, quantity, unit_price FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY order_id, product_id ORDER BY item_id) AS r FROM v_order_items) n
    WHERE r = 1 AND NOT EXISTS (SELECT 1 FROM v_order_items t WHERE t.quantity <= 0 AND t.order_id = n.order_id AND t.product_id = n.product_id)""",
)

add(
    "SNK-7_add_to_set",
    "batch_reference:s node_id:i temperature:d status:s",
    lambda d: writes.add_to_set(
        d["node_processings"].select("batch_reference", "node_id", "temperature", "status"),
        d["node_processings"].filter("status = 'PENDING'").select("batch_reference", "node_id", "temperature", "status"),
    ),
    """SELECT batch_reference, node_id, temperature, status FROM v_node_processings
    EXCEPT SELECT batch_reference, node_id, temperature, status FROM v_node_processings WHERE status = 'PENDING'""",
)

add(
    "SNK-8_reject_counts",
    "reason:s skipped:i",
    lambda d: writes.reject_counts(
        writes.split_unresolved(
            d["shipment_positions"], d["shipments"], {"shipment_id": "shipment_id"}, "position_without_shipment"
        )[1],
        writes.split_unresolved(
            d["node_processings"], d["batches"], {"batch_reference": "batch_identifier"}, "processing_without_batch"
        )[1],
    ),
    """SELECT 'position_without_shipment' AS reason, COUNT(*) AS skipped FROM v_shipment_positions WHERE shipment_id NOT IN (SELECT shipment_id FROM v_shipments)
    UNION ALL SELECT 'processing_without_batch', COUNT(*) FROM v_node_processings WHERE batch_reference NOT IN (SELECT batch_identifier FROM v_batches)""",
)

_COUNTED = [
    "suppliers", "customers", "products", "orders", "order_items", "batches", "warehouse_skus", "supply_chain_nodes",
    "node_processings", "carriers", "transport_product_references", "shipments", "shipment_positions",
    "transport_completions", "deliveries",
]

add(
    "SNK-9_load_statistics",
    "table_name:s row_count:i",
    lambda d: writes.load_statistics({n: d[n] for n in _COUNTED}),
    " UNION ALL ".join(f"SELECT '{n}' AS table_name, COUNT(*) AS row_count FROM v_{n}" for n in _COUNTED),
)


def _second_load(d: Driver) -> DataFrame:
    """Loading the same processings again must add nothing."""
    events = route(d["raw_wms"], "NodeProcessed")
    first = d.stage("processings", lambda: ops.build_node_processings(events, d["supply_chain_nodes"])[0])
    again, _ = ops.build_node_processings(events, d["supply_chain_nodes"], first)
    return first.agg(F.count("*").alias("first_load")).crossJoin(again.agg(F.count("*").alias("second_load")))


add(
    "SNK-10_idempotent_reload",
    "first_load:i second_load:i",
    _second_load,
    "SELECT COUNT(*) AS first_load, 0 AS second_load FROM v_node_processings WHERE node_id <> 2",
)

add(
    "SNK_surrogate_keys",
    "customers:i distinct_keys:i lowest:i highest:i",
    lambda d: writes.assign_keys(d["customers"], "customer_number", "customer_sk").agg(
        F.count("*").alias("customers"), F.count_distinct("customer_sk").alias("distinct_keys"),
        F.min("customer_sk").alias("lowest"), F.max("customer_sk").alias("highest"),
    ),
    "SELECT COUNT(*) AS customers, COUNT(*) AS distinct_keys, 1 AS lowest, COUNT(*) AS highest FROM v_customers",
)

# --- functions -----------------------------------------------------------------------

add(
    "FN_keys",
    "raw:s normalized:s match:s wms:s tms:s erp_format:b wms_format:b tms_format:b",
    lambda d: d.base("part")
    .select(F.concat(F.lit(" BaN_"), F.col("p_partkey").cast("string"), F.lit(" ")).alias("raw"), F.concat(F.lit("BAN-"), F.col("p_partkey").cast("string")).alias("code"))
    .select(
        "raw", keys.normalize_key("raw").alias("normalized"), keys.match_key("raw").alias("match"),
        keys.wms_key("code").alias("wms"), keys.tms_key("code").alias("tms"),
        keys.key_format_ok("code", "ERP").alias("erp_format"), keys.key_format_ok(keys.wms_key("code"), "WMS").alias("wms_format"),
        keys.key_format_ok(keys.tms_key("code"), "TMS").alias("tms_format"),
    ),
    """SELECT ' BaN_' || p_partkey || ' ' AS raw, 'BAN-' || p_partkey AS normalized, 'ban-' || p_partkey AS match, 'BAN_' || p_partkey AS wms, 'ban-' || p_partkey AS tms,
    p_partkey BETWEEN 100 AND 999 AS erp_format, p_partkey BETWEEN 100 AND 999 AS wms_format, p_partkey BETWEEN 100 AND 999 AS tms_format FROM part""",
)

add(
    "FN_dates",
    "o_orderkey:i date_sk:i shown:s epoch:i later:t",
    lambda d: d.base("orders").select(
        "o_orderkey", dates.date_key("o_orderdate").alias("date_sk"), dates.display_moment("o_orderdate").alias("shown"),
        dates.epoch_seconds("o_orderdate").alias("epoch"), dates.plus_seconds("o_orderdate", 3600).alias("later"),
    ),
    """SELECT o_orderkey, CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS date_sk, strftime(o_orderdate, '%d.%m.%Y %H:%M') AS shown,
    CAST(epoch(o_orderdate) AS BIGINT) AS epoch, o_orderdate + INTERVAL 1 HOUR AS later FROM orders""",
)

add(
    "FN_numbers",
    "event_id:i k:i k_bad:i measured:d breach:b within:b rounded:d",
    lambda d: d["shipment_positions"]
    .join(d.base("events").select("event_id", "props"), F.col("event_id") == F.col("position_id"))
    .select(
        "event_id",
        numbers.safe_int(F.get_json_object("props", "$.k")).alias("k"),
        numbers.safe_int("props").alias("k_bad"),
        numbers.safe_decimal(F.col("container_temperature").cast("string"), 5, 2).alias("measured"),
        numbers.breaks_cold_chain("container_temperature").alias("breach"),
        numbers.within_cold_chain("container_temperature").alias("within"),
        numbers.half_up(F.col("container_temperature"), 1).alias("rounded"),
    ),
    """SELECT position_id AS event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, TRY_CAST(props AS INTEGER) AS k_bad, container_temperature AS measured,
    (container_temperature < 10 OR container_temperature > 15) AS breach, container_temperature BETWEEN 10 AND 15 AS within,
    ((CAST(container_temperature * 100 AS BIGINT) + 5) // 10) / 10.0 AS rounded FROM v_shipment_positions JOIN events ON event_id = position_id""",
)

add(
    "FN_document_texts",
    "shipment_identifier:s lading:s customs:s import_no:s phyto:s path:s",
    lambda d: d["shipments"].select(
        "shipment_identifier", texts.bill_of_lading_number("shipment_identifier").alias("lading"),
        texts.customs_number("shipment_identifier").alias("customs"), texts.import_number("shipment_identifier").alias("import_no"),
        texts.phytosanitary_number("shipment_identifier").alias("phyto"),
        texts.object_path("shipments", "shipment_identifier", "invoice").alias("path"),
    ),
    """SELECT shipment_identifier, 'BL-' || right(shipment_identifier, 8) AS lading, 'CC-EU-' || right(shipment_identifier, 8) AS customs,
    'DE' || replace(upper(right(shipment_identifier, 12)), '-', '') AS import_no, 'PHYTO-' || upper(right(shipment_identifier, 6)) AS phyto,
    'shipments/' || shipment_identifier || '/invoice.pdf' AS path FROM v_shipments""",
)

add(
    "FN-18_order_lines",
    "order_reference:s position:i product_code:s quantity:i unit_price:d",
    lambda d: ops.order_lines(d["order_events"]),
    """SELECT 'ORD-' || l_orderkey AS order_reference, ROW_NUMBER() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber) - 1 AS position, 'BAN-' || l_partkey AS product_code,
    CAST(l_quantity AS INTEGER) AS quantity, (100 + l_partkey % 500) / 100.0 AS unit_price FROM v_l1 JOIN v_orders ON order_id = l_orderkey JOIN v_customers USING (customer_id)""",
)

# --- loaders -------------------------------------------------------------------------


def _suppliers(d: Driver) -> DataFrame:
    return d.stage("suppliers", lambda: ops.build_suppliers(route(d["raw_erp"], "SupplierCreated"))[0])


def _customers(d: Driver) -> DataFrame:
    return d.stage("customers", lambda: ops.build_customers(route(d["raw_erp"], "CustomerCreated"))[0])


def _products(d: Driver) -> DataFrame:
    return d.stage("products", lambda: ops.build_products(route(d["raw_erp"], "ProductCreated"), _suppliers(d))[0])


def _carriers(d: Driver) -> DataFrame:
    return d.stage("carriers", lambda: ops.build_carriers(route(d["raw_tms"], "CarrierCreated"))[0])


def _shipments(d: Driver) -> DataFrame:
    return d.stage(
        "shipments", lambda: ops.build_shipments(route(d["raw_tms"], "TransportStarted"), _carriers(d))[0]
    )


def _with(df: DataFrame, lookup: DataFrame, key: str, name: str, how: str = "left") -> DataFrame:
    return df.join(lookup.select(key, name), key, how)


add(
    "OPS-1_suppliers",
    "supplier_code:s supplier_name:s country:s event_timestamp:t",
    _suppliers,
    "SELECT supplier_code, supplier_name, country, event_timestamp FROM v_suppliers",
)
add(
    "OPS-1_customers",
    "customer_number:s customer_name:s city:s country:s event_timestamp:t",
    _customers,
    "SELECT * FROM v_customers WHERE customer_id % 50 <> 0",
)
_LOADED_CODE = "CASE WHEN product_id % 101 = 0 THEN 'BANANA-' || product_id ELSE product_code END"
add(
    "OPS-1_products",
    "product_code:s product_name:s category:s supplier_code:s event_timestamp:t",
    lambda d: _with(_products(d), _suppliers(d), "supplier_id", "supplier_code"),
    f"""SELECT {_LOADED_CODE} AS product_code, product_name, category, supplier_code, p.event_timestamp FROM v_products p LEFT JOIN v_suppliers s USING (supplier_id)""",
)
add(
    "OPS-2_warehouse_skus",
    "erp_product_code:s sku:s event_timestamp:t",
    lambda d: ops.build_warehouse_skus(route(d["raw_wms"], "WarehouseSKUCreated"))[0],
    "SELECT erp_product_code, sku, event_timestamp FROM v_warehouse_skus",
)
add(
    "OPS-2_carriers",
    "carrier_code:s carrier_name:s event_timestamp:t trips:i",
    lambda d: _carriers_with_trips(d),
    """SELECT carrier_code, carrier_name, event_timestamp, (SELECT COUNT(*) FROM v_shipments s WHERE s.carrier_id = c.carrier_id AND shipment_id % 40 <> 1) AS trips FROM v_carriers c""",
)


def _carriers_with_trips(d: Driver) -> DataFrame:
    carriers, trips = _carriers(d), _shipments(d)
    counts = trips.filter(F.col("carrier_id").isNotNull()).groupBy("carrier_id").agg(F.count("*").alias("trips"))
    return carriers.join(counts, "carrier_id", "left").na.fill(0, ["trips"])


add(
    "OPS-2_transport_references",
    "erp_product_code:s transport_product_reference:s event_timestamp:t",
    lambda d: ops.build_transport_references(route(d["raw_tms"], "TransportProductReferenceCreated"))[0],
    "SELECT * FROM v_transport_product_references",
)
add(
    "OPS-3_orders",
    "order_reference:s customer_number:s delivery_priority:s order_timestamp:t",
    lambda d: _with(
        ops.build_orders(route(d["raw_erp"], "OrderCreated"), _customers(d))[0], _customers(d), "customer_id", "customer_number"
    ),
    """SELECT order_reference, customer_number, CASE WHEN delivery_priority = 'UNSPECIFIED' THEN 'NORMAL' ELSE delivery_priority END AS delivery_priority, order_timestamp
    FROM v_orders JOIN v_customers USING (customer_id) WHERE customer_id % 50 <> 0""",
)
add(
    "OPS-3_rejected_orders",
    "reason:s order_reference:s",
    lambda d: ops.build_orders(route(d["raw_erp"], "OrderCreated"), _customers(d))[1],
    "SELECT 'order_without_customer' AS reason, order_reference FROM v_orders JOIN v_customers USING (customer_id) WHERE customer_id % 50 = 0",
)


def _order_items(d: Driver) -> DataFrame:
    events = route(d["raw_erp"], "OrderCreated")
    orders = d.stage("orders", lambda: ops.build_orders(events, _customers(d))[0])
    products = _products(d)
    items = ops.build_order_items(events, orders, products)[0]
    return _with(_with(items, orders, "order_id", "order_reference", "inner"), products, "product_id", "product_code", "inner")


add(
    "OPS-3_order_items",
    "order_reference:s product_code:s quantity:i unit_price:d",
    _order_items,
    """SELECT order_reference, 'BAN-' || l_partkey AS product_code, CAST(l_quantity AS INTEGER) AS quantity, (100 + l_partkey % 500) / 100.0 AS unit_price
    FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY l_orderkey, l_partkey ORDER BY l_linenumber) AS r FROM v_l1) JOIN v_orders ON order_id = l_orderkey JOIN v_customers USING (customer_id)
    WHERE r = 1 AND customer_id % 50 <> 0 AND l_partkey % 101 <> 0""",
)
add(
    "OPS-4_batches",
    "batch_identifier:s product_code:s origin_country:s quantity:i supply_chain_node:s wms_sku:s tms_product_reference:s harvested_at:t",
    lambda d: _with(ops.build_batches(route(d["raw_erp"], "BatchHarvested"), _products(d))[0], _products(d), "product_id", "product_code"),
    """SELECT batch_identifier, CASE WHEN product_id % 101 <> 0 THEN 'BAN-' || product_id END AS product_code, origin_country, CASE WHEN batch_id % 13 <> 0 THEN quantity END AS quantity,
    supply_chain_node, 'BAN_' || product_id AS wms_sku, 'ban-' || product_id AS tms_product_reference, harvested_at FROM v_batches""",
)
add(
    "OPS-5_node_processings",
    "node_id:i batch_reference:s sku:s temperature:d status:s processed_at:t",
    lambda d: ops.build_node_processings(route(d["raw_wms"], "NodeProcessed"), d["supply_chain_nodes"])[0],
    "SELECT * FROM v_node_processings WHERE node_id <> 2",
)
add(
    "OPS-6_shipments",
    "shipment_identifier:s source_node:s target_node:s transport_mode:s cargo_product_reference:s carrier_code:s estimated_arrival:t started_at:t",
    lambda d: _with(
        _shipments(d), _carriers(d), "carrier_id", "carrier_code"
    ),
    "SELECT s.*, carrier_code FROM v_shipments s LEFT JOIN v_carriers USING (carrier_id) WHERE shipment_id % 40 <> 1",
)
add(
    "OPS-6_positions",
    "shipment_identifier:s latitude:d longitude:d container_temperature:d speed_kmh:d recorded_at:t",
    lambda d: _with(
        ops.build_positions(route(d["raw_tms"], "ShipmentPositionUpdated"), _shipments(d))[0], _shipments(d), "shipment_id", "shipment_identifier", "inner"
    ),
    "SELECT p.*, shipment_identifier FROM v_shipment_positions p JOIN v_shipments USING (shipment_id) WHERE shipment_id % 40 <> 1",
)
add(
    "OPS-6_completions",
    "shipment_identifier:s arrival_node:s delay_minutes:i completed_at:t",
    lambda d: _with(
        ops.build_completions(route(d["raw_tms"], "TransportCompleted"), _shipments(d))[0], _shipments(d), "shipment_id", "shipment_identifier", "inner"
    ),
    "SELECT c.*, shipment_identifier FROM v_transport_completions c JOIN v_shipments USING (shipment_id) WHERE shipment_id % 40 <> 1",
)
add(
    "OPS-6_deliveries",
    "shipment_identifier:s supply_chain_node:s delivery_status:s received_by:s cargo_product_reference:s delivered_at:t",
    lambda d: _with(
        ops.build_deliveries(route(d["raw_tms"], "DeliveryCompleted"), _shipments(d))[0], _shipments(d), "shipment_id", "shipment_identifier", "inner"
    ),
    """SELECT c.*, shipment_identifier FROM v_deliveries c JOIN (SELECT shipment_id, shipment_identifier FROM v_shipments) s USING (shipment_id) WHERE shipment_id % 40 <> 1""",
)
add(
    "OPS-6_rejected_events",
    "reason:s skipped:i",
    lambda d: writes.reject_counts(
        ops.build_positions(route(d["raw_tms"], "ShipmentPositionUpdated"), _shipments(d))[1],
        ops.build_completions(route(d["raw_tms"], "TransportCompleted"), _shipments(d))[1],
        ops.build_deliveries(route(d["raw_tms"], "DeliveryCompleted"), _shipments(d))[1],
    ),
    """SELECT 'position_without_shipment' AS reason, COUNT(*) AS skipped FROM v_shipment_positions WHERE shipment_id NOT IN (SELECT shipment_id FROM v_shipments WHERE shipment_id % 40 <> 1)
    UNION ALL SELECT 'completion_without_shipment', COUNT(*) FROM v_transport_completions WHERE shipment_id % 40 = 1 HAVING COUNT(*) > 0
    UNION ALL SELECT 'delivery_without_shipment', COUNT(*) FROM v_deliveries WHERE shipment_id % 40 = 1 HAVING COUNT(*) > 0""",
)

# --- joins and aggregation not covered by a report ---------------------------------------

add(
    "JN-3_line_orphans",
    "orphan_orders:i orphan_products:i",
    lambda d: _line_orphans(d),
    """SELECT SUM(CASE WHEN o.order_id IS NULL THEN 1 ELSE 0 END) AS orphan_orders, SUM(CASE WHEN p.product_id IS NULL THEN 1 ELSE 0 END) AS orphan_products
    FROM v_order_items i LEFT JOIN (SELECT * FROM v_orders WHERE delivery_priority <> 'LOW') o USING (order_id) LEFT JOIN (SELECT * FROM v_products WHERE supplier_id IS NOT NULL) p USING (product_id)""",
)


def _line_orphans(d: Driver) -> DataFrame:
    from freightloom.operators.verification import order_item_orphans

    return order_item_orphans(
        d["order_items"], d["orders"].filter("delivery_priority <> 'LOW'"), d["products"].filter("supplier_id IS NOT NULL")
    )


add(
    "SKEW_bounded_lists",
    "node_id:i part:i elements:i first_value:d last_value:d ordered:b",
    lambda d: skew.bounded_lists(
        d["node_processings"].filter("temperature IS NOT NULL"), ["node_id"], F.col("temperature"), "list", F.floor("temperature").cast("long")
    ).select(
        "node_id", "part", F.size("list").alias("elements"), F.element_at("list", 1).alias("first_value"),
        F.element_at("list", -1).alias("last_value"), (F.array_sort("list") == F.col("list")).alias("ordered"),
    ),
    """SELECT node_id, CAST(floor(temperature) AS BIGINT) AS part, COUNT(*) AS elements, MIN(temperature) AS first_value, MAX(temperature) AS last_value, TRUE AS ordered FROM v_node_processings WHERE temperature IS NOT NULL GROUP BY 1, 2""",
)

# --- SQL over the tables -----------------------------------------------------------------


def _by_sql(d: Driver) -> DataFrame:
    """The tables as views, and the key functions by name."""
    keys.register_sql_functions(d.spark)
    for name in ("shipments", "carriers"):
        d[name].createOrReplaceTempView(f"sql_{name}")
    return d.spark.sql(
        "SELECT normalize_key(cargo_product_reference) AS product_code, carrier_name, COUNT(*) AS shipments "
        "FROM sql_shipments JOIN sql_carriers USING (carrier_id) GROUP BY 1, 2"
    )


add(
    "SRC-7_sql_over_tables",
    "product_code:s carrier_name:s shipments:i",
    _by_sql,
    "SELECT upper(cargo_product_reference) AS product_code, carrier_name, COUNT(*) AS shipments FROM v_shipments JOIN v_carriers USING (carrier_id) GROUP BY 1, 2",
)

# --- reports ---------------------------------------------------------------------------

add(
    "RPT-1_table_counts",
    "table_name:s row_count:i",
    lambda d: rpt.table_counts({n: d[n] for n in _COUNTED if n != "transport_product_references"}),
    " UNION ALL ".join(
        f"SELECT '{n}' AS table_name, COUNT(*) AS row_count FROM v_{n}" for n in _COUNTED if n != "transport_product_references"
    ),
)
add(
    "RPT-2_suppliers_by_country",
    "supplier_code:s supplier_name:s country:s",
    lambda d: rpt.in_order(rpt.suppliers_by_country(d["suppliers"]), "suppliers_by_country"),
    "SELECT * FROM v_suppliers",
)
add(
    "RPT-2_customers_by_country",
    "customer_number:s customer_name:s city:s country:s",
    lambda d: rpt.in_order(rpt.customers_by_country(d["customers"]), "customers_by_country"),
    "SELECT * FROM v_customers",
)
add(
    "RPT-3_products_with_supplier",
    "product_code:s product_name:s category:s supplier_name:s origin:s",
    lambda d: rpt.products_with_supplier(d["products"], d["suppliers"]),
    "SELECT product_code, product_name, category, supplier_name, country AS origin FROM v_products JOIN v_suppliers USING (supplier_id)",
)
add(
    "RPT-4_orders_with_customer",
    "order_reference:s customer_name:s delivery_priority:s order_timestamp:t",
    lambda d: rpt.orders_with_customer(d["orders"], d["customers"]),
    "SELECT * FROM v_orders JOIN v_customers USING (customer_id)",
)
add(
    "RPT-5_order_line_values",
    "order_reference:s product_code:s product_name:s quantity:i unit_price:d line_value_eur:d",
    lambda d: rpt.order_line_values(d["order_items"], d["orders"], d["products"]),
    """SELECT order_reference, product_code, product_name, quantity, unit_price, quantity * unit_price AS line_value_eur
    FROM v_order_items JOIN v_orders USING (order_id) JOIN v_products USING (product_id)""",
)
add(
    "RPT-6_customer_volume",
    "customer_name:s orders:i total_quantity:i total_value_eur:d",
    lambda d: rpt.customer_volume(d["customers"], d["orders"], d["order_items"]),
    """SELECT customer_name, COUNT(DISTINCT order_id) AS orders, SUM(quantity) AS total_quantity, SUM(quantity * unit_price) AS total_value_eur
    FROM v_customers JOIN v_orders USING (customer_id) JOIN v_order_items USING (order_id) GROUP BY customer_name""",
)
add(
    "RPT-7_batches_with_product",
    "batch_identifier:s product_code:s product_name:s origin_country:s quantity:i wms_sku:s tms_product_reference:s harvested_at:t",
    lambda d: rpt.batches_with_product(d["batches"], d["products"]),
    "SELECT * FROM v_batches JOIN v_products USING (product_id)",
)
add("RPT-8_skus", "sku:s erp_product_code:s event_timestamp:t", lambda d: rpt.skus(d["warehouse_skus"]), "SELECT * FROM v_warehouse_skus")
add(
    "RPT-8_nodes_in_sequence",
    "node_code:s node_name:s node_type:s region:s sequence_order:i processings:i",
    lambda d: rpt.nodes_in_sequence(d["supply_chain_nodes"]).join(
        rpt.processings_per_node(d["supply_chain_nodes"], d["node_processings"]), ["node_name", "sequence_order"]
    ),
    "SELECT *, (SELECT COUNT(*) FROM v_node_processings p WHERE p.node_id = n.node_id) AS processings FROM v_supply_chain_nodes n",
)
add(
    "RPT-9_processings_per_node",
    "node_name:s sequence_order:i processings:i",
    lambda d: rpt.processings_per_node(d["supply_chain_nodes"], d["node_processings"]),
    "SELECT node_name, sequence_order, COUNT(processing_id) AS processings FROM v_supply_chain_nodes LEFT JOIN v_node_processings USING (node_id) GROUP BY ALL",
)
add(
    "RPT-10_processings_with_node",
    "batch_reference:s sku:s node_name:s status:s temperature:d processed_at:t",
    lambda d: rpt.processings_with_node(d["node_processings"], d["supply_chain_nodes"]),
    "SELECT * FROM v_node_processings JOIN v_supply_chain_nodes USING (node_id)",
)
add(
    "RPT-10_warehouse_breaches",
    "batch_reference:s sku:s node_name:s temperature:d processed_at:t",
    lambda d: rpt.warehouse_breaches(d["node_processings"], d["supply_chain_nodes"]),
    "SELECT * FROM v_node_processings JOIN v_supply_chain_nodes USING (node_id) WHERE temperature < 10 OR temperature > 15",
)
add(
    "RPT-11_carriers",
    "carrier_code:s carrier_name:s event_timestamp:t completed_transports:i",
    lambda d: rpt.carrier_list(d["carriers"]).join(
        rpt.carrier_delay(d["transport_completions"], d["shipments"], d["carriers"]).select("carrier_name", "completed_transports"),
        "carrier_name", "left",
    ),
    """SELECT carrier_code, carrier_name, event_timestamp, n AS completed_transports FROM v_carriers LEFT JOIN (SELECT carrier_id, COUNT(*) AS n FROM v_transport_completions JOIN v_shipments USING (shipment_id) GROUP BY 1) USING (carrier_id)""",
)
add(
    "RPT-11_transport_references",
    "erp_product_code:s transport_product_reference:s",
    lambda d: rpt.transport_references(d["transport_product_references"]),
    "SELECT * FROM v_transport_product_references",
)
add(
    "RPT-11_shipments_with_carrier",
    "shipment_identifier:s source_node:s target_node:s transport_mode:s cargo_product_reference:s carrier_name:s started_at:t estimated_arrival:t",
    lambda d: rpt.shipments_with_carrier(d["shipments"], d["carriers"]),
    "SELECT * FROM v_shipments JOIN v_carriers USING (carrier_id)",
)
_BY_CARRIER = "FROM v_transport_completions JOIN v_shipments USING (shipment_id) JOIN v_carriers USING (carrier_id) GROUP BY carrier_name"
add(
    "RPT-12_carrier_delay",
    "carrier_name:s completed_transports:i avg_delay_minutes:d max_delay_minutes:i",
    lambda d: rpt.carrier_delay(d["transport_completions"], d["shipments"], d["carriers"]),
    f"SELECT carrier_name, COUNT(*) AS completed_transports, {average('SUM(delay_minutes)', 'COUNT(delay_minutes)', 2)} AS avg_delay_minutes, MAX(delay_minutes) AS max_delay_minutes {_BY_CARRIER}",
)
add(
    "RPT-13_delivery_status",
    "delivery_status:s deliveries:i",
    lambda d: rpt.delivery_status_counts(d["deliveries"]),
    "SELECT delivery_status, COUNT(*) AS deliveries FROM v_deliveries GROUP BY 1",
)
add(
    "RPT-14_positions_with_shipment",
    "shipment_identifier:s latitude:d longitude:d container_temperature:d speed_kmh:d recorded_at:t",
    lambda d: rpt.positions_with_shipment(d["shipment_positions"], d["shipments"]),
    "SELECT * FROM v_shipment_positions JOIN v_shipments USING (shipment_id)",
)
add(
    "RPT-14_transit_breaches",
    "shipment_identifier:s container_temperature:d latitude:d longitude:d recorded_at:t",
    lambda d: rpt.transit_breaches(d["shipment_positions"], d["shipments"]),
    "SELECT * FROM v_shipment_positions JOIN v_shipments USING (shipment_id) WHERE container_temperature < 10 OR container_temperature > 15",
)
add(
    "RPT-15_product_keys",
    "erp_product_code:s product_name:s wms_sku:s tms_product_reference:s",
    lambda d: rpt.product_keys(d["products"], d["warehouse_skus"], d["transport_product_references"]),
    """SELECT product_code AS erp_product_code, product_name, sku AS wms_sku, transport_product_reference AS tms_product_reference FROM v_products
    LEFT JOIN v_warehouse_skus w ON w.erp_product_code = product_code LEFT JOIN v_transport_product_references t ON t.erp_product_code = product_code""",
)
_TRACK = """SELECT batch_identifier, product_code, product_name, node_name, status, temperature, processed_at FROM v_batches JOIN v_products USING (product_id)
    LEFT JOIN v_node_processings ON batch_reference = batch_identifier LEFT JOIN v_supply_chain_nodes USING (node_id)"""
_TRACK_SPEC = "batch_identifier:s product_code:s product_name:s node_name:s status:s temperature:d processed_at:t"
add(
    "RPT-16_batch_tracking",
    _TRACK_SPEC,
    lambda d: rpt.batch_tracking(d["batches"], d["products"], d["node_processings"], d["supply_chain_nodes"]),
    _TRACK,
)
add(
    "RPT-17_shipments_per_route",
    "source_node:s target_node:s transport_mode:s shipments:i",
    lambda d: rpt.shipments_per_route(d["shipments"]),
    "SELECT source_node, target_node, transport_mode, COUNT(*) AS shipments FROM v_shipments GROUP BY ALL",
)
add(
    "RPT-17_completion_counts",
    "completed_shipments:i total_completions:i",
    lambda d: rpt.completion_counts(d["transport_completions"]),
    "SELECT COUNT(DISTINCT shipment_id) AS completed_shipments, COUNT(*) AS total_completions FROM v_transport_completions",
)
add(
    "RPT-17_delivery_shares",
    "delivery_status:s deliveries:i share_pct:i",
    lambda d: rpt.delivery_status_shares(d["deliveries"]),
    f"SELECT delivery_status, n AS deliveries, {percent('n', 'total', 0)} AS share_pct FROM (SELECT delivery_status, COUNT(*) AS n FROM v_deliveries GROUP BY 1) CROSS JOIN (SELECT COUNT(*) AS total FROM v_deliveries)",
)
add(
    "RPT-18_temperature_per_node",
    "node_name:s processings:i avg_temp:d min_temp:d max_temp:d breaches:i",
    lambda d: rpt.temperature_per_node(d["node_processings"], d["supply_chain_nodes"]),
    f"""SELECT node_name, COUNT(*) AS processings, {average('SUM(CAST(temperature * 100 AS BIGINT))', 'COUNT(temperature)', 2, 2)} AS avg_temp, MIN(temperature) AS min_temp, MAX(temperature) AS max_temp,
    COUNT(*) FILTER (WHERE temperature < 10 OR temperature > 15) AS breaches FROM v_node_processings JOIN v_supply_chain_nodes USING (node_id) GROUP BY node_name""",
)
add(
    "AG-17_temperature_quartiles",
    "node_name:s q1:d median:d q3:d",
    lambda d: rpt.temperature_quartiles(d["node_processings"], d["supply_chain_nodes"]),
    """SELECT node_name, round(quantile_cont(CAST(temperature AS DOUBLE), 0.25), 6) AS q1, round(quantile_cont(CAST(temperature AS DOUBLE), 0.5), 6) AS median, round(quantile_cont(CAST(temperature AS DOUBLE), 0.75), 6) AS q3
    FROM v_node_processings JOIN v_supply_chain_nodes USING (node_id) WHERE temperature IS NOT NULL GROUP BY node_name""",
)
add(
    "RPT-19_carrier_lateness",
    "carrier_name:s transports:i avg_delay:d max_delay:i much_delayed:i",
    lambda d: rpt.carrier_lateness(d["transport_completions"], d["shipments"], d["carriers"]),
    f"SELECT carrier_name, COUNT(*) AS transports, {average('SUM(delay_minutes)', 'COUNT(delay_minutes)', 1)} AS avg_delay, MAX(delay_minutes) AS max_delay, COUNT(*) FILTER (WHERE delay_minutes > 60) AS much_delayed {_BY_CARRIER}",
)
add(
    "ST-2_worst_carrier",
    "carrier_name:s avg_delay:d",
    lambda d: rpt.worst_carrier(d["transport_completions"], d["shipments"], d["carriers"]),
    f"SELECT carrier_name, {average('SUM(delay_minutes)', 'COUNT(delay_minutes)', 1)} AS avg_delay {_BY_CARRIER} ORDER BY avg_delay DESC, carrier_name LIMIT 1",
)


def _warehouses(d: Driver) -> DataFrame:
    return d.base("nation").selectExpr("n_nationkey AS warehouse_id", "concat('Warehouse ', n_name) AS name", "n_name AS city")


def _fulfilment(d: Driver) -> DataFrame:
    return d["orders"].withColumn("warehouse_id", (F.col("order_id") % 25).cast("int"))


add(
    "RPT-20_fulfilment_orders",
    "order_id:i customer_name:s city:s country:s warehouse:s warehouse_city:s",
    lambda d: rpt.fulfilment_orders(_fulfilment(d), d["customers"], _warehouses(d)),
    """SELECT order_id, customer_name, city, country, 'Warehouse ' || n_name AS warehouse, n_name AS warehouse_city FROM v_orders JOIN v_customers USING (customer_id) JOIN nation ON n_nationkey = order_id % 25""",
)
add(
    "RPT-20_fulfilment_lines",
    "order_id:i product_name:s price:d quantity:i product_id:i",
    lambda d: rpt.fulfilment_lines(d["order_items"], d["products"]),
    "SELECT order_id, product_name, unit_price AS price, quantity, product_id FROM v_order_items JOIN v_products USING (product_id)",
)
add(
    "FN-22_orders_before",
    "order_reference:s order_timestamp:t",
    lambda d: d["orders"].filter(F.col("order_timestamp") < dates.moment(AS_OF) - F.expr("INTERVAL '90' DAY")),
    f"SELECT * FROM v_orders WHERE order_timestamp < TIMESTAMP '{AS_OF}' - INTERVAL 90 DAY",
)
