"""Checked queries: lifecycle documents, manifest, graph, live state, streams."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from checks import adapter
from checks.adapter import LIVE_AS_OF, Driver
from checks.registry import add, average
from freightloom.operators import graph, lifecycle, live, manifest
from freightloom.operators.verification import structure_checks
from freightloom.streaming import live as stream

# --- lifecycle documents -----------------------------------------------------------------


def _shipment(d: Driver) -> tuple[DataFrame, ...]:
    return d["started"], d["positions"], d["completed"], d["delivered"]


def _lifecycle(d: Driver) -> DataFrame:
    return lifecycle.shipment_lifecycle(*_shipment(d))


def _batches(d: Driver) -> DataFrame:
    return lifecycle.batch_documents(d["batch_events"], d["processing_events"], d["supply_chain_nodes"])


_DAY = "CAST(strftime({0}, '%Y%m%d') AS INTEGER)"


_FIRST = "SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY shipment_identifier ORDER BY event_timestamp) AS r FROM {0}) WHERE r = 1"
_DOCS = f"""SELECT s.shipment_identifier, upper(s.cargo_product_reference) AS cargo_product_reference, s.source_node, s.target_node, s.transport_mode, s.carrier_id, s.estimated_arrival,
    s.event_timestamp AS started_at, CASE WHEN f.shipment_identifier IS NOT NULL THEN f.delivery_status WHEN c.shipment_identifier IS NOT NULL THEN 'TRANSPORT_COMPLETED' ELSE 'IN_TRANSIT' END AS delivery_status,
    c.delay_minutes, c.event_timestamp AS completed_at, s.event_timestamp AS created_at,
    COALESCE(GREATEST(p.event_timestamp, c.event_timestamp, f.event_timestamp), s.event_timestamp) AS updated_at, f.event_timestamp AS delivered_at
    FROM ({_FIRST.format('v_started')}) s LEFT JOIN ({_FIRST.format('v_completed')}) c USING (shipment_identifier) LEFT JOIN ({_FIRST.format('v_delivered')}) f USING (shipment_identifier)
    LEFT JOIN (SELECT shipment_identifier, MAX(event_timestamp) AS event_timestamp FROM v_positions GROUP BY 1) p USING (shipment_identifier)"""
_EVENTS = f"""SELECT shipment_identifier, event_timestamp, 1 AS rank, 'ShipmentPositionUpdated' AS event_type FROM v_positions
    UNION ALL SELECT shipment_identifier, started_at, 0, 'TransportStarted' FROM ({_DOCS})
    UNION ALL SELECT shipment_identifier, completed_at, 2, 'TransportCompleted' FROM ({_DOCS}) WHERE completed_at IS NOT NULL
    UNION ALL SELECT shipment_identifier, delivered_at, 3, 'DeliveryCompleted' FROM ({_DOCS}) WHERE delivered_at IS NOT NULL"""

add(
    "DOC-1_shipment_lifecycle",
    "shipment_identifier:s cargo_product_reference:s source_node:s target_node:s transport_mode:s carrier_id:s estimated_arrival:t started_at:t delivery_status:s "
    "delay_minutes:i completed_at:t created_at:t updated_at:t part:i events:s",
    lambda d: _lifecycle(d).join(lifecycle.shipment_events(*_shipment(d)), "shipment_identifier").withColumn("carrier_id", F.col("carrier.carrier_id")).withColumn(
        "events",
        F.array_join(F.transform("events", lambda e: F.concat(F.date_format(e.timestamp, "yyyy-MM-dd HH:mm:ss.SSSSSS"), F.lit(" "), e.event_type)), "|"),
    ),
    f"""SELECT d.*, part, events FROM ({_DOCS}) d JOIN (SELECT shipment_identifier, {_DAY.format('event_timestamp')} AS part, string_agg(strftime(event_timestamp, '%Y-%m-%d %H:%M:%S.%f') || ' ' || event_type, '|' ORDER BY event_timestamp, rank) AS events
    FROM ({_EVENTS}) GROUP BY 1, 2) USING (shipment_identifier)""",
)
add(
    "DOC-1_embedded_positions",
    "shipment_identifier:s event_timestamp:t latitude:d longitude:d container_temperature:d speed_kmh:d",
    lambda d: lifecycle.shipment_events(*_shipment(d))
    .select("shipment_identifier", F.explode("events").alias("e"))
    .filter("e.event_type = 'ShipmentPositionUpdated'")
    .select("shipment_identifier", F.col("e.timestamp").alias("event_timestamp"), "e.latitude", "e.longitude", "e.container_temperature", "e.speed_kmh"),
    f"SELECT * FROM v_positions WHERE shipment_identifier IN (SELECT shipment_identifier FROM v_started)",
)
_NODE_OF = "(SELECT n.*, node_code FROM v_node_processings n JOIN v_supply_chain_nodes USING (node_id))"
add(
    "DOC-2_node_documents",
    "batch_reference:s supply_chain_node:s sku:s canonical_product_code:s temperature:d temperature_within_range:b status:s processed_at:t temperature_ok:b min_allowed:d max_allowed:d",
    lambda d: lifecycle.node_documents(d["processing_events"]).select("*", "quality_flags.*"),
    f"""SELECT batch_reference, node_code AS supply_chain_node, sku, replace(sku, '_', '-') AS canonical_product_code, temperature, COALESCE(temperature BETWEEN 10 AND 15, FALSE) AS temperature_within_range, status, processed_at,
    COALESCE(temperature BETWEEN 10 AND 15, FALSE) AS temperature_ok, 10.0 AS min_allowed, 15.0 AS max_allowed FROM {_NODE_OF}""",
)
add(
    "DOC-3_batch_tracking",
    "batch_identifier:s erp_product_code:s wms_sku:s tms_product_reference:s origin_country:s quantity:i harvested_at:t current_node:s part:i nodes_processed:s updated_at:t",
    lambda d: _batches(d).join(lifecycle.batch_stations(d["processing_events"]), "batch_identifier", "left").withColumn(
        "nodes_processed",
        F.array_join(
            F.transform("nodes_processed", lambda n: F.concat_ws(" ", F.date_format(n.processed_at, "yyyy-MM-dd"), n.node, F.coalesce(n.temperature.cast("string"), F.lit("-")), n.status)), "|"
        ),
    ),
    f"""SELECT COALESCE(b.batch_identifier, n.batch_reference) AS batch_identifier, 'BAN-' || b.product_id AS erp_product_code, wms_sku, tms_product_reference, origin_country, quantity, harvested_at,
    COALESCE(n.current_node, b.supply_chain_node) AS current_node, p.part, p.nodes AS nodes_processed, n.updated_at FROM v_batches b FULL JOIN (
    SELECT batch_reference, MAX(processed_at) AS updated_at, arg_max(node_code, (processed_at, node_id)) AS current_node FROM {_NODE_OF} GROUP BY 1) n ON n.batch_reference = b.batch_identifier
    LEFT JOIN (SELECT batch_reference, {_DAY.format('processed_at')} AS part, string_agg(strftime(processed_at, '%Y-%m-%d') || ' ' || node_code || ' ' || COALESCE(CAST(temperature AS VARCHAR), '-') || ' ' || status, '|' ORDER BY processed_at, node_code) AS nodes
    FROM {_NODE_OF} GROUP BY 1, 2) p ON p.batch_reference = n.batch_reference""",
)
add(
    "DOC-4_order_documents",
    "order_reference:s customer_number:s customer_name:s delivery_priority:s event_timestamp:t items:i first_product:s",
    lambda d: lifecycle.order_documents(d["order_events"]).select(
        "order_reference", "customer.customer_number", "customer.customer_name", "delivery_priority", "event_timestamp",
        F.size("items").alias("items"), F.try_element_at("items", F.lit(1))["product_code"].alias("first_product"),
    ),
    """SELECT order_reference, customer_number, customer_name, delivery_priority, order_timestamp AS event_timestamp, COALESCE(n, 0) AS items, first_product FROM v_orders JOIN v_customers USING (customer_id)
    LEFT JOIN (SELECT l_orderkey, COUNT(*) AS n, 'BAN_' || arg_min(l_partkey, l_linenumber) AS first_product FROM v_l1 GROUP BY 1) ON l_orderkey = order_id""",
)
add(
    "DOC-5_unexpired",
    "shipment_identifier:s created_at:t",
    lambda d: lifecycle.unexpired_documents(_lifecycle(d), LIVE_AS_OF.replace(month=3, day=31, hour=12)),
    f"SELECT shipment_identifier, created_at FROM ({_DOCS}) WHERE created_at + INTERVAL 90 DAY > TIMESTAMP '2024-03-31 12:00:00'",
)
add(
    "FLT-7_delayed_shipments",
    "shipment_identifier:s source_node:s target_node:s delay_minutes:i",
    lambda d: lifecycle.delayed_shipments(_lifecycle(d)),
    f"SELECT * FROM ({_DOCS}) WHERE delay_minutes > 60",
)
add(
    "FLT-7_cool_batches",
    "batch_reference:s temperature:d processed_at:t",
    lambda d: lifecycle.cool_batches(lifecycle.node_documents(d["processing_events"]), "AFRICA_COLD_STORAGE", 12.0),
    "SELECT batch_reference, temperature, processed_at FROM v_node_processings WHERE node_id = 4 AND temperature < 12",
)
add(
    "FLT-7_range_violations",
    "batch_reference:s supply_chain_node:s temperature:d",
    lambda d: lifecycle.range_violations(lifecycle.node_documents(d["processing_events"])),
    f"SELECT batch_reference, node_code AS supply_chain_node, temperature FROM {_NODE_OF} WHERE temperature IS NULL OR temperature NOT BETWEEN 10 AND 15",
)
add(
    "VER-12_structure",
    "check_name:s documents:i broken:i",
    lambda d: structure_checks(
        _lifecycle(d), lifecycle.shipment_events(*_shipment(d)), _batches(d), lifecycle.batch_stations(d["processing_events"]),
        lifecycle.node_documents(d["processing_events"]),
    ).withColumnRenamed("check", "check_name"),
    """SELECT 'shipment_events.events' AS check_name, COUNT(DISTINCT shipment_identifier) AS documents, 0 AS broken FROM v_started
    UNION ALL SELECT 'batch_tracking.nodes_processed', COUNT(*), 0 FROM (SELECT batch_identifier FROM v_batches UNION SELECT batch_reference FROM v_node_processings)
    UNION ALL SELECT 'node_events.quality_flags', COUNT(*), 0 FROM v_node_processings""",
)

# --- manifest -----------------------------------------------------------------------------------


def _ship_events(d: Driver) -> DataFrame:
    """Transport starts of the shipments."""
    return d["shipments"].selectExpr(
        "shipment_identifier", "source_node", "target_node", "transport_mode", "cargo_product_reference",
        "named_struct('carrier_id', CASE WHEN carrier_id IS NOT NULL THEN concat('CAR-', carrier_id) END, 'carrier_name', CASE WHEN carrier_id IS NOT NULL THEN concat('Carrier ', carrier_id) END) AS carrier",
        "estimated_arrival", "started_at AS event_timestamp",
    )


def _delivery_events(d: Driver) -> DataFrame:
    codes = d["shipments"].select("shipment_id", "shipment_identifier")
    return d["deliveries"].join(codes, "shipment_id").withColumn("event_timestamp", F.col("delivered_at"))


def _manifest(d: Driver) -> DataFrame:
    return manifest.manifest(_ship_events(d), _delivery_events(d), d["processing_events"])


_SHOWN = "strftime({0}, '%d.%m.%Y %H:%M')"
_CARRIER_SQL = "COALESCE('Carrier ' || carrier_id, '–')"
add(
    "MAN-1_delivery_notes",
    "entity_type:s entity_key:s document_type:s bucket:s object_path:s tag_carrier:s carrier_name:s carrier_id:s product_code:s started:s estimated_arrival:s source_node:s target_node:s",
    lambda d: manifest.delivery_notes(_ship_events(d)).select(
        "*", F.col("tags")["carrier"].alias("tag_carrier"),
        *[F.col("fields")[n].alias(n) for n in ("carrier_name", "carrier_id", "product_code", "started", "estimated_arrival", "source_node", "target_node")],
    ),
    f"""SELECT 'SHIPMENT' AS entity_type, shipment_identifier AS entity_key, 'delivery_note' AS document_type, 'delivery-notes' AS bucket, 'shipments/' || shipment_identifier || '/delivery_note.pdf' AS object_path,
    COALESCE('Carrier ' || carrier_id, '') AS tag_carrier, {_CARRIER_SQL} AS carrier_name, COALESCE('CAR-' || carrier_id, '–') AS carrier_id, upper(cargo_product_reference) AS product_code,
    {_SHOWN.format('started_at')} AS started, {_SHOWN.format('estimated_arrival')} AS estimated_arrival, source_node, target_node FROM v_shipments""",
)
add(
    "MAN-2_sea_documents",
    "entity_key:s document_type:s bucket:s object_path:s number:s route:s import_number:s phyto:s destination:s",
    lambda d: manifest.sea_documents(_ship_events(d)).select(
        "*", F.col("fields")["number"].alias("number"), F.col("tags")["route"].alias("route"), F.col("fields")["import_number"].alias("import_number"),
        F.col("fields")["phytosanitary_number"].alias("phyto"), F.col("tags")["destination"].alias("destination"),
    ),
    """SELECT shipment_identifier AS entity_key, 'bill_of_lading' AS document_type, 'transport-docs' AS bucket, 'shipments/' || shipment_identifier || '/bill_of_lading.pdf' AS object_path, 'BL-' || right(shipment_identifier, 8) AS number,
    source_node || '->' || target_node AS route, NULL AS import_number, NULL AS phyto, NULL AS destination FROM v_shipments WHERE transport_mode = 'SEA_FREIGHT'
    UNION ALL SELECT shipment_identifier, 'customs_clearance', 'transport-docs', 'shipments/' || shipment_identifier || '/customs_clearance.pdf', 'CC-EU-' || right(shipment_identifier, 8), NULL,
    'DE' || replace(upper(right(shipment_identifier, 12)), '-', ''), 'PHYTO-' || upper(right(shipment_identifier, 6)), 'EU' FROM v_shipments WHERE transport_mode = 'SEA_FREIGHT'""",
)
add(
    "MAN-3_invoices",
    "entity_key:s object_path:s product_code:s received_by:s delivered:s source_node:s carrier_name:s transport_mode:s",
    lambda d: manifest.invoices(_delivery_events(d), _ship_events(d).filter("cargo_product_reference <> 'ban-7'")).select(
        "entity_key", "object_path", *[F.col("fields")[n].alias(n) for n in ("product_code", "received_by", "delivered", "source_node", "carrier_name", "transport_mode")]
    ),
    f"""SELECT s.shipment_identifier AS entity_key, 'shipments/' || s.shipment_identifier || '/invoice.pdf' AS object_path, upper(d.cargo_product_reference) AS product_code, COALESCE(received_by, '–') AS received_by, {_SHOWN.format('delivered_at')} AS delivered,
    CASE WHEN s.cargo_product_reference <> 'ban-7' THEN source_node ELSE '–' END AS source_node, CASE WHEN s.cargo_product_reference <> 'ban-7' THEN {_CARRIER_SQL} ELSE '–' END AS carrier_name,
    CASE WHEN s.cargo_product_reference <> 'ban-7' THEN transport_mode ELSE '–' END AS transport_mode FROM v_deliveries d JOIN v_shipments s USING (shipment_id) WHERE delivery_status = 'SUCCESSFUL'""",
)
add(
    "MAN-4_quality_certificates",
    "entity_key:s object_path:s product_code:s temperature:s result:s release:s",
    lambda d: manifest.quality_certificates(d["processing_events"]).select(
        "entity_key", "object_path", *[F.col("fields")[n].alias(n) for n in ("product_code", "temperature", "result", "release")]
    ),
    """SELECT batch_reference AS entity_key, 'batches/' || batch_reference || '/quality_certificate.pdf' AS object_path, replace(sku, '_', '-') AS product_code, COALESCE(temperature || ' °C', '–') AS temperature,
    CASE WHEN temperature BETWEEN 10 AND 15 THEN 'BESTANDEN ✓' ELSE 'NICHT BESTANDEN ✗' END AS result, CASE WHEN temperature BETWEEN 10 AND 15 THEN 'Ja' ELSE 'Nein – Quarantäne' END AS release FROM v_node_processings WHERE node_id = 3""",
)
_TYPES = """SELECT 'SHIPMENT' AS entity_type, 'delivery_note' AS document_type, 'delivery-notes' AS bucket, shipment_identifier AS entity_key FROM v_shipments
    UNION ALL SELECT 'SHIPMENT', 'bill_of_lading', 'transport-docs', shipment_identifier FROM v_shipments WHERE transport_mode = 'SEA_FREIGHT'
    UNION ALL SELECT 'SHIPMENT', 'customs_clearance', 'transport-docs', shipment_identifier FROM v_shipments WHERE transport_mode = 'SEA_FREIGHT'
    UNION ALL SELECT 'SHIPMENT', 'invoice', 'invoices', shipment_identifier FROM v_shipments JOIN v_deliveries USING (shipment_id) WHERE delivery_status = 'SUCCESSFUL'
    UNION ALL SELECT 'BATCH', 'quality_certificate', 'batch-certificates', batch_reference FROM v_node_processings WHERE node_id = 3"""
add("MAN-5_by_type", "document_type:s bucket:s documents:i", lambda d: manifest.manifest_by_type(_manifest(d)), f"SELECT document_type, bucket, COUNT(*) AS documents FROM ({_TYPES}) GROUP BY ALL")
add("MAN-5_by_entity", "entity_type:s documents:i", lambda d: manifest.manifest_by_entity(_manifest(d)), f"SELECT entity_type, COUNT(*) AS documents FROM ({_TYPES}) GROUP BY ALL")
add(
    "MAN-5_paths",
    "entity_type:s entity_key:s document_type:s full_path:s",
    lambda d: manifest.full_paths(_manifest(d)),
    f"SELECT entity_type, entity_key, document_type, bucket || '/' || CASE entity_type WHEN 'BATCH' THEN 'batches/' ELSE 'shipments/' END || entity_key || '/' || document_type || '.pdf' AS full_path FROM ({_TYPES})",
)
add(
    "MAN-6_missing_notes",
    "shipment_identifier:s",
    lambda d: manifest.missing_notes(d["shipments"], manifest.delivery_notes(_ship_events(d).filter("carrier.carrier_id IS NOT NULL"))),
    "SELECT shipment_identifier FROM v_shipments WHERE carrier_id IS NULL",
)


def _heads(d: Driver) -> DataFrame:
    return d["orders"].join(d["customers"], "customer_id").selectExpr(
        "order_id", "customer_name", "city", "concat('Warehouse ', order_id % 25) AS warehouse"
    )


add(
    "MAN-7_order_texts",
    "order_id:i part:i invoice_text:s delivery_text:s total:d",
    lambda d: manifest.order_texts(_heads(d), d["order_items"].withColumn("position", F.expr("CAST(item_id % 8 - 1 AS INT)")), d["products"]),
    r"""SELECT order_id, 0 AS part, 'INVOICE ' || order_id || chr(10) || customer_name || ' (' || city || ')' || chr(10) || chr(10) || string_agg(product_name || ' x ' || quantity || ' = ' || COALESCE(CAST(CAST(quantity * unit_price AS DECIMAL(18,2)) AS VARCHAR), '–'), chr(10) ORDER BY product_name, product_id, quantity)
    || chr(10) || chr(10) || 'TOTAL: ' || COALESCE(CAST(CAST(SUM(quantity * unit_price) AS DECIMAL(18,2)) AS VARCHAR), '–') AS invoice_text, 'DELIVERY ' || order_id || chr(10) || 'Warehouse: Warehouse ' || (order_id % 25) || chr(10) || chr(10) || string_agg(product_name || ' -> ' || quantity, chr(10) ORDER BY product_name, product_id, quantity) AS delivery_text,
    SUM(quantity * unit_price) AS total FROM v_orders JOIN v_customers USING (customer_id) JOIN v_order_items USING (order_id) JOIN v_products USING (product_id) GROUP BY order_id, customer_name, city""",
)

# --- graph ------------------------------------------------------------------------------------------


def _graph(d: Driver) -> tuple[DataFrame, DataFrame]:
    return graph.graph_nodes(d.tables), graph.graph_edges(d.tables)


add(
    "GR-1_nodes",
    "label:s id:s name:s",
    lambda d: _graph(d)[0].select(
        "label", "id", F.coalesce(*[F.col("properties")[n] for n in ("node_name", "supplier_name", "customer_name", "product_name", "carrier_name", "delivery_priority", "product_code", "transport_mode")]).alias("name")
    ),
    """SELECT 'SupplyChainNode' AS label, node_code AS id, graph_name AS name FROM v_supply_chain_nodes UNION ALL SELECT 'Supplier', supplier_code, supplier_name FROM v_suppliers UNION ALL SELECT 'Customer', customer_number, customer_name FROM v_customers
    UNION ALL SELECT 'Product', product_code, product_name FROM v_products UNION ALL SELECT 'Carrier', carrier_code, carrier_name FROM v_carriers UNION ALL SELECT 'Order', order_reference, delivery_priority FROM v_orders
    UNION ALL SELECT 'Batch', batch_identifier, 'BAN-' || product_id FROM v_batches UNION ALL SELECT 'Shipment', shipment_identifier, transport_mode FROM v_shipments""",
)
add(
    "GR-2_master_edges",
    "type:s src:s dst:s transport_mode:s",
    lambda d: graph.master_edges(d.tables).withColumn("transport_mode", F.col("properties")["transport_mode"]),
    """SELECT 'SUPPLIES' AS type, supplier_code AS src, product_code AS dst, NULL AS transport_mode FROM v_products JOIN v_suppliers USING (supplier_id) UNION ALL SELECT 'DELIVERS_TO', supplier_code, 'BANANA_PLANTATION', NULL FROM v_suppliers
    UNION ALL SELECT 'RECEIVES_FROM', customer_number, 'RETAIL_STORE', NULL FROM v_customers UNION ALL SELECT 'CONNECTED_TO', source_node, target_node, transport_mode FROM v_topology
    UNION ALL SELECT 'OPERATES_ON', carrier_code, node_code, transport_mode FROM v_carriers JOIN v_carrier_node_types USING (carrier_code) JOIN v_supply_chain_nodes USING (node_type)""",
)
_CONTAINS = "(SELECT DISTINCT order_reference, product_code, quantity, unit_price FROM v_order_items JOIN v_orders USING (order_id) JOIN v_products USING (product_id))"
add(
    "GR-3_order_edges",
    "type:s src:s dst:s quantity:i unit_price:d",
    lambda d: graph.order_edges(d.tables).select(
        "type", "src", "dst", F.col("properties")["quantity"].cast("int").alias("quantity"), F.col("properties")["unit_price"].cast("decimal(10,2)").alias("unit_price")
    ),
    f"""SELECT 'PLACED' AS type, customer_number AS src, order_reference AS dst, NULL AS quantity, NULL AS unit_price FROM v_orders JOIN v_customers USING (customer_id)
    UNION ALL SELECT 'CONTAINS', order_reference, product_code, quantity, unit_price FROM {_CONTAINS}""",
)
_OP = "(SELECT DISTINCT order_reference, product_id FROM v_order_items JOIN v_orders USING (order_id))"
add(
    "GR-4_triggered_degrees",
    "id:s degree:i",
    lambda d: graph.out_degrees(graph.hub_edges(d.tables), "TRIGGERED"),
    f"SELECT order_reference AS id, SUM(n) AS degree FROM {_OP} JOIN (SELECT product_id, COUNT(*) AS n FROM v_batches GROUP BY 1) USING (product_id) GROUP BY 1",
)
add(
    "GR-5_shipment_edges",
    "type:s src:s dst:s",
    lambda d: graph.shipment_edges(d.tables),
    """SELECT 'FROM' AS type, shipment_identifier AS src, source_node AS dst FROM v_shipments UNION ALL SELECT 'TO', shipment_identifier, target_node FROM v_shipments UNION ALL SELECT 'TRANSPORTED_BY', shipment_identifier, carrier_code FROM v_shipments JOIN v_carriers USING (carrier_id)""",
)
add(
    "GR-5_transported_via_degrees",
    "id:s degree:i",
    lambda d: graph.out_degrees(graph.hub_edges(d.tables), "TRANSPORTED_VIA"),
    "SELECT batch_identifier AS id, n AS degree FROM v_batches JOIN (SELECT cargo_product_reference, COUNT(*) AS n FROM v_shipments GROUP BY 1) ON cargo_product_reference = tms_product_reference",
)
add(
    "GR-6_delivered_to_degrees",
    "id:s degree:i",
    lambda d: graph.out_degrees(graph.hub_edges(d.tables), "DELIVERED_TO"),
    """SELECT shipment_identifier AS id, n AS degree FROM v_shipments s JOIN (SELECT shipment_id FROM v_deliveries) USING (shipment_id) JOIN (SELECT 'ban-' || product_id AS ref, COUNT(DISTINCT customer_id) AS n FROM v_order_items JOIN v_orders USING (order_id)
    WHERE product_id IN (SELECT product_id FROM v_batches) GROUP BY 1) ON ref = s.cargo_product_reference""",
)
add(
    "GR-6_delivered_to_ends",
    "side:s hub:s id:s delivery_status:s received_by:s",
    lambda d: graph.hub_edges(d.tables).filter("type = 'DELIVERED_TO'").select(
        "side", "hub", "id", F.col("properties")["delivery_status"].alias("delivery_status"), F.col("properties")["received_by"].alias("received_by")
    ),
    """SELECT 'src' AS side, upper(s.cargo_product_reference) AS hub, shipment_identifier AS id, delivery_status, received_by FROM v_shipments s JOIN (SELECT shipment_id, delivery_status, received_by FROM v_deliveries) USING (shipment_id)
    WHERE s.cargo_product_reference IN (SELECT tms_product_reference FROM v_batches)
    UNION ALL SELECT DISTINCT 'dst', 'BAN-' || product_id, customer_number, NULL, NULL FROM v_order_items JOIN v_orders USING (order_id) JOIN v_customers USING (customer_id) WHERE product_id IN (SELECT product_id FROM v_batches)""",
)
add(
    "GR-7_processed_at",
    "src:s dst:s temperature:d status:s processed_at:s",
    lambda d: graph.processing_edges(d.tables).select(
        "src", "dst", F.col("properties")["temperature"].cast("decimal(5,2)").alias("temperature"), F.col("properties")["status"].alias("status"), F.col("properties")["processed_at"].alias("processed_at")
    ),
    f"SELECT batch_reference AS src, node_code AS dst, temperature, status, strftime(processed_at, '%Y-%m-%d %H:%M:%S') AS processed_at FROM {_NODE_OF} WHERE batch_reference IN (SELECT batch_identifier FROM v_batches)",
)
add(
    "GR-8_node_counts",
    "label:s nodes:i",
    lambda d: graph.node_counts(_graph(d)[0]),
    " UNION ALL ".join(
        f"SELECT '{label}' AS label, COUNT(*) AS nodes FROM v_{t}"
        for label, t in (("SupplyChainNode", "supply_chain_nodes"), ("Supplier", "suppliers"), ("Customer", "customers"), ("Product", "products"), ("Carrier", "carriers"), ("Order", "orders"), ("Batch", "batches"), ("Shipment", "shipments"))
    ),
)
add(
    "GR-8_edge_counts",
    "type:s edges:i",
    lambda d: graph.edge_counts(_graph(d)[1], graph.hub_edges(d.tables)),
    f"""SELECT 'SUPPLIES' AS type, COUNT(*) AS edges FROM v_products WHERE supplier_id IS NOT NULL UNION ALL SELECT 'DELIVERS_TO', COUNT(*) FROM v_suppliers UNION ALL SELECT 'RECEIVES_FROM', COUNT(*) FROM v_customers
    UNION ALL SELECT 'CONNECTED_TO', COUNT(*) FROM v_topology UNION ALL SELECT 'OPERATES_ON', COUNT(*) FROM v_carrier_node_types JOIN v_supply_chain_nodes USING (node_type) UNION ALL SELECT 'PLACED', COUNT(*) FROM v_orders
    UNION ALL SELECT 'CONTAINS', COUNT(*) FROM {_CONTAINS} UNION ALL SELECT 'FROM', COUNT(*) FROM v_shipments UNION ALL SELECT 'TO', COUNT(*) FROM v_shipments UNION ALL SELECT 'TRANSPORTED_BY', COUNT(carrier_id) FROM v_shipments
    UNION ALL SELECT 'PROCESSED_AT', COUNT(*) FROM v_node_processings WHERE batch_reference IN (SELECT batch_identifier FROM v_batches)
    UNION ALL SELECT 'TRIGGERED', SUM(a * b) FROM (SELECT product_id, COUNT(*) AS a FROM {_OP} GROUP BY 1) JOIN (SELECT product_id, COUNT(*) AS b FROM v_batches GROUP BY 1) USING (product_id)
    UNION ALL SELECT 'TRANSPORTED_VIA', SUM(a * b) FROM (SELECT cargo_product_reference AS r, COUNT(*) AS a FROM v_shipments GROUP BY 1) JOIN (SELECT tms_product_reference AS r, COUNT(*) AS b FROM v_batches GROUP BY 1) USING (r)
    UNION ALL SELECT 'DELIVERED_TO', SUM(a * b) FROM (SELECT cargo_product_reference AS r, COUNT(*) AS a FROM v_deliveries GROUP BY 1) JOIN (SELECT 'ban-' || product_id AS r, COUNT(DISTINCT customer_id) AS b FROM v_order_items JOIN v_orders USING (order_id) WHERE product_id IN (SELECT product_id FROM v_batches) GROUP BY 1) USING (r)""",
)
add(
    "GR-9_shortest_path",
    "stations:s modes:s total_weight:d hops:i",
    lambda d: graph.shortest_path(graph.route_edges(d["shipments"]), "BANANA_PLANTATION", "RETAIL_STORE").select(
        F.array_join("stations", "|").alias("stations"), F.array_join("modes", "|").alias("modes"), "total_weight", "hops"
    ),
    """SELECT stations, modes, total_weight, hops FROM (WITH RECURSIVE edge AS (SELECT source_node, target_node, transport_mode, MIN(epoch(estimated_arrival - started_at)) / 3600.0 AS w FROM v_shipments GROUP BY 1, 2, 3),
    walk AS (SELECT 'BANANA_PLANTATION' AS place, 'BANANA_PLANTATION' AS stations, '' AS modes, CAST(0 AS DOUBLE) AS total_weight, 0 AS hops
    UNION ALL SELECT target_node, stations || '|' || target_node, CASE WHEN modes = '' THEN transport_mode ELSE modes || '|' || transport_mode END, total_weight + w, hops + 1 FROM walk JOIN edge ON source_node = place WHERE hops < 20)
    SELECT * FROM walk WHERE place = 'RETAIL_STORE' ORDER BY hops LIMIT 1)""",
)
_KNOWN = f"(SELECT p.*, graph_name, sequence_order FROM v_node_processings p JOIN v_supply_chain_nodes USING (node_id) WHERE batch_reference IN (SELECT batch_identifier FROM v_batches))"
add(
    "GR-10_batch_path",
    "batch_identifier:s node_name:s sequence_order:i temperature:d status:s processed_at:t cold_chain:s",
    lambda d: graph.batch_path(*_graph(d)),
    f"SELECT batch_reference AS batch_identifier, graph_name AS node_name, sequence_order, temperature, status, processed_at, CASE WHEN temperature BETWEEN 10 AND 15 THEN 'OK' ELSE 'KUEHLKETTENBRUCH' END AS cold_chain FROM {_KNOWN}",
)
add(
    "GR-11_chain_of_one_order",
    "customer_name:s order_reference:s batch:s shipment:s transport_mode:s carrier_name:s",
    lambda d: graph.fulfilment_chain(*_graph(d), graph.hub_edges(d.tables), "ORD-7"),
    """SELECT DISTINCT customer_name, order_reference, batch_identifier AS batch, shipment_identifier AS shipment, transport_mode, carrier_name FROM v_orders JOIN v_customers USING (customer_id) JOIN v_order_items USING (order_id) JOIN v_batches b USING (product_id)
    JOIN v_shipments ON cargo_product_reference = b.tms_product_reference JOIN v_carriers USING (carrier_id) WHERE order_reference = 'ORD-7'""",
)
add(
    "GR-11_chain_ends",
    "kind:s id:s carrier_code:s",
    lambda d: graph.fulfilment_chain_ends(_graph(d)[1], graph.hub_edges(d.tables), "ORD-7").select("kind", "id", "carrier_code").distinct(),
    """WITH own AS (SELECT DISTINCT product_id FROM v_orders JOIN v_order_items USING (order_id) WHERE order_reference = 'ORD-7')
    SELECT 'batch' AS kind, batch_identifier AS id, NULL AS carrier_code FROM v_batches JOIN own USING (product_id)
    UNION ALL SELECT 'shipment', shipment_identifier, carrier_code FROM v_shipments JOIN v_carriers USING (carrier_id) WHERE CAST(substr(cargo_product_reference, 5) AS BIGINT) IN (SELECT product_id FROM own)""",
)
add(
    "GR-11_chain_summary",
    "order_reference:s batches:i shipments:i",
    lambda d: graph.fulfilment_chain_summary(_graph(d)[1], graph.hub_edges(d.tables)),
    f"""SELECT order_reference, SUM(b) AS batches, SUM(s) AS shipments FROM {_OP} JOIN (SELECT product_id, COUNT(*) AS b FROM v_batches GROUP BY 1) USING (product_id)
    JOIN (SELECT CAST(substr(cargo_product_reference, 5) AS BIGINT) AS product_id, COUNT(*) AS s FROM v_shipments WHERE carrier_id IS NOT NULL GROUP BY 1) USING (product_id) GROUP BY 1""",
)
_OPC = f"{_CONTAINS} JOIN v_orders USING (order_reference) JOIN v_customers USING (customer_id)"
add("GR-12_order_products", "customer_number:s order_reference:s product_code:s delivery_priority:s", lambda d: graph.order_products(*_graph(d)), f"SELECT customer_number, order_reference, product_code, delivery_priority FROM {_OPC}")
add(
    "GR-13_carrier_overview",
    "carrier_code:s carrier_name:s shipments:i transport_modes:s",
    lambda d: graph.carrier_overview(*_graph(d)).withColumn("transport_modes", F.array_join("transport_modes", "|")),
    "SELECT carrier_code, carrier_name, COUNT(*) AS shipments, string_agg(DISTINCT transport_mode, '|' ORDER BY transport_mode) AS transport_modes FROM v_shipments JOIN v_carriers USING (carrier_id) GROUP BY ALL",
)
add("GR-14_supplier_coverage", "product_code:s product_name:s supplier_code:s supplier_name:s", lambda d: graph.supplier_coverage(*_graph(d)), "SELECT * FROM v_products JOIN v_suppliers USING (supplier_id)")
add("GR-14_without_supplier", "products_without_supplier:i", lambda d: graph.products_without_supplier(*_graph(d)), "SELECT COUNT(*) AS products_without_supplier FROM v_products WHERE supplier_id IS NULL")
_SUPPLIED = f"{_OPC} JOIN v_products USING (product_code) JOIN v_suppliers USING (supplier_id)"
add("GR-15_supplier_reach", "supplier_name:s customers:i orders:i", lambda d: graph.supplier_reach(*_graph(d)), f"SELECT supplier_name, COUNT(DISTINCT customer_number) AS customers, COUNT(*) AS orders FROM {_SUPPLIED} GROUP BY 1")
add("GR-15_supplier_customer_pairs", "supplier_name:s customer_name:s orders:i", lambda d: graph.supplier_customer_pairs(*_graph(d)), f"SELECT supplier_name, customer_name, COUNT(*) AS orders FROM {_SUPPLIED} GROUP BY ALL")
add(
    "GR-16_sea_freight_delay",
    "carrier_name:s shipments:i avg_delay_minutes:d max_delay_minutes:i",
    lambda d: graph.sea_freight_delay(*_graph(d), d["transport_completions"], d["shipments"]),
    f"""SELECT carrier_name, COUNT(*) AS shipments, {average('SUM(delay_minutes)', 'COUNT(delay_minutes)', 2)} AS avg_delay_minutes, MAX(delay_minutes) AS max_delay_minutes
    FROM v_shipments JOIN v_carriers USING (carrier_id) LEFT JOIN v_transport_completions USING (shipment_id) WHERE transport_mode = 'SEA_FREIGHT' GROUP BY 1""",
)
add("GR-17_breaches", "batch_identifier:s node_name:s temperature:d processed_at:t", lambda d: graph.cold_chain_breaches(*_graph(d)), f"SELECT batch_reference AS batch_identifier, graph_name AS node_name, temperature, processed_at FROM {_KNOWN} WHERE temperature < 10 OR temperature > 15")
add(
    "GR-18_supply_listing",
    "supplier_name:s product_name:s order_reference:s delivery_priority:s customer_name:s",
    lambda d: graph.supply_listing(*_graph(d)),
    f"SELECT supplier_name, product_name, order_reference, delivery_priority, customer_name FROM {_SUPPLIED}",
)
add(
    "GR-19_carrier_routes",
    "carrier_name:s source_name:s target_name:s transport_mode:s trips:i",
    lambda d: graph.carrier_routes(*_graph(d)),
    "SELECT carrier_name, a.graph_name AS source_name, b.graph_name AS target_name, transport_mode, COUNT(*) AS trips FROM v_shipments JOIN v_carriers USING (carrier_id) JOIN v_supply_chain_nodes a ON a.node_code = source_node JOIN v_supply_chain_nodes b ON b.node_code = target_node GROUP BY ALL",
)
add(
    "GR-20_station_temperature",
    "node_name:s sequence_order:i avg_temp:d min_temp:d max_temp:d",
    lambda d: graph.station_temperature(*_graph(d)),
    f"SELECT graph_name AS node_name, sequence_order, {average('SUM(CAST(temperature * 100 AS BIGINT))', 'COUNT(temperature)', 2, 2)} AS avg_temp, MIN(temperature) AS min_temp, MAX(temperature) AS max_temp FROM {_KNOWN} GROUP BY ALL",
)
add(
    "GR-21_stations",
    "node_code:s node_name:s node_type:s sequence_order:i processings:i",
    lambda d: graph.stations(_graph(d)[0]).join(
        graph.processing_edges(d.tables).groupBy(F.col("dst").alias("node_code")).agg(F.count("*").alias("processings")), "node_code", "left"
    ).na.fill(0, ["processings"]),
    f"SELECT node_code, graph_name AS node_name, node_type, sequence_order, (SELECT COUNT(*) FROM {_KNOWN} k WHERE k.node_id = n.node_id) AS processings FROM v_supply_chain_nodes n",
)
add(
    "GR-21_supplier_codes",
    "label:s part:i total:i ids:s",
    lambda d: graph.collected_codes(_graph(d)[0], "Supplier").withColumn("ids", F.array_join("ids", "|")),
    "SELECT 'Supplier' AS label, CAST(regexp_extract(supplier_code, '([0-9]+)[^0-9]*$', 1) AS BIGINT) // 1000 AS part, SUM(COUNT(*)) OVER () AS total, string_agg(supplier_code, '|' ORDER BY supplier_code) AS ids FROM v_suppliers GROUP BY 2",
)
add(
    "GR-21_product_codes",
    "label:s part:i total:i ids:s",
    lambda d: graph.collected_codes(_graph(d)[0], "Product").withColumn("ids", F.array_join("ids", "|")),
    "SELECT 'Product' AS label, CAST(regexp_extract(product_code, '([0-9]+)[^0-9]*$', 1) AS BIGINT) // 1000 AS part, SUM(COUNT(*)) OVER () AS total, string_agg(product_code, '|' ORDER BY product_code) AS ids FROM v_products GROUP BY 2",
)
add(
    "GR-22_order_graph",
    "type:s src:i dst:i",
    lambda d: graph.order_graph(
        d["orders"].withColumn("warehouse_id", (F.col("order_id") % 25).cast("int")), d["order_items"], d["products"].filter("supplier_id IS NOT NULL")
    ),
    """WITH s AS (SELECT DISTINCT order_id, i.product_id, supplier_id FROM v_order_items i JOIN v_products p ON p.product_id = i.product_id WHERE supplier_id IS NOT NULL)
    SELECT 'PLACED' AS type, customer_id AS src, order_id AS dst FROM v_orders UNION ALL SELECT 'FULFILLS', order_id % 25, order_id FROM v_orders UNION ALL SELECT DISTINCT 'CONTAINS', order_id, product_id FROM v_order_items
    UNION ALL SELECT DISTINCT 'SUPPLIED_BY', product_id, supplier_id FROM s UNION ALL SELECT DISTINCT 'SUPPLIES', supplier_id, order_id % 25 FROM s""",
)

# --- live state -----------------------------------------------------------------------------------------

_STATUS_SPEC = "shipment_identifier:s status:s updated_at:t expires_at:t"
_STATUS_SQL = """SELECT shipment_identifier, status, updated_at, updated_at + to_days(CASE status WHEN 'IN_TRANSIT' THEN 7 ELSE 30 END) AS expires_at FROM (
    SELECT shipment_identifier, arg_max(status, (event_timestamp, rank)) AS status, MAX(event_timestamp) AS updated_at FROM (SELECT shipment_identifier, event_timestamp, 0 AS rank, 'IN_TRANSIT' AS status FROM v_started
    UNION ALL SELECT shipment_identifier, event_timestamp, 1, delivery_status FROM v_delivered) GROUP BY 1)"""
_INFO_SPEC = "shipment_identifier:s transport_mode:s source_node:s target_node:s carrier_id:s updated_at:t expires_at:t"
_LAST = "SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY shipment_identifier ORDER BY event_timestamp DESC) AS r FROM {0}) WHERE r = 1"
_INFO_SQL = f"SELECT *, event_timestamp AS updated_at, event_timestamp + INTERVAL 7 DAY AS expires_at FROM ({_LAST.format('v_started')})"
_POSITION_SPEC = "shipment_identifier:s latitude:d longitude:d container_temperature:d speed_kmh:d updated_at:t expires_at:t"
_POSITION_SQL = f"SELECT *, event_timestamp AS updated_at, event_timestamp + INTERVAL 1 HOUR AS expires_at FROM ({_LAST.format('v_positions')})"
_BAD = "v_positions WHERE container_temperature < 10 OR container_temperature > 15"
_ALERT_SPEC = "shipment_identifier:s updated_at:t expires_at:t"
_ALERT_SQL = f"SELECT shipment_identifier, MAX(event_timestamp) AS updated_at, MAX(event_timestamp) + INTERVAL 1 DAY AS expires_at FROM {_BAD} GROUP BY 1"
_ISO = "strftime(event_timestamp, '%Y-%m-%dT%H:%M:%S.%f')"
_VIOLATION_SPEC = "day:i member:s temperature:d"
_VIOLATION_SQL = f"""SELECT CAST(strftime(event_timestamp, '%Y%m%d') AS INTEGER) AS day, shipment_identifier || ':' || {_ISO} || ':temp=' || CAST(CAST(container_temperature AS DOUBLE) AS VARCHAR) AS member, container_temperature AS temperature, event_timestamp + INTERVAL 7 DAY AS expires_at FROM {_BAD}"""
_MEMBER = f"""'{{"lat":' || CAST(CAST(latitude AS DOUBLE) AS VARCHAR) || ',"lon":' || CAST(CAST(longitude AS DOUBLE) AS VARCHAR) || ',"temp":' || CAST(CAST(container_temperature AS DOUBLE) AS VARCHAR) || ',"ts":"' || {_ISO} || '"}}'"""

add("LIV-1_shipment_status", _STATUS_SPEC, lambda d: live.shipment_status(d["started"], d["delivered"]), _STATUS_SQL)
add("LIV-2_shipment_info", _INFO_SPEC, lambda d: live.shipment_info(d["started"]), _INFO_SQL)
add("LIV-3_latest_position", _POSITION_SPEC, lambda d: live.latest_position(d["positions"]), _POSITION_SQL)
add(
    "LIV-4_route_history",
    "shipment_identifier:s part:i route:s updated_at:t expires_at:t",
    lambda d: live.route_history(d["positions"]).withColumn("route", F.array_join(F.transform("route", lambda p: p.member), "|")),
    f"""SELECT shipment_identifier, {_DAY.format('event_timestamp')} AS part, string_agg(m, '|' ORDER BY epoch_second, m) AS route, ANY_VALUE(last) AS updated_at, ANY_VALUE(last) + INTERVAL 3 DAY AS expires_at FROM (
    SELECT *, {_MEMBER} AS m, CAST(floor(epoch(event_timestamp)) AS BIGINT) AS epoch_second, MAX(event_timestamp) OVER (PARTITION BY shipment_identifier) AS last FROM v_positions) GROUP BY 1, 2""",
)
add("LIV-5_temperature_alerts", _ALERT_SPEC + " alert:s", lambda d: live.temperature_alerts(d["positions"]), f"SELECT *, 'ALERT' AS alert FROM ({_ALERT_SQL})")
add("LIV-6_violation_ranking", _VIOLATION_SPEC + " expires_at:t", lambda d: live.violation_ranking(d["positions"]), _VIOLATION_SQL)
add(
    "LIV-6_above_fifteen_and_a_half",
    _VIOLATION_SPEC,
    lambda d: live.ranking_by_score(live.violation_ranking(d["positions"]), at_least=15.5),
    f"SELECT * FROM ({_VIOLATION_SQL}) WHERE temperature >= 15.5",
)
add(
    "LIV-7_active_shipments",
    "active_shipments:i",
    lambda d: live.active_shipments(d["started"], d["delivered"]),
    """SELECT SUM(step) - LEAST(0, MIN(running)) AS active_shipments FROM (SELECT step, SUM(step) OVER (ORDER BY event_timestamp, step DESC ROWS UNBOUNDED PRECEDING) AS running FROM (
    SELECT event_timestamp, 1 AS step FROM v_started UNION ALL SELECT event_timestamp, -1 FROM v_delivered))""",
)
_COUNTERS = "SELECT 'deliveries_' || lower(delivery_status) AS counter, COUNT(*) AS value FROM v_delivered GROUP BY 1"
add("LIV-7_delivery_counters", "counter:s value:i", lambda d: live.delivery_counters(d["delivered"]), _COUNTERS)
add("LIV-7_alert_counter", "temperature_alerts:i", lambda d: live.alert_counter(d["positions"]), f"SELECT COUNT(*) AS temperature_alerts FROM {_BAD}")
_ORDER_DAYS = "SELECT CAST(strftime(order_timestamp, '%Y%m%d') AS INTEGER) AS day, COUNT(*) AS orders FROM v_orders JOIN v_customers USING (customer_id) GROUP BY 1"
add("LIV-7_orders_per_day", "day:i orders:i", lambda d: live.orders_per_day(d["order_events"]), _ORDER_DAYS)
_ORDER_EVENTS = "v_orders JOIN v_customers USING (customer_id)"
add(
    "LIV-7_orders_today",
    "orders_today:i",
    lambda d: live.orders_today(d["order_events"], datetime(1995, 6, 15, 12)),
    f"SELECT COUNT(*) AS orders_today FROM {_ORDER_EVENTS} WHERE CAST(order_timestamp AS DATE) = DATE '1995-06-15'",
)
add(
    "LIV-7_load_runs",
    "etl_runs:i",
    lambda d: live.load_runs(d.base("events").select(F.to_date("ts").alias("loaded_on")).distinct()),
    "SELECT COUNT(DISTINCT CAST(ts AS DATE)) AS etl_runs FROM events",
)
add(
    "LIV-8_order_status",
    "order_reference:s status:s updated_at:t expires_at:t",
    lambda d: live.order_status(d["order_events"]),
    f"SELECT order_reference, 'CREATED' AS status, order_timestamp AS updated_at, order_timestamp + INTERVAL 30 DAY AS expires_at FROM {_ORDER_EVENTS}",
)
add(
    "LIV-8_order_meta",
    "order_reference:s customer_number:s customer_name:s priority:s updated_at:t",
    lambda d: live.order_meta(d["order_events"]),
    f"SELECT order_reference, customer_number, customer_name, delivery_priority AS priority, order_timestamp AS updated_at FROM {_ORDER_EVENTS}",
)
add(
    "LIV-8_order_timeline",
    "order_reference:s part:i timeline:s",
    lambda d: live.order_timeline(d["order_events"]).withColumn("timeline", F.array_join("timeline", "|")),
    f"SELECT order_reference, {_DAY.format('order_timestamp')} AS part, strftime(order_timestamp, '%Y-%m-%dT%H:%M:%S.%f') || ' – CREATED' AS timeline FROM {_ORDER_EVENTS}",
)
add(
    "LIV-9_product_cache",
    "product_code:s description:s unit_price:s updated_at:t",
    lambda d: live.product_cache(d["product_events"], d["order_events"]),
    """SELECT 'BAN-' || id AS product_code, description, unit_price, updated_at FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY id ORDER BY src, updated_at, position, description, unit_price) AS r FROM (
    SELECT product_id AS id, 0 AS src, event_timestamp AS updated_at, 0 AS position, product_name AS description, '' AS unit_price FROM v_products WHERE product_id % 3 = 0
    UNION ALL SELECT l_partkey, 1, order_timestamp, ROW_NUMBER() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber) - 1, 'Part ' || l_partkey, CAST(CAST((100 + l_partkey % 500) / 100.0 AS DOUBLE) AS VARCHAR)
    FROM v_l1 JOIN v_orders ON order_id = l_orderkey JOIN v_customers USING (customer_id))) WHERE r = 1""",
)


def _entries(d: Driver) -> DataFrame:
    status = live.entries("string", "shipment:status:", live.shipment_status(d["started"], d["delivered"]), "shipment_identifier")
    alerts = live.entries("string", "shipment:alert:temperature:", live.temperature_alerts(d["positions"]), "shipment_identifier")
    info = live.entries("hash", "shipment:info:", live.shipment_info(d["started"]), "shipment_identifier")
    return reduce(DataFrame.unionByName, [status, alerts, info])


add(
    "LIV-10_lookup",
    "key:s kind:s value:s updated_at:t",
    lambda d: live.find(_entries(d), "shipment:*us:*", "string"),
    f"SELECT 'shipment:status:' || shipment_identifier AS key, 'string' AS kind, '{{\"status\":\"' || status || '\"}}' AS value, updated_at FROM ({_STATUS_SQL})",
)
add(
    "LIV-11_not_expired",
    _STATUS_SPEC,
    lambda d: live.not_expired(live.shipment_status(d["started"], d["delivered"]), LIVE_AS_OF.replace(month=2, day=5)),
    f"SELECT * FROM ({_STATUS_SQL}) WHERE expires_at > TIMESTAMP '2024-02-05'",
)
add(
    "LIV-12_repeated_events",
    _POSITION_SPEC,
    lambda d: live.latest_position(
        live.distinct_events(d["positions"].unionByName(d["positions"]).withColumn("event_type", F.lit("ShipmentPositionUpdated")))
    ),
    _POSITION_SQL,
)

# --- the same state kept by a stream ----------------------------------------------------------------------


def _typed(d: Driver, *types: str) -> DataFrame:
    return d.live_stream().filter(F.col("event_type").isin(*types))


def _stream_positions(d: Driver) -> DataFrame:
    return adapter.positions(_typed(d, "view", "click"))


def _current(updates: DataFrame, fields: list[str], ttl: str) -> DataFrame:
    state = stream.latest_of_updates(updates, "shipment_identifier", fields)
    return stream.expiring(state, live.TTL_SECONDS[ttl])


add(
    "LIV-1_stream_shipment_status",
    _STATUS_SPEC,
    lambda d: stream.current_status(stream.run(stream.stream_shipment_status(adapter.status_events(d.live_stream())), "status")),
    _STATUS_SQL,
)
add(
    "LIV-2_stream_shipment_info",
    _INFO_SPEC,
    lambda d: _current(
        stream.run(stream.stream_shipment_info(live.flat_starts(adapter.started(_typed(d, "signup")))), "info"),
        ["transport_mode", "source_node", "target_node", "carrier_id"], "shipment_info",
    ),
    _INFO_SQL,
)
add(
    "LIV-3_stream_latest_position",
    _POSITION_SPEC,
    lambda d: _current(
        stream.run(stream.stream_latest_position(_stream_positions(d)), "position"),
        ["latitude", "longitude", "container_temperature", "speed_kmh"], "shipment_position",
    ),
    _POSITION_SQL,
)
add(
    "LIV-4_stream_route_points",
    "shipment_identifier:s member:s",
    lambda d: stream.settled(stream.run(stream.stream_route_points(_stream_positions(d)), "route", "append", stream.POINT_KEYS), stream.POINT_KEYS),
    f"SELECT shipment_identifier, {_MEMBER} AS member FROM v_positions",
)
add(
    "LIV-5_stream_alerts",
    _ALERT_SPEC,
    lambda d: _current(stream.run(stream.stream_temperature_alerts(_stream_positions(d)), "alerts"), [], "temperature_alert"),
    _ALERT_SQL,
)
add(
    "LIV-6_stream_violations",
    _VIOLATION_SPEC,
    lambda d: stream.settled(
        stream.run(stream.stream_violations(_stream_positions(d)), "violations", "append", stream.VIOLATION_KEYS), stream.VIOLATION_KEYS
    ),
    _VIOLATION_SQL,
)
add(
    "LIV-7_stream_counters",
    "counter:s value:i",
    lambda d: stream.counter_totals(stream.run(stream.stream_counters(adapter.status_events(d.live_stream())), "counters")),
    f"{_COUNTERS} UNION ALL SELECT 'started', COUNT(*) FROM v_started UNION ALL SELECT 'temperature_alerts', COUNT(*) FROM {_BAD}",
)
add(
    "LIV-7_stream_active_shipments",
    "active_shipments:i",
    lambda d: stream.active_from(stream.run(stream.stream_changes(adapter.status_events(d.live_stream())), "changes", "append")),
    """SELECT SUM(step) - LEAST(0, MIN(running)) AS active_shipments FROM (SELECT step, SUM(step) OVER (ORDER BY event_timestamp, step DESC ROWS UNBOUNDED PRECEDING) AS running FROM (
    SELECT event_timestamp, 1 AS step FROM v_started UNION ALL SELECT event_timestamp, -1 FROM v_delivered))""",
)
add(
    "LIV-12_stream_repeated_events",
    "shipment_identifier:s event_type:s event_timestamp:t",
    lambda d: stream.settled(
        stream.run(
            adapter.status_events(d.live_stream()).select("shipment_identifier", "event_type", "event_timestamp"), "unique", "append", stream.EVENT_KEYS
        ),
        stream.EVENT_KEYS,
    ),
    """SELECT DISTINCT shipment_identifier, event_type, event_timestamp FROM (SELECT shipment_identifier, 'ShipmentPositionUpdated' AS event_type, event_timestamp FROM v_positions
    UNION ALL SELECT shipment_identifier, 'TransportStarted', event_timestamp FROM v_started UNION ALL SELECT shipment_identifier, 'DeliveryCompleted', event_timestamp FROM v_delivered)""",
)
