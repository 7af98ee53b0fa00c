"""Checked queries: star schema, key figures, master data, quality, verification."""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from checks.adapter import AS_OF, PERIOD, Driver
from checks.registry import add, average, percent
from freightloom.operators import catalogue, mdm, quality, validation
from freightloom.operators import verification as ver
from freightloom.plans import kpi, star
from freightloom.plans import reports as rpt
from freightloom.sources import relations as R
from freightloom.sources.constant import constant

# --- star schema -------------------------------------------------------------------------


def _dims(d: Driver) -> star.Dimensions:
    return star.Dimensions(
        customer=d.stage("dim_customer", lambda: star.dim_customer(d["customers"])),
        product=d.stage("dim_product", lambda: star.dim_product(d["products"], d["suppliers"])),
        supplier=d.stage("dim_supplier", lambda: star.dim_supplier(d["suppliers"])),
        carrier=d.stage("dim_carrier", lambda: star.dim_carrier(d["carriers"])),
        node=d.stage("dim_node", lambda: star.dim_supply_chain_node(d["supply_chain_nodes"])),
        status=R.delivery_statuses(d.spark),
    )


def _ready_dims(d: Driver) -> star.Dimensions:
    """Dimensions as an earlier load left them, keyed by the ids of their source."""
    stamp = "event_timestamp AS source_created_at"
    folded = d["suppliers"].selectExpr("supplier_id", "supplier_code", "supplier_name", "country AS supplier_country")
    return star.Dimensions(
        customer=d["customers"].selectExpr("customer_id AS customer_sk", "customer_number", "customer_name", "city", "country", stamp),
        product=d["products"].join(folded, "supplier_id", "left").selectExpr(
            "product_id AS product_sk", "product_code", "product_name", "category", "supplier_code", "supplier_name", "supplier_country"
        ),
        supplier=d["suppliers"].selectExpr("supplier_id AS supplier_sk", "supplier_code", "supplier_name", "country", stamp),
        carrier=d["carriers"].selectExpr("carrier_id AS carrier_sk", "carrier_code", "carrier_name", stamp),
        node=d["supply_chain_nodes"].selectExpr("node_id AS node_sk", "node_code", "node_name", "node_type", "region", "sequence_order"),
        status=R.delivery_statuses(d.spark),
    )


def fact(d: Driver, loaded: bool = True) -> tuple[DataFrame, star.Dimensions]:
    """Fact and dimensions; unless loaded before, the dimensions are built and written first."""
    dims = _ready_dims(d) if loaded else _dims(d)
    t = d.tables
    rows = star.fact_fulfillment(
        t["orders"], t["order_items"], t["customers"], t["products"], t["suppliers"], t["shipments"], t["deliveries"],
        t["transport_completions"], t["carriers"], t["batches"], t["node_processings"], dims,
    )
    return rows, dims


def _named_fact(d: Driver) -> DataFrame:
    rows, dims = fact(d, loaded=False)
    return (
        rows.join(dims.customer.select("customer_sk", "customer_number"), "customer_sk")
        .join(dims.product.select("product_sk", "product_code"), "product_sk")
        .join(dims.supplier.select("supplier_sk", "supplier_code"), "supplier_sk")
        .join(dims.carrier.select("carrier_sk", "carrier_code"), "carrier_sk", "left")
        .join(dims.node.select(F.col("node_sk").alias("destination_node_sk"), F.col("node_code").alias("destination_node")), "destination_node_sk", "left")
        .join(dims.status.select(F.col("status_sk").alias("delivery_status_sk"), F.col("status_code").alias("delivery_status")), "delivery_status_sk")
    )


add(
    "DWH-1_dim_customer",
    "customer_number:s customer_name:s city:s country:s source_created_at:t",
    lambda d: star.dim_customer(d["customers"]),
    "SELECT *, event_timestamp AS source_created_at FROM v_customers",
)
add(
    "DWH-2_dim_supplier",
    "supplier_code:s supplier_name:s country:s source_created_at:t",
    lambda d: star.dim_supplier(d["suppliers"]),
    "SELECT *, event_timestamp AS source_created_at FROM v_suppliers",
)
add(
    "DWH-3_dim_product",
    "product_code:s product_name:s category:s supplier_code:s supplier_name:s supplier_country:s",
    lambda d: star.dim_product(d["products"], d["suppliers"]),
    "SELECT product_code, product_name, category, supplier_code, supplier_name, country AS supplier_country FROM v_products LEFT JOIN v_suppliers USING (supplier_id)",
)
add(
    "DWH-4_dim_carrier",
    "carrier_code:s carrier_name:s source_created_at:t fulfillments:i",
    lambda d: _carrier_use(d),
    "SELECT carrier_code, carrier_name, event_timestamp AS source_created_at, (SELECT COUNT(*) FROM v_fact f WHERE f.carrier_code = c.carrier_code) AS fulfillments FROM v_carriers c",
)
add(
    "DWH-5_dim_node",
    "node_code:s node_name:s node_type:s region:s sequence_order:i fulfillments:i",
    lambda d: _node_use(d),
    "SELECT *, (SELECT COUNT(*) FROM v_fact f WHERE f.destination_node = n.node_code) AS fulfillments FROM v_supply_chain_nodes n",
)


def _carrier_use(d: Driver) -> DataFrame:
    rows, dims = fact(d, loaded=False)
    use = rows.filter("carrier_sk IS NOT NULL").groupBy("carrier_sk").agg(F.count("*").alias("fulfillments"))
    return dims.carrier.join(use, "carrier_sk", "left").na.fill(0, ["fulfillments"])


def _node_use(d: Driver) -> DataFrame:
    rows, dims = fact(d, loaded=False)
    use = rows.groupBy(F.col("destination_node_sk").alias("node_sk")).agg(F.count("*").alias("fulfillments"))
    return dims.node.join(use, "node_sk", "left").na.fill(0, ["fulfillments"])


_FACT = (
    "customer_number:s product_code:s supplier_code:s carrier_code:s destination_node:s order_date_sk:i delivery_date_sk:i delivery_status:s "
    "order_reference:s batch_identifier:s shipment_identifier:s quantity:i unit_price:d total_value:d delay_minutes:i avg_temperature:d "
    "num_supply_chain_hops:i delivery_priority_code:s on_time_flag:b"
)
add(
    "DWH-7_status_dimension",
    "status_code:s status_name:s is_successful:b fulfillments:i",
    lambda d: fact(d)[0]
    .groupBy(F.col("delivery_status_sk").alias("status_sk"))
    .agg(F.count("*").alias("fulfillments"))
    .join(R.delivery_statuses(d.spark), "status_sk"),
    "SELECT status_code, status_name, is_successful, COUNT(*) AS fulfillments FROM v_fact JOIN v_statuses ON status_code = delivery_status GROUP BY ALL",
)
add("DWH-8_fact_fulfillment", _FACT, _named_fact, "SELECT * FROM v_fact")
add(
    "WN-1_first_order_per_product",
    "product_code:s order_reference:s quantity:i unit_price:d customer_number:s",
    lambda d: star.first_order_per_product(d["order_items"], d["orders"], d["customers"], d["products"], d["suppliers"]),
    "SELECT product_code, order_reference, quantity, unit_price, customer_number FROM v_first_order JOIN v_products USING (product_id) JOIN v_suppliers USING (supplier_id)",
)
add(
    "WN-2_first_batch_per_product",
    "product_code:s batch_identifier:s",
    lambda d: star.first_batch_per_product(d["batches"], d["products"]),
    "SELECT product_code, batch_identifier FROM v_first_batch JOIN v_products USING (product_id)",
)

# --- key figures ---------------------------------------------------------------------------

add(
    "KPI-1_carrier_performance",
    "carrier_code:s carrier_name:s total_hops:i on_time_count:i delayed_count:i otd_rate_pct:d avg_delay_minutes:d max_delay_minutes:i",
    lambda d: (lambda f: kpi.carrier_performance(f[0], f[1].carrier))(fact(d)),
    f"""SELECT carrier_code, carrier_name, COUNT(*) AS total_hops, COUNT(*) FILTER (WHERE on_time_flag) AS on_time_count, COUNT(*) FILTER (WHERE NOT on_time_flag) AS delayed_count,
    {percent('COUNT(*) FILTER (WHERE on_time_flag)', 'COUNT(*)')} AS otd_rate_pct, {average('SUM(delay_minutes)', 'COUNT(*)', 1)} AS avg_delay_minutes, MAX(delay_minutes) AS max_delay_minutes
    FROM v_fact JOIN v_carriers USING (carrier_code) GROUP BY carrier_code, carrier_name""",
)
add(
    "KPI-2_summary",
    "total_fulfillments:i kpi_otd_rate_pct:d kpi_avg_delay_hours:d kpi_temp_outlier_pct:d kpi_avg_order_value_eur:d kpi_total_revenue_eur:d",
    lambda d: kpi.kpi_summary(fact(d)[0]),
    f"""SELECT COUNT(*) AS total_fulfillments, {percent('COUNT(*) FILTER (WHERE on_time_flag)', 'COUNT(*)')} AS kpi_otd_rate_pct,
    {average('SUM(delay_minutes)', '(COUNT(*) * 60)', 2)} AS kpi_avg_delay_hours,
    {percent('COUNT(*) FILTER (WHERE avg_temperature NOT BETWEEN 10 AND 15)', 'COUNT(avg_temperature)')} AS kpi_temp_outlier_pct,
    {average('SUM(CAST(total_value * 100 AS BIGINT))', 'COUNT(total_value)', 2, 2)} AS kpi_avg_order_value_eur, SUM(total_value) AS kpi_total_revenue_eur FROM v_fact""",
)
add(
    "KPI-3_monthly_revenue",
    "year:i month:i month_name:s product_code:s product_name:s total_quantity:i total_revenue_eur:d num_shipments:i",
    lambda d: (lambda f: kpi.monthly_revenue(f[0], R.calendar_of(d["orders"], "order_timestamp"), f[1].product))(fact(d)),
    """SELECT order_date_sk // 10000 AS year, order_date_sk // 100 % 100 AS month, monthname(strptime(CAST(order_date_sk AS VARCHAR), '%Y%m%d')) AS month_name, product_code, product_name,
    SUM(quantity) AS total_quantity, SUM(total_value) AS total_revenue_eur, COUNT(*) AS num_shipments FROM v_fact JOIN v_products USING (product_code) GROUP BY ALL""",
)
add(
    "KPI-4_revenue_by_customer_month",
    "customer_name:s year:i month:i revenue_eur:d",
    lambda d: (lambda f: kpi.revenue_by_customer_month(f[0], f[1].customer, R.calendar_of(d["orders"], "order_timestamp")))(fact(d)),
    "SELECT customer_name, order_date_sk // 10000 AS year, order_date_sk // 100 % 100 AS month, SUM(total_value) AS revenue_eur FROM v_fact JOIN v_customers USING (customer_number) GROUP BY ALL",
)
add(
    "KPI-5_temperature_by_node",
    "node_name:s sequence_order:i avg_temp:d breaches:i",
    lambda d: (lambda f: kpi.temperature_by_node(f[0], f[1].node))(fact(d)),
    f"""SELECT node_name, sequence_order, {average('SUM(CAST(avg_temperature * 100 AS BIGINT))', 'COUNT(*)', 2, 2)} AS avg_temp, COUNT(*) FILTER (WHERE avg_temperature NOT BETWEEN 10 AND 15) AS breaches
    FROM v_fact JOIN v_supply_chain_nodes ON node_code = destination_node WHERE avg_temperature IS NOT NULL GROUP BY node_name, sequence_order""",
)
add(
    "KPI-6_on_time_distribution",
    "on_time_flag:b fulfillments:i",
    lambda d: kpi.on_time_distribution(fact(d)[0]),
    "SELECT on_time_flag, COUNT(*) AS fulfillments FROM v_fact GROUP BY 1",
)
add(
    "KPI-6_fact_plausibility",
    "total_facts:i avg_quantity:d avg_temp_celsius:d avg_delay_minutes:d on_time_count:i on_time_pct:d",
    lambda d: kpi.fact_plausibility(fact(d)[0]),
    f"""SELECT COUNT(*) AS total_facts, {average('SUM(quantity)', 'COUNT(quantity)', 1)} AS avg_quantity, {average('SUM(CAST(avg_temperature * 100 AS BIGINT))', 'COUNT(avg_temperature)', 2, 2)} AS avg_temp_celsius,
    {average('SUM(delay_minutes)', 'COUNT(*)', 1)} AS avg_delay_minutes, COUNT(*) FILTER (WHERE on_time_flag) AS on_time_count, {percent('COUNT(*) FILTER (WHERE on_time_flag)', 'COUNT(*)')} AS on_time_pct FROM v_fact""",
)

# --- master data ------------------------------------------------------------------------------

_GOLDEN = "entity_type:s canonical_key:s canonical_name:s status:s quality_score:d"
_MAPPING = "entity_type:s canonical_key:s source_system:s source_key:s normalized_key:s is_canonical:b"
add("MDM-1_golden_records", _GOLDEN, lambda d: d["golden_records"], "SELECT * FROM v_golden")
add("MDM-2_source_mappings", _MAPPING, lambda d: d["source_mappings"], "SELECT * FROM v_mappings")
add(
    "MDM-3_resolve",
    "batch_reference:s sku:s canonical_key:s",
    lambda d: mdm.resolve(d["node_processings"].select("batch_reference", "sku"), "sku", "WMS", d["source_mappings"], d["golden_records"]),
    "SELECT batch_reference, sku, m.canonical_key FROM v_node_processings LEFT JOIN (SELECT * FROM v_mappings WHERE source_system = 'WMS') m ON m.source_key = sku",
)


def _raw_keys(d: Driver) -> DataFrame:
    return d["shipments"].selectExpr(
        "shipment_identifier",
        "CASE shipment_id % 4 WHEN 0 THEN cargo_product_reference WHEN 1 THEN concat(' ', upper(cargo_product_reference), ' ') "
        "WHEN 2 THEN replace(cargo_product_reference, '-', '_') ELSE replace(cargo_product_reference, 'ban-', 'BANANA-') END AS raw_key",
    )


add(
    "MDM-4_resolve_fuzzy",
    "shipment_identifier:s raw_key:s canonical_key:s",
    lambda d: mdm.resolve_fuzzy(_raw_keys(d), "raw_key", d["source_mappings"], d["golden_records"]),
    """SELECT shipment_identifier, raw_key, COALESCE((SELECT MIN(canonical_key) FROM v_mappings WHERE source_key = raw_key), (SELECT MIN(canonical_key) FROM v_mappings WHERE normalized_key = lower(replace(trim(raw_key), '_', '-')))) AS canonical_key
    FROM (SELECT shipment_identifier, CASE shipment_id % 4 WHEN 0 THEN cargo_product_reference WHEN 1 THEN ' ' || upper(cargo_product_reference) || ' ' WHEN 2 THEN replace(cargo_product_reference, '-', '_')
    ELSE replace(cargo_product_reference, 'ban-', 'BANANA-') END AS raw_key FROM v_shipments)""",
)
add(
    "MDM-5_golden_overview",
    _GOLDEN + " erp_key:s wms_key:s tms_key:s total_mappings:i",
    lambda d: mdm.golden_overview(d["golden_records"], d["source_mappings"]),
    """SELECT g.entity_type, g.canonical_key, g.canonical_name, g.status, g.quality_score, MAX(source_key) FILTER (WHERE source_system = 'ERP') AS erp_key, MAX(source_key) FILTER (WHERE source_system = 'WMS') AS wms_key,
    MAX(source_key) FILTER (WHERE source_system = 'TMS') AS tms_key, COUNT(source_key) AS total_mappings FROM v_golden g LEFT JOIN v_mappings m ON m.entity_type = g.entity_type AND m.canonical_key = g.canonical_key GROUP BY ALL""",
)
add(
    "MDM-6_coverage_by_type",
    "entity_type_code:s golden_records:i active_records:i",
    lambda d: mdm.coverage_by_type(d["golden_records"], R.entity_types(d.spark)),
    "SELECT entity_type_code, COUNT(canonical_key) AS golden_records, COUNT(canonical_key) FILTER (WHERE status = 'ACTIVE') AS active_records FROM v_entity_types LEFT JOIN v_golden ON entity_type = entity_type_code GROUP BY 1",
)
add(
    "MDM-6_coverage_by_system",
    "source_system:s total_mappings:i canonical_mappings:i",
    lambda d: mdm.coverage_by_system(d["source_mappings"]),
    "SELECT source_system, COUNT(*) AS total_mappings, COUNT(*) FILTER (WHERE is_canonical) AS canonical_mappings FROM v_mappings GROUP BY 1",
)


def _broken_mappings(d: Driver) -> DataFrame:
    """Mappings whose transport entry is canonical too for every seventh product."""
    code = F.regexp_extract("canonical_key", r"(\d+)$", 1).try_cast("long")
    wrong = (F.col("source_system") == "TMS") & (F.col("entity_type") == "PRODUCT") & (code % 7 == 0)
    return d["source_mappings"].withColumn("is_canonical", F.when(wrong, True).otherwise(F.col("is_canonical")))


add(
    "MDM-7_canonical_violations",
    "entity_type:s canonical_key:s canonical_count:i",
    lambda d: mdm.canonical_violations(_broken_mappings(d)),
    "SELECT 'PRODUCT' AS entity_type, product_code AS canonical_key, 2 AS canonical_count FROM v_products WHERE product_id % 7 = 0 AND product_id % 211 <> 0",
)
add(
    "MDM-7_canonical_check",
    "violations:i is_canonical_check:s",
    lambda d: mdm.canonical_check(d["source_mappings"]),
    """SELECT COUNT(*) AS violations, CASE WHEN COUNT(*) = 0 THEN 'PASS – jeder Golden Record hat genau 1 canonical mapping' ELSE 'FAIL – ' || COUNT(*) || ' Golden Records ohne oder mit mehreren canonical mappings' END AS is_canonical_check
    FROM (SELECT entity_type, canonical_key FROM v_mappings GROUP BY ALL HAVING COUNT(*) FILTER (WHERE is_canonical) <> 1)""",
)
add(
    "MDM-8_cross_system_keys",
    "canonical_key:s canonical_name:s tms_key:s erp_key:s",
    lambda d: mdm.cross_system_keys(d["golden_records"], d["source_mappings"]),
    """SELECT g.canonical_key, canonical_name, t.source_key AS tms_key, e.source_key AS erp_key FROM v_golden g JOIN v_mappings t ON t.canonical_key = g.canonical_key AND t.source_system = 'TMS' AND t.entity_type = 'PRODUCT'
    JOIN v_mappings e ON e.canonical_key = g.canonical_key AND e.source_system = 'ERP' AND e.entity_type = 'PRODUCT' WHERE g.entity_type = 'PRODUCT'""",
)
add(
    "MDM-8_shipments_of_product",
    "canonical_key:s shipment_identifier:s source_node:s target_node:s",
    lambda d: mdm.shipments_of_product(d["shipments"], d["source_mappings"]),
    "SELECT canonical_key, shipment_identifier, source_node, target_node FROM v_shipments JOIN v_mappings ON source_key = cargo_product_reference AND source_system = 'TMS' AND entity_type = 'PRODUCT'",
)
add(
    "MDM-9_unharmonised_skus",
    "sku:s",
    lambda d: mdm.unharmonised_skus(d["warehouse_skus"], d["source_mappings"]),
    "SELECT sku FROM v_warehouse_skus WHERE sku NOT IN (SELECT source_key FROM v_mappings WHERE source_system = 'WMS')",
)
add(
    "MDM-9_unharmonised_references",
    "cargo_product_reference:s",
    lambda d: mdm.unharmonised_references(d["shipments"], d["source_mappings"]),
    "SELECT DISTINCT cargo_product_reference FROM v_shipments WHERE cargo_product_reference NOT IN (SELECT source_key FROM v_mappings WHERE source_system = 'TMS')",
)
add(
    "MDM-10_key_matrix",
    "normalized_key:s erp_key:s wms_key:s tms_key:s is_complete:b",
    lambda d: mdm.key_matrix(d["products"].filter("product_id % 5 <> 0"), d["warehouse_skus"], d["shipments"]),
    """SELECT normalized_key, MIN(k) FILTER (WHERE s = 'ERP') AS erp_key, MIN(k) FILTER (WHERE s = 'WMS') AS wms_key, MIN(k) FILTER (WHERE s = 'TMS') AS tms_key, COUNT(DISTINCT s) = 3 AS is_complete FROM (
    SELECT lower(replace(k, '_', '-')) AS normalized_key, k, s FROM (SELECT product_code AS k, 'ERP' AS s FROM v_products WHERE product_id % 5 <> 0 UNION ALL SELECT sku, 'WMS' FROM v_warehouse_skus
    UNION ALL SELECT DISTINCT cargo_product_reference, 'TMS' FROM v_shipments)) GROUP BY normalized_key""",
)

# --- quality --------------------------------------------------------------------------------------

_DAY_AFTER = f"TIMESTAMP '{AS_OF}' + INTERVAL 1 DAY"
_START = f"TIMESTAMP '{PERIOD.start}'"


def _outside(column: str) -> str:
    return f"({column} < {_START} OR {column} > {_DAY_AFTER})"


def _surplus(table: str, key: str) -> str:
    return f"SELECT COALESCE(SUM(n - 1), 0) FROM (SELECT COUNT(*) AS n FROM {table} GROUP BY {key} HAVING COUNT(*) > 1)"


def _raw_shipments(d: Driver) -> DataFrame:
    """Shipments as counted from the lines before their keys were made unique."""
    return d.base("lineitem").filter("l_linenumber <= 6").selectExpr(
        "concat('SHIP-', l_orderkey, '-', l_linenumber) AS shipment_identifier",
    )


_RAW_SHIPMENTS = "(SELECT 'SHIP-' || l_orderkey || '-' || l_linenumber AS shipment_identifier FROM lineitem WHERE l_linenumber <= 6)"

_VIOLATIONS = {
    "1.1": "SELECT COUNT(*) FROM v_products WHERE supplier_id IS NULL",
    "1.2": "SELECT COUNT(*) FROM v_order_items WHERE quantity IS NULL OR unit_price IS NULL",
    "1.3": "SELECT COUNT(*) FROM v_node_processings WHERE temperature IS NULL",
    "1.4": "SELECT COUNT(*) FROM v_deliveries WHERE delivery_status = 'SUCCESSFUL' AND received_by IS NULL",
    "1.5": "SELECT COUNT(*) FROM v_orders o WHERE NOT EXISTS (SELECT 1 FROM v_order_items i WHERE i.order_id = o.order_id)",
    "2.1": _surplus("v_suppliers", "supplier_code"),
    "2.2": _surplus("v_orders", "order_reference"),
    "2.3": _surplus("v_batches", "batch_identifier"),
    "2.4": _surplus("v_shipments", "shipment_identifier"),
    "3.1": "SELECT COUNT(*) FROM v_warehouse_skus w WHERE NOT EXISTS (SELECT 1 FROM v_mappings m WHERE m.source_system = 'WMS' AND m.normalized_key = lower(replace(w.sku, '_', '-')))",
    "3.2": "SELECT COUNT(*) FROM v_transport_product_references t WHERE NOT EXISTS (SELECT 1 FROM v_mappings m WHERE m.source_system = 'TMS' AND m.normalized_key = lower(t.transport_product_reference))",
    "3.3": "SELECT COUNT(*) FROM v_batches JOIN v_products USING (product_id) WHERE wms_sku <> replace(product_code, '-', '_')",
    "3.4": "SELECT COUNT(*) FROM v_deliveries d WHERE delivery_status = 'SUCCESSFUL' AND NOT EXISTS (SELECT 1 FROM v_transport_completions c WHERE c.shipment_id = d.shipment_id)",
    "4.1": "SELECT COUNT(*) FROM v_order_items WHERE quantity <= 0",
    "4.2": "SELECT COUNT(*) FROM v_order_items WHERE unit_price < 1.50 OR unit_price > 5.00",
    "4.3": "SELECT COUNT(*) FROM v_node_processings WHERE temperature < 10 OR temperature > 15",
    "4.4": "SELECT COUNT(*) FROM v_shipment_positions WHERE container_temperature < 10 OR container_temperature > 15",
    "4.5": "SELECT COUNT(*) FROM v_shipment_positions WHERE latitude NOT BETWEEN -90 AND 90 OR longitude NOT BETWEEN -180 AND 180",
    "4.6": "SELECT COUNT(*) FROM v_deliveries WHERE delivery_status NOT IN ('SUCCESSFUL', 'DELAYED', 'FAILED')",
    "4.7": "SELECT COUNT(*) FROM v_orders WHERE delivery_priority NOT IN ('HIGH', 'NORMAL', 'LOW')",
    "4.8": "SELECT COUNT(*) FROM v_transport_completions WHERE delay_minutes > 180",
    "4.9": "SELECT COUNT(*) FROM v_shipment_positions WHERE speed_kmh > 200 OR speed_kmh < 0",
    "5.1": "SELECT COUNT(*) FROM v_transport_completions JOIN v_shipments USING (shipment_id) WHERE completed_at < started_at",
    "5.2": f"SELECT COUNT(*) FROM v_batches WHERE {_outside('harvested_at')}",
    "5.3": f"""SELECT COUNT(*) FROM v_orders o WHERE order_timestamp < TIMESTAMP '{AS_OF}' - INTERVAL 90 DAY AND o.order_id NOT IN (SELECT i.order_id FROM v_order_items i JOIN v_products p USING (product_id)
      JOIN (SELECT DISTINCT b.product_id FROM v_batches b JOIN (SELECT DISTINCT h.cargo_product_reference FROM v_shipments h JOIN v_deliveries USING (shipment_id)) s ON s.cargo_product_reference = b.tms_product_reference) x USING (product_id))""",
    "6.1": "SELECT COUNT(*) FROM v_node_processings n WHERE NOT EXISTS (SELECT 1 FROM v_batches b WHERE b.batch_identifier = n.batch_reference)",
    "6.2": "SELECT COUNT(*) FROM v_shipments s WHERE NOT EXISTS (SELECT 1 FROM v_transport_product_references r WHERE r.transport_product_reference = s.cargo_product_reference)",
    "6.3": "SELECT COUNT(*) FROM v_shipments WHERE carrier_id IS NULL",
    "5.0a": f"SELECT COUNT(*) FROM v_suppliers WHERE {_outside('event_timestamp')}",
    "5.0b": f"SELECT COUNT(*) FROM v_customers WHERE {_outside('event_timestamp')}",
    "5.0c": f"SELECT COUNT(*) FROM v_products WHERE {_outside('event_timestamp')}",
    "5.0d": f"SELECT COUNT(*) FROM v_carriers WHERE {_outside('event_timestamp')}",
}


@lru_cache(maxsize=None)
def _audit_sql(master_data: bool = False) -> str:
    rules = quality.MASTER_DATA_RULES if master_data else quality.RULES
    rows = " UNION ALL ".join(
        f"SELECT '{dimension}' AS dimension, '{number}' AS number, '{table}' AS \"table\", '{rule}' AS rule, ({_VIOLATIONS[number]}) AS violations"
        for number, dimension, table, rule in rules
    )
    return f"SELECT *, \"table\" AS table_name, CASE WHEN violations = 0 THEN 'PASS' ELSE 'FAIL' END AS status FROM ({rows})"


_AUDIT = "dimension:s number:s table_name:s rule:s violations:i status:s"
add(
    "DQ-ALL_audit",
    _AUDIT,
    lambda d: quality.dq_audit(d.tables, PERIOD).withColumnRenamed("table", "table_name"),
    _audit_sql(),
)
add(
    "DQ-5.0_master_data_dates",
    _AUDIT,
    lambda d: quality.dq_audit(d.tables, PERIOD, [r[0] for r in quality.MASTER_DATA_RULES]).withColumnRenamed("table", "table_name"),
    _audit_sql(True),
)
add(
    "DQ_scores",
    "dimension:s rules:i violations:i passed_pct:d",
    lambda d: quality.dq_scores(quality.dq_audit(d.tables, PERIOD)),
    f"SELECT dimension, COUNT(*) AS rules, SUM(violations) AS violations, {percent('COUNT(*) FILTER (WHERE violations = 0)', 'COUNT(*)')} AS passed_pct FROM ({_audit_sql()}) GROUP BY dimension",
)
add(
    "DQ-2.4_duplicate_keys",
    "shipment_identifier:s occurrences:i",
    lambda d: quality.dq_detail("2.4", {"shipments": _raw_shipments(d)}, PERIOD),
    f"SELECT shipment_identifier, COUNT(*) AS occurrences FROM {_RAW_SHIPMENTS} GROUP BY 1 HAVING COUNT(*) > 1",
)
add(
    "AG-7_surplus_duplicates",
    "violations:i",
    lambda d: quality.surplus_rows(_raw_shipments(d), "shipment_identifier"),
    f"SELECT ({_surplus(_RAW_SHIPMENTS, 'shipment_identifier')}) AS violations",
)
_DETAILS = {
    "3.1": ("sku:s erp_product_code:s", "SELECT * FROM v_warehouse_skus w WHERE NOT EXISTS (SELECT 1 FROM v_mappings m WHERE m.source_system = 'WMS' AND m.normalized_key = lower(replace(w.sku, '_', '-')))"),
    "3.2": ("transport_product_reference:s erp_product_code:s", "SELECT * FROM v_transport_product_references t WHERE NOT EXISTS (SELECT 1 FROM v_mappings m WHERE m.source_system = 'TMS' AND m.normalized_key = lower(t.transport_product_reference))"),
    "3.3": ("batch_identifier:s product_id:i wms_sku:s product_code:s", "SELECT * FROM v_batches JOIN v_products USING (product_id) WHERE wms_sku <> replace(product_code, '-', '_')"),
    "4.3": ("violations:i min_temp:d max_temp:d", "SELECT COUNT(*) AS violations, MIN(temperature) AS min_temp, MAX(temperature) AS max_temp FROM v_node_processings WHERE temperature < 10 OR temperature > 15"),
    "4.6": ("delivery_status:s occurrences:i", "SELECT delivery_status, COUNT(*) AS occurrences FROM v_deliveries WHERE delivery_status NOT IN ('SUCCESSFUL', 'DELAYED', 'FAILED') GROUP BY 1"),
    "4.7": ("delivery_priority:s occurrences:i", "SELECT delivery_priority, COUNT(*) AS occurrences FROM v_orders WHERE delivery_priority NOT IN ('HIGH', 'NORMAL', 'LOW') GROUP BY 1"),
}
for _number, (_spec, _body) in _DETAILS.items():
    add(f"DQ-{_number}_detail", _spec, (lambda n: lambda d: quality.dq_detail(n, d.tables, PERIOD))(_number), _body)
for _number in ("1.5", "3.4", "5.1", "5.3", "6.1", "6.2"):
    add(
        f"DQ-{_number}_detail", "violations:i", (lambda n: lambda d: quality.dq_detail(n, d.tables, PERIOD))(_number),
        f"SELECT ({_VIOLATIONS[_number]}) AS violations",
    )
add(
    "JN-4_orders_without_lines",
    "order_reference:s",
    lambda d: quality.orders_without_lines(d.tables),
    "SELECT order_reference FROM v_orders o WHERE NOT EXISTS (SELECT 1 FROM v_order_items i WHERE i.order_id = o.order_id)",
)
add(
    "JN-4_processings_without_batch",
    "batch_reference:s rows:i",
    lambda d: quality.processings_without_batch(d.tables),
    "SELECT batch_reference, COUNT(*) AS rows FROM v_node_processings n WHERE NOT EXISTS (SELECT 1 FROM v_batches b WHERE b.batch_identifier = n.batch_reference) GROUP BY 1",
)
add(
    "DQ_constraint_rejects",
    "table_name:s reason:s rows:i",
    lambda d: _constraint_rejects(d),
    """SELECT 'orders' AS table_name, 'delivery_priority' AS reason, COUNT(*) AS rows FROM v_orders WHERE delivery_priority = 'UNSPECIFIED'
    UNION ALL SELECT 'order_items', 'quantity', COUNT(*) FROM v_order_items WHERE quantity <= 0
    UNION ALL SELECT 'deliveries', 'delivery_status', COUNT(*) FROM v_deliveries WHERE delivery_status = 'UNKNOWN'
    UNION ALL SELECT 'shipment_positions', 'latitude', COUNT(*) FROM v_shipment_positions WHERE latitude NOT BETWEEN -90 AND 90""",
)


def _constraint_rejects(d: Driver) -> DataFrame:
    return ver.stack_rows(
        [
            quality.enforce(name, d[name])[1].groupBy("reason").agg(F.count("*").alias("rows")).withColumn("table_name", F.lit(name))
            for name in ("orders", "order_items", "deliveries", "shipment_positions")
        ]
    )


# --- validation ---------------------------------------------------------------------------------------


def _validated(d: Driver) -> DataFrame:
    checked = validation.validate_processings(d["node_processings"])
    return validation.validate_references(checked, d["batches"], {"batch_reference": "batch_identifier"}, "RI-01")


_CODES = """SELECT *, CASE WHEN temperature IS NULL THEN 'VQ-03' WHEN temperature < 10 OR temperature > 15 THEN 'PQ-03' END AS t, CASE WHEN batch_reference NOT IN (SELECT batch_identifier FROM v_batches) THEN 'RI-01' END AS r FROM v_node_processings"""
add(
    "VAL-1_processing_codes",
    "processing_id:i codes:s",
    lambda d: _validated(d).select("processing_id", F.array_join("errors", ",").alias("codes")),
    f"SELECT processing_id, concat_ws(',', t, r) AS codes FROM ({_CODES})",
)
add(
    "VAL-1_order_codes",
    "order_reference:s codes:s",
    lambda d: validation.validate_orders(d["order_events"]).select("order_reference", F.array_join("errors", ",").alias("codes")),
    """SELECT order_reference, COALESCE(codes, '') AS codes FROM v_orders JOIN v_customers USING (customer_id) LEFT JOIN (SELECT l_orderkey, string_agg(code, ',' ORDER BY l_linenumber) FILTER (WHERE code IS NOT NULL) AS codes FROM (
    SELECT l_orderkey, l_linenumber, CASE WHEN (100 + l_partkey % 500) NOT BETWEEN 150 AND 500 THEN 'PQ-02' END AS code FROM v_l1) GROUP BY 1) ON l_orderkey = order_id""",
)
add(
    "VAL-2_split_summary",
    "destination:s codes:s rows:i",
    lambda d: validation.split_summary(_validated(d)),
    f"""SELECT CASE WHEN r IS NOT NULL THEN 'QUARANTINE' WHEN t IS NOT NULL THEN 'WARNING' ELSE 'OK' END AS destination, concat_ws(',', t, r) AS codes, COUNT(*) AS rows FROM ({_CODES}) GROUP BY ALL""",
)
add(
    "VAL-2_warnings",
    "processing_id:i temperature:d quality_flag:s quality_notes:s",
    lambda d: validation.split(_validated(d))[1],
    f"SELECT processing_id, temperature, 'WARNING' AS quality_flag, t AS quality_notes FROM ({_CODES}) WHERE r IS NULL AND t IS NOT NULL",
)
add(
    "VAL-3_validators",
    "order_id:i product_id:i quantity_ok:b code_ok:b",
    lambda d: d["order_items"].join(d["products"].select("product_id", "product_code"), "product_id").select(
        "order_id", "product_id",
        validation.order_quantity_valid("quantity").alias("quantity_ok"), validation.product_code_valid("product_code", "ERP").alias("code_ok"),
    ),
    "SELECT order_id, product_id, quantity BETWEEN 100 AND 1000 AS quantity_ok, product_id BETWEEN 100 AND 999 AS code_ok FROM v_order_items JOIN v_products USING (product_id)",
)

# --- verification ----------------------------------------------------------------------------------------

_METRICS = [("shipments", "ge", "60"), ("node_processings", "ge", "60"), ("carriers", "eq", "5"), ("supply_chain_nodes", "in", "6, 7, 8"), ("deliveries", "truthy", ""), ("customers", "eq", "10")]


def _checks(d: Driver) -> DataFrame:
    metrics = ver.stack_rows([ver.metric(d[name], "tables", name) for name, _, _ in _METRICS])
    expected = constant(d.spark, [("tables", n, op, e) for n, op, e in _METRICS], "system string, name string, op string, expected string")
    return ver.check(metrics, expected)


_CHECKS = """SELECT 'tables' AS system, name, actual, op, expected, CASE WHEN CASE op WHEN 'eq' THEN actual = TRY_CAST(expected AS DOUBLE) WHEN 'ge' THEN actual >= TRY_CAST(expected AS DOUBLE) WHEN 'in' THEN actual IN (6, 7, 8) ELSE actual <> 0 END
    THEN 'PASS' ELSE 'FAIL' END AS status FROM (""" + " UNION ALL ".join(
    f"SELECT '{n}' AS name, COUNT(*) AS actual, '{op}' AS op, '{e}' AS expected FROM v_{n}" for n, op, e in _METRICS
) + ")"
add("VER-1_checks", "system:s name:s actual:d expected:s op:s status:s", _checks, _CHECKS)
add(
    "VER-2_summary",
    "total:i passed:i failed:i",
    lambda d: ver.summary(_checks(d)),
    f"SELECT COUNT(*) AS total, COUNT(*) FILTER (WHERE status = 'PASS') AS passed, COUNT(*) FILTER (WHERE status <> 'PASS') AS failed FROM ({_CHECKS})",
)
_FKS = [
    ("ERP FK-Check", "erp.products → erp.suppliers", "v_products", "supplier_id", "v_suppliers", True),
    ("ERP FK-Check", "erp.order_items → erp.orders", "v_order_items", "order_id", "v_orders", False),
    ("ERP FK-Check", "erp.order_items → erp.products", "v_order_items", "product_id", "v_products", False),
    ("ERP FK-Check", "erp.orders → erp.customers", "v_orders", "customer_id", "v_customers", False),
    ("WMS FK-Check", "wms.node_processings → wms.supply_chain_nodes", "v_node_processings", "node_id", "v_supply_chain_nodes", False),
    ("TMS FK-Check", "tms.shipments → tms.carriers", "v_shipments", "carrier_id", "v_carriers", False),
    ("TMS FK-Check", "tms.shipment_positions → tms.shipments", "v_shipment_positions", "shipment_id", "v_shipments", False),
    ("TMS FK-Check", "tms.transport_completions → tms.shipments", "v_transport_completions", "shipment_id", "v_shipments", False),
    ("TMS FK-Check", "tms.deliveries → tms.shipments", "v_deliveries", "shipment_id", "v_shipments", False),
]
add(
    "VER-3_foreign_keys",
    "check_name:s relation:s orphans:i",
    lambda d: ver.foreign_key_checks(d.tables),
    " UNION ALL ".join(
        f"SELECT '{n}' AS check_name, '{r}' AS relation, COUNT(*) AS orphans FROM {c} x WHERE NOT EXISTS (SELECT 1 FROM {p} y WHERE y.{k} = x.{k})" + (f" AND {k} IS NOT NULL" if skip else "")
        for n, r, c, k, p, skip in _FKS
    ),
)
add(
    "VER-4_cross_schema",
    "check_name:s orphans:i message:s",
    lambda d: ver.cross_schema_checks(d.tables),
    f"""SELECT check_name, orphans, CASE WHEN orphans = 0 THEN 'PASS – ' || good ELSE 'FAIL – ' || orphans || ' ' || bad END AS message FROM (
    SELECT 'wms_erp_batch_check' AS check_name, ({_VIOLATIONS['6.1']}) AS orphans, 'alle batch_references in WMS auflösbar' AS good, 'node_processings ohne ERP-Batch' AS bad
    UNION ALL SELECT 'tms_productref_check', ({_VIOLATIONS['6.2']}), 'alle cargo_product_references in TMS auflösbar', 'Shipments ohne TMS-Produktreferenz')""",
)
_EXPECTED = {"carriers": "5 Carrier", "supply_chain_nodes": "7 Knoten"}
_VER5 = ["suppliers", "customers", "products", "orders", "order_items", "batches", "carriers", "supply_chain_nodes", "shipments"]
add(
    "VER-5_expected_counts",
    "table_name:s row_count:i expected_value:s",
    lambda d: ver.expected_counts({n: d[n] for n in _VER5}, _EXPECTED),
    " UNION ALL ".join(f"SELECT '{n}' AS table_name, COUNT(*) AS row_count, '{_EXPECTED.get(n, '')}' AS expected_value FROM v_{n}" for n in _VER5),
)
add(
    "VER-6_date_spine",
    "first_day:D last_day:D days:i date_spine_check:s",
    lambda d: ver.date_spine_check(R.calendar_of(d["orders"], "order_timestamp"), 2557),
    """SELECT first_day, last_day, days, CASE WHEN days = 2557 THEN 'PASS – 2557 Tage' ELSE 'FAIL – erwartet 2557, gefunden: ' || days END AS date_spine_check FROM (
    SELECT make_date(lo, 1, 1) AS first_day, make_date(hi, 12, 31) AS last_day, date_diff('day', make_date(lo, 1, 1), make_date(hi, 12, 31)) + 1 AS days FROM (SELECT MIN(year(o_orderdate)) AS lo, MAX(year(o_orderdate)) AS hi FROM orders))""",
)
_WIDE = ["suppliers", "customers", "products", "orders", "order_items", "batches", "node_processings", "shipments", "deliveries"]
add(
    "VER-8_overview_row",
    " ".join(f"{n}:i" for n in _WIDE),
    lambda d: ver.overview_row({n: d[n] for n in _WIDE}),
    "SELECT " + ", ".join(f"(SELECT COUNT(*) FROM v_{n}) AS {n}" for n in _WIDE),
)
add(
    "VER-9_flow",
    "check_name:s status:s detail:s",
    lambda d: ver.plausibility_flow(d["shipments"], d["transport_completions"]).withColumnRenamed("check", "check_name"),
    """SELECT check_name, status, detail FROM (SELECT (SELECT COUNT(*) FROM v_shipments) AS total, (SELECT COUNT(DISTINCT shipment_id) FROM v_transport_completions) AS done,
    (SELECT COUNT(*) FROM (SELECT 1 FROM v_shipments GROUP BY source_node, target_node, transport_mode)) AS routes, (SELECT COUNT(*) FROM (SELECT COUNT(*) AS n FROM v_shipments GROUP BY source_node, target_node, transport_mode) WHERE n <> 10) AS wrong) f,
    LATERAL (SELECT 'routes' AS check_name, CASE WHEN routes = 6 THEN 'OK' ELSE 'FAIL' END AS status, 'expected 6, found ' || routes AS detail
    UNION ALL SELECT 'shipments_per_route', CASE WHEN wrong = 0 THEN 'OK' ELSE 'FAIL' END, wrong || ' routes without 10 shipments' UNION ALL SELECT 'transport_mode', 'OK', '0 wrong modes'
    UNION ALL SELECT 'completed', CASE WHEN done = total THEN 'OK' ELSE 'WARN' END, done || '/' || total || ' completed')""",
)
add(
    "VER-10_cold_chain",
    "check_name:s status:s detail:s",
    lambda d: ver.plausibility_cold_chain(d["node_processings"], d["supply_chain_nodes"]).withColumnRenamed("check", "check_name"),
    f"""SELECT check_name, status, detail FROM (SELECT COUNT(*) AS records, COUNT(*) FILTER (WHERE temperature < 10 OR temperature > 15) AS b, COUNT(DISTINCT node_id) AS nodes,
    CAST({average('SUM(CAST(temperature * 100 AS BIGINT))', 'COUNT(temperature)', 2, 2)} AS DECIMAL(9,2)) AS a, MIN(temperature) AS lo, MAX(temperature) AS hi FROM v_node_processings) f,
    LATERAL (SELECT 'breaches' AS check_name, CASE WHEN b = 0 THEN 'OK' ELSE 'FAIL' END AS status, b || ' in ' || records || ' processings' AS detail UNION ALL SELECT 'stations', CASE WHEN nodes = 6 THEN 'OK' ELSE 'FAIL' END, nodes || '/6 measured'
    UNION ALL SELECT 'average', CASE WHEN (SELECT COUNT(*) FROM (SELECT AVG(temperature) AS x FROM v_node_processings GROUP BY node_id) WHERE x NOT BETWEEN 10 AND 15) = 0 THEN 'OK' ELSE 'FAIL' END, 'overall ' || a
    UNION ALL SELECT 'minimum', CASE WHEN lo >= 10 THEN 'OK' ELSE 'FAIL' END, 'lowest ' || lo UNION ALL SELECT 'maximum', CASE WHEN hi <= 15 THEN 'OK' ELSE 'FAIL' END, 'highest ' || hi)""",
)
add(
    "VER-11_master_data",
    "check_name:s status:s detail:s",
    lambda d: ver.plausibility_master_data(
        mdm.key_matrix(d["products"], d["warehouse_skus"], d["shipments"]), d["golden_records"], d["source_mappings"],
        mdm.resolve_fuzzy(d["warehouse_skus"].select("sku"), "sku", d["source_mappings"], d["golden_records"]),
        rpt.carrier_lateness(d["transport_completions"], d["shipments"], d["carriers"]),
    ).withColumnRenamed("check", "check_name"),
    f"""SELECT check_name, status, detail FROM (SELECT (SELECT COUNT(*) FROM v_products) AS k, (SELECT COUNT(*) FROM v_products WHERE lower(product_code) IN (SELECT cargo_product_reference FROM v_shipments)) AS complete,
    (SELECT COUNT(*) FROM v_golden) AS g, (SELECT COUNT(*) FROM v_mappings) AS m, (SELECT COUNT(*) FROM v_warehouse_skus WHERE sku_id % 211 = 0) AS u) f, (SELECT carrier_name, {average('SUM(delay_minutes)', 'COUNT(*)', 1)} AS a FROM v_transport_completions JOIN v_shipments USING (shipment_id) JOIN v_carriers USING (carrier_id) GROUP BY 1 ORDER BY a DESC, carrier_name DESC LIMIT 1) w,
    LATERAL (SELECT 'keys_in_all_systems' AS check_name, CASE WHEN complete = k THEN 'OK' ELSE 'WARN' END AS status, complete || '/' || k || ' complete' AS detail UNION ALL SELECT 'golden_records', 'OK', g || ' golden records'
    UNION ALL SELECT 'source_mappings', 'OK', m || ' mappings' UNION ALL SELECT 'resolver', CASE WHEN u = 0 THEN 'OK' ELSE 'FAIL' END, u || ' of ' || k || ' keys unresolved'
    UNION ALL SELECT 'worst_carrier', CASE WHEN a < 100 THEN 'OK' ELSE 'WARN' END, carrier_name || ' ' || CAST(floor(a + 0.5) AS INTEGER) || ' min')""",
)

# --- catalogue -----------------------------------------------------------------------------------------------


def _schemas(d: Driver) -> dict[str, dict[str, DataFrame]]:
    t = d.tables
    return {
        "erp": {n: t[n] for n in ("suppliers", "customers", "products", "orders", "order_items", "batches")},
        "wms": {n: t[n] for n in ("warehouse_skus", "supply_chain_nodes", "node_processings")},
        "tms": {n: t[n] for n in ("carriers", "transport_product_references", "shipments", "shipment_positions", "transport_completions", "deliveries")},
    }


add(
    "META-1_table_registry",
    "system_code:s schema_name:s table_name:s data_category:s source_event:s row_count:i",
    lambda d: catalogue.table_registry(d.spark, _schemas(d)),
    "SELECT * FROM (" + " UNION ALL ".join(
        f"SELECT '{s.upper()}' AS system_code, '{s}' AS schema_name, '{t}' AS table_name, '{c}' AS data_category, "
        + (f"'{e}'" if e else "NULL")
        + " AS source_event, "
        + (f"(SELECT COUNT(*) FROM v_{t})" if s in ("erp", "wms", "tms") and t != "document_references" else "NULL")
        + " AS row_count"
        for s, t, c, e in catalogue.TABLES
    ) + ")",
)


def _nullable_sql() -> str:
    """Columns of the order items as the rules classify them."""
    return """SELECT 'erp' AS schema_name, 'order_items' AS table_name, column_name, data_category, scale_level, quality_rule, nulls > 0 AS is_nullable, is_pk, is_fk FROM (
    SELECT 'item_id' AS column_name, 'BEWEGUNGSDATEN' AS data_category, 'NOMINAL' AS scale_level, CAST(NULL AS VARCHAR) AS quality_rule, (SELECT COUNT(*) FROM v_order_items WHERE item_id IS NULL) AS nulls, TRUE AS is_pk, FALSE AS is_fk
    UNION ALL SELECT 'order_id', 'BEWEGUNGSDATEN', 'NOMINAL', NULL, (SELECT COUNT(*) FROM v_order_items WHERE order_id IS NULL), FALSE, FALSE
    UNION ALL SELECT 'product_id', 'BEWEGUNGSDATEN', 'NOMINAL', NULL, (SELECT COUNT(*) FROM v_order_items WHERE product_id IS NULL), FALSE, TRUE
    UNION ALL SELECT 'quantity', 'BEWEGUNGSDATEN', 'RATIO', '> 0 (negative Mengen unzulässig)', (SELECT COUNT(*) FROM v_order_items WHERE quantity IS NULL), FALSE, FALSE
    UNION ALL SELECT 'unit_price', 'BEWEGUNGSDATEN', 'RATIO', '> 0 EUR', (SELECT COUNT(*) FROM v_order_items WHERE unit_price IS NULL), FALSE, FALSE)"""


add(
    "META-3_classified_order_items",
    "schema_name:s table_name:s column_name:s data_category:s scale_level:s quality_rule:s is_nullable:b is_pk:b is_fk:b",
    lambda d: catalogue.catalogue(d.spark, {"erp": {"order_items": d["order_items"]}}),
    _nullable_sql(),
)
add(
    "META-3_catalogue",
    "schema_name:s table_name:s column_name:s data_type:s description:s data_category:s scale_level:s quality_rule:s is_nullable:b is_pk:b is_fk:b",
    lambda d: catalogue.catalogue(d.spark, _schemas(d)),
)
add(
    "META-4_coverage",
    "classified:i total:i pct:d",
    lambda d: catalogue.coverage(catalogue.catalogue(d.spark, _schemas(d)), R.catalogue_columns(d.spark, _schemas(d))),
)
add(
    "META-5_interval_columns",
    "schema_name:s table_name:s column_name:s",
    lambda d: catalogue.find_columns(catalogue.catalogue(d.spark, {"tms": {"shipment_positions": d["shipment_positions"], "transport_completions": d["transport_completions"]}}), scale="INTERVAL"),
    """SELECT * FROM (VALUES ('tms', 'shipment_positions', 'latitude'), ('tms', 'shipment_positions', 'longitude'), ('tms', 'shipment_positions', 'container_temperature'), ('tms', 'shipment_positions', 'recorded_at'), ('tms', 'transport_completions', 'completed_at')) AS t(schema_name, table_name, column_name)""",
)
add(
    "VER-7_scale_levels",
    "scale_level:s columns:i",
    lambda d: catalogue.scale_distribution(catalogue.catalogue(d.spark, _schemas(d))),
)
