"""Golden results of a small corpus, repeated loads, order of inputs."""

from __future__ import annotations

import json
from datetime import datetime

import pytest
from corpus import write
from pyspark.sql import functions as F

from freightloom.operators import catalogue, graph, live, mdm, quality
from freightloom.plans import kpi, load
from freightloom.plans import reports as rpt
from freightloom.sources.relations import calendar_of
from freightloom.sources.events import corrupt_events, read_events, route

LOADED = [
    "suppliers", "customers", "products", "orders", "order_items", "batches", "warehouse_skus", "node_processings", "carriers",
    "transport_product_references", "shipments", "shipment_positions", "transport_completions", "deliveries", "golden_records",
    "source_mappings", "dim_customer", "dim_product", "fact_fulfillment", "shipment_documents", "node_documents", "batch_documents",
    "order_documents", "document_references", "rejects",
]
EXPECTED = dict(
    suppliers=2, customers=2, products=3, orders=3, order_items=4, batches=3, warehouse_skus=3, node_processings=18, carriers=2,
    transport_product_references=3, shipments=18, shipment_positions=36, transport_completions=18, deliveries=3, golden_records=16,
    source_mappings=29, dim_customer=2, dim_product=3, fact_fulfillment=2, shipment_documents=18, node_documents=18, batch_documents=3,
    order_documents=4, document_references=28, rejects=2,
)


def _load(spark, source, base):
    write(source)
    store = load.TableStore(spark, str(base))
    for system in ("erp", "wms", "tms"):
        load.stage_events(store, read_events(spark, str(source), system))
    _all(store)
    return store


def _all(store):
    load.load_operational(store)
    load.load_master_data(store)
    load.load_star(store)
    load.load_documents(store)


@pytest.fixture(scope="module")
def store(spark, tmp_path_factory):
    return _load(spark, tmp_path_factory.mktemp("events"), tmp_path_factory.mktemp("tables"))


def _counts(store):
    return {r.table_name: r.row_count for r in load.statistics(store, LOADED).collect()}


def _tables(store):
    names = [
        "suppliers", "customers", "products", "orders", "order_items", "batches", "warehouse_skus", "supply_chain_nodes",
        "node_processings", "carriers", "transport_product_references", "shipments", "shipment_positions", "transport_completions",
        "deliveries", "source_mappings",
    ]
    return {n: store.table(n) for n in names}


def test_row_counts(store):
    assert _counts(store) == EXPECTED


def test_unreadable_file_is_kept_apart(spark, store, tmp_path):
    assert store.table("quarantine").count() == 1
    write(tmp_path)
    kept = read_events(spark, str(tmp_path), "tms", on_bad="drop")
    raw = read_events(spark, str(tmp_path), "tms")
    assert len(kept.collect()) == len(raw.collect()) - 1
    assert len(corrupt_events(raw).collect()) == 1


def test_loading_again_changes_nothing(store):
    before = {n: sorted(map(str, store.table(n).collect())) for n in ("orders", "order_items", "shipments", "dim_product", "fact_fulfillment")}
    _all(store)
    assert _counts(store) == EXPECTED
    for name, rows in before.items():
        assert sorted(map(str, store.table(name).collect())) == rows


def test_staging_again_changes_nothing(spark, store, tmp_path):
    write(tmp_path / "in")
    other = load.TableStore(spark, str(tmp_path / "out"))
    for _ in range(2):
        for system in ("erp", "wms", "tms"):
            load.stage_events(other, read_events(spark, str(tmp_path / "in"), system))
        _all(other)
        assert {n: other.table(n).count() for n in ("events", "quarantine", "rejects")} == {
            n: store.table(n).count() for n in ("events", "quarantine", "rejects")
        }
        assert _counts(other) == EXPECTED


def test_events_without_key_are_rejected(spark, tmp_path):
    folder = tmp_path / "in" / "erp"
    folder.mkdir(parents=True)
    rows = [{"event_type": "SupplierCreated", "timestamp": "2026-03-01T00:00:00", "supplier_name": "none"}, {"event_type": "SupplierCreated", "timestamp": "2026-03-01T00:00:00", "supplier_code": "S1"}]
    (folder / "a.json").write_text("\n".join(map(json.dumps, rows)), encoding="utf-8")
    store = load.TableStore(spark, str(tmp_path / "out"))
    load.stage_events(store, read_events(spark, str(tmp_path / "in"), "erp", multi_line=False))
    for _ in range(2):
        load.load_operational(store)
        assert [r.supplier_code for r in store.table("suppliers").collect()] == ["S1"]
        assert [r.reason for r in store.table("rejects").collect()] == ["missing_supplier_code"]


def test_events_that_break_a_constraint_are_rejected_and_later_ones_loaded(spark, tmp_path):
    folder = tmp_path / "in" / "wms"
    folder.mkdir(parents=True)
    base = {"event_type": "BatchHarvested", "batch_identifier": "B1", "product_code": "BAN-1"}
    rows = [base | {"timestamp": "2026-03-01T00:00:00", "quantity": -5}, base | {"timestamp": "2026-03-02T00:00:00", "quantity": 7}]
    (folder / "a.json").write_text("\n".join(map(json.dumps, rows)), encoding="utf-8")
    store = load.TableStore(spark, str(tmp_path / "out"))
    load.stage_events(store, read_events(spark, str(tmp_path / "in"), "wms", multi_line=False))
    for _ in range(2):
        load.load_operational(store)
        assert [(r.batch_identifier, r.quantity) for r in store.table("batches").collect()] == [("B1", 7)]
        assert [r.reason for r in store.table("rejects").collect()] == ["invalid_quantity"]


def test_unreadable_table_is_an_error(spark, tmp_path):
    (tmp_path / "bad").mkdir()
    (tmp_path / "bad" / "part-0.parquet").write_text("not parquet")
    store = load.TableStore(spark, str(tmp_path))
    assert store.read("nothing") is None
    with pytest.raises(Exception, match="(?i)parquet|footer"):
        store.read("bad").collect()


def test_every_day_of_the_fact_is_in_the_calendar(spark, store):
    for key in ("order_date_sk", "delivery_date_sk"):
        days = store.table("dim_date").select(F.col("date_sk").alias(key))
        assert store.table("fact_fulfillment").filter(F.col(key).isNotNull()).join(days, key, "left_anti").count() == 0
    late = spark.sql("SELECT TIMESTAMP_NTZ '2025-12-30 10:00:00' AS at UNION ALL SELECT TIMESTAMP_NTZ '2026-01-02 10:00:00'")
    assert calendar_of(late, "at").filter("date_sk = 20260102").count() == 1


def test_order_of_files_does_not_matter(spark, store, tmp_path):
    write(tmp_path / "in", reverse=True)
    other = load.TableStore(spark, str(tmp_path / "out"))
    for system in ("erp", "wms", "tms"):
        load.stage_events(other, read_events(spark, str(tmp_path / "in"), system))
    _all(other)
    for name in ("orders", "order_items", "fact_fulfillment", "shipment_documents", "batch_documents", "source_mappings"):
        assert sorted(map(str, other.table(name).collect())) == sorted(map(str, store.table(name).collect()))


def test_keys_are_harmonised(store):
    products = {r.product_code: r.supplier_id for r in store.table("products").collect()}
    assert set(products) == {"BAN-101", "BAN-102", "BAN-103"}
    assert products["BAN-103"] is None
    ids = [r.order_id for r in store.table("orders").collect()]
    assert sorted(ids) == [1, 2, 3]


def test_key_figures(store):
    fact = store.table("fact_fulfillment")
    row = kpi.kpi_summary(fact).first()
    # BAN-103 has no supplier and drops out; BAN-101 is valued with ORD-A, BAN-102 with its first line
    assert row.total_fulfillments == 2
    assert float(row.kpi_total_revenue_eur) == 25.0 + 12.0
    assert float(row.kpi_otd_rate_pct) == 50.0
    assert float(row.kpi_avg_delay_hours) == 0.08
    assert float(row.kpi_temp_outlier_pct) == 0.0
    months = kpi.monthly_revenue(fact, store.table("dim_date"), store.table("dim_product")).collect()
    assert {(m.year, m.month, m.month_name) for m in months} == {(2026, 3, "March")}


def test_reports(store):
    t = _tables(store)
    lateness = {r.carrier_name: (r.transports, float(r.avg_delay), r.max_delay) for r in rpt.carrier_lateness(t["transport_completions"], t["shipments"], t["carriers"]).collect()}
    assert lateness == {"Lines 1": (15, 10.0, 20), "Lines 2": (3, 10.0, 20)}
    empty = rpt.processings_per_node(t["supply_chain_nodes"], t["node_processings"]).filter("node_name = 'Retail Store'").first()
    assert empty.processings == 0
    ordered = rpt.in_order(rpt.nodes_in_sequence(t["supply_chain_nodes"]), "nodes_in_sequence").collect()
    assert [r.sequence_order for r in ordered] == list(range(1, 8))


def test_audit_finds_only_what_is_planted(store):
    period = quality.Period(datetime(2026, 1, 1), datetime(2026, 6, 1))
    audit = {r.number: r.violations for r in quality.dq_audit(_tables(store), period).collect()}
    assert len(audit) == 28
    assert {n: v for n, v in audit.items() if v} == {"1.1": 1, "4.4": 1}


def test_graph(store):
    t = _tables(store)
    edges = graph.graph_edges(t)
    path = graph.shortest_path(edges, "BANANA_PLANTATION", "RETAIL_STORE").first()
    assert (path.hops, path.total_weight) == (6, 263.0)
    hubs = graph.hub_edges(t)
    assert {r.type: r.edges for r in graph.hub_edge_counts(hubs).collect()} == {"TRIGGERED": 4, "TRANSPORTED_VIA": 18, "DELIVERED_TO": 3}
    chain = graph.fulfilment_chain(graph.graph_nodes(t), edges, hubs, "ORD-B").collect()
    assert {c.batch for c in chain} == {"BATCH-1", "BATCH-2"} and len(chain) == 12
    backwards = graph.shortest_path(edges, "RETAIL_STORE", "BANANA_PLANTATION")
    assert backwards.count() == 0
    stay = graph.shortest_path(edges, "RETAIL_STORE", "RETAIL_STORE").first()
    assert (stay.hops, stay.stations) == (0, ["RETAIL_STORE"])


def test_documents(store):
    doc = store.table("shipment_documents").filter("shipment_identifier = 'SHIP-1-5-00001234'").first()
    assert doc.delivery_status == "DELAYED" and doc.delay_minutes == 10
    parts = store.table("shipment_events").filter("shipment_identifier = 'SHIP-1-5-00001234'").orderBy("part").collect()
    assert [e.event_type for p in parts for e in p.events] == [
        "TransportStarted", "ShipmentPositionUpdated", "ShipmentPositionUpdated", "TransportCompleted", "DeliveryCompleted",
    ]
    batch = store.table("batch_documents").filter("batch_identifier = 'BATCH-0'").first()
    assert batch.current_node == "CENTRAL_WAREHOUSE"
    stations = store.table("batch_stations").filter("batch_identifier = 'BATCH-0'").collect()
    assert sum(len(s.nodes_processed) for s in stations) == 6
    by_type = {r["document_type"]: r["count"] for r in store.table("document_references").groupBy("document_type").count().collect()}
    assert by_type == {"delivery_note": 18, "bill_of_lading": 3, "customs_clearance": 3, "invoice": 1, "quality_certificate": 3}
    lading = store.table("document_references").filter("document_type = 'bill_of_lading'").first()
    assert lading.fields["number"] == "BL-00001234" and lading.object_path.endswith("/bill_of_lading.pdf")


def test_live_state(store):
    events = store.table("events")
    started, delivered = route(events, "TransportStarted"), route(events, "DeliveryCompleted")
    assert live.active_shipments(started, delivered).first().active_shipments == 15
    status = {r.shipment_identifier: r.status for r in live.shipment_status(started, delivered).collect()}
    assert status["SHIP-0-5-00001234"] == "SUCCESSFUL" and status["SHIP-0-0-00001234"] == "IN_TRANSIT"
    ranking = live.violation_ranking(route(events, "ShipmentPositionUpdated")).collect()
    assert len(ranking) == 1 and ranking[0].member.endswith(":temp=16.5")
    cache = {r.product_code: r.unit_price for r in live.product_cache(route(events, "ProductCreated"), route(events, "OrderCreated")).collect()}
    assert cache == {"BAN-101": "", "BAN-102": "", "BAN-103": ""}
    today = live.orders_today(route(events, "OrderCreated"), datetime(2026, 3, 1, 23))
    assert today.first().orders_today == 4


def test_unknown_key_resolves_to_null(spark, store):
    asked = spark.createDataFrame([("BANANA-101",), ("ban_102",), ("BAN 103",), ("BAN-103",)], "k string")
    got = {r.k: r.canonical_key for r in mdm.resolve_fuzzy(asked, "k", store.table("source_mappings"), store.table("golden_records")).collect()}
    assert got == {"BANANA-101": None, "ban_102": "BAN-102", "BAN 103": None, "BAN-103": "BAN-103"}


def test_catalogue(spark, store):
    schemas = {"erp": {n: store.table(n) for n in ("products", "orders")}, "dwh": {"dim_date": store.table("dim_date")}}
    rows = {(r.table_name, r.column_name): r for r in catalogue.catalogue(spark, schemas).collect()}
    assert rows["products", "supplier_id"].is_nullable and not rows["products", "product_code"].is_nullable
    assert rows["orders", "delivery_priority"].scale_level == "ORDINAL"
    assert rows["orders", "order_timestamp"].scale_level == "INTERVAL"
    assert rows["dim_date", "is_weekend"].scale_level == "NOMINAL"
    assert rows["dim_date", "date_sk"].scale_level == "ORDINAL" and rows["dim_date", "date_sk"].is_pk
    curated = catalogue.curated_entries(
        spark, "erp", "orders", [("delivery_priority", "VARCHAR(10)", "by hand", "BEWEGUNGSDATEN", "ORDINAL", "", False, False, False)]
    )
    mixed = catalogue.catalogue(spark, schemas, curated)
    assert mixed.count() == len(rows)
    assert mixed.filter("column_name = 'delivery_priority'").first().description == "by hand"
    assert catalogue.find_columns(mixed, schema="erp", with_rule=True).filter(F.col("column_name") == "product_code").count() == 1
