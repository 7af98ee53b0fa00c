"""Operators against brute force, hot keys included."""

from __future__ import annotations

import random
from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from freightloom.functions import keys
from freightloom.operators import graph, lifecycle, live, manifest, quality, skew, validation, verification, writes

NOW = datetime(2026, 3, 1)


def test_parts_of_a_hot_key_lie_in_several_tasks_and_join_to_the_sorted_list(spark):
    rows = [("hot", i) for i in range(20_000)] + [(f"cold {i}", i) for i in range(10_000)]
    df = spark.createDataFrame(rows, "k string, v int").repartition(4)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        listed = skew.bounded_lists(df, ["k"], F.col("v"), "vs", F.floor(F.col("v") / 500).cast("int"))
        parts = listed.withColumn("task", F.spark_partition_id()).collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    hot = sorted((p for p in parts if p.k == "hot"), key=lambda p: p.part)
    assert len({p.task for p in hot}) > 1 and all(len(p.vs) == 500 for p in hot)
    assert [v for p in hot for v in p.vs] == list(range(20_000))
    assert all((p.part, p.vs) == (int(p.k[5:]) // 500, [int(p.k[5:])]) for p in parts if p.k != "hot")


def test_lists_without_key(spark):
    parts = skew.bounded_lists(spark.range(100), [], F.col("id"), "ids", F.floor(F.col("id") / 30)).collect()
    assert [i for p in sorted(parts, key=lambda p: p.part) for i in p.ids] == list(range(100)) and len(parts) == 4


def test_first_per_key_limits_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), F.col("id").alias("v"))
    first = skew.first_per_key(df, ["k"], [F.col("v").desc()])
    assert {r.k: r.v for r in first.collect()} == {0: 999, 1: 997, 2: 998}
    plan = first._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("WindowGroupLimit") == 2  # one before and one after the exchange


def test_orphan_count_equals_row_count(spark):
    child = spark.createDataFrame([(1,)] * 50 + [(2,)] * 3 + [(None,)] * 2, "k int")
    parent = spark.createDataFrame([(2,), (3,)], "k int")
    assert skew.orphan_count(child, parent, {"k": "k"}).first().orphans == 52


def test_keys_are_dense_and_go_on(spark):
    first = writes.assign_keys(spark.range(100).select(F.col("id").cast("string").alias("name")), "name", "sk", buckets=7)
    assert sorted(r.sk for r in first.collect()) == list(range(1, 101))
    more = spark.createDataFrame([("x",), ("y",)], "name string")
    assert sorted(r.sk for r in writes.assign_keys(more, "name", "sk", first, buckets=7).collect()) == [101, 102]


def test_write_semantics(spark):
    target = spark.createDataFrame([(1, "old", 0)], "k int, v string, at int")
    new = spark.createDataFrame([(1, "a", 1), (2, "b", 2), (2, "c", 3)], "k int, v string, at int")
    assert {tuple(r) for r in writes.insert_ignore(new, target, ["k"], ["at"]).collect()} == {(2, "b", 2)}
    assert {tuple(r) for r in writes.upsert_last(new, target, ["k"], ["at"]).collect()} == {(1, "a", 1), (2, "c", 3)}
    assert writes.add_to_set(new, new.filter("k = 2")).count() == 1
    known, lost = writes.split_unresolved(new, target, {"k": "k"}, "unknown")
    assert known.count() == 1 and writes.reject_counts(lost).first().skipped == 2


def test_key_functions_in_sql(spark):
    keys.register_sql_functions(spark)
    row = spark.sql(r"SELECT normalize_key(' ban_101\t') AS a, match_key('BAN_101 ') AS b").first()
    assert (row.a, row.b) == ("BAN-101", "ban-101")


def _positions(spark, count, ship="S", step=timedelta(seconds=1)):
    rows = [(ship, NOW + i * step, Decimal("1.5"), Decimal("2.5"), Decimal("12.00"), Decimal("50.00")) for i in range(count)]
    return spark.createDataFrame(
        rows,
        "shipment_identifier string, event_timestamp timestamp_ntz, latitude decimal(9,6), longitude decimal(9,6), "
        "container_temperature decimal(5,2), speed_kmh decimal(6,2)",
    )


def test_lifecycle_of_a_hot_shipment_comes_in_parts_by_day(spark):
    started = spark.createDataFrame(
        [("S", NOW, "ban-1", "A", "B", "TRUCK", ("C", "c"), NOW)],
        "shipment_identifier string, event_timestamp timestamp_ntz, cargo_product_reference string, source_node string, target_node string, "
        "transport_mode string, carrier struct<carrier_id:string,carrier_name:string>, estimated_arrival timestamp_ntz",
    )
    done = spark.createDataFrame([("S", NOW, "B", 5)], "shipment_identifier string, event_timestamp timestamp_ntz, arrival_node string, delay_minutes int")
    final = spark.createDataFrame([], "shipment_identifier string, event_timestamp timestamp_ntz, delivery_status string, received_by string")
    points = _positions(spark, 300, step=timedelta(minutes=15))
    docs = lifecycle.shipment_lifecycle(started, points.union(points), done, final).collect()
    assert [(d.delivery_status, d.updated_at) for d in docs] == [("TRANSPORT_COMPLETED", points.agg(F.max("event_timestamp")).first()[0])]
    parts = sorted(lifecycle.shipment_events(started, points.union(points), done, final).collect(), key=lambda p: p.part)
    assert [p.part for p in parts] == [20260301, 20260302, 20260303, 20260304]
    events = [e for p in parts for e in p.events]
    assert len(events) == 302 and events == sorted(events, key=lambda e: (e.timestamp, e.rank))
    assert [p.part for p in live.route_history(points).orderBy("part").collect()] == [20260301, 20260302, 20260303, 20260304]


@pytest.mark.parametrize("seed", range(3))
def test_active_shipments_never_fall_below_zero(spark, seed):
    rng = random.Random(seed)
    steps = [(NOW + timedelta(seconds=rng.randrange(400_000)), rng.choice([1, -1, -1])) for _ in range(300)]
    make = lambda sign: spark.createDataFrame([(t,) for t, s in steps if s == sign], "event_timestamp timestamp_ntz")
    active = 0
    for _, step in sorted(steps, key=lambda x: (x[0], -x[1])):
        active = max(0, active + step)
    assert live.active_shipments(make(1), make(-1)).first().active_shipments == active


def test_hub_edges_equal_their_pairs(spark):
    rows = [("T", "src", "p", f"o{i}") for i in range(40)] + [("T", "dst", "p", f"b{i}") for i in range(30)] + [("T", "src", "q", "o1"), ("T", "dst", "q", "b99")]
    hubs = spark.createDataFrame(rows, "type string, side string, hub string, id string").withColumn("properties", F.create_map().cast("map<string,string>"))
    assert graph.hub_edge_counts(hubs).first().edges == 40 * 30 + 1
    pairs = graph.expand(hubs, "T", spark.createDataFrame([("o1",)], "id string"))
    assert {r.dst for r in pairs.collect()} == {f"b{i}" for i in range(30)} | {"b99"}
    assert {r.id: r.degree for r in graph.out_degrees(hubs, "T").collect()}["o1"] == 31


def test_shortest_path_on_random_graphs(spark):
    rng = random.Random(5)
    links = {(rng.randrange(30), rng.randrange(30)) for _ in range(60)}
    edges = spark.createDataFrame([("L", str(a), str(b), {"m": "x", "w": "1"}) for a, b in links], "type string, src string, dst string, properties map<string,string>")
    reach, frontier, hops = {0}, {0}, 0
    distance = {0: 0}
    while frontier:
        hops += 1
        frontier = {b for a, b in links if a in frontier} - reach
        reach |= frontier
        distance |= {n: hops for n in frontier}
    far = max(distance, key=lambda n: (distance[n], n))
    path = graph.shortest_path(edges, "0", str(far), "L", "w", "m").first()
    assert path.hops == distance[far]
    assert all((int(a), int(b)) in links for a, b in zip(path.stations, path.stations[1:]))
    chain = spark.createDataFrame([("L", f"c{i}", f"c{i + 1}", {"m": "x", "w": "1"}) for i in range(40)], edges.schema)
    assert graph.shortest_path(chain, "c0", "c40", "L", "w", "m").first().hops == 40
    assert graph.shortest_path(chain, "c0", "c40", "L", "w", "m", max_hops=39).count() == 0
    nowhere = graph.shortest_path(edges, "0", "none", "L", "w", "m")
    assert nowhere.count() == 0


def test_order_texts_of_one_page_and_of_many(spark):
    orders = spark.createDataFrame([(1, "Shop", "Town", "Main"), (2, "Big", "City", "Side")], "order_id long, customer_name string, city string, warehouse string")
    lines = [(1, 10, 2, Decimal("1.50"), 0), (1, 11, 1, Decimal("2.00"), None)] + [(2, i, 1, Decimal("1.00"), i) for i in range(100)]
    items = spark.createDataFrame(lines, "order_id long, product_id long, quantity int, unit_price decimal(10,2), position int")
    products = spark.createDataFrame([(i, f"P{i:03d}") for i in range(100)], "product_id long, product_name string")
    pages = manifest.order_texts(orders, items, products, page_lines=20).collect()
    one = next(p for p in pages if p.order_id == 1)
    assert one.invoice_text == "INVOICE 1\nShop (Town)\n\nP010 x 2 = 3.00\nP011 x 1 = 2.00\n\nTOTAL: 5.00"
    assert one.delivery_text == "DELIVERY 1\nWarehouse: Main\n\nP010 -> 2\nP011 -> 1"
    many = [p for p in pages if p.order_id == 2]
    assert len(many) == 5 and {float(p.total) for p in many} == {100.0}
    assert sum(p.invoice_text.count(" x 1 = ") for p in many) == 100


def test_validation_and_quarantine(spark):
    rows = [("b1", Decimal("12.00")), ("b1", None), ("b1", Decimal("9.99")), ("lost", Decimal("12.00"))]
    df = spark.createDataFrame(rows, "batch_reference string, temperature decimal(5,2)")
    batches = spark.createDataFrame([("b1",), ("b1",)], "batch_identifier string")
    checked = validation.validate_references(validation.validate_processings(df), batches, {"batch_reference": "batch_identifier"}, "RI-01")
    ok, warning, quarantine = validation.split(checked)
    assert (ok.count(), quarantine.count()) == (1, 1)
    assert {r.quality_notes for r in warning.collect()} == {"VQ-03", "PQ-03"}
    formats = spark.createDataFrame([("BAN-101", "BAN_101", "ban-101")], "e string, w string, t string").select(
        *[validation.product_code_valid(c, s) for c, s in (("e", "ERP"), ("w", "WMS"), ("t", "TMS"), ("e", "TMS"))]
    )
    assert tuple(formats.first()) == (True, True, True, False)


def test_expectation_operators(spark):
    metrics = spark.createDataFrame([("s", "a", 5.0), ("s", "b", 0.0)], "system string, name string, actual double")
    wanted = [("a", "eq", "5"), ("a", "ge", "6"), ("a", "in", "1, 5"), ("a", "truthy", ""), ("b", "truthy", ""), ("missing", "ge", "0")]
    expected = spark.createDataFrame([("s", *w) for w in wanted], "system string, name string, op string, expected string")
    checks = verification.check(metrics, expected)
    assert [(r.name, r.op, r.status) for r in checks.orderBy("name", "op").collect()] == [
        ("a", "eq", "PASS"), ("a", "ge", "FAIL"), ("a", "in", "PASS"), ("a", "truthy", "PASS"), ("b", "truthy", "FAIL"), ("missing", "ge", "FAIL"),
    ]
    assert tuple(verification.summary(checks).first()) == (6, 3, 3)


def test_constraints_send_rows_to_the_rejects(spark):
    rows = spark.createDataFrame([(1, Decimal("2.00")), (0, Decimal("0.00")), (None, None)], "quantity int, unit_price decimal(10,2)")
    ok, bad = quality.enforce("order_items", rows)
    assert ok.count() == 2 and bad.first().reason == "quantity,unit_price"


# one planted violation per rule: table, values of a row that is otherwise fine
FAULTS = {
    "1.1": ("products", dict(supplier_id=None)),
    "1.2": ("order_items", dict(unit_price=None)),
    "1.3": ("node_processings", dict(temperature=None)),
    "1.4": ("deliveries", dict(received_by=None)),
    "4.1": ("order_items", dict(quantity=0)),
    "4.2": ("order_items", dict(unit_price=Decimal("5.01"))),
    "4.3": ("node_processings", dict(temperature=Decimal("15.01"))),
    "4.4": ("shipment_positions", dict(container_temperature=Decimal("9.99"))),
    "4.5": ("shipment_positions", dict(latitude=Decimal("90.000001"))),
    "4.6": ("deliveries", dict(delivery_status="UNKNOWN")),
    "4.7": ("orders", dict(delivery_priority="URGENT")),
    "4.8": ("transport_completions", dict(delay_minutes=181)),
    "4.9": ("shipment_positions", dict(speed_kmh=Decimal("-1.00"))),
    "5.2": ("batches", dict(harvested_at=datetime(2025, 12, 31))),
    "6.3": ("shipments", dict(carrier_id=None)),
}
GOOD = {
    "products": ("supplier_id long, event_timestamp timestamp_ntz", dict(supplier_id=1, event_timestamp=NOW)),
    "order_items": ("quantity int, unit_price decimal(10,2)", dict(quantity=1, unit_price=Decimal("2.00"))),
    "node_processings": ("temperature decimal(5,2)", dict(temperature=Decimal("10.00"))),
    "deliveries": ("delivery_status string, received_by string", dict(delivery_status="SUCCESSFUL", received_by="E")),
    "orders": ("delivery_priority string", dict(delivery_priority="LOW")),
    "shipment_positions": (
        "container_temperature decimal(5,2), latitude decimal(9,6), longitude decimal(9,6), speed_kmh decimal(6,2)",
        dict(container_temperature=Decimal("15.00"), latitude=Decimal("90"), longitude=Decimal("-180"), speed_kmh=Decimal("200")),
    ),
    "transport_completions": ("delay_minutes int", dict(delay_minutes=180)),
    "batches": ("harvested_at timestamp_ntz", dict(harvested_at=NOW)),
    "shipments": ("carrier_id long", dict(carrier_id=1)),
}


def test_each_planted_fault_moves_its_rule_only(spark):
    period = quality.Period(datetime(2026, 1, 1), datetime(2026, 6, 1))
    rules = quality.row_rules(period)
    for table, (schema, good) in GOOD.items():
        faults = {n: v for n, (t, v) in FAULTS.items() if t == table}
        rows = [good] + [good | v for v in faults.values()]
        df = spark.createDataFrame([tuple(r.values()) for r in rows], schema)
        conditions = {n: c for n, c in rules[table].items() if n in FAULTS}
        flags = df.select(*[F.coalesce(c, F.lit(False)).alias(n) for n, c in conditions.items()]).collect()
        assert not any(flags[0])
        for row, number in zip(flags[1:], faults):
            broken = {n for n in conditions if row[n]}
            assert broken == {number}, (table, number, broken)
