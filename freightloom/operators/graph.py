"""Property graph as ``nodes`` and ``edges`` relations.

Most edges are stored one by one. Three types link everything of one
product with everything else of it (orders with batches, batches with
shipments, delivered shipments with customers). Their pairs grow with the
square of a product's rows, so these are stored through a hub: one row per
end, carrying the product. Counts and degrees are exact on that form, and
``expand`` yields the pairs of the sources one asks for.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from freightloom import constants as C
from freightloom.functions.keys import normalize_key
from freightloom.functions.numbers import breaks_cold_chain, exact, mean
from freightloom.operators.skew import bounded_lists, matched
from freightloom.session import shared_dir
from freightloom.sources.constant import constant
from freightloom.sources.relations import carrier_node_types, graph_node_names, topology

Tables = dict[str, DataFrame]


#: Numbers of a code that share a list.
CODES_PER_PART = 1_000


def _props(**values: Column) -> Column:
    pairs: list[Column] = []
    for name, value in values.items():
        pairs += [F.lit(name), value.cast("string")]
    return F.create_map(*pairs) if pairs else F.create_map().cast("map<string,string>")


def _node(df: DataFrame, label: str, key: str, **properties: Column) -> DataFrame:
    return df.select(F.lit(label).alias("label"), F.col(key).alias("id"), _props(**properties).alias("properties"))


def _edge(df: DataFrame, kind: str, src: Column, dst: Column, **properties: Column) -> DataFrame:
    return df.select(
        F.lit(kind).alias("type"), src.alias("src"), dst.alias("dst"), _props(**properties).alias("properties")
    )


def _union(parts: list[DataFrame]) -> DataFrame:
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole


def graph_nodes(t: Tables) -> DataFrame:
    """Nodes of eight labels: label, id, properties."""
    c = F.col
    names = graph_node_names(t["supply_chain_nodes"].sparkSession)
    stations = t["supply_chain_nodes"].join(names, "node_code", "left")
    products = t["products"].select("product_id", "product_code")
    return _union(
        [
            _node(
                stations, "SupplyChainNode", "node_code", node_name=F.coalesce("graph_name", "node_name"),
                node_type=c("node_type"), region=c("region"), sequence_order=c("sequence_order"),
            ),
            _node(t["suppliers"], "Supplier", "supplier_code", supplier_name=c("supplier_name"), country=c("country")),
            _node(
                t["customers"], "Customer", "customer_number", customer_name=c("customer_name"), city=c("city"),
                country=c("country"),
            ),
            _node(t["products"], "Product", "product_code", product_name=c("product_name"), category=c("category")),
            _node(t["carriers"], "Carrier", "carrier_code", carrier_name=c("carrier_name")),
            _node(
                t["orders"], "Order", "order_reference", delivery_priority=c("delivery_priority"),
                order_date=c("order_timestamp"),
            ),
            _node(
                t["batches"].join(products, "product_id", "left"), "Batch", "batch_identifier", quantity=c("quantity"),
                origin_country=c("origin_country"), product_code=c("product_code"),
            ),
            _node(
                t["shipments"], "Shipment", "shipment_identifier", transport_mode=c("transport_mode"),
                started_at=c("started_at"), cargo_product_reference=normalize_key("cargo_product_reference"),
            ),
        ]
    )


def master_edges(t: Tables) -> DataFrame:
    """SUPPLIES, DELIVERS_TO, RECEIVES_FROM, CONNECTED_TO and OPERATES_ON."""
    c = F.col
    spark = t["suppliers"].sparkSession
    supplied = t["products"].join(t["suppliers"].select("supplier_id", "supplier_code"), "supplier_id")
    operated = (
        t["carriers"]
        .join(carrier_node_types(spark), "carrier_code")
        .join(t["supply_chain_nodes"].select("node_code", "node_type"), "node_type")
    )
    return _union(
        [
            _edge(supplied, "SUPPLIES", c("supplier_code"), c("product_code")),
            _edge(t["suppliers"], "DELIVERS_TO", c("supplier_code"), F.lit(C.ORIGIN_NODE)),
            _edge(t["customers"], "RECEIVES_FROM", c("customer_number"), F.lit(C.DESTINATION_NODE)),
            _edge(
                topology(spark), "CONNECTED_TO", c("source_node"), c("target_node"), transport_mode=c("transport_mode"),
                typical_hours=c("typical_hours"),
            ),
            _edge(operated, "OPERATES_ON", c("carrier_code"), c("node_code"), transport_mode=c("transport_mode")),
        ]
    )


def order_edges(t: Tables) -> DataFrame:
    """PLACED and CONTAINS."""
    c = F.col
    placed = t["orders"].join(t["customers"].select("customer_id", "customer_number"), "customer_id")
    lines = (
        t["order_items"]
        .join(t["orders"].select("order_id", "order_reference"), "order_id")
        .join(t["products"].select("product_id", "product_code"), "product_id")
        .select("order_reference", "product_code", "quantity", "unit_price")
        .distinct()
    )
    return _union(
        [
            _edge(placed, "PLACED", c("customer_number"), c("order_reference"), timestamp=c("order_timestamp")),
            _edge(
                lines, "CONTAINS", c("order_reference"), c("product_code"), quantity=c("quantity"),
                unit_price=c("unit_price"),
            ),
        ]
    )


def shipment_edges(t: Tables) -> DataFrame:
    """FROM, TO and TRANSPORTED_BY; the ends must be known stations and carriers."""
    c = F.col
    codes = t["supply_chain_nodes"].select("node_code")
    routed = matched(t["shipments"], codes, {"source_node": "node_code"}, keep=True)
    routed = matched(routed, codes, {"target_node": "node_code"}, keep=True)
    carried = routed.join(t["carriers"].select("carrier_id", "carrier_code"), "carrier_id")
    return _union(
        [
            _edge(routed, "FROM", c("shipment_identifier"), c("source_node")),
            _edge(routed, "TO", c("shipment_identifier"), c("target_node")),
            _edge(carried, "TRANSPORTED_BY", c("shipment_identifier"), c("carrier_code")),
        ]
    )


def processing_edges(t: Tables) -> DataFrame:
    """PROCESSED_AT from known batches to stations."""
    c = F.col
    known = matched(t["node_processings"], t["batches"], {"batch_reference": "batch_identifier"}, keep=True)
    at = known.join(t["supply_chain_nodes"].select("node_id", "node_code"), "node_id")
    return _edge(
        at, "PROCESSED_AT", c("batch_reference"), c("node_code"), temperature=c("temperature"),
        status=F.coalesce("status", F.lit("COMPLETED")), processed_at=c("processed_at"),
    )


def graph_edges(t: Tables) -> DataFrame:
    """All edges stored one by one: type, src, dst, properties."""
    return _union([master_edges(t), order_edges(t), shipment_edges(t), processing_edges(t)])


# --- edges through a product hub ------------------------------------------------


def hub_edges(t: Tables) -> DataFrame:
    """Ends of TRIGGERED, TRANSPORTED_VIA and DELIVERED_TO by product.

    Columns type, side (``src`` or ``dst``), hub, id, properties. Every src
    is linked with every dst of the same type and hub.
    """
    c = F.col
    codes = t["products"].select("product_id", "product_code")
    ordered = (
        t["order_items"]
        .join(codes, "product_id")
        .join(t["orders"].select("order_id", "order_reference", "customer_id"), "order_id")
    )
    batches = t["batches"].join(codes, "product_id").select("batch_identifier", "product_code")
    shipments = t["shipments"].select(
        "shipment_id", "shipment_identifier", normalize_key("cargo_product_reference").alias("product_code")
    )
    harvested = batches.select("product_code").distinct()
    delivered = shipments.join(
        t["deliveries"].select("shipment_id", "delivery_status", "received_by", "delivered_at"), "shipment_id"
    ).join(harvested, "product_code", "left_semi")
    buyers = (
        ordered.select("product_code", "customer_id")
        .distinct()
        .join(harvested, "product_code", "left_semi")
        .join(t["customers"].select("customer_id", "customer_number"), "customer_id")
    )

    def end(df: DataFrame, kind: str, side: str, key: str, **properties: Column) -> DataFrame:
        return df.select(
            F.lit(kind).alias("type"), F.lit(side).alias("side"), c("product_code").alias("hub"), c(key).alias("id"),
            _props(**properties).alias("properties"),
        )

    orders = ordered.select("product_code", "order_reference").distinct()
    return _union(
        [
            end(orders, "TRIGGERED", "src", "order_reference"),
            end(batches, "TRIGGERED", "dst", "batch_identifier"),
            end(batches, "TRANSPORTED_VIA", "src", "batch_identifier"),
            end(shipments, "TRANSPORTED_VIA", "dst", "shipment_identifier"),
            end(
                delivered, "DELIVERED_TO", "src", "shipment_identifier", delivery_status=c("delivery_status"),
                received_by=c("received_by"), delivered_at=c("delivered_at"),
            ),
            end(buyers, "DELIVERED_TO", "dst", "customer_number"),
        ]
    )


def hub_sizes(hubs: DataFrame) -> DataFrame:
    """Ends on either side of each hub: type, hub, sources, targets."""
    return hubs.groupBy("type", "hub").agg(
        F.count_if(F.col("side") == "src").alias("sources"), F.count_if(F.col("side") == "dst").alias("targets")
    )


def hub_edge_counts(hubs: DataFrame) -> DataFrame:
    """Exact number of pairs per type, without forming them."""
    pairs = F.sum(F.col("sources").cast("decimal(38,0)") * F.col("targets").cast("decimal(38,0)"))
    return hub_sizes(hubs).groupBy("type").agg(pairs.cast("long").alias("edges"))


def out_degrees(hubs: DataFrame, kind: str) -> DataFrame:
    """Partners of each source of one type: id, degree. Sources without partner are left out."""
    ends = hubs.filter(F.col("type") == kind)
    targets = ends.filter(F.col("side") == "dst").groupBy("hub").agg(F.count("*").alias("n"))
    return (
        ends.filter(F.col("side") == "src")
        .join(targets, "hub")
        .groupBy("id")
        .agg(F.sum("n").alias("degree"))
    )


def expand(hubs: DataFrame, kind: str, sources: DataFrame) -> DataFrame:
    """Edges of one type that start at the given ids (column ``id``)."""
    ends = hubs.filter(F.col("type") == kind)
    asked = ends.filter(F.col("side") == "src").join(sources.select("id").distinct(), "id", "left_semi")
    targets = ends.filter(F.col("side") == "dst").select("hub", F.col("id").alias("dst"))
    return (
        asked.join(targets, "hub")
        .select(F.lit(kind).alias("type"), F.col("id").alias("src"), "dst", "properties")
        .dropDuplicates(["src", "dst"])
    )


# --- counts ------------------------------------------------------------------------


def node_counts(nodes: DataFrame) -> DataFrame:
    """Nodes per label."""
    return nodes.groupBy("label").agg(F.count("*").alias("nodes"))


def edge_counts(edges: DataFrame, hubs: DataFrame | None = None) -> DataFrame:
    """Edges per type, those through hubs included when given."""
    counts = edges.groupBy("type").agg(F.count("*").alias("edges"))
    return counts if hubs is None else counts.unionByName(hub_edge_counts(hubs))


# --- patterns ----------------------------------------------------------------------


def of_type(edges: DataFrame, kind: str, src: str, dst: str) -> DataFrame:
    """Edges of one type with their ends under the given names."""
    return edges.filter(F.col("type") == kind).select(
        F.col("src").alias(src), F.col("dst").alias(dst), F.col("properties").alias(f"{src}_{dst}")
    )


def attributes(nodes: DataFrame, label: str, key: str, *names: str) -> DataFrame:
    """Nodes of one label as a flat relation of chosen properties."""
    return nodes.filter(F.col("label") == label).select(
        F.col("id").alias(key), *[F.col("properties")[n].alias(n) for n in names]
    )


def shortest_path(
    edges: DataFrame,
    src: str,
    dst: str,
    edge_type: str = "CONNECTED_TO",
    weight: str = "typical_hours",
    mode: str = "transport_mode",
    max_hops: int | None = None,
) -> DataFrame:
    """Path with the fewest hops: stations, modes, total weight, hops.

    Breadth-first search; each level is one join with the edges and holds
    the nodes reached for the first time with one parent each. The edges are
    checkpointed once, so no level derives them again, and so are the levels:
    a lost executor costs one level. No row when there is
    no path, or none of at most ``max_hops`` hops where that is given.
    """
    spark = edges.sparkSession
    shared_dir(spark)
    steps = edges.filter(F.col("type") == edge_type).select(
        F.col("src").alias("parent"),
        F.col("dst").alias("id"),
        F.col("properties")[mode].alias("mode"),
        F.col("properties")[weight].cast("double").alias("weight"),
    ).checkpoint()
    start = constant(spark, [(src,)], "id string")
    visited = start
    frontier = start
    levels: list[DataFrame] = []
    while src != dst and (max_hops is None or len(levels) < max_hops):
        reached = (
            steps.join(frontier.select(F.col("id").alias("parent")), "parent", "left_semi")
            .join(visited, "id", "left_anti")
            .groupBy("id")
            .agg(F.min(F.struct("parent", "mode", "weight")).alias("via"))
            .checkpoint()
        )
        levels.append(reached)
        if not reached.filter(F.col("id") == dst).isEmpty():
            break
        if reached.isEmpty():
            levels = []
            break
        visited = visited.unionByName(reached.select("id")).checkpoint()
        frontier = reached
    else:
        if src != dst:
            levels = []
    if not levels:
        found = start.filter(F.lit(src == dst))
        return found.select(
            F.array("id").alias("stations"), F.array().cast("array<string>").alias("modes"),
            F.lit(0.0).alias("total_weight"), F.lit(0).alias("hops"),
        )
    path = levels[-1].filter(F.col("id") == dst).select(
        F.array("via.parent", "id").alias("stations"), F.array("via.mode").alias("modes"),
        F.array("via.weight").alias("weights"), F.col("via.parent").alias("at"),
    )
    for level in reversed(levels[:-1]):
        path = path.join(level, path["at"] == level["id"]).select(
            F.concat(F.array("via.parent"), "stations").alias("stations"),
            F.concat(F.array("via.mode"), "modes").alias("modes"),
            F.concat(F.array("via.weight"), "weights").alias("weights"),
            F.col("via.parent").alias("at"),
        )
    total = F.aggregate("weights", F.lit(0.0), lambda a, w: a + w)
    return path.select("stations", "modes", total.alias("total_weight"), F.size("modes").alias("hops"))


def route_edges(shipments: DataFrame) -> DataFrame:
    """CONNECTED_TO edges as the shipments travelled them, with planned hours."""
    hours = (F.unix_micros(F.col("estimated_arrival").cast("timestamp")) - F.unix_micros(
        F.col("started_at").cast("timestamp")
    )) / F.lit(3_600_000_000)
    routes = shipments.groupBy("source_node", "target_node", "transport_mode").agg(F.min(hours).alias("hours"))
    return _edge(
        routes, "CONNECTED_TO", F.col("source_node"), F.col("target_node"), transport_mode=F.col("transport_mode"),
        typical_hours=F.col("hours"),
    )


def _processed(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    at = of_type(edges, "PROCESSED_AT", "batch_identifier", "node_code")
    stations = attributes(nodes, "SupplyChainNode", "node_code", "node_name", "sequence_order")
    p = F.col("batch_identifier_node_code")
    return at.join(stations, "node_code").select(
        "batch_identifier",
        "node_name",
        F.col("sequence_order").cast("int").alias("sequence_order"),
        p["temperature"].cast("decimal(5,2)").alias("temperature"),
        p["status"].alias("status"),
        p["processed_at"].cast("timestamp_ntz").alias("processed_at"),
    )


def batch_path(nodes: DataFrame, edges: DataFrame, batch_identifier: str | None = None) -> DataFrame:
    """Stations of a batch (of every batch when none is named) with cold-chain status."""
    chosen = edges
    if batch_identifier is not None:
        chosen = edges.filter(F.col("src") == batch_identifier)
    ok = F.coalesce(~breaks_cold_chain("temperature"), F.lit(False))
    return _processed(nodes, chosen).withColumn("cold_chain", F.when(ok, "OK").otherwise("KUEHLKETTENBRUCH"))


def fulfilment_chain(nodes: DataFrame, edges: DataFrame, hubs: DataFrame, order_reference: str) -> DataFrame:
    """Customer, order, batch, shipment and carrier of one order.

    The pairs of batches and shipments are formed on request only; the number
    of rows is that of the pairs of each product. ``fulfilment_chain_ends``
    tells the same in linear size.
    """
    order = constant(edges.sparkSession, [(order_reference,)], "id string")
    triggered = expand(hubs, "TRIGGERED", order).select(F.col("src").alias("order_reference"), F.col("dst").alias("batch"))
    via = expand(hubs, "TRANSPORTED_VIA", triggered.select(F.col("batch").alias("id"))).select(
        F.col("src").alias("batch"), F.col("dst").alias("shipment")
    )
    placed = of_type(edges.filter(F.col("dst") == order_reference), "PLACED", "customer_number", "order_reference")
    by = of_type(edges, "TRANSPORTED_BY", "shipment", "carrier_code")
    return (
        placed.join(triggered, "order_reference")
        .join(via, "batch")
        .join(by, "shipment")
        .join(attributes(nodes, "Customer", "customer_number", "customer_name"), "customer_number")
        .join(attributes(nodes, "Carrier", "carrier_code", "carrier_name"), "carrier_code")
        .join(attributes(nodes, "Shipment", "shipment", "transport_mode"), "shipment")
        .select("customer_name", "order_reference", "batch", "shipment", "transport_mode", "carrier_name")
    )


def fulfilment_chain_ends(edges: DataFrame, hubs: DataFrame, order_reference: str) -> DataFrame:
    """Batches and carried shipments that one order reaches: hub, kind, id, carrier_code.

    Every batch of a hub goes with every shipment of the same hub, so the two
    lists of ends say what all their pairs would.
    """
    mine = hubs.filter((F.col("type") == "TRIGGERED") & (F.col("side") == "src") & (F.col("id") == order_reference)).select("hub").distinct()
    batches = hubs.filter((F.col("type") == "TRIGGERED") & (F.col("side") == "dst")).join(mine, "hub", "left_semi")
    shipments = hubs.filter((F.col("type") == "TRANSPORTED_VIA") & (F.col("side") == "dst")).join(mine, "hub", "left_semi")
    carried = shipments.select("hub", F.col("id").alias("shipment")).join(of_type(edges, "TRANSPORTED_BY", "shipment", "carrier_code"), "shipment")
    return batches.select("hub", F.lit("batch").alias("kind"), "id", F.lit(None).cast("string").alias("carrier_code")).unionByName(
        carried.select("hub", F.lit("shipment").alias("kind"), F.col("shipment").alias("id"), "carrier_code")
    )


def fulfilment_chain_summary(edges: DataFrame, hubs: DataFrame) -> DataFrame:
    """Per order: batches and carried shipments its chain reaches.

    Both are counted at the hub of each product, so an order adds one row
    per product whatever the chain holds.
    """
    hub = hubs.filter(F.col("type") == "TRIGGERED")
    orders = hub.filter(F.col("side") == "src").select("hub", F.col("id").alias("order_reference"))
    batches = hub.filter(F.col("side") == "dst").groupBy("hub").agg(F.count("*").alias("batches"))
    carried = (
        hubs.filter((F.col("type") == "TRANSPORTED_VIA") & (F.col("side") == "dst"))
        .select("hub", F.col("id").alias("shipment"))
        .join(of_type(edges, "TRANSPORTED_BY", "shipment", "carrier_code"), "shipment")
        .groupBy("hub")
        .agg(F.count("*").alias("shipments"))
    )
    reach = batches.join(carried, "hub")
    return (
        orders.join(reach, "hub")
        .groupBy("order_reference")
        .agg(F.sum("batches").alias("batches"), F.sum("shipments").alias("shipments"))
    )


def order_products(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Orders with customer and product."""
    return (
        of_type(edges, "PLACED", "customer_number", "order_reference")
        .join(of_type(edges, "CONTAINS", "order_reference", "product_code"), "order_reference")
        .join(attributes(nodes, "Order", "order_reference", "delivery_priority"), "order_reference")
        .select("customer_number", "order_reference", "product_code", "delivery_priority")
    )


def carrier_overview(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Shipments and distinct modes per carrier."""
    trips = of_type(edges, "TRANSPORTED_BY", "shipment", "carrier_code").join(
        attributes(nodes, "Shipment", "shipment", "transport_mode"), "shipment"
    )
    per_mode = trips.groupBy("carrier_code", "transport_mode").agg(F.count("*").alias("n"))
    return (
        per_mode.groupBy("carrier_code")
        .agg(F.sum("n").alias("shipments"), F.array_sort(F.collect_set("transport_mode")).alias("transport_modes"))
        .join(attributes(nodes, "Carrier", "carrier_code", "carrier_name"), "carrier_code")
        .select("carrier_code", "carrier_name", "shipments", "transport_modes")
    )


def supplier_coverage(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Products with the suppliers that supply them."""
    return (
        of_type(edges, "SUPPLIES", "supplier_code", "product_code")
        .join(attributes(nodes, "Product", "product_code", "product_name"), "product_code")
        .join(attributes(nodes, "Supplier", "supplier_code", "supplier_name"), "supplier_code")
        .select("product_code", "product_name", "supplier_code", "supplier_name")
    )


def products_without_supplier(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """One row: products no supplier supplies."""
    supplied = of_type(edges, "SUPPLIES", "supplier_code", "product_code")
    alone = attributes(nodes, "Product", "product_code").join(supplied, "product_code", "left_anti")
    return alone.agg(F.count("*").alias("products_without_supplier"))


def _supplier_orders(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    return (
        of_type(edges, "CONTAINS", "order_reference", "product_code")
        .join(of_type(edges, "SUPPLIES", "supplier_code", "product_code"), "product_code")
        .join(of_type(edges, "PLACED", "customer_number", "order_reference"), "order_reference")
        .join(attributes(nodes, "Supplier", "supplier_code", "supplier_name"), "supplier_code")
    )


def supplier_reach(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Distinct customers and order lines per supplier name."""
    pairs = (
        _supplier_orders(nodes, edges).groupBy("supplier_name", "customer_number").agg(F.count("*").alias("orders"))
    )
    return pairs.groupBy("supplier_name").agg(F.count("*").alias("customers"), F.sum("orders").alias("orders"))


def supplier_customer_pairs(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Order lines per supplier name and customer name."""
    per_customer = (
        _supplier_orders(nodes, edges).groupBy("supplier_name", "customer_number").agg(F.count("*").alias("orders"))
    )
    return (
        per_customer.join(attributes(nodes, "Customer", "customer_number", "customer_name"), "customer_number")
        .groupBy("supplier_name", "customer_name")
        .agg(F.sum("orders").alias("orders"))
    )


def sea_freight_delay(nodes: DataFrame, edges: DataFrame, completions: DataFrame, shipments: DataFrame) -> DataFrame:
    """Sea-freight shipments with average and largest delay per carrier.

    The delay comes from the completions; a shipment without one counts as
    shipment but not in the average.
    """
    sea = attributes(nodes, "Shipment", "shipment", "transport_mode").filter(F.col("transport_mode") == "SEA_FREIGHT")
    delay = shipments.join(completions.select("shipment_id", "delay_minutes"), "shipment_id").select(
        F.col("shipment_identifier").alias("shipment"), "delay_minutes"
    )
    per_carrier = (
        of_type(edges, "TRANSPORTED_BY", "shipment", "carrier_code")
        .join(sea, "shipment")
        .join(delay, "shipment", "left")
        .groupBy("carrier_code")
        .agg(
            F.count("*").alias("shipments"), F.sum("delay_minutes").alias("s"), F.count("delay_minutes").alias("c"),
            F.max("delay_minutes").alias("max_delay_minutes"),
        )
    )
    return per_carrier.join(attributes(nodes, "Carrier", "carrier_code", "carrier_name"), "carrier_code").select(
        "carrier_name", "shipments", mean(F.col("s"), F.col("c"), 2).alias("avg_delay_minutes"), "max_delay_minutes"
    )


def cold_chain_breaches(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Processings outside the corridor."""
    return (
        _processed(nodes, edges)
        .filter(breaks_cold_chain("temperature"))
        .select("batch_identifier", "node_name", "temperature", "processed_at")
    )


def supply_listing(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Supplier, product, order and customer of every order line."""
    return (
        _supplier_orders(nodes, edges)
        .join(attributes(nodes, "Product", "product_code", "product_name"), "product_code")
        .join(attributes(nodes, "Order", "order_reference", "delivery_priority"), "order_reference")
        .join(attributes(nodes, "Customer", "customer_number", "customer_name"), "customer_number")
        .select("supplier_name", "product_name", "order_reference", "delivery_priority", "customer_name")
    )


def carrier_routes(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Trips per carrier, route and mode."""
    trips = (
        of_type(edges, "TRANSPORTED_BY", "shipment", "carrier_code")
        .join(of_type(edges, "FROM", "shipment", "source"), "shipment")
        .join(of_type(edges, "TO", "shipment", "target"), "shipment")
        .join(attributes(nodes, "Shipment", "shipment", "transport_mode"), "shipment")
        .groupBy("carrier_code", "source", "target", "transport_mode")
        .agg(F.count("*").alias("trips"))
    )
    stations = attributes(nodes, "SupplyChainNode", "code", "node_name")
    return (
        trips.join(attributes(nodes, "Carrier", "carrier_code", "carrier_name"), "carrier_code")
        .join(stations.select(F.col("code").alias("source"), F.col("node_name").alias("source_name")), "source")
        .join(stations.select(F.col("code").alias("target"), F.col("node_name").alias("target_name")), "target")
        .select("carrier_name", "source_name", "target_name", "transport_mode", "trips")
    )


def station_temperature(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Average and range of temperature per station."""
    per_station = (
        _processed(nodes, edges)
        .groupBy("node_name", "sequence_order")
        .agg(
            F.sum(exact("temperature")).alias("s"), F.count("temperature").alias("c"),
            F.min("temperature").alias("min_temp"), F.max("temperature").alias("max_temp"),
        )
    )
    return per_station.select(
        "node_name", "sequence_order", mean(F.col("s"), F.col("c"), 2).alias("avg_temp"), "min_temp", "max_temp"
    )


def stations(nodes: DataFrame) -> DataFrame:
    """Stations with their place in the flow."""
    return attributes(nodes, "SupplyChainNode", "node_code", "node_name", "node_type", "sequence_order").withColumn(
        "sequence_order", F.col("sequence_order").cast("int")
    )


def collected_codes(nodes: DataFrame, label: str, width: int = CODES_PER_PART) -> DataFrame:
    """Sorted ids of one label with the total, one list for each ``width`` numbers of the code.

    The number is the last run of digits; a code without one counts as 0.
    """
    ids = nodes.filter(F.col("label") == label)
    number = F.coalesce(F.expr("try_cast(nullif(regexp_extract(id, '([0-9]+)[^0-9]*$', 1), '') AS bigint)"), F.lit(0))
    parts = bounded_lists(ids, ["label"], F.col("id"), "ids", F.floor(number / F.lit(width)).cast("long"))
    total = ids.agg(F.count("*").alias("total"))
    return parts.crossJoin(total).select("label", "part", "total", "ids")  # total is one row


def order_graph(orders: DataFrame, order_items: DataFrame, product_suppliers: DataFrame) -> DataFrame:
    """Edges of the fulfilment graph with warehouses.

    PLACED, FULFILLS, CONTAINS, SUPPLIED_BY and SUPPLIES (supplier to
    warehouse), each pair once. Ends are the ids of the tables.
    """
    c = F.col
    lines = order_items.select("order_id", "product_id").distinct()
    supplied = lines.join(product_suppliers.select("product_id", "supplier_id"), "product_id")
    stocked = (
        supplied.join(orders.select("order_id", "warehouse_id"), "order_id").select("supplier_id", "warehouse_id").distinct()
    )

    def pairs(df: DataFrame, kind: str, src: str, dst: str) -> DataFrame:
        return df.select(F.lit(kind).alias("type"), c(src).cast("long").alias("src"), c(dst).cast("long").alias("dst"))

    return _union(
        [
            pairs(orders, "PLACED", "customer_id", "order_id"),
            pairs(orders, "FULFILLS", "warehouse_id", "order_id"),
            pairs(lines, "CONTAINS", "order_id", "product_id"),
            pairs(supplied.select("product_id", "supplier_id").distinct(), "SUPPLIED_BY", "product_id", "supplier_id"),
            pairs(stocked, "SUPPLIES", "supplier_id", "warehouse_id"),
        ]
    )
