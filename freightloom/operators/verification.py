"""Expectation checks, foreign-key checks and plausibility checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from freightloom import constants as C
from freightloom.functions.numbers import mean
from freightloom.operators.skew import matched, orphan_count
from freightloom.sources.relations import topology


def check(metrics: DataFrame, expectations: DataFrame) -> DataFrame:
    """Compare metrics (system, name, actual) with expectations.

    An expectation row has system, name, op and ``expected`` as text: a
    number for ``eq`` and ``ge``, numbers separated by commas for ``in``,
    anything for ``truthy``. A metric that is missing fails.
    """
    joined = expectations.join(metrics, ["system", "name"], "left")
    actual, expected, op = F.col("actual"), F.col("expected"), F.col("op")
    wanted = F.trim(expected).try_cast("double")
    members = F.transform(F.split(expected, ","), lambda x: F.trim(x).try_cast("double"))
    passed = (
        F.when(op == "eq", actual == wanted)
        .when(op == "ge", actual >= wanted)
        .when(op == "in", F.array_contains(members, actual))
        .when(op == "truthy", actual != 0)
    )
    return joined.select(
        "system",
        "name",
        "actual",
        "expected",
        "op",
        F.when(F.coalesce(passed, F.lit(False)), "PASS").otherwise("FAIL").alias("status"),
    )


def summary(checks: DataFrame) -> DataFrame:
    """Number of checks, passed and failed."""
    return checks.agg(
        F.count("*").alias("total"),
        F.count_if(F.col("status") == "PASS").alias("passed"),
        F.count_if(F.col("status") != "PASS").alias("failed"),
    )


def metric(df: DataFrame, system: str, name: str, value: Column | None = None) -> DataFrame:
    """One metric row; the number of rows unless an aggregate is given."""
    measured = (F.count("*") if value is None else value).cast("double")
    return df.agg(measured.alias("actual")).select(F.lit(system).alias("system"), F.lit(name).alias("name"), "actual")


def stack_rows(parts: list[DataFrame]) -> DataFrame:
    """Union of relations with the same columns."""
    union = parts[0]
    for part in parts[1:]:
        union = union.unionByName(part)
    return union


def fk_check(
    child: DataFrame, parent: DataFrame, on: dict[str, str], check_name: str, relation: str, null_is_orphan: bool = True
) -> DataFrame:
    """One row: child rows whose reference has no parent."""
    rows = child
    if not null_is_orphan:
        for column in on:
            rows = rows.filter(F.col(column).isNotNull())
    return orphan_count(rows, parent, on).select(
        F.lit(check_name).alias("check_name"), F.lit(relation).alias("relation"), "orphans"
    )


def foreign_key_checks(t: dict[str, DataFrame]) -> DataFrame:
    """The nine references inside the three source schemas."""
    by = lambda *names: {n: n for n in names}
    return stack_rows(
        [
            fk_check(t["products"], t["suppliers"], by("supplier_id"), "ERP FK-Check", "erp.products → erp.suppliers", False),
            fk_check(t["order_items"], t["orders"], by("order_id"), "ERP FK-Check", "erp.order_items → erp.orders"),
            fk_check(t["order_items"], t["products"], by("product_id"), "ERP FK-Check", "erp.order_items → erp.products"),
            fk_check(t["orders"], t["customers"], by("customer_id"), "ERP FK-Check", "erp.orders → erp.customers"),
            fk_check(
                t["node_processings"], t["supply_chain_nodes"], by("node_id"), "WMS FK-Check",
                "wms.node_processings → wms.supply_chain_nodes",
            ),
            fk_check(t["shipments"], t["carriers"], by("carrier_id"), "TMS FK-Check", "tms.shipments → tms.carriers"),
            fk_check(
                t["shipment_positions"], t["shipments"], by("shipment_id"), "TMS FK-Check",
                "tms.shipment_positions → tms.shipments",
            ),
            fk_check(
                t["transport_completions"], t["shipments"], by("shipment_id"), "TMS FK-Check",
                "tms.transport_completions → tms.shipments",
            ),
            fk_check(t["deliveries"], t["shipments"], by("shipment_id"), "TMS FK-Check", "tms.deliveries → tms.shipments"),
        ]
    )


def order_item_orphans(order_items: DataFrame, orders: DataFrame, products: DataFrame) -> DataFrame:
    """One row: order lines without order and lines without product."""
    no_order = orphan_count(order_items, orders, {"order_id": "order_id"}, "orphan_orders")
    no_product = orphan_count(order_items, products, {"product_id": "product_id"}, "orphan_products")
    return no_order.crossJoin(no_product)  # one row each


def cross_schema_checks(t: dict[str, DataFrame]) -> DataFrame:
    """References between schemas that no constraint holds, with a message."""

    def one(child, parent, on, name, good, bad):
        return orphan_count(child, parent, on).select(
            F.lit(name).alias("check_name"),
            "orphans",
            F.when(F.col("orphans") == 0, F.lit(f"PASS – {good}"))
            .otherwise(F.concat(F.lit("FAIL – "), F.col("orphans").cast("string"), F.lit(f" {bad}")))
            .alias("message"),
        )

    return stack_rows(
        [
            one(
                t["node_processings"], t["batches"], {"batch_reference": "batch_identifier"}, "wms_erp_batch_check",
                "alle batch_references in WMS auflösbar", "node_processings ohne ERP-Batch",
            ),
            one(
                t["shipments"], t["transport_product_references"],
                {"cargo_product_reference": "transport_product_reference"}, "tms_productref_check",
                "alle cargo_product_references in TMS auflösbar", "Shipments ohne TMS-Produktreferenz",
            ),
        ]
    )


def expected_counts(tables: dict[str, DataFrame], expected: dict[str, str]) -> DataFrame:
    """Rows of each table beside the text that says what to expect."""
    return stack_rows(
        [
            df.agg(F.count("*").alias("row_count")).select(
                F.lit(name).alias("table_name"), "row_count", F.lit(expected.get(name, "")).alias("expected_value")
            )
            for name, df in tables.items()
        ]
    )


def date_spine_check(dates: DataFrame, expected_days: int) -> DataFrame:
    """Range and completeness of the calendar."""
    return dates.agg(
        F.min("full_date").alias("first_day"), F.max("full_date").alias("last_day"), F.count("*").alias("days")
    ).select(
        "first_day",
        "last_day",
        "days",
        F.when(F.col("days") == expected_days, F.lit(f"PASS – {expected_days} Tage"))
        .otherwise(F.concat(F.lit(f"FAIL – erwartet {expected_days}, gefunden: "), F.col("days").cast("string")))
        .alias("date_spine_check"),
    )


def overview_row(tables: dict[str, DataFrame]) -> DataFrame:
    """One wide row with the number of rows of each table."""
    row = None
    for name, df in tables.items():
        one = df.agg(F.count("*").alias(name))
        row = one if row is None else row.crossJoin(one)  # one row each
    return row


# --- plausibility ----------------------------------------------------------------


def _verdict(name: str, good: Column, bad_status: str, detail: Column) -> Column:
    return F.struct(
        F.lit(name).alias("check"),
        F.when(F.coalesce(good, F.lit(False)), "OK").otherwise(bad_status).alias("status"),
        detail.alias("detail"),
    )


def _verdicts(facts: DataFrame, *rows: Column) -> DataFrame:
    return facts.select(F.explode(F.array(*rows)).alias("v")).select("v.check", "v.status", "v.detail")


def _text(*parts: Column | str) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def plausibility_flow(shipments: DataFrame, completions: DataFrame, per_route: int = 10) -> DataFrame:
    """Routes, shipments per route, modes and completion of the flow."""
    routes = shipments.groupBy("source_node", "target_node", "transport_mode").agg(F.count("*").alias("n"))
    modes = routes.groupBy("source_node", "target_node").agg(
        F.count("*").alias("variants"), F.min("transport_mode").alias("found_mode")
    )
    flow = topology(shipments.sparkSession).select(
        "source_node", "target_node", F.col("transport_mode").alias("expected_mode")
    )
    wrong = flow.join(modes, ["source_node", "target_node"], "left").agg(
        F.count_if(
            F.col("found_mode").isNull() | (F.col("variants") != 1) | (F.col("found_mode") != F.col("expected_mode"))
        ).alias("mode_errors")
    )
    totals = routes.agg(
        F.count("*").alias("routes"),
        F.count_if(F.col("n") != per_route).alias("wrong_routes"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("shipments"),
    )
    completed = completions.groupBy("shipment_id").agg(F.count("*").alias("n")).agg(F.count("*").alias("completed"))
    facts = totals.crossJoin(wrong).crossJoin(completed)  # one row each
    hops = len(C.TOPOLOGY)
    return _verdicts(
        facts,
        _verdict("routes", F.col("routes") == hops, "FAIL", _text(f"expected {hops}, found ", F.col("routes"))),
        _verdict(
            "shipments_per_route", F.col("wrong_routes") == 0, "FAIL",
            _text(F.col("wrong_routes"), f" routes without {per_route} shipments"),
        ),
        _verdict("transport_mode", F.col("mode_errors") == 0, "FAIL", _text(F.col("mode_errors"), " wrong modes")),
        _verdict(
            "completed", F.col("completed") == F.col("shipments"), "WARN",
            _text(F.col("completed"), "/", F.col("shipments"), " completed"),
        ),
    )


def plausibility_cold_chain(processings: DataFrame, nodes: DataFrame) -> DataFrame:
    """Breaches, measured stations, averages and extremes of temperature."""
    per_node = (
        processings.groupBy("node_id")
        .agg(
            F.count("*").alias("n"),
            F.sum(F.col("temperature").cast("decimal(28,2)")).alias("s"),
            F.count("temperature").alias("c"),
            F.min("temperature").alias("lo"),
            F.max("temperature").alias("hi"),
            F.count_if(
                (F.col("temperature") < F.lit(C.COLD_CHAIN_MIN)) | (F.col("temperature") > F.lit(C.COLD_CHAIN_MAX))
            ).alias("b"),
        )
        .join(nodes.select("node_id"), "node_id", "left_semi")
    )
    average = mean(F.col("s"), F.col("c"), 2)
    inside = average.between(F.lit(C.COLD_CHAIN_MIN), F.lit(C.COLD_CHAIN_MAX))
    facts = per_node.agg(
        F.count("*").alias("stations"),
        F.sum("n").alias("records"),
        F.sum("b").alias("breaches"),
        F.count_if(~F.coalesce(inside, F.lit(False))).alias("outside"),
        mean(F.sum("s"), F.sum("c"), 2).alias("average"),
        F.min("lo").alias("lo"),
        F.max("hi").alias("hi"),
    )
    stations = len(C.NODES) - 1
    return _verdicts(
        facts,
        _verdict(
            "breaches", F.col("breaches") == 0, "FAIL", _text(F.col("breaches"), " in ", F.col("records"), " processings")
        ),
        _verdict("stations", F.col("stations") == stations, "FAIL", _text(F.col("stations"), f"/{stations} measured")),
        _verdict("average", F.col("outside") == 0, "FAIL", _text("overall ", F.col("average").cast("decimal(9,2)"))),
        _verdict("minimum", F.col("lo") >= F.lit(C.COLD_CHAIN_MIN), "FAIL", _text("lowest ", F.col("lo"))),
        _verdict("maximum", F.col("hi") <= F.lit(C.COLD_CHAIN_MAX), "FAIL", _text("highest ", F.col("hi"))),
    )


def plausibility_master_data(
    matrix: DataFrame, golden: DataFrame, mappings: DataFrame, resolved: DataFrame, lateness: DataFrame
) -> DataFrame:
    """Key coverage, golden records, mappings, resolver and worst carrier.

    ``resolved`` holds keys beside the canonical key a resolver found for
    them; the check counts those left without.
    """
    facts = (
        matrix.agg(F.count("*").alias("keys"), F.count_if(F.col("is_complete")).alias("complete"))
        .crossJoin(golden.agg(F.count("*").alias("golden")))
        .crossJoin(mappings.agg(F.count("*").alias("mappings")))
        .crossJoin(
            resolved.agg(
                F.count("*").alias("asked"), F.count_if(F.col("canonical_key").isNull()).alias("unresolved")
            )
        )
        .crossJoin(lateness.agg(F.max(F.struct("avg_delay", "carrier_name")).alias("worst")))
    )  # one row each
    return _verdicts(
        facts,
        _verdict(
            "keys_in_all_systems", F.col("complete") == F.col("keys"), "WARN",
            _text(F.col("complete"), "/", F.col("keys"), " complete"),
        ),
        _verdict("golden_records", F.col("golden") >= 1, "FAIL", _text(F.col("golden"), " golden records")),
        _verdict("source_mappings", F.col("mappings") >= 3, "FAIL", _text(F.col("mappings"), " mappings")),
        _verdict(
            "resolver", F.col("unresolved") == 0, "FAIL",
            _text(F.col("unresolved"), " of ", F.col("asked"), " keys unresolved"),
        ),
        _verdict(
            "worst_carrier", F.col("worst.avg_delay") < 100, "WARN",
            _text(F.col("worst.carrier_name"), " ", F.round("worst.avg_delay", 0).cast("int"), " min"),
        ),
    )


def structure_checks(
    shipment_docs: DataFrame, shipment_events: DataFrame, batch_docs: DataFrame, batch_stations: DataFrame, node_docs: DataFrame
) -> DataFrame:
    """Documents, and those whose parts or flags are broken.

    A shipment has at least one list of events, a list of stations has its
    batch, and a node document has its flags.
    """

    def one(documents: DataFrame, broken: DataFrame, name: str) -> DataFrame:
        counts = documents.agg(F.count("*").alias("documents")).crossJoin(broken.agg(F.count("*").alias("broken")))  # one row each
        return counts.select(F.lit(name).alias("check"), "documents", "broken")

    return stack_rows(
        [
            one(
                shipment_docs,
                matched(shipment_docs, shipment_events, {"shipment_identifier": "shipment_identifier"}, keep=False),
                "shipment_events.events",
            ),
            one(
                batch_docs,
                matched(batch_stations, batch_docs, {"batch_identifier": "batch_identifier"}, keep=False),
                "batch_tracking.nodes_processed",
            ),
            one(node_docs, node_docs.filter("quality_flags IS NULL"), "node_events.quality_flags"),
        ]
    )
