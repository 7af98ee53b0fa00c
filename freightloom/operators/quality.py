"""Data-quality audit: 28 rules over the operational tables.

Rules on single rows are grouped by table, so each table is scanned once
for all its rules. Rules across tables compare distinct keys with the rows
they stand for. The audit is one row per rule.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from freightloom import constants as C
from freightloom.functions.dates import moment
from freightloom.functions.keys import match_key, tms_key, wms_key
from freightloom.functions.numbers import breaks_cold_chain, percentage
from freightloom.operators.skew import matched, orphan_keys, row_counts
from freightloom.sources.constant import constant

Tables = dict[str, DataFrame]

# Number, dimension, table and text of each rule.
RULES = [
    ("1.1", "VOLLSTÄNDIGKEIT", "erp.products", "supplier_id NULL"),
    ("1.2", "VOLLSTÄNDIGKEIT", "erp.order_items", "quantity oder unit_price NULL"),
    ("1.3", "VOLLSTÄNDIGKEIT", "wms.node_processings", "temperature NULL (Kühlkette-Lücke)"),
    ("1.4", "VOLLSTÄNDIGKEIT", "tms.deliveries", "received_by NULL bei SUCCESSFUL"),
    ("1.5", "VOLLSTÄNDIGKEIT", "erp.orders", "Order ohne Bestellpositionen"),
    ("2.1", "EINDEUTIGKEIT", "erp.suppliers", "supplier_code Duplikat"),
    ("2.2", "EINDEUTIGKEIT", "erp.orders", "order_reference Duplikat"),
    ("2.3", "EINDEUTIGKEIT", "erp.batches", "batch_identifier Duplikat"),
    ("2.4", "EINDEUTIGKEIT", "tms.shipments", "shipment_identifier Duplikat"),
    ("3.1", "KONSISTENZ", "wms.warehouse_skus", "SKU ohne MDM-Mapping (über normalized_key)"),
    ("3.2", "KONSISTENZ", "tms.transport_product_references", "TMS-Referenz ohne MDM-Mapping (über normalized_key)"),
    ("3.3", "KONSISTENZ", "erp.batches", "wms_sku passt nicht zu product_code"),
    ("3.4", "KONSISTENZ", "tms.deliveries + tms.transport_completions", "SUCCESSFUL-Delivery ohne TransportCompleted-Eintrag"),
    ("4.1", "PLAUSIBILITÄT", "erp.order_items", "quantity <= 0"),
    ("4.2", "PLAUSIBILITÄT", "erp.order_items", "unit_price außerhalb [1.50, 5.00]"),
    ("4.3", "PLAUSIBILITÄT", "wms.node_processings", "temperature außerhalb [10, 15]°C (Kühlkettenbruch)"),
    ("4.4", "PLAUSIBILITÄT", "tms.shipment_positions", "container_temperature außerhalb [10, 15]°C"),
    ("4.5", "PLAUSIBILITÄT", "tms.shipment_positions", "latitude/longitude außerhalb Wertebereich"),
    ("4.6", "PLAUSIBILITÄT", "tms.deliveries", "delivery_status ungültig"),
    ("4.7", "PLAUSIBILITÄT", "erp.orders", "delivery_priority ungültig"),
    ("4.8", "PLAUSIBILITÄT", "tms.transport_completions", "delay_minutes > 180"),
    ("4.9", "PLAUSIBILITÄT", "tms.shipment_positions", "speed_kmh > 200 oder < 0"),
    ("5.1", "AKTUALITÄT", "tms", "TransportCompleted vor TransportStarted"),
    ("5.2", "AKTUALITÄT", "erp.batches", "harvested_at außerhalb Projektlaufzeit (2026)"),
    ("5.3", "AKTUALITÄT", "erp.orders", "Order > 90 Tage ohne Delivery"),
    ("6.1", "REF. INTEGRITÄT", "wms.node_processings", "batch_reference ohne erp.batches"),
    ("6.2", "REF. INTEGRITÄT", "tms.shipments", "cargo_product_reference ohne tms.transport_product_references"),
    ("6.3", "REF. INTEGRITÄT", "tms.shipments", "Shipment ohne Carrier (carrier_id NULL)"),
]

#: Rules of the detail check that the audit leaves out.
MASTER_DATA_RULES = [
    ("5.0a", "AKTUALITÄT", "erp.suppliers", "event_timestamp ausserhalb 2026"),
    ("5.0b", "AKTUALITÄT", "erp.customers", "event_timestamp ausserhalb 2026"),
    ("5.0c", "AKTUALITÄT", "erp.products", "event_timestamp ausserhalb 2026"),
    ("5.0d", "AKTUALITÄT", "tms.carriers", "event_timestamp ausserhalb 2026"),
]

DIMENSIONS = [
    "VOLLSTÄNDIGKEIT", "EINDEUTIGKEIT", "KONSISTENZ", "PLAUSIBILITÄT", "AKTUALITÄT", "REF. INTEGRITÄT",
]


@dataclass(frozen=True)
class Period:
    """Project period and the moment that stands for now."""

    start: datetime
    as_of: datetime

    def outside(self, column: str) -> Column:
        last = moment(self.as_of + timedelta(days=1))
        return (F.col(column) < moment(self.start)) | (F.col(column) > last)

    def stale(self, column: str, days: int = C.STALE_ORDER_DAYS) -> Column:
        return F.col(column) < moment(self.as_of - timedelta(days=days))


def _c(name: str) -> Column:
    return F.col(name)


def row_rules(period: Period) -> dict[str, dict[str, Column]]:
    """Violation conditions that one row decides, by table and rule."""
    return {
        "products": {"1.1": _c("supplier_id").isNull(), "5.0c": period.outside("event_timestamp")},
        "order_items": {
            "1.2": _c("quantity").isNull() | _c("unit_price").isNull(),
            "4.1": _c("quantity") <= 0,
            "4.2": (_c("unit_price") < F.lit(C.PRICE_MIN)) | (_c("unit_price") > F.lit(C.PRICE_MAX)),
        },
        "node_processings": {"1.3": _c("temperature").isNull(), "4.3": breaks_cold_chain("temperature")},
        "deliveries": {
            "1.4": (_c("delivery_status") == "SUCCESSFUL") & _c("received_by").isNull(),
            "4.6": ~_c("delivery_status").isin(C.FINAL_STATUSES),
        },
        "orders": {"4.7": ~_c("delivery_priority").isin(C.PRIORITIES)},
        "shipment_positions": {
            "4.4": breaks_cold_chain("container_temperature"),
            "4.5": ~_c("latitude").between(-90, 90) | ~_c("longitude").between(-180, 180),
            "4.9": (_c("speed_kmh") > C.MAX_SPEED_KMH) | (_c("speed_kmh") < 0),
        },
        "transport_completions": {"4.8": _c("delay_minutes") > C.MAX_DELAY_MINUTES},
        "batches": {"5.2": period.outside("harvested_at")},
        "shipments": {"6.3": _c("carrier_id").isNull()},
        "suppliers": {"5.0a": period.outside("event_timestamp")},
        "customers": {"5.0b": period.outside("event_timestamp")},
        "carriers": {"5.0d": period.outside("event_timestamp")},
    }


#: Business keys that must be unique: rule, table, column.
UNIQUE_KEYS = {
    "2.1": ("suppliers", "supplier_code"),
    "2.2": ("orders", "order_reference"),
    "2.3": ("batches", "batch_identifier"),
    "2.4": ("shipments", "shipment_identifier"),
}


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    """Key values that occur more than once, with their number of rows."""
    return row_counts(df, [key], "occurrences").filter(F.col("occurrences") > 1)


def surplus_rows(df: DataFrame, key: str) -> DataFrame:
    """One row: rows beyond the first of each key."""
    return duplicate_keys(df, key).agg(
        F.coalesce(F.sum(F.col("occurrences") - 1), F.lit(0)).cast("long").alias("violations")
    )


def orders_without_lines(t: Tables) -> DataFrame:
    return matched(t["orders"], t["order_items"].select("order_id"), {"order_id": "order_id"}, keep=False)


def skus_without_mapping(t: Tables) -> DataFrame:
    known = t["source_mappings"].filter(F.col("source_system") == "WMS")
    skus = t["warehouse_skus"].withColumn("_norm", match_key("sku"))
    return matched(skus, known, {"_norm": "normalized_key"}, keep=False).select("sku", "erp_product_code")


def references_without_mapping(t: Tables) -> DataFrame:
    known = t["source_mappings"].filter(F.col("source_system") == "TMS")
    refs = t["transport_product_references"].withColumn("_norm", tms_key("transport_product_reference"))
    return matched(refs, known, {"_norm": "normalized_key"}, keep=False).select(
        "transport_product_reference", "erp_product_code"
    )


def batches_with_wrong_sku(t: Tables) -> DataFrame:
    codes = t["products"].select("product_id", "product_code")
    return (
        t["batches"]
        .join(codes, "product_id")
        .filter(F.col("wms_sku") != wms_key("product_code"))
        .select("batch_identifier", "product_id", "wms_sku", "product_code")
    )


def successes_without_completion(t: Tables) -> DataFrame:
    done = t["deliveries"].filter(F.col("delivery_status") == "SUCCESSFUL").select("shipment_id", "delivery_status")
    return matched(done, t["transport_completions"], {"shipment_id": "shipment_id"}, keep=False)


def completions_before_start(t: Tables) -> DataFrame:
    return (
        t["transport_completions"]
        .join(t["shipments"].select("shipment_id", "shipment_identifier", "started_at"), "shipment_id")
        .filter(F.col("completed_at") < F.col("started_at"))
        .select("shipment_identifier", "started_at", "completed_at")
    )


def stale_orders(t: Tables, period: Period) -> DataFrame:
    """Old orders none of whose products was ever delivered.

    The chain from delivery back to order is walked on distinct keys: a
    product with a third of all shipments is one row after the first step.
    """
    delivered = t["shipments"].join(t["deliveries"].select("shipment_id"), "shipment_id", "left_semi")
    references = delivered.select("cargo_product_reference").distinct()
    batches = t["batches"].select("product_id", "tms_product_reference").distinct()
    products = matched(batches, references, {"tms_product_reference": "cargo_product_reference"}, keep=True)
    known = t["products"].select("product_id").join(products, "product_id", "left_semi")
    served = matched(t["order_items"].select("order_id", "product_id"), known, {"product_id": "product_id"}, keep=True)
    old = t["orders"].filter(period.stale("order_timestamp"))
    return matched(old, served, {"order_id": "order_id"}, keep=False)


def processings_without_batch(t: Tables) -> DataFrame:
    return orphan_keys(t["node_processings"], t["batches"], {"batch_reference": "batch_identifier"})


def shipments_without_reference(t: Tables) -> DataFrame:
    return orphan_keys(
        t["shipments"],
        t["transport_product_references"],
        {"cargo_product_reference": "transport_product_reference"},
    )


def _join_rules(t: Tables, period: Period) -> dict[str, Callable[[], DataFrame]]:
    def counted(df: DataFrame) -> DataFrame:
        return df.agg(F.count("*").alias("violations"))

    def weighted(df: DataFrame) -> DataFrame:
        return df.agg(F.coalesce(F.sum("rows"), F.lit(0)).cast("long").alias("violations"))

    rules: dict[str, Callable[[], DataFrame]] = {
        number: (lambda table=table, key=key: surplus_rows(t[table], key)) for number, (table, key) in UNIQUE_KEYS.items()
    }
    rules |= {
        "1.5": lambda: counted(orders_without_lines(t)),
        "3.1": lambda: counted(skus_without_mapping(t)),
        "3.2": lambda: counted(references_without_mapping(t)),
        "3.3": lambda: counted(batches_with_wrong_sku(t)),
        "3.4": lambda: counted(successes_without_completion(t)),
        "5.1": lambda: counted(completions_before_start(t)),
        "5.3": lambda: counted(stale_orders(t, period)),
        "6.1": lambda: weighted(processings_without_batch(t)),
        "6.2": lambda: weighted(shipments_without_reference(t)),
    }
    return rules


def violation_counts(t: Tables, period: Period, rules: list[str] | None = None) -> DataFrame:
    """Violations by rule number."""
    wanted = [r[0] for r in RULES] if rules is None else rules
    parts: list[DataFrame] = []
    for table, conditions in row_rules(period).items():
        chosen = [n for n in conditions if n in wanted]
        if not chosen:
            continue
        totals = t[table].agg(*[F.count_if(conditions[n]).alias(f"r{i}") for i, n in enumerate(chosen)])
        pairs = ", ".join(f"'{n}', r{i}" for i, n in enumerate(chosen))
        parts.append(totals.select(F.expr(f"stack({len(chosen)}, {pairs}) AS (number, violations)")))
    for number, build in _join_rules(t, period).items():
        if number in wanted:
            parts.append(build().select(F.lit(number).alias("number"), "violations"))
    union = parts[0]
    for part in parts[1:]:
        union = union.unionByName(part)
    return union


def dq_audit(t: Tables, period: Period, rules: list[str] | None = None) -> DataFrame:
    """One row per rule with its violations and PASS or FAIL."""
    counts = violation_counts(t, period, rules)
    texts = constant(
        counts.sparkSession,
        [(i, *r) for i, r in enumerate(RULES + MASTER_DATA_RULES, start=1)],
        "position int, number string, dimension string, table string, rule string",
    )
    return counts.join(texts, "number").select(
        "dimension",
        "number",
        "table",
        "rule",
        "violations",
        F.when(F.col("violations") == 0, "PASS").otherwise("FAIL").alias("status"),
        "position",
    )


def dq_scores(audit: DataFrame) -> DataFrame:
    """Rules, violations and passed share per dimension."""
    return audit.groupBy("dimension").agg(
        F.count("*").alias("rules"),
        F.sum("violations").alias("violations"),
        percentage(F.count_if(F.col("status") == "PASS"), F.count("*")).alias("passed_pct"),
    )


def dq_detail(number: str, t: Tables, period: Period) -> DataFrame:
    """What violates one rule: keys or values, or the count where there are none to show."""
    if number in UNIQUE_KEYS:
        return duplicate_keys(t[UNIQUE_KEYS[number][0]], UNIQUE_KEYS[number][1])
    listed: dict[str, Callable[[], DataFrame]] = {
        "3.1": lambda: skus_without_mapping(t),
        "3.2": lambda: references_without_mapping(t),
        "3.3": lambda: batches_with_wrong_sku(t),
        "4.3": lambda: t["node_processings"]
        .filter(breaks_cold_chain("temperature"))
        .agg(
            F.count("*").alias("violations"),
            F.min("temperature").alias("min_temp"),
            F.max("temperature").alias("max_temp"),
        ),
        "4.6": lambda: row_counts(
            t["deliveries"].filter(~F.col("delivery_status").isin(C.FINAL_STATUSES)), ["delivery_status"], "occurrences"
        ),
        "4.7": lambda: row_counts(
            t["orders"].filter(~F.col("delivery_priority").isin(C.PRIORITIES)), ["delivery_priority"], "occurrences"
        ),
    }
    if number in listed:
        return listed[number]()
    return violation_counts(t, period, [number]).select("violations")


# --- load-time contract: constraints as reject rules ---------------------------


def constraint_rules() -> dict[str, dict[str, Column]]:
    """Allowed values and ranges of each table as violation conditions."""
    return {
        "orders": {"delivery_priority": ~_c("delivery_priority").isin(C.PRIORITIES)},
        "order_items": {"quantity": _c("quantity") <= 0, "unit_price": _c("unit_price") <= 0},
        "batches": {"quantity": _c("quantity") <= 0},
        "node_processings": {"status": ~_c("status").isin(C.PROCESSING_STATUSES)},
        "shipments": {"transport_mode": ~_c("transport_mode").isin(C.TRANSPORT_MODES)},
        "shipment_positions": {
            "latitude": ~_c("latitude").between(-90, 90),
            "longitude": ~_c("longitude").between(-180, 180),
            "speed_kmh": _c("speed_kmh") < 0,
        },
        "transport_completions": {"delay_minutes": _c("delay_minutes") < 0},
        "deliveries": {"delivery_status": ~_c("delivery_status").isin(C.FINAL_STATUSES)},
        "golden_records": {
            "status": ~_c("status").isin(C.GOLDEN_STATUSES),
            "quality_score": ~_c("quality_score").between(0, 1),
        },
        "source_mappings": {"source_system": ~_c("source_system").isin(C.SOURCE_SYSTEMS)},
    }


def enforce(table: str, rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Split rows into those that satisfy the table's constraints and the rejects.

    NULL satisfies a constraint; rejects carry the broken columns as reason.
    """
    rules = constraint_rules().get(table, {})
    broken = F.array_compact(F.array(*[F.when(rule, F.lit(name)) for name, rule in rules.items()]))
    tagged = rows.withColumn("_broken", broken)
    ok = tagged.filter(F.size("_broken") == 0).drop("_broken")
    bad = tagged.filter(F.size("_broken") > 0).withColumn("reason", F.array_join("_broken", ",")).drop("_broken")
    return ok, bad
