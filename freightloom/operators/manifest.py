"""Which documents are due, where they belong and what they say."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from freightloom import constants as C
from freightloom.functions.dates import display_moment
from freightloom.functions.keys import normalize_key
from freightloom.functions.numbers import exact, within_cold_chain
from freightloom.functions.texts import (
    bill_of_lading_number,
    customs_number,
    import_number,
    object_path,
    phytosanitary_number,
)
from freightloom.operators.skew import bounded_lists, matched
from freightloom.operators.writes import upsert_last

_DASH = "–"


def _or_dash(c: Column | str) -> Column:
    return F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(_DASH))


def _or_empty(c: Column | str) -> Column:
    return F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(""))


def _map(values: dict[str, Column]) -> Column:
    pairs: list[Column] = []
    for name, value in values.items():
        pairs += [F.lit(name), value.cast("string")]
    return F.create_map(*pairs)


def _document(
    entity_type: str, key: str, kind: str, bucket: str, folder: str, tags: dict[str, Column], fields: dict[str, Column]
) -> list[Column]:
    return [
        F.lit(entity_type).alias("entity_type"),
        F.col(key).alias("entity_key"),
        F.lit(kind).alias("document_type"),
        F.lit(bucket).alias("bucket"),
        object_path(folder, key, kind).alias("object_path"),
        _map(tags | {"document_type": F.lit(kind)}).alias("tags"),
        _map(fields).alias("fields"),
        F.col("event_timestamp").alias("event_timestamp"),
    ]


def _transport_fields() -> dict[str, Column]:
    return {
        "shipment_identifier": F.col("shipment_identifier"),
        "transport_mode": _or_dash("transport_mode"),
        "carrier_name": _or_dash("carrier.carrier_name"),
        "carrier_id": _or_dash("carrier.carrier_id"),
        "source_node": _or_dash("source_node"),
        "target_node": _or_dash("target_node"),
        "product_code": normalize_key(_or_dash("cargo_product_reference")),
        "started": display_moment("event_timestamp"),
        "estimated_arrival": display_moment("estimated_arrival"),
    }


def delivery_notes(started: DataFrame) -> DataFrame:
    """A delivery note for every transport start."""
    tags = {
        "shipment_identifier": F.col("shipment_identifier"),
        "source_node": _or_empty("source_node"),
        "target_node": _or_empty("target_node"),
        "carrier": _or_empty("carrier.carrier_name"),
        "transport_mode": _or_empty("transport_mode"),
    }
    return started.select(
        *_document(
            "SHIPMENT", "shipment_identifier", "delivery_note", "delivery-notes", "shipments", tags, _transport_fields()
        )
    )


def sea_documents(started: DataFrame) -> DataFrame:
    """Bill of lading and customs clearance for every start by sea."""
    sea = started.filter(F.col("transport_mode") == "SEA_FREIGHT")
    shipment = {"shipment_identifier": F.col("shipment_identifier"), "transport_mode": F.col("transport_mode")}
    lading = _document(
        "SHIPMENT", "shipment_identifier", "bill_of_lading", "transport-docs", "shipments",
        shipment
        | {
            "carrier": _or_empty("carrier.carrier_name"),
            "route": F.concat(_or_empty("source_node"), F.lit("->"), _or_empty("target_node")),
        },
        _transport_fields() | {"number": bill_of_lading_number("shipment_identifier")},
    )
    customs = _document(
        "SHIPMENT", "shipment_identifier", "customs_clearance", "transport-docs", "shipments",
        shipment | {"origin_country": F.lit("Ghana"), "destination": F.lit("EU")},
        _transport_fields()
        | {
            "number": customs_number("shipment_identifier"),
            "import_number": import_number("shipment_identifier"),
            "phytosanitary_number": phytosanitary_number("shipment_identifier"),
        },
    )
    both = F.explode(F.array(F.struct(*lading), F.struct(*customs)))
    return sea.select(both.alias("d")).select("d.*")


def invoices(delivered: DataFrame, started: DataFrame) -> DataFrame:
    """An invoice for every successful delivery, with its transport if known.

    The last start of a shipment describes its transport.
    """
    done = delivered.filter(F.col("delivery_status") == "SUCCESSFUL")
    transport = started.groupBy("shipment_identifier").agg(
        F.max(F.struct("event_timestamp", "source_node", "target_node", "carrier", "transport_mode")).alias("t")
    )
    joined = done.join(transport, "shipment_identifier", "left")
    fields = {
        "shipment_identifier": F.col("shipment_identifier"),
        "product_code": normalize_key(_or_dash("cargo_product_reference")),
        "delivery_status": _or_dash("delivery_status"),
        "received_by": _or_dash("received_by"),
        "delivered": display_moment("event_timestamp"),
        "source_node": _or_dash("t.source_node"),
        "target_node": _or_dash("t.target_node"),
        "carrier_name": _or_dash("t.carrier.carrier_name"),
        "transport_mode": _or_dash("t.transport_mode"),
    }
    tags = {"shipment_identifier": F.col("shipment_identifier"), "delivery_status": _or_empty("delivery_status")}
    return joined.select(
        *_document("SHIPMENT", "shipment_identifier", "invoice", "invoices", "shipments", tags, fields)
    )


def quality_certificates(processed: DataFrame) -> DataFrame:
    """A certificate for every processing at quality control, with the decision."""
    checked = processed.filter(F.col("supply_chain_node") == C.QUALITY_NODE)
    passed = within_cold_chain("temperature")
    fields = {
        "batch_identifier": F.col("batch_reference"),
        "product_code": normalize_key(_or_dash("sku")),
        "node": F.col("supply_chain_node"),
        "checked": display_moment("event_timestamp"),
        "status": _or_dash("status"),
        "temperature": F.coalesce(F.concat(F.col("temperature").cast("decimal(9,2)").cast("string"), F.lit(" °C")), F.lit(_DASH)),
        "result": F.when(passed, "BESTANDEN ✓").otherwise("NICHT BESTANDEN ✗"),
        "release": F.when(passed, "Ja").otherwise("Nein – Quarantäne"),
    }
    tags = {
        "batch_identifier": F.col("batch_reference"),
        "sku": normalize_key(_or_empty("sku")),
        "temperature": _or_empty(F.col("temperature").cast("string")),
    }
    return checked.select(
        *_document("BATCH", "batch_reference", "quality_certificate", "batch-certificates", "batches", tags, fields)
    )


def manifest(
    started: DataFrame, delivered: DataFrame, processed: DataFrame, existing: DataFrame | None = None
) -> DataFrame:
    """All documents due, one per entity and type; the latest event wins."""
    due = (
        delivery_notes(started)
        .unionByName(sea_documents(started))
        .unionByName(invoices(delivered, started))
        .unionByName(quality_certificates(processed))
    )
    return upsert_last(due, existing, ["entity_key", "document_type"], ["event_timestamp"])


def manifest_by_type(documents: DataFrame) -> DataFrame:
    """Documents per type and bucket."""
    return documents.groupBy("document_type", "bucket").agg(F.count("*").alias("documents"))


def manifest_by_entity(documents: DataFrame) -> DataFrame:
    """Documents per entity type."""
    return documents.groupBy("entity_type").agg(F.count("*").alias("documents"))


def full_paths(documents: DataFrame, entity_type: str | None = None, entity_key: str | None = None) -> DataFrame:
    """Bucket and path in one; of one entity when named."""
    chosen = documents
    if entity_type is not None:
        chosen = chosen.filter(F.col("entity_type") == entity_type)
    if entity_key is not None:
        chosen = chosen.filter(F.col("entity_key") == entity_key)
    return chosen.select(
        "entity_type", "entity_key", "document_type", F.concat_ws("/", "bucket", "object_path").alias("full_path")
    )


def missing_notes(shipments: DataFrame, documents: DataFrame) -> DataFrame:
    """Shipments without delivery note."""
    notes = documents.filter(F.col("document_type") == "delivery_note")
    return matched(shipments, notes, {"shipment_identifier": "entity_key"}, keep=False).select("shipment_identifier")


def order_texts(
    orders: DataFrame, order_items: DataFrame, products: DataFrame, page_lines: int = 1_000
) -> DataFrame:
    """Invoice and delivery text per order, one page for each ``page_lines`` positions.

    ``orders`` has order_id, customer_name, city and warehouse. Every page
    carries the heading and the total of the whole order. ``order_items`` has
    the position of each line, counted from 0; a line without one stands on
    the first page.
    """
    lines = order_items.join(products.select("product_id", "product_name"), "product_id").withColumn(
        "subtotal", exact(F.col("unit_price") * F.col("quantity")).cast("decimal(18,2)")
    )
    totals = lines.groupBy("order_id").agg(F.sum(exact("subtotal")).cast("decimal(18,2)").alias("total"))
    line = F.struct("product_name", "product_id", "quantity", "subtotal")
    page = F.floor(F.coalesce("position", F.lit(0)) / F.lit(page_lines)).cast("long")
    pages = bounded_lists(lines, ["order_id"], line, "lines", page)
    name, qty, sub = "product_name", "quantity", "subtotal"
    invoice_lines = F.transform(
        "lines",
        lambda x: F.concat_ws(
            "", x[name], F.lit(" x "), _or_dash(x[qty].cast("string")), F.lit(" = "), _or_dash(x[sub].cast("string"))
        ),
    )
    delivery_lines = F.transform(
        "lines", lambda x: F.concat_ws("", x[name], F.lit(" -> "), _or_dash(x[qty].cast("string")))
    )
    order = F.col("order_id").cast("string")
    heading = F.concat(F.lit("INVOICE "), order, F.lit("\n"), "customer_name", F.lit(" ("), "city", F.lit(")\n"))
    delivery_heading = F.concat(F.lit("DELIVERY "), order, F.lit("\nWarehouse: "), "warehouse", F.lit("\n"))
    total = F.concat(F.lit("\nTOTAL: "), _or_dash(F.col("total").cast("string")))
    return (
        orders.join(pages, "order_id")
        .join(totals, "order_id")
        .select(
            "order_id",
            "part",
            F.concat_ws("\n", heading, F.array_join(invoice_lines, "\n"), total).alias("invoice_text"),
            F.concat_ws("\n", delivery_heading, F.array_join(delivery_lines, "\n")).alias("delivery_text"),
            "total",
        )
    )
