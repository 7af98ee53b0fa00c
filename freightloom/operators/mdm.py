"""Master data: golden records, source mappings and key resolution."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from freightloom.functions.keys import match_key, tms_key, wms_key
from freightloom.functions.numbers import count_where
from freightloom.operators.skew import matched
from freightloom.operators.writes import insert_ignore


def golden_records(
    products: DataFrame,
    customers: DataFrame,
    suppliers: DataFrame,
    carriers: DataFrame,
    nodes: DataFrame,
    existing: DataFrame | None = None,
) -> DataFrame:
    """One record per business entity; products score 0.95, the rest 1.00."""
    sources = [
        ("PRODUCT", products, "product_code", "product_name", "0.95"),
        ("CUSTOMER", customers, "customer_number", "customer_name", "1.00"),
        ("SUPPLIER", suppliers, "supplier_code", "supplier_name", "1.00"),
        ("CARRIER", carriers, "carrier_code", "carrier_name", "1.00"),
        ("SUPPLY_CHAIN_NODE", nodes, "node_code", "node_name", "1.00"),
    ]
    records = None
    for entity_type, df, key, name, score in sources:
        one = df.select(
            F.lit(entity_type).alias("entity_type"),
            F.col(key).alias("canonical_key"),
            F.col(name).alias("canonical_name"),
            F.lit("ACTIVE").alias("status"),
            F.lit(score).cast("decimal(3,2)").alias("quality_score"),
        )
        records = one if records is None else records.unionByName(one)
    return insert_ignore(records, existing, ["entity_type", "canonical_key"])


def source_mappings(golden: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """The key of each golden record in every system that knows it."""
    key = F.col("canonical_key")

    def entry(system: str, source_key, canonical: bool):
        return F.struct(
            F.lit(system).alias("source_system"), source_key.alias("source_key"), F.lit(canonical).alias("is_canonical")
        )

    entries = (
        F.when(
            F.col("entity_type") == "PRODUCT",
            F.array(entry("ERP", key, True), entry("WMS", wms_key(key), False), entry("TMS", tms_key(key), False)),
        )
        .when(F.col("entity_type").isin("CUSTOMER", "SUPPLIER"), F.array(entry("ERP", key, True)))
        .when(F.col("entity_type") == "CARRIER", F.array(entry("TMS", key, True)))
        .otherwise(F.array(entry("WMS", key, True), entry("TMS", key, False)))
    )
    rows = golden.select("entity_type", "canonical_key", F.explode(entries).alias("m")).select(
        "entity_type",
        "canonical_key",
        "m.source_system",
        "m.source_key",
        match_key("m.source_key").alias("normalized_key"),
        "m.is_canonical",
    )
    return insert_ignore(rows, existing, ["source_system", "source_key"])


def _active(mappings: DataFrame, golden: DataFrame) -> DataFrame:
    live = golden.filter(F.col("status") == "ACTIVE").select("entity_type", "canonical_key")
    return mappings.join(live, ["entity_type", "canonical_key"], "left_semi")


def resolve(df: DataFrame, key_col: str, system: str, mappings: DataFrame, golden: DataFrame) -> DataFrame:
    """Add the canonical key for a key as spelled in ``system``; NULL if unknown."""
    lookup = (
        _active(mappings, golden)
        .filter(F.col("source_system") == system)
        .select(F.col("source_key").alias("_source"), "canonical_key")
    )
    return df.join(lookup, df[key_col] == lookup["_source"], "left").drop("_source")


def resolve_fuzzy(df: DataFrame, key_col: str, mappings: DataFrame, golden: DataFrame) -> DataFrame:
    """Add the canonical key for a key in any spelling.

    An exact match in any system wins over a match of the normalised form;
    among several canonical keys the smallest is taken. Each distinct key
    is resolved once.
    """

    def forms(exact, loose):
        rows = [F.struct(F.lit(i).alias("form"), c.alias("key")) for i, c in enumerate((exact, loose))]
        return F.explode(F.array(*rows)).alias("f")

    known = _active(mappings, golden).select(forms(F.col("source_key"), F.col("normalized_key")), "canonical_key")
    lookup = known.groupBy("f.form", "f.key").agg(F.min("canonical_key").alias("canonical_key"))
    keys = df.select(F.col(key_col).alias("_raw")).distinct()
    asked = keys.select("_raw", forms(F.col("_raw"), match_key("_raw"))).select("_raw", "f.form", "f.key")
    best = asked.join(lookup, ["form", "key"]).groupBy("_raw").agg(F.min(F.struct("form", "canonical_key")).alias("m"))
    resolved = best.select("_raw", "m.canonical_key")
    return df.join(resolved, df[key_col] == resolved["_raw"], "left").drop("_raw")


def golden_overview(golden: DataFrame, mappings: DataFrame) -> DataFrame:
    """One row per golden record with its key in each system."""

    def key_in(system: str):
        return F.max(F.when(F.col("source_system") == system, F.col("source_key"))).alias(f"{system.lower()}_key")

    per_record = mappings.groupBy("entity_type", "canonical_key").agg(
        key_in("ERP"), key_in("WMS"), key_in("TMS"), F.count("*").alias("total_mappings")
    )
    return golden.join(per_record, ["entity_type", "canonical_key"], "left").select(
        "entity_type",
        "canonical_key",
        "canonical_name",
        "status",
        "quality_score",
        "erp_key",
        "wms_key",
        "tms_key",
        F.coalesce("total_mappings", F.lit(0)).alias("total_mappings"),
    )


def coverage_by_type(golden: DataFrame, entity_types: DataFrame) -> DataFrame:
    """Golden records per entity type, empty types included."""
    counts = golden.groupBy(F.col("entity_type").alias("entity_type_code")).agg(
        F.count("*").alias("golden_records"), count_where(F.col("status") == "ACTIVE").alias("active_records")
    )
    return (
        entity_types.select("entity_type_code")
        .join(counts, "entity_type_code", "left")
        .na.fill(0, ["golden_records", "active_records"])
    )


def coverage_by_system(mappings: DataFrame) -> DataFrame:
    """Mappings per source system."""
    return mappings.groupBy("source_system").agg(
        F.count("*").alias("total_mappings"), count_where(F.col("is_canonical")).alias("canonical_mappings")
    )


def canonical_violations(mappings: DataFrame) -> DataFrame:
    """Golden records whose mappings do not have exactly one canonical entry."""
    return (
        mappings.groupBy("entity_type", "canonical_key")
        .agg(count_where(F.col("is_canonical")).alias("canonical_count"))
        .filter(F.col("canonical_count") != 1)
    )


def canonical_check(mappings: DataFrame) -> DataFrame:
    """The same check as one row with a message."""
    return canonical_violations(mappings).agg(F.count("*").alias("violations")).select(
        "violations",
        F.when(F.col("violations") == 0, "PASS – jeder Golden Record hat genau 1 canonical mapping")
        .otherwise(
            F.concat(
                F.lit("FAIL – "),
                F.col("violations").cast("string"),
                F.lit(" Golden Records ohne oder mit mehreren canonical mappings"),
            )
        )
        .alias("is_canonical_check"),
    )


def cross_system_keys(golden: DataFrame, mappings: DataFrame, left: str = "TMS", right: str = "ERP") -> DataFrame:
    """Products with their keys in two systems side by side."""
    products = golden.filter(F.col("entity_type") == "PRODUCT").select("entity_type", "canonical_key", "canonical_name")
    on = ["entity_type", "canonical_key"]

    def side(system: str):
        return mappings.filter(F.col("source_system") == system).select(
            *on, F.col("source_key").alias(f"{system.lower()}_key")
        )

    return products.join(side(left), on).join(side(right), on).drop("entity_type")


def shipments_of_product(shipments: DataFrame, mappings: DataFrame) -> DataFrame:
    """Shipments with the canonical key of their cargo."""
    tms = mappings.filter((F.col("source_system") == "TMS") & (F.col("entity_type") == "PRODUCT")).select(
        F.col("source_key").alias("cargo_product_reference"), "canonical_key"
    )
    return shipments.join(tms, "cargo_product_reference").select(
        "canonical_key", "shipment_identifier", "source_node", "target_node", "cargo_product_reference"
    )


def unharmonised_skus(skus: DataFrame, mappings: DataFrame) -> DataFrame:
    """Warehouse SKUs the mappings do not know."""
    known = mappings.filter(F.col("source_system") == "WMS")
    return matched(skus, known, {"sku": "source_key"}, keep=False).select("sku")


def unharmonised_references(shipments: DataFrame, mappings: DataFrame) -> DataFrame:
    """Cargo references of shipments the mappings do not know."""
    known = mappings.filter(F.col("source_system") == "TMS")
    references = shipments.select("cargo_product_reference").distinct()
    return matched(references, known, {"cargo_product_reference": "source_key"}, keep=False)


def key_matrix(products: DataFrame, skus: DataFrame, shipments: DataFrame) -> DataFrame:
    """Which normalised product key occurs in which system, and how it is spelled."""
    keys = (
        products.select(F.lit("ERP").alias("system"), F.col("product_code").alias("key"))
        .unionByName(skus.select(F.lit("WMS").alias("system"), F.col("sku").alias("key")))
        .unionByName(
            shipments.select(F.lit("TMS").alias("system"), F.col("cargo_product_reference").alias("key")).distinct()
        )
    )

    def key_in(system: str):
        return F.min(F.when(F.col("system") == system, F.col("key"))).alias(f"{system.lower()}_key")

    matrix = keys.groupBy(match_key("key").alias("normalized_key")).agg(key_in("ERP"), key_in("WMS"), key_in("TMS"))
    complete = F.col("erp_key").isNotNull() & F.col("wms_key").isNotNull() & F.col("tms_key").isNotNull()
    return matrix.withColumn("is_complete", complete)
