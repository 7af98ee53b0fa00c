"""Data catalogue: systems, tables and columns with their scale level."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from freightloom.functions.numbers import percentage
from freightloom.operators.writes import insert_ignore
from freightloom.sources.constant import constant
from freightloom.sources.relations import catalogue_columns

# System code and name.
SYSTEMS = [
    ("ERP", "Enterprise Resource Planning"),
    ("WMS", "Warehouse Management System"),
    ("TMS", "Transport Management System"),
    ("MDM", "Master Data Management"),
    ("META", "Metadatenmanagement"),
    ("DWH", "Data Warehouse"),
]

# Schema, table, data category, source event.
TABLES = [
    ("erp", "suppliers", "STAMMDATEN", "SupplierCreated"),
    ("erp", "customers", "STAMMDATEN", "CustomerCreated"),
    ("erp", "products", "STAMMDATEN", "ProductCreated"),
    ("erp", "orders", "BEWEGUNGSDATEN", "OrderCreated"),
    ("erp", "order_items", "BEWEGUNGSDATEN", "OrderCreated"),
    ("erp", "batches", "BEWEGUNGSDATEN", "BatchHarvested"),
    ("wms", "warehouse_skus", "STAMMDATEN", "WarehouseSKUCreated"),
    ("wms", "supply_chain_nodes", "STAMMDATEN", None),
    ("wms", "node_processings", "BEWEGUNGSDATEN", "NodeProcessed"),
    ("tms", "carriers", "STAMMDATEN", "CarrierCreated"),
    ("tms", "transport_product_references", "STAMMDATEN", "TransportProductReferenceCreated"),
    ("tms", "shipments", "BEWEGUNGSDATEN", "TransportStarted"),
    ("tms", "shipment_positions", "ECHTZEITDATEN", "ShipmentPositionUpdated"),
    ("tms", "transport_completions", "EVENTDATEN", "TransportCompleted"),
    ("tms", "deliveries", "EVENTDATEN", "DeliveryCompleted"),
    ("mdm", "entity_types", "METADATEN", None),
    ("mdm", "golden_records", "METADATEN", None),
    ("mdm", "source_mappings", "METADATEN", None),
    ("erp", "document_references", "METADATEN", None),
    ("dwh", "dim_customer", "ANALYTIK", None),
    ("dwh", "dim_product", "ANALYTIK", None),
    ("dwh", "dim_supplier", "ANALYTIK", None),
    ("dwh", "dim_carrier", "ANALYTIK", None),
    ("dwh", "dim_supply_chain_node", "ANALYTIK", None),
    ("dwh", "dim_date", "ANALYTIK", None),
    ("dwh", "dim_delivery_status", "ANALYTIK", None),
    ("dwh", "fact_fulfillment", "ANALYTIK", None),
]

# Columns without scale level.
AUDIT_COLUMNS = ["created_at", "source_event", "etl_loaded_at", "etl_source"]

# Columns by scale level.
ORDINAL_COLUMNS = [
    "delivery_priority", "delivery_priority_code", "year", "quarter", "month", "week_of_year", "day_of_month",
    "day_of_week", "month_name", "day_name",
]
COORDINATES = ["latitude", "longitude"]
TIME_PATTERNS = ["%_at", "%_timestamp", "%_arrival"]
TIME_TYPES = ["TIMESTAMP", "TIMESTAMP_NTZ", "DATE"]
RATIO_COLUMNS = [
    "quantity", "unit_price", "total_value", "delay_minutes", "speed_kmh", "sequence_order", "num_supply_chain_hops",
    "quality_score",
]

# Description by column.
DESCRIPTIONS = {
    "latitude": "WGS84-Breitengrad (-90 bis 90)",
    "longitude": "WGS84-Längengrad (-180 bis 180)",
    "temperature": "Containertemperatur in °C; Soll 10-15°C (Kühlkette)",
    "avg_temperature": "Durchschnittstemperatur in °C über alle Knoten dieser Lieferung",
    "delay_minutes": "Verzögerung in Minuten (0 = pünktlich)",
    "quantity": "Mengeneinheiten (Karton, Stück, Einheit)",
    "unit_price": "Einzelpreis in EUR",
    "total_value": "Gesamtwert in EUR (quantity * unit_price)",
    "delivery_priority": "Lieferpriorität: LOW < NORMAL < HIGH",
    "sequence_order": "Reihenfolge im Supply-Chain-Flow (1-7)",
}

# Quality rule by pattern of the column, first match counts.
QUALITY_RULES = [
    ("%temperature", "Soll 10-15°C; Abweichungen = Kühlkettenbruch"),
    ("latitude", "BETWEEN -90 AND 90"),
    ("longitude", "BETWEEN -180 AND 180"),
    ("delay_minutes", ">= 0; > 30 min = SLA-Verletzung"),
    ("quantity", "> 0 (negative Mengen unzulässig)"),
    ("unit_price", "> 0 EUR"),
    ("delivery_priority", "IN (LOW, NORMAL, HIGH)"),
    ("delivery_status", "IN (SUCCESSFUL, DELAYED, FAILED)"),
    ("%_code", "Format <KÜRZEL>-NNN (z.B. BAN-101)"),
    ("%_reference", "UUID-basiert oder fachliches Eindeutigkeitskriterium"),
    ("%_identifier", "UUID-basiert oder fachliches Eindeutigkeitskriterium"),
]

# Technical keys that are primary, and those that are no foreign key.
PRIMARY_KEYS = [
    "processing_id", "item_id", "position_id", "completion_id", "delivery_id", "sku_id", "batch_id", "mapping_id",
    "golden_id", "entity_type_id", "column_id", "table_id", "system_id", "ref_id", "fulfillment_sk", "status_sk",
    "node_sk", "date_sk",
]
NOT_FOREIGN_KEYS = [
    "order_id", "processing_id", "item_id", "position_id", "completion_id", "delivery_id", "sku_id", "batch_id",
    "shipment_id_pk", "mapping_id", "golden_id", "entity_type_id", "column_id", "table_id", "system_id", "ref_id",
    "fulfillment_sk",
]


def systems(spark: SparkSession) -> DataFrame:
    """The registered systems."""
    return constant(spark, SYSTEMS, "system_code string, system_name string")


def registered_tables(spark: SparkSession, existing: DataFrame | None = None) -> DataFrame:
    """The registered tables with their system, data category and source event."""
    tables = constant(
        spark,
        TABLES, "schema_name string, table_name string, data_category string, source_event string"
    )
    linked = tables.join(systems(spark), F.upper("schema_name") == F.col("system_code")).select(
        "system_code", "schema_name", "table_name", "data_category", "source_event"
    )
    return insert_ignore(linked, existing, ["schema_name", "table_name"])


def _like_any(column: str, patterns: list[str]) -> Column:
    condition = F.lit(False)
    for pattern in patterns:
        condition = condition | F.col(column).like(pattern)
    return condition


def scale_level() -> Column:
    """NOMINAL, ORDINAL, INTERVAL or RATIO by type and name of a column."""
    name = F.col("column_name")
    return (
        F.when(F.col("data_type") == "BOOLEAN", "NOMINAL")
        .when(name.isin(ORDINAL_COLUMNS), "ORDINAL")
        .when(
            name.like("%temperature%")
            | name.isin(COORDINATES)
            | _like_any("column_name", TIME_PATTERNS)
            | F.col("data_type").isin(TIME_TYPES),
            "INTERVAL",
        )
        .when(name.isin(RATIO_COLUMNS), "RATIO")
        .when(name == "date_sk", "ORDINAL")
        .otherwise("NOMINAL")
    )


def _description() -> Column:
    text = F.lit(None).cast("string")
    for column, value in reversed(DESCRIPTIONS.items()):
        text = F.when(F.col("column_name") == column, value).otherwise(text)
    return text


def _quality_rule() -> Column:
    text = F.lit(None).cast("string")
    for pattern, value in reversed(QUALITY_RULES):
        text = F.when(F.col("column_name").like(pattern), value).otherwise(text)
    return text


def null_counts(schema: str, table: str, df: DataFrame) -> DataFrame:
    """Rows and NULLs of every column of one table, in one scan."""
    columns = [c for c in df.columns if c not in AUDIT_COLUMNS]
    counts = df.agg(F.count("*").alias("_rows"), *[F.count_if(F.col(c).isNull()).alias(f"_{i}") for i, c in enumerate(columns)])
    pairs = ", ".join(f"'{c}', _{i}" for i, c in enumerate(columns))
    return counts.select(
        F.lit(schema).alias("schema_name"),
        F.lit(table).alias("table_name"),
        F.col("_rows").alias("row_count"),
        F.expr(f"stack({len(columns)}, {pairs}) AS (column_name, nulls)"),
    )


def catalogue(
    spark: SparkSession, schemas: dict[str, dict[str, DataFrame]], curated: DataFrame | None = None
) -> DataFrame:
    """Every column of the registered tables, classified by rule.

    Parquet columns are all declared nullable, so ``is_nullable`` states
    whether the data holds a NULL. Entries in ``curated`` (same columns) go
    before the rules.
    """
    columns = catalogue_columns(spark, schemas).filter(~F.col("column_name").isin(AUDIT_COLUMNS))
    profile = None
    for schema, tables in schemas.items():
        for table, df in tables.items():
            one = null_counts(schema, table, df)
            profile = one if profile is None else profile.unionByName(one)
    name = F.col("column_name")
    like_id = name.like("%_id") | name.like("%_sk")
    classified = (
        columns.join(registered_tables(spark), ["schema_name", "table_name"])
        .join(profile, ["schema_name", "table_name", "column_name"])
        .select(
            "schema_name",
            "table_name",
            "column_name",
            "data_type",
            _description().alias("description"),
            "data_category",
            scale_level().alias("scale_level"),
            _quality_rule().alias("quality_rule"),
            (F.col("nulls") > 0).alias("is_nullable"),
            (
                (name == F.concat("table_name", F.lit("_id")))
                | (name == F.concat("table_name", F.lit("_sk")))
                | name.isin(PRIMARY_KEYS)
            ).alias("is_pk"),
            (like_id & ~name.isin(NOT_FOREIGN_KEYS)).alias("is_fk"),
        )
    )
    if curated is None:
        return classified
    keys = ["schema_name", "table_name", "column_name"]
    chosen = curated.join(registered_tables(spark).select("schema_name", "table_name"), keys[:2], "left_semi")
    return chosen.unionByName(insert_ignore(classified, chosen, keys))


def curated_entries(spark: SparkSession, schema: str, table: str, rows: list[tuple]) -> DataFrame:
    """Hand-written entries of one table, for the ``curated`` side of a catalogue.

    Each row: column, type, description, category, scale level, quality
    rule, nullable, primary key, foreign key.
    """
    entries = constant(
        spark,
        rows,
        "column_name string, data_type string, description string, data_category string, scale_level string, "
        "quality_rule string, is_nullable boolean, is_pk boolean, is_fk boolean",
    )
    table_row = registered_tables(spark).filter((F.col("schema_name") == schema) & (F.col("table_name") == table))
    return table_row.select("schema_name", "table_name").crossJoin(entries)  # one row on the left


def coverage(classified: DataFrame, columns: DataFrame) -> DataFrame:
    """Classified columns, all columns and their share in percent."""
    total = columns.filter(~F.col("column_name").isin(AUDIT_COLUMNS)).agg(F.count("*").alias("total"))
    return (
        classified.agg(F.count("*").alias("classified"))
        .crossJoin(total)  # one row each
        .withColumn("pct", percentage(F.col("classified"), F.col("total")))
    )


def scale_distribution(classified: DataFrame) -> DataFrame:
    """Columns per scale level."""
    return classified.groupBy("scale_level").agg(F.count("*").alias("columns"))


def find_columns(
    classified: DataFrame,
    scale: str | None = None,
    schema: str | None = None,
    category: str | None = None,
    with_rule: bool = False,
) -> DataFrame:
    """Columns by scale level, schema or data category, or those with a quality rule."""
    found = classified
    if scale is not None:
        found = found.filter(F.col("scale_level") == scale)
    if schema is not None:
        found = found.filter(F.col("schema_name") == schema)
    if category is not None:
        found = found.filter(F.col("data_category") == category)
    return found.filter(F.col("quality_rule").isNotNull()) if with_rule else found


def table_registry(spark: SparkSession, schemas: dict[str, dict[str, DataFrame]]) -> DataFrame:
    """Registered tables with their current number of rows; NULL where not at hand."""
    counts = None
    for schema, tables in schemas.items():
        for table, df in tables.items():
            one = df.agg(F.count("*").alias("row_count")).select(
                F.lit(schema).alias("schema_name"), F.lit(table).alias("table_name"), "row_count"
            )
            counts = one if counts is None else counts.unionByName(one)
    return registered_tables(spark).join(counts, ["schema_name", "table_name"], "left")
