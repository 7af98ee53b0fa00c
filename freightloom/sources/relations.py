"""Constant relations, the calendar and the catalogue scan."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from freightloom import constants as C
from freightloom.functions.dates import date_parts
from freightloom.sources.constant import constant


def supply_chain_nodes(spark: SparkSession) -> DataFrame:
    """The seven stations; the sequence doubles as key."""
    rows = [(seq, code, name, kind, region, seq) for code, name, kind, region, seq in C.NODES]
    return constant(
        spark,
        rows, "node_id int, node_code string, node_name string, node_type string, region string, sequence_order int"
    )


def graph_node_names(spark: SparkSession) -> DataFrame:
    """Station names used in the graph."""
    return constant(spark, list(C.GRAPH_NODE_NAMES.items()), "node_code string, graph_name string")


def topology(spark: SparkSession) -> DataFrame:
    """The six hops with mode and typical duration."""
    return constant(
        spark,
        C.TOPOLOGY, "source_node string, target_node string, transport_mode string, typical_hours int"
    )


def carrier_node_types(spark: SparkSession) -> DataFrame:
    """Which carrier serves which type of station by which mode."""
    return constant(
        spark,
        C.CARRIER_NODE_TYPES, "carrier_code string, transport_mode string, node_type string"
    )


def delivery_statuses(spark: SparkSession) -> DataFrame:
    """The four delivery statuses."""
    rows = [(i + 1, *row) for i, row in enumerate(C.DELIVERY_STATUSES)]
    return constant(
        spark,
        rows, "status_sk long, status_code string, status_name string, is_successful boolean, description string"
    )


def entity_types(spark: SparkSession) -> DataFrame:
    """The five master-data entity types."""
    return constant(
        spark,
        C.ENTITY_TYPES, "entity_type_code string, entity_type_name string, source_schema string"
    )


def calendar(spark: SparkSession, start: date | str, end: date | str) -> DataFrame:
    """One row per day from ``start`` to ``end``, both included."""
    span = spark.range(1).select(
        F.explode(
            F.sequence(F.lit(str(start)).cast("date"), F.lit(str(end)).cast("date"), F.expr("interval 1 day"))
        ).alias("day")
    )
    return span.select(*[v.alias(k) for k, v in date_parts("day").items()])


def calendar_of(moments: DataFrame, column: str) -> DataFrame:
    """The calendar of the full years a column of timestamps touches."""
    years = moments.agg(F.min(F.year(column)).alias("lo"), F.max(F.year(column)).alias("hi"))
    days = years.filter(F.col("lo").isNotNull()).select(
        F.explode(
            F.sequence(F.make_date("lo", F.lit(1), F.lit(1)), F.make_date("hi", F.lit(12), F.lit(31)), F.expr("interval 1 day"))
        ).alias("day")
    )
    return days.select(*[v.alias(k) for k, v in date_parts("day").items()])


def catalogue_columns(spark: SparkSession, schemas: dict[str, dict[str, DataFrame]]) -> DataFrame:
    """Columns of the given tables: schema, table, column, type, position.

    Takes ``{schema: {table: DataFrame}}``; only the schemas are read, no data.
    """
    rows = [
        (schema, table, field.name, field.dataType.simpleString().upper(), position)
        for schema, tables in schemas.items()
        for table, df in tables.items()
        for position, field in enumerate(df.schema.fields, start=1)
    ]
    return constant(
        spark,
        rows, "schema_name string, table_name string, column_name string, data_type string, ordinal_position int"
    )


def database_columns(spark: SparkSession, databases: list[str]) -> DataFrame:
    """The same listing for tables registered in Spark databases."""
    tables = {
        db: {t.name: spark.table(f"{db}.{t.name}") for t in spark.catalog.listTables(db) if not t.isTemporary}
        for db in databases
    }
    return catalogue_columns(spark, tables)
