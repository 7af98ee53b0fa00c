"""Validation of events at load time and the quarantine split."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from freightloom import constants as C
from freightloom.functions.keys import key_format_ok
from freightloom.functions.numbers import breaks_cold_chain, within_cold_chain

# Rule codes and the treatment each calls for.
CRITICAL_RULES = ["RI-01", "RI-02", "EQ-01"]
WARNING_RULES = ["PQ-03", "VQ-03"]


def temperature_valid(column: str = "temperature") -> Column:
    """Measured and inside the corridor."""
    return within_cold_chain(column)


def product_code_valid(column: str, system: str) -> Column:
    """Product key in the format of its system."""
    return key_format_ok(column, system)


def order_quantity_valid(column: str = "quantity") -> Column:
    """Order quantity inside its usual range."""
    low, high = C.ORDER_QUANTITY_RANGE
    return F.coalesce(F.col(column).between(low, high), F.lit(False))


def validate_processings(processings: DataFrame) -> DataFrame:
    """Add the codes of broken rules: temperature missing or out of range."""
    errors = F.array(
        F.when(F.col("temperature").isNull(), F.lit("VQ-03")),
        F.when(breaks_cold_chain("temperature"), F.lit("PQ-03")),
    )
    return processings.withColumn("errors", F.array_compact(errors))


def validate_orders(orders: DataFrame) -> DataFrame:
    """Add one code per broken rule and item: quantity, price.

    A missing quantity or price counts as zero and so as broken.
    """

    def codes(item: Column) -> Column:
        quantity = F.coalesce(item["quantity"], F.lit(0))
        price = F.coalesce(item["unit_price"], F.lit(0).cast("decimal(10,2)"))
        return F.array(
            F.when(quantity <= 0, F.lit("PQ-01")),
            F.when(~price.between(F.lit(C.PRICE_MIN), F.lit(C.PRICE_MAX)), F.lit("PQ-02")),
        )

    per_item = F.flatten(F.transform(F.coalesce("items", F.array()), codes))
    return orders.withColumn("errors", F.array_compact(per_item))


def validate_references(df: DataFrame, ref: DataFrame, on: dict[str, str], code: str) -> DataFrame:
    """Append ``code`` to ``errors`` where a reference leads nowhere.

    The referenced keys are reduced to distinct ones, so no row multiplies.
    """
    keys = ref.select(*[F.col(r).alias(f"_ref_{i}") for i, r in enumerate(on.values())]).distinct()
    condition = F.lit(True)
    for i, left in enumerate(on):
        condition = condition & (df[left] == keys[f"_ref_{i}"])
    joined = df.join(keys.withColumn("_found", F.lit(True)), condition, "left")
    broken = F.when(F.col("_found").isNull(), F.array(F.lit(code))).otherwise(F.array().cast("array<string>"))
    return joined.withColumn("errors", F.concat(F.coalesce("errors", F.array().cast("array<string>")), broken)).select(
        *df.columns
    )


def split(validated: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``(ok, warning, quarantine)``.

    Critical codes lead to quarantine; any other code loads the row with a
    flag and notes.
    """
    critical = F.exists("errors", lambda e: e.isin(CRITICAL_RULES))
    clean = F.size("errors") == 0
    ok = validated.filter(clean).drop("errors")
    warning = (
        validated.filter(~clean & ~critical)
        .withColumn("quality_flag", F.lit("WARNING"))
        .withColumn("quality_notes", F.array_join("errors", ","))
        .drop("errors")
    )
    quarantine = validated.filter(critical).withColumnRenamed("errors", "reasons")
    return ok, warning, quarantine


def split_summary(validated: DataFrame) -> DataFrame:
    """Rows by destination and list of codes."""
    critical = F.exists("errors", lambda e: e.isin(CRITICAL_RULES))
    destination = (
        F.when(critical, "QUARANTINE").when(F.size("errors") > 0, "WARNING").otherwise("OK").alias("destination")
    )
    return validated.groupBy(destination, F.array_join("errors", ",").alias("codes")).agg(F.count("*").alias("rows"))
