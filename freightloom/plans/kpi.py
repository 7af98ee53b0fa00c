"""Key figures over the fulfilment fact.

Groups are formed on surrogate keys first; names are joined to the few
rows that remain.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from freightloom.constants import COLD_CHAIN_MAX, COLD_CHAIN_MIN
from freightloom.functions.numbers import breaks_cold_chain, count_where, exact, half_up, mean, percentage


def carrier_performance(fact: DataFrame, carriers: DataFrame) -> DataFrame:
    """Deliveries, on-time rate and delay per carrier; unknown carriers drop out."""
    per_carrier = (
        fact.filter(F.col("carrier_sk").isNotNull())
        .groupBy("carrier_sk")
        .agg(
            F.count("*").alias("total_hops"),
            count_where(F.col("on_time_flag")).alias("on_time_count"),
            count_where(~F.col("on_time_flag")).alias("delayed_count"),
            F.sum("delay_minutes").alias("_delay"),
            F.count("delay_minutes").alias("_delays"),
            F.max("delay_minutes").alias("max_delay_minutes"),
        )
    )
    return per_carrier.join(carriers.select("carrier_sk", "carrier_code", "carrier_name"), "carrier_sk").select(
        "carrier_code",
        "carrier_name",
        "total_hops",
        "on_time_count",
        "delayed_count",
        percentage(F.col("on_time_count"), F.col("total_hops")).alias("otd_rate_pct"),
        mean(F.col("_delay"), F.col("_delays"), 1).alias("avg_delay_minutes"),
        "max_delay_minutes",
    )


def kpi_summary(fact: DataFrame) -> DataFrame:
    """The five key figures as one row."""
    outlier = ~F.col("avg_temperature").between(F.lit(COLD_CHAIN_MIN), F.lit(COLD_CHAIN_MAX))
    totals = fact.agg(
        F.count("*").alias("total_fulfillments"),
        count_where(F.col("on_time_flag")).alias("_on_time"),
        F.sum("delay_minutes").alias("_delay"),
        F.count("delay_minutes").alias("_delays"),
        count_where(outlier).alias("_outliers"),
        F.count("avg_temperature").alias("_measured"),
        F.sum(exact("total_value")).alias("_value"),
        F.count("total_value").alias("_values"),
    )
    return totals.select(
        "total_fulfillments",
        percentage(F.col("_on_time"), F.col("total_fulfillments")).alias("kpi_otd_rate_pct"),
        mean(F.col("_delay"), F.col("_delays") * 60, 2).alias("kpi_avg_delay_hours"),
        percentage(F.col("_outliers"), F.col("_measured")).alias("kpi_temp_outlier_pct"),
        mean(F.col("_value"), F.col("_values"), 2).alias("kpi_avg_order_value_eur"),
        half_up(F.col("_value"), 2, 28).alias("kpi_total_revenue_eur"),
    )


def monthly_revenue(fact: DataFrame, dates: DataFrame, products: DataFrame) -> DataFrame:
    """Quantity, revenue and deliveries per product and order month."""
    per_day = fact.groupBy("order_date_sk", "product_sk").agg(
        F.sum("quantity").alias("q"), F.sum(exact("total_value")).alias("v"), F.count("*").alias("n")
    )
    months = dates.select(F.col("date_sk").alias("order_date_sk"), "year", "month", "month_name")
    per_month = (
        per_day.join(months, "order_date_sk")
        .groupBy("year", "month", "month_name", "product_sk")
        .agg(
            F.sum("q").alias("total_quantity"),
            F.sum("v").alias("total_revenue_eur"),
            F.sum("n").alias("num_shipments"),
        )
    )
    return per_month.join(products.select("product_sk", "product_code", "product_name"), "product_sk").select(
        "year", "month", "month_name", "product_code", "product_name", "total_quantity", "total_revenue_eur",
        "num_shipments",
    )


def revenue_by_customer_month(fact: DataFrame, customers: DataFrame, dates: DataFrame) -> DataFrame:
    """Revenue per customer name and order month."""
    per_day = fact.groupBy("order_date_sk", "customer_sk").agg(F.sum(exact("total_value")).alias("v"))
    return (
        per_day.join(dates.select(F.col("date_sk").alias("order_date_sk"), "year", "month"), "order_date_sk")
        .join(customers.select("customer_sk", "customer_name"), "customer_sk")
        .groupBy("customer_name", "year", "month")
        .agg(F.sum("v").alias("revenue_eur"))
    )


def temperature_by_node(fact: DataFrame, nodes: DataFrame) -> DataFrame:
    """Average product temperature and breaches per destination."""
    per_node = (
        fact.filter(F.col("avg_temperature").isNotNull())
        .groupBy(F.col("destination_node_sk").alias("node_sk"))
        .agg(
            F.sum(exact("avg_temperature")).alias("_sum"),
            F.count("*").alias("_count"),
            count_where(breaks_cold_chain("avg_temperature")).alias("breaches"),
        )
    )
    return per_node.join(nodes.select("node_sk", "node_name", "sequence_order"), "node_sk").select(
        "node_name", "sequence_order", mean(F.col("_sum"), F.col("_count"), 2).alias("avg_temp"), "breaches"
    )


def on_time_distribution(fact: DataFrame) -> DataFrame:
    """Deliveries by on-time flag."""
    return fact.groupBy("on_time_flag").agg(F.count("*").alias("fulfillments"))


def fact_plausibility(fact: DataFrame) -> DataFrame:
    """One row of averages to judge a load by."""
    totals = fact.agg(
        F.count("*").alias("total_facts"),
        F.sum("quantity").alias("_quantity"),
        F.count("quantity").alias("_quantities"),
        F.sum(exact("avg_temperature")).alias("_temp"),
        F.count("avg_temperature").alias("_temps"),
        F.sum("delay_minutes").alias("_delay"),
        F.count("delay_minutes").alias("_delays"),
        count_where(F.col("on_time_flag")).alias("on_time_count"),
    )
    return totals.select(
        "total_facts",
        mean(F.col("_quantity"), F.col("_quantities"), 1).alias("avg_quantity"),
        mean(F.col("_temp"), F.col("_temps"), 2).alias("avg_temp_celsius"),
        mean(F.col("_delay"), F.col("_delays"), 1).alias("avg_delay_minutes"),
        "on_time_count",
        percentage(F.col("on_time_count"), F.col("total_facts")).alias("on_time_pct"),
    )


