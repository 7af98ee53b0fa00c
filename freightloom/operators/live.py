"""Live state as of a moment, folded from events in the order of their time.

Each state row carries ``updated_at`` and ``expires_at``; ``not_expired``
keeps what is alive at a moment. The streaming counterparts stand in
``freightloom.streaming.live`` and end in the same state.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from freightloom.constants import TTL_SECONDS
from freightloom.functions.dates import date_key, epoch_seconds, moment, plus_seconds
from freightloom.functions.keys import normalize_key
from freightloom.functions.numbers import breaks_cold_chain
from freightloom.functions.texts import position_member
from freightloom.operators.skew import bounded_lists

SHIPMENT = "shipment_identifier"


def distinct_events(events: DataFrame, key: str = SHIPMENT) -> DataFrame:
    """Events without repetitions of (key, type, time)."""
    return events.dropDuplicates([key, "event_type", "event_timestamp"])


def _latest(df: DataFrame, key: str, *fields: str) -> DataFrame:
    """The last values per key; the fields break ties of time."""
    return df.groupBy(key).agg(F.max(F.struct("event_timestamp", *fields)).alias("v")).select(
        key, F.col("v.event_timestamp").alias("updated_at"), *[F.col(f"v.{f}").alias(f) for f in fields]
    )


def _expiring(state: DataFrame, ttl: Column | int) -> DataFrame:
    return state.withColumn("expires_at", plus_seconds("updated_at", ttl))


def status_changes(started: DataFrame, delivered: DataFrame) -> DataFrame:
    """Status changes of shipments; at the same time a delivery comes after a start."""
    return started.select(
        SHIPMENT, "event_timestamp", F.lit(0).alias("rank"), F.lit("IN_TRANSIT").alias("status")
    ).unionByName(
        delivered.select(
            SHIPMENT, "event_timestamp", F.lit(1).alias("rank"), F.coalesce("delivery_status", F.lit("UNKNOWN")).alias("status")
        )
    )


def status_ttl() -> Column:
    """Seconds a status lives: longer once it is final."""
    return F.when(F.col("status") == "IN_TRANSIT", TTL_SECONDS["shipment_status_in_transit"]).otherwise(
        TTL_SECONDS["shipment_status_final"]
    )


def shipment_status(started: DataFrame, delivered: DataFrame) -> DataFrame:
    """Current status per shipment."""
    return _expiring(_latest(status_changes(started, delivered), SHIPMENT, "rank", "status").drop("rank"), status_ttl())


def flat_starts(started: DataFrame) -> DataFrame:
    """Transport starts with the carrier's key and no missing texts."""
    texts = [F.coalesce(c, F.lit("")).alias(c) for c in ("transport_mode", "source_node", "target_node")]
    return started.select(
        SHIPMENT, "event_timestamp", *texts, F.coalesce("carrier.carrier_id", F.lit("")).alias("carrier_id")
    )


def shipment_info(started: DataFrame) -> DataFrame:
    """Route, mode and carrier per shipment, as last started."""
    state = _latest(flat_starts(started), SHIPMENT, "transport_mode", "source_node", "target_node", "carrier_id")
    return _expiring(state, TTL_SECONDS["shipment_info"])


def latest_position(positions: DataFrame) -> DataFrame:
    """Last known position per shipment."""
    state = _latest(positions, SHIPMENT, "latitude", "longitude", "container_temperature", "speed_kmh")
    return _expiring(state, TTL_SECONDS["shipment_position"])


def route_members(positions: DataFrame, repeated: bool = False) -> DataFrame:
    """Points of routes: shipment, score in seconds, member as JSON text; each once unless ``repeated``."""
    c = F.col
    members = positions.select(
        SHIPMENT,
        "event_timestamp",
        epoch_seconds("event_timestamp").alias("score"),
        position_member(c("latitude"), c("longitude"), c("container_temperature"), c("event_timestamp")).alias("member"),
    )
    return members if repeated else members.distinct()


def route_history(positions: DataFrame) -> DataFrame:
    """Points of each route in order of time, one part a day."""
    members = route_members(positions)
    parts = bounded_lists(members, [SHIPMENT], F.struct("score", "member"), "route", date_key("event_timestamp"))
    last = members.groupBy(SHIPMENT).agg(F.max("event_timestamp").alias("updated_at"))
    return _expiring(parts.join(last, SHIPMENT), TTL_SECONDS["shipment_route"])


def temperature_breaches(positions: DataFrame) -> DataFrame:
    """Positions outside the corridor."""
    return positions.filter(breaks_cold_chain("container_temperature"))


def temperature_alerts(positions: DataFrame) -> DataFrame:
    """Shipments with an alert, as of their last breach."""
    state = (
        temperature_breaches(positions)
        .groupBy(SHIPMENT)
        .agg(F.max("event_timestamp").alias("updated_at"))
        .withColumn("alert", F.lit("ALERT"))
    )
    return _expiring(state, TTL_SECONDS["temperature_alert"])


def violation_members(positions: DataFrame) -> DataFrame:
    """Breaches by day of the event: day, member, temperature; each once."""
    bad = temperature_breaches(positions)
    member = F.concat(
        SHIPMENT,
        F.lit(":"),
        F.date_format("event_timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"),
        F.lit(":temp="),
        F.col("container_temperature").cast("double").cast("string"),
    )
    return bad.select(
        date_key("event_timestamp").alias("day"),
        member.alias("member"),
        F.col("container_temperature").alias("temperature"),
        "event_timestamp",
    )


def violation_ranking(positions: DataFrame) -> DataFrame:
    """Daily list of breaches; its order is by temperature, then member."""
    members = violation_members(positions)
    ranked = members.groupBy("day", "member", "temperature").agg(F.max("event_timestamp").alias("updated_at"))
    return _expiring(ranked, TTL_SECONDS["violation_ranking"])


def ranking_by_score(
    ranking: DataFrame, day: int | None = None, at_least: float | None = None, at_most: float | None = None
) -> DataFrame:
    """Entries of the daily lists in a range of temperatures, ascending."""
    chosen = ranking if day is None else ranking.filter(F.col("day") == day)
    if at_least is not None:
        chosen = chosen.filter(F.col("temperature") >= at_least)
    if at_most is not None:
        chosen = chosen.filter(F.col("temperature") <= at_most)
    return chosen.orderBy("day", "temperature", "member")


# --- counters ----------------------------------------------------------------------


def active_shipments(started: DataFrame, delivered: DataFrame) -> DataFrame:
    """Started minus delivered, never below zero along the way.

    A delivery while the counter stands at zero leaves it there. The final
    value is ``total - min(0, lowest running total)``. Running totals are
    taken within a minute, then over the minutes of a day, then over days,
    so no window spans more than one of these.
    """
    steps = started.select("event_timestamp", F.lit(1).alias("step")).unionByName(
        delivered.select("event_timestamp", F.lit(-1).alias("step"))
    )
    per_moment = steps.groupBy("event_timestamp").agg(
        F.count_if(F.col("step") > 0).alias("up"), F.count_if(F.col("step") < 0).alias("down")
    )
    # starts of a moment come before its deliveries, so the low point is its end
    points = per_moment.select(
        F.date_trunc("minute", "event_timestamp").alias("minute"),
        F.col("event_timestamp").alias("at"),
        (F.col("up") - F.col("down")).alias("total"),
        F.least(F.lit(0), F.col("up") - F.col("down")).alias("low"),
    )

    def folded(df: DataFrame, group: list[str], order: str) -> DataFrame:
        before = Window.partitionBy(*group).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
        running = df.withColumn("base", F.coalesce(F.sum("total").over(before), F.lit(0)))
        return running.groupBy(*group).agg(
            F.sum("total").alias("total"), F.min(F.col("base") + F.col("low")).alias("low")
        )

    minutes = folded(points, ["minute"], "at").withColumn("day", F.to_date("minute"))
    days = folded(minutes, ["day"], "minute")
    # one row per calendar day is left
    whole = folded(days.withColumn("all", F.lit(1)), ["all"], "day")
    value = F.coalesce(F.sum(F.col("total") - F.least(F.lit(0), F.col("low"))), F.lit(0))
    return whole.agg(value.cast("long").alias("active_shipments"))


def delivery_counters(delivered: DataFrame) -> DataFrame:
    """Deliveries by status, each event counted."""
    status = F.lower(F.coalesce("delivery_status", F.lit("UNKNOWN")))
    return delivered.groupBy(F.concat(F.lit("deliveries_"), status).alias("counter")).agg(F.count("*").alias("value"))


def alert_counter(positions: DataFrame) -> DataFrame:
    """Temperature alerts raised so far."""
    return temperature_breaches(positions).agg(F.count("*").alias("temperature_alerts"))


def orders_per_day(orders: DataFrame) -> DataFrame:
    """Orders by day of the event."""
    return orders.groupBy(date_key("event_timestamp").alias("day")).agg(F.count("*").alias("orders"))


def orders_today(orders: DataFrame, as_of: datetime) -> DataFrame:
    """Orders of the day a moment lies in."""
    day = date_key(moment(as_of))
    return orders.filter(date_key("event_timestamp") == day).agg(F.count("*").alias("orders_today"))


def load_runs(log: DataFrame) -> DataFrame:
    """Number of loads in a log with one row per load."""
    return log.agg(F.count("*").alias("etl_runs"))


# --- orders and products --------------------------------------------------------------


def order_status(orders: DataFrame) -> DataFrame:
    """Status per order; an order event means it was created."""
    state = orders.groupBy("order_reference").agg(F.max("event_timestamp").alias("updated_at"))
    return _expiring(state.withColumn("status", F.lit("CREATED")), TTL_SECONDS["order"])


def order_meta(orders: DataFrame) -> DataFrame:
    """Customer and priority per order, as last stated."""
    flat = orders.select(
        "order_reference",
        "event_timestamp",
        F.coalesce("customer.customer_number", F.lit("")).alias("customer_number"),
        F.coalesce("customer.customer_name", F.lit("")).alias("customer_name"),
        F.col("delivery_priority").alias("priority"),
    )
    return _expiring(_latest(flat, "order_reference", "customer_number", "customer_name", "priority"), TTL_SECONDS["order"])


def order_timeline(orders: DataFrame) -> DataFrame:
    """Entries of each order in order of time, one part a day."""
    entry = F.concat(F.date_format("event_timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit(" – CREATED"))
    parts = bounded_lists(orders, ["order_reference"], entry, "timeline", date_key("event_timestamp"))
    last = orders.groupBy("order_reference").agg(F.max("event_timestamp").alias("updated_at"))
    return _expiring(parts.join(last, "order_reference"), TTL_SECONDS["order"])


def product_cache(products: DataFrame, orders: DataFrame) -> DataFrame:
    """Description and price per product; the first writer wins.

    Product events write before order lines, each group in order of time.
    """
    from_products = products.select(
        normalize_key("product_code").alias("product_code"),
        F.lit(0).alias("source"),
        "event_timestamp",
        F.lit(0).alias("position"),
        F.coalesce("product_name", F.lit("")).alias("description"),
        F.coalesce(F.col("unit_price").cast("double").cast("string"), F.lit("")).alias("unit_price"),
    )
    from_orders = orders.select("event_timestamp", F.posexplode("items").alias("position", "i")).select(
        normalize_key("i.product_code").alias("product_code"),
        F.lit(1).alias("source"),
        "event_timestamp",
        "position",
        F.coalesce("i.description", F.lit("")).alias("description"),
        F.coalesce(F.col("i.unit_price").cast("double").cast("string"), F.lit("")).alias("unit_price"),
    )
    writes = from_products.unionByName(from_orders).filter(F.col("product_code") != "")
    state = writes.groupBy("product_code").agg(
        F.min(F.struct("source", "event_timestamp", "position", "description", "unit_price")).alias("v")
    )
    flat = state.select(
        "product_code", F.col("v.event_timestamp").alias("updated_at"), "v.description", "v.unit_price"
    )
    return _expiring(flat, TTL_SECONDS["product_cache"])


# --- questions to the state --------------------------------------------------------------


def not_expired(state: DataFrame, as_of: datetime) -> DataFrame:
    """State that is alive at a moment."""
    return state.filter(F.col("expires_at") > moment(as_of))


def entries(kind: str, prefix: str, state: DataFrame, key: str) -> DataFrame:
    """A state as generic entries: key, kind, value as JSON, times."""
    fields = [c for c in state.columns if c not in (key, "updated_at", "expires_at")]
    return state.select(
        F.concat(F.lit(prefix), F.col(key)).alias("key"),
        F.lit(kind).alias("kind"),
        F.to_json(F.struct(*fields)).alias("value"),
        "updated_at",
        "expires_at",
    )


def find(state_entries: DataFrame, pattern: str, kind: str | None = None) -> DataFrame:
    """Entries whose key matches a pattern with ``*``, of one kind when named."""
    escaped = pattern.replace("\\", "\\\\").replace("%", "\\%").replace("_", "\\_").replace("*", "%")
    found = state_entries.filter(F.col("key").like(escaped))
    return found if kind is None else found.filter(F.col("kind") == kind)
