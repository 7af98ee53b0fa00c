"""A stream that is fed file by file ends in the state of the batch form."""

from __future__ import annotations

import json
import os

from corpus import events
from pyspark.sql import functions as F

from freightloom.operators import live
from freightloom.sources.events import read_events, route
from freightloom.streaming import live as stream


def _feed(spark, folder):
    """The transport events in four files, each event twice over."""
    listed = events()["tms"]
    folder.mkdir()
    for i in range(4):
        lines = [json.dumps(e) for e in listed[i::4]] * 2
        (folder / f"{i}.json").write_text("\n".join(lines), encoding="utf-8")
    batch = read_events(spark, str(folder), multi_line=False).drop("_corrupt_record").persist()
    return stream.read_event_stream(spark, str(folder), multi_line=False, files_per_trigger=1), batch


def _rows(df, *columns):
    return sorted(map(str, df.select(*columns).collect()))


def test_streams_equal_batch(spark, tmp_path):
    source, batch = _feed(spark, tmp_path / "tms")
    started, positions, delivered = (route(batch, t) for t in ("TransportStarted", "ShipmentPositionUpdated", "DeliveryCompleted"))
    flat = source.select(
        "shipment_identifier", "event_type", "delivery_status", F.col("timestamp").cast("timestamp_ntz").alias("event_timestamp"),
        F.col("container_temperature").cast("decimal(5,2)").alias("container_temperature"),
    )
    updates = stream.run(stream.stream_shipment_status(flat), "status")
    assert updates.select("batch").distinct().count() > 1
    columns = ("shipment_identifier", "status", "updated_at", "expires_at")
    assert _rows(stream.current_status(updates), *columns) == _rows(live.shipment_status(started, delivered), *columns)

    moving = route(source, "ShipmentPositionUpdated")
    fields = ["latitude", "longitude", "container_temperature", "speed_kmh"]
    latest = stream.latest_of_updates(stream.run(stream.stream_latest_position(moving), "position"), "shipment_identifier", fields)
    columns = ("shipment_identifier", "updated_at", *fields)
    assert _rows(latest, *columns) == _rows(live.latest_position(positions), *columns)

    points = stream.settled(stream.run(stream.stream_route_points(moving), "points", "append", stream.POINT_KEYS), stream.POINT_KEYS)
    assert _rows(points, "shipment_identifier", "member") == _rows(live.route_members(positions), "shipment_identifier", "member")

    totals = stream.counter_totals(stream.run(stream.stream_counters(flat), "counters")).filter("counter LIKE 'deliveries%'")
    assert _rows(totals, "counter", "value") == _rows(live.delivery_counters(delivered), "counter", "value")


def test_files_in_descending_order_of_time_lose_nothing(spark, tmp_path):
    folder = tmp_path / "late"
    folder.mkdir()
    lines = []
    for day in (20, 12, 5, 1):
        ship = f"S{day}"
        at = f"2026-03-{day:02d}T08:00:00"
        place = {"latitude": 1.5, "longitude": 2.5}
        lines.append([
            {"event_type": "TransportStarted", "timestamp": at, "shipment_identifier": ship, "source_node": "A", "target_node": "B", "transport_mode": "TRUCK"},
            {"event_type": "ShipmentPositionUpdated", "timestamp": at, "shipment_identifier": ship, "coordinates": place, "container_temperature": 22.0, "speed_kmh": 9.0},
            {"event_type": "ShipmentPositionUpdated", "timestamp": at, "shipment_identifier": "ALL", "coordinates": place, "container_temperature": 3.0 + day, "speed_kmh": 9.0},
            {"event_type": "DeliveryCompleted", "timestamp": f"2026-03-{day:02d}T20:00:00", "shipment_identifier": ship, "delivery_status": "SUCCESSFUL"},
        ])
    for i, events_of_day in enumerate(lines):
        (folder / f"{i}.json").write_text("\n".join(map(json.dumps, events_of_day)), encoding="utf-8")
        os.utime(folder / f"{i}.json", (1_700_000_000 + i, 1_700_000_000 + i))
    batch = read_events(spark, str(folder), multi_line=False).drop("_corrupt_record").persist()
    started, positions, delivered = (route(batch, t) for t in ("TransportStarted", "ShipmentPositionUpdated", "DeliveryCompleted"))

    def source():
        return stream.read_event_stream(spark, str(folder), multi_line=False, files_per_trigger=1)

    def flat():
        return source().select(
            "shipment_identifier", "event_type", "delivery_status", F.col("timestamp").cast("timestamp_ntz").alias("event_timestamp"),
            F.col("container_temperature").cast("decimal(5,2)").alias("container_temperature"),
        )

    def moving():
        return route(source(), "ShipmentPositionUpdated")

    fields = ["latitude", "longitude", "container_temperature", "speed_kmh"]
    key = "shipment_identifier"
    latest = stream.latest_of_updates(stream.run(stream.stream_latest_position(moving()), "position"), key, fields)
    assert _rows(latest, key, "updated_at", *fields) == _rows(live.latest_position(positions), key, "updated_at", *fields)
    status = stream.current_status(stream.run(stream.stream_shipment_status(flat()), "status"))
    assert _rows(status, key, "status") == _rows(live.shipment_status(started, delivered), key, "status")
    alerts = stream.latest_of_updates(stream.run(stream.stream_temperature_alerts(moving()), "alerts"), key, [])
    assert _rows(alerts, key, "updated_at") == _rows(live.temperature_alerts(positions), key, "updated_at")
    points = stream.settled(stream.run(stream.stream_route_points(moving()), "points", "append", stream.POINT_KEYS), stream.POINT_KEYS)
    assert _rows(points, key, "member") == _rows(live.route_members(positions), key, "member")
    breaches = stream.settled(stream.run(stream.stream_violations(moving()), "violations", "append", stream.VIOLATION_KEYS), stream.VIOLATION_KEYS)
    assert _rows(breaches, "day", "member") == _rows(live.violation_ranking(positions), "day", "member")
    totals = {r.counter: r.value for r in stream.counter_totals(stream.run(stream.stream_counters(flat()), "counters")).collect()}
    assert totals == {"started": 4, "deliveries_successful": 4, "temperature_alerts": live.alert_counter(positions).first()[0]}
    active = stream.active_from(stream.run(stream.stream_changes(flat()), "changes", "append"))
    assert active.first() == live.active_shipments(started, delivered).first()
