"""A small event corpus with results that are easy to work out by hand.

Two suppliers, two customers, three products, three orders, three batches.
Each batch passes the six stations and travels the six hops; hop ``h`` of
batch ``b`` is late by ``10 * b`` minutes and measures ``10 + h / 2`` degrees.
The last hop is delivered: batch 0 on time, batch 1 delayed, batch 2 failed.
"""

from __future__ import annotations

import json
from datetime import datetime, timedelta
from pathlib import Path

from freightloom.constants import NODES, TOPOLOGY

START = datetime(2026, 3, 1, 8, 0, 0, 123456)
# key spellings planted in the events of product 101, 102, 103
SPELLINGS = ["BAN-101", "BAN_102", " ban-103 "]


def _at(minutes: float) -> str:
    return (START + timedelta(minutes=minutes)).isoformat()


def events() -> dict[str, list[dict]]:
    erp: list[dict] = []
    wms: list[dict] = []
    tms: list[dict] = []
    for i, spelling in enumerate(SPELLINGS):
        erp.append({
            "event_type": "ProductCreated", "product_code": spelling, "product_name": f"Sort {i}", "category": "Fresh Fruit",
            "supplier_reference": ["SUP-1", "SUP-2", "SUP-MISSING"][i], "timestamp": _at(i),
        })
        code = f"BAN-{101 + i}"
        wms.append({"event_type": "WarehouseSKUCreated", "erp_product_code": code, "sku": code.replace("-", "_"), "timestamp": _at(i)})
        tms.append({
            "event_type": "TransportProductReferenceCreated", "erp_product_code": code,
            "transport_product_reference": code.lower(), "timestamp": _at(i),
        })
    for i in (1, 2):
        erp.append({"event_type": "SupplierCreated", "supplier_code": f"SUP-{i}", "supplier_name": f"Farm {i}", "country": "Ghana", "timestamp": _at(i)})
        erp.append({
            "event_type": "CustomerCreated", "customer_number": f"CUST-{i}", "customer_name": f"Shop {i}", "city": f"City {i}",
            "country": "Germany", "timestamp": _at(i),
        })
        tms.append({"event_type": "CarrierCreated", "carrier_id": f"CAR-10{i}", "carrier_name": f"Lines {i}", "timestamp": _at(i)})
    orders = [("ORD-A", "CUST-1", "HIGH", [(0, 10, 2.5)]), ("ORD-B", "CUST-2", None, [(1, 4, 3.0), (1, 9, 3.0), (2, 1, 1.5)]), ("ORD-C", "CUST-1", "LOW", [(0, 7, 2.0)])]
    for i, (ref, customer, priority, items) in enumerate(orders):
        event = {
            "event_type": "OrderCreated", "order_reference": ref, "customer": {"customer_number": customer, "customer_name": f"Shop {customer[-1]}"},
            "items": [{"product_code": SPELLINGS[p], "description": f"Sort {p}", "quantity": q, "unit_price": u} for p, q, u in items],
            "timestamp": _at(100 + i),
        }
        if priority:
            event["delivery_priority"] = priority
        erp.append(event)
    erp.append({"event_type": "OrderCreated", "order_reference": "ORD-LOST", "customer": {"customer_number": "CUST-9"}, "items": [], "timestamp": _at(110)})
    for b in range(3):
        erp.append({
            "event_type": "BatchHarvested", "batch_identifier": f"BATCH-{b}", "product_code": SPELLINGS[b], "origin_country": "Ghana",
            "quantity": 100, "supply_chain_node": "BANANA_PLANTATION", "wms_sku": f"BAN_{101 + b}", "tms_product_reference": f"ban-{101 + b}",
            "timestamp": _at(200 + b),
        })
        for h in range(6):
            wms.append({
                "event_type": "NodeProcessed", "supply_chain_node": NODES[h][0], "batch_reference": f"BATCH-{b}", "sku": f"BAN_{101 + b}",
                "temperature": 10 + h / 2, "status": "COMPLETED", "timestamp": _at(300 + 10 * h + b),
            })
            ship = f"SHIP-{b}-{h}-00001234"
            source, target, mode, hours = TOPOLOGY[h]
            begin = 1000 + 100 * h + b
            tms.append({
                "event_type": "TransportStarted", "shipment_identifier": ship, "source_node": source, "target_node": target, "transport_mode": mode,
                "cargo_product_reference": f"ban-{101 + b}", "carrier": {"carrier_id": "CAR-102" if mode == "SEA_FREIGHT" else "CAR-101", "carrier_name": "Lines"},
                "estimated_arrival": _at(begin + 60 * hours), "timestamp": _at(begin),
            })
            for k in range(2):
                tms.append({
                    "event_type": "ShipmentPositionUpdated", "shipment_identifier": ship, "cargo_product_reference": f"ban-{101 + b}",
                    "coordinates": {"latitude": 5.5 + h, "longitude": -0.25 * k}, "container_temperature": 16.5 if (b, h, k) == (1, 3, 1) else 12.25,
                    "speed_kmh": 50 + k, "timestamp": _at(begin + 10 + k),
                })
            tms.append({
                "event_type": "TransportCompleted", "shipment_identifier": ship, "cargo_product_reference": f"ban-{101 + b}", "arrival_node": target,
                "delay_minutes": 10 * b, "timestamp": _at(begin + 50),
            })
        final = {
            "event_type": "DeliveryCompleted", "shipment_identifier": f"SHIP-{b}-5-00001234", "cargo_product_reference": f"ban-{101 + b}",
            "delivery_status": ["SUCCESSFUL", "DELAYED", "FAILED"][b], "received_by": f"EMP-{b}", "supply_chain_node": "RETAIL_STORE", "timestamp": _at(1560 + b),
        }
        tms.append(final)
    tms.append({"event_type": "TransportCompleted", "shipment_identifier": "SHIP-LOST", "arrival_node": "X", "delay_minutes": 1, "timestamp": _at(5000)})
    return {"erp": erp, "wms": wms, "tms": tms}


def write(folder: Path, reverse: bool = False) -> None:
    """One pretty-printed file per event, and one file that is no JSON."""
    for system, listed in events().items():
        (folder / system).mkdir(parents=True, exist_ok=True)
        for i, event in enumerate(reversed(listed) if reverse else listed):
            (folder / system / f"{i:04d}_{event['event_type']}.json").write_text(json.dumps(event, indent=2), encoding="utf-8")
    (folder / "tms" / "9999_broken.json").write_text('{"event_type": "Transp', encoding="utf-8")
