"""Fixed values of the supply-chain model.

Everything in this module is a fixed value: codes, names, ranges and texts
that results must carry exactly as given.
"""

from __future__ import annotations

from decimal import Decimal

# --- supply-chain nodes: code, name, type, region, sequence -----------------
NODES = [
    ("BANANA_PLANTATION", "Banana Plantation", "PLANTATION", "Africa", 1),
    ("COLLECTION_CENTER", "Collection Center", "COLLECTION_CENTER", "Africa", 2),
    ("QUALITY_CONTROL", "Quality Control", "QUALITY_CONTROL", "Africa", 3),
    ("AFRICA_COLD_STORAGE", "Africa Cold Storage", "COLD_STORAGE", "Africa", 4),
    ("EUROPE_COLD_STORAGE", "Europe Cold Storage", "COLD_STORAGE", "Europe", 5),
    ("CENTRAL_WAREHOUSE", "Central Warehouse", "WAREHOUSE", "Europe", 6),
    ("RETAIL_STORE", "Retail Store", "RETAIL", "Europe", 7),
]

# --- names of the same nodes in the graph ------------------------------------
GRAPH_NODE_NAMES = {
    "BANANA_PLANTATION": "Banana Plantation Ghana",
    "COLLECTION_CENTER": "Collection Center Ghana",
    "QUALITY_CONTROL": "Quality Control Station",
    "AFRICA_COLD_STORAGE": "Africa Cold Storage Accra",
    "EUROPE_COLD_STORAGE": "Europe Cold Storage Hamburg",
    "CENTRAL_WAREHOUSE": "Central Warehouse Germany",
    "RETAIL_STORE": "Retail Store",
}

# --- hops: source, target, transport mode, typical hours ---------------------
TOPOLOGY = [
    ("BANANA_PLANTATION", "COLLECTION_CENTER", "TRUCK", 4),
    ("COLLECTION_CENTER", "QUALITY_CONTROL", "TRUCK", 2),
    ("QUALITY_CONTROL", "AFRICA_COLD_STORAGE", "TRUCK", 6),
    ("AFRICA_COLD_STORAGE", "EUROPE_COLD_STORAGE", "SEA_FREIGHT", 240),
    ("EUROPE_COLD_STORAGE", "CENTRAL_WAREHOUSE", "TRUCK", 8),
    ("CENTRAL_WAREHOUSE", "RETAIL_STORE", "TRUCK", 3),
]

# --- carrier, transport mode, node type it serves -----------------------------
CARRIER_NODE_TYPES = [
    ("CAR-101", "TRUCK", "PLANTATION"),
    ("CAR-101", "TRUCK", "COLLECTION_CENTER"),
    ("CAR-101", "TRUCK", "QUALITY_CONTROL"),
    ("CAR-101", "TRUCK", "WAREHOUSE"),
    ("CAR-101", "TRUCK", "RETAIL"),
    ("CAR-102", "SEA_FREIGHT", "COLD_STORAGE"),
    ("CAR-103", "SEA_FREIGHT", "COLD_STORAGE"),
    ("CAR-104", "SEA_FREIGHT", "COLD_STORAGE"),
]

# --- delivery statuses: code, name, successful, description -------------------
DELIVERY_STATUSES = [
    ("SUCCESSFUL", "Erfolgreich geliefert", True, "Ware pünktlich und vollständig beim Kunden angekommen"),
    ("DELAYED", "Verzögert geliefert", True, "Ware angekommen, aber mit Zeitverzögerung"),
    ("FAILED", "Lieferung fehlgeschlagen", False, "Ware nicht beim Kunden angekommen"),
    ("IN_TRANSIT", "Zwischenhop in Lieferkette", False, "Transportetappe ohne Endlieferung (Plantation -> ... -> RETAIL_STORE)"),
]

# --- master-data entity types: code, name, source schema ---------------------
ENTITY_TYPES = [
    ("PRODUCT", "Produkt", "erp"),
    ("SUPPLIER", "Lieferant", "erp"),
    ("CUSTOMER", "Kunde", "erp"),
    ("CARRIER", "Transportdienstleister", "tms"),
    ("SUPPLY_CHAIN_NODE", "Supply-Chain-Knoten", "wms"),
]

# --- allowed values -----------------------------------------------------------
PRIORITIES = ["HIGH", "NORMAL", "LOW"]
FINAL_STATUSES = ["SUCCESSFUL", "DELAYED", "FAILED"]
PROCESSING_STATUSES = ["COMPLETED", "PENDING", "FAILED"]
TRANSPORT_MODES = ["TRUCK", "SEA_FREIGHT"]
GOLDEN_STATUSES = ["ACTIVE", "DEPRECATED", "MERGED"]
SOURCE_SYSTEMS = ["ERP", "WMS", "TMS"]
DEFAULT_PRIORITY = "NORMAL"
ORIGIN_NODE = "BANANA_PLANTATION"
DESTINATION_NODE = "RETAIL_STORE"
QUALITY_NODE = "QUALITY_CONTROL"

# --- limits -------------------------------------------------------------------
COLD_CHAIN_MIN = Decimal("10.0")
COLD_CHAIN_MAX = Decimal("15.0")
PRICE_MIN = Decimal("1.50")
PRICE_MAX = Decimal("5.00")
MAX_DELAY_MINUTES = 180
LATE_MINUTES = 60
MAX_SPEED_KMH = 200
ORDER_QUANTITY_RANGE = (100, 1000)
STALE_ORDER_DAYS = 90
HOPS_PER_FULFILLMENT = 6

# --- product key format per source system -------------------------------------
KEY_PATTERNS = {
    "ERP": r"^BAN-\d{3}$",
    "WMS": r"^BAN_\d{3}$",
    "TMS": r"^ban-\d{3}$",
}

# --- time to live of live state, in seconds ------------------------------------
HOUR = 3600
DAY = 86400
TTL_SECONDS = {
    "shipment_status_in_transit": 7 * DAY,
    "shipment_status_final": 30 * DAY,
    "shipment_info": 7 * DAY,
    "shipment_position": HOUR,
    "shipment_route": 3 * DAY,
    "temperature_alert": DAY,
    "violation_ranking": 7 * DAY,
    "order": 30 * DAY,
    "product_cache": HOUR,
    "lifecycle_document": 90 * DAY,
}
