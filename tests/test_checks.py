"""Some checked queries against their SQL; ``python tests/compare.py <folder>`` runs all."""

from __future__ import annotations

from pathlib import Path

import pytest
from compare import compare, duck

from __spark_entry__ import entry, oracle_sql, queries

FOLDER = "/root/testdata/sf0.001"
SOME = [
    "RPT-6_customer_volume", "RPT-12_carrier_delay", "SNK-2_upsert_last", "OPS-5_node_processings", "KPI-1_carrier_performance",
    "MDM-4_resolve_fuzzy", "DQ-ALL_audit", "VAL-2_split_summary", "DOC-1_shipment_lifecycle", "DOC-3_batch_tracking", "MAN-4_quality_certificates",
    "MAN-5_by_type", "GR-8_edge_counts", "GR-9_shortest_path", "GR-11_chain_summary", "LIV-6_violation_ranking", "LIV-7_active_shipments",
]

pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="check tables are not here")


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


@pytest.mark.parametrize("name", SOME)
def test_query(spark, con, name):
    assert compare(queries()[name](spark, FOLDER), con, oracle_sql()[name]) is None


def test_entry(spark):
    assert entry(spark).count() > 0


def test_every_oracle_has_its_query():
    assert set(oracle_sql()) <= set(queries())
