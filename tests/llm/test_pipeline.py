"""The stages on the small tables, each against a plain form on its own input; and the registered queries."""

from collections import defaultdict
from pathlib import Path

import pytest
from test_duplicates import brute_fingerprint, roots

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="check tables are not here")


def test_stages(spark):
    import corpus_pipeline as cp
    from freightloom.llm.decontaminate import words_of

    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns, read = docs.columns, []
    for name, stage in cp.STAGES:
        docs = cp.staged(stage(spark, docs, FOLDER), "test")
        read.append({r[0]: r for r in docs.collect()})
        if name != cp.STAGES[-1][0]:
            assert docs.columns == columns
    start = {r["doc_id"]: r for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    clean, single, far, free, coded = read

    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    assert len(clean) >= 0.8 * len(start) and all(clean[i] == start[i] for i in clean)
    assert sum(labels.get(i, 0) == 0 and i not in clean for i in start) <= 0.1 * len(start)

    best = {}
    for i, r in clean.items():
        best[r["text"]] = max(i, best.get(r["text"], i))
    assert set(single) == set(best.values())

    prints = {i: brute_fingerprint(r["text"]) for i, r in single.items()}
    nodes = set(prints.values())
    up, least = roots(nodes, [(a, b) for a in nodes for b in nodes if a < b and (a ^ b).bit_count() <= 3]), defaultdict(list)
    for i, p in prints.items():
        least[up[p]].append(i)
    assert set(far) == {min(v) for v in least.values()}

    items = [" ".join(words_of(r["text"])) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    holds = {i for i, r in far.items() if any(f" {item} " in f" {' '.join(words_of(r['text']))} " for item in items)}
    assert holds and not holds & set(free) and len(far) - len(free) <= len(holds) + 1

    assert set(coded) == set(free)
    import hashlib

    assert all(r["decoded_sha256"] == hashlib.sha256(free[i]["text"].encode()).hexdigest() for i, r in coded.items())


def test_queries_against_sql(spark):
    from compare import compare, duck

    from freightloom.llm.queries import ORACLES, QUERIES

    con = duck(FOLDER)
    for name, sql in ORACLES.items():
        assert compare(QUERIES[name](spark, FOLDER), con, sql) is None, name
