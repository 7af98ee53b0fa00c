"""Near duplicates by SimHash and multi-index hashing.

A fingerprint of 64 bits is cut into two segments. Two fingerprints within
three bits differ by at most one bit in one of them, so each fingerprint is
entered under both its segments and looks up the Hamming ball of radius one
around each. Of two neighbours in a ball only the one with the zero bit asks.
Whole distances are verified in the join.

Equal fingerprints are one node, however many documents carry them. Components
are found by alternating large-star and small-star steps, which never hold
more edges than there are links.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

from freightloom.llm.common import digest_of, field_of, keep_rows, slices, staged, text_of

WIDTH = 3
SEED = 42
MAX_BITS = 3
SEGMENT = 32
#: Shingles whose bits are unpacked at once.
CHUNK = 1 << 16


def fingerprint(text: bytes, width: int = WIDTH, seed: int = SEED) -> int:
    """SimHash of the shingles of an ASCII-lowered text, as a signed 64-bit number; 0 without words."""
    words = text.lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words)] if len(words) < width else list(map(b" ".join, zip(*(words[i:] for i in range(width)))))
    hashes = np.array(list(map(xxhash.xxh64_intdigest, shingles, repeat(seed))), dtype=np.uint64)
    ones = np.zeros(64, dtype=np.int64)
    for start in range(0, len(hashes), CHUNK):
        part = hashes[start : start + CHUNK].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int32)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", width: int = WIDTH, seed: int = SEED) -> DataFrame:
    """``id, digest, fp`` of each document; null counts as the empty text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                fps = [fingerprint(text, width, seed) for text in part.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(fps, pa.int64())], ["id", "digest", "fp"])

    source = docs.select(F.col(id_column).alias("id"), digest_of(text_column).alias("digest"), text_of(text_column).cast("binary").alias("text"))
    return source.mapInArrow(run, StructType([field_of(source, "id"), StructField("digest", BinaryType()), StructField("fp", LongType())]))


def links(fps: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Pairs ``u < v`` of distinct fingerprints within ``max_bits`` bits; every such pair, perhaps more than once.

    Complete for up to three bits: two segments, radius one.
    """
    if not 0 <= max_bits <= 3:
        raise ValueError("two segments with balls of radius one reach three bits")
    mask = (1 << SEGMENT) - 1
    segments = F.explode(
        F.array(
            F.struct(F.lit(0).alias("s"), F.col("fp").bitwiseAND(F.lit(mask)).alias("part")),
            F.struct(F.lit(1).alias("s"), F.shiftrightunsigned("fp", SEGMENT).alias("part")),
        )
    )
    entries = fps.select("fp", segments.alias("e")).select(F.col("e.s").alias("s"), F.col("e.part").alias("part"), "fp")
    bits = F.array(*[F.lit(1 << b) for b in range(SEGMENT)])
    ball = F.transform(F.filter(bits, lambda b: F.col("part").bitwiseAND(b) == 0), lambda b: F.col("part").bitwiseOR(b))
    probes = entries.select("s", F.explode(F.concat(F.array("part"), ball)).alias("key"), F.col("fp").alias("a"), F.col("part").alias("own"))
    entries = entries.select("s", F.col("part").alias("key"), F.col("fp").alias("b"))
    near = (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits) & ((F.col("own") != probes["key"]) | (F.col("a") < F.col("b")))
    pairs = probes.join(entries, (probes["s"] == entries["s"]) & (probes["key"] == entries["key"]) & near)
    return pairs.select(F.least("a", "b").alias("u"), F.greatest("a", "b").alias("v"))


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` of every node with an edge; the root is the smallest node of its component.

    Runs until a round changes nothing. Each round is written to the shared
    folder, so a lost executor costs one round at most.
    """
    edges = staged(edges.filter("u < v").distinct(), "links")
    before = _state(edges)
    while before[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("m").alias("u"), "v").filter("u < v").distinct()
        lowest = large.groupBy("v").agg(F.min("u").alias("m"))
        small = large.join(lowest, "v").filter("u <> m").select(F.col("m").alias("u"), F.col("u").alias("v"))
        small = small.unionByName(lowest.select(F.col("m").alias("u"), "v")).distinct()
        edges = staged(small, "stars")
        after = _state(edges)
        if after == before:
            break
        before = after
    roots = edges.select(F.col("v").alias("node"), F.col("u").alias("root"))
    return roots.unionByName(edges.select(F.col("u").alias("node"), F.col("u").alias("root")).distinct())


def near_duplicates(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", width: int = WIDTH, max_bits: int = MAX_BITS, seed: int = SEED
) -> DataFrame:
    """One row per document: ``id, digest, fp, component_id, kept``.

    ``component_id`` is the smallest id that links reach. A text without words
    has the fingerprint zero, which links like any other; null counts as such
    a text. Null ids are never the smallest unless a component has no other.
    One (id, text) of each component is kept, the one with the smallest id
    (of several texts under one id, that with the smallest digest); rows equal
    in both are all marked, and ``drop_near_duplicates`` leaves one of them.
    Other columns are ignored; an empty table gives no rows.
    """
    rows = staged(fingerprints(docs, id_column, text_column, width, seed), "fingerprints")
    first = F.struct(F.col("id").isNull().alias("none"), F.col("id").alias("id"), F.col("digest").alias("digest"))
    nodes = staged(rows.groupBy("fp").agg(F.min(first).alias("first")), "nodes")
    found = components(links(nodes.select("fp"), max_bits)).select(F.col("node").alias("fp"), "root")
    grouped = nodes.join(found, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    lowest = grouped.groupBy("root").agg(F.min("first").alias("lead"))
    leads = grouped.join(lowest, "root").select("fp", "lead")
    kept = F.col("id").eqNullSafe(F.col("lead.id")) & (F.col("digest") == F.col("lead.digest"))
    return rows.join(leads, "fp").select("id", "digest", "fp", F.col("lead.id").alias("component_id"), kept.alias("kept"))


def drop_near_duplicates(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", width: int = WIDTH, max_bits: int = MAX_BITS
) -> DataFrame:
    """The documents with one of each component, the one with the smallest id."""
    kept = near_duplicates(docs, id_column, text_column, width, max_bits).filter("kept").select("id", "digest")
    return keep_rows(docs, kept, id_column, text_column)
