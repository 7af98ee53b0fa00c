"""Exact duplicates with a split of heavy hitters.

Each task keeps a Misra-Gries summary of the digests it sees. The merged
summaries name every digest that may hold more than ``2 / (k + 1)`` of all
rows, and never more than ``k`` of them. Their groups are then counted exactly
over all rows; the winners so verified are broadcast, and the rows of hot
digests are settled where they lie. All other digests take the ordinary
shuffle, in which no group is large against the whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from freightloom.llm.common import digest_of, keep_rows, staged

#: Counters of a summary, hence the most winners that are ever broadcast.
COUNTERS = 1024


def add_counts(counters: dict[bytes, int], more: Iterator[tuple[bytes, int]], k: int) -> dict[bytes, int]:
    """Misra-Gries step: add, then take the (k+1)-th largest count off all."""
    for digest, n in more:
        counters[digest] = counters.get(digest, 0) + n
    if len(counters) <= k:
        return counters
    cut = sorted(counters.values(), reverse=True)[k]
    return {digest: n - cut for digest, n in counters.items() if n > cut}


def _summaries(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counters: dict[bytes, int] = {}
        for batch in batches:
            counts = batch.column(0).value_counts()
            counters = add_counts(counters, zip(counts.field(0).to_pylist(), counts.field(1).to_pylist()), k)
        yield pa.RecordBatch.from_arrays([pa.array(list(counters), pa.binary()), pa.array(list(counters.values()), pa.int64())], ["digest", "counter"])

    return run


def frequent_digests(rows: DataFrame, k: int = COUNTERS) -> DataFrame:
    """Digests whose merged counter exceeds ``n / (k + 1)``: at most ``k`` rows.

    A merged counter never exceeds the true count and falls short of it by
    ``n / (k + 1)`` at most, so every digest with more than ``2n / (k + 1)``
    rows is among them.
    """
    n = rows.count()
    merged = rows.select("digest").mapInArrow(_summaries(k), "digest binary, counter long").groupBy("digest").agg(F.sum("counter").alias("counter"))
    return merged.filter(F.col("counter") * (k + 1) > n).select("digest")


def exact_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", k: int = COUNTERS) -> DataFrame:
    """One row per document: ``id, digest, keep_id, group_size, kept``.

    Texts are equal when their UTF-8 bytes are (by SHA-256); null counts as
    the empty text. Of equal texts the row with the largest id stays. A null
    id is smaller than any other. Of rows that share id and text exactly one
    is kept. Other columns are ignored; an empty table gives no rows.
    """
    source = docs.select(F.col(id_column).alias("id"), digest_of(text_column).alias("digest"))
    rows = staged(source.withColumn("row", F.monotonically_increasing_id()), "digests")
    winner, size = F.max(F.struct("id", "row")).alias("winner"), F.count(F.lit(1)).alias("group_size")

    hot = rows.join(F.broadcast(frequent_digests(rows, k)), "digest").groupBy("digest").agg(winner, size)
    hot = staged(hot, "winners")  # at most k rows
    tagged = rows.join(F.broadcast(hot), "digest", "left")
    settled = tagged.filter("winner IS NOT NULL")

    rest = rows.join(F.broadcast(hot), "digest", "left_anti")
    ordinary = rest.join(rest.groupBy("digest").agg(winner, size), "digest")
    return settled.unionByName(ordinary).select(
        "id", "digest", F.col("winner.id").alias("keep_id"), "group_size", (F.col("row") == F.col("winner.row")).alias("kept")
    )


def drop_exact_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", k: int = COUNTERS) -> DataFrame:
    """The documents without exact copies; the one with the largest id of each group stays."""
    kept = exact_duplicates(docs, id_column, text_column, k).filter("kept").select("id", "digest")
    return keep_rows(docs, kept, id_column, text_column)
