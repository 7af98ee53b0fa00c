"""Token counts by source, language and tokenizer, kept up to date by signed changes.

A batch of changes is reduced to additive totals and written to a folder of its
own; the batch is committed by the marker that Spark writes last, and a batch
that is committed already is not applied again. Totals are the sum of the
committed batches. ``compact`` folds them into a base, which names the batches
it holds, so that nothing counts twice whatever is lost on the way.
"""

from __future__ import annotations

from urllib.parse import quote, unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

KEYS = ("source", "lang", "tokenizer")
TOTALS = "source string, lang string, tokenizer string, n_docs long, n_tokens long"


def deltas(changes: DataFrame) -> DataFrame:
    """Additive totals of signed changes.

    ``changes`` has the keys, ``op``, ``n_tokens`` and ``old_tokens``. An insert
    adds a document and its tokens, a delete takes both away, a revision adds
    ``n_tokens - old_tokens``; any other ``op`` is an error. A null count is 0;
    a null key is a group of its own. Repeated rows count each time.
    """
    n, old = F.coalesce(F.col("n_tokens"), F.lit(0)).cast("long"), F.coalesce(F.col("old_tokens"), F.lit(0)).cast("long")
    op = F.col("op")
    wrong = F.raise_error(F.concat(F.lit("unknown change: "), F.coalesce(op, F.lit("null")))).cast("long")
    docs = F.when(op == "insert", 1).when(op == "delete", -1).when(op == "revise", 0).otherwise(wrong)
    tokens = F.when(op == "insert", n).when(op == "delete", -n).when(op == "revise", n - old).otherwise(wrong)
    return changes.groupBy(*[F.col(k).cast("string").alias(k) for k in KEYS]).agg(F.sum(docs).alias("n_docs"), F.sum(tokens).alias("n_tokens"))


class Rollup:
    """Totals in a folder that all executors reach."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def _names(self, below: str) -> list[str]:
        """Sub-folders of ``below`` that carry the marker of a finished write."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{below}")
        files = path.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not files.exists(path):
            return []
        found = [s.getPath() for s in files.listStatus(path) if s.isDirectory()]
        done = self.spark._jvm.org.apache.hadoop.fs.Path
        return sorted(p.getName() for p in found if files.exists(done(p, "_SUCCESS")))

    def batches(self) -> list[str]:
        """Ids of the committed batches."""
        return [unquote(name[3:]) for name in self._names("deltas")]

    def commit(self, batch: str, changes: DataFrame) -> bool:
        """Apply a batch once; false if it is committed already."""
        if batch in self.batches() or batch in self._folded()[1]:
            return False
        deltas(changes).write.mode("overwrite").parquet(f"{self.folder}/deltas/id={quote(batch, safe='')}")
        return True

    def _folded(self) -> tuple[str | None, set[str]]:
        """The newest base and the batches it holds."""
        names = [n for n in self._names("held")]
        if not names:
            return None, set()
        held = self.spark.read.schema("batch string").parquet(f"{self.folder}/held/{names[-1]}")
        return names[-1], {r[0] for r in held.collect()}

    def totals(self) -> DataFrame:
        """``source, lang, tokenizer, n_docs, n_tokens``; groups in which nothing is left have no row."""
        base, held = self._folded()
        paths = [f"{self.folder}/deltas/id={quote(b, safe='')}" for b in self.batches() if b not in held]
        paths += [f"{self.folder}/base/{base}"] if base else []
        if not paths:
            return self.spark.createDataFrame([], TOTALS)
        rows = self.spark.read.schema(TOTALS).parquet(*paths)
        summed = rows.groupBy(*KEYS).agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))
        return summed.filter("n_docs <> 0 OR n_tokens <> 0")

    def compact(self) -> None:
        """Fold all committed batches into a new base; it counts from when its list of batches is written."""
        base, held = self._folded()
        now = sorted(held | set(self.batches()))
        name = f"base-{int(base[5:]) + 1 if base else 0:09d}"
        self.totals().write.mode("overwrite").parquet(f"{self.folder}/base/{name}")
        self.spark.createDataFrame([(b,) for b in now], "batch string").coalesce(1).write.mode("overwrite").parquet(f"{self.folder}/held/{name}")
