"""Write semantics on immutable tables: what to append, what to replace."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from freightloom.operators.skew import first_per_key, matched

#: Hash buckets used to number keys; each is ordered by its own task.
KEY_BUCKETS = 4096


def insert_ignore(
    new: DataFrame,
    target: DataFrame | None,
    keys: list[str],
    order: list[Column | str] = (),
) -> DataFrame:
    """Rows to append so that the first row per key stays."""
    first = first_per_key(new, keys, list(order))
    return first if target is None else matched(first, target, {k: k for k in keys}, keep=False)


def upsert_last(
    new: DataFrame,
    target: DataFrame | None,
    keys: list[str],
    order: list[str],
) -> DataFrame:
    """The whole new table: the last row per key in load order wins.

    ``order`` names columns of ``new``; the target's rows count as older
    than any of them.
    """
    tagged = new.withColumn("_age", F.lit(1))
    if target is not None:
        tagged = target.withColumn("_age", F.lit(0)).unionByName(tagged, allowMissingColumns=True)
    newest = [F.col("_age").desc()] + [F.col(c).desc_nulls_last() for c in order]
    last = first_per_key(tagged, keys, newest).drop("_age")
    return last if target is None else last.select(*target.columns)


def insert_missing(new: DataFrame, target: DataFrame | None, keys: list[str], position: str) -> DataFrame:
    """First row per key by position that the target lacks."""
    return insert_ignore(new, target, keys, [position])


def fill_missing(df: DataFrame, lookup: DataFrame, on: dict[str, str], column: str) -> DataFrame:
    """Fill NULLs of one column from a lookup with unique keys; other values stay."""
    renamed = lookup.select(
        *[F.col(r).alias(f"_ref_{i}") for i, r in enumerate(on.values())], F.col(column).alias("_fill")
    )
    condition = F.lit(True)
    for i, left in enumerate(on):
        condition = condition & (df[left] == renamed[f"_ref_{i}"])
    joined = df.join(renamed, condition, "left").withColumn(column, F.coalesce(df[column], F.col("_fill")))
    return joined.select(*df.columns)


def add_to_set(new: DataFrame, present: DataFrame | None) -> DataFrame:
    """Elements to add to embedded sets, kept as rows of (owner, element).

    Whole rows are the key, missing values included.
    """
    return new.distinct() if present is None else new.subtract(present.select(*new.columns))


def split_unresolved(
    df: DataFrame, ref: DataFrame, on: dict[str, str], reason: str
) -> tuple[DataFrame, DataFrame]:
    """Rows with a partner in ``ref``, and the others with the reason."""
    return (
        matched(df, ref, on, keep=True),
        matched(df, ref, on, keep=False).withColumn("reason", F.lit(reason)),
    )


def reject_counts(*rejects: DataFrame) -> DataFrame:
    """Skipped rows by reason over any number of reject relations."""
    reasons = [r.select("reason") for r in rejects]
    union = reasons[0]
    for r in reasons[1:]:
        union = union.unionByName(r)
    return union.groupBy("reason").agg(F.count("*").alias("skipped"))


def load_statistics(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows per written table."""
    union = None
    for name, df in tables.items():
        one = df.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        union = one if union is None else union.unionByName(one)
    return union


def assign_keys(
    new: DataFrame,
    key: str,
    id_column: str,
    existing: DataFrame | None = None,
    buckets: int = KEY_BUCKETS,
) -> DataFrame:
    """Number rows with unique keys densely, continuing after ``existing``.

    Keys are hashed into buckets; each bucket is numbered by itself and
    shifted by the size of the buckets before it. The only ungrouped window
    runs over the bucket sizes. The numbers depend on the set of keys alone,
    so a task that is run again gives the same ones.
    """
    bucketed = new.withColumn("_bucket", F.pmod(F.xxhash64(F.col(key)), F.lit(buckets)).cast("int"))
    sizes = bucketed.groupBy("_bucket").agg(F.count("*").alias("_size"))
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_bucket", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"))
    within = Window.partitionBy("_bucket").orderBy(key)
    numbered = bucketed.withColumn("_number", F.row_number().over(within)).join(
        F.broadcast(offsets), "_bucket"  # one row per bucket, so never more than `buckets`
    )
    number = F.col("_offset") + F.col("_number")
    if existing is not None:
        last = existing.agg(F.coalesce(F.max(id_column), F.lit(0)).alias("_last"))
        numbered = numbered.crossJoin(last)  # one row
        number = number + F.col("_last")
    return numbered.select(number.cast("long").alias(id_column), *new.columns)


def full_refresh(df: DataFrame, path: str, partition_by: list[str] = ()) -> None:
    """Replace a table by its new content."""
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def append(df: DataFrame, path: str, partition_by: list[str] = ()) -> None:
    """Append rows, as chosen by ``insert_ignore``."""
    df.write.mode("append").partitionBy(*partition_by).parquet(path)


def write_version(df: DataFrame, base: str, version: int) -> str:
    """Write an upserted table beside the version it was read from."""
    path = f"{base.rstrip('/')}/v={version:06d}"
    df.write.mode("errorifexists").parquet(path)
    return path
