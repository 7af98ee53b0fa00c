"""Helpers that keep one hot key from ending up in one task.

A key may own a third of all rows. Rows are therefore reduced before they
are shuffled, and lists are built in parts that follow from their elements.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _orderable(df: DataFrame, skip: set[str]) -> list[str]:
    def ok(kind: T.DataType) -> bool:
        if isinstance(kind, T.MapType):
            return False
        if isinstance(kind, T.ArrayType):
            return ok(kind.elementType)
        if isinstance(kind, T.StructType):
            return all(ok(f.dataType) for f in kind.fields)
        return True

    return [f.name for f in df.schema.fields if f.name not in skip and ok(f.dataType)]


def first_per_key(df: DataFrame, keys: list[str], order: list[Column | str]) -> DataFrame:
    """The first row of each key; remaining columns break ties.

    Spark limits each key to its first row before the shuffle as well as
    after it, so a hot key sends one row per map task.
    """
    named = {c for c in order if isinstance(c, str)} | set(keys)
    ties = [F.col(c) for c in _orderable(df, named)]
    window = Window.partitionBy(*keys).orderBy(*[F.col(c) if isinstance(c, str) else c for c in order], *ties)
    return df.withColumn("_rank", F.row_number().over(window)).filter(F.col("_rank") == 1).drop("_rank")


def row_counts(df: DataFrame, keys: list[str], name: str = "rows") -> DataFrame:
    """Rows per key, partially counted before the shuffle."""
    return df.groupBy(*keys).agg(F.count("*").alias(name))


def bounded_lists(df: DataFrame, keys: list[str], element: Column, name: str, part: Column) -> DataFrame:
    """Sorted lists of ``element`` per key and part.

    ``part`` follows from the element alone (the day of an event, a range of
    positions or codes), so a list does not depend on how many rows there are,
    an addition touches the last part only, and the parts of a hot key lie in
    different tasks. Parts in order, one after the other, are the whole list in
    order if ``part`` rises with the element.
    """
    items = df.select(*keys, part.alias("part"), element.alias("_element"))
    return items.groupBy(*keys, "part").agg(F.sort_array(F.collect_list("_element")).alias(name))


def matched(df: DataFrame, ref: DataFrame, on: dict[str, str], keep: bool) -> DataFrame:
    """Rows of ``df`` with (``keep``) or without a partner in ``ref``."""
    keys = ref.select(*[F.col(r).alias(f"_ref_{i}") for i, r in enumerate(on.values())])
    condition = F.lit(True)
    for i, left in enumerate(on):
        condition = condition & (df[left] == keys[f"_ref_{i}"])
    return df.join(keys, condition, "left_semi" if keep else "left_anti")


def orphan_keys(child: DataFrame, parent: DataFrame, on: dict[str, str]) -> DataFrame:
    """Distinct child keys without parent and the rows each stands for.

    Counting per key first means the join sees each key once, whatever
    share of the rows it owns.
    """
    return matched(row_counts(child, list(on), "rows"), parent, on, keep=False)


def orphan_count(child: DataFrame, parent: DataFrame, on: dict[str, str], name: str = "orphans") -> DataFrame:
    """One row: number of child rows without parent."""
    return orphan_keys(child, parent, on).agg(F.coalesce(F.sum("rows"), F.lit(0)).cast("long").alias(name))
