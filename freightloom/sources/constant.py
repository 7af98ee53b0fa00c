"""Inline constant relations."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession


def _literal(value: object) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return "TRUE" if value else "FALSE"
    if isinstance(value, (int, float)):
        return str(value)
    text = str(value).replace("\\", "\\\\").replace("'", "\\'")
    return f"'{text}'"


def constant(spark: SparkSession, rows: Iterable[tuple], schema: str) -> DataFrame:
    """Rows as a ``VALUES`` relation with ``name type, ...`` as schema.

    The optimizer knows the rows and their size, which it does not for rows
    handed over from Python: such a relation is folded or broadcast.
    """
    fields = [f.strip().split(" ", 1) for f in schema.split(",")]
    casts = ", ".join(f"CAST(`{n}` AS {t}) AS `{n}`" for n, t in fields)
    lines = ", ".join("(" + ", ".join(_literal(v) for v in row) + ")" for row in rows)
    if not lines:
        nulls = ", ".join(f"CAST(NULL AS {t}) AS `{n}`" for n, t in fields)
        return spark.sql(f"SELECT {nulls} WHERE FALSE")
    names = ", ".join(f"`{n}`" for n, _ in fields)
    return spark.sql(f"SELECT {casts} FROM VALUES {lines} AS t({names})")
