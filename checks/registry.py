"""Registry of checked queries: Spark callable, result columns, SQL text."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.adapter import VIEWS, Driver

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

# One letter per column says how both sides present it.
_SPARK = {
    "s": lambda c: c.cast("string"),
    "i": lambda c: c.cast("long"),
    "d": lambda c: c.cast("double"),
    "b": lambda c: c.cast("boolean"),
    "t": lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS"),
    "D": lambda c: F.date_format(c, "yyyy-MM-dd"),
}
_SQL = {
    "s": "CAST({0} AS VARCHAR)",
    "i": "CAST({0} AS BIGINT)",
    "d": "CAST({0} AS DOUBLE)",
    "b": "CAST({0} AS BOOLEAN)",
    "t": "strftime({0}, '%Y-%m-%d %H:%M:%S.%f')",
    "D": "strftime({0}, '%Y-%m-%d')",
}


def _columns(spec: str) -> list[tuple[str, str]]:
    return [tuple(item.rsplit(":", 1)) for item in spec.split()]


def present(df: DataFrame, spec: str) -> DataFrame:
    """Result in a form both engines write the same way."""
    return df.select(*[_SPARK[kind](F.col(name)).alias(name) for name, kind in _columns(spec)])


def _needed(text: str, found: list[str]) -> list[str]:
    for view in re.findall(r"\bv_\w+", text):
        if view not in found:
            _needed(VIEWS[view], found)
            found.append(view)
    return found


def sql(spec: str, body: str) -> str:
    """Body with the views it needs and the presentation of its columns."""
    views = _needed(body, [])
    head = "WITH " + ",\n".join(f"{v} AS ({VIEWS[v]})" for v in views) + "\n" if views else ""
    columns = ", ".join(_SQL[kind].format(name) + f" AS {name}" for name, kind in _columns(spec))
    return f"{head}SELECT {columns} FROM ({body}) AS result"


def add(name: str, spec: str, build: Callable[[Driver], DataFrame], body: str | None = None) -> None:
    """Register a query; without SQL only its rows are checked."""
    if name in QUERIES:
        raise ValueError(f"{name} is registered twice")

    def run(spark: SparkSession, folder: str) -> DataFrame:
        return present(build(Driver(spark, folder)), spec)

    QUERIES[name] = run
    if body is not None:
        ORACLES[name] = sql(spec, body)


# --- exact arithmetic in SQL -----------------------------------------------------------


def average(total: str, count: str, scale: int, scale_in: int = 0) -> str:
    """Half-up average of integers that carry ``scale_in`` decimals; not for negative totals."""
    factor = 10 ** (scale - scale_in)
    return f"CASE WHEN {count} > 0 THEN ((2 * {total} * {factor} + {count}) // (2 * {count})) / {float(10**scale)} END"


def percent(part: str, whole: str, scale: int = 1) -> str:
    """Half-up percentage of two counts."""
    return average(f"({part}) * 100", whole, scale)
