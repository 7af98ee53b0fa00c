"""Business keys and their spellings in the three source systems."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from freightloom.constants import KEY_PATTERNS

_BLANKS = " \t\n\r\f\x0b"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _stripped(c: Column | str) -> Column:
    return F.btrim(_col(c), F.lit(_BLANKS))


def match_key(c: Column | str) -> Column:
    """Spelling-neutral form used for matching: ``BAN_101`` becomes ``ban-101``."""
    return F.lower(F.replace(_stripped(c), F.lit("_"), F.lit("-")))


def normalize_key(c: Column | str) -> Column:
    """Canonical form: ``BAN_101`` and ``ban-101`` become ``BAN-101``."""
    return F.upper(match_key(c))


def wms_key(c: Column | str) -> Column:
    """Warehouse spelling of a canonical key."""
    return F.replace(_col(c), F.lit("-"), F.lit("_"))


def tms_key(c: Column | str) -> Column:
    """Transport spelling of a canonical key."""
    return F.lower(_col(c))


def key_format_ok(c: Column | str, system: str) -> Column:
    """Whether a product key has the format of its system; NULL is no match."""
    pattern = KEY_PATTERNS.get(system)
    if pattern is None:
        return F.lit(False)
    return F.coalesce(_col(c).rlike(pattern), F.lit(False))


def register_sql_functions(spark: SparkSession) -> None:
    """Make the two key functions callable from SQL text."""
    blanks = "' \\t\\n\\r\\f\\u000B'"
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION match_key(k STRING) RETURNS STRING "
        f"RETURN lower(replace(btrim(k, {blanks}), '_', '-'))"
    )
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION normalize_key(k STRING) RETURNS STRING "
        f"RETURN upper(replace(btrim(k, {blanks}), '_', '-'))"
    )
