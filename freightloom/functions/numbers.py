"""Safe conversions, rounding on decimals and the range tests built on them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from freightloom.constants import COLD_CHAIN_MAX, COLD_CHAIN_MIN
from freightloom.functions.keys import _col


def safe_decimal(c: Column | str, precision: int, scale: int) -> Column:
    """Cast to a decimal, NULL where the text is no number or does not fit."""
    return _col(c).try_cast(f"decimal({precision},{scale})")


def safe_int(c: Column | str) -> Column:
    """Cast to an integer, NULL where the text is no integer."""
    return _col(c).try_cast("int")


def safe_double(c: Column | str) -> Column:
    """Cast to a double, NULL where the text is no number."""
    return _col(c).try_cast("double")


def exact(c: Column | str, scale: int = 2) -> Column:
    """Wide decimal, so that sums and averages do not depend on row order."""
    return _col(c).cast(f"decimal(28,{scale})")


def half_up(c: Column, scale: int, precision: int = 18) -> Column:
    """Round half up and give the result a declared type."""
    return F.round(c, scale).cast(f"decimal({precision},{scale})")


def ratio(part: Column, whole: Column) -> Column:
    """Exact quotient of two counts or decimals; NULL when the divisor is zero."""
    return F.try_divide(part.cast("decimal(28,6)"), whole.cast("decimal(20,0)"))


def percentage(part: Column, whole: Column, scale: int = 1) -> Column:
    """``100 * part / whole`` rounded half up; NULL when ``whole`` is zero."""
    return half_up(ratio(part * F.lit(100), whole), scale, 9)


def mean(total: Column, count: Column, scale: int) -> Column:
    """Average from its two parts, rounded half up."""
    return half_up(ratio(total, count), scale)


def breaks_cold_chain(c: Column | str) -> Column:
    """Temperature outside the corridor; NULL stays NULL and counts as no breach."""
    return (_col(c) < F.lit(COLD_CHAIN_MIN)) | (_col(c) > F.lit(COLD_CHAIN_MAX))


def within_cold_chain(c: Column | str) -> Column:
    """Measured and inside the corridor; a missing value is not inside."""
    return F.coalesce(_col(c).between(F.lit(COLD_CHAIN_MIN), F.lit(COLD_CHAIN_MAX)), F.lit(False))


def count_where(condition: Column) -> Column:
    """Rows for which the condition is true, as one aggregate among others."""
    return F.count_if(condition)
