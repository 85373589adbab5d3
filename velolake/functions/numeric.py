"""Two-decimal metrics as whole hundredths.

Sums of whole hundredths do not depend on the order of addition, so a mean is the
same for every partitioning, and rounding needs no decimal arithmetic per row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def integer_div(dividend: Column, divisor: Column) -> Column:
    return F.call_function("div", dividend, divisor)


def to_hundredths(metric: Column) -> Column:
    """Whole hundredths of a value that was already rounded to two decimals."""
    return F.rint(metric * 100.0).cast("bigint")


def from_hundredths(hundredths: Column) -> Column:
    return hundredths / F.lit(100.0)


def mean_from_hundredths(total: Column, count: Column) -> Column:
    """Mean rounded to two decimals, half away from zero; NULL when nothing was counted."""
    counted = F.nullif(count, F.lit(0).cast("bigint"))
    rounded = integer_div(2 * F.abs(total) + counted, 2 * counted)
    return from_hundredths(F.when(total < 0, -rounded).otherwise(rounded))
