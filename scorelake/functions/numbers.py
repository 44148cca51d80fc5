"""Numeric expressions whose results must match the SQL they replace."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def round2(value: Column) -> Column:
    """Two decimals, rounding the scaled binary value: 1.005 gives 1.0, not 1.01."""
    return F.round(value * F.lit(100.0)) / F.lit(100.0)


def percentage(part: Column, whole: Column) -> Column:
    """``part`` as a percentage of ``whole``, two decimals; NULL when ``whole`` is 0."""
    return round2(F.try_divide(part * F.lit(100.0), whole))


def to_int(value: Column) -> Column:
    """Nearest integer, ties to even (80.5 gives 80, 81.5 gives 82); overflow raises."""
    return F.bround(value).cast("int")
