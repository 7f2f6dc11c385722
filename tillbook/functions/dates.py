"""Calendar arithmetic."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def days_between(start: Column, end: Column) -> Column:
    """Whole days from ``start`` to ``end``, negative if ``end`` comes first."""
    return F.date_diff(end, start).cast("bigint")
