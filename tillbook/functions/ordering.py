"""Sort orders in which NULL counts as the largest value: last going up, first going down."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ASC, DESC = "asc", "desc"

# A sort key by name, for operators that look at the column's type: ("revenue", DESC).
SortKey = tuple[str, str]


def ascending(column: Column | str) -> Column:
    return F.asc_nulls_last(column)


def descending(column: Column | str) -> Column:
    return F.desc_nulls_first(column)


def directed(column: Column | str, direction: str) -> Column:
    return {ASC: ascending, DESC: descending}[direction](column)
