"""Counts of several tables, share of a grand total, moving average."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillbook.functions.rounding import rounded_quotient


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """``(tbl, rows)``: the number of rows of each table."""
    counts = (
        table.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("tbl"), "rows")
        for name, table in tables.items()
    )
    return reduce(DataFrame.unionByName, counts)


def share_of_total(df: DataFrame, value: str, out: str, digits: int = 1) -> DataFrame:
    """Percentage of the sum of ``value`` over all rows; the sum is a scalar subquery, rows stay where they are."""
    total = df.agg(F.sum(value)).scalar()
    if isinstance(df.schema[value].dataType, T.DecimalType):
        return df.withColumn(out, rounded_quotient(100 * F.col(value), total, digits))
    return df.withColumn(out, F.round(100 * F.col(value) / total, digits))


def moving_average(df: DataFrame, order: Sequence[Column], value: str, preceding: int, out: str) -> DataFrame:
    """Mean of ``value`` over the current and the ``preceding`` rows in front of it.

    The window has no partitions, so it runs in one task: give it a table whose size has a bound, such as one row
    per calendar day.
    """
    window = Window.orderBy(*order).rowsBetween(-preceding, Window.currentRow)
    if isinstance(df.schema[value].dataType, T.DecimalType):
        number = F.count(value).over(window).cast("decimal(20,0)")
        return df.withColumn(out, rounded_quotient(F.sum(value).over(window), number, 2))
    return df.withColumn(out, F.round(F.avg(value).over(window), 2))
