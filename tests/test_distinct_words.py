"""Distinct counts by words of 64 ids."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import functions as F

from tillbook.operators import distinct_in_words, id_words, merged_words
from tillbook.plans import marts

IDS = [None, 0, 1, -1, 63, 64, -64, -65, 32768, -32768, 2**63 - 1, -(2**63 - 1), -(2**63), 2**63, 10**37, -(10**37)]


def _counts(parts, *keys):
    merged = merged_words(parts, keys)
    return {tuple(row[:-1]): row[-1] for row in merged.groupBy(*keys).agg(distinct_in_words().alias("n")).collect()}


def test_odd_ids_are_counted_once(spark):
    rows = [(day, None if i is None else Decimal(i)) for day in ("a", "b", None) for i in IDS * 2] + [("nulls", None)]
    df = spark.createDataFrame(rows, "day string, id decimal(38,0)").repartition(7)
    parts = id_words(df, ["day"], "id").union(id_words(df.filter("day = 'a'"), ["day"], "id"))
    distinct = len(IDS) - 1
    assert _counts(parts, "day") == {("a",): distinct, ("b",): distinct, (None,): distinct, ("nulls",): 0}
    assert _counts(parts) == {(): distinct}


def test_no_rows(spark):
    parts = id_words(spark.createDataFrame([], "day string, id long"), ["day"], "id")
    assert _counts(parts, "day") == {}
    assert _counts(parts) == {(): 0}


def test_dense_and_thin_days(spark):
    day = F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id") % 50)
    df = spark.range(0, 200_000, 1, 4).withColumn("day", day).select("day", (F.col("id") % 60_000).alias("id"))
    parts = id_words(df, ["day"], "id")
    expected = {(r[0],): r[1] for r in df.groupBy("day").agg(F.count_distinct("id")).collect()}
    assert _counts(parts, "day") == expected
    assert parts.filter("day = -1").count() <= 60_000 // 64 + 1  # all ids of the hot day


def test_stored_days_of_thin_ids_take_short_rows_in_hash_maps(spark):
    sales = spark.range(20_000).select(
        F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 100).cast("int")).alias("order_date"),
        (F.col("id") * 40_000).cast("decimal(38,0)").alias("order_id"),
        F.lit(1).cast("decimal(12,2)").alias("line_revenue"),
    )
    parts = marts.daily_parts(sales)
    assert "binary" not in dict(parts.dtypes).values()  # 4 KB for each id before
    for df in (parts, marts.daily_revenue_of_parts(parts)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "SortAggregate" not in plan and "HashAggregate" in plan
    assert {tuple(row)[1:] for row in marts.daily_revenue_of_parts(parts).collect()} == {(200, 200)}
