"""Findings of round 3."""

from __future__ import annotations

from pyspark.sql import functions as F

from tests import sample
from tillbook.operators import latest_per_key
from tillbook.plans import staging


def test_dealt_rows_give_the_same_choice_and_no_task_sorts_a_whole_split(spark):
    key, value = F.when(F.col("id") % 3 > 0, F.col("id") % 50).otherwise(7), F.when(F.col("id") % 5 > 0, F.col("id") % 11)
    rows = spark.range(0, 3000, 1, 4).select(F.nullif(key, F.lit(9)).alias("key"), value.alias("a"), (F.col("id") % 13).alias("b"))
    plain = latest_per_key(rows.union(rows), ["key"], [F.desc_nulls_last("a")])
    dealt = latest_per_key(rows.union(rows), ["key"], [F.desc_nulls_last("a")], tasks=5)
    plan = dealt._jdf.queryExecution().executedPlan().toString()
    first_shuffle = plan[plan.rindex("Exchange hashpartitioning") :]
    assert "Sort" not in first_shuffle and "WindowGroupLimit" not in first_shuffle
    assert plan.count("Exchange hashpartitioning") == 2
    assert sample.bag(dealt) == sample.bag(plain)


def test_tasks_follow_the_rows(spark):
    fewest = spark.sparkContext.defaultParallelism
    assert staging.tasks_for(spark, 0) == fewest
    assert staging.tasks_for(spark, 1000 * staging.TASK_ROWS + 1) == 1001
