"""What the physical plans must and must not contain."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import sample
from tillbook.plans import analytics, jobs, marts
from tillbook.sources import Layers


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df):
    df.collect()
    return plan(df).split("== Initial Plan ==")[0]


@pytest.fixture(scope="module")
def star(spark, tmp_path_factory):
    layers = Layers(str(tmp_path_factory.mktemp("layers")))
    sample.land(spark, layers)
    jobs.seed_orders(spark, layers)
    jobs.refresh_marts(spark, layers)
    return jobs.load_star(spark, layers)


def test_scans_read_needed_columns_only(star):
    assert "ReadSchema: struct<order_id:decimal(38,0),line_revenue:decimal(38,2)>" in plan(analytics.kpis(star.fact))
    assert "ReadSchema: struct<line_revenue:decimal(38,2),order_date:date>" in plan(
        analytics.revenue_moving_average(star.fact)
    )


def test_filters_reach_the_scan(spark, star):
    orders = spark.read.parquet(*star.fact.inputFiles())
    fact = marts.fct_sales(orders.drop("unit_price"), star.products)
    assert "EqualTo(status,COMPLETED)" in plan(fact)


def test_known_unique_orders_need_no_regrouping(star):
    assert plan(analytics.kpis(star.fact, orders_unique=True)).count("Exchange") == 1
    assert "order_id" not in plan(analytics.kpis(star.fact, orders_unique=True)).split("hashpartitioning")[-1][:30]
    assert plan(analytics.repeat_customers(star.fact, orders_unique=True)).count("hashpartitioning") == 2
    assert plan(analytics.repeat_customers(star.fact)).count("hashpartitioning") == 3


def test_sales_are_summed_before_the_join(star):
    for report in (analytics.top_products(star.fact, star.products), marts.category_revenue(star.fact, star.products)):
        text = plan(report)
        join = text.index("Join")
        assert "partial_sum(line_revenue" in text[join:]
        assert "Cartesian" not in text and "NestedLoop" not in text


def test_top_products_keep_only_the_top_rows_of_each_task(star):
    assert "TakeOrderedAndProject(limit=5" in plan(analytics.top_products(star.fact, star.products))


def test_the_view_is_computed_once_for_the_share(star):
    assert "ReusedExchange" in final_plan(analytics.category_share(star.fact, star.products))


def test_hot_product_is_split_in_the_fact_join(spark):
    """A third of all orders has one product; with thresholds for small data the join splits that key."""
    orders = spark.range(200_000, numPartitions=8).select(
        F.col("id").cast("decimal(38,0)").alias("order_id"),
        (F.col("id") % 7).cast("decimal(38,0)").alias("customer_id"),
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 5000).cast("decimal(38,0)").alias("product_id"),
        F.lit(1).cast("decimal(38,0)").alias("quantity"),
        F.lit(None).cast("timestamp_ntz").alias("order_ts"),
        F.lit("COMPLETED").alias("status"),
    )
    products = spark.range(5000).select(
        F.col("id").cast("decimal(38,0)").alias("product_id"), F.lit(2).cast("decimal(10,2)").alias("unit_price")
    )
    small = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "128KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    for name, value in small.items():
        spark.conf.set(name, value)
    try:
        fact = marts.fct_sales(orders, products)
        rows, revenue = fact.agg(F.count(F.lit(1)), F.sum("line_revenue")).first()
        fact.write.format("noop").mode("overwrite").save()
        text = final_plan(fact)
    finally:
        for name in small:
            spark.conf.unset(name)
    assert (rows, revenue) == (200_000, 400_000)
    assert "skew=true" in text
