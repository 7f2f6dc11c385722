"""Jobs that write: set up the layers, stage, refresh the marts, offer everything as views."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillbook.plans import marts, staging
from tillbook.schemas import RAW, STG_ORDERS
from tillbook.sources import Layers, create_raw, read_raw


def set_up(spark: SparkSession, layers: Layers) -> None:
    """Empty raw tables and an empty staged order table."""
    for table in RAW:
        create_raw(spark, layers, table)
    layers.staged_orders(spark).create(STG_ORDERS)


def stage_dimensions(spark: SparkSession, layers: Layers) -> None:
    """Full refresh of staged customers and products."""
    layers.staged(spark, "customers").overwrite(staging.clean_customers(read_raw(spark, layers, "customers")))
    layers.staged(spark, "products").overwrite(staging.clean_products(read_raw(spark, layers, "products")))


def seed_orders(
    spark: SparkSession, layers: Layers, load_ts: datetime | None = None, last_line: bool = False
) -> None:
    """Batch seed of the staged orders from all raw orders there are; for use without the feed.

    ``last_line`` settles equal stamps by file and line instead of by the largest values.
    """
    orders = staging.seed_orders(
        read_raw(spark, layers, "orders", lineage=last_line),
        layers.staged(spark, "customers").read(),
        layers.staged(spark, "products").read(),
        load_ts,
    )
    layers.staged_orders(spark).overwrite(orders)


def _unique(df: DataFrame, key: str) -> bool:
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1).isEmpty()


def refresh_marts(spark: SparkSession, layers: Layers) -> None:
    """Full refresh of the star schema from the staged tables.

    Staged orders hold one row per order. If product ids are unique too, so are the orders of the fact, and the fact
    says so; reports then count orders without a distinct.
    """
    products = layers.staged(spark, "products").read()
    orders = layers.staged_orders(spark).read()
    layers.mart(spark, "dim_customer").overwrite(marts.dim_customer(layers.staged(spark, "customers").read()))
    layers.mart(spark, "dim_product").overwrite(marts.dim_product(products))
    layers.mart(spark, "fct_sales").overwrite(
        marts.fct_sales(orders, products), facts={"orders_unique": _unique(products, "product_id")}
    )


def add_days(layers: Layers, sales: DataFrame) -> None:
    """Count sales that were not counted before; days that have rows already are merged when they are read."""
    layers.mart(sales.sparkSession, "daily_orders").append(marts.daily_parts(sales))


@dataclass(frozen=True)
class Star:
    """The star schema as written by the last refresh."""

    fact: DataFrame
    customers: DataFrame
    products: DataFrame
    orders_unique: bool


def load_star(spark: SparkSession, layers: Layers) -> Star:
    fact = layers.mart(spark, "fct_sales")
    state = fact.state()  # once, so that rows and facts are of one refresh
    return Star(
        fact=fact.read(state),
        customers=layers.mart(spark, "dim_customer").read(),
        products=layers.mart(spark, "dim_product").read(),
        orders_unique=state["facts"].get("orders_unique", False),
    )


def register_views(spark: SparkSession, layers: Layers) -> None:
    """Temporary views of all layers, for queries written in SQL. Register again to see a later refresh."""
    for table in RAW:
        read_raw(spark, layers, table).createOrReplaceTempView(f"raw_{table}")
    staging.clean_orders(read_raw(spark, layers, "orders")).createOrReplaceTempView("v_clean_orders")
    layers.staged(spark, "customers").read().createOrReplaceTempView("stg_customers")
    layers.staged(spark, "products").read().createOrReplaceTempView("stg_products")
    layers.staged_orders(spark).read().createOrReplaceTempView("stg_orders")
    star = load_star(spark, layers)
    star.customers.createOrReplaceTempView("dim_customer")
    star.products.createOrReplaceTempView("dim_product")
    star.fact.createOrReplaceTempView("fct_sales")
    marts.daily_revenue(star.fact, star.orders_unique).createOrReplaceTempView("v_daily_revenue")
    marts.category_revenue(star.fact, star.products).createOrReplaceTempView("v_category_revenue")
