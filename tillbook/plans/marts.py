"""Star schema and reporting views."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillbook.functions import descending
from tillbook.operators import distinct_in_words, id_words, merged_words

COMPLETED = "COMPLETED"


def dim_customer(customers: DataFrame) -> DataFrame:
    """Customers with a full name, NULL if either part is missing."""
    full_name = F.concat("first_name", F.lit(" "), "last_name").alias("full_name")
    return customers.select("customer_id", full_name, "email", "city", "country", "signup_date")


def dim_product(products: DataFrame) -> DataFrame:
    return products.select("product_id", "product_name", "category", "unit_price")


def fct_sales(orders: DataFrame, products: DataFrame) -> DataFrame:
    """Completed orders at the product's present price; an order of an unknown product drops out."""
    sold = orders.filter(F.col("status") == COMPLETED)
    return sold.join(products.select("product_id", "unit_price"), "product_id").select(
        "order_id",
        "customer_id",
        "product_id",
        "quantity",
        "unit_price",
        (F.col("quantity") * F.col("unit_price")).alias("line_revenue"),
        "order_ts",
        F.col("order_ts").cast("date").alias("order_date"),
        "status",
    )


def order_count(orders_unique: bool) -> Column:
    """Number of different orders. Where each order is known to stand in one row, a plain count gives the same
    number without regrouping every row by its order."""
    return F.count("order_id") if orders_unique else F.count_distinct("order_id")


def daily_revenue(fact: DataFrame, orders_unique: bool = False) -> DataFrame:
    return fact.groupBy("order_date").agg(
        order_count(orders_unique).alias("orders"), F.sum("line_revenue").alias("revenue")
    )


def daily_parts(fact: DataFrame) -> DataFrame:
    """Sales per day in a form that can be stored and added up: order ids as bits, revenue, lines with a price."""
    sums = F.sum("line_revenue").alias("_revenue"), F.count("line_revenue").alias("_lines")
    return id_words(fact, ["order_date"], "order_id", *sums)


def added_up(parts: DataFrame, *keys: str) -> DataFrame:
    """``daily_parts`` by the given keys or over all days, an order of several parts counted once."""
    merged = merged_words(parts, keys, F.sum("_revenue").alias("_revenue"), F.sum("_lines").alias("_lines"))
    return merged.groupBy(*keys).agg(
        distinct_in_words().alias("orders"), F.sum("_revenue").alias("revenue"), F.sum("_lines").alias("lines")
    )


def daily_revenue_of_parts(parts: DataFrame) -> DataFrame:
    return added_up(parts, "order_date").drop("lines")


def members(dimension: DataFrame, key: str, *attributes: str) -> DataFrame:
    """Keys of a dimension with some attributes, and how many rows say the same: a sum counts each, a distinct
    count does not. Copies of a key meet in the aggregate and not in the join behind it."""
    return dimension.groupBy(key, *attributes).agg(F.count(F.lit(1)).alias("_copies"))


def sales_by_product(fact: DataFrame, products: DataFrame, *attributes: str) -> DataFrame:
    """Revenue and units per product attribute.

    Sales are summed per product before they meet the dimension, so that only one row per product is joined, however
    often a product was sold.
    """
    per_product = fact.groupBy("product_id").agg(
        F.sum("line_revenue").alias("_revenue"), F.sum("quantity").alias("_units")
    )
    copies = F.col("_copies").cast("decimal(20,0)")
    return (
        per_product.join(members(products, "product_id", *attributes), "product_id")
        .groupBy(*attributes)
        .agg(
            F.sum(F.col("_revenue") * copies).alias("revenue"),
            F.sum(F.col("_units") * copies).alias("units_sold"),
        )
    )


def category_revenue(fact: DataFrame, products: DataFrame) -> DataFrame:
    return sales_by_product(fact, products, "category")


def category_revenue_report(fact: DataFrame, products: DataFrame) -> DataFrame:
    """The category view, best category first."""
    return category_revenue(fact, products).orderBy(descending("revenue"))
