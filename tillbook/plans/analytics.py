"""Business reports on the star schema.

``orders_unique`` states that the fact holds each order once, as the marts job records it; every report is right
without it, too. An order belongs to one customer: the staged orders hold one row per order.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillbook.functions import ASC, DESC, ascending, days_between, descending
from tillbook.functions.rounding import rounded_quotient
from tillbook.operators import global_ntiles, global_rank, moving_average, share_of_total
from tillbook.plans.marts import added_up, category_revenue, daily_revenue, members, order_count, sales_by_product

RFM_TILES = 3


def kpis(fact: DataFrame, orders_unique: bool = False) -> DataFrame:
    """Headline numbers, always one row."""
    return fact.agg(
        order_count(orders_unique).alias("total_orders"),
        F.sum("line_revenue").alias("total_revenue"),
        rounded_quotient(F.sum("line_revenue"), F.count("line_revenue").cast("decimal(20,0)"), 2).alias("avg_line_value"),
    )


def kpis_of_parts(parts: DataFrame) -> DataFrame:
    """The same from stored days, without a look at the fact."""
    lines = F.col("lines").cast("decimal(20,0)")
    return added_up(parts).select(
        F.col("orders").alias("total_orders"),
        F.col("revenue").alias("total_revenue"),
        rounded_quotient(F.col("revenue"), lines, 2).alias("avg_line_value"),
    )


def top_products(fact: DataFrame, products: DataFrame, limit: int = 5) -> DataFrame:
    """Best-selling product names by revenue; products of the same name and category count as one."""
    return (
        sales_by_product(fact, products, "product_name", "category")
        .select("product_name", "category", "units_sold", "revenue")
        .orderBy(descending("revenue"), ascending("product_name"), ascending("category"))
        .limit(limit)
    )


def _per_customer(fact: DataFrame, orders_unique: bool, *more: Column) -> DataFrame:
    return fact.groupBy("customer_id").agg(
        order_count(orders_unique).alias("_orders"), F.sum("line_revenue").alias("_revenue"), *more
    )


def _sales_by_customer(fact: DataFrame, customers: DataFrame, orders_unique: bool, *attributes: str) -> DataFrame:
    """Orders and revenue per customer attribute; sales are summed per customer before they meet the dimension."""
    return (
        _per_customer(fact, orders_unique)
        .join(members(customers, "customer_id", *attributes), "customer_id")
        .groupBy(*attributes)
        .agg(
            F.sum("_orders").alias("orders"),
            F.sum(F.col("_revenue") * F.col("_copies")).alias("revenue"),
        )
    )


def revenue_by_city(fact: DataFrame, customers: DataFrame, orders_unique: bool = False) -> DataFrame:
    """Cities by revenue."""
    return _sales_by_customer(fact, customers, orders_unique, "city").orderBy(descending("revenue"))


def revenue_moving_average(fact: DataFrame, days: int = 3) -> DataFrame:
    """Revenue per day beside the mean of the last ``days`` days that had sales; days without sales are not filled in.

    The window sees one row per day, so the calendar bounds its size.
    """
    by_day = [ascending("order_date")]
    daily = daily_revenue(fact, orders_unique=True).select("order_date", "revenue")
    return moving_average(daily, by_day, "revenue", days - 1, "revenue_3d_avg").orderBy(*by_day)


def customer_lifetime_value(fact: DataFrame, customers: DataFrame, orders_unique: bool = False) -> DataFrame:
    """Customers ranked by what they spent; customers of the same name and city count as one."""
    spending = _sales_by_customer(fact, customers, orders_unique, "full_name", "city").withColumnRenamed(
        "revenue", "lifetime_value"
    )
    ranked = global_rank(spending, ("lifetime_value", DESC), "spend_rank")
    return ranked.orderBy(descending("lifetime_value"), ascending("full_name"), ascending("city"))


def repeat_customers(fact: DataFrame, orders_unique: bool = False) -> DataFrame:
    """How many customers ordered more than once, and how many just once."""
    per_customer = fact.groupBy("customer_id").agg(order_count(orders_unique).alias("_orders"))
    kind = F.when(F.col("_orders") > 1, "Repeat").otherwise("One-time").alias("customer_type")
    return per_customer.groupBy(kind).agg(F.count(F.lit(1)).alias("customers"))


def category_share(fact: DataFrame, products: DataFrame) -> DataFrame:
    """Categories with their share of the whole revenue in percent."""
    revenue = category_revenue(fact, products).select("category", "revenue")
    return share_of_total(revenue, "revenue", "pct_of_total").orderBy(descending("revenue"))


def rfm_base(
    fact: DataFrame, customers: DataFrame, as_of: date | None = None, orders_unique: bool = False
) -> DataFrame:
    """Days since the last order, number of orders and revenue of each customer."""
    today = F.current_date() if as_of is None else F.lit(as_of)
    sales = _per_customer(fact, orders_unique, F.max("order_date").alias("_last"))
    return sales.join(members(customers, "customer_id", "full_name"), "customer_id").select(
        "customer_id",
        "full_name",
        days_between(F.col("_last"), today).alias("recency_days"),
        F.col("_orders").alias("frequency"),
        (F.col("_revenue") * F.col("_copies")).alias("monetary"),
    )


def rfm_scores(
    fact: DataFrame, customers: DataFrame, as_of: date | None = None, orders_unique: bool = False
) -> DataFrame:
    """Thirds of the customers by recency, frequency and revenue, 1 being the best; ties go by customer id."""
    ties = [("customer_id", ASC), ("full_name", ASC)]
    orders = {
        "r_score": [("recency_days", ASC), *ties],
        "f_score": [("frequency", DESC), *ties],
        "m_score": [("monetary", DESC), *ties],
    }
    scored = global_ntiles(rfm_base(fact, customers, as_of, orders_unique), RFM_TILES, orders)
    return scored.orderBy(descending("monetary"), ascending("customer_id"), ascending("full_name")).select(
        "full_name", "recency_days", "frequency", "monetary", "r_score", "f_score", "m_score"
    )
