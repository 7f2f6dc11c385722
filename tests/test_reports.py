"""The reports on the sample, and on dirty random tables against the same questions in plain SQL."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

import sample
from tillbook.plans import analytics, jobs, marts
from tillbook.schemas import RAW
from tillbook.sources import landing
from tillbook.streaming import OrderFeed

AS_OF = dt.date(2024, 6, 1)

GOLDEN = {
    "kpis": [("13", "17461.00", "1343.15")],
    "top_products": [
        ("Wireless Mouse", "Electronics", "5", "3995.00"),
        ("USB-C Hub", "Electronics", "3", "3897.00"),
        ("Mechanical Keyboard", "Electronics", "1", "2499.00"),
        ("Water Bottle", "Home", "5", "2495.00"),
        ("Gel Pen Pack", "Stationery", "16", "1584.00"),
    ],
    "revenue_by_city": [
        ("Hyderabad", "5", "6689.00"),
        ("Bengaluru", "3", "3842.00"),
        ("Delhi", "2", "2289.00"),
        ("Pune", "1", "1996.00"),
        ("Mumbai", "1", "1598.00"),
        ("Chennai", "1", "1047.00"),
    ],
    "revenue_moving_average": [
        ("2024-05-01", "2343.00", "2343.00"),
        ("2024-05-03", "2499.00", "2421.00"),
        ("2024-05-05", "990.00", "1944.00"),
        ("2024-05-06", "799.00", "1429.33"),
        ("2024-05-08", "2598.00", "1462.33"),
        ("2024-05-09", "1047.00", "1481.33"),
        ("2024-05-10", "1996.00", "1880.33"),
        ("2024-05-12", "594.00", "1212.33"),
        ("2024-05-15", "1598.00", "1396.00"),
        ("2024-05-16", "1199.00", "1130.33"),
        ("2024-05-18", "499.00", "1098.67"),
        ("2024-05-20", "1299.00", "999.00"),
    ],
    "customer_lifetime_value": [
        ("Aarav Sharma", "Hyderabad", "3", "4691.00", "1"),
        ("Priya Nair", "Bengaluru", "3", "3842.00", "2"),
        ("Sara Khan", "Delhi", "2", "2289.00", "3"),
        ("Vikram Reddy", "Hyderabad", "2", "1998.00", "4"),
        ("Kabir Singh", "Pune", "1", "1996.00", "5"),
        ("Rohan Mehta", "Mumbai", "1", "1598.00", "6"),
        ("Ananya Iyer", "Chennai", "1", "1047.00", "7"),
    ],
    "category_share": [
        ("Electronics", "10391.00", "59.5"),
        ("Home", "4741.00", "27.2"),
        ("Stationery", "2329.00", "13.3"),
    ],
    "category_revenue": [
        ("Electronics", "10391.00", "9"),
        ("Home", "4741.00", "9"),
        ("Stationery", "2329.00", "21"),
    ],
    "rfm_scores": [
        ("Aarav Sharma", "20", "3", "4691.00", "2", "1", "1"),
        ("Priya Nair", "14", "3", "3842.00", "1", "1", "1"),
        ("Sara Khan", "12", "2", "2289.00", "1", "1", "1"),
        ("Vikram Reddy", "16", "2", "1998.00", "1", "2", "2"),
        ("Kabir Singh", "22", "1", "1996.00", "3", "3", "2"),
        ("Rohan Mehta", "17", "1", "1598.00", "2", "2", "3"),
        ("Ananya Iyer", "23", "1", "1047.00", "3", "3", "3"),
    ],
}


def reports(star, orders_unique):
    fact, customers, products = star.fact, star.customers, star.products
    return {
        "kpis": analytics.kpis(fact, orders_unique),
        "top_products": analytics.top_products(fact, products),
        "revenue_by_city": analytics.revenue_by_city(fact, customers, orders_unique),
        "revenue_moving_average": analytics.revenue_moving_average(fact),
        "customer_lifetime_value": analytics.customer_lifetime_value(fact, customers, orders_unique),
        "category_share": analytics.category_share(fact, products),
        "category_revenue": marts.category_revenue_report(fact, products),
        "rfm_scores": analytics.rfm_scores(fact, customers, AS_OF, orders_unique),
        "repeat_customers": analytics.repeat_customers(fact, orders_unique),
        "daily_revenue": marts.daily_revenue(fact, orders_unique),
    }


@pytest.fixture(scope="module")
def sample_star(spark, tmp_path_factory):
    layers = sample_layers(tmp_path_factory)
    sample.land(spark, layers)
    OrderFeed(spark, layers).seed()
    jobs.refresh_marts(spark, layers)
    return jobs.load_star(spark, layers)


def sample_layers(tmp_path_factory):
    from tillbook.sources import Layers

    return Layers(str(tmp_path_factory.mktemp("layers")))


@pytest.mark.parametrize("orders_unique", [False, True])
def test_sample_results(sample_star, orders_unique):
    assert sample_star.orders_unique
    results = reports(sample_star, orders_unique)
    for name, expected in GOLDEN.items():
        assert sample.values(results[name]) == expected, name
    assert sample.bag(results["repeat_customers"]) == [("One-time", "3"), ("Repeat", "4")]


def test_batch_seed_equals_feed_seed(spark, layers, sample_star):
    sample.land(spark, layers)
    jobs.seed_orders(spark, layers)
    jobs.refresh_marts(spark, layers)
    assert sample.bag(jobs.load_star(spark, layers).fact) == sample.bag(sample_star.fact)


def test_empty_fact(sample_star):
    empty = sample_star.fact.filter("order_id < 0")
    assert sample.values(analytics.kpis(empty)) == [("0", None, None)]
    assert analytics.customer_lifetime_value(empty, sample_star.customers).collect() == []
    assert analytics.rfm_scores(empty, sample_star.customers, AS_OF).collect() == []
    assert analytics.category_share(empty, sample_star.products).collect() == []


def test_result_types(sample_star):
    star = reports(sample_star, True)
    assert sample_star.fact.schema.simpleString() == (
        "struct<order_id:decimal(38,0),customer_id:decimal(38,0),product_id:decimal(38,0),quantity:decimal(38,0),"
        "unit_price:decimal(10,2),line_revenue:decimal(38,2),order_ts:timestamp_ntz,order_date:date,status:string>"
    )
    assert star["customer_lifetime_value"].schema.simpleString() == (
        "struct<full_name:string,city:string,orders:bigint,lifetime_value:decimal(38,2),spend_rank:bigint>"
    )
    assert star["rfm_scores"].schema.simpleString() == (
        "struct<full_name:string,recency_days:bigint,frequency:bigint,monetary:decimal(38,2),r_score:bigint,"
        "f_score:bigint,m_score:bigint>"
    )
    assert star["category_share"].schema.names == ["category", "revenue", "pct_of_total"]


PLAIN_SQL = {
    "kpis": """SELECT count(DISTINCT order_id), sum(line_revenue), round(avg(line_revenue), 2) FROM fct_sales""",
    "top_products": """
        SELECT p.product_name, p.category, sum(f.quantity), sum(f.line_revenue) AS revenue
        FROM fct_sales f JOIN dim_product p ON f.product_id = p.product_id GROUP BY p.product_name, p.category
        ORDER BY revenue DESC NULLS FIRST, p.product_name NULLS LAST, p.category NULLS LAST LIMIT 5""",
    "revenue_by_city": """
        SELECT c.city, count(DISTINCT f.order_id), sum(f.line_revenue)
        FROM fct_sales f JOIN dim_customer c ON f.customer_id = c.customer_id GROUP BY c.city""",
    "revenue_moving_average": """
        SELECT order_date, revenue, round(avg(revenue) OVER (
            ORDER BY order_date NULLS LAST ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), 2)
        FROM (SELECT order_date, sum(line_revenue) AS revenue FROM fct_sales GROUP BY order_date)""",
    "customer_lifetime_value": """
        SELECT c.full_name, c.city, count(DISTINCT f.order_id), sum(f.line_revenue),
               rank() OVER (ORDER BY sum(f.line_revenue) DESC NULLS FIRST)
        FROM fct_sales f JOIN dim_customer c ON f.customer_id = c.customer_id GROUP BY c.full_name, c.city""",
    "repeat_customers": """
        SELECT CASE WHEN n > 1 THEN 'Repeat' ELSE 'One-time' END, count(*)
        FROM (SELECT customer_id, count(DISTINCT order_id) AS n FROM fct_sales GROUP BY customer_id) GROUP BY 1""",
    "category_share": """
        SELECT category, revenue, round(100 * revenue / sum(revenue) OVER (), 1)
        FROM (SELECT p.category, sum(f.line_revenue) AS revenue
              FROM fct_sales f JOIN dim_product p ON f.product_id = p.product_id GROUP BY p.category)""",
    "category_revenue": """
        SELECT p.category, sum(f.line_revenue), sum(f.quantity)
        FROM fct_sales f JOIN dim_product p ON f.product_id = p.product_id GROUP BY p.category""",
    "daily_revenue": """
        SELECT order_date, count(DISTINCT order_id), sum(line_revenue) FROM fct_sales GROUP BY order_date""",
    "rfm_scores": """
        WITH rfm AS (
            SELECT c.customer_id, c.full_name, datediff(date '2024-06-01', max(f.order_date)) AS recency_days,
                   count(DISTINCT f.order_id) AS frequency, sum(f.line_revenue) AS monetary
            FROM fct_sales f JOIN dim_customer c ON f.customer_id = c.customer_id GROUP BY c.customer_id, c.full_name)
        SELECT full_name, recency_days, frequency, monetary,
               ntile(3) OVER (ORDER BY recency_days NULLS LAST, customer_id, full_name NULLS LAST),
               ntile(3) OVER (ORDER BY frequency DESC NULLS FIRST, customer_id, full_name NULLS LAST),
               ntile(3) OVER (ORDER BY monetary DESC NULLS FIRST, customer_id, full_name NULLS LAST)
        FROM rfm""",
}


def dirty_raw(seed, unique_dimensions):
    """Customers and products with namesakes, missing values and, if wanted, copies; one customer and one product
    with a third of all orders."""
    rng = random.Random(seed)
    stamp = dt.datetime(2024, 6, 1)
    copies = 1 if unique_dimensions else 2
    customers, products, orders = [], [], []
    for key in range(1, 41):
        for _ in range(rng.randint(1, copies)):
            first = rng.choice(["ann", "bob", None, "cy-dee"])
            city = rng.choice(["pune", "Pune ", "delhi", None])
            customers.append((str(key), first, rng.choice(["roy", "lee"]), "x@y.z", city, "in", "2024-01-01", stamp))
    for key in range(1, 21):
        for _ in range(rng.randint(1, copies)):
            price = rng.choice(["10.00", "9.99", "free", "0.01"])
            products.append((str(key), rng.choice(["pen", "cup", None]), rng.choice(["a", "b"]), price, stamp))
    for _ in range(900):
        customer = 1 if rng.random() < 0.34 else rng.randint(1, 45)
        product = 1 if rng.random() < 0.34 else rng.randint(1, 22)
        moment = "never" if rng.random() < 0.1 else f"2024-05-{rng.randint(1, 28):02d} 10:00:00"
        quantity = rng.choice(["1", "2", "x", None, "2.5"])
        status = rng.choice(["completed", "COMPLETED ", "pending"])
        loaded = stamp + dt.timedelta(minutes=rng.randint(0, 3))
        orders.append((str(rng.randint(1, 600)), str(customer), str(product), quantity, moment, status, loaded))
    return {"customers": customers, "products": products, "orders": orders}


@pytest.mark.parametrize("unique_dimensions", [True, False])
@pytest.mark.parametrize("checked", [True, False])
def test_reports_equal_plain_sql(spark, layers, unique_dimensions, checked):
    jobs.set_up(spark, layers)
    raw = {name: spark.createDataFrame(rows, RAW[name]) for name, rows in dirty_raw(5, unique_dimensions).items()}
    for name, df in raw.items():
        if name != "orders" or checked:
            landing.append_raw(df, layers, name)
    jobs.stage_dimensions(spark, layers)
    feed = OrderFeed(spark, layers)
    if not checked:  # a first, nearly empty batch is the seed; the others then keep orders of unknown customers
        landing.append_raw(raw["orders"].limit(1), layers, "orders")
        feed.seed()
        landing.append_raw(raw["orders"], layers, "orders")
    feed.run_once()
    jobs.refresh_marts(spark, layers)
    jobs.register_views(spark, layers)
    star = jobs.load_star(spark, layers)
    assert star.orders_unique == unique_dimensions
    for orders_unique in {False, star.orders_unique}:
        for name, report in reports(star, orders_unique).items():
            assert sample.bag(report) == sample.bag(spark.sql(PLAIN_SQL[name])), name


def test_category_revenues_add_up_to_the_headline(sample_star):
    by_category = analytics.category_share(sample_star.fact, sample_star.products).agg(F.sum("revenue")).first()[0]
    assert by_category == analytics.kpis(sample_star.fact).first().total_revenue


def test_views_answer_sql(spark, layers):
    sample.land(spark, layers)
    jobs.seed_orders(spark, layers)
    jobs.refresh_marts(spark, layers)
    jobs.register_views(spark, layers)
    got = spark.sql("SELECT * FROM v_category_revenue ORDER BY revenue DESC")
    assert sample.values(got) == GOLDEN["category_revenue"]
    assert spark.table("v_clean_orders").count() == 15
    assert spark.table("stg_orders").count() == 15
    assert spark.table("raw_orders").count() == 16
