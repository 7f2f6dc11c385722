from __future__ import annotations

import datetime as dt

import pytest
from pyspark.errors import NumberFormatException

import sample
from tillbook.operators import latest_per_key
from tillbook.plans import staging
from tillbook.schemas import RAW, STG_ORDERS

T1, T2 = dt.datetime(2024, 5, 1), dt.datetime(2024, 5, 2)


def orders(spark, *rows):
    """Rows of order id, customer, product, quantity, time, status, load stamp; trailing ones may be left out."""
    defaults = ("1", "1", "1", "1", "2024-05-01 10:00:00", "COMPLETED", T1)
    return spark.createDataFrame([tuple(row) + defaults[len(row) :] for row in rows], RAW["orders"])


def dimensions(spark, customer_ids=(1,), product_ids=(1,)):
    customers = spark.createDataFrame([(c,) for c in customer_ids], "customer_id int").selectExpr(
        "cast(customer_id as decimal(38,0)) customer_id"
    )
    products = spark.createDataFrame([(p,) for p in product_ids], "product_id int").selectExpr(
        "cast(product_id as decimal(38,0)) product_id"
    )
    return customers, products


def test_customers(spark):
    raw = spark.createDataFrame(
        [
            ("1", " anne-marie ", "KHAN", " A@B.C ", "new delhi", "INDIA", "2024-01-15", T1),
            (None, "x", "x", "x", "x", "x", "x", T1),
            ("2", None, "Roy", None, None, None, "soon", T1),
        ],
        RAW["customers"],
    )
    clean = staging.clean_customers(raw)
    assert clean.schema.simpleString() == (
        "struct<customer_id:decimal(38,0),first_name:string,last_name:string,email:string,city:string,"
        "country:string,signup_date:date>"
    )
    assert sample.bag(clean) == [
        ("1", "Anne-Marie", "Khan", "a@b.c", "New Delhi", "India", "2024-01-15"),
        ("2", None, "Roy", None, None, None, None),
    ]


def test_products(spark):
    raw = spark.createDataFrame(
        [("1", " USB-C Hub ", " home ", "9.5", T1), ("2", "b", "c", "free", T1), (None, "x", "x", "1", T1)],
        RAW["products"],
    )
    clean = staging.clean_products(raw)
    assert clean.schema["unit_price"].dataType.simpleString() == "decimal(10,2)"
    assert sample.bag(clean) == [("1", "USB-C Hub", "Home", "9.50"), ("2", "b", "C", None)]


def test_orders_are_typed_and_defaulted(spark):
    raw = orders(
        spark,
        ("1", "1", "1", None),
        ("2", "1", "1", "abc"),
        ("3", "1", "1", "2.7", "2024-13-01 00:00:00"),
        ("4", None, "1", "5", None, " completed "),
        (None,),
    )
    assert [(row[0], row[3], row[4], row[5]) for row in sample.bag(staging.clean_orders(raw))] == [
        ("1", "1", "2024-05-01 10:00:00", "COMPLETED"),
        ("2", "1", "2024-05-01 10:00:00", "COMPLETED"),
        ("3", "3", None, "COMPLETED"),
        ("4", "5", None, "COMPLETED"),
    ]


@pytest.mark.parametrize("bad", [("x1",), ("1", "x1"), ("1", "1", "x1")])
def test_bad_ids_fail_the_job(spark, bad):
    with pytest.raises(NumberFormatException):
        staging.clean_orders(orders(spark, bad)).collect()


def test_newest_load_wins_and_ids_compare_as_numbers(spark):
    raw = orders(
        spark,
        ("1008", "1", "1", "9", "2024-05-09 00:00:00", "PENDING", T1),
        ("01008", "1", "1", "2", "2024-05-01 00:00:00", "COMPLETED", T2),
        ("7", "1", "1", "1", "2024-05-01 00:00:00", "PENDING", None),
        ("7", "1", "1", "1", "2024-05-01 00:00:00", "COMPLETED", T2),
    )
    assert [(row[0], row[3], row[5]) for row in sample.bag(staging.clean_orders(raw))] == [
        ("1008", "2", "COMPLETED"),
        ("7", "1", "PENDING"),
    ]


def test_equal_stamps_give_the_same_choice_in_any_input_order(spark):
    rows = [("1", "1", str(product), str(product % 7)) for product in range(1, 40)]
    first = sample.bag(staging.clean_orders(orders(spark, *rows)))
    second = sample.bag(staging.clean_orders(orders(spark, *reversed(rows)).repartition(5)))
    assert first == second
    assert first[0][2] == "39"


def test_latest_is_idempotent_and_limits_each_map_task(spark):
    raw = staging.type_orders(orders(spark, ("1",), ("1",), ("2",)))
    once = latest_per_key(raw, ["order_id"], [])
    assert sample.bag(latest_per_key(once, ["order_id"], [])) == sample.bag(once)
    plan = latest_per_key(raw, ["order_id"], [])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    before_shuffle = plan[plan.index("Exchange hashpartitioning") :]
    assert "WindowGroupLimit" in before_shuffle


def test_seed_checks_references_after_choosing_the_copy(spark):
    raw = orders(
        spark,
        ("1", "1", "1"),
        ("2", "9", "1"),
        ("3", "1", "9"),
        ("4", None, "1"),
        ("5", "1", "1", "1", "2024-05-01 10:00:00", "COMPLETED", T1),
        ("5", "9", "1", "1", "2024-05-01 10:00:00", "COMPLETED", T2),
    )
    seeded = staging.seed_orders(raw, *dimensions(spark, (1, 1, 2)), load_ts=T2)
    assert seeded.schema.simpleString() == STG_ORDERS.simpleString()
    assert [row[0] for row in sample.bag(seeded)] == ["1"]
    assert seeded.first()["_loaded_at"] == T2


def test_reference_filter_is_a_semi_join(spark):
    customers, products = dimensions(spark)
    df = staging.valid_orders(staging.type_orders(orders(spark, ("1",))), customers, products)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("LeftSemi") == 2
    assert "Cartesian" not in plan and "NestedLoop" not in plan
