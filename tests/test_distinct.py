"""Distinct counts by bitmaps, lineage as a tie-break, references of large dimensions, merges by stamp."""

from __future__ import annotations

from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tillbook.operators import distinct_ids, id_bitmaps, keep_valid_refs, merge_newest, merged_bitmaps
from tillbook.plans import jobs, staging
from tillbook.sources import landing
from tillbook.streaming import OrderFeed

IDS = [None, 0, 1, -1, 32768, 32769, -32768, 2**63 - 1, -(2**63 - 1), -(2**63), 2**63, 10**37, -(10**37)]


def _counts(parts, *keys):
    merged = merged_bitmaps(parts, keys)
    return {tuple(row[:-1]): row[-1] for row in merged.groupBy(*keys).agg(distinct_ids().alias("n")).collect()}


def test_odd_ids_are_counted_once(spark):
    rows = [(day, None if i is None else Decimal(i)) for day in ("a", "b", None) for i in IDS * 2] + [("nulls", None)]
    df = spark.createDataFrame(rows, "day string, id decimal(38,0)").repartition(7)
    halves = [df, df.filter("day = 'a'")]
    parts = id_bitmaps(halves[0], ["day"], "id").union(id_bitmaps(halves[1], ["day"], "id"))
    distinct = len(IDS) - 1
    assert _counts(parts, "day") == {("a",): distinct, ("b",): distinct, (None,): distinct, ("nulls",): 0}
    assert _counts(parts) == {(): distinct}


def test_no_rows(spark):
    parts = id_bitmaps(spark.createDataFrame([], "day string, id long"), ["day"], "id")
    assert _counts(parts, "day") == {}
    assert _counts(parts) == {(): 0}


def test_a_hot_day_leaves_the_map_tasks_as_few_rows(spark):
    day = F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id") % 50)
    df = spark.range(0, 200_000, 1, 4).withColumn("day", day)
    parts = id_bitmaps(df.select("day", (F.col("id") % 60_000).alias("id")), ["day"], "id")
    plan = parts._jdf.queryExecution().executedPlan().toString()
    assert "partial_bitmap_construct_agg" in plan[plan.index("Exchange hashpartitioning") :]
    expected = {(r[0],): r[1] for r in df.groupBy("day").agg(F.count_distinct(F.col("id") % 60_000)).collect()}
    assert _counts(parts, "day") == expected


@pytest.mark.parametrize("most", [100, 5, 0])
def test_references_by_any_way(spark, most):
    """Few known ids, many known but few unknown ones, many of both."""
    df = spark.createDataFrame([(i, i % 12 if i % 5 else None, i % 9) for i in range(200)], "id int, a int, b int")
    a = spark.createDataFrame([(i,) for i in range(10)] * 2 + [(None,)], "a int")
    b = spark.createDataFrame([(i,) for i in range(8)], "b int")
    kept = keep_valid_refs(df, (a, "a"), (b, "b"), most=most)
    assert kept.columns == df.columns
    wanted = {i for i in range(200) if i % 5 and i % 12 < 10 and i % 9 < 8}
    found = [row["id"] for row in kept.collect()]
    assert sorted(found) == sorted(wanted)


def test_orders_cross_the_network_once_beside_large_dimensions(spark, monkeypatch):
    monkeypatch.setitem(keep_valid_refs.__kwdefaults__, "most", 3)
    raw = spark.createDataFrame(
        [(str(i), str(i % 7), str(i % 8), "1", "2024-05-01 10:00:00", "x", None) for i in range(50)],
        "order_id string, customer_id string, product_id string, quantity string, order_ts string, status string, "
        "_loaded_at timestamp_ntz",
    )
    customers = spark.range(6).select(F.col("id").cast("decimal(38,0)").alias("customer_id"))
    products = spark.range(7).select(F.col("id").cast("decimal(38,0)").alias("product_id"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        seeded = staging.seed_orders(raw, customers, products)
        plan = seeded._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 1
        assert sorted(int(r[0]) for r in seeded.collect()) == [i for i in range(50) if i % 7 < 6 and i % 8 < 7]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


HEADER = "order_id,customer_id,product_id,quantity,order_ts,status\n"


@pytest.mark.parametrize("feed", [False, True])
def test_the_last_line_of_the_last_file_wins(spark, layers, tmp_path, feed):
    for name, quantities in (("a.csv", (9, 8)), ("b.csv", (7, 3, 5, 2))):
        lines = [f"1,1,1,{q},2024-05-01 10:00:00,completed\n" for q in quantities]
        (tmp_path / name).write_text(HEADER + "".join(lines))
    jobs.set_up(spark, layers)
    one = {"customer_id": "1", "product_id": "1", "order_id": "1", "quantity": "99"}
    landing.insert_rows(spark, layers, "customers", [{"customer_id": "1"}])
    landing.insert_rows(spark, layers, "products", [{"product_id": "1"}])
    stamp = datetime(2024, 6, 1)
    landing.insert_rows(spark, layers, "orders", [one], stamp)
    landing.load_csv(spark, layers, "orders", [str(tmp_path / "b.csv"), str(tmp_path / "a.csv")], load_ts=stamp)
    jobs.stage_dimensions(spark, layers)
    if feed:
        OrderFeed(spark, layers, last_line=True).seed()
    else:
        jobs.seed_orders(spark, layers, last_line=True)
    assert [int(row["quantity"]) for row in layers.staged_orders(spark).read().collect()] == [2]
    files = landing.read_raw(spark, layers, "orders", lineage=True).select("_source_file").distinct().collect()
    assert {(row[0] or "none").rpartition("/")[2] for row in files} == {"a.csv", "b.csv", "none"}



def test_late_older_copies_do_not_win(spark):
    target = spark.createDataFrame([(1, 5, "t"), (2, 5, "t"), (3, None, "t"), (4, None, "t"), (6, 5, "t")], "k int, s int, v string")
    late = spark.createDataFrame([("old", 4, 1), ("new", 6, 2), ("dated", 1, 3), ("bare", None, 4), ("first", 1, 5)], "v string, s int, k int")
    last = spark.createDataFrame([("same", 6, 2), ("a", 5, 6), ("b", 5, 6)], "v string, s int, k int")
    merged = merge_newest(target, late, last, key="k", stamp="s")
    assert merged.columns == target.columns
    assert merged._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
    assert {r["k"]: r["v"] for r in merged.collect()} == {1: "t", 2: "same", 3: "dated", 4: "bare", 5: "first", 6: "b"}
