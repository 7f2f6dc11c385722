"""Cases in which a cast, a rounding or a second seed went wrong once."""

from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal

from pyspark.sql import functions as F

from tillbook import functions as fn
from tillbook.functions.rounding import rounded_quotient
from tillbook.operators import share_of_total
from tillbook.plans import analytics


def test_dates_and_timestamps_must_fit_as_a_whole(spark):
    texts = ["2024", "2024-01", "2024-01-15 not a date", "2024-01-15Tjunk", "2024-01-15", " 15-JAN-2024", "01/15/2024",
             "2024-01-15 10:22:00", "2024-01-15 10:22:00+05:30"]
    rows = spark.createDataFrame([(k, x) for k, x in enumerate(texts)], "k int, x string")
    found = rows.select("k", fn.try_date(F.col("x")).alias("d"), fn.try_timestamp(F.col("x")).alias("t")).orderBy("k")
    days, moments = zip(*[(row["d"], row["t"]) for row in found.collect()], strict=True)
    assert days[:4] == (None,) * 4 and days[4] == days[6] == days[7] == date(2024, 1, 15)
    assert moments[:4] == (None,) * 4 and moments[8] is None
    assert moments[4] == datetime(2024, 1, 15) and moments[7] == datetime(2024, 1, 15, 10, 22)


def test_quotients_are_rounded_once(spark):
    rows = spark.createDataFrame([(Decimal("33349999.95"),), (Decimal("66650000.05"),)], "v decimal(38,2)")
    shares = [row["s"] for row in share_of_total(rows, "v", "s").orderBy("v").collect()]
    assert shares == [Decimal("33.3"), Decimal("66.7")]
    values = spark.range(1).select(
        *[
            rounded_quotient(F.lit(Decimal(a)).cast("decimal(38,2)"), F.lit(Decimal(b)), 2).alias(f"c{k}")
            for k, (a, b) in enumerate([("100.00", "20001"), ("0.05", "10"), ("-0.05", "10"), ("1.00", "0")])
        ]
    )
    assert list(values.first()) == [Decimal("0.00"), Decimal("0.01"), Decimal("-0.01"), None]


def test_average_of_many_small_lines(spark):
    fact = spark.range(20_001).select(
        F.col("id").alias("order_id"),
        F.when(F.col("id") == 0, Decimal("100.00")).otherwise(Decimal("0.00")).cast("decimal(38,2)").alias("line_revenue"),
    )
    assert analytics.kpis(fact).first()["avg_line_value"] == Decimal("0.00")


def test_second_seed_checks_references(spark, layers):
    import sample
    from tillbook.plans import jobs
    from tillbook.sources import landing
    from tillbook.streaming import OrderFeed

    unknown = {"order_id": "2000", "customer_id": "999", "product_id": "104", "quantity": "1",
               "order_ts": "2024-05-22 12:00:00", "status": "COMPLETED"}
    for _ in range(2):
        sample.land(spark, layers)
        landing.insert_rows(spark, layers, "orders", [unknown])
        OrderFeed(spark, layers).seed()
        orders = layers.staged_orders(spark).read()
        assert orders.count() == 15 and orders.filter("order_id = 2000").isEmpty()
        jobs.set_up(spark, layers)


def test_star_is_of_one_refresh(spark, layers, monkeypatch):
    import sample
    from tillbook.plans import jobs
    from tillbook.sources import VersionedTable

    sample.land(spark, layers)
    jobs.seed_orders(spark, layers)
    jobs.refresh_marts(spark, layers)
    read = VersionedTable.read

    def refreshed_meanwhile(table, state=None):
        if table.path.endswith("fct_sales"):
            table.overwrite(read(table).unionAll(read(table)), facts={"orders_unique": False})
        return read(table, state)

    monkeypatch.setattr(VersionedTable, "read", refreshed_meanwhile)
    star = jobs.load_star(spark, layers)
    assert star.orders_unique and star.fact.count() == star.fact.select("order_id").distinct().count()


def test_roots_with_quotes_and_relative_roots(spark, tmp_path, monkeypatch):
    import os

    import sample
    from tillbook.plans import jobs
    from tillbook.sources import Layers

    for root in (f"{tmp_path}/o'neil", os.path.relpath(f"{tmp_path}/relative")):
        os.makedirs(root)
        layers = Layers(root, order_buckets=3)
        sample.land(spark, layers)
        jobs.seed_orders(spark, layers)
        table = layers.staged_orders(spark)
        assert table.read().count() == 15 and table.state()["buckets"] == 3
        assert all(os.path.isdir(f"{root}/stg/orders/data/{folder}") for folder in table.state()["folders"])


def test_old_versions_go_by_themselves(spark, tmp_path, monkeypatch):
    from tillbook.sources import VersionedTable, files, tables

    monkeypatch.setattr(tables, "KEPT_VERSIONS", 3)
    table = VersionedTable(spark, f"{tmp_path}/t")
    for n in range(7):
        table.overwrite(spark.range(n))
    assert len(files.list_names(spark, f"{table.path}/commits")) == 4
    assert table.read().count() == 6
