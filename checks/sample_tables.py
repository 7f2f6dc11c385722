"""The given tables turned into raw retail tables: all text, with the kinds of dirt the staging layer removes.

Line items become orders; (order, line) pairs occur several times and so give copies. The modulo expressions plant
missing ids, values that cannot be parsed, and odd spellings; every row of every table is used. ``oracle.RAW_SQL``
states the same in SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillbook.schemas import LOADED_AT


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _text(column: str, kind: str = "bigint") -> Column:
    return F.col(column).cast(kind).cast("string")


def raw_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    place = (
        table(spark, sf_dir, "nation")
        .join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select("n_nationkey", "n_name", "r_name")
    )
    day = F.date_add(F.lit("2020-01-01").cast("date"), (key % 1000).cast("int"))
    signup = (
        F.when(key % 13 == 0, "not a date")
        .when(key % 17 == 0, F.date_format(day, "MM/dd/yyyy"))
        .when(key % 19 != 0, day.cast("string"))
    )
    return (
        table(spark, sf_dir, "customer")
        .join(place, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            F.when(key % 101 != 0, _text("c_custkey")).alias("customer_id"),
            F.concat(F.lit("  "), F.lower("c_mktsegment"), F.lit("-"), F.upper("r_name")).alias("first_name"),
            F.concat(F.lit("o'clerk "), (key % 40).cast("string"), F.lit(" ")).alias("last_name"),
            F.concat(F.col("c_mktsegment"), F.lit("."), _text("c_custkey"), F.lit("@Example.COM ")).alias("email"),
            F.col("n_name").alias("city"),
            F.lower("r_name").alias("country"),
            signup.alias("signup_date"),
            F.lit("2002-01-01 00:00:00").cast("timestamp_ntz").alias(LOADED_AT),
        )
    )


def raw_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("p_partkey")
    return table(spark, sf_dir, "part").select(
        F.when(key % 97 != 0, _text("p_partkey")).alias("product_id"),
        F.concat(F.lit(" "), F.col("p_name")).alias("product_name"),
        F.concat(F.lower("p_type"), F.lit("/"), (F.col("p_size") % 5).cast("string")).alias("category"),
        F.when(key % 89 == 0, "on request").otherwise(_text("p_retailprice", "decimal(10,2)")).alias("unit_price"),
        F.lit("2002-01-01 00:00:00").cast("timestamp_ntz").alias(LOADED_AT),
    )


def raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    supplier = F.col("l_suppkey")
    quantity = (
        F.when(supplier % 10 == 1, "n/a")
        .when(supplier % 10 == 2, F.concat(_text("l_quantity"), F.lit(".7")))
        .when(supplier % 10 != 0, _text("l_quantity"))
    )
    status = (
        F.when(F.col("o_orderstatus") == "P", "CANCELLED")
        .when(F.col("o_orderstatus") == "O", "Pending ")
        .otherwise(" completed")
    )
    return (
        table(spark, sf_dir, "lineitem")
        .join(table(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
        .select(
            F.when(F.col("l_orderkey") % 211 != 0, (F.col("l_orderkey") * 10 + F.col("l_linenumber")).cast("string"))
            .alias("order_id"),
            _text("o_custkey").alias("customer_id"),
            _text("l_partkey").alias("product_id"),
            quantity.alias("quantity"),
            F.when(supplier % 23 == 3, "soon").otherwise(F.col("o_orderdate").cast("string")).alias("order_ts"),
            status.alias("status"),
            F.col("l_shipdate").alias(LOADED_AT),
        )
    )
