"""Raw text to clean, typed, unique rows."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillbook.functions import (
    descending,
    lower_trimmed,
    title_trimmed,
    to_number,
    try_date,
    try_decimal,
    try_number,
    try_timestamp,
    upper_trimmed,
)
from tillbook.operators import keep_valid_refs, latest_per_key
from tillbook.schemas import LINEAGE, LOADED_AT, PRICE, STG_ORDERS, TIMESTAMP
from tillbook.session import require_ansi

DEFAULT_QUANTITY = 1

#: Landed rows that a task sorts, some 550 bytes each with the path of their file.
TASK_ROWS = 1_500_000


def tasks_for(spark: SparkSession, rows: int) -> int:
    """Tasks that sort ``rows``: as many as run at once, and more where a task would get more than ``TASK_ROWS``."""
    return max(spark.sparkContext.defaultParallelism, -(-rows // TASK_ROWS))


def load_stamp(load_ts: datetime | None = None) -> Column:
    """The given load time, or now."""
    return F.localtimestamp() if load_ts is None else F.lit(load_ts).cast(TIMESTAMP)


def clean_customers(raw: DataFrame) -> DataFrame:
    """Typed customers with tidy names; rows without an id are dropped."""
    return (
        require_ansi(raw)
        .filter(F.col("customer_id").isNotNull())
        .select(
            to_number(F.col("customer_id")).alias("customer_id"),
            title_trimmed(F.col("first_name")).alias("first_name"),
            title_trimmed(F.col("last_name")).alias("last_name"),
            lower_trimmed(F.col("email")).alias("email"),
            title_trimmed(F.col("city")).alias("city"),
            title_trimmed(F.col("country")).alias("country"),
            try_date(F.col("signup_date")).alias("signup_date"),
        )
    )


def clean_products(raw: DataFrame) -> DataFrame:
    """Typed products; rows without an id are dropped, a price that is no number becomes NULL."""
    return (
        require_ansi(raw)
        .filter(F.col("product_id").isNotNull())
        .select(
            to_number(F.col("product_id")).alias("product_id"),
            F.trim(F.col("product_name")).alias("product_name"),
            title_trimmed(F.col("category")).alias("category"),
            try_decimal(F.col("unit_price"), PRICE.precision, PRICE.scale).alias("unit_price"),
        )
    )


def type_orders(raw: DataFrame) -> DataFrame:
    """Typed orders, copies included; load stamp and, where given, lineage are kept to choose among the copies."""
    return (
        require_ansi(raw)
        .filter(F.col("order_id").isNotNull())
        .select(
            to_number(F.col("order_id")).alias("order_id"),
            to_number(F.col("customer_id")).alias("customer_id"),
            to_number(F.col("product_id")).alias("product_id"),
            F.coalesce(try_number(F.col("quantity")), F.lit(DEFAULT_QUANTITY)).alias("quantity"),
            try_timestamp(F.col("order_ts")).alias("order_ts"),
            upper_trimmed(F.col("status")).alias("status"),
            LOADED_AT,
            *_lineage(raw),
        )
    )


def _lineage(raw: DataFrame) -> list[str]:
    return [name for name in LINEAGE.names if name in raw.columns]


def clean_orders(raw: DataFrame) -> DataFrame:
    """Typed orders, one row per order: the copy loaded last. Used by the batch seed and by the feed alike.

    Raw rows with lineage settle equal stamps by it: the copy of the last file by path, and the last line in it, wins; a
    row that was not read from a file yields to one that was. Such rows are wide, and are counted first (by the footers
    of the landed files) so that no task sorts more of them the more there are.
    """
    lineage = _lineage(raw)
    order = [descending(LOADED_AT), *(F.desc_nulls_last(name) for name in lineage)]
    tasks = tasks_for(raw.sparkSession, raw.count()) if lineage else None
    return latest_per_key(type_orders(raw), ["order_id"], order, tasks).drop(LOADED_AT, *lineage)


def valid_orders(
    orders: DataFrame, customers: DataFrame, products: DataFrame, among: DataFrame | None = None
) -> DataFrame:
    """Orders whose customer and product both exist. ``among``: typed orders with at least the same references."""
    return keep_valid_refs(orders, (customers, "customer_id"), (products, "product_id"), among=among)


def stamped(orders: DataFrame, load_ts: datetime | None = None) -> DataFrame:
    """Clean orders in the shape of the staged table."""
    return orders.withColumn(LOADED_AT, load_stamp(load_ts)).select(*STG_ORDERS.names)


def seed_orders(
    raw_orders: DataFrame, customers: DataFrame, products: DataFrame, load_ts: datetime | None = None
) -> DataFrame:
    """First content of the staged orders. The copy is chosen first: a bad newest copy removes its order."""
    valid = valid_orders(clean_orders(raw_orders), customers, products, among=type_orders(raw_orders))
    return stamped(valid, load_ts)
