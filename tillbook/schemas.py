"""Declared schemas of every layer. Nothing is ever inferred from the data."""

from pyspark.sql import types as T

NUMBER = T.DecimalType(38, 0)
PRICE = T.DecimalType(10, 2)
TIMESTAMP = T.TimestampNTZType()

LOADED_AT = "_loaded_at"

# Where a landed row comes from: its file, the block of it and the place among the rows of one task.
LINEAGE = T.StructType(
    [
        T.StructField("_source_file", T.StringType()),
        T.StructField("_source_block", T.LongType()),
        T.StructField("_source_row", T.LongType()),
    ]
)


def _raw(*names: str) -> T.StructType:
    """Landing tables hold text only, so that no value can break a load, plus the load stamp."""
    text = [T.StructField(name, T.StringType()) for name in names]
    return T.StructType([*text, T.StructField(LOADED_AT, TIMESTAMP)])


RAW = {
    "customers": _raw("customer_id", "first_name", "last_name", "email", "city", "country", "signup_date"),
    "products": _raw("product_id", "product_name", "category", "unit_price"),
    "orders": _raw("order_id", "customer_id", "product_id", "quantity", "order_ts", "status"),
}

STG_ORDERS = T.StructType(
    [
        T.StructField("order_id", NUMBER),
        T.StructField("customer_id", NUMBER),
        T.StructField("product_id", NUMBER),
        T.StructField("quantity", NUMBER),
        T.StructField("order_ts", TIMESTAMP),
        T.StructField("status", T.StringType()),
        T.StructField(LOADED_AT, TIMESTAMP),
    ]
)


def text_columns(table: str) -> list[str]:
    """The columns a source file of ``table`` carries."""
    return [field.name for field in RAW[table] if field.name != LOADED_AT]
