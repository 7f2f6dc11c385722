"""Column functions: Column in, Column out, all of them built on native Spark expressions."""

from tillbook.functions.casts import to_number, try_date, try_decimal, try_number, try_timestamp
from tillbook.functions.dates import days_between
from tillbook.functions.ordering import ASC, DESC, SortKey, ascending, descending, directed
from tillbook.functions.text import lower_trimmed, null_tokens, title_case, title_trimmed, upper_trimmed

__all__ = [
    "ASC",
    "DESC",
    "SortKey",
    "ascending",
    "days_between",
    "descending",
    "directed",
    "lower_trimmed",
    "null_tokens",
    "title_case",
    "title_trimmed",
    "to_number",
    "try_date",
    "try_decimal",
    "try_number",
    "try_timestamp",
    "upper_trimmed",
]
