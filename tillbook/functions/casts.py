"""Failing and safe casts from landed text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillbook.schemas import NUMBER, TIMESTAMP

# The date layouts accepted besides ISO.
DATE_LAYOUTS = ("dd-MMM-yyyy", "MM/dd/yyyy")

# A whole ISO date, with or without a time of day. A cast alone would also take years, months and trailing text.
ISO = r"^\s*\d{4,}-\d{1,2}-\d{1,2}([ T]\d{1,2}:\d{1,2}(:\d{1,2}(\.\d+)?)?)?\s*$"


def to_number(text: Column) -> Column:
    """Whole number; text that is no number fails the job (under ANSI mode), NULL stays NULL."""
    return text.cast(NUMBER)


def try_number(text: Column) -> Column:
    """Whole number, fractions rounded half up; NULL where the text is no number."""
    return text.try_cast(NUMBER)


def try_decimal(text: Column, precision: int, scale: int) -> Column:
    """Fixed-point number; NULL where the text is no number or does not fit."""
    return text.try_cast(T.DecimalType(precision, scale))


def try_date(text: Column, layouts: Sequence[str] = DATE_LAYOUTS) -> Column:
    """ISO date, or one of ``layouts``; NULL where none fits. Later layouts run only where earlier ones fail."""
    iso = F.when(text.rlike(ISO), text.try_cast("date"))
    return F.coalesce(iso, *(F.try_to_date(text, layout) for layout in layouts))


def try_timestamp(text: Column) -> Column:
    """Timestamp without time zone; NULL where the text is none, or names a zone, which this type can't keep."""
    return F.when(text.rlike(ISO), text.try_cast(TIMESTAMP))
