"""Quotients that are rounded once."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

_WHOLE = "decimal(38,0)"


def rounded_quotient(dividend: Column, divisor: Column, digits: int) -> Column:
    """Decimal quotient rounded half up to ``digits``; NULL for a divisor of 0.

    A decimal division rounds to a few digits by itself, and rounding that again can miss the nearest value. The exact
    remainder decides instead.
    """
    divisor = F.nullif(divisor, F.lit(0))
    scaled = dividend * F.lit(Decimal(10**digits))
    rest = scaled % divisor
    whole = ((scaled - rest) / divisor).cast(_WHOLE)
    away = F.when(2 * F.abs(rest) >= F.abs(divisor), F.signum(scaled) * F.signum(divisor)).otherwise(0).cast(_WHOLE)
    return (whole + away).cast(_WHOLE) * F.lit(Decimal(1).scaleb(-digits))
