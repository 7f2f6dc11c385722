"""Exact distinct counts of ids that can be stored and merged.

Ids that fit a long become bits, and rows of the same ids are merged by OR. ``id_bitmaps`` keeps a row of 4 KB per group and
bucket of 32,768 ids and suits ids that lie close together within a group; ``id_words`` keeps a row of one long per group and 64
ids, so it never takes more rows than there are ids. Wider ids keep a row of their own each. So a day counted once is not counted
again when days are added up.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_BUCKET, _BIT, _WIDE, _IDS = "_bucket", "_bit", "_wide", "_ids"
_WORD, _BITS = "_word", "_bits"
_LARGEST = (1 << 63) - 1


def _split(id_: Column) -> tuple[Column, Column]:
    """The id as a long, or else as it is."""
    fits = id_.cast("decimal(38,0)").between(F.lit(-_LARGEST), F.lit(_LARGEST))
    return F.when(fits, id_.cast("bigint")), F.when(~fits, id_)


def id_bitmaps(df: DataFrame, keys: Sequence[str], id_column: str, *aggregates: Column) -> DataFrame:
    """Per group and bucket the ids of whole-number column ``id_column`` and further aggregates of these rows.

    NULL ids set no bit but keep their group. Map tasks set the bits of their rows first, so a group with most rows
    arrives as one row per map task and bucket.
    """
    number, wide = _split(F.col(id_column))
    bits = {_BUCKET: F.bitmap_bucket_number(number), _BIT: F.bitmap_bit_position(number), _WIDE: wide}
    return df.withColumns(bits).groupBy(*keys, _BUCKET, _WIDE).agg(F.bitmap_construct_agg(_BIT).alias(_IDS), *aggregates)


def merged_bitmaps(parts: DataFrame, keys: Sequence[str], *aggregates: Column) -> DataFrame:
    """``id_bitmaps`` of several days or loads with one row per group of ``keys`` and bucket."""
    return parts.groupBy(*keys, _BUCKET, _WIDE).agg(F.bitmap_or_agg(_IDS).alias(_IDS), *aggregates)


def distinct_ids() -> Column:
    """Aggregate over merged rows: the number of different ids."""
    return F.coalesce(F.sum(F.bitmap_count(_IDS)), F.lit(0)) + F.count(_WIDE)


def id_words(df: DataFrame, keys: Sequence[str], id_column: str, *aggregates: Column) -> DataFrame:
    """``id_bitmaps`` with a long for 64 ids: ids spread thin take a short row each, which hash aggregation can hold.

    NULL ids set no bit but keep their group. Map tasks set the bits of their rows first.
    """
    number, wide = _split(F.col(id_column))
    word = F.shiftright(number, 6)
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), number.bitwiseAND(F.lit(63).cast("bigint")).cast("int"))
    bits = {_WORD: word, _BITS: bit, _WIDE: wide}
    return df.withColumns(bits).groupBy(*keys, _WORD, _WIDE).agg(F.bit_or(_BITS).alias(_BITS), *aggregates)


def merged_words(parts: DataFrame, keys: Sequence[str], *aggregates: Column) -> DataFrame:
    """``id_words`` of several days or loads with one row per group of ``keys`` and word."""
    return parts.groupBy(*keys, _WORD, _WIDE).agg(F.bit_or(_BITS).alias(_BITS), *aggregates)


def distinct_in_words() -> Column:
    """Aggregate over merged words: the number of different ids."""
    return F.coalesce(F.sum(F.bit_count(_BITS)), F.lit(0)) + F.count(_WIDE)
