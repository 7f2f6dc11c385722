"""One row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillbook.functions import descending

_RN = "_rn"
_SHARE = "_share"

#: Tasks that the rows of one key are dealt to at most, if their number of tasks is given.
SHARES = 16


def latest_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], tasks: int | None = None
) -> DataFrame:
    """The first row of each key by ``order``; ties go to the largest remaining columns, so the choice is fixed.

    The ``_rn = 1`` filter lets Spark limit each key to one row per map task before the shuffle, so a key with a
    large share of all rows reaches its reducer as one row per map task.

    That sorts all rows of a map task, which a split of well-compressed files has many of. With ``tasks`` rows are dealt
    to so many by key first, and sorted only there; those of one key go to up to ``SHARES`` of them, each of which
    keeps one, before the key's task chooses.
    """
    values = [name for name in df.columns if name not in keys]
    rest = [descending(name) for name in values]
    if tasks is None:
        return _first(df, keys, [*order, *rest])
    share = F.pmod(F.xxhash64(*values), F.lit(SHARES)) if values else F.lit(0)
    dealt = df.withColumn(_SHARE, share).repartition(tasks, *keys, _SHARE)
    kept = _first(dealt, [*keys, _SHARE], [*order, *rest]).drop(_SHARE)
    return _first(kept.repartition(tasks, *keys), keys, [*order, *rest])


def _first(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(_RN, F.row_number().over(window)).filter(F.col(_RN) == 1).drop(_RN)
