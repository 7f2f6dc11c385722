"""Update-or-insert as a DataFrame operator."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillbook.operators.latest import latest_per_key

_ARRIVAL = "_arrival"


def merge_rows(target: DataFrame, source: DataFrame, key: str, among: DataFrame | None = None) -> DataFrame:
    """``target`` with each row of ``source`` replacing the row of the same key, or added if there is none.

    ``source`` holds one row per key. The target is only filtered: with a source below the broadcast threshold it
    is not shuffled at all. ``among``: rows with just the keys of ``source``, repeated or not, that are cheaper to compute.
    """
    untouched = target.join((source if among is None else among).select(key), key, "left_anti")
    return untouched.select(*target.columns).unionByName(source.select(*target.columns))


def merge_newest(target: DataFrame, *batches: DataFrame, key: str, stamp: str) -> DataFrame:
    """One row per key: that of the newest ``stamp`` over the target and all batches, whichever order they come in.

    Equal stamps go to the later batch, equal ones within a batch to the largest remaining columns; a row without a
    stamp yields to one that has it. All batches are merged by a single shuffle, which a key with most rows enters as
    one row per map task.
    """
    parts = (
        part.select(*target.columns).withColumn(_ARRIVAL, F.lit(number)) for number, part in enumerate((target, *batches))
    )
    order = [F.desc_nulls_last(stamp), F.desc(_ARRIVAL)]
    return latest_per_key(reduce(DataFrame.unionByName, parts), [key], order).drop(_ARRIVAL)
