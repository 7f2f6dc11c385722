"""Referential filter."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillbook.session import checkpointed

#: Ids that are sent to every executor at most, some 20 MB of them.
MOST_IDS = 200_000


def _few(ids: DataFrame, most: int) -> bool:
    return ids.limit(most + 1).count() <= most


def keep_valid_refs(
    df: DataFrame, *references: tuple[DataFrame, str], among: DataFrame | None = None, most: int = MOST_IDS
) -> DataFrame:
    """Rows of ``df`` whose value in each named column exists in that column of the paired table; NULL is dropped.

    A table of few ids is sent to the rows. Beside a large one the unknown ids are found first, from the distinct ids
    of ``among`` (``df`` unless given: any rows that hold all its ids and are cheaper to compute), and the rows lose those;
    as long as they are few, the rows stay where they are. Only many unknown ids of a large table shuffle the rows.
    """
    for table, column in references:
        known = table.select(column)
        if _few(known, most):
            df = df.join(F.broadcast(known), column, "left_semi").select(*df.columns)
            continue
        wanted = (df if among is None else among).select(column).filter(F.col(column).isNotNull()).distinct()
        unknown = checkpointed(wanted.join(known, column, "left_anti"))
        if _few(unknown, most):
            present = df.filter(F.col(column).isNotNull())
            df = present.join(F.broadcast(unknown), column, "left_anti").select(*df.columns)
        else:
            df = df.join(known, column, "left_semi").select(*df.columns)
    return df
