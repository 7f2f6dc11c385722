"""Relational operators: DataFrames and parameters in, a DataFrame out."""

from tillbook.operators.distinct import distinct_ids, distinct_in_words, id_bitmaps, id_words, merged_bitmaps, merged_words
from tillbook.operators.latest import latest_per_key
from tillbook.operators.merge import merge_newest, merge_rows
from tillbook.operators.ranking import global_ntile, global_ntiles, global_position, global_rank
from tillbook.operators.references import keep_valid_refs
from tillbook.operators.totals import moving_average, row_counts, share_of_total

__all__ = [
    "distinct_ids",
    "distinct_in_words",
    "global_ntile",
    "global_ntiles",
    "global_position",
    "global_rank",
    "id_bitmaps",
    "id_words",
    "keep_valid_refs",
    "latest_per_key",
    "merge_newest",
    "merge_rows",
    "merged_bitmaps",
    "merged_words",
    "moving_average",
    "row_counts",
    "share_of_total",
]
