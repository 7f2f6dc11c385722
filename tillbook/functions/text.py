"""Text cleaning."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Field contents that mean "no value".
NULL_TOKENS = ("", "NULL")

# The characters, besides white space, after which a new word starts.
WORD_BREAKS = r"""!?@"^#$&~_,.:;+-*%/|\[](){}<>"""

_BREAK_CLASS = r"\s" + "".join("\\" + char for char in WORD_BREAKS)


def null_tokens(text: Column, tokens: Sequence[str] = NULL_TOKENS) -> Column:
    """NULL for each of ``tokens``, the text itself otherwise."""
    return F.when(~text.isin(*tokens), text)


def title_case(text: Column) -> Column:
    """Capital at each word start, small letters after it; words also end at punctuation.

    ``initcap`` breaks words at blanks only and is enough for most values. Only a value that holds another break
    is cut into runs of word characters and runs of breaks, which are capitalised one by one.
    """
    runs = F.regexp_extract_all(text, F.lit(f"([^{_BREAK_CLASS}]+|[{_BREAK_CLASS}]+)"), F.lit(0))
    by_run = F.array_join(F.transform(runs, F.initcap), "")
    return F.when(text.rlike(f"[{_BREAK_CLASS}&&[^ ]]"), by_run).otherwise(F.initcap(text))


def title_trimmed(text: Column) -> Column:
    return title_case(F.trim(text))


def lower_trimmed(text: Column) -> Column:
    return F.lower(F.trim(text))


def upper_trimmed(text: Column) -> Column:
    return F.upper(F.trim(text))
