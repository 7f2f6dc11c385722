"""Small helpers that several operators share."""

from __future__ import annotations

import ctypes
import os
from collections.abc import Callable, Iterator
from functools import wraps
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillbook.session import scratch_path

# A word is a run of bytes other than space, tab, line feed, vertical tab, form feed and carriage return.
WORD = r"[^\x20\x09-\x0D]+"

#: Bytes a Python worker may hold before it looks for free ones to give back. A new one has about 112 MB.
MOST_HELD = 160 << 20


def give_back() -> None:
    """Return what a worker has freed to the system if it holds much.

    Spark deals tasks to all idle workers in turn, so each would keep what its largest task ever took.
    """
    try:
        with open("/proc/self/statm") as sizes:
            held = int(sizes.read().split()[1]) * os.sysconf("SC_PAGE_SIZE")
        if held > MOST_HELD:
            pa.default_memory_pool().release_unused()
            ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # systems without these keep what they freed
        return


def lean_stream(stream: Callable[[Iterator[Any]], Iterator[Any]]) -> Callable[[Iterator[Any]], Iterator[Any]]:
    """``stream`` for ``mapInArrow``; its worker gives memory back at the end."""

    @wraps(stream)
    def run(batches: Iterator[Any]) -> Iterator[Any]:
        yield from stream(batches)
        give_back()

    return run


def lean(function: Callable[..., pa.Table]) -> Callable[..., pa.Table]:
    """``function`` of a group for ``applyInArrow``; its worker gives memory back after each."""

    def run_two(left: pa.Table, right: pa.Table) -> pa.Table:
        found = function(left, right)
        give_back()
        return found

    def run_one(group: pa.Table) -> pa.Table:
        found = function(group)
        give_back()
        return found

    return run_two if function.__code__.co_argcount == 2 else run_one


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def word_count(text: Column) -> Column:
    """Number of words; 0 for a null text."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)).cast("long"), F.lit(0).cast("long"))


def byte_words(text: str | None) -> list[bytes]:
    """The words of a text with A-Z in lower case; ``bytes`` methods treat just the ASCII ranges meant here."""
    return text.encode().lower().split() if text else []


def fold(doc_id: str, parts: int) -> Column:
    """Remainder of crc32 of the id as text; null for a null id."""
    return F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(parts))


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read again: lineage ends here and survives a lost executor."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def packed(df: DataFrame) -> Column:
    """All columns as one struct ``row``, so that no name in it clashes with those of an operator."""
    return F.struct(*[F.col(f"`{name}`") for name in df.columns]).alias("row")


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def sample_below(df: DataFrame, key: str, rows: int, most: int, seed: int = 17) -> DataFrame:
    """About ``most`` of ``rows`` rows, chosen by a hash of ``key`` and thus the same ones in each run."""
    if rows <= most:
        return df
    share = int(most / rows * (1 << 30))
    return df.filter(F.pmod(F.xxhash64(F.lit(seed), key), F.lit(1 << 30)) < share)
