"""Packing documents into sequences of fixed length: tokens, pieces, and a best-fit packing by exact complements.

Tasks cut token ids into pieces; only the lengths' histogram, one number for each length up to the sequence length,
reaches the driver. There ``plan`` fills sequences exactly: for each length, longest first, it looks up the gap in the
index of single lengths, of pair sums and of triple sums, and takes a combination as often as the counts allow. What
has no exact partner is placed by best fit. The plan is a list of patterns (lengths, times), of a size that depends on the sequence
length alone, and pieces find their place in it by their rank among those of their length.
"""

from __future__ import annotations

import base64
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillbook.llm.common import lean_stream, stored

SEQUENCE = 1024
END = 2
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
SPECIAL = "<|endoftext|>"

#: Parts of a length for ranking: a rank is the size of the parts before plus the place within one.
BUCKETS = 1024

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


@cache
def encoders(tokenizer: str, ranks: str):
    """Two encoders of one vocabulary; the second, several times as fast, does not know special tokens in a text."""
    import tiktoken
    from tokenizers import Tokenizer

    with open(ranks, "rb") as lines:
        table = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={})
    return Tokenizer.from_file(tokenizer), fast


def token_ids(text: str | None, tokenizer: str = TOKENIZER, ranks: str = RANKS) -> list[int]:
    """Ids of a text without special tokens added, then the end id; a null text is empty."""
    full, fast = encoders(tokenizer, ranks)
    text = text or ""
    ids = full.encode(text, add_special_tokens=False).ids if SPECIAL in text else fast.encode_ordinary(text)
    return [*ids, END]


def cuts(n: int, longest: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n ids: one if it fits, else full ones after a first of what remains."""
    first = n % longest or longest
    return [(0, first)] + [(start, longest) for start in range(first, n, longest)]


def pieces(docs: DataFrame, longest: int = SEQUENCE, with_ids: bool = False) -> DataFrame:
    """A row for each piece of each document, with its ids where wanted."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns: dict[str, list] = {name: [] for name in ("doc_id", "piece", "start", "length", "ids_crc32", "ids")}
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = np.array(token_ids(text.as_py()), dtype="<u4")
                for number, (start, length) in enumerate(cuts(len(ids), longest)):
                    part = ids[start : start + length]
                    row = (doc_id, number, start, length, zlib.crc32(part.tobytes()), part.tolist() if with_ids else None)
                    for column, value in zip(columns.values(), row, strict=True):
                        column.append(value)
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32()))
            arrays = [pa.array(x, kind) for x, kind in zip(columns.values(), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays[: 5 + with_ids], names=list(columns)[: 5 + with_ids])

    ids = ", ids array<int>" if with_ids else ""
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(lean_stream(cut), PIECES + ids)


def _fill(counts: np.ndarray, longest: int, take, sums: int) -> None:
    """Fill gaps exactly: by single lengths for all lengths first, then by pairs, then by triples, up to ``sums``."""
    for length in range(longest, 0, -1):
        gap = longest - length
        if gap == 0 or counts[gap]:
            take((length, gap) if gap else (length,))
    for length in range(longest - 2, 0, -1) if sums > 1 else ():
        while counts[length] and (pair := _pair(counts, longest - length)) and take((length, *pair)):
            pass
    for length in range(longest - 3, 0, -1) if sums > 2 else ():
        gap, first = longest - length, 1
        while counts[length] and first <= gap // 3:
            pair = _pair(counts, gap - first, first) if counts[first] else None
            if pair is None or not take((length, first, *pair)):
                first += 1


def _pair(counts: np.ndarray, total: int, least: int = 1) -> tuple[int, int] | None:
    """Two available lengths of that sum, the longer as long as can be, neither below ``least``."""
    low = np.arange(least, total // 2 + 1)
    found = np.flatnonzero((counts[low] > 0) & (counts[total - low] > (low == total - low)))
    return (int(total - low[found[0]]), int(low[found[0]])) if len(found) else None


def plan(counts: np.ndarray, longest: int = SEQUENCE) -> list[tuple[tuple[int, ...], int]]:
    """Patterns (lengths, times) that use each length as often as ``counts[length]`` says, each of ``longest`` at most.

    Exact triples can use up short lengths that best fit would need later, so the plan is made with sums of up to one,
    two and three lengths, and the one with the fewest sequences is taken.
    """
    plans = [_plan(counts.copy(), longest, sums) for sums in (1, 2, 3)]
    return min(plans, key=lambda patterns: sum(times for _, times in patterns))


def _plan(counts: np.ndarray, longest: int, sums: int) -> list[tuple[tuple[int, ...], int]]:
    patterns: Counter = Counter()

    def take(lengths: tuple[int, ...]) -> int:
        times = min(int(counts[x]) // n for x, n in Counter(lengths).items())
        for x in lengths:
            counts[x] -= times
        if times:
            patterns[lengths] += times
        return times

    _fill(counts, longest, take, sums)
    gaps: dict[int, Counter] = defaultdict(Counter)  # what is left in open sequences
    for length in range(longest, 0, -1):
        left = int(counts[length])
        for gap in sorted(g for g in gaps if g >= length):
            for lengths, times in list(gaps[gap].items()):
                for each in range(gap // length, 0, -1):
                    some = min(times, left // each)
                    if some:
                        gaps[gap][lengths] -= some
                        gaps[gap - each * length][lengths + (length,) * each] += some
                        left, times = left - some * each, times - some
        room = longest // length
        for each in (room, left % room):
            if some := left // each if each else 0:
                gaps[longest - each * length][(length,) * each] += some
                left -= some * each
    for open_ones in gaps.values():
        patterns.update({lengths: times for lengths, times in open_ones.items() if times})
    return sorted(patterns.items(), reverse=True)


def _places(patterns: list[tuple[tuple[int, ...], int]], longest: int) -> dict[int, tuple[np.ndarray, ...]]:
    """For each length: first ranks of its spans, with the first sequence and the offset of each."""
    spans, used, sequence = defaultdict(list), Counter(), 0
    for lengths, times in patterns:
        offset = 0
        for x in lengths:
            spans[x].append((used[x], sequence, offset))
            used[x] += times
            offset += x
        sequence += times
    return {x: tuple(np.array(column) for column in zip(*rows, strict=True)) for x, rows in spans.items()}


def pack(cut: DataFrame, longest: int = SEQUENCE) -> DataFrame:
    """``cut`` (materialised; doc_id, piece, start, length, ids_crc32, more) with sequence_id and offset."""
    bucket = F.pmod(F.xxhash64("doc_id", "piece"), F.lit(BUCKETS))
    rows = cut.withColumn("bucket", bucket)
    sizes = rows.groupBy("length", "bucket").agg(F.count(F.lit(1)).alias("n"))
    counts = np.zeros(longest + 1, dtype=np.int64)
    for row in sizes.groupBy("length").agg(F.sum("n").alias("n")).collect():  # longest rows at most
        counts[row["length"]] = row["n"]
    places = _places(plan(counts, longest), longest)
    earlier = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("length", "bucket", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    own = Window.partitionBy("length", "bucket").orderBy("doc_id", "piece", "ids_crc32")
    ranked = rows.withColumn("place", F.row_number().over(own) - 1).join(starts, ["length", "bucket"])
    ranked = ranked.withColumn("rank", (F.col("before") + F.col("place")).cast("long"))

    @F.pandas_udf("struct<sequence_id: long, offset: long>")
    def place(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        sequence, offset = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
        ranks, lengths = rank.to_numpy(), length.to_numpy()
        for x in np.unique(lengths):
            first, base, at = places[int(x)]
            here = np.flatnonzero(lengths == x)
            span = np.searchsorted(first, ranks[here], side="right") - 1
            sequence[here] = base[span] + ranks[here] - first[span]
            offset[here] = at[span]
        return pd.DataFrame({"sequence_id": sequence, "offset": offset})

    placed = ranked.withColumn("at", place("length", "rank"))
    return placed.select(*cut.columns, "at.sequence_id", "at.offset")


def best_fit(docs: DataFrame, longest: int = SEQUENCE, with_ids: bool = False) -> DataFrame:
    """Pieces of all documents with the sequence and the offset each goes to.

    Reads doc_id and text alone. A null or empty text is one piece, the end id. Null ids and repeated rows are
    documents like others. Equal lengths are told apart by rank, so ties need no rule. An empty table gives none.
    """
    return pack(stored(pieces(docs, longest, with_ids), "pieces"), longest)
