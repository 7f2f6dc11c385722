"""SimHash near-duplicates, found by fuzzy hashing with the binary Golay code.

A fingerprint of 64 bits is cut into three segments. Two fingerprints that differ in at most two bits have a segment without
errors whose successor (in a circle) has at most one: the errors (2,0,0), (1,1,0) and their turns leave no other
case. So a key is a segment as it is, with a codeword index of the next one. Each 23-bit word lies within distance 3 of
just one codeword of the Golay code; a word at distance 3 gets the indices of the five codewords at distance 4 as
well. Words that differ in one bit then always share an index. Fingerprints with a common key are verified by their
bits. Everything after the fingerprints works on distinct ones, so a group of copies is one row.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillbook.llm.common import byte_words, lean_stream, stored
from tillbook.llm.components import components

SHINGLE = 3
SEED = 42
MOST_BITS = 2

#: Generator polynomial of the [23, 12, 7] code, and the segments (first bit, bits) of a fingerprint.
GENERATOR = 0b110001110101
SEGMENTS = ((0, 22), (22, 21), (43, 21))

#: Rows of a key compared in one group; a key with more is cut into tiles, and each pair of tiles is a group.
TILE = 1024

_SLICE = 1 << 16


def fingerprint(text: str | None, size: int = SHINGLE) -> int:
    """SimHash of the word shingles, repeats included; 0 without words. A bit is set if over half the hashes have it."""
    words = byte_words(text)
    if not words:
        return 0
    size = min(size, len(words))
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))[: len(words) - size + 1]
    ends = ends[size - 1 :]
    ones, digest = np.zeros(64, np.int64), xxhash.xxh64_intdigest
    for at in range(0, len(starts), _SLICE):
        spans = zip(starts[at : at + _SLICE].tolist(), ends[at : at + _SLICE].tolist(), strict=True)
        hashes = np.array([digest(line[a:b], SEED) for a, b in spans], dtype="<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(ones * 2 > len(starts), bitorder="little")
    return int(bits.view("<u8")[0])


def fingerprints(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """doc_id and fingerprint (its bits as a long) of each document."""

    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = [fingerprint(text.as_py(), size) for text in batch.column(1)]
            signed = pa.array(np.array(prints, dtype=np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column(0), signed], names=["doc_id", "print"])

    rows = docs.select(F.col("doc_id").cast("long"), "text")
    return rows.mapInArrow(lean_stream(take), "doc_id long, print long")


@cache
def _errors() -> np.ndarray:
    """For each syndrome: the error of at most 3 bits, and for those of 3 the five errors of 4 bits; -1 fills up."""

    def syndrome(word: np.ndarray) -> np.ndarray:
        for bit in range(22, 10, -1):
            word = np.where(word >> bit & 1, word ^ GENERATOR << (bit - 11), word)
        return word

    table, used = np.full((2048, 6), -1, np.int64), np.zeros(2048, np.int64)
    for weight in range(5):
        errors = np.array([sum(1 << bit for bit in bits) for bits in combinations(range(23), weight)], np.int64)
        for error, found in zip(errors.tolist(), syndrome(errors).tolist(), strict=True):
            table[found, used[found]] = error
            used[found] += 1
    return table


def codewords(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, index) of all codewords that 23-bit words decode to."""
    rest = words.copy()
    for bit in range(22, 10, -1):
        rest = np.where(rest >> bit & 1, rest ^ GENERATOR << (bit - 11), rest)
    errors = _errors()[rest]
    row, column = np.nonzero(errors >= 0)
    return row, (words[row] ^ errors[row, column]) >> 11


def keys(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, key) of all keys of fingerprints."""
    bits = prints.view(np.uint64)
    segments = [((bits >> np.uint64(at)) & np.uint64((1 << n) - 1)).astype(np.int64) for at, n in SEGMENTS]
    rows, found = [], []
    for turn, exact in enumerate(segments):
        row, index = codewords(segments[(turn + 1) % 3])
        rows.append(row)
        found.append(np.int64(turn) << 40 | exact[row] << 12 | index)
    return np.concatenate(rows), np.concatenate(found)


def forest(group: np.ndarray, prints: np.ndarray, most: int) -> list[tuple[int, int]]:
    """Links that span what is linked within each group of sorted group numbers; pairs are compared, not kept."""
    parent = np.arange(len(group))

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    links, bits = [], prints.view(np.uint64)
    left = np.arange(len(group) - 1)
    for step in range(1, len(group)):
        left = left[left + step < len(group)]
        left = left[group[left] == group[left + step]]
        if not len(left):
            break
        right = left + step
        near = (parent[left] != parent[right]) & (np.bitwise_count(bits[left] ^ bits[right]) <= most)
        for a, b in zip(left[near].tolist(), right[near].tolist(), strict=True):
            root, other = find(a), find(b)
            if root != other:
                parent[max(root, other)] = min(root, other)
                links.append((int(prints[a]), int(prints[b])))
    return links


def _links(prints: DataFrame, most: int) -> DataFrame:
    """Edges (a, b) that connect distinct fingerprints just as all links do."""

    def spread(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            values = batch["print"].to_numpy()
            row, key = keys(values)
            yield pd.DataFrame({"key": key, "print": values[row]})

    def verified(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kept = None
        for batch in batches:
            rows = batch if kept is None else pd.concat([kept, batch])
            number = rows.groupby(["key", "i", "j"], sort=False).ngroup().to_numpy()
            open_from = int(np.searchsorted(number, number[-1]))
            kept = rows.iloc[open_from:]
            yield edges(number[:open_from], rows["print"].to_numpy()[:open_from])
        if kept is not None:
            yield edges(np.zeros(len(kept), np.int64), kept["print"].to_numpy())

    def edges(number: np.ndarray, values: np.ndarray) -> pd.DataFrame:
        return pd.DataFrame(forest(number, values, most), columns=["a", "b"], dtype="int64")

    keyed = prints.mapInPandas(lean_stream(spread), "key long, print long")
    sizes = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    tiles = F.ceil(F.col("n") / TILE).cast("int")
    shared = keyed.join(sizes, "key").withColumn("tiles", tiles)
    shared = shared.withColumn("tile", F.pmod(F.xxhash64("print"), F.col("tiles")).cast("int"))
    shared = shared.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    grouped = shared.select(
        "key", F.least("tile", "other").alias("i"), F.greatest("tile", "other").alias("j"), "print"
    )
    grouped = grouped.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
    return grouped.mapInPandas(lean_stream(verified), "a long, b long")


def near_duplicates(docs: DataFrame, size: int = SHINGLE, most: int = MOST_BITS) -> DataFrame:
    """doc_id, fingerprint (hex) and component_id, the smallest doc_id reachable over links of ``most`` bits (2 at most).

    Reads doc_id and text alone. Texts without words have fingerprint 0 and link like others. Null ids take part and
    are never a component_id, unless all ids of a component are null. Rows may repeat. An empty table gives none.
    """
    if most > MOST_BITS:
        raise ValueError("the keys are exact up to 2 differing bits")
    prints = stored(fingerprints(docs, size), "prints")
    distinct = stored(prints.groupBy("print").agg(F.min("doc_id").alias("first")), "distinct")
    roots = components(_links(distinct.select("print"), most))
    named = distinct.join(roots.withColumnRenamed("node", "print"), "print", "left")
    named = named.withColumn("root", F.coalesce("root", "print"))
    least = named.groupBy("root").agg(F.min("first").alias("component_id"))
    named = named.select("print", "root").join(least, "root").select("print", "component_id")
    hexed = F.lpad(F.lower(F.hex("print")), 16, "0").alias("fingerprint")
    return prints.join(named, "print").select("doc_id", hexed, "component_id")


def one_of_each(docs: DataFrame, size: int = SHINGLE, most: int = MOST_BITS) -> DataFrame:
    """The documents without their near-duplicates: of each component the one with the smallest id, all columns kept.

    Rows of one id are one document; the smallest text stays. Rows without an id are kept once for each text.
    """
    found = near_duplicates(docs, size, most)
    lost = found.groupBy("doc_id").agg(F.min("component_id").alias("c")).filter("doc_id <> c").select("doc_id")
    kept = docs.join(lost, "doc_id", "left_anti").select(*docs.columns)
    unnamed = F.when(F.col("doc_id").isNull(), F.xxhash64("text"))
    rows = kept.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), "doc_id", "text", unnamed.alias("unnamed")
    )
    first = F.row_number().over(Window.partitionBy("doc_id", "unnamed").orderBy("text"))
    return rows.withColumn("place", first).filter("place = 1").select("row.*")
