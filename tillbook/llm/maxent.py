"""Language model: hashed maximum entropy with a softmax factored by classes.

A word's probability is that of its class times that within the class. The 1,024 most frequent tokens, the end among
them, form 16 classes of 64 by rank; all others belong to 16 classes by their last two bytes. Features are the
symbols of the last four words (skips), of the last two as a pair and of the last and the third as a pair, hashed to rows of
weights for the classes; rows for the words of a frequent class are hashed from feature and class. A symbol is a
frequent word or the class of a rare one. Within a rare class words share by their counts in all training documents.

Counts: documents go to chunks by their id, whose words are numbered once; a chunk sends its distinct words with counts to
buckets, which add up and answer each chunk. Training: every position of every document is an example; rounds of tasks add up gradients over a part
of the examples each, and the driver takes an adaptive step on weights of fixed size. Scoring: a chunk's tokens in
batches of numpy.
"""

from __future__ import annotations

import zlib
from collections.abc import Collection, Iterator
from dataclasses import dataclass, replace
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillbook.llm.common import fold, lean, lean_stream, shuffle_partitions, stored
from tillbook.llm.passages import _by, _from_planes, _planes, _prime

FOLDS = 5
HELD_OUT = 1

CLASSES = 16  # frequent ones, and as many rare ones
WIDTH = 64  # words of a frequent class
FREQUENT = CLASSES * WIDTH
NOTHING = FREQUENT + CLASSES  # the symbol before the first word

ROWS = 1 << 13
WITHIN_ROWS = 1 << 13
FEATURES = 7
WITHIN_FEATURES = 4

#: Rounds over all examples and parts of each; positions that go to a part together; step size.
EPOCHS = 2
PARTS = 8
STRETCH = 64
RATE = 0.6

#: Squared slope each weight starts with: weights that few examples touch move little.
PRIOR = 100.0

CHUNK_BYTES = 4 << 20
PIECE = 1 << 19  # tokens whose examples are laid out at a time
BATCH = 1 << 15  # positions whose slopes are added up at once
CUT = 1 << 12  # of a batch, so that its factors stay in the processor's cache
RUN = 16  # rows added up one after the other

#: Marks a symbol that stands in front of a stretch as history alone.
_BEFORE = np.uint16(1 << 15)

_HASH = np.uint64((1 << 60) - 1)


class _RareClass(dict):
    """Rare class of a word by its last two bytes, each computed once."""

    def __missing__(self, tail: bytes) -> int:
        self[tail] = zlib.crc32(tail) & 15
        return self[tail]


def word_key(word: bytes) -> int:
    """Hash of a word with its rare class in the upper four bits."""
    return int(word_keys([word])[0])


def word_keys(words: Collection[bytes]) -> np.ndarray:
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    rare = np.fromiter(map(_RareClass().__getitem__, [word[-2:] for word in words]), np.uint64, len(words))
    return hashes >> np.uint64(4) | rare << np.uint64(60)


def _as_bytes(words: pa.LargeStringArray) -> list[bytes]:
    words = words.cast(pa.large_binary())
    ends = np.frombuffer(words.buffers()[1], np.int64, len(words) + 1, 8 * words.offset).tolist()
    data = words.buffers()[2]
    data = data.to_pybytes() if data else b""
    return [data[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]


@dataclass
class Tokens:
    """Texts as numbers of distinct words in ``keys``; ``bounds`` tells texts apart. Ends are not among the tokens."""

    tokens: np.ndarray
    bounds: np.ndarray
    keys: np.ndarray

    @classmethod
    def of(cls, texts: pa.ChunkedArray) -> Tokens:
        words = pc.ascii_split_whitespace(pc.ascii_lower(texts.cast(pa.large_string()).combine_chunks()))
        bounds = np.concatenate(([0], np.cumsum(pc.fill_null(pc.list_value_length(words), 0).to_numpy()))).astype(np.int64)
        encoded = words.flatten().dictionary_encode()
        tokens, distinct = encoded.indices.to_numpy(), _as_bytes(encoded.dictionary)
        if b"" in distinct:  # before or after white space that begins or ends a text, or is all of it
            empty = distinct.index(b"")
            bounds = np.concatenate(([0], np.cumsum(tokens != empty)))[bounds]
            tokens = tokens[tokens != empty]
            tokens = tokens - (tokens > empty)
            del distinct[empty]
        return cls(tokens, bounds, word_keys(distinct))

    def with_ends(self, of_word: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
        """A value for each token with ``end`` after each text, and where texts begin."""
        texts = len(self.bounds) - 1
        out = np.full(len(self.tokens) + texts, end, of_word.dtype)
        at = np.arange(len(self.tokens)) + np.repeat(np.arange(texts), np.diff(self.bounds))
        out[at] = of_word[self.tokens]
        return out, self.bounds + np.arange(texts + 1)


@dataclass(frozen=True)
class Corpus:
    """What the model knows of the training documents' words."""

    tokens: int  # with ends
    distinct: int  # with the end
    documents: int
    frequent: np.ndarray  # keys by rank; the end is symbol 0, these are 1 and up
    frequent_counts: np.ndarray
    rare_counts: np.ndarray  # by rare class
    rare_distinct: np.ndarray

    def symbols(self, keys: np.ndarray) -> np.ndarray:
        order = np.argsort(self.frequent)
        at = np.searchsorted(self.frequent[order], keys)
        found = np.zeros(len(keys), bool)
        inside = at < len(order)
        found[inside] = self.frequent[order][at[inside]] == keys[inside]
        out = FREQUENT + (keys >> np.uint64(60)).astype(np.int64)
        out[found] = order[at[found]] + 1
        return out

    def base(self, counts: np.ndarray) -> np.ndarray:
        """log10 probability of tokens with these counts, by counts alone."""
        return np.log10((counts + 0.5) / (self.tokens + 0.5 * (self.distinct + 1)))


@dataclass(frozen=True)
class Model:
    corpus: Corpus
    classes: np.ndarray  # (ROWS, 2 * CLASSES)
    within: np.ndarray  # (WITHIN_ROWS, WIDTH)

    @classmethod
    def start(cls, corpus: Corpus) -> Model:
        """Weights that give words by their counts: all in the features that are always there."""
        counts = np.zeros(FREQUENT)
        counts[0] = corpus.documents
        counts[1 : 1 + len(corpus.frequent)] = corpus.frequent_counts
        by_class = counts.reshape(CLASSES, WIDTH)
        classes = np.zeros((ROWS, 2 * CLASSES), np.float32)
        classes[0] = np.log(np.concatenate((by_class.sum(axis=1), corpus.rare_counts)) + 0.5)
        within = np.zeros((WITHIN_ROWS, WIDTH), np.float32)
        within[:CLASSES] = np.log(by_class + 0.5)
        return cls(corpus, classes, within)

    @cached_property
    def factors(self) -> tuple[np.ndarray, np.ndarray]:
        """What each weight multiplies an outcome by."""
        return _factors(self.classes), _factors(self.within)


def _factors(weights: np.ndarray) -> np.ndarray:
    """exp of weights, each row less its middle, which leaves probabilities alone.

    A weight moves by ``RATE`` a step at most, 9.6 in all, and starts within 15 of the middle for up to 10 ** 12 tokens,
    so that products over seven rows stay within exp(83) and exp(-83), in the range of 32 bits.
    """
    middle = (weights.max(axis=1, keepdims=True) + weights.min(axis=1, keepdims=True)) / 2
    return np.exp(weights - middle)


def features(history: np.ndarray) -> np.ndarray:
    """(n, FEATURES) rows from (n, 4) symbols of the words before, nearest first; row 0 is always there."""
    out = np.zeros((FEATURES, len(history)), np.int64)  # a feature's rows lie together
    for k in range(4):
        np.take(_SINGLES[k], history[:, k], out=out[k + 1], mode="clip")
    p = np.ascontiguousarray(history[:, :3].T).astype(np.uint64)
    for k, (b, salt) in enumerate(((p[1], 11), (p[2], 13)), start=5):
        with np.errstate(over="ignore"):
            out[k] = _hashed_row((p[0] * np.uint64(2654435761) + b + np.uint64(salt)) * np.uint64(0xD6E8FEB86659FD93))
    return out.T


def _hashed_row(x: np.ndarray) -> np.ndarray:
    """A row other than the first."""
    x = (x ^ x >> np.uint64(29)) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(32)
    return (x.astype(np.uint32) % np.uint32(ROWS - 1)).astype(np.int64) + 1


def _single_rows(k: int) -> np.ndarray:
    """Rows of each symbol as the word ``k`` places before the last."""
    with np.errstate(over="ignore"):
        x = np.arange(NOTHING + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return _hashed_row(x + np.uint64(k * 0x632BE59BD9B4E019 % 2**64))


_SINGLES = [_single_rows(k) for k in range(4)]


def within_rows(rows: np.ndarray, of_class: np.ndarray) -> np.ndarray:
    """(n, WITHIN_FEATURES) rows for words of a class: its own, then hashes with the first features."""
    hashed = (rows[:, 1:WITHIN_FEATURES].T * CLASSES + of_class) * 2654435761 >> 7
    return np.concatenate((of_class[None], hashed % (WITHIN_ROWS - CLASSES) + CLASSES)).T


def _products(factors: np.ndarray, rows: np.ndarray, out: np.ndarray | None = None) -> np.ndarray:
    """Products of rows of factors: in proportion to the probabilities."""
    if out is None:
        out = np.empty((len(rows), factors.shape[1]), factors.dtype)
    for at in range(0, len(rows), CUT):
        cut, own = rows[at : at + CUT], out[at : at + CUT]
        np.take(factors, cut[:, 0], axis=0, out=own, mode="clip")
        more = np.empty_like(own)
        for k in range(1, rows.shape[1]):
            own *= np.take(factors, cut[:, k], axis=0, out=more, mode="clip")
    return out


def _sums(products: np.ndarray) -> np.ndarray:
    return products @ np.ones(products.shape[1], products.dtype)


def _places_of(target: np.ndarray, width: int) -> np.ndarray:
    """Where the outcomes lie in a flat array of rows of ``width``."""
    return np.arange(0, len(target) * width, width) + target


def _log_softmax_at(factors: np.ndarray, rows: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Log probability of one outcome of each row."""
    total = _products(factors, rows)
    own = np.take(total.ravel(), _places_of(target, total.shape[1]))
    return np.log(own.astype(np.float64)) - np.log(_sums(total).astype(np.float64))


def histories(symbols: np.ndarray, place: np.ndarray, at: np.ndarray) -> np.ndarray:
    """(n, 4) symbols before the positions ``at``, within their texts; ``place``: their places in these."""
    out = np.full((len(at), 4), NOTHING, np.int64)
    for k in range(4):
        inside = np.flatnonzero(place > k)
        out[inside, k] = symbols[at[inside] - k - 1]
    return out


def _places(begins: np.ndarray) -> np.ndarray:
    return np.arange(begins[-1] - begins[0]) - np.repeat(begins[:-1] - begins[0], np.diff(begins))


def log_probabilities(model: Model, history: np.ndarray, symbols: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """log10 of each word's probability; ``counts`` are those of rare words in the training documents."""
    corpus, out = model.corpus, np.zeros(len(symbols))
    for at in range(0, len(symbols), BATCH):
        cut = slice(at, at + BATCH)
        rows, target = features(history[cut]), symbols[cut]
        common = target < FREQUENT
        of_class = np.where(common, target // WIDTH, target - FREQUENT + CLASSES)
        found = _log_softmax_at(model.factors[0], rows, of_class)
        inner = within_rows(rows[common], of_class[common])
        found[common] += _log_softmax_at(model.factors[1], inner, target[common] % WIDTH)
        rare = of_class[~common] - CLASSES
        total = corpus.rare_counts[rare] + 0.5 * (corpus.rare_distinct[rare] + 1)
        found[~common] += np.log((counts[cut][~common] + 0.5) / total)
        out[cut] = found / np.log(10)
    return out


def gradient(model: Model, examples: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Slopes of the log likelihood of examples (n, 5): four symbols before, and the word's."""
    classes, within = np.zeros_like(model.classes), np.zeros_like(model.within)
    add_gradient(classes, within, model, examples)
    return classes, within


def add_gradient(classes: np.ndarray, within: np.ndarray, model: Model, examples: np.ndarray) -> None:
    for at in range(0, len(examples), BATCH):
        part = examples[at : at + BATCH]
        by_second = np.argsort(part[:, 1], kind="stable")
        part = part[by_second[np.argsort(part[by_second, 0], kind="stable")]].astype(np.int64)  # shared rows lie together
        rows, target = features(part[:, :4]), part[:, 4]
        common = target < FREQUENT
        of_class = np.where(common, target // WIDTH, target - FREQUENT + CLASSES)
        slope = _slope(model.factors[0], rows, of_class)
        classes[0] += np.ones(len(slope), slope.dtype) @ slope
        _add(classes, rows[:, 1:], slope)
        inner = within_rows(rows[common], of_class[common])
        _add(within, inner, _slope(model.factors[1], inner, target[common] % WIDTH))


def _slope(factors: np.ndarray, rows: np.ndarray, target: np.ndarray) -> np.ndarray:
    """What happened less what was expected."""
    out = np.empty((len(rows), factors.shape[1]), factors.dtype)
    for at in range(0, len(rows), CUT):
        own = _products(factors, rows[at : at + CUT], out[at : at + CUT])
        own *= (-1 / _sums(own))[:, None]
    out.ravel()[_places_of(target, out.shape[1])] += 1
    return out


def _add(total: np.ndarray, rows: np.ndarray, slope: np.ndarray) -> None:
    """Add each row of ``slope`` to the rows of ``total`` that its features name."""
    if not rows.size:
        return
    flat = rows.T.astype(np.uint16 if len(total) <= 1 << 16 else np.int64).ravel()
    order = np.argsort(flat, kind="stable")
    named = flat[order]
    first = np.flatnonzero(np.concatenate(([True], named[1:] != named[:-1])))
    size = np.diff(np.concatenate((first, [len(named)])))
    total[named[first]] += _run_sums(slope, order - order // len(rows) * len(rows), first, size)


def _run_sums(values: np.ndarray, source: np.ndarray, first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Sum of ``values[source[a : a + n]]`` for each ``first`` a and ``size`` n.

    Long runs are cut into those of ``RUN``; the first rows of all are added at once, then the second, and so on.
    """
    pieces = (size + RUN - 1) // RUN
    of_run = np.cumsum(pieces) - pieces
    begin = np.arange(0, RUN * int(pieces.sum()), RUN) + np.repeat(first - RUN * of_run, pieces)
    left = np.minimum(np.repeat(first + size, pieces) - begin, RUN)
    by_size = np.argsort((RUN - left).astype(np.uint16), kind="stable")
    begin = begin[by_size]
    longer = np.cumsum(np.bincount(left, minlength=RUN + 1)[::-1])[::-1]  # pieces of k rows and more
    sums = np.take(values, source[begin], axis=0, mode="clip")
    more = np.empty((CUT, values.shape[1]), values.dtype)
    for k in range(1, RUN):
        for at in range(0, int(longer[k + 1]), CUT):
            end = min(at + CUT, int(longer[k + 1]))
            own = np.take(values, source[begin[at:end] + k], axis=0, mode="clip", out=more[: end - at])
            sums[at:end] += own
    place = np.empty(len(by_size), np.int64)
    place[by_size] = np.arange(len(by_size))
    out = np.take(sums, place[of_run], axis=0, mode="clip")
    long = np.flatnonzero(pieces > 1)
    if len(long):
        out[long] = _run_sums(sums, place, of_run[long], pieces[long])
    return out


def _chunked(docs: DataFrame, chunks: int) -> DataFrame:
    chunk = F.coalesce(F.pmod("doc_id", F.lit(chunks)), F.lit(0)).cast("long").alias("chunk")
    learns = F.coalesce(fold("doc_id", FOLDS) != HELD_OUT, F.lit(False)).alias("learns")
    return docs.select(F.col("doc_id").cast("long"), "text").select(chunk, "doc_id", learns, "text")


def _bucket(keys: np.ndarray, buckets: int) -> np.ndarray:
    return ((keys & _HASH) % np.uint64(buckets)).astype(np.int64)


_TOKENIZED = {
    "chunk": pa.int64(), "ids": pa.list_(pa.int64()), "learns": pa.list_(pa.bool_()), "bounds": pa.list_(pa.int64()),
    "tokens": pa.binary(), "keys": pa.binary(),
}


def _tokenized(docs: DataFrame) -> DataFrame:
    """A row for each chunk: its documents and their words as places in the chunk's sorted keys."""

    def number(table: pa.Table) -> pa.Table:
        found = Tokens.of(table.column("text"))
        order = np.argsort(found.keys)
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        row = (
            table.column("chunk")[0].as_py(), table.column("doc_id").to_pylist(), table.column("learns").to_pylist(),
            found.bounds, _planes(place[found.tokens]), found.keys[order].tobytes(),
        )
        return pa.table({n: pa.array([value], kind) for value, (n, kind) in zip(row, _TOKENIZED.items(), strict=True)})

    schema = "chunk long, ids array<long>, learns array<boolean>, bounds array<long>, tokens binary, keys binary"
    return docs.groupBy("chunk").applyInArrow(lean(number), schema)


def _tokens_in(rows: pa.RecordBatch | pa.Table, k: int) -> tuple[Tokens, pa.Array, np.ndarray]:
    """Words, ids and whether they are learned from, of the documents of a chunk."""
    ids, learns, bounds, tokens, keys = (rows.column(name)[k] for name in list(_TOKENIZED)[1:])
    found = Tokens(
        _from_planes(tokens.as_py()), bounds.values.to_numpy(), np.frombuffer(keys.as_py(), np.uint64)
    )
    return found, ids.values, learns.values.to_numpy(zero_copy_only=False).astype(bool)


def _counted(tokenized: DataFrame, buckets: int) -> DataFrame:
    """Answers (chunk, bucket, counts of the chunk's words in order) and, by bucket, sums and its most frequent words."""
    request = {"bucket": pa.int64(), "chunk": pa.int64(), "keys": pa.binary(), "counts": pa.binary()}

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                found, _, learns = _tokens_in(batch, k)
                learned = found.tokens[np.repeat(learns, np.diff(found.bounds))]
                counts = np.bincount(learned, minlength=len(found.keys))
                chunk = batch.column("chunk")[k].as_py()
                parts = list(_by(_bucket(found.keys, buckets)))
                rows = [(b, chunk, found.keys[own].tobytes(), _planes(counts[own])) for b, own in parts]
                columns = [pa.array([r[j] for r in rows], kind) for j, kind in enumerate(request.values())]
                yield pa.RecordBatch.from_arrays(columns, names=list(request))

    reply = {
        "chunk": pa.int64(), "bucket": pa.int64(), "counts": pa.binary(), "n": pa.int64(), "rare": pa.int32(),
        "distinct": pa.int64(), "keys": pa.binary(),
    }

    def answer(table: pa.Table) -> pa.Table:
        asked = table.to_pylist()
        keys = [np.frombuffer(row["keys"], np.uint64) for row in asked]
        distinct, number = np.unique(np.concatenate(keys), return_inverse=True)
        own = np.concatenate([_from_planes(row["counts"]) for row in asked])
        totals = np.bincount(number, own, minlength=len(distinct)).astype(np.int64)
        bucket, rows, at = asked[0]["bucket"], [], 0
        for row, part in zip(asked, keys, strict=True):
            answers = _planes(totals[number[at : at + len(part)]])
            rows.append((row["chunk"], bucket, answers, None, None, None, None))
            at += len(part)
        best = _most_frequent(distinct, totals)
        rows.append((None, None, totals[best].tobytes(), None, None, None, distinct[best].tobytes()))
        rare = (distinct >> np.uint64(60)).astype(np.int64)
        for k in range(CLASSES):
            here = totals[rare == k]
            rows.append((None, None, None, int(here.sum()), k, int((here > 0).sum()), None))
        return pa.table({n: pa.array([r[k] for r in rows], kind) for k, (n, kind) in enumerate(reply.items())})

    asked = tokenized.mapInArrow(lean_stream(ask), "bucket long, chunk long, keys binary, counts binary")
    schema = "chunk long, bucket long, counts binary, n long, rare int, distinct long, keys binary"
    return asked.groupBy("bucket").applyInArrow(answer, schema)


def _most_frequent(keys: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Places of the most frequent words, those that can be among the frequent ones of all."""
    best = np.lexsort((keys.view(np.int64), -counts))[:FREQUENT]
    return best[counts[best] > 0]


def _candidates(counted: DataFrame) -> DataFrame:
    """(key, n) of each task's most frequent words."""

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        for batch in batches:
            for more_keys, more in zip(*(batch.column(k).to_pylist() for k in (0, 1)), strict=True):
                keys = np.concatenate((keys, np.frombuffer(more_keys, np.uint64)))
                counts = np.concatenate((counts, np.frombuffer(more, np.int64)))
                best = _most_frequent(keys, counts)
                keys, counts = keys[best], counts[best]
        yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(counts)], names=["key", "n"])

    return counted.filter("keys IS NOT NULL").select("keys", "counts").mapInArrow(merged, "key long, n long")


def _corpus(docs: DataFrame, counted: DataFrame) -> Corpus:
    documents = docs.filter("learns").count()
    top = _candidates(counted).orderBy(F.desc("n"), "key").limit(FREQUENT - 1).collect()
    sums = counted.filter("rare IS NOT NULL").groupBy("rare").agg(F.sum("n").alias("n"), F.sum("distinct").alias("d"))
    counts, distinct = np.zeros(CLASSES), np.zeros(CLASSES)
    for row in sums.collect():
        counts[row["rare"]], distinct[row["rare"]] = row["n"], row["d"]
    keys = np.array([row["key"] for row in top], np.int64).view(np.uint64)
    n = np.array([row["n"] for row in top], np.float64)
    rare = (keys >> np.uint64(60)).astype(np.int64)
    corpus = Corpus(
        int(counts.sum()) + documents, int(distinct.sum()) + (documents > 0), documents, keys, n, counts, distinct
    )
    less = np.bincount(rare, n, minlength=CLASSES), np.bincount(rare, minlength=CLASSES)
    return replace(corpus, rare_counts=counts - less[0], rare_distinct=distinct - less[1])


def stretches(symbols: np.ndarray, begins: np.ndarray, ids: np.ndarray) -> Iterator[tuple[int, bytes]]:
    """(part, symbols) of all positions: stretches of a text, each behind the four symbols before it, marked."""
    place = _places(begins)
    first = np.flatnonzero(place % STRETCH == 0)
    size = np.diff(np.concatenate((first, [len(symbols)])))
    of_text = np.repeat(np.arange(len(ids)), np.diff(begins))[first]
    with np.errstate(over="ignore"):
        mixed = ids.astype(np.uint64)[of_text] * np.uint64(0x9E3779B97F4A7C15) + place[first].astype(np.uint64)
        part = (mixed * np.uint64(0xD6E8FEB86659FD93) >> np.uint64(40)) % np.uint64(PARTS)
    begin = first + 4 * np.arange(len(first))
    out = np.empty(len(symbols) + 4 * len(first), "<u2")
    out[np.arange(len(symbols)) + np.repeat(4 * np.arange(1, len(first) + 1), size)] = symbols
    out[begin[:, None] + np.arange(4)] = histories(symbols, place[first], first)[:, ::-1].astype("<u2") | _BEFORE
    part = np.repeat(part, size + 4)
    for k in np.unique(part).tolist():
        yield int(k), out[part == k].tobytes()


def examples_in(blob: bytes) -> np.ndarray:
    """Examples (n, 5) of stretches: four symbols before, nearest first, and the position's own."""
    stream = np.frombuffer(blob, "<u2")
    at = np.flatnonzero(stream < _BEFORE)
    return np.stack([*(stream[at - k] & ~_BEFORE for k in (1, 2, 3, 4)), stream[at]], axis=1)


def _examples(docs: DataFrame, corpus: Corpus) -> DataFrame:
    """(part, examples) of all positions of all training documents, tokenized or not."""

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                found, ids, learns = _tokens_in(batch, row)
                symbols, begins = found.with_ends(corpus.symbols(found.keys), 0)
                own = np.flatnonzero(learns)
                # some megabytes of texts at a time
                for texts in np.split(own, np.searchsorted(begins[own], np.arange(PIECE, begins[-1], PIECE))):
                    sizes = np.diff(begins)[texts]
                    of_own = np.concatenate(([0], np.cumsum(sizes))).astype(np.int64)
                    at = np.repeat(begins[texts] - of_own[:-1], sizes) + np.arange(of_own[-1])
                    parts = list(stretches(symbols[at], of_own, ids.take(pa.array(texts)).to_numpy(zero_copy_only=False)))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([k for k, _ in parts], pa.int32()), pa.array([x for _, x in parts], pa.binary())],
                        names=["part", "examples"],
                    )

    if "tokens" not in docs.columns:
        docs = _tokenized(docs.withColumn("chunk", F.lit(0).cast("long")))
    return docs.mapInArrow(lean_stream(pick), "part int, examples binary")


def train(corpus: Corpus, examples: DataFrame) -> Model:
    """Rounds of gradients, added up over tasks, each over a part of the examples; steps as in adaptive gradient ascent."""
    model = Model.start(corpus)
    power = [np.full_like(model.classes, PRIOR), np.full_like(model.within, PRIOR)]
    shapes = [model.classes.shape, model.within.shape]
    for step in range(EPOCHS * PARTS):
        now = model

        def slopes(batches: Iterator[pa.RecordBatch], now: Model = now) -> Iterator[pa.RecordBatch]:
            total = [np.zeros(shape, np.float32) for shape in shapes]
            for batch in batches:
                for blob in batch.column(0).to_pylist():
                    add_gradient(*total, now, examples_in(blob))
            yield pa.RecordBatch.from_arrays(
                [pa.array([0, 1], pa.int32()), pa.array([x.tobytes() for x in total], pa.binary())],
                names=["table", "slope"],
            )

        def added(table: pa.Table) -> pa.Table:
            blobs = (np.frombuffer(x.as_py(), np.float32) for x in table.column("slope"))
            return pa.table({"table": table.column("table")[:1], "slope": pa.array([sum(blobs).tobytes()], pa.binary())})

        part = examples.filter(F.col("part") == step % PARTS).select("examples")
        tasks = max(1, min(shuffle_partitions(examples.sparkSession), 16))
        sums = part.coalesce(tasks).mapInArrow(slopes, "table int, slope binary")
        slope = {r["table"]: np.frombuffer(r["slope"], np.float32) for r in
                 sums.groupBy("table").applyInArrow(added, "table int, slope binary").collect()}
        if not slope:  # no examples in this part
            continue
        weights = []
        for k, old in enumerate((model.classes, model.within)):
            own = slope[k].reshape(shapes[k])
            power[k] += own**2
            weights.append(old + RATE * own / np.sqrt(power[k]))
        model = Model(corpus, *weights)
    return model


def scores(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of each text.

    Reads doc_id and text alone. Null texts are empty: their only token is the end. Null ids are not held out, and never learned
    from. Without training documents every token has count 0. Rows may repeat; an empty table gives none.
    """
    spark = docs.sparkSession
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(shuffle_partitions(spark), size // (16 * CHUNK_BYTES) + 1)
    chunked = _chunked(docs, _prime(max(shuffle_partitions(spark), size // CHUNK_BYTES + 1)))
    tokenized = stored(_tokenized(chunked), "tokenized")
    counted = stored(_counted(tokenized, buckets), "counted")
    corpus = _corpus(chunked, counted)
    model = train(corpus, stored(_examples(tokenized, corpus), "examples"))
    shared = spark.sparkContext.broadcast(model)  # weights of fixed size and 1,024 words: about 3 MB

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        model = shared.value
        corpus = model.corpus
        found, ids, _ = _tokens_in(left, 0)
        counts = np.zeros(len(found.keys), np.int64)
        answers = {row["bucket"]: row["counts"] for row in right.select(["bucket", "counts"]).to_pylist()}
        for bucket, own in _by(_bucket(found.keys, buckets)):
            counts[own] = _from_planes(answers[bucket])
        per_token, begins = found.with_ends(counts, corpus.documents)
        symbols, _ = found.with_ends(corpus.symbols(found.keys), 0)
        own = np.empty(len(symbols))
        for a, b in _spans(begins):
            cut = slice(begins[a], begins[b])
            at = np.arange(begins[b] - begins[a])
            history = histories(symbols[cut], _places(begins[a : b + 1]), at)
            own[cut] = log_probabilities(model, history, symbols[cut], per_token[cut])
        total = lambda x: np.add.reduceat(x, begins[:-1])  # noqa: E731  each text has its end at least
        return pa.table({
            "doc_id": ids,
            "n_tokens": pa.array(np.diff(begins)),
            "n_known": pa.array(total((per_token > 0).astype(np.int64))),
            "base_score": pa.array(total(corpus.base(per_token))),
            "score": pa.array(total(own)),
        })

    answers = counted.filter("chunk IS NOT NULL").select("chunk", "bucket", "counts")
    schema = "doc_id long, n_tokens long, n_known long, base_score double, score double"
    scored = tokenized.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(score, schema)
    held_out = F.coalesce(fold("doc_id", FOLDS) == HELD_OUT, F.lit(False)).alias("held_out")
    known = F.lit(corpus.tokens).cast("long").alias("train_tokens")
    return scored.select("doc_id", held_out, "n_tokens", "n_known", known, "base_score", "score")


def _spans(begins: np.ndarray, most: int = 1 << 17) -> Iterator[tuple[int, int]]:
    """Runs of texts of about ``most`` tokens."""
    a, texts = 0, len(begins) - 1
    while a < texts:
        b = max(a + 1, int(np.searchsorted(begins, begins[a] + most, side="right")) - 1)
        yield a, min(b, texts)
        a = min(b, texts)
