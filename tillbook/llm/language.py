"""Language of documents by a linear-chain conditional random field over their words.

Every word gets a language: its affixes, n-grams and the word itself score each language, and learned transitions score
neighbours. Forward-backward gives each word's probabilities, so texts that switch languages are labelled word by word;
a document's language is the one with the most expected words.

Labels are per document. Training chains put labelled documents one after the other, so that the model also sees
switches. It runs on the driver over a sample of bounded size, whole chains side by side; scoring runs in tasks, documents of
similar length side by side.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillbook.llm.common import fold

FOLDS = 4
HELD_OUT = 2
UNKNOWN = "und"

#: The sample: so many pieces of documents and, on average, characters at most, from each language at its share of the whole.
#: Languages with fewer than LEAST of these are sampled up to it, all together at most as much again.
MOST_PIECES = 3000
MOST_CHARS = 6_000_000
PIECE = 20_000
LEAST = 60

BUCKETS = 1 << 17
CHAINS = 128
ROUNDS = 14
RATE = 0.4
DECAY = 1e-6

#: Words in a group of documents scored side by side, padding included; words whose scores a task keeps.
GROUP = 400_000
MOST_WORDS = 300_000

_WORD = re.compile(r"[^\W\d_]+")


def words_of(text: str | None) -> list[str]:
    """Runs of letters, in lower case."""
    return _WORD.findall(text.lower()) if text else []


def traits(word: str) -> list[int]:
    """Hashed features: the word, its beginnings and ends, its bigrams and trigrams."""
    framed = f"^{word}$"
    found = {f"w{word}"}
    found.update(f"p{word[:n]}" for n in (1, 2, 3))
    found.update(f"s{word[-n:]}" for n in (1, 2, 3))
    found.update(framed[i : i + n] for n in (2, 3) for i in range(len(framed) - n + 1))
    return [zlib.crc32(x.encode()) % BUCKETS for x in found]


@dataclass
class Field:
    """Weights of features (buckets x languages) and of transitions (languages x languages, log)."""

    languages: list[str]
    features: np.ndarray
    transitions: np.ndarray

    def emissions(self, words: list[str]) -> np.ndarray:
        """Scores of languages for each word, as positive factors with largest value 1."""
        found = [traits(word) for word in words]
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        flat = np.fromiter((x for own in found for x in own), np.int64, int(sizes.sum()))
        scores = np.add.reduceat(self.features[flat], np.cumsum(sizes) - sizes, axis=0)
        return factors(scores)


def factors(scores: np.ndarray) -> np.ndarray:
    return np.exp(np.clip(scores - scores.max(axis=-1, keepdims=True), -40, 0)).astype(np.float32)


def marginals(emissions: np.ndarray, move: np.ndarray, lengths: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(t, probabilities, pairs) from the last position to the first, for chains (time, chain, language).

    Chains come longest first, so those that have a position t are the first few. ``pairs`` are the joint
    probabilities of t and t + 1 summed over chains. Values are scaled at each position, which cancels out.
    """
    active = np.searchsorted(-lengths, -np.arange(len(emissions)), side="left")  # chains longer than t
    forward = np.empty_like(emissions)
    now = emissions[0] / emissions[0].sum(axis=1, keepdims=True)
    forward[0] = now
    for t in range(1, len(emissions)):
        now = (now[: active[t]] @ move) * emissions[t, : active[t]]
        now /= now.sum(axis=1, keepdims=True)
        forward[t, : active[t]] = now
    back = np.ones_like(emissions[0])
    for t in range(len(emissions) - 1, -1, -1):
        k, pairs = active[t], None
        if t + 1 < len(emissions) and (after := active[t + 1]):
            ahead = back[:after] * emissions[t + 1, :after]
            joint = forward[t, :after, :, None] * move * ahead[:, None, :]
            joint /= joint.sum(axis=(1, 2), keepdims=True)
            pairs = joint.sum(axis=0)
            new = ahead @ move.T
            back[:after] = new / new.sum(axis=1, keepdims=True)
        here = forward[t, :k] * back[:k]
        yield t, here / here.sum(axis=1, keepdims=True), pairs


def train(samples: list[tuple[str, list[str]]]) -> Field:
    """A field fitted to (language, words) in the order given, by adaptive gradient ascent on the likelihood."""
    languages = sorted({language for language, _ in samples})
    number = {language: k for k, language in enumerate(languages)}
    vocabulary: dict[str, int] = {}
    tokens = np.array([vocabulary.setdefault(w, len(vocabulary)) for _, words in samples for w in words], np.int64)
    labels = np.repeat([number[x] for x, _ in samples], [len(words) for _, words in samples]).astype(np.int64)
    count = len(languages)
    features = np.zeros((BUCKETS, count), np.float32)
    transitions = np.zeros((count, count))
    if not len(tokens):
        return Field(languages, features, transitions)
    found = [traits(word) for word in vocabulary]
    sizes = np.fromiter(map(len, found), np.int64, len(found))
    flat = np.fromiter((x for own in found for x in own), np.int64, int(sizes.sum()))
    starts, owner = np.cumsum(sizes) - sizes, np.repeat(np.arange(len(sizes)), sizes)
    steps = -(-len(tokens) // max(1, min(CHAINS, len(tokens) // 50)))
    chains = -(-len(tokens) // steps)
    lengths = np.minimum(steps, len(tokens) - steps * np.arange(chains))
    places = np.arange(steps)[:, None] + steps * np.arange(chains)[None, :]
    inside = np.minimum(places, len(tokens) - 1)
    target = np.zeros((len(vocabulary), count))
    np.add.at(target, (tokens, labels), 1.0)
    seen = np.zeros((count, count))
    same_chain = np.arange(1, len(tokens)) % steps != 0
    np.add.at(seen, (labels[:-1][same_chain], labels[1:][same_chain]), 1.0)
    feature_power, move_power = np.full((BUCKETS, 1), 1e-6), 1e-6
    for _ in range(ROUNDS):
        scores = np.add.reduceat(features[flat], starts, axis=0)
        emissions = factors(scores)[tokens[inside]]
        expected, pairs = np.zeros((len(vocabulary), count)), np.zeros((count, count))
        found_at = np.empty((steps, chains, count))
        for t, probability, joint in marginals(emissions, np.exp(transitions), lengths):
            found_at[t, : len(probability)] = probability
            if joint is not None:
                pairs += joint
        real = places < len(tokens)
        for k in range(count):
            expected[:, k] = np.bincount(tokens[inside][real], found_at[..., k][real], minlength=len(vocabulary))
        slope_of_word = target - expected
        slope = np.stack([np.bincount(flat, slope_of_word[owner, k], minlength=BUCKETS) for k in range(count)], axis=1)
        slope -= DECAY * len(tokens) * features
        feature_power += (slope**2).sum(axis=1, keepdims=True)
        features += (RATE * slope / np.sqrt(feature_power)).astype(np.float32)
        difference = seen - pairs
        move_power += (difference**2).sum()
        transitions += difference / np.sqrt(move_power)
    return Field(languages, features, transitions)


def pieces(docs: DataFrame) -> DataFrame:
    """The labelled documents outside the held-out fold as (lang, doc_id, piece, chars), long ones as several pieces."""
    known = docs.select("doc_id", "text", "lang").filter(fold("doc_id", FOLDS) != HELD_OUT)
    known = known.filter("lang IS NOT NULL AND text IS NOT NULL")
    last = F.greatest(F.lit(0), F.floor((F.length("text") - 1) / PIECE)).cast("int")
    return known.withColumn("piece", F.explode(F.sequence(F.lit(0), last)))


def fit(docs: DataFrame) -> Field:
    """A field from a sample of the labelled documents outside the held-out fold, chosen and ordered by a hash.

    Documents are sampled in pieces, so none is too long. The number of languages is taken to be small, as the
    transitions are its square.
    """
    cut = pieces(docs)
    size = F.least(F.lit(PIECE), F.length("text") - F.col("piece") * PIECE)
    sizes = cut.groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.sum(size).alias("chars")).collect()
    shares = _shares({row["lang"]: (row["n"], row["chars"]) for row in sizes})
    if not shares:
        return train([])
    share = F.element_at(F.create_map(*[F.lit(x) for pair in shares.items() for x in pair]), F.col("lang"))
    at = F.xxhash64(F.lit(17), "doc_id", "piece")
    chosen = cut.filter(F.pmod(at, F.lit(1 << 30)) < share)
    text = F.substring("text", F.col("piece") * PIECE + 1, F.lit(PIECE)).alias("text")
    rows = chosen.select("lang", "doc_id", "piece", text, F.xxhash64(F.lit(5), "doc_id").alias("at"))
    rows = rows.orderBy("at", "doc_id", "piece", "text").collect()
    return train([(row["lang"], words_of(row["text"])) for row in rows])


def _shares(sizes: dict[str, tuple[int, int]]) -> dict[str, int]:
    """Of 2^30, how much of each language (pieces, characters) is sampled."""
    number, chars = (sum(x) for x in zip(*sizes.values(), strict=True)) if sizes else (0, 0)
    common = min(1.0, MOST_PIECES / max(1, number), MOST_CHARS / max(1, chars))
    least = min(LEAST, MOST_PIECES / max(1, len(sizes)), MOST_CHARS / PIECE / max(1, len(sizes)))
    return {lang: int(min(1.0, max(common, least / n)) * (1 << 30)) for lang, (n, _) in sizes.items()}


class Tagger:
    """Expected words of each language in documents; keeps the scores of words it has met."""

    def __init__(self, field: Field):
        self.field = field
        self.move = np.exp(field.transitions).astype(np.float32)
        self.known: dict[str, int] = {}
        self.table = np.zeros((0, len(field.languages)), np.float32)

    def ids(self, texts: list[list[str]]) -> list[np.ndarray]:
        if len(self.known) > MOST_WORDS:
            self.known, self.table = {}, self.table[:0]
        new = [w for w in set().union(*texts) if w not in self.known]
        if new:
            self.known.update(zip(new, range(len(self.known), len(self.known) + len(new)), strict=True))
            self.table = np.concatenate((self.table, self.field.emissions(new)))
        known = self.known
        return [np.fromiter((known[w] for w in words), np.int32, len(words)) for words in texts]

    def expected(self, texts: list[list[str]]) -> np.ndarray:
        """Mean probability of each language over the words of each text; zeros without words."""
        out = np.zeros((len(texts), len(self.field.languages)))
        ids = self.ids(texts)
        lengths = np.fromiter(map(len, ids), np.int64, len(ids))
        order = np.argsort(-lengths, kind="stable")
        order = order[lengths[order] > 0]
        at = 0
        while at < len(order):
            longest = int(lengths[order[at]])
            end = at + max(1, GROUP // longest)
            group = order[at:end]
            group = group[lengths[group] * 2 + 64 >= longest]  # not too much padding
            tokens = np.zeros((longest, len(group)), np.int32)
            for k, row in enumerate(group):
                tokens[: lengths[row], k] = ids[row]
            total = np.zeros((len(group), out.shape[1]))
            for _, probability, _ in self.backwards(self.table[tokens], lengths[group]):
                total[: len(probability)] += probability
            out[group] = total / lengths[group][:, None]
            at += len(group)
        return out

    def backwards(self, emissions: np.ndarray, lengths: np.ndarray):
        """``marginals`` without the pairs."""
        active = np.searchsorted(-lengths, -np.arange(len(emissions)), side="left")
        forward, move = emissions, self.move
        ahead = emissions.copy()
        now = forward[0]
        for t in range(1, len(emissions)):
            k = active[t]
            now = now[:k] @ move
            now *= emissions[t, :k]
            now /= now.sum(axis=1, keepdims=True)
            forward[t, :k] = now
        back, turned = np.ones_like(emissions[0]), move.T.copy()
        for t in range(len(emissions) - 1, -1, -1):
            k = active[t]
            if t + 1 < len(emissions):
                after = active[t + 1]
                new = (back[:after] * ahead[t + 1, :after]) @ turned
                new /= new.sum(axis=1, keepdims=True)
                back[:after] = new
            here = forward[t, :k] * back[:k]
            yield t, here / here.sum(axis=1, keepdims=True), None


def predictions(docs: DataFrame, field: Field | None = None) -> DataFrame:
    """doc_id, held_out, lang_pred and score, the mean probability of that language over the words.

    Reads doc_id and text, for learning lang as well. Texts that are null or have no letter are ``und`` with score 0, and
    so is everything if nothing could be learned. Null ids are not held out, and never learned from. Equal scores go to the
    language first in order. Rows may repeat; an empty table gives none.
    """
    field = field or fit(docs)

    def tag(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tagger = Tagger(field)
        for batch in batches:
            for start in range(0, batch.num_rows, 2000):
                part = batch.slice(start, 2000)
                texts = [words_of(text) for text in part.column(1).to_pylist()]
                texts = [words if any(map(_lettered, words)) else [] for words in texts]
                found = tagger.expected(texts) if field.languages else np.zeros((len(texts), 1))
                best = found.argmax(axis=1)
                named = [field.languages[k] if words and field.languages else UNKNOWN
                         for k, words in zip(best, texts, strict=True)]
                score = np.clip(found[np.arange(len(found)), best], 0.0, 1.0)
                columns = [part.column(0), pa.array(named, pa.string()), pa.array(score)]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "lang_pred", "score"])

    tagged = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        tag, "doc_id long, lang_pred string, score double"
    )
    held_out = F.coalesce(fold("doc_id", FOLDS) == HELD_OUT, F.lit(False)).alias("held_out")
    return tagged.select("doc_id", held_out, "lang_pred", "score")


def _lettered(word: str) -> bool:
    return any(map(str.isalpha, word))
