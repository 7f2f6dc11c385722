"""Toxicity by a weighted finite-state grammar over clauses.

A lexicon transducer maps words to symbols with weights: insults, threats of harm, words that announce a threat, targets,
negations and words of reported speech. Insults are learned: words and word beginnings that labelled toxic
documents use far more often than others. Five transducers read the symbols of a clause together, each with
few states:

* insult: an insult scores its weight, more if it follows another one;
* threat: harm scores when something has announced it (will hurt), a little otherwise;
* target: what a clause scores counts more once it addresses somebody, whether before or after;
* negation: what follows within a few words counts less;
* reported speech: what follows the report counts less.

Their product is one transducer from states and symbols to states and factors. A clause's score is the sum along its path,
a document's the sum and the largest of its clauses, and a logistic curve fitted on other labelled documents makes a probability of
these.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillbook.llm.common import fold, sample_below, stored

FOLDS = 5
HELD_OUT = 0

#: Labelled documents the insults and the curve are learned from, at most.
MOST_LABELS = 40_000

#: An insult is in so many toxic documents at least, with such log odds against others.
LEAST_DOCUMENTS = 6
LEAST_ODDS = 2.5
PREFIXES = (4, 5, 6, 7)

OTHER, INSULT, HARM, ANNOUNCE, TARGET, NEGATION, REPORT, END = range(8)

# Words of the grammar in four languages.
WORDS: dict[int, str] = {
    INSULT: "idiot moron stupid loser scum trash pathetic worthless disgusting clown dumb fool jerk filth "
    "trottel dumm abschaum versager ekelhaft imbécile crétin ordure minable estúpido imbécil basura escoria",
    HARM: "kill hurt beat destroy burn shoot stab smash töten verletzen schlagen vernichten tuer frapper détruire "
    "brûler matar golpear destruir quemar",
    ANNOUNCE: "will shall gonna going must should werde werden sollte muss vais allons dois voy vamos debes",
    TARGET: "you your yours yourself u du dich dir dein euch ihr tu toi te vous votre tú usted ustedes vosotros",
    NEGATION: "not never no nobody without isn't aren't don't doesn't nicht nie kein keine ohne ne pas jamais sans "
    "nunca jamás sin",
    REPORT: "said says claimed called according quote quoted wrote told sagte sagt laut schrieb nannte dit selon "
    "appelé écrit dijo dice según escribió llamó",
}
SEED_WEIGHT = 2.0

_TOKEN = re.compile(r"[^\W_]+(?:['’][^\W_]+)*|[.!?;:\n]")
_ENDS = frozenset(".!?;:\n")


@dataclass(frozen=True)
class Transducer:
    """States are small numbers; ``step`` maps (state, symbol) to (state, factor, gain); what is absent stays as it is."""

    step: dict[tuple[int, int], tuple[int, float, float]]

    def move(self, state: int, symbol: int) -> tuple[int, float, float]:
        return self.step.get((state, symbol), (state, 1.0, 0.0))


#: 0: nothing yet, 1: after an insult.
INSULTS = Transducer({(0, INSULT): (1, 1.0, 0.0), (1, INSULT): (1, 1.25, 0.0)})
#: 0: nothing, 1: announced. Harm unannounced counts little.
THREATS = Transducer({(0, ANNOUNCE): (1, 1.0, 0.0), (0, HARM): (0, 1.0, 0.1), (1, HARM): (0, 1.0, 2.0)})
#: 0: nobody addressed, 1: somebody is.
TARGETS = Transducer({(0, TARGET): (1, 1.0, 0.0), (1, INSULT): (1, 1.25, 0.0), (1, HARM): (1, 1.25, 0.0)})
#: n: a negation reaches n more words.
NEGATIONS = Transducer(
    {(n, s): (max(n - 1, 0), 0.3 if n and s in (INSULT, HARM) else 1.0, 0.0) for n in range(4) for s in range(7)}
    | {(n, NEGATION): (3, 1.0, 0.0) for n in range(4)}
)
#: 0: own words, 1: reported ones.
REPORTS = Transducer({(0, REPORT): (1, 1.0, 0.0), (1, INSULT): (1, 0.5, 0.0), (1, HARM): (1, 0.5, 0.0)})

GRAMMAR = (INSULTS, THREATS, TARGETS, NEGATIONS, REPORTS)


class Composed:
    """The product of transducers, built state by state as texts need them."""

    def __init__(self, parts: tuple[Transducer, ...] = GRAMMAR):
        self.parts = parts
        self.states: dict[tuple[int, ...], int] = {(0,) * len(parts): 0}
        self.names = [(0,) * len(parts)]
        self.table: dict[tuple[int, int], tuple[int, float, float]] = {}

    def move(self, state: int, symbol: int) -> tuple[int, float, float]:
        """Next state, factor on the symbol's own weight, and weight that the path gains here."""
        found = self.table.get((state, symbol))
        if found is None:
            steps = [part.move(at, symbol) for part, at in zip(self.parts, self.names[state], strict=True)]
            name = tuple(step[0] for step in steps)
            if name not in self.states:
                self.states[name] = len(self.names)
                self.names.append(name)
            factor = math.prod(step[1] for step in steps)
            found = (self.states[name], factor, factor * sum(step[2] for step in steps))
            self.table[state, symbol] = found
        return found


class Lexicon:
    """Words and word beginnings with their symbols; the heaviest match of a word counts."""

    def __init__(self, insults: dict[str, float]):
        self.fixed = {word: (symbol, SEED_WEIGHT) for symbol, words in WORDS.items() for word in words.split()}
        self.insults = insults
        self.cache: dict[str, tuple[int, float]] = {}

    def read(self, word: str) -> tuple[int, float]:
        found = self.cache.get(word)
        if found is None:
            weights = [self.insults[x] for x in traits(word) if x in self.insults]
            found = self.fixed.get(word, (OTHER, 0.0))
            if weights:
                found = (INSULT, max(*weights, found[1] if found[0] == INSULT else 0.0))
            if len(self.cache) > 200_000:
                self.cache.clear()
            self.cache[word] = found
        return found


def traits(word: str) -> list[str]:
    """A word as a whole and its beginnings."""
    return [word + "$", *(word[:n] for n in PREFIXES if len(word) > n)]


def clause_scores(text: str | None, lexicon: Lexicon, composed: Composed) -> list[float]:
    """Scores of the clauses that score at all."""
    scores, state, score = [], 0, 0.0
    cache, move, addressed, after = lexicon.cache, composed.move, False, 0
    tokens = _TOKEN.findall((text or "").lower())
    for token in tokens:
        if token in _ENDS:
            if score > 0:
                scores.append(score)
            state, score, addressed = 0, 0.0, False
            continue
        symbol, weight = cache.get(token) or lexicon.read(token)
        if symbol == OTHER and not state:
            continue
        if symbol == TARGET and score > 0 and not addressed:
            score *= 1.25
        addressed = addressed or symbol == TARGET
        state, factor, gain = move(state, symbol)
        score += gain + (weight * factor if symbol == INSULT else 0.0)
    if score > 0:
        scores.append(score)
    return scores


def summary(scores: list[float]) -> tuple[float, float]:
    """What the curve sees of a document: log of the sum and the largest clause."""
    return math.log1p(sum(scores)), math.log1p(max(scores, default=0.0))


@dataclass(frozen=True)
class Model:
    """Insults with weights, and the curve's weights on a constant, the sum and the largest clause."""

    insults: dict[str, float]
    curve: tuple[float, float, float]

    def probability(self, total: float, largest: float) -> float:
        a, b, c = self.curve
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, a + b * total + c * largest))))


def _trait_counts(docs: DataFrame, wanted: frozenset[str] | None) -> DataFrame:
    """(trait, documents it is in) of the traits wanted, all if none are named."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter = Counter()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                own = {x for word in set(_TOKEN.findall((text or "").lower())) for x in traits(word)}
                found.update(own if wanted is None else own & wanted)
            if len(found) > 500_000:
                yield counted(found)
                found = Counter()
        yield counted(found)

    def counted(found: Counter) -> pa.RecordBatch:
        columns = [pa.array(list(found), pa.string()), pa.array(list(found.values()), pa.int64())]
        return pa.RecordBatch.from_arrays(columns, names=["trait", "n"])

    rows = docs.select("text").mapInArrow(count, "trait string, n long")
    return rows.groupBy("trait").agg(F.sum("n").alias("n"))


def _learn_insults(docs: DataFrame) -> dict[str, float]:
    """Weights, log odds of toxic against other documents, of ``docs`` (text, toxic)."""
    sizes = {row["toxic"]: row["n"] for row in docs.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    toxic, clean = sizes.get(1, 0), sizes.get(0, 0)
    if not toxic or not clean:
        return {}
    counts = _trait_counts(docs.filter("toxic = 1"), None).filter(F.col("n") >= LEAST_DOCUMENTS)
    # no more than the words of the sample's toxic documents divided by ``LEAST_DOCUMENTS``
    seen = {row["trait"]: row["n"] for row in counts.collect()}
    others = {r["trait"]: r["n"] for r in _trait_counts(docs.filter("toxic = 0"), frozenset(seen)).collect()}
    odds = {x: math.log((n + 0.5) / (toxic - n + 0.5) * (clean - m + 0.5) / (m + 0.5))
            for x, n in seen.items() for m in (others.get(x, 0),)}
    return {x: value for x, value in odds.items() if value >= LEAST_ODDS}


def _scored(docs: DataFrame, insults: dict[str, float], *columns: str) -> DataFrame:
    """The named columns with sum and largest clause of the text."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon, composed = Lexicon(insults), Composed()
        for batch in batches:
            texts = batch.column(len(columns)).to_pylist()
            pairs = [summary(clause_scores(text, lexicon, composed)) for text in texts]
            found = [pa.array([pair[k] for pair in pairs], pa.float64()) for k in (0, 1)]
            kept = [batch.column(k) for k in range(len(columns))]
            yield pa.RecordBatch.from_arrays([*kept, *found], names=[*columns, "total", "largest"])

    chosen = docs.select(*columns, "text")
    kinds = [f"{c} {chosen.schema[c].dataType.simpleString()}" for c in columns]
    return chosen.mapInArrow(score, ", ".join([*kinds, "total double", "largest double"]))


def _fit_curve(rows: Iterable[tuple[float, float, int, int]]) -> tuple[float, float, float]:
    """Logistic regression by Newton's method on (sum, largest, toxic, weight), slightly regularised."""
    data = np.array(list(rows), np.float64).reshape(-1, 4)
    design = np.concatenate((np.ones((len(data), 1)), data[:, :2]), axis=1)
    label, weight, beta = data[:, 2], data[:, 3], np.array([-2.0, 0.5, 0.5])
    ridge = np.diag([0.01, 0.05, 0.05])
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        slope = design.T @ (weight * (label - p)) - ridge @ beta
        step = np.linalg.solve((design.T * (weight * p * (1 - p))) @ design + ridge, slope)
        beta = beta + step * min(1.0, 2 / max(1e-9, np.abs(step).max()))
    return tuple(beta.tolist())


def learn(docs: DataFrame, labels: DataFrame, most: int = MOST_LABELS) -> Model:
    """A model from labelled documents outside the held-out fold; two thirds give the insults, the rest the curve.

    The third for the curve is scored with insults it had no part in; the insults that count in the end come from all.
    """
    marks = labels.select(F.col("doc_id").cast("long"), "toxic").filter("toxic IS NOT NULL")
    marks = marks.filter(fold("doc_id", FOLDS) != HELD_OUT).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    number = marks.count()
    # both sides by the same hash, so that no more of the texts than the sample's share is moved
    texts, marks = (sample_below(x, "doc_id", number, most) for x in (docs.select(F.col("doc_id").cast("long"), "text"), marks))
    # two numbers for each document of a bounded sample, so that no texts are dealt out
    known = stored(texts.join(F.broadcast(marks), "doc_id"), "sample")
    third = F.pmod(F.xxhash64(F.lit(3), "doc_id"), F.lit(3)) == 0
    half = _learn_insults(known.filter(~third).select("text", "toxic"))
    points = _scored(known.filter(third), half, "toxic")
    rounded = points.groupBy(
        F.round("total", 2).alias("total"), F.round("largest", 2).alias("largest"), "toxic"
    ).agg(F.count(F.lit(1)).alias("n"))
    rows = [(r["total"], r["largest"], r["toxic"], r["n"]) for r in rounded.collect()]
    return Model(_learn_insults(known.select("text", "toxic")), _fit_curve(rows))


def scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted, and the sum and largest clause behind the score.

    Reads doc_id and text alone. Null and empty texts score as texts without matches. Null ids are not held out, and never
    learned from. Without labels the fixed words and a prior curve decide. Rows may repeat; an empty table gives none.
    """
    model = learn(docs, labels)
    a, b, c = model.curve
    found = _scored(docs.select(F.col("doc_id").cast("long"), "text"), model.insults, "doc_id")
    odds = F.lit(a) + F.lit(b) * F.col("total") + F.lit(c) * F.col("largest")
    scored = found.withColumn("score", 1 / (1 + F.exp(-odds)))
    held_out = F.coalesce(fold("doc_id", FOLDS) == HELD_OUT, F.lit(False)).alias("held_out")
    predicted = F.when(F.col("score") >= 0.5, 1).otherwise(0).cast("int").alias("predicted")
    return scored.select("doc_id", held_out, "score", predicted, "total", "largest")
