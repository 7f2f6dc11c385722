"""Quality of documents: a classifier of the text, with posteriors of its site that shrink towards wider ones.

The classifier is a logistic regression on a few properties of a text, fitted to labelled documents. Its probabilities,
summed up by path and by host, are soft counts of good documents. Empirical Bayes turns them into rates: a path's rate
shrinks towards its host's and a host's towards the global one, by prior strengths that the spread between hosts and
that between the paths of a host give (moments of a beta-binomial). A document's verdict adds the log odds of its path,
as its other documents show them and relative to the global ones, to those of its text.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillbook.llm.common import packed, sample_below, stored

#: Labelled documents the classifier is fitted to, at most.
MOST_LABELS = 20_000

#: How far a site may move a document, in log odds, and the probability below which a document is rejected.
SITE_LIMIT = 2.0
THRESHOLD = 0.5

#: Strengths of the priors where hosts or paths do not differ at all.
MOST_STRENGTH = 1000.0

_MARKS = re.compile(r"[^\w\s.,;:!?'\"()-]")
_STOPS = ".,;:!?"
FEATURES = 10


def properties(text: str | None) -> list[float]:
    """Properties of a text, all between about 0 and 5."""
    text = text or ""
    words = text.split()
    n, chars = len(words), len(text)
    if not n:
        return [1.0] + [0.0] * (FEATURES - 1)
    counts = Counter(words)
    repeats = sum(a == b for a, b in zip(words, words[1:], strict=False))
    lengths = np.fromiter(map(len, words), np.int64, n)
    common = sum(sorted(counts.values(), reverse=True)[:10])
    lines = text.split("\n")
    return [
        0.0,
        math.log10(n + 1),
        10 * len(_MARKS.findall(text)) / chars,
        3 * repeats / n,
        3 * len(counts) / n,
        float(lengths.mean()) / 5,
        float((lengths > 20).mean()) * 5,
        3 * sum(w[-1] in _STOPS for w in words) / n,
        3 * common / n,
        5 * (1 - len(set(lines)) / len(lines)),
    ]


def _described(docs: DataFrame, *columns: str) -> DataFrame:
    """The named columns and ``features`` of the text."""

    @F.arrow_udf("array<double>")
    def describe(texts: pa.Array) -> pa.Array:
        return pa.array([properties(text.as_py()) for text in texts], pa.list_(pa.float64()))

    return docs.select(*columns, describe("text").alias("features"))


class Classifier:
    """Log odds of a good document: weights on standardised properties and their squares."""

    def __init__(self, features: np.ndarray, good: np.ndarray, rounds: int = 60):
        features = features.reshape(-1, FEATURES)
        self.mean = features.mean(axis=0) if len(features) else np.zeros(FEATURES)
        self.scale = features.std(axis=0) + 1e-3 if len(features) else np.ones(FEATURES)
        design, ridge = self._design(features), np.eye(1 + 2 * FEATURES)
        self.weights = np.zeros(1 + 2 * FEATURES)
        for _ in range(rounds if 0 < good.sum() < len(good) else 0):
            p = 1 / (1 + np.exp(-np.clip(design @ self.weights, -30, 30)))
            slope = design.T @ (good - p) - ridge @ self.weights
            step = np.linalg.solve((design.T * (p * (1 - p))) @ design + ridge, slope)
            self.weights += step * min(1.0, 3 / max(1e-9, np.abs(step).max()))
            if np.abs(step).max() < 1e-6:
                break
        else:
            if len(good) and not 0 < good.sum() < len(good):
                self.weights[0] = math.log((good.sum() + 0.5) / (len(good) - good.sum() + 0.5))

    def _design(self, features: np.ndarray) -> np.ndarray:
        z = np.clip((features - self.mean) / self.scale, -5, 5)
        return np.concatenate((np.ones((len(z), 1)), z, z * z / 5), axis=1)

    def log_odds(self, features: np.ndarray) -> np.ndarray:
        return np.clip(self._design(features.reshape(-1, FEATURES)) @ self.weights, -12, 12)


def fit(docs: DataFrame, labels: DataFrame, most: int = MOST_LABELS) -> Classifier:
    """A classifier fitted to at most about ``most`` labelled documents, chosen by a hash of their ids."""
    marks = labels.select(F.col("doc_id").cast("long"), F.col("quality").alias("good"))
    marks = marks.filter("doc_id IS NOT NULL AND good IS NOT NULL").groupBy("doc_id").agg(F.max("good").alias("good"))
    chosen = sample_below(marks, "doc_id", marks.count(), most)  # about ``most`` ids, so small enough to send
    texts = docs.select(F.col("doc_id").cast("long"), "text").join(F.broadcast(chosen), "doc_id")
    described = _described(texts, "doc_id", "good").groupBy("doc_id", "good").agg(F.min("features").alias("features"))
    rows = described.sort("doc_id").collect()  # one row an id, however often it is repeated
    return Classifier(np.array([r["features"] for r in rows]), np.array([float(r["good"]) for r in rows]))


@dataclass(frozen=True)
class Prior:
    """Global rate of good documents, and how many documents the prior of a host and of a path counts for."""

    rate: float
    host_strength: float
    path_strength: float


def strength(groups: DataFrame, *parent: str) -> float:
    """Prior strength of groups (n, good) within their parents, by the moments of a beta-binomial.

    Within a parent of rate m, the sum over its k groups of n (rate - m)^2 is m (1 - m) (k - 1 + r (n0 - k + 1)) on
    average, n0 being the sum of n less the sum of n^2 over it. Summed over parents this gives the correlation r of documents
    of one group beyond that of their parent; the strength is 1 / r - 1.
    """
    n, good = F.sum("n"), F.sum("good")
    parents = groups.groupBy(*parent).agg(
        F.count(F.lit(1)).alias("k"),
        (good / n * (1 - good / n)).alias("v"),
        (F.sum(F.col("good") * F.col("good") / F.col("n")) - good * good / n).alias("spread"),
        (n - F.sum(F.col("n") * F.col("n")) / n).alias("n0"),
    )
    found = parents.agg(
        F.sum(F.col("spread") - F.col("v") * (F.col("k") - 1)).alias("beyond"),
        F.sum(F.col("v") * (F.col("n0") - F.col("k") + 1)).alias("whole"),
    ).first()
    if not found["whole"] or found["whole"] <= 0 or found["beyond"] <= 0:
        return MOST_STRENGTH
    return min(max(found["whole"] / found["beyond"] - 1, 1.0), MOST_STRENGTH)


def _logit(p: Column) -> Column:
    return F.log(p / (1 - p))


def _good() -> Column:
    return 1 / (1 + F.exp(-F.col("text_log_odds")))


def counted(scored: DataFrame) -> tuple[DataFrame, Prior]:
    """Soft counts of each path and its host (host, path, n, good, host_n, host_good), and the priors they give."""
    paths = scored.groupBy("host", "path").agg(F.count(F.lit(1)).cast("double").alias("n"), F.sum(_good()).alias("good"))
    paths = stored(paths, "sites")
    hosts = paths.groupBy("host").agg(F.sum("n").alias("n"), F.sum("good").alias("good"))
    total = hosts.agg(F.sum("n").alias("n"), F.sum("good").alias("good")).first()
    rate = min(max((total["good"] or 0.0) / (total["n"] or 1), 1e-3), 1 - 1e-3)
    prior = Prior(rate, strength(hosts), strength(paths, "host"))
    return paths.join(hosts.select("host", F.col("n").alias("host_n"), F.col("good").alias("host_good")), "host"), prior


def sited(scored: DataFrame, sites: DataFrame, prior: Prior) -> DataFrame:
    """``scored`` with site_log_odds and score. A site's rate is that of its other documents: what a document says of
    itself is in its own log odds."""
    host_good = F.col("host_good") - _good() + prior.host_strength * prior.rate
    host_rate = host_good / (F.col("host_n") - 1 + prior.host_strength)
    path_rate = (F.col("good") - _good() + prior.path_strength * host_rate) / (F.col("n") - 1 + prior.path_strength)
    path_rate = F.greatest(F.least(path_rate, F.lit(1 - 1e-9)), F.lit(1e-9))
    shift = _logit(path_rate) - math.log(prior.rate / (1 - prior.rate))
    shift = F.greatest(F.least(shift, F.lit(SITE_LIMIT)), F.lit(-SITE_LIMIT))
    both = F.col("text_log_odds") + F.col("site_log_odds")
    found = scored.join(sites, ["host", "path"]).withColumn("site_log_odds", shift)
    return found.withColumn("score", 1 / (1 + F.exp(-both))).drop("n", "good", "host_n", "host_good")


def judged(docs: DataFrame, labels: DataFrame, host: Column | None = None, path: Column | None = None) -> DataFrame:
    """Each document as ``row`` with text_log_odds, site_log_odds and score, its probability of being good.

    A host is the source, a path the source with the language, unless given. Null hosts and paths are sites of
    their own. Null and empty texts have properties like others. Without labels of both kinds the text says nothing
    but the labels' rate. Rows may repeat; an empty table gives none.
    """
    model = fit(docs, labels)
    host = F.coalesce(F.col("source") if host is None else host, F.lit("\0"))
    path = F.coalesce(F.col("lang") if path is None else path, F.lit("\0"))

    @F.arrow_udf("double")
    def log_odds(texts: pa.Array) -> pa.Array:
        return pa.array(model.log_odds(np.array([properties(text.as_py()) for text in texts], np.float64)))

    # only the text goes to Python and only a number comes back; rows stay where they are
    site = host.alias("host"), path.alias("path"), log_odds("text").alias("text_log_odds")
    sites, prior = counted(docs.select(*site))
    found = sited(docs.select(packed(docs), *site), sites, prior)
    return found.select("row", "text_log_odds", "site_log_odds", "score")


def verdicts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, score, kept and the two parts of the score for each document."""
    found = judged(docs, labels)
    return found.select(
        "row.doc_id", "score", (F.col("score") >= THRESHOLD).alias("kept"), "text_log_odds", "site_log_odds"
    )


def accepted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that are not rejected, all columns kept."""
    return judged(docs, labels).filter(F.col("score") >= THRESHOLD).select("row.*")
