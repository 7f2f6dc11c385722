"""Whitening of embeddings: their leading principal components, each scaled to unit variance.

Entries become whole numbers, so sums and deviations are exact. The covariance is that of all usable vectors, centred
before they are multiplied: each task adds up its own products, and sums of cells meet in a shuffle, a row per cell of
the matrix and task. Eigenvalues and components come from contour integration (``feast``). A last pass over all rows
measures how far the covariance of the whitened values is from the identity.

What reaches the driver is bounded by the square of the dimension, whatever the number of rows.

Defined results: a vector takes part if it is not null, all its entries are finite and smaller than ``LIMIT`` in size, and
it has the length that most such vectors have (of equally frequent lengths the larger); other rows are dropped. Zero
vectors take part. Repeated rows and null ids count as rows of their own. Components whose eigenvalue is zero up to
rounding have no whitened value and are left out, so a table of equal vectors, like an empty one, gives no rows. A
deviation beyond a long is null. Further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillbook.llm import feast
from tillbook.llm.vectors import matrix

COMPONENTS = 8

#: Larger entries would not leave room for exact sums.
LIMIT = float(1 << 30)

SCALE, OFFSET = 1024.0, 100_000

_LONG = (1 << 63) - 1

SCHEMA = (
    "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
)


@dataclass(frozen=True)
class Fit:
    """Rows, sums of whole-number entries, falling eigenvalues, components as columns and the trace of the covariance."""

    n: int
    sums: np.ndarray
    eigenvalues: np.ndarray
    components: np.ndarray
    trace: float


def _takes_part(embedding: str) -> Column:
    # NaN is larger than any number
    return F.coalesce(F.forall(embedding, lambda x: x.isNotNull() & (F.abs(x) < LIMIT)), F.lit(False))


def usable(vectors: DataFrame) -> DataFrame:
    """``vec_id`` and ``embedding`` of the vectors that take part."""
    good = vectors.select("vec_id", "embedding").filter(_takes_part("embedding") & (F.size("embedding") > 0))
    length = F.size("embedding").alias("length")
    usual = good.groupBy(length).count().orderBy(F.desc("count"), F.desc("length")).first()
    return good.filter(F.size("embedding") == (usual["length"] if usual else 0))


def whole(column: pa.Array) -> np.ndarray:
    """Entries as whole numbers, a row for each vector."""
    return np.floor(SCALE * matrix(column)).astype(np.int64) + OFFSET


def _added(df: DataFrame, partial: Callable[[np.ndarray], np.ndarray], kind: str) -> np.ndarray:
    """Sum over all rows of what ``partial`` gives for the whole numbers of a batch: added up per task, then per cell."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                found = partial(whole(batch.column(0)))
                total = found if total is None else total + found
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(total)], ["cell", "value"])

    cells = df.select("embedding").mapInArrow(run, f"cell long, value {kind}")
    rows = cells.groupBy("cell").agg(F.sum("value").alias("value")).collect()
    return np.array([row["value"] for row in sorted(rows, key=lambda row: row["cell"])])


def _multiples(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """``n * x - sums`` exactly: in longs, or in Python's whole numbers where longs might not do."""
    most = n * int(np.abs(x).max(initial=0)) + max(map(abs, sums.tolist()), default=0)
    return n * x - sums if most <= _LONG else n * x.astype(object) - sums.astype(object)


def centred(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """``x`` without the mean, rounded once."""
    return _multiples(x, n, sums).astype(np.float64) / n


def deviations(x: np.ndarray, n: int, sums: np.ndarray) -> list[int | None]:
    """The exact sum of squares of ``n * x - sums`` of each row; None beyond a long."""
    apart = _multiples(x, n, sums)
    largest = max(abs(int(apart.max(initial=0))), abs(int(apart.min(initial=0))))
    if apart.dtype == np.int64 and largest**2 * x.shape[1] > _LONG:
        apart = apart.astype(object)
    return [int(total) if total <= _LONG else None for total in (apart * apart).sum(axis=1)]


def fitted(vectors: DataFrame, most: int = COMPONENTS) -> Fit:
    """Components of ``usable`` vectors; none if there are no vectors or all are equal."""
    sums = _added(vectors, lambda x: np.append(x.sum(axis=0), len(x)), "long")
    if not len(sums):
        return Fit(0, np.empty(0, np.int64), np.empty(0), np.empty((0, 0)), 0.0)
    n, sums = int(sums[-1]), sums[:-1].astype(np.int64)
    upper = np.triu_indices(len(sums))

    def products(x: np.ndarray) -> np.ndarray:
        apart = centred(x, n, sums)
        return (apart.T @ apart)[upper]

    covariance = np.zeros((len(sums), len(sums)))
    covariance[upper] = _added(vectors, products, "double") / n
    covariance = np.triu(covariance) + np.triu(covariance, 1).T
    values, components = feast.largest(vectors.sparkSession, covariance, most)
    if len(values):  # the largest entry of a component is positive
        components = components * np.sign(components[np.abs(components).argmax(axis=0), np.arange(len(values))])
    return Fit(n, sums, values, components, float(np.trace(covariance)))


def _projected(x: np.ndarray, fit: Fit) -> np.ndarray:
    return centred(x, fit.n, fit.sums) @ (fit.components / np.sqrt(fit.eigenvalues))


def identity_error(vectors: DataFrame, fit: Fit) -> float:
    """Largest absolute entry of the covariance of the whitened vectors minus the identity, measured on all of them."""
    k = len(fit.eigenvalues)

    def products(x: np.ndarray) -> np.ndarray:
        found = _projected(x, fit)
        return np.concatenate([found.sum(axis=0), (found.T @ found).ravel()])

    added = _added(vectors, products, "double") / fit.n
    covariance = added[k:].reshape(k, k) - np.outer(added[:k], added[:k])
    return float(np.abs(covariance - np.eye(k)).max())


def whitened(vectors: DataFrame, most: int = COMPONENTS) -> DataFrame:
    """A row for each usable vector and component, in the columns of ``SCHEMA``; components are numbered from 1."""
    rows = usable(vectors)
    fit = fitted(rows, most)
    k = len(fit.eigenvalues)
    if not k:
        return vectors.sparkSession.createDataFrame([], SCHEMA)
    error = identity_error(rows, fit)
    explained = fit.eigenvalues / fit.trace

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, count = whole(batch.column(1)), batch.num_rows
            if not count:
                continue
            each = pa.array(np.repeat(np.arange(count), k))
            deviation = pa.array(deviations(x, fit.n, fit.sums), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).cast(pa.int64()).take(each),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), count)),
                    pa.array(np.full(count * k, fit.n, np.int64)),
                    deviation.take(each),
                    pa.array(_projected(x, fit).ravel()),
                    pa.array(np.tile(explained, count)),
                    pa.array(np.full(count * k, error)),
                ],
                ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return rows.mapInArrow(run, SCHEMA)
