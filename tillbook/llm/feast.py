"""The largest eigenvalues of a symmetric matrix and their vectors by contour integration.

Inertia counts of shifted matrices (signs of the pivots of a symmetric factorisation) say how many eigenvalues lie above
a shift; they find intervals that hold the wanted ones and end in gaps of the spectrum. For each interval a quadrature
along a circle around it, of solutions of complex shifted systems, filters a random subspace down to the interval's
eigenvectors; Rayleigh-Ritz takes them out, and the filter is applied again until residuals are at rounding level. An
interval is done when as many pairs have converged in it as inertia counted, so none is missed.

Counts and shifted solves are independent of each other: each is a Spark task. The matrix, of the size of the square of
the dimension, is sent along; what returns is a number or a narrow block of vectors.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import SparkSession

#: Quadrature nodes on the upper half of a circle; the lower half is its mirror image.
NODES = 8

#: Shifts counted at a time when intervals are sought.
SHIFTS = 16

#: Eigenvalues an interval may hold if gaps allow it, and vectors of its subspace beyond those it holds.
PER_INTERVAL, MORE = 4, 8

#: The largest eigenvalue of an interval is at most so many times its smallest, if gaps allow it.
LIKE = 8

MOST_ROUNDS = 40


def spread(spark: SparkSession, work: Callable[[int], np.ndarray], count: int) -> list[np.ndarray]:
    """``work(0)`` to ``work(count - 1)``, each in a task of its own."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            numbers = batch.column(0).to_pylist()
            found = [np.ascontiguousarray(work(number), dtype=np.float64).tobytes() for number in numbers]
            yield pa.RecordBatch.from_arrays([pa.array(numbers, pa.int64()), pa.array(found, pa.binary())], ["number", "found"])

    rows = spark.range(0, count, 1, count).mapInArrow(run, "number long, found binary").collect()
    return [np.frombuffer(row["found"], np.float64) for row in sorted(rows, key=lambda row: row["number"])]


def above(matrix: np.ndarray, shift: float) -> int:
    """How many eigenvalues are larger than ``shift``: positive pivots of a factorisation with complete pivoting.

    A pivot is the largest diagonal entry, or a block of two rows around the largest other entry; such a block has one
    eigenvalue of either sign. By Sylvester's law the signs are those of the eigenvalues.
    """
    rest = matrix - shift * np.eye(len(matrix))
    positive = 0
    while len(rest):
        diagonal = np.abs(np.diag(rest))
        first = int(diagonal.argmax())
        others = np.abs(rest - np.diag(np.diag(rest)))
        row, column = divmod(int(others.argmax()), len(rest))
        if max(diagonal[first], others[row, column]) == 0:
            break
        if diagonal[first] >= 0.64 * others[row, column]:
            pivots = [first]
            positive += bool(rest[first, first] > 0)
        else:
            pivots = [row, column]
            positive += 1
        kept = np.setdiff1d(np.arange(len(rest)), pivots)
        side = rest[np.ix_(kept, pivots)]
        rest = rest[np.ix_(kept, kept)] - side @ np.linalg.solve(rest[np.ix_(pivots, pivots)], side.T)
        rest = (rest + rest.T) / 2
    return positive


@dataclass
class Interval:
    """Eigenvalues in (low, high], ``count`` of them by inertia."""

    low: float
    high: float
    count: int


class Counts:
    """Inertia counts at the shifts asked for so far; they fall as the shift rises."""

    def __init__(self, spark: SparkSession, matrix: np.ndarray):
        self.spark, self.matrix, self.known = spark, matrix, {}

    def take(self, shifts: Iterable[float]) -> None:
        new, matrix = sorted(set(map(float, shifts)) - self.known.keys()), self.matrix
        if new:
            found = spread(self.spark, lambda i: np.array([above(matrix, new[i])]), len(new))
            self.known |= {shift: int(count[0]) for shift, count in zip(new, found, strict=True)}

    def between(self, low: float, high: float) -> None:
        spaced = np.geomspace if high > 4 * low > 0 else np.linspace
        self.take(spaced(low, high, SHIFTS + 2)[1:-1])

    def narrow(self, count: int) -> None:
        """Make the bracket of the eigenvalue of this rank a thousandth of it."""
        while True:
            low, high = self.bracket(count)
            if high - low <= 1e-3 * high:
                return
            self.between(low, high)

    def gap(self, count: int) -> tuple[float, float]:
        """The first and the last known shift above which there are ``count`` eigenvalues."""
        shifts = [shift for shift, n in self.known.items() if n == count]
        return min(shifts), max(shifts)

    def bracket(self, count: int) -> tuple[float, float]:
        """The largest known shift with ``count`` eigenvalues or more above it, the smallest with fewer."""
        low = max(shift for shift, n in self.known.items() if n >= count)
        return low, min(shift for shift, n in self.known.items() if n < count and shift > low)


def intervals(spark: SparkSession, matrix: np.ndarray, most: int) -> list[Interval]:
    """Disjoint intervals, the uppermost first, that hold the ``most`` largest positive eigenvalues.

    Eigenvalues at rounding level count as zero and are left out. Equal ones stay together, so that more than ``most``
    may be held.
    """
    limit = float(np.abs(matrix).sum(axis=1).max()) * (1 + 1e-9)
    if limit == 0:
        return []
    least = len(matrix) * np.finfo(float).eps * limit
    counts = Counts(spark, matrix)
    counts.take([least, limit])
    wanted = min(most, counts.known[least])
    if wanted == 0:
        return []
    counts.narrow(wanted)
    counts.narrow(1)
    low = counts.bracket(wanted)[0]
    counts.between(low, counts.bracket(1)[1])
    below = [shift for shift in counts.known if shift < low]
    if below:
        counts.between(max(below), low)
        low = sum(counts.gap(counts.known[low])) / 2
        counts.take([low])
    out: list[Interval] = []
    inside, all_of_them = 0, counts.known[low]
    while inside < all_of_them:
        # from just above the next eigenvalue down to a gap, with few eigenvalues of like size in between
        counts.narrow(inside + 1)
        next_one, high = counts.bracket(inside + 1)
        gaps = sorted({n for n in counts.known.values() if inside < n <= all_of_them})
        fitting = [n for n in gaps if n <= inside + PER_INTERVAL and counts.bracket(n)[0] * LIKE >= next_one]
        n = max(fitting) if fitting else min(gaps)
        cut = low if n == all_of_them else sum(counts.gap(n)) / 2
        counts.take([cut])
        out.append(Interval(cut, high, counts.known[cut] - inside))
        inside = counts.known[cut]
    return out


def _nodes(interval: Interval) -> tuple[np.ndarray, np.ndarray]:
    """Points of the upper half circle around an interval and their weights."""
    x, weight = np.polynomial.legendre.leggauss(NODES)
    turned = (interval.high - interval.low) / 2 * np.exp(1j * np.pi / 2 * (1 - x))
    return (interval.high + interval.low) / 2 + turned, weight / 2 * turned


def _filtered(spark: SparkSession, matrix: np.ndarray, ranges: list[Interval], blocks: list[np.ndarray]) -> list[np.ndarray]:
    """The blocks with all that belongs to eigenvalues outside their intervals filtered away; a task for each node."""
    points = [_nodes(interval) for interval in ranges]

    def solved(task: int) -> np.ndarray:
        of, node = divmod(task, NODES)
        shifts, weights = points[of]
        shifted = shifts[node] * np.eye(len(matrix)) - matrix
        return (weights[node] * np.linalg.solve(shifted, blocks[of].astype(complex))).real

    parts = spread(spark, solved, len(ranges) * NODES)
    return [sum(parts[i * NODES : (i + 1) * NODES]).reshape(block.shape) for i, block in enumerate(blocks)]


def largest(spark: SparkSession, matrix: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Up to ``most`` eigenvalues of a positive semidefinite matrix, falling, and their unit vectors as columns.

    Fewer where the others are zero. Raises ``ArithmeticError`` if an interval does not yield all that it holds.
    """
    size = len(matrix)
    found = intervals(spark, matrix, most)
    if not found:
        return np.empty(0), np.empty((size, 0))
    scale, generator = found[0].high, np.random.default_rng(7)
    widths = [min(size, 2 * interval.count + MORE) for interval in found]
    blocks = [generator.standard_normal((size, width)) for width in widths]
    done: dict[int, np.ndarray] = {}
    best = dict.fromkeys(range(len(found)), np.inf)
    for _ in range(MOST_ROUNDS):
        todo = [i for i in range(len(found)) if i not in done]
        if not todo:
            break
        filtered = _filtered(spark, matrix, [found[i] for i in todo], [blocks[i] for i in todo])
        for i, block in zip(todo, filtered, strict=True):
            basis = np.linalg.qr(block)[0]
            values, turns = np.linalg.eigh(basis.T @ matrix @ basis)
            blocks[i] = basis @ turns
            inside = (values > found[i].low) & (values <= found[i].high)
            vectors = blocks[i][:, inside]
            error = np.abs(matrix @ vectors - vectors * values[inside]).max(initial=0.0) / scale
            # at rounding level, or as good as it gets
            settled = error <= 1e-15 or (error <= 1e-12 and error >= best[i] / 2)
            if inside.sum() == found[i].count and settled:
                done[i] = vectors
            best[i] = min(best[i], error) if inside.sum() == found[i].count else np.inf
    if len(done) < len(found):
        raise ArithmeticError(f"no convergence in {[found[i] for i in range(len(found)) if i not in done]}")
    basis = np.linalg.qr(np.hstack([done[i] for i in range(len(found))]))[0]
    values, turns = np.linalg.eigh(basis.T @ matrix @ basis)
    vectors = basis @ turns
    return values[::-1][:most].copy(), vectors[:, ::-1][:, :most].copy()
