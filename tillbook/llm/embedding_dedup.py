"""Near-duplicate vectors by tiled comparison of PCA-ordered coordinates.

Unit vectors are rotated to principal components, so that leading coordinates differ most. Two vectors whose cosine
reaches the threshold differ by at most ``width`` in every coordinate: a grid over the leading ones names the cells that can hold
partners, and cells meet only their neighbours. A label's grid has as many dimensions as its rows ask for: none while they
fit a tile, so that no row is sent twice for nothing. Cells are cut into tiles of bounded size, and tiles are as large as
memory allows before rows are sent to more of them. A task gets a tile with its visitors
one batch after the other and adds up products block of dimensions by block: the sum so far and the product of the
norms of what remains bound the cosine, and a pair that can't reach the threshold is left alone. Survivors are
verified in double precision on the vectors as given.

Equal vectors are one row with a count. Only links that span what is linked leave a task, and a number of links for each row.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillbook.llm.common import sample_below, stored
from tillbook.llm.components import components
from tillbook.llm.vectors import matrix, usable

THRESHOLD = 0.98

#: Vectors the rotation is fitted to, at most; most coordinates of the grid; dimensions added at a time.
MOST_SAMPLE = 10_000
GRID = 3
BLOCK = 8

#: Rows of a tile while the grid has fewer than ``GRID`` coordinates, and at most; pairs that are compared at a time.
TILE = 4096
MOST_TILE = 32_768
PAIRS = 1 << 17

#: A coordinate of the grid is taken to cut cells into so many.
_CUTS = 4

_SLACK = 1e-6
_BITS = 12
_BASE = 1 << _BITS


def rotation(vectors: DataFrame) -> np.ndarray | None:
    """Principal axes, the widest first, of a sample of the vectors of the most frequent length."""
    lengths = vectors.groupBy(F.size("embedding").alias("size")).agg(F.count(F.lit(1)).alias("n"))
    most = lengths.orderBy(F.desc("n"), "size").first()
    if most is None:
        return None
    own = vectors.filter(F.size("embedding") == most["size"])
    rows = sample_below(own, "rep", most["n"], MOST_SAMPLE).select("embedding").collect()
    if not rows:
        return np.eye(most["size"])
    sample = np.array([row["embedding"] for row in rows], np.float64)
    sample /= np.linalg.norm(sample, axis=1, keepdims=True)
    # cosines take no account of a mean, so moments about zero give the axes
    _, axes = np.linalg.eigh(sample.T @ sample)
    return axes[:, ::-1].copy()


def _turned(vectors: np.ndarray, axes: np.ndarray | None) -> np.ndarray:
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    return unit @ axes if axes is not None and len(axes) == unit.shape[1] else unit


class Tile:
    """Rows of a tile, compared with batches of visitors."""

    def __init__(self, ids: np.ndarray, copies: np.ndarray, vectors: np.ndarray, axes: np.ndarray | None, threshold: float):
        self.ids, self.copies, self.vectors, self.axes, self.threshold = ids, copies, vectors, axes, threshold
        self.turned = _turned(vectors, axes)
        self.norms = np.linalg.norm(vectors, axis=1)
        self.rest = _rests(self.turned)
        self.linked = np.zeros(len(ids), np.int64)
        self.parent = np.arange(len(ids))

    def find(self, x: int) -> int:
        while self.parent[x] != x:
            self.parent[x] = self.parent[self.parent[x]]
            x = self.parent[x]
        return x

    def pairs(self, vectors: np.ndarray, at_home: bool = False) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(visitor, home row) of all pairs whose cosine reaches the threshold, some visitors after the other.

        ``at_home``: the visitors are the tile itself, and each pair comes once.
        """
        turned = self.turned if at_home else _turned(vectors, self.axes)
        if turned.shape[1] != self.turned.shape[1]:
            return
        rest = self.rest if at_home else _rests(turned)
        norms = self.norms if at_home else np.linalg.norm(vectors, axis=1)
        rows = max(1, PAIRS // max(1, len(self.ids)))
        for start in range(0, len(vectors), rows):
            here, first = slice(start, start + rows), start if at_home else 0
            a, b = self._reaching(turned[here], [r[here] for r in rest], first)
            if at_home:
                later = a + start < b
                a, b = a[later], b[later]
            a = a + start
            exact = np.einsum("ij,ij->i", vectors[a], self.vectors[b]) / (norms[a] * self.norms[b])
            near = exact >= self.threshold
            yield a[near], b[near]

    def _reaching(self, turned: np.ndarray, rest: list[np.ndarray], first: int) -> tuple[np.ndarray, np.ndarray]:
        """Pairs with home rows from ``first`` on whose bound never falls below the threshold."""
        least, home = self.threshold - _SLACK, self.turned[first:]
        sums = turned[:, :BLOCK] @ home[:, :BLOCK].T
        a, b = np.nonzero(sums + rest[0][:, None] * self.rest[0][None, first:] >= least)
        sums, b = sums[a, b], b + first
        for k, at in enumerate(range(BLOCK, turned.shape[1], BLOCK), start=1):
            if not len(a):
                break
            sums += np.einsum("ij,ij->i", turned[a, at : at + BLOCK], self.turned[b, at : at + BLOCK])
            alive = sums + rest[k][a] * self.rest[k][b] >= least
            a, b, sums = a[alive], b[alive], sums[alive]
        return a, b

    def visit(self, ids: np.ndarray, copies: np.ndarray, vectors: np.ndarray, at_home: bool) -> tuple[list, list]:
        """Rows (id, links) of the visitors and links (a, b); ``at_home``: the visitors are the tile itself."""
        weights, links, seen = np.zeros(len(ids), np.int64), [], {}
        for a, b in self.pairs(vectors, at_home):
            np.add.at(self.linked, b, copies[a])
            np.add.at(self.linked if at_home else weights, a, self.copies[b])
            for x, y in zip(a.tolist(), b.tolist(), strict=True):
                root = self.find(y)
                mate = self.find(x) if at_home else seen.get(x)
                if mate is None:
                    seen[x] = root
                    links.append((int(ids[x]), int(self.ids[y])))
                elif (mate := self.find(mate)) != root:
                    self.parent[max(mate, root)] = min(mate, root)
                    links.append((int(ids[x]), int(self.ids[y])))
        return [(int(ids[k]), int(weights[k])) for k in np.flatnonzero(weights)], links

    def totals(self) -> list[tuple[int, int]]:
        return [(int(self.ids[k]), int(self.linked[k])) for k in np.flatnonzero(self.linked)]


def _rests(turned: np.ndarray) -> list[np.ndarray]:
    """Norms of what follows each block of dimensions."""
    squares = np.cumsum((turned**2)[:, ::-1], axis=1)[:, ::-1]
    return [
        np.sqrt(squares[:, at]) if at < turned.shape[1] else np.zeros(len(turned))
        for at in range(BLOCK, turned.shape[1] + BLOCK, BLOCK)
    ]


def _cells(distinct: DataFrame, axes: np.ndarray | None, width: float) -> DataFrame:
    """``distinct`` with the grid cell of each vector as a number."""

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells = np.zeros(batch.num_rows, np.int64)
            sizes = np.array(batch.column(1).value_lengths().to_pylist(), np.int64)
            for size in np.unique(sizes):
                here = np.flatnonzero(sizes == size)
                turned = _turned(matrix(batch.column(1).take(pa.array(here))), axes)[:, :GRID]
                steps = np.floor(turned / width).astype(np.int64) + _BASE // 2
                for k in range(GRID):
                    cells[here] = cells[here] * _BASE + (steps[:, k] if k < steps.shape[1] else 0)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cells)], names=[*batch.schema.names, "cell"])

    kind = distinct.schema["embedding"].dataType.simpleString()
    columns = distinct.select("rep", "embedding", "label", "copies")
    schema = f"rep long, embedding {kind}, label {columns.schema['label'].dataType.simpleString()}, copies long, cell long"
    return columns.mapInArrow(place, schema)


def _routes(placed: DataFrame) -> DataFrame:
    """For each cell of the finest grid the cell of its label's grid, its tiles, and the cells its rows go to with theirs.

    Rows visit their neighbours further on, and the tiles of their own cell that come after theirs.
    """
    rows_of, cell_of = Window.partitionBy("label", "size"), Window.partitionBy("label", "size", "coarse")
    # cells of a label are few, as a unit vector's coordinates are within one of zero
    cells = placed.groupBy("label", "size", "cell").agg(F.count(F.lit(1)).alias("n"))
    total = F.sum("n").over(rows_of)
    dims = sum(F.when(total > TILE * _CUTS**k, 1).otherwise(0) for k in range(GRID))
    cells = cells.withColumn("dims", dims).withColumn("rows", F.greatest(F.lit(TILE), F.ceil(total / _CUTS**GRID)))
    cells = cells.withColumn("coarse", F.expr(f"shiftright(cell, {_BITS} * ({GRID} - dims))"))
    tiles = F.ceil(F.sum("n").over(cell_of) / F.least("rows", F.lit(max(TILE, MOST_TILE)))).cast("int")
    cells = cells.withColumn("tiles", tiles).drop("n", "rows")
    hosts = cells.select("label", "size", "dims", F.col("coarse").alias("host"), F.col("tiles").alias("host_tiles")).distinct()
    onward = F.lit(None)
    for d in range(GRID + 1):
        around = (sum(x * _BASE ** (d - 1 - k) for k, x in enumerate(step)) for step in product((-1, 0, 1), repeat=d))
        ahead = F.array(*[F.lit(x).cast("long") for x in sorted(x for x in around if x >= 0)])
        onward = F.when(F.col("dims") == d, ahead).otherwise(onward)
    steps = hosts.select("label", "size", F.col("host").alias("coarse"), F.explode(onward).alias("step"))
    steps = steps.withColumn("host", F.col("coarse") + F.col("step"))
    routes = steps.join(hosts, ["label", "size", "host"]).groupBy("label", "size", "coarse")
    routes = routes.agg(F.collect_list(F.struct("host", "host_tiles")).alias("routes"))
    return cells.join(routes, ["label", "size", "coarse"]).drop("dims")


def _sent(placed: DataFrame) -> DataFrame:
    """Rows of (label, size, host, at) tiles: those of the tile itself and, with ``visits``, those that meet it."""
    placed = placed.withColumn("size", F.size("embedding"))
    rows = placed.join(_routes(placed), ["label", "size", "cell"])
    rows = rows.withColumn("tile", F.pmod(F.xxhash64("rep"), F.col("tiles")).cast("int"))
    rows = rows.withColumn("route", F.explode("routes"))
    first = F.when(F.col("route.host") == F.col("coarse"), F.col("tile")).otherwise(0)
    rows = rows.withColumn("at", F.explode(F.expr("sequence(0, route.host_tiles - 1)"))).filter(F.col("at") >= first)
    visits = (F.col("route.host") != F.col("coarse")) | (F.col("at") != F.col("tile"))
    return rows.select(
        "label", "size", F.col("route.host").alias("host"), "at", visits.alias("visits"), "rep", "copies", "embedding"
    )


def _compared(placed: DataFrame, axes: np.ndarray | None, threshold: float) -> DataFrame:
    """Rows (a, b, links): a link where b is there, else a number of links of a."""
    group = ["label", "size", "host", "at"]
    rows = _sent(placed).withColumn("key", F.xxhash64(*group)).repartition("key")
    rows = rows.sortWithinPartitions("key", *group, "visits")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tile, now, home = None, None, []
        for batch in batches:
            names = list(zip(*(batch.column(k).to_pylist() for k in range(5)), strict=True))
            counts, links, at = [], [], 0
            while at < len(names):
                end = at + 1
                while end < len(names) and names[end] == names[at]:
                    end += 1
                part = batch.slice(at, end - at)
                ids, copies = (part.column(k).to_numpy(zero_copy_only=False) for k in (5, 6))
                vectors = matrix(part.column(7))
                if names[at][:4] != now:
                    if home:
                        tile = _settle_home(home, counts, links, axes, threshold)
                    if tile is not None:
                        counts += tile.totals()
                    tile, now, home = None, names[at][:4], []
                if not names[at][4]:
                    home.append((ids, copies, vectors))
                else:
                    if home:
                        tile, home = _settle_home(home, counts, links, axes, threshold), []
                    if tile is not None:
                        more = tile.visit(ids, copies, vectors, at_home=False)
                        counts += more[0]
                        links += more[1]
                at = end
            yield _results(counts, links)
        counts, links = [], []
        if home:
            tile = _settle_home(home, counts, links, axes, threshold)
        if tile is not None:
            counts += tile.totals()
        yield _results(counts, links)

    return rows.drop("key").select(*group, "visits", "rep", "copies", "embedding").mapInArrow(
        compare, "a long, b long, links long"
    )


def _settle_home(home: list, counts: list, links: list, axes: np.ndarray | None, threshold: float) -> Tile:
    ids, copies, vectors = (np.concatenate(x) for x in zip(*home, strict=True))
    tile = Tile(ids, copies, vectors, axes, threshold)
    more = tile.visit(ids, copies, vectors, at_home=True)
    counts += more[0]
    links += more[1]
    return tile


def _results(counts: list, links: list) -> pa.RecordBatch:
    a = [x for x, _ in counts] + [x for x, _ in links]
    b = [None] * len(counts) + [y for _, y in links]
    n = [n for _, n in counts] + [None] * len(links)
    return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (a, b, n)], names=["a", "b", "links"])


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """vec_id, n_links, component_id and kept for each row of (vec_id, embedding, label).

    Vectors link if their labels are equal, their lengths too, and their cosine is ``threshold`` or more. Vectors that are
    null, zero, or hold null or non-finite components, and rows without label or id, link with nothing; a component
    of its own has its own id. Rows that repeat a vector link with each other; an id is taken for one vector. An
    empty table gives none.
    """
    rows = vectors.select(F.col("vec_id").cast("long"), "embedding", "label")
    linkable = usable("embedding") & F.col("label").isNotNull() & F.col("vec_id").isNotNull()
    good = rows.filter(linkable)
    distinct = good.groupBy("label", "embedding").agg(
        F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("copies")
    )
    distinct = stored(distinct, "distinct")
    axes = rotation(distinct)
    width = math.sqrt(2 - 2 * threshold) + _SLACK
    found = stored(_compared(_cells(distinct, axes, width), axes, threshold), "compared")
    links = found.filter("b IS NULL").groupBy(F.col("a").alias("rep")).agg(F.sum("links").alias("links"))
    roots = components(found.filter("b IS NOT NULL").select("a", "b")).withColumnRenamed("node", "rep")
    known = distinct.join(links, "rep", "left").join(roots, "rep", "left").select(
        "label", "embedding",
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).cast("long").alias("n_links"),
        F.coalesce("root", "rep").alias("component_id"),
    )
    linked = good.join(known, ["label", "embedding"]).select("vec_id", "n_links", "component_id")
    alone = rows.filter(~linkable).select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    both = linked.union(alone)
    return both.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
