"""Nearest neighbours by inner product: a graph built by NN-descent, searched greedily.

Vectors are dealt to shards of bounded size by a hash of their ids. In each shard every vector starts with random
neighbours; a round joins neighbours with their neighbours (a Spark join of the lists with themselves) and each vector
keeps the nearest of all it has met. The graph's edges are the neighbours and a sample of those that point back. A
query, in blocks, goes through the graph of each shard: a beam of the best vectors seen so far, whose neighbours are
looked at until none of the beam is left to expand; the shards' results are merged.

The graph is built on distances: of the nodes v, u keeps those with the largest u.v - |v|^2 / 2, in double precision, so one
very long vector changes nothing for the others. A search begins at random vectors and at the longest ones, which are far
from all others and still the nearest by inner product. Scores are inner products of the vectors as given.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillbook.llm.common import stored
from tillbook.llm.vectors import matrix, usable

QUERY_EVERY = 20
NEAREST = 20

#: Vectors of a shard, about; neighbours of a vector; neighbours, and as many pointing back, joined in a round; rounds.
SHARD = 4096
NEIGHBOURS = 24
JOINED = 14
ROUNDS = 5

#: Beam of a search, vectors of it expanded at a time, queries searched side by side.
BEAM = 72
EXPANDED = 4
SIDE_BY_SIDE = 256
QUERY_BLOCK = 4096
LONGEST = 16

_PAIRS = 100_000
_STATE = {"shard": pa.int64(), "node": pa.int32(), "near": pa.list_(pa.int32()), "hops": pa.list_(pa.int32())}
_STATE_SCHEMA = "shard long, node int, near array<int>, hops array<int>"


def _scaled(vectors: np.ndarray) -> np.ndarray:
    """Vectors divided by their largest component, which changes no order and keeps squares finite."""
    return vectors / (np.abs(vectors).max(initial=0.0) or 1.0)


def _unit(queries: np.ndarray) -> np.ndarray:
    """Queries of largest component 1, which changes none of their orders."""
    return queries / np.abs(queries).max(axis=1, keepdims=True)


def _nearest(vectors: np.ndarray, u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """(n, NEIGHBOURS) nearest of the pairs (u, v), nearest first; -1 fills up."""
    n = len(vectors)
    pairs = np.unique(u.astype(np.int64) * n + v)
    u, v = pairs // n, pairs % n
    u, v = u[u != v], v[u != v]
    half = np.einsum("ij,ij->i", vectors, vectors) / 2
    closeness = np.empty(len(u))
    for at in range(0, len(u), _PAIRS):
        cut = slice(at, at + _PAIRS)
        closeness[cut] = np.einsum("ij,ij->i", vectors[u[cut]], vectors[v[cut]]) - half[v[cut]]
    order = np.lexsort((v, -closeness, u))
    u, v = u[order], v[order]
    first = np.searchsorted(u, np.arange(n))
    place = np.arange(len(u)) - first[u]
    out = np.full((n, NEIGHBOURS), -1, np.int64)
    best = place < NEIGHBOURS
    out[u[best], place[best]] = v[best]
    return out


def _hops(near: np.ndarray, ahead: int, back: int, seed: int) -> list[np.ndarray]:
    """For each node its first neighbours and a random sample of the nodes that have it as one."""
    n = len(near)
    u, k = np.nonzero(near >= 0)
    v = near[u, k]
    order = np.lexsort((np.random.default_rng(seed).random(len(u)), v))
    u, v = u[order], v[order]
    first = np.searchsorted(v, np.arange(n + 1))
    return [
        np.unique(np.concatenate((near[x, :ahead][near[x, :ahead] >= 0], u[first[x] : min(first[x] + back, first[x + 1])])))
        for x in range(n)
    ]


def _state(shard: int, near: np.ndarray, ahead: int, back: int, seed: int) -> pa.Table:
    hops = _hops(near, ahead, back, seed)
    columns = [np.full(len(near), shard), np.arange(len(near)), [x[x >= 0] for x in near], hops]
    return pa.table({name: pa.array(x, kind) for (name, kind), x in zip(_STATE.items(), columns, strict=True)})


def _closer(edges: int, seed: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """A round in a shard: vectors with, for each node, lists of nodes it has met."""

    def closer(left: pa.Table, right: pa.Table) -> pa.Table:
        left = left.sort_by("node")
        vectors = _scaled(matrix(left.column("embedding")))
        lists = right.column("met").combine_chunks()
        u = np.repeat(right.column("node").to_numpy(), lists.value_lengths().to_numpy(zero_copy_only=False))
        near = _nearest(vectors, u, lists.flatten().to_numpy())
        return _state(left.column("shard")[0].as_py(), near, edges, edges, seed)

    return closer


def build(index: DataFrame) -> DataFrame:
    """Graph (shard, node, near, hops) of ``index`` (shard, node, embedding), hops being the edges to search along."""

    def start(table: pa.Table) -> pa.Table:
        table = table.sort_by("node")
        vectors = _scaled(matrix(table.column("embedding")))
        n = len(vectors)
        v = np.random.default_rng(n).integers(0, n, (n, NEIGHBOURS))
        near = _nearest(vectors, np.repeat(np.arange(n), NEIGHBOURS), v.ravel())
        return _state(table.column("shard")[0].as_py(), near, JOINED, JOINED, 0)

    graph = stored(index.groupBy("shard").applyInArrow(start, _STATE_SCHEMA), "graph")
    for number in range(1, ROUNDS + 1):
        via = graph.select("shard", "node", F.explode("hops").alias("via"))
        beyond = graph.select("shard", F.col("node").alias("via"), F.col("hops").alias("met"))
        met = via.join(beyond, ["shard", "via"]).select("shard", "node", "met")
        met = met.union(graph.select("shard", "node", F.col("near").alias("met")))
        met = met.union(graph.select("shard", "node", F.col("hops").alias("met")))
        closer = _closer(NEIGHBOURS if number == ROUNDS else JOINED, number)
        closest = index.groupBy("shard").cogroup(met.groupBy("shard")).applyInArrow(closer, _STATE_SCHEMA)
        graph = stored(closest, "graph")
    return graph


def search(vectors: np.ndarray, hops: np.ndarray, queries: np.ndarray, own: np.ndarray) -> np.ndarray:
    """(queries, BEAM) nodes found, best first; -1 fills up. ``own``: the node a query is itself, or -1."""
    n, q = len(vectors), len(queries)
    longest = np.argsort(-np.einsum("ij,ij->i", vectors, vectors), kind="stable")[:LONGEST]
    seeds = np.union1d(np.random.default_rng(n).permutation(n)[:BEAM], longest)
    beam = np.broadcast_to(seeds, (q, len(seeds))).copy()
    beam = np.concatenate((beam, np.where(np.isin(own, seeds), -1, own)[:, None]), axis=1)
    seen = np.zeros((q, n + 1), bool)
    seen[np.arange(q)[:, None], beam] = True
    seen[:, n] = True
    score = _products(vectors, beam, queries)
    todo = beam >= 0
    while True:
        order = np.argsort(-score, axis=1, kind="stable")[:, :BEAM]
        beam, score, todo = (np.take_along_axis(x, order, axis=1) for x in (beam, score, todo))
        rank = np.cumsum(todo, axis=1)
        now = todo & (rank <= EXPANDED)
        if not now.any():
            return beam
        todo &= ~now
        rows, places = np.nonzero(now)
        slot = rank[rows, places] - 1
        fresh = np.full((q, EXPANDED, hops.shape[1]), -1, np.int64)
        fresh[rows, slot] = hops[beam[rows, places]]
        fresh = np.sort(fresh.reshape(q, -1), axis=1)
        fresh[:, 1:][fresh[:, 1:] == fresh[:, :-1]] = -1
        fresh[seen[np.arange(q)[:, None], fresh]] = -1
        seen[np.arange(q)[:, None], fresh] = True
        fresh = np.sort(fresh, axis=1)[:, -max(1, int((fresh >= 0).sum(axis=1).max())) :]
        beam = np.concatenate((beam, fresh), axis=1)
        score = np.concatenate((score, _products(vectors, fresh, queries)), axis=1)
        todo = np.concatenate((todo, fresh >= 0), axis=1)


def _products(vectors: np.ndarray, nodes: np.ndarray, queries: np.ndarray) -> np.ndarray:
    out = np.einsum("qcd,qd->qc", vectors[nodes], queries)
    out[nodes < 0] = -np.inf
    return out


def nearest(vectors: DataFrame, every: int = QUERY_EVERY, count: int = NEAREST) -> DataFrame:
    """query_id, rank, vec_id and score: the ``count`` nearest found for each row whose vec_id ``every`` divides.

    Vectors that are null, zero, or hold null or non-finite components, and rows without id, take no part. Only vectors of
    one length meet. An id is one vector: of rows that repeat it one takes part, and none is its own neighbour. Ties go to the
    smaller id. An empty table gives none.
    """
    rows = vectors.select(F.col("vec_id").cast("long"), "embedding").filter(F.col("vec_id").isNotNull())
    rows = rows.filter(usable("embedding")).withColumn("size", F.size("embedding"))
    shards = -(-rows.count() // SHARD) or 1
    # lengths take shards of their own
    sharded = rows.withColumn("shard", F.col("size").cast("long") * shards + F.pmod(F.xxhash64("vec_id"), F.lit(shards)))
    kind = rows.schema["embedding"].dataType.simpleString()

    def numbered(table: pa.Table) -> pa.Table:
        ids = table.column("vec_id").to_numpy()
        order = np.lexsort((*matrix(table.column("embedding")).T[::-1], ids))
        order = order[np.concatenate(([True], ids[order][1:] != ids[order][:-1]))]
        kept = table.take(pa.array(order))
        return kept.append_column("node", pa.array(np.arange(len(kept)), pa.int32()))

    columns = sharded.select("shard", "vec_id", "embedding")
    index = columns.groupBy("shard").applyInArrow(numbered, f"shard long, vec_id long, embedding {kind}, node int")
    index = stored(index, "index")
    graph = build(index.select("shard", "node", "embedding"))

    # each shard with its edges, once for each block of queries that comes
    searched = index.join(graph.select("shard", "node", "hops"), ["shard", "node"])
    queries = index.filter(F.col("vec_id") % every == 0).select(
        F.col("vec_id").alias("query_id"), F.col("embedding").alias("query"),
        F.floor(F.col("shard") / shards).cast("long").alias("size"),
    )
    there = index.select("shard").distinct().withColumn("size", F.floor(F.col("shard") / shards).cast("long"))
    number = queries.count()
    block = F.pmod(F.xxhash64("query_id"), F.lit(-(-number // QUERY_BLOCK) or 1))
    asked = queries.withColumn("block", block).join(there, "size").select("shard", "block", "query_id", "query")
    blocks = asked.select("shard", "block").distinct()
    copies = searched.join(blocks, "shard").select(
        F.col("shard").alias("in_shard"), F.col("block").alias("for_block"), "node", "vec_id", "embedding", "hops"
    )

    def find(left: pa.Table, right: pa.Table) -> pa.Table:
        left = left.sort_by("node")
        exact, ids = matrix(left.column("embedding")), left.column("vec_id").to_numpy()
        near = _scaled(exact).astype(np.float32)
        lists = left.column("hops").to_pylist()
        hops = np.full((len(lists), max(1, max(map(len, lists)))), -1, np.int64)
        for row, own in zip(hops, lists, strict=True):
            row[: len(own)] = own
        asked, asked_ids = matrix(right.column("query")), right.column("query_id").to_numpy()
        order = np.argsort(ids)
        at = np.minimum(np.searchsorted(ids[order], asked_ids), len(ids) - 1)
        itself = np.where(ids[order[at]] == asked_ids, order[at], -1)
        out = []
        for start in range(0, len(asked), SIDE_BY_SIDE):
            cut = slice(start, start + SIDE_BY_SIDE)
            beams = search(near, hops, _unit(asked[cut]).astype(np.float32), itself[cut])
            for query, vector, own, beam in zip(asked_ids[cut], asked[cut], itself[cut], beams, strict=True):
                found = beam[(beam >= 0) & (beam != own)]
                score = exact[found] @ vector
                best = np.lexsort((ids[found], -score))[:count]
                out.append((np.full(len(best), query), ids[found][best], score[best]))
        columns = [np.concatenate(x) for x in zip(*out, strict=True)]
        return pa.table({"query_id": columns[0], "vec_id": columns[1], "score": columns[2]})

    found = copies.groupBy("in_shard", "for_block").cogroup(asked.groupBy("shard", "block"))
    found = found.applyInArrow(find, "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= count)
    return ranked.select("query_id", F.col("rank").cast("int"), "vec_id", "score")
