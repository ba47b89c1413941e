"""Approximate nearest neighbours by largest inner product: a navigable small-world graph per shard.

Distinct vectors fall into shards by hash. A shard's graph has levels: every vector is on the lowest,
a geometrically smaller share on each further one. Vectors are inserted, those of the highest levels first: a batch
at a time searches the graph as it stands, beam by beam down the levels, and is linked to what it finds and to
its own nearest within the batch. Of its candidates a vector takes those that the diversity rule picks (a
candidate stays if no chosen neighbour is nearer to it); links go both ways, and a full list is thinned by the same
rule. Neighbours are stored as one flat array per level; as vectors are numbered in order of insertion, a level's
members are the first of them. A search passes a beam from level to level, for a block of queries at a time.
Every query visits every shard; the shards' best are merged.

Inner products have no triangle inequality, so graphs are built on vectors with one component more,
which gives all of a shard the same norm: there, the nearest is the one of the largest inner product.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import stage

#: Vectors of a shard (about): few, large shards, since every query visits all of them.
SHARD_VECTORS = 32_768
#: Neighbours a list is thinned to, and its places, on upper levels and on the lowest.
NEIGHBOURS, LOWEST_NEIGHBOURS, SPARE = 16, 32, 16
#: Width of the beam on upper levels, on insertion and on search; nodes expanded at a time.
UPPER_BEAM, INSERT_BEAM, BEAM, EXPANDED = 32, 64, 240, 4
#: Vectors inserted together (at most as many as there are already), neighbours within the batch, queries together and per task.
BATCH, BATCH_NEIGHBOURS, QUERY_BLOCK, QUERY_PART = 512, 16, 512, 65_536
#: Rows of one vector and salt that meet in a task on the way to its smallest ids.
SALTED_ROWS = 100_000


def _chosen(own: np.ndarray, among: np.ndarray, candidates: np.ndarray, most: int) -> np.ndarray:
    """Of each node's candidates (-1 for none), up to ``most`` by the diversity rule, then the nearest left out.

    ``own`` holds each candidate's nearness to the node, ``among`` the candidates' to each other. Ties: the earlier vector.
    """
    n, k = candidates.shape
    own = np.where(candidates >= 0, own, -np.inf)
    order = np.lexsort((candidates, -own), axis=1)
    rows = np.arange(n)[:, None]
    candidates, own = candidates[rows, order], own[rows, order]
    among = among[rows[:, :, None], order[:, :, None], order[:, None, :]]
    chosen = np.zeros((n, k), bool)
    for j in range(k):
        rival = np.where(chosen[:, :j], among[:, j, :j], -np.inf).max(axis=1, initial=-np.inf)
        chosen[:, j] = (candidates[:, j] >= 0) & (own[:, j] > rival) & (chosen[:, :j].sum(axis=1) < most)
    first = np.argsort(~chosen, axis=1, kind="stable")[:, :most]  # chosen ones, then the nearest of the rest
    out = np.full((n, most), -1, np.int32)
    out[:, :first.shape[1]] = candidates[rows, first]
    return out


def _pick(vectors: np.ndarray, nodes: np.ndarray, candidates: np.ndarray, most: int) -> np.ndarray:
    out = np.empty((len(nodes), most), np.int32)
    for low in range(0, len(nodes), BATCH):
        c = candidates[low:low + BATCH]
        near = vectors[c]
        own = np.einsum("nd,nkd->nk", vectors[nodes[low:low + BATCH]], near)
        out[low:low + BATCH] = _chosen(own, near @ near.transpose(0, 2, 1), c, most)
    return out


def _link(vectors: np.ndarray, graph: np.ndarray, sources: np.ndarray, targets: np.ndarray, most: int) -> None:
    """Put each source into its target's list; lists without a free place are thinned to ``most`` first."""
    order = np.argsort(targets, kind="stable")
    sources, targets = sources[order], targets[order]
    while len(targets):
        free = graph.shape[1] - (graph[targets] >= 0).sum(axis=1)
        place = np.arange(len(targets)) - np.searchsorted(targets, targets)
        fits = place < free
        graph[targets[fits], graph.shape[1] - free[fits] + place[fits]] = sources[fits]
        sources, targets = sources[~fits], targets[~fits]
        full = np.unique(targets)
        if len(full):
            kept = _pick(vectors, full, graph[full], most)
            graph[full] = -1
            graph[full, :most] = kept


def _beam(vectors: np.ndarray, graph: np.ndarray, queries: np.ndarray, entries: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``width`` best nodes met from the entries (-1: none) and their nearness, in no order."""
    n_q, n = len(queries), len(graph)
    width = min(width, n)
    seen = np.zeros((n_q, n + 1), bool)  # the last column stands for "none"
    seen[:, -1] = True
    ids = np.full((n_q, max(width, entries.shape[1])), -1, np.int64)
    ids[:, :entries.shape[1]] = entries
    np.put_along_axis(seen, ids, True, 1)

    def nearness(nodes: np.ndarray) -> np.ndarray:
        out = np.full(nodes.shape, -np.inf, np.float32)
        q, j = np.nonzero(nodes >= 0)
        out[q, j] = np.einsum("id,id->i", queries[q], vectors[nodes[q, j]])
        return out

    score, done = nearness(ids), ids < 0
    while True:
        if ids.shape[1] > width:
            keep = np.argpartition(-score, width - 1, axis=1)[:, :width]
            ids, score, done = (np.take_along_axis(x, keep, 1) for x in (ids, score, done))
        active = np.flatnonzero(~done.all(axis=1))
        if not len(active):
            return ids, score
        open_score = np.where(done[active], -np.inf, score[active])
        pick = np.argpartition(-open_score, min(EXPANDED, width) - 1, axis=1)[:, :EXPANDED]
        chosen = np.where(np.take_along_axis(done[active], pick, 1), -1, np.take_along_axis(ids[active], pick, 1))
        done[active[:, None], pick] = True
        near = np.full((n_q, chosen.shape[1] * graph.shape[1]), -1, np.int64)
        near[active] = np.where(chosen[:, :, None] >= 0, graph[chosen], -1).reshape(len(active), -1)
        near.sort(axis=1)
        near[:, 1:][near[:, 1:] == near[:, :-1]] = -1
        near[np.take_along_axis(seen, near, 1)] = -1
        np.put_along_axis(seen, near, True, 1)
        new = nearness(near)
        most = min(near.shape[1], width)
        best = np.argpartition(-new, most - 1, axis=1)[:, :most]
        near, new = np.take_along_axis(near, best, 1), np.take_along_axis(new, best, 1)
        ids, score, done = np.hstack([ids, near]), np.hstack([score, new]), np.hstack([done, near < 0])


class Graph:
    """One shard's vectors, in order of insertion, and flat neighbour arrays, lowest level first."""

    def __init__(self, vectors: np.ndarray, order: np.ndarray, neighbours: list[np.ndarray]):
        self.vectors, self.order, self.neighbours = vectors, order, neighbours

    @classmethod
    def build(cls, vectors: np.ndarray) -> Graph:
        """Insert all vectors; ``order`` holds their row numbers as given."""
        n = len(vectors)
        draw = np.random.default_rng(n).random(n)
        level = np.floor(-np.log(np.maximum(draw, 1e-12)) / np.log(NEIGHBOURS)).astype(int)
        order = np.argsort(-level, kind="stable")
        vectors, level = vectors[order], level[order]
        norms = (vectors**2).sum(axis=1)
        lifted = np.hstack([vectors, np.sqrt(np.maximum(norms.max() - norms, 0))[:, None]]).astype(np.float32)
        sizes = [int((level >= h).sum()) for h in range(level[0] + 1)]
        most = [NEIGHBOURS if h else LOWEST_NEIGHBOURS for h in range(len(sizes))]
        graphs = [np.full((size, m + SPARE), -1, np.int32) for size, m in zip(sizes, most)]
        low = 0
        while low < n:
            high = min(n, low + min(BATCH, max(low, EXPANDED)))
            batch = np.arange(low, high)
            entries = np.zeros((high - low, 1 if low else 0), np.int64)
            for h in range(len(sizes) - 1, -1, -1):
                if low:
                    entries, _ = _beam(lifted, graphs[h], lifted[batch], entries, UPPER_BEAM if h else INSERT_BEAM)
                new = batch[batch < sizes[h]]
                if not len(new):
                    continue
                own = lifted[new] @ lifted[new].T
                np.fill_diagonal(own, -np.inf)
                k = min(BATCH_NEIGHBOURS, len(new) - 1)
                within = new[np.argpartition(-own, max(k - 1, 0), axis=1)[:, :k]]
                candidates = np.hstack([entries[:len(new)], within])
                if not candidates.shape[1]:
                    continue
                picked = _pick(lifted, new, candidates, most[h])
                graphs[h][new, :most[h]] = picked
                source, target = np.repeat(new, most[h]), picked.ravel()
                linked = (target >= 0) & ~(graphs[h][np.maximum(target, 0)] == source[:, None]).any(axis=1)
                _link(lifted, graphs[h], source[linked], target[linked], most[h])
            low = high
        return cls(vectors, order, graphs)

    def to_row(self) -> dict:
        return {"n": len(self.vectors), "vectors": self.vectors.tobytes(),
                "neighbours": [x.tobytes() for x in self.neighbours], "widths": [x.shape[1] for x in self.neighbours]}

    @classmethod
    def from_row(cls, row: dict) -> Graph:
        vectors = np.frombuffer(row["vectors"], np.float64).reshape(row["n"], -1)
        return cls(vectors, np.arange(row["n"]), [
            np.frombuffer(x, np.int32).reshape(-1, w) for x, w in zip(row["neighbours"], row["widths"])])

    def search(self, queries: np.ndarray, k: int, beam: int = BEAM, ranks: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Node numbers of the k best found (-1: none) and their inner products, best first; ties by ``ranks`` (default: number)."""
        small, q32 = self.vectors.astype(np.float32), queries.astype(np.float32)
        ids = np.zeros((len(queries), 1), np.int64)
        for h in range(len(self.neighbours) - 1, -1, -1):
            ids, _ = _beam(small, self.neighbours[h], q32, ids, UPPER_BEAM if h else beam)
        exact = np.where(ids >= 0, np.einsum("qd,qmd->qm", queries, self.vectors[ids]), -np.inf)
        order = np.lexsort((ids if ranks is None else ranks[ids], -exact), axis=1)[:, :k]
        return np.take_along_axis(ids, order, 1), np.take_along_axis(exact, order, 1)


def _usable(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """Ids and double vectors; null, empty and zero vectors and such with null or non-finite parts are left out."""
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return df.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v")).filter(
        "id IS NOT NULL").filter(finite & F.exists("v", lambda x: x != 0)).withColumn("dim", F.size("v"))


def nearest(df: DataFrame, k: int, is_query, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """The ``k`` nearest found of each row for which ``is_query`` holds, among all rows but itself.

    Returns ``query_id``, ``rank`` (from 1), ``vec_id``, ``score`` (the inner product in double
    precision), nearest first, ties to the smaller id. Rows without an id or a usable vector take
    no part; equal rows count once; equal vectors under several ids are all candidates; vectors of
    another length are never candidates. Equal vectors are one node of a graph, with their ``k + 1``
    smallest ids (no further id can be among the k best). With fewer candidates than k, all found.
    """
    vectors = stage(_usable(df, id_col, vector_col), "vectors")
    total = max(1, vectors.count())
    salts = -(-total // SALTED_ROWS)
    smallest = lambda c: F.slice(F.array_sort(F.array_distinct(c)), 1, k + 1)
    distinct = stage(
        vectors.groupBy("dim", "v", F.pmod(F.xxhash64("id"), F.lit(salts)).alias("salt"))
        .agg(smallest(F.collect_list("id")).alias("ids"))
        .groupBy("dim", "v").agg(smallest(F.flatten(F.collect_list("ids"))).alias("ids")), "distinct-vectors")
    shards = max(1, -(-distinct.count() // SHARD_VECTORS))
    shard = F.pmod(F.xxhash64("v"), F.lit(shards)).cast("int")

    def build(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        dim = key[0].as_py()
        v = rows["v"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
        given = np.argsort([x[0] for x in rows["ids"].to_pylist()])  # ids are sorted: a shard's graph depends on its rows alone
        graph = Graph.build(v[given])
        row = {"dim": dim, "shard": key[1].as_py(), "ids": rows["ids"].take(pa.array(given[graph.order])).to_pylist()} | graph.to_row()
        return pa.Table.from_pylist([row], graph_schema)

    graph_schema = pa.schema([
        ("dim", pa.int32()), ("shard", pa.int32()), ("ids", pa.list_(pa.list_(pa.int64()))), ("n", pa.int32()),
        ("vectors", pa.binary()), ("neighbours", pa.list_(pa.binary())), ("widths", pa.list_(pa.int32()))])
    graphs = stage(distinct.select("dim", "v", "ids", shard.alias("shard")).groupBy("dim", "shard").applyInArrow(
        build, "dim int, shard int, ids array<array<bigint>>, n int, vectors binary, neighbours array<binary>, widths array<int>"),
        "graphs")

    parts = -(-total // QUERY_PART)
    part = lambda c: F.pmod(F.xxhash64(c), F.lit(parts)).cast("int")
    queries = vectors.filter(is_query(F.col("id"))).distinct()
    asked = queries.select(
        "dim", "id", "v", part("id").alias("part"), F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"))
    offered = graphs.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))

    def search(asked: pa.Table, offered: pa.Table) -> pa.Table:
        out = {"query_id": [], "query_v": [], "vec_id": [], "score": []}
        if asked.num_rows and offered.num_rows:
            row = offered.to_pylist()[0]
            graph, ids = Graph.from_row(row), row["ids"]
            smallest_ids = np.array([x[0] for x in ids])
            for at in range(0, asked.num_rows, QUERY_BLOCK):
                block = asked.slice(at, QUERY_BLOCK)
                own, vs = block["id"].to_pylist(), block["v"].to_pylist()
                found, scores = graph.search(np.array(vs, np.float64), k + 1, ranks=smallest_ids)
                for q, v, nodes, values in zip(own, vs, found.tolist(), scores.tolist()):
                    hits = [(-s, i) for node, s in zip(nodes, values) if node >= 0 for i in ids[node] if i != q]
                    for s, i in sorted(hits)[:k]:
                        out["query_id"].append(q)
                        out["query_v"].append(hash(tuple(v)))
                        out["vec_id"].append(i)
                        out["score"].append(-s)
        return pa.table({n: pa.array(c, pa.float64() if n == "score" else pa.int64()) for n, c in out.items()})

    found = asked.groupBy("dim", "shard", "part").cogroup(offered.groupBy("dim", "shard", "part")).applyInArrow(
        search, "query_id long, query_v long, vec_id long, score double")
    best = Window.partitionBy("query_id", "query_v").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")
