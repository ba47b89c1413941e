"""Recall of one shard's graph on vectors that are hard to navigate, and ties."""

import numpy as np
import pytest


def vectors(kind, n=4096, parts=64):
    r = np.random.default_rng(3)
    if kind == "log-normal lengths":
        v = r.standard_normal((n, parts))
        return v / np.linalg.norm(v, axis=1)[:, None] * r.lognormal(0, 1, n)[:, None]
    clusters, spread = kind
    return r.standard_normal((clusters, parts))[r.integers(0, clusters, n)] + spread * r.standard_normal((n, parts))


@pytest.mark.parametrize("kind", [(40, 0.05), (40, 0.01), (100, 0.01), (600, 0.01), "log-normal lengths"])
def test_recall_of_one_graph(kind):
    from yearweave.llm.hnsw_search import Graph
    v = vectors(kind)
    graph = Graph.from_row(Graph.build(v).to_row())
    queries = v[::20]
    _, scores = graph.search(queries, 20)
    least = -np.sort(-(queries @ v.T), axis=1)[:, 19]
    recall = (scores >= least[:, None] - 1e-9).mean(axis=1)
    assert recall.mean() > 0.95 and (recall == 0).mean() < 0.01


def test_lists_are_bounded_and_levels_nest():
    from yearweave.llm.hnsw_search import LOWEST_NEIGHBOURS, NEIGHBOURS, SPARE, Graph
    graph = Graph.build(vectors((40, 0.05), 2000, 16))
    assert sorted(graph.order.tolist()) == list(range(2000))
    for h, lists in enumerate(graph.neighbours):
        assert lists.shape[1] == (NEIGHBOURS if h else LOWEST_NEIGHBOURS) + SPARE and lists.max() < len(lists)
        for node, own in enumerate(lists):
            held = own[own >= 0].tolist()
            assert len(held) == len(set(held)) and node not in held
    assert [len(x) for x in graph.neighbours] == sorted((len(x) for x in graph.neighbours), reverse=True)


@pytest.mark.parametrize("n", [1, 2, 3, 5, 30])
def test_small_graphs_find_everything(n):
    from yearweave.llm.hnsw_search import Graph
    v = np.random.default_rng(n).standard_normal((n, 4))
    ids, scores = Graph.build(v).search(v, n)
    assert np.allclose(scores, -np.sort(-(v @ v.T), axis=1)) and all(sorted(row) == list(range(n)) for row in ids.tolist())


def test_ties_go_to_the_smaller_id_at_the_edge(spark):
    from yearweave.llm.hnsw_search import nearest
    rows = [(0, [1.0, 0.0])] + [(i, [1.0, float(i)]) for i in range(1, 40)]  # all as near to 0 as each other
    shuffled = spark.createDataFrame([rows[(7 * i) % 40] for i in range(40)], "vec_id long, embedding array<float>")
    got = nearest(shuffled, 5, lambda i: i == 0).orderBy("rank").collect()
    assert [(r.rank, r.vec_id, r.score) for r in got] == [(i, i, 1.0) for i in range(1, 6)]
