"""Links between embeddings against all cosines."""

import math

import numpy as np
import pytest
from conftest import SF_DIR

from tidemark.llm import embedding_graph as module
from tidemark.llm.embedding_graph import LEAST, Graph, embedding_links, linked
from tidemark.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<float>, label int, node long, copies long, `a.b` string"


def usable(vector):
    return vector is not None and None not in vector and all(map(math.isfinite, vector)) and any(vector)


def expected(rows):
    """``rows``: (id, vector, label); one (id, links, component, kept) for each."""
    near = [[] for _ in rows]
    for i, (_, a, x) in enumerate(rows):
        for j, (_, b, y) in enumerate(rows):
            if i != j and x == y and x is not None and usable(a) and usable(b) and len(a) == len(b):
                u, v = (np.array(z, np.float32).astype(float) for z in (a, b))
                u, v = u / np.abs(u).max(), v / np.abs(v).max()
                if u @ v / math.sqrt(u @ u) / math.sqrt(v @ v) >= LEAST:
                    near[i].append(j)
    root = list(range(len(rows)))
    out = []
    for i in range(len(rows)):
        group, front = {i}, [i]
        while front:
            front = [k for j in front for k in near[j] if k not in group and not group.add(k)]
        ids = [rows[k][0] for k in group if rows[k][0] is not None]
        root[i] = min(ids, default=None)
        out.append((rows[i][0], len(near[i]), root[i], rows[i][0] == root[i]))
    return sorted(out, key=repr)


def cloud(seed, groups, size, dims=16, spread=0.05):
    pick = np.random.default_rng(seed)
    centres = pick.normal(size=(groups, dims))
    return (np.repeat(centres, size, 0) + spread * pick.normal(size=(groups * size, dims))).astype(np.float32)


def found(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_query_by_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/embeddings.parquet").select(
        "vec_id", "embedding", "label").collect()]
    got = found(QUERIES["op13_embedding_graph"](spark, SF_DIR))
    assert got == expected(rows)


@pytest.mark.parametrize("shard", [8192, 40])
def test_shards_give_the_same(spark, shard):
    """Near copies, exact copies and single vectors, in one shard and in several."""
    vectors = np.concatenate([cloud(1, 6, 20), cloud(2, 60, 1), np.repeat(cloud(3, 2, 1), 30, 0)])
    pick = np.random.default_rng(4).permutation(len(vectors))
    rows = [(int(i), vectors[i].tolist(), int(i % 2)) for i in pick]
    df = spark.createDataFrame([(*r, 1, 1, "x") for r in rows], SCHEMA).repartition(7)
    assert found(embedding_links(df, shard=shard)) == expected(rows)


def test_awkward_vectors(spark):
    nan, inf = float("nan"), float("inf")
    one = [1.0, 2.0, 3.0]
    rows = [
        (1, one, 1), (2, one, 1), (2, one, 1), (3, [2.0, 4.0, 6.0], 1), (4, one, 2), (5, one, None),
        (6, None, 1), (7, [], 1), (8, [0.0, -0.0, 0.0], 1), (9, [1.0, None, 3.0], 1), (10, [1.0, nan, 3.0], 1),
        (11, [1.0, inf, 3.0], 1), (12, [1.0, 2.0], 1), (None, one, 1), (None, [-1.0, 0.0, 0.0], 3),
        (13, [3e38, 3e38, 0.0], 4), (14, [1e-42, 1e-42, 0.0], 4), (15, None, None),
    ]
    df = spark.createDataFrame([(*r, None, None, None) for r in rows], SCHEMA)
    assert found(embedding_links(df)) == expected(rows)
    assert embedding_links(spark.createDataFrame([], SCHEMA)).count() == 0


def test_beams_find_what_there_is():
    vectors = np.concatenate([cloud(5, 40, 25, 24), cloud(6, 500, 1, 24), cloud(7, 1, 300, 24, 0.02)])
    graph = Graph(np.random.default_rng(8).permutation(vectors))
    assert graph.top >= 1 and all((x < len(vectors)).all() for x in graph.links)
    unit = graph.exact / graph.norms[:, None]
    truth = unit @ unit.T >= LEAST
    got = linked(graph, graph)
    assert not (got & ~truth).any() and (got & truth).sum() >= 0.99 * truth.sum()


def test_beams_widen_and_give_way(monkeypatch):
    """With links that lead nowhere, audits fail until the exact comparison takes over."""
    vectors = cloud(9, 10, 12)
    graph = Graph(vectors)
    beams = []
    near = Graph.near
    monkeypatch.setattr(Graph, "near", lambda self, queries, beam: beams.append(beam) or near(self, queries, beam))
    for links in graph.links:
        links[:] = -1
    unit = graph.exact / graph.norms[:, None]
    assert (linked(graph, graph, first_beam=4) == (unit @ unit.T >= LEAST)).all()
    assert beams == [4, 8, 16, 32, 64, 128]


def test_roots():
    links = np.zeros((4, 3), bool)
    links[[0, 1, 1, 3], [0, 0, 2, 1]] = True
    root = module._roots(links, np.ascontiguousarray(links.T))
    assert root.tolist() == [0, 0, 2, 3, 0, 3, 0]
