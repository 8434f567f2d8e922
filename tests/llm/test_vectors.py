"""Operator 10 against brute force; components; the pipeline."""

import numpy as np
import pytest

from veloframe.llm.components import connected
from veloframe.llm.hnsw import Graph
from veloframe.llm.vectors import audited_links, near_vectors


def test_graph_recall():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(1500, 24))
    x[:300] = x[0] + 0.02 * rng.normal(size=(300, 24))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    graph = Graph.loaded(Graph(x).dumped(), x)
    ids, _ = graph.search(x[::7].astype(np.float32), 32)
    truth = np.argsort(-(x[::7] @ x.T), axis=1)[:, 0]
    assert (ids[:, 0] == truth).mean() > 0.98 or (np.take_along_axis(x[::7] @ x.T, ids[:, :1], 1)[:, 0] > 0.999).mean() > 0.98


def test_all_is_reached():
    """Far groups that the heuristic parts are bridged, and a beam as wide as the graph finds every point."""
    rng = np.random.default_rng(5)
    x = np.repeat(rng.normal(size=(30, 8)), 60, axis=0) + 1e-3 * rng.normal(size=(1800, 8))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    graph = Graph(x)
    assert (np.sort(graph.search(x[:3].astype(np.float32), 1800)[0], axis=1) == np.arange(1800)).all()


def test_large_groups_in_large_shards():
    """Beams start narrow, are widened for groups far larger than they are, and doubled until the audit passes."""
    rng = np.random.default_rng(8)
    x = rng.normal(size=(6000, 24))
    x[:900] = x[0] + 0.03 * rng.normal(size=(900, 24))
    x[900:3000] = np.repeat(x[900:1600], 3, axis=0) + 0.05 * rng.normal(size=(2100, 24))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    ask = np.concatenate([np.arange(0, 900, 30), np.arange(900, 6000, 20)])
    found = audited_links(Graph(x), x, x[ask], ask, 0.95, 8, 64, 50, 0.99)
    truth = [set(np.flatnonzero(row)) for row in (x[ask] @ x.T) >= 0.95]
    assert all(set(f.tolist()) <= t for f, t in zip(found, truth, strict=True))
    assert sum(len(f) - 1 for f in found) >= 0.99 * sum(len(t) - 1 for t in truth) > 20_000


@pytest.fixture(scope="module")
def vectors(spark):
    rng = np.random.default_rng(7)
    x = rng.normal(size=(400, 16)).astype(np.float32)
    x[50:120] = x[0] + 0.05 * rng.normal(size=(70, 16))
    x[200:230] = x[199]
    x[230] = 3 * x[199]
    rows = [(i * 2, [float(v) for v in r]) for i, r in enumerate(x)]
    rows += [(1001, None), (1003, [0.0] * 16), (1005, [1.0] * 15 + [float("nan")]), (1007, [1.0] * 15 + [None]), (1009, []), (1011, [1.0] * 8), (1013, [float("inf")] + [1.0] * 15), (1011, [1.0] * 8)]
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3)


def test_near_vectors(vectors):
    got = sorted((r.vec_id, r.n_links, r.component_id) for r in near_vectors(vectors).collect())
    rows = [(r.vec_id, r.embedding) for r in vectors.collect()]
    sound = [i for i, (_, v) in enumerate(rows) if v and None not in v and np.isfinite(v).all() and any(v)]
    links, up = {i: 0 for i in range(len(rows))}, list(range(len(rows)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in sound:
        for j in sound:
            if i != j and len(rows[i][1]) == len(rows[j][1]):
                a, b = np.array(rows[i][1], float), np.array(rows[j][1], float)
                if a @ b / np.linalg.norm(a) / np.linalg.norm(b) >= 0.95:
                    links[i] += 1
                    x, y = sorted((root(i), root(j)), key=lambda k: rows[k][0])
                    up[y] = x
    assert got == sorted((rows[i][0], links[i], rows[root(i)][0]) for i in range(len(rows)))
    assert near_vectors(vectors.limit(0)).count() == 0


def test_components(spark):
    edges = [(i, i + 1) for i in range(40) if i not in (9, 25)] + [(100, 7), (200, 201), (5, 5)]
    got = {r.node: r.root for r in connected(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(10)}, **{i: 10 for i in range(10, 26)}, **{i: 26 for i in range(26, 41)}, 100: 0, 200: 200, 201: 200}


def test_pipeline(spark, sf):
    import corpus_pipeline as pipeline

    docs = spark.read.parquet(f"{sf}/documents.parquet")
    n = docs.count()
    columns = docs.columns
    from veloframe.llm.common import staged

    counts = []
    for name, stage in pipeline.STAGES:
        docs = staged(stage(spark, docs, sf), name)
        counts.append(docs.count())
        assert docs.columns == columns or name == "packing"
    assert [x for x, _ in pipeline.STAGES] == ["language_id", "near_duplicates", "decontamination", "personal_data", "packing"]
    assert n * 0.9 < counts[0] <= n and counts[1] < counts[0] and counts[3] == counts[2]
    kept = {d for r in docs.select("doc_ids").collect() for d in r.doc_ids}
    assert len(kept) == counts[3]
