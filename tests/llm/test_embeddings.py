import numpy as np

from tradewind.llm import embeddings
from tradewind.llm.hnsw import Graph


def brute(rows, least=0.98):
    def usable(i, v, label):
        return i is not None and v is not None and label is not None and all(x is not None and np.isfinite(x) for x in v) and any(v)

    ok = [usable(*r) for r in rows]
    root = {r[0]: r[0] for r in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    links = [0] * len(rows)
    for a, (i, v, x) in enumerate(rows):
        for b, (j, w, y) in enumerate(rows[:a]):
            if ok[a] and ok[b] and x == y and len(v) == len(w):
                p, q = np.array(v, np.float32).astype(float), np.array(w, np.float32).astype(float)
                if p @ q >= least * np.linalg.norm(p) * np.linalg.norm(q):
                    links[a] += 1
                    links[b] += 1
                    lo, hi = sorted((find(i), find(j)))
                    root[hi] = lo
    return [(r[0], n, find(r[0]) if r[0] is not None else None, r[0] is not None and find(r[0]) == r[0]) for r, n in zip(rows, links, strict=True)]


def clusters(seed, n, size, noise, dim=16):
    draw = np.random.default_rng(seed)
    return [(c + noise * draw.normal(size=dim)).tolist() for c in draw.normal(size=(n, dim)) for _ in range(size)]


NAN, INF = float("nan"), float("inf")
EDGES = [
    (1000, None, 1), (1001, [], 1), (1002, [0.0] * 16, 1), (1003, [NAN] + [1.0] * 15, 1), (1004, [INF] + [1.0] * 15, 1),
    (1005, [None] + [1.0] * 15, 1), (1006, [1.0] * 16, None), (None, [1.0] * 16, 1), (1007, [1.0] * 16, 1), (1008, [2.0] * 16, 1),
    (1009, [1.0] * 16, 2), (1010, [1.0] * 8, 1), (1011, [1.0] * 16, 1), (1011, [1.0] * 16, 1), (1012, [-1.0] * 16, 1),
]
SCHEMA = "vec_id long, embedding array<float>, label int"


def test_equals_brute_force_over_several_shards(spark, rows):
    table = [(i, v, i % 2) for i, v in enumerate(clusters(1, 40, 8, 0.08))] + EDGES
    docs = spark.createDataFrame(table, SCHEMA)
    assert rows(embeddings.near_duplicates(docs, shard_size=50)) == sorted(brute(table), key=repr)


def test_group_larger_than_the_beam(spark, rows):
    table = [(i, v, 3) for i, v in enumerate(clusters(2, 2, 150, 0.02))]
    docs = spark.createDataFrame(table, SCHEMA)
    assert rows(embeddings.near_duplicates(docs)) == sorted(brute(table), key=repr)


def test_empty_table(spark):
    assert embeddings.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0


def test_graph_recall():
    draw = np.random.default_rng(4)
    vectors = draw.normal(size=(1500, 32)).astype(np.float32)
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    graph = Graph(vectors)
    beam, recall = embeddings.audited_beam(graph, 0.98, 0.98)
    assert recall >= 0.98
    found, _ = graph.nearest(vectors[:100], beam)
    exact = np.argsort(-(vectors[:100] @ vectors.T), axis=1)[:, :10]
    assert np.mean([len(set(f[:10]) & set(e)) / 10 for f, e in zip(found, exact, strict=True)]) >= 0.9
