import numpy as np
import pytest

from placetally.llm import embedding_dedup
from placetally.llm.hnsw import Graph, audited_beam, near


def by_rule(vectors, least=0.98):
    """vectors: (vec_id, label, components)."""
    def usable(v):
        return v[1] is not None and v[2] and all(x is not None and np.isfinite(x) for x in v[2]) and any(v[2])
    n = len(vectors)
    root, links = list(range(n)), [0] * n
    for i in range(n):
        for j in range(i):
            a, b = vectors[i], vectors[j]
            if usable(a) and usable(b) and a[1] == b[1] and len(a[2]) == len(b[2]):
                x, y = np.array(a[2]), np.array(b[2])
                if x @ y / np.sqrt((x @ x) * (y @ y)) >= least - 1e-15:
                    links[i] += 1
                    links[j] += 1
                    p, q = root[i], root[j]
                    root = [min(p, q) if r in (p, q) else r for r in root]
    least_id = {}
    for i, r in enumerate(root):
        least_id[r] = min(least_id.get(r, vectors[i][0]), vectors[i][0])
    return sorted((v[0], links[i], least_id[root[i]], v[0] == least_id[root[i]]) for i, v in enumerate(vectors))


def frame(spark, vectors):
    return spark.createDataFrame([(i, e, label, "mine", "mine") for i, label, e in vectors],
                                 "vec_id long, embedding array<float>, label int, shard string, n string")


def result(found):
    return sorted((r.vec_id, r.n_links, r.component_id, r.kept) for r in found.collect())


@pytest.mark.parametrize("shard", [40, 16_384])
def test_links_equal_the_rule(spark, monkeypatch, shard):
    monkeypatch.setattr(embedding_dedup, "SHARD_ROWS", shard)
    monkeypatch.setattr(embedding_dedup, "BLOCK_ROWS", 30)
    rng = np.random.default_rng(1)
    vectors = []
    for i in range(90):
        x = rng.normal(size=12)
        for k in range(rng.integers(1, 4)):
            y = x + rng.normal(size=12) * 0.05 * k
            vectors.append([len(vectors), int(i % 3 > 0), np.float32(y).tolist()])
    vectors += [[500 + k, 1, vectors[7][2]] for k in range(40)] + [[600, 0, vectors[7][2]], [601, None, vectors[7][2]]]
    nan, inf = float("nan"), float("inf")
    vectors += [[700, 1, None], [701, 1, []], [702, 1, [0.0] * 12], [703, 1, [nan] * 12], [704, 1, [inf] * 12], [705, 1, [None] * 12],
                [706, 1, [1.0, 2.0]], [707, 1, [2.0, 4.0]], [708, 1, [1e-30] * 12], [709, 1, [1e30] * 12]]
    assert result(embedding_dedup.near_duplicates(frame(spark, vectors))) == by_rule(vectors)


def test_repeated_ids_are_vectors_of_their_own(spark):
    one, other, third = [1.0, 0.0, 0.0], [1.0, 0.1, 0.0], [0.0, 0.0, 1.0]
    vectors = [[1, 0, one], [2, 0, one], [3, 0, other], [1, 1, one], [7, 1, one], [9, 2, one], [9, 2, other], [9, 3, third],
               [4, 4, third], [4, 4, third], [5, 4, one]]
    assert result(embedding_dedup.near_duplicates(frame(spark, vectors))) == by_rule(vectors)
    lost = frame(spark, [[1, 0, one], [2, 0, one]]).selectExpr("if(vec_id = 2, null, vec_id) as vec_id", "embedding", "label")
    assert {(r.vec_id, r.n_links, r.component_id) for r in embedding_dedup.near_duplicates(lost).collect()} == {(1, 0, 1), (None, 0, None)}


def test_empty_table(spark):
    assert embedding_dedup.near_duplicates(frame(spark, [[1, 1, [1.0]]]).limit(0)).count() == 0


def test_graph_finds_near_vectors_among_many():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(6_000, 32))
    x[3_000:] = x[:3_000] + rng.normal(size=(3_000, 32)) * 0.015
    x[:700] = x[0] + rng.normal(size=(700, 32)) * 0.01  # a large group
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    graph = Graph.load(Graph(x).dump())
    found = near(graph, x.astype(np.float32), 0.98, audited_beam(graph, 0.98, 64, 0.25, 1_024))
    links = [np.flatnonzero(row) for row in x @ x.T >= 0.98 + 1e-4]
    assert all(len(set(b.tolist())) == len(b) for b in found)
    assert sum(np.isin(a, b).sum() for a, b in zip(links, found)) >= 0.9999 * sum(map(len, links))
