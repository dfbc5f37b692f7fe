"""Vector links against brute force."""

import numpy as np

import brute
from threadloom.llm import vector_links


def rows():
    rng = np.random.default_rng(6)
    base = rng.standard_normal((60, 16))
    vectors = [base[i] + 0.12 * rng.standard_normal(16) for i in range(60) for _ in range(5)]
    vectors += [base[0].copy() for _ in range(30)] + [3 * base[1]]
    out = [(k, [float(np.float32(x)) for x in v]) for k, v in enumerate(vectors)]
    inf, nan = float("inf"), float("nan")
    odd = [None, [0.0] * 16, [nan] + [1.0] * 15, [inf] + [1.0] * 15, [None] + [1.0] * 15, [], [1.0, 0.0], [2.0, 0.0], [1e-30, 0.0]]
    out += [(1000 + k, v) for k, v in enumerate(odd)]
    return [*out, out[3], (None, out[3][1])]


def test_near_duplicates(spark):
    data = rows()
    frame = spark.createDataFrame(data, "vec_id bigint, embedding array<float>").selectExpr("*", "1 AS node", "2 AS shard", "'x' AS kind")
    good = [v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(v) for _, v in data]
    unit = [np.array(v) / np.linalg.norm(v) if g else None for (_, v), g in zip(data, good, strict=True)]
    linked = lambda i, j: good[i] and good[j] and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= 0.9
    pairs = [(i, j) for i in range(len(data)) for j in range(i) if linked(i, j)]
    found = brute.classes(pairs, len(data))
    n = np.bincount(np.array(pairs).ravel(), minlength=len(data))
    least = {c: min((data[i][0] for i in range(len(data)) if found[i] == c and data[i][0] is not None), default=None) for c in found}
    expected = sorted((str(data[i][0]), int(n[i]), str(least[found[i]])) for i in range(len(data)))
    result = vector_links.near_duplicates(frame)
    assert sorted((str(r["vec_id"]), r["n_links"], str(r["component_id"])) for r in result.collect()) == expected
    assert result.where("kept and vec_id <> component_id").count() == 0
    assert vector_links.near_duplicates(frame.limit(0)).count() == 0


def test_audit_sees_isolated_links():
    from threadloom.llm.small_world import BEAM, Graph

    class Lossy(Graph):
        def within(self, queries, least, beam):
            q, n = np.nonzero(queries @ self.vectors.T >= least)
            # Two of the thirteen pairs, and all from outside, are lost to narrow beams.
            lost = (n >= 500) & (n < 504) & ((queries[q] != self.vectors[n]).any(axis=1)) & (beam < 2 * BEAM)
            lost |= (n == 300) & ((queries[q] != self.vectors[n]).any(axis=1)) & (beam < 4 * BEAM)
            return q[~lost], n[~lost]

    rng = np.random.default_rng(8)
    vectors = rng.standard_normal((526, 64))
    vectors[501::2] = vectors[500::2] + 0.05 * rng.standard_normal((13, 64))
    vectors = (vectors / np.linalg.norm(vectors, axis=1, keepdims=True)).astype(np.float32)
    graph = Lossy(vectors)
    assert graph.audited_beam(0.9, 0.99, 526) == 2 * BEAM
    outside = vectors[300:301] + np.float32(0.01)
    assert graph.audited_beam(0.9, 0.99, 526, more=outside / np.linalg.norm(outside)) == 4 * BEAM
    assert Lossy(vectors[:300]).audited_beam(0.9, 0.99) == BEAM


def test_double_columns_lose_no_link(spark):
    rows = [(1, [1e300, 0.0]), (2, [2e300, 0.0]), (3, [1.0, 0.0]), (4, [1e-60, 0.0]), (5, [1.0, 1e-9]), (6, [0.0, 1.0])]
    out = vector_links.near_duplicates(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")).collect()
    assert sorted(map(tuple, out)) == [(k, 4, 1, k == 1) for k in range(1, 6)] + [(6, 0, 6, True)]
    # Cosines to either side of the threshold by less than single precision tells.
    near = [[1.0, 0.0], [0.9 + 1e-12, (1 - (0.9 + 1e-12) ** 2) ** 0.5], [-0.9 + 1e-12, (1 - (0.9 - 1e-12) ** 2) ** 0.5]]
    rows = [(k, v) for k, v in enumerate(near)] + [(9, [-1.0, 0.0])]
    out = vector_links.near_duplicates(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")).collect()
    assert sorted((r["vec_id"], r["n_links"]) for r in out) == [(0, 1), (1, 1), (2, 0), (9, 0)]


def test_recall_of_thousands_a_shard(spark, monkeypatch):
    """Shards far larger than a beam: links found against brute force, none below the threshold."""
    monkeypatch.setattr(vector_links, "SHARDS", 2)
    rng = np.random.default_rng(12)
    base = rng.standard_normal((4000, 64))
    near = base[rng.integers(0, 4000, 2000)] + 0.3 * rng.standard_normal((2000, 64))
    vectors = np.concatenate([base, near]).astype(np.float32)
    frame = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(vectors)], "vec_id bigint, embedding array<float>")
    unit = vectors.astype(float) / np.linalg.norm(vectors.astype(float), axis=1, keepdims=True)
    linked = unit @ unit.T >= 0.9
    np.fill_diagonal(linked, False)
    true = linked.sum(axis=1)
    out = {r["vec_id"]: r for r in vector_links.near_duplicates(frame).collect()}
    found = np.array([out[k]["n_links"] for k in range(len(vectors))])
    assert true.sum() > 3000 and (found <= true).all()
    assert found.sum() >= 0.99 * true.sum()
    known = brute.classes(np.argwhere(np.triu(linked)).tolist(), len(vectors))
    assert np.mean([out[k]["component_id"] == known[k] for k in range(len(vectors))]) >= 0.99
