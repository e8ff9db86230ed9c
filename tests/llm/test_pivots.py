from __future__ import annotations

import math

import numpy as np
import pytest

from tallyloom.llm import pivots

ROWS = "vec_id long, embedding array<float>, label int"


def _pairs(rng, n, dim, cosine):
    x = rng.normal(size=(n, dim))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    o = rng.normal(size=(n, dim))
    o -= (o * x).sum(axis=1, keepdims=True) * x
    o /= np.linalg.norm(o, axis=1, keepdims=True)
    return x, cosine * x + math.sqrt(1 - cosine * cosine) * o


def _brute(rows):
    """(links, component) of each vec_id by all pairs."""
    ok = {i: (np.array(v, float), g) for i, v, g in rows
          if i is not None and g is not None and v and None not in v and np.isfinite(np.array(v, float)).all() and np.any(np.array(v, float))}
    root, links = {i: i for i, _, _ in rows if i is not None}, {i: 0 for i, _, _ in rows if i is not None}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in ok:
        for b in ok:
            (x, g), (y, h) = ok[a], ok[b]
            if a < b and g == h and len(x) == len(y) and x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= 0.93:
                links[a] += 1
                links[b] += 1
                p, q = sorted((find(a), find(b)))
                root[q] = p
    return {i: (links[i], find(i), find(i) == i) for i in root}


def _rows():
    rng = np.random.default_rng(1)
    x, y = _pairs(rng, 25, 64, 0.96)
    rows = [(k, v.tolist(), int(k % 3)) for k, v in enumerate(x)] + [(50 + k, v.tolist(), int(k % 3)) for k, v in enumerate(y)]
    centre = rng.normal(size=64)
    rows += [(100 + k, (centre + rng.normal(scale=0.15, size=64)).tolist(), 7) for k in range(40)]
    rows += [(200 + k, rows[0][1], 0) for k in range(5)] + [(210, rows[0][1], 1), (211, (3 * np.array(rows[0][1])).tolist(), 0)]
    rows += [(300, None, 1), (301, [], 1), (302, [0.0] * 64, 1), (303, [None] + [1.0] * 63, 1), (304, [float("nan")] * 64, 1), (305, [float("inf")] * 64, 1),
             (306, rows[1][1], None), (307, [1.0, 2.0], 1), (308, [2.0, 4.0], 1), (309, [1e30, 2e30], 1)]
    return rows


def _got(df):
    return {r.vec_id: (r.n_links, r.component_id, r.kept) for r in df.collect()}


@pytest.mark.parametrize("block", [1_000, 6])
def test_against_all_pairs(spark, monkeypatch, block):
    monkeypatch.setattr(pivots, "BLOCK", block)
    rows = _rows()
    df = spark.createDataFrame(rows, ROWS).selectExpr("*", "'x' AS vector", "'x' AS rep", "1 AS size", "0 AS pivot")
    assert _got(pivots.near_vectors(df.repartition(3))) == _brute(rows)


def test_repeated_and_missing_ids(spark):
    v = [1.0, 0.5]
    df = spark.createDataFrame([(1, v, 0), (1, v, 0), (2, v, 0), (None, v, 0)], ROWS)
    got = sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in pivots.near_vectors(df).collect()), key=repr)
    assert got == [(1, 1, 1, True), (1, 1, 1, True), (2, 1, 1, False), (None, 0, None, True)]
    assert pivots.near_vectors(df.limit(0)).collect() == []


@pytest.mark.parametrize("dim", [16, 64, 384])
def test_recall_at_the_threshold(dim):
    """Pairs right at the limit are the hardest to find."""
    x, y = _pairs(np.random.default_rng(dim), 3000, dim, 0.93)
    a, b = pivots.permutation_prefix(x), pivots.permutation_prefix(y)
    shared = np.array([len(np.intersect1d(p, q)) for p, q in zip(a, b)])
    assert (shared >= pivots.MIN_SHARED).mean() > 0.99


def test_recall_on_the_test_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    rows = [(r.vec_id, r.embedding, r.label) for r in df.collect()]
    assert _got(pivots.near_vectors(df)) == _brute(rows)
