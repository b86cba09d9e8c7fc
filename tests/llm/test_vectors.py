"""Embedding near-duplicates and exact top-k against brute force."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from changeflow.llm import topk as topk_module
from changeflow.llm.embedding_dedup import near_duplicate_vectors, tile_links
from changeflow.llm.topk import CoverTree, search, top_k

SCHEMA = "vec_id long, embedding array<double>, label int"


def _vectors(seed, n, d=12, labels=3):
    rng = np.random.default_rng(seed)
    centers = rng.normal(size=(8, d))
    rows = []
    for i in range(n):
        x = centers[rng.integers(8)] + rng.normal(size=d) * rng.choice([0.05, 0.25, 1.0])
        rows.append((i, x.tolist(), int(rng.integers(labels)) if rng.random() > 0.05 else None))
    rows += [(n + i, rows[0][1], rows[0][2]) for i in range(6)]
    rows += [(n + 10, None, 1), (n + 11, [0.0] * d, 1), (n + 12, [float("nan")] * d, 1), (n + 13, [1.0, None] + [0.0] * (d - 2), 1), (n + 14, [1.0, 2.0], 1), (n + 15, [2.0, 4.0], 1), (n + 16, [], 0)]
    return rows


def _usable(v):
    return bool(v) and all(x is not None and math.isfinite(x) for x in v) and any(v)


def _links(rows, threshold):
    up, count = {r[0]: r[0] for r in rows}, {r[0]: 0 for r in rows}

    def root(a):
        while up[a] != a:
            a = up[a]
        return a

    for i, (a, x, la) in enumerate(rows):
        for b, y, lb in rows[:i]:
            if la is not None and la == lb and _usable(x) and _usable(y) and len(x) == len(y):
                x_, y_ = np.array(x), np.array(y)
                if x_ @ y_ / np.sqrt((x_ @ x_) * (y_ @ y_)) >= threshold:
                    count[a] += 1
                    count[b] += 1
                    ra, rb = sorted((root(a), root(b)))
                    up[rb] = ra
    return {a: (count[a], root(a)) for a in up}


@pytest.mark.parametrize("threshold", [0.93, 0.7])
def test_near_duplicates(spark, threshold):
    rows = _vectors(1, 260)
    out = near_duplicate_vectors(spark.createDataFrame(rows, SCHEMA).withColumn("component_id", F.lit("clash")), threshold).collect()
    assert {r["vec_id"]: (r["n_links"], r["component_id"]) for r in out} == _links(rows, threshold)
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in out) and len(out) == len(rows)


def test_tiles_by_hash(spark, monkeypatch):
    from changeflow.llm import embedding_dedup

    monkeypatch.setattr(embedding_dedup, "TILE", 20)
    rows = _vectors(3, 200, labels=1)
    out = near_duplicate_vectors(spark.createDataFrame(rows, SCHEMA), 0.9).collect()
    assert {r["vec_id"]: (r["n_links"], r["component_id"]) for r in out} == _links(rows, 0.9)


def test_repeated_rows_and_no_rows(spark):
    rows = [(1, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (2, [1.0, 0.01], 1), (None, [1.0, 0.0], 1)]
    out = sorted((r["vec_id"], r["n_links"], r["component_id"]) for r in near_duplicate_vectors(spark.createDataFrame(rows, SCHEMA)).collect())
    assert out == [(1, 2, 1), (1, 2, 1), (2, 2, 1)]
    assert near_duplicate_vectors(spark.createDataFrame([], SCHEMA)).count() == 0


def test_one_id_with_different_vectors(spark):
    rows = [(5, [1.0, 0.0], 1), (5, [0.0, 1.0], 1), (6, [1.0, 0.01], 1), (7, [1.0, 0.02], 1)]
    out = sorted((r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in near_duplicate_vectors(spark.createDataFrame(rows, SCHEMA)).collect())
    assert out == [(5, 0, 5, True), (5, 2, 5, True), (6, 2, 5, False), (7, 2, 5, False)]


def test_bounds_lose_no_pair():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(300, 16)) + 1.2
    axes = np.linalg.eigh(x.T @ x)[1][:, ::-1].T
    found = {(i, j) for a, b in tile_links(x, x, axes, 0.8, True) for i, j in zip(a.tolist(), b.tolist())}
    n = np.linalg.norm(x, axis=1)
    cos = x @ x.T / np.outer(n, n)
    assert found == {(i, j) for i in range(300) for j in range(i + 1, 300) if cos[i, j] >= 0.8} and found


def _brute(rows, k, scale=1024):
    clean = [(i, tuple(math.floor(scale * x) for x in v)) for i, v, _ in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q, x in set(clean):
        if q % 10 == 0:
            scored = sorted((-sum(a * b for a, b in zip(x, y)), i) for i, y in clean if i != q and len(y) == len(x))
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scored[:k])]
    return sorted(out)


@pytest.mark.parametrize("k", [1, 10, 500])
def test_top_k(spark, k, monkeypatch):
    monkeypatch.setattr(topk_module, "BLOCK", 64)
    rows = _vectors(5, 240)
    rows += [*rows[:3], (10, [3.0] * 12, 1), (11, [-2.0] * 12, 1)]  # repeats, and other vectors under a known id
    clash = spark.createDataFrame(rows, SCHEMA).withColumn("rank", F.lit("clash")).withColumn("score", F.lit(1))
    assert sorted(tuple(r) for r in top_k(clash, F.col("vec_id") % 10 == 0, k).collect()) == _brute(rows, k)


def test_top_k_edges(spark):
    assert top_k(spark.createDataFrame([], SCHEMA), F.col("vec_id") % 10 == 0).count() == 0
    huge = [(0, [1e12, -1e12], 1), (1, [3e11, 1.0], 1), (2, [1.0, 1.0], 1)]
    assert {tuple(r) for r in top_k(spark.createDataFrame(huge, SCHEMA), F.col("vec_id") % 10 == 0).collect()} == {t[:3] + (min(t[3], 2**63 - 1),) for t in _brute(huge, 10)}


def test_cover_tree():
    rng = np.random.default_rng(1)
    points = np.floor(rng.normal(size=(1500, 6)) * 50)
    tree = CoverTree(points)
    for node, (lo, hi) in enumerate(tree.range):
        own = points[tree.order[lo:hi]]
        assert np.linalg.norm(own - tree.centers[node], axis=1).max() <= tree.radii[node] + 1e-9
        assert not tree.children[node] or sum(tree.range[c][1] - tree.range[c][0] for c in tree.children[node]) == hi - lo
    best = search(points[:40], np.arange(40), np.full(40, -np.inf), points, np.arange(1500), 5)
    scores = points[:40] @ points.T
    scores[np.arange(40), np.arange(40)] = -np.inf
    for q in range(40):
        assert best.ids[q].tolist() == np.lexsort((np.arange(1500), -scores[q]))[:5].tolist()
