"""Clusters against plain full scans in Python integers."""
import hashlib
import math
import random

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from crawlsieve.llm import centroids as ce


def plain(rows, dim, k, rounds, scale, salt="3:"):
    """rows: (id, vector).  Clusters by full scans."""
    kept = [(i, [math.floor(x * scale) for x in v], v) for i, v in rows
            if v is not None and len(v) == dim and all(x is not None and math.isfinite(x) for x in v)]
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"{salt}{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[2]))
    cs = [r[1] for r in order[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(cs))
    for _ in range(rounds):
        groups = [[] for _ in cs]
        for _, v, _ in kept:
            groups[nearest(v)[1]].append(v)
        cs = [[sum(x) // len(g) for x in zip(*g)] if g else c for g, c in zip(groups, cs)]
    found = [(i, *nearest(v)[::-1]) for i, v, _ in kept]
    inertia = {j: sum(d for _, c, d in found if c == j) for j in range(len(cs))}
    return [(i, c, d, inertia[c], sum(inertia.values()), hashlib.sha256(",".join(map(str, cs[c])).encode()).hexdigest()) for i, c, d in found]


def vectors(seed, n, dim, spread=0.4):
    rng = random.Random(seed)
    homes = [[rng.uniform(-2, 2) for _ in range(dim)] for _ in range(6)]
    out = [(i, [x + rng.gauss(0, spread) for x in rng.choice(homes)]) for i in range(n)]
    return out


ODD = [(900, None), (901, []), (902, [0.5]), (903, [None, 0.0, 1.0, 2.0]), (904, [math.nan, 0.0, 1.0, 2.0]), (905, [math.inf, 0.0, 1.0, 2.0]),
       (906, [1.0] * 5), (None, [0.1, 0.2, 0.3, 0.4]), (None, [0.1, 0.2, 0.3, 0.4]), (None, None)]
DDL = "vec_id long, embedding array<double>, cluster int, distance int, ids string, own string"


def frame(spark, rows, parts=3):
    return spark.createDataFrame([(i, v, 1, 2, "x", "y") for i, v in rows], DDL).repartition(parts)


@pytest.mark.parametrize("rows,k", [
    (vectors(1, 300, 4) + ODD + vectors(1, 300, 4)[:20], 5),     # odd rows, repeated rows
    ([(i, [0.25] * 4) for i in range(30)], 4),                   # all equal: ties
    (vectors(2, 3, 4), 8),                                       # fewer vectors than clusters
    (vectors(3, 200, 4, spread=0.01), 8), ([(1, [0.5, -0.5, 0.0, 1e4])], 2)])
def test_equal_to_full_scans(spark, rows, k, monkeypatch):
    monkeypatch.setattr(ce, "BLOCK", 64)
    found = ce.cluster(frame(spark, rows), dim=4, k=k, rounds=6, scale=16)
    got = sorted(map(tuple, ce.members(spark, found).collect()), key=str)
    assert got == sorted(plain(rows, 4, k, 6, 16), key=str)
    assert found.scanned[0] == 1.0


def test_bounds_spare_scans(spark):
    found = ce.cluster(frame(spark, vectors(5, 2000, 8, spread=0.15)), dim=8, k=6, rounds=8, scale=1024)
    assert found.scanned[-1] < 0.3


@settings(max_examples=300, deadline=None)
@given(st.integers(0, 10_000), st.floats(0, 3), st.integers(2, 5))
def test_loosening_is_a_bound(seed, radius, dim):
    rng = np.random.default_rng(seed)
    center, old = rng.normal(size=dim), rng.normal(size=(3, dim)) * 2
    new = old + rng.normal(size=(3, dim)) * rng.choice([0.0, 0.1, 1.0])
    give = ce.loosening(center, radius, old, new)
    x = rng.normal(size=(400, dim))
    x = center + radius * x / np.linalg.norm(x, axis=1, keepdims=True) * rng.uniform(0, 1, size=(400, 1)) ** 0.2
    lost = np.linalg.norm(x[:, None] - old, axis=2) - np.linalg.norm(x[:, None] - new, axis=2)
    assert (lost.max(axis=0) <= give + 1e-12).all()
    assert (give <= np.linalg.norm(new - old, axis=1) * (1 + 1e-8)).all()


def test_tighter_than_full_drift():
    old, new = np.array([[10.0, 0.0]]), np.array([[10.0, 3.0]])
    assert ce.loosening(np.array([0.0, 0.0]), 1.0, old, new)[0] < 0.4 * 3
    assert ce.loosening(np.array([0.0, -50.0]), 1.0, old, new)[0] < 1e-6


def test_empty_and_too_large(spark):
    assert ce.members(spark, ce.cluster(frame(spark, []), dim=4)).collect() == []
    assert ce.members(spark, ce.cluster(frame(spark, [(1, [1.0])]), dim=4)).collect() == []
    with pytest.raises(Exception, match="does not fit a long"):
        ce.cluster(frame(spark, [(1, [1e9] * 4)]), dim=4)


def test_query_equals_sql(spark):
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{sf}/embeddings.parquet'")
    want = sorted(con.execute(ce._oracle()).fetchall())
    got = ce.op13_centroid_clusters(spark, sf)
    assert got.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert sorted(map(tuple, got.collect())) == want
