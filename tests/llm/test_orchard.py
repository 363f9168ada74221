"""Clustering against all distances."""

import hashlib
import math

import duckdb
import numpy as np
import pytest

from marketloom.llm import orchard

SF = "/root/testdata/sf0.001"


def brute(rows, d=orchard.DIMENSIONS):
    """Rows (vec_id, embedding) by the rules, every distance computed."""
    kept = [(i, [math.floor(64 * float(x)) for x in e]) for i, e in rows if e is not None and len(e) == d and all(x is not None and math.isfinite(x) for x in e)]
    if not kept:
        return []
    centroids = [p for _, p in sorted(kept, key=lambda r: (hashlib.sha256(f"1:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))[:16]]

    def nearest(p):
        return min((sum((a - b) ** 2 for a, b in zip(p, c)), k) for k, c in enumerate(centroids))

    for _ in range(3):
        own = {}
        for _, p in kept:
            own.setdefault(nearest(p)[1], []).append(p)
        centroids = [[sum(x) // len(own[k]) for x in zip(*own[k])] if k in own else c for k, c in enumerate(centroids)]
    found = [(i, *nearest(p)) for i, p in kept]
    inertia = {k: sum(f[1] for f in found if f[2] == k) for k in range(16)}
    return [(i, k, dist, inertia[k], sum(inertia.values()), hashlib.sha256(",".join(map(str, centroids[k])).encode()).hexdigest()) for i, dist, k in found]


def test_report(spark):
    vectors = spark.read.parquet(f"{SF}/embeddings.parquet")
    got = sorted(map(tuple, orchard.cluster_report(vectors).collect()))
    assert got == sorted(brute([(r.vec_id, r.embedding) for r in vectors.collect()]))


def test_report_sql(spark):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW embeddings AS SELECT * FROM '{SF}/embeddings.parquet'")
    want = con.sql(f"SELECT vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256 FROM ({orchard.ORACLE})").fetchall()
    assert sorted(map(tuple, orchard.cluster_report(spark.read.parquet(f"{SF}/embeddings.parquet")).collect())) == sorted(want)


def test_search_is_exact_and_saves_distances():
    """Random, tied and repeated centroids; far-apart groups, where most distances are never computed."""
    rng = np.random.default_rng(4)
    for k, spread in ((1, 3), (2, 3), (16, 2), (16, 3), (40, 400)):
        centroids = rng.integers(-spread, spread, (k, 8))
        points = np.concatenate([rng.integers(-spread, spread, (500, 8)), centroids])
        far = ((points[:, None] - centroids[None]) ** 2).sum(axis=2)
        number, distance = orchard.Search(centroids).nearest(points)
        assert (number == far.argmin(axis=1)).all() and (distance == far.min(axis=1)).all()
    centroids = rng.integers(0, 1000, (16, 8)) + 100_000 * np.arange(16)[:, None]
    measured = []
    orchard.Search(centroids).nearest(centroids.repeat(20, axis=0), measured)
    assert measured[0] < 0.6 * 16 * 16 * 20


def test_awkward(spark):
    """Nulls, wrong lengths, non-finite components, repeated and tied vectors and ids, clashing columns, fewer vectors than centroids, nothing."""
    schema = "vec_id long, embedding array<float>, point string, cluster string, distance string, total int"
    rng = np.random.default_rng(9)
    base = [[float(x) for x in rng.integers(-3, 3, 64)] for _ in range(12)]
    rows = [(i, base[i % 12], "p", "c", "d", 1) for i in range(70)] + [(3, base[3], "p", None, None, None), (3, base[4], "p", None, None, None), (None, base[0], "", "", "", 0)]
    rows += [(90, None, "", "", "", 0), (91, [], "", "", "", 0), (92, [0.5] * 63, "", "", "", 0), (93, [0.5] * 65, "", "", "", 0), (94, [None, *base[0][1:]], "", "", "", 0)]
    rows += [(95 + i, [x, *base[0][1:]], "", "", "", 0) for i, x in enumerate((float("nan"), float("inf"), -float("inf")))]
    for some in (rows, rows[:5], rows[:1], rows[-6:]):
        got = orchard.cluster_report(spark.createDataFrame(some, schema).repartition(3)).collect()
        assert sorted(map(str, map(tuple, got))) == sorted(map(str, brute([r[:2] for r in some])))
    assert orchard.cluster_report(spark.createDataFrame([], schema)).count() == 0


def test_a_component_too_large(spark):
    vectors = spark.createDataFrame([(1, [1e30] + [0.0] * 63)], "vec_id long, embedding array<float>")
    with pytest.raises(Exception, match="too large|OVERFLOW|overflow"):
        orchard.cluster_report(vectors).collect()


def test_hot_vector(spark):
    vectors = spark.range(3000).selectExpr("id AS vec_id", "transform(sequence(1, 64), i -> cast(if(id % 3 = 0, 1, id % 7 + i % 5) AS float)) AS embedding")
    got = sorted(map(tuple, orchard.cluster_report(vectors).collect()))
    assert got == sorted(brute([(r.vec_id, r.embedding) for r in vectors.collect()]))
