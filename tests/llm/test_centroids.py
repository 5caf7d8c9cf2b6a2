"""Centroid clustering: the screen's intervals, and whole runs against plain integer loops."""

import hashlib
import math

import numpy as np
import pytest

from quillspark.llm import centroids
from quillspark.llm.queries import ORACLE_SQL, QUERIES
from tests.oracle import SF, database, rows


def plain(table, k=16, rounds=3, size=64):
    fine = [(i, [math.floor(64 * float(x)) for x in v]) for i, v in table if v is not None and len(v) == size and all(x is not None and math.isfinite(x) for x in v)]
    first = sorted(fine, key=lambda r: (r[0] is None, hashlib.sha256(f"1:{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[1]))
    c = [list(v) for _, v in first[:k]]
    nearest = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, x)), j) for j, x in enumerate(c))
    for _ in range(rounds):
        groups = {}
        for _, v in fine:
            groups.setdefault(nearest(v)[1], []).append(v)
        c = [[sum(col) // len(groups[j]) for col in zip(*groups[j])] if j in groups else x for j, x in enumerate(c)]
    return [(i, nearest(v)[1], nearest(v)[0]) for i, v in fine], c


def test_intervals_hold_the_exact_score_at_every_size():
    rng = np.random.default_rng(3)
    for scale in (1, 100, 1 << 20, 1 << 26, (1 << 27) - 1):
        c, x = rng.integers(-scale, scale + 1, (9, 64)), rng.integers(-scale, scale + 1, (200, 64))
        x[:50] = c[rng.integers(0, 9, 50)] + rng.integers(-1, 2, (50, 64)) * (np.abs(c).max() < scale)
        screen = centroids.Screen(c.tolist())
        low, high = screen.intervals(x)
        exact = np.array([[sum(q * q for q in b) - 2 * sum(p * q for p, q in zip(a, b)) for b in c.tolist()] for a in x.tolist()], dtype=object)
        assert (low <= exact).all() and (exact <= high).all()
        near, _ = screen.nearest(x)
        assert near.tolist() == [min(range(9), key=lambda j: (centroids.plain_distance(a, c[j].tolist()), j)) for a in x.tolist()]


def test_screen_leaves_few_exact_comparisons_and_settles_ties_by_number():
    rng = np.random.default_rng(4)
    c = rng.integers(-30, 30, (16, 64))
    _, compared = centroids.Screen(c.tolist()).nearest(rng.integers(-30, 30, (5000, 64)))
    assert compared < 500
    twice = np.concatenate([c[:3], c[:3]])
    near, compared = centroids.Screen(twice.tolist()).nearest(c[:3])
    assert near.tolist() == [0, 1, 2] and compared == 6


def test_integers_beyond_the_screen():
    c = [[0] * 64, [1 << 40] * 64]
    x = np.array([[1 << 39] * 64, [(1 << 39) + 1] * 64, [3] * 64, [-(1 << 62)] * 64])
    screen = centroids.Screen(c)
    assert screen.nearest(x)[0].tolist() == [0, 1, 0, 0]
    assert screen.distance(x, np.array([0, 1, 0, 0])) == [64 << 78, 64 * ((1 << 39) - 1) ** 2, 576, 64 << 124]
    mixed = centroids.Screen([[0] * 64, [1 << 20] * 64]).nearest(np.array([[1 << 50] * 64, [5] * 64]))[0]
    assert mixed.tolist() == [1, 0]


@pytest.fixture(scope="module")
def table():
    rng = np.random.default_rng(5)
    vectors = [(int(i), [float(np.float32(x)) for x in rng.normal(0, 0.3, 64)]) for i in range(300)]
    odd = [(1000, None), (1001, []), (1002, [0.5] * 63), (1003, [0.5] * 65), (1004, [None] + [0.5] * 63), (1005, [float("nan")] + [0.5] * 63), (1006, [float("inf")] + [0.5] * 63), (None, [0.25] * 64), (7, vectors[7][1]), (7, vectors[8][1]), (1007, [0.0] * 64), (1008, [-0.0] * 64), (1009, [1e6] * 64), (1010, [-1e6] * 64)]
    return vectors + odd


def test_whole_run(spark, table, tmp_path):
    df = spark.createDataFrame([(i, v, "z", 1) for i, v in table], "vec_id long, embedding array<float>, cluster string, distance int").repartition(5)
    df.write.parquet(f"{tmp_path}/embeddings.parquet")
    got = QUERIES["op11_centroids"](spark, str(tmp_path)).collect()
    want, c = plain(table)
    assert sorted(map(str, ((r["vec_id"], r["cluster"], r["distance"]) for r in got))) == sorted(map(str, want))
    for r in got:
        assert r["cluster_inertia"] == sum(d for _, j, d in want if j == r["cluster"]) and r["inertia"] == sum(d for _, _, d in want)
        assert r["centroid_sha256"] == hashlib.sha256(",".join(map(str, c[r["cluster"]])).encode()).hexdigest()


def test_fewer_vectors_than_centroids_and_none(spark):
    df = spark.createDataFrame([(i, [float(i)] * 64) for i in range(3)], "vec_id long, embedding array<double>")
    got, c = centroids.cluster(df)
    assert sorted(map(tuple, got.select("vec_id", "distance").collect())) == [(0, 0), (1, 0), (2, 0)] and len(c) == 3
    assert centroids.cluster(df.filter("vec_id > 9"))[0].count() == 0


def test_distance_beyond_64_bits_is_null(spark, tmp_path):
    spark.createDataFrame([(0, [0.0] * 64), (1, [1e15] * 64), (2, [1e17] * 64)] + [(0, [0.0] * 64)] * 20, "vec_id long, embedding array<double>").write.parquet(f"{tmp_path}/embeddings.parquet")
    got = {r["vec_id"]: r for r in QUERIES["op11_centroids"](spark, str(tmp_path)).collect()}
    assert set(got) == {0, 1, 2} and got[0]["distance"] is not None


def test_query_and_sql(spark):
    got = QUERIES["op11_centroids"](spark, SF).toPandas()
    assert rows(got) == rows(database().sql(ORACLE_SQL["op11_centroids"]).df())
