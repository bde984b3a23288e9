"""Rounds of exact k-means beside a plain version that computes every distance."""

import hashlib

import numpy as np
from pyspark.sql import types as T
from stardw.llm import zone_maps as z

SCHEMA = T.StructType([
    T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.DoubleType())),
    T.StructField("key", T.StringType()), T.StructField("cluster", T.LongType()), T.StructField("x", T.LongType()),
])


def frame(spark, rows):
    return spark.createDataFrame([(i, v, "k", 7, 8) for i, v in rows], SCHEMA)


def plain(rows, k, rounds, dims):
    kept = [
        (i, [min(max(int(np.floor(x * 64)), -z.LIMIT), z.LIMIT) for x in v]) for i, v in rows
        if v is not None and len(v) == dims and all(x is not None and np.isfinite(x) for x in v)]

    def order(r):
        return r[0] is None, "" if r[0] is None else hashlib.sha256(f"1:{r[0]}".encode()).hexdigest(), r[1]

    centroids = [list(v) for _, v in sorted(kept, key=order)[:k]]

    def assign():
        out = []
        for _, v in kept:
            d = [sum((a - b) ** 2 for a, b in zip(v, c, strict=True)) for c in centroids]
            out.append((d.index(min(d)), min(d)))
        return out

    for _ in range(rounds):
        found = assign()
        for c in range(len(centroids)):
            mine = [v for (_, v), (place, _) in zip(kept, found, strict=True) if place == c]
            if mine:
                centroids[c] = [sum(column) // len(mine) for column in zip(*mine, strict=True)]
    found = assign()
    whole = sum(d for _, d in found)
    return sorted(((
        i, c, d, sum(x for p, x in found if p == c), whole,
        hashlib.sha256(",".join(map(str, centroids[c])).encode()).hexdigest(),
    ) for (i, _), (c, d) in zip(kept, found, strict=True)), key=repr)


def shown(df):
    return sorted((tuple(r)[:6] for r in df.collect()), key=repr)


def vectors(n, dims, seed=0, groups=0):
    rng = np.random.default_rng(seed)
    if not groups:
        return [(i, rng.normal(0, 0.2, dims).tolist()) for i in range(n)]
    middles = rng.normal(0, 5, (groups, dims))
    return [(i, (middles[i % groups] + rng.normal(0, 0.1, dims)).tolist()) for i in range(n)]


def test_equals_every_distance(spark):
    rows = vectors(200, 5)
    rows += [(i, [0.1] * 5) for i in range(300, 380)]  # one very common vector
    rows += rows[:9]  # repeated rows
    rows += [(500, None), (501, []), (502, [1.0] * 4), (503, [1.0] * 6), (504, [float("nan")] * 5),
             (505, [float("inf")] + [0.0] * 4), (506, [None] + [0.0] * 4), (None, [0.3] * 5)]
    found = z.clustered(frame(spark, rows), k=6, rounds=3, block=16, dims=5)
    assert shown(found) == plain(rows, 6, 3, 5)


def test_blocks_and_tasks_do_not_change_a_result(spark):
    df = frame(spark, vectors(150, 8, 3))
    one = shown(z.clustered(df.coalesce(1), k=5, block=7, dims=8))
    assert one == shown(z.clustered(df.repartition(6), k=5, block=64, dims=8))


def test_boxes_rule_out_centroids_of_grouped_vectors(spark):
    rows = vectors(400, 6, 1, groups=8)
    found = z.clustered(frame(spark, rows), k=8, block=16, dims=6)
    assert shown(found) == plain(rows, 8, 3, 6)
    assert found.agg({"compared": "avg"}).first()[0] < 4


def test_no_candidate_is_lost():
    rng = np.random.default_rng(5)
    for _ in range(200):
        points = rng.integers(-9, 10, (12, 3)).astype(np.int32)
        centroids = rng.integers(-9, 10, (6, 3)).astype(np.int64)
        some = z.candidates(points.min(axis=0), points.max(axis=0), centroids)
        assert set(z.nearest(points, centroids)[0].tolist()) <= set(some.tolist())


def test_huge_and_tied_components(spark):
    rows = [(i, [1e300 * s, -1e300, 0.0, 1.0]) for i, s in enumerate([1, -1, 1, -1])] + [(9, [0.5] * 4), (10, [0.5] * 4)]
    found = z.clustered(frame(spark, rows), k=3, rounds=2, block=2, dims=4)
    wanted = plain(rows, 3, 2, 4)
    assert [r[:3] for r in shown(found)] == [r[:3] for r in wanted]


def test_fewer_vectors_than_centroids_and_none(spark):
    rows = vectors(3, 4)
    assert shown(z.clustered(frame(spark, rows), k=16, dims=4)) == plain(rows, 16, 3, 4)
    assert z.clustered(frame(spark, [(1, [1.0])]), dims=4).count() == 0
    assert z.clustered(frame(spark, [(1, [1.0])]).limit(0), dims=4).count() == 0


def test_the_curve_visits_neighbours():
    side = 8
    cells = np.array([(a, b) for a in range(side) for b in range(side)])
    path = cells[np.lexsort(z.hilbert(cells, 3).T[::-1])]
    assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()
    cube = np.array([(a, b, c) for a in range(4) for b in range(4) for c in range(4)])
    path = cube[np.lexsort(z.hilbert(cube, 2).T[::-1])]
    assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()
