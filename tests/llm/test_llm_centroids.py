import hashlib
import math

import numpy as np

from quarrylake.llm import centroids

SCHEMA = "vec_id long, embedding array<float>, cluster string, v int"


def plain_kmeans(rows, k, rounds, seed):
    """Every vector against every centroid, in whole numbers."""
    kept = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows]
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"{seed}:{r[0]}".encode()).hexdigest(), r[1]))
    points = [v for _, v in order[:k]]
    nearest = lambda v: min((sum((x - y) ** 2 for x, y in zip(v, c, strict=True)), j) for j, c in enumerate(points))
    for _ in range(rounds):
        own = [[] for _ in points]
        for _, v in kept:
            own[nearest(v)[1]].append(v)
        points = [[sum(x) // len(vs) for x in zip(*vs, strict=True)] if vs else c for vs, c in zip(own, points, strict=True)]
    return sorted(((i, nearest(v)[1], nearest(v)[0]) for i, v in kept), key=str), points


def vectors(seed, count, dims):
    draw = np.random.default_rng(seed)
    middle = draw.normal(0, 1, (5, dims))
    rows = [(int(i), (middle[i % 5] + draw.normal(0, 0.3, dims)).astype(np.float32).tolist()) for i in range(count)]
    return rows + [rows[0], rows[0], (None, rows[1][1]), (count, [0.0] * dims), (count + 1, [-1.5] * dims)]


def test_search_is_exact_and_ties_go_to_the_smaller_number():
    draw = np.random.default_rng(1)
    for turn in range(300):
        k, dims, size = int(draw.integers(1, 12)), int(draw.choice([1, 2, 8, 64])), int(draw.choice([2, 5, 100, 1 << 27]))
        points, own = draw.integers(-size, size + 1, (k, dims)), draw.integers(-size, size + 1, (40, dims))
        if turn % 3 == 0:
            own[:k] = points
        number, distance, _ = centroids.Nearest(points.tolist()).of(own)
        every = np.square(own[:, None] - points[None]).sum(axis=2)
        assert (number == every.argmin(axis=1)).all() and (distance == every.min(axis=1)).all()


def test_bounds_spare_distances():
    """Vectors apart in mean, or alike in mean and apart in deviation, need one distance each."""
    level = np.arange(6)[:, None] * 1000 + np.zeros((6, 64), dtype=np.int64)
    sign = np.where(np.arange(64) % 2, 1, -1)
    spread = np.arange(6)[:, None] * 1000 * sign
    for points in (level, spread):
        own = np.repeat(points, 50, axis=0) + np.random.default_rng(2).integers(-3, 4, (300, 64))
        number, _, taken = centroids.Nearest(points.tolist()).of(own)
        assert (number == np.repeat(np.arange(6), 50)).all()
        assert taken < 1.5 * len(own) if points is level else taken < 6 * len(own)


def test_clusters_are_those_of_all_distances(spark):
    rows = vectors(3, 160, 16)
    df = spark.createDataFrame([(i, v, "x", 1) for i, v in rows], SCHEMA).repartition(7)
    kept = centroids.whole_vectors(df, 16)
    points = centroids.fit(kept, 6, 10, 3)
    want, want_points = plain_kmeans(rows, 6, 10, 3)
    assert points == want_points
    got = centroids.clustered(kept, points).collect()
    assert sorted(((r.vec_id, r.cluster, r.distance) for r in got), key=str) == want
    total = sum(d for _, _, d in want)
    for r in got:
        assert r.inertia == total and r.cluster_inertia == sum(d for _, c, d in want if c == r.cluster)
        assert r.centroid == points[r.cluster] and r.centroid_sha256 == centroids.digest(points[r.cluster])


def test_vectors_that_take_no_part(spark):
    rows = [(1, [1.0, 2.0]), (2, None), (3, []), (4, [1.0]), (5, [1.0, None]), (6, [float("nan"), 1.0]), (7, [float("inf"), 1.0]),
            (8, [1e30, 0.0]), (9, [131072.0, -131072.0]), (None, [0.5, 0.5])]
    kept = centroids.whole_vectors(spark.createDataFrame([(i, v, "x", 1) for i, v in rows], SCHEMA), 2)
    assert sorted((r.vec_id or 0) for r in kept.collect()) == [0, 1, 9]
    points = centroids.fit(kept, 8, 10, 3)
    assert len(points) == 3
    assert {r.distance for r in centroids.clustered(kept, points).collect()} == {0}
    none = centroids.whole_vectors(spark.createDataFrame([], SCHEMA), 2)
    assert centroids.clustered(none, centroids.fit(none, 8, 10, 3)).collect() == []
