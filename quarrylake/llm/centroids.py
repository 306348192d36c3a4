"""Exact k-means over whole-number vectors by equal-average equal-variance search.

Centroids stand sorted by the sum of their components. A vector starts at the place of
its own sum and scans outward, the nearer sum first. With m for a vector's mean and d for
its deviation from that mean (root of the summed squares), no centroid is closer than

    dims * (m_x - m_c)^2 + (d_x - d_c)^2.

Once the first term alone exceeds the best distance so far, every centroid further out
is rejected with it (equal average); where the sum exceeds it, that centroid is (equal
variance). What is left gets its exact distance in whole numbers. Bounds are floats
and taken low enough to reject nothing that could tie.

Each round is one job over the stored vectors: a task returns one row of sums per
centroid, whatever it reads, and the driver holds the centroids only.

Defined cases: vectors that are null, of another size, or hold a null or non-finite
component take no part, nor do those with a component beyond `MOST`, whose squared
distances fit no long; a null id orders last among the first centroids and stays null;
rows that repeat an id are vectors of their own; with fewer vectors than centroids
every vector starts one; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarrylake.llm.common import stored

SCALE = 1024
MOST = 1 << 17  # greatest magnitude of a component: scaled it is 2^27, a distance in 64 dimensions at most 2^62

SUMS_ARROW = pa.schema([("cluster", pa.int32()), ("rows", pa.int64()), ("sums", pa.list_(pa.int64()))])
ASSIGNED_ARROW = pa.schema([("vec_id", pa.int64()), ("cluster", pa.int32()), ("distance", pa.int64())])


def whole_vectors(vectors: DataFrame, dims: int, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """Stored (vec_id, v): floor(SCALE * x) of every component of the vectors that take part."""
    within = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) <= MOST)
    given = F.col(embedding)
    sound = given.isNotNull() & (F.size(given) == dims) & F.coalesce(F.forall(given, within), F.lit(False))
    scaled = F.transform(given, lambda x: F.floor(x.cast("double") * SCALE).cast("int"))
    return stored(vectors.filter(sound).select(F.col(vec_id).cast("bigint").alias("vec_id"), scaled.alias("v")), "centroids-vectors")


def first_centroids(vectors: DataFrame, k: int, seed: int) -> list[list[int]]:
    """The k vectors whose ids have the least hashes; rows of one id go by their components."""
    place = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")).cast("binary"), 256)
    rows = vectors.orderBy(place.asc_nulls_last(), "v").limit(k).select("v").collect()
    return [list(r["v"]) for r in rows]


class Nearest:
    """Equal-average equal-variance search among a few centroids."""

    def __init__(self, centroids: list[list[int]]) -> None:
        points = np.array(centroids, dtype=np.int64)
        self.number = np.argsort(points.sum(axis=1), kind="stable")
        self.points = points[self.number]
        self.sums = self.points.sum(axis=1)
        self.deviations = self.deviation(self.points)

    @staticmethod
    def deviation(points: np.ndarray) -> np.ndarray:
        return np.sqrt(np.square(points - points.mean(axis=1, keepdims=True)).sum(axis=1))

    def of(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """Number and squared distance of each vector's nearest centroid, and how many distances were taken."""
        n, dims, k = *vectors.shape, len(self.points)
        sums, deviations = vectors.sum(axis=1), self.deviation(vectors)
        right = np.searchsorted(self.sums, sums)
        left = right - 1
        best = np.full(n, np.iinfo(np.int64).max, dtype=np.int64)
        number = np.full(n, k, dtype=np.int64)
        alive, taken = np.arange(n), 0
        for _ in range(k):
            to_left = np.abs(sums[alive] - self.sums[np.maximum(left[alive], 0)])
            to_right = np.abs(sums[alive] - self.sums[np.minimum(right[alive], k - 1)])
            go_left = (left[alive] >= 0) & ((right[alive] >= k) | (to_left <= to_right))
            at = np.where(go_left, left[alive], right[alive])
            left[alive] -= go_left
            right[alive] += ~go_left
            apart = np.square((sums[alive] - self.sums[at]).astype(np.float64)) / dims
            spread = np.maximum(np.abs(deviations[alive] - self.deviations[at]) * (1 - 1e-9) - 1e-3, 0)
            bar = best[alive].astype(np.float64) * (1 + 1e-9) + 1
            within = apart <= bar  # sums further out only get worse, so the scan of the others is over
            close = np.flatnonzero(within & (apart + np.square(spread) <= bar))
            rows, near = alive[close], at[close]
            distance = np.square(vectors[rows] - self.points[near]).sum(axis=1)
            taken += len(rows)
            better = (distance < best[rows]) | ((distance == best[rows]) & (self.number[near] < number[rows]))
            best[rows[better]], number[rows[better]] = distance[better], self.number[near[better]]
            alive = alive[within]
            if not len(alive):
                break
        return number, best, taken


def matrix(column: pa.ListArray) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), -1)


def sums_by_centroid(vectors: DataFrame, centroids: list[list[int]]) -> DataFrame:
    """Per task and centroid, the number of its vectors and their componentwise sum."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search, dims = Nearest(centroids), len(centroids[0])
        counts, sums = np.zeros(len(centroids), np.int64), np.zeros((len(centroids), dims), np.int64)
        for rows in batches:
            points = matrix(rows.column("v"))
            number, _, _ = search.of(points)
            counts += np.bincount(number, minlength=len(centroids))
            np.add.at(sums, number, points)
        own = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(own, pa.int32()), pa.array(counts[own]), pa.array(list(sums[own]), pa.list_(pa.int64()))], schema=SUMS_ARROW
        )

    return vectors.select("v").mapInArrow(each, "cluster int, rows bigint, sums array<bigint>")


def moved(vectors: DataFrame, centroids: list[list[int]]) -> list[list[int]]:
    """Every centroid at floor(sum / count) of its vectors; one without vectors stays."""
    parts = sums_by_centroid(vectors, centroids).select("cluster", "rows", F.posexplode("sums").alias("i", "s"))
    found = parts.groupBy("cluster", "i").agg(F.sum("rows").alias("rows"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).collect()
    means = {(r["cluster"], r["i"]): int(r["s"]) // r["rows"] for r in found}
    return [[means.get((c, i), x) for i, x in enumerate(own)] for c, own in enumerate(centroids)]


def assigned(vectors: DataFrame, centroids: list[list[int]]) -> DataFrame:
    """(vec_id, cluster, distance) of every vector."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = Nearest(centroids)
        for rows in batches:
            number, distance, _ = search.of(matrix(rows.column("v")))
            yield pa.RecordBatch.from_arrays([rows.column("vec_id"), pa.array(number, pa.int32()), pa.array(distance)], schema=ASSIGNED_ARROW)

    return vectors.mapInArrow(each, "vec_id bigint, cluster int, distance bigint")


def fit(vectors: DataFrame, k: int, rounds: int, seed: int) -> list[list[int]]:
    """The centroids after `rounds` rounds over stored (vec_id, v); no more than k of them."""
    centroids = first_centroids(vectors, k, seed)
    for _ in range(rounds if centroids else 0):
        centroids = moved(vectors, centroids)
    return centroids


def digest(centroid: list[int]) -> str:
    return hashlib.sha256(",".join(map(str, centroid)).encode()).hexdigest()


def clustered(vectors: DataFrame, centroids: list[list[int]]) -> DataFrame:
    """Every vector with its cluster, squared distance, the cluster's and the whole inertia,
    and its centroid's components and digest. An inertia beyond a long is null."""
    spark = vectors.sparkSession
    if not centroids:
        return spark.createDataFrame([], "vec_id bigint, cluster int, distance bigint, cluster_inertia bigint, inertia bigint, centroid_sha256 string, centroid array<bigint>")
    rows = stored(assigned(vectors, centroids), "centroids-assigned")
    sums = {r["cluster"]: int(r["total"]) for r in rows.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("total")).collect()}

    def by_cluster(values: list[Column]) -> Column:
        return F.get(F.array(*values), F.col("cluster"))

    numbers = range(len(centroids))
    inertia = by_cluster([F.lit(str(sums.get(c, 0))).try_cast("bigint") for c in numbers])
    points = by_cluster([F.array(*map(F.lit, c)).cast("array<bigint>") for c in centroids])
    return rows.select(
        "vec_id", "cluster", "distance", inertia.alias("cluster_inertia"), F.lit(str(sum(sums.values()))).try_cast("bigint").alias("inertia"),
        by_cluster([F.lit(digest(c)) for c in centroids]).alias("centroid_sha256"), points.alias("centroid"),
    )
