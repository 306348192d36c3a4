"""Exact top-k inner products over an impact-ordered, score-at-a-time index.

A shard holds up to `SHARD` whole-number vectors. Per dimension its posting list is
ordered by value and cut into segments of equal quantised value. A query reads
segments by descending quantised impact (its own weight times the segment's level,
values counted from the dimension's least or, for negative weights, from its
greatest, so every impact is non-negative) and adds the impact's lower end to the
accumulators. What is unread bounds what any vector can still gain. Reading stops
when that proves that all but a few vectors stay below the k-th best score; those
few, and everything not proven out, are scored exactly. The k best of earlier
shards of the same task serve as a threshold for the next shard.

The queries come in blocks of `BLOCK` rows, which is all that is ever broadcast or
held by the driver; each block meets every shard, and each task returns k rows a query.

Defined cases: vectors that are null, empty, or hold a null or non-finite component
take no part; a query only meets vectors of its own dimension; rows with a null id
take no part; rows that repeat an id are candidates of their own, and a query meets
none that carries its id; repeated query rows count once per distinct vector; ties
go to the smaller id; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarrylake.llm.common import batch, stored
from quarrylake.session import scratch_path

SHARD = 16_384  # vectors in a shard
BLOCK = 4_096  # queries in a broadcast
LEVELS = 8  # quantised values of a dimension
CHECKS = 8  # times a proof is tried while reading
ENOUGH = 64  # reading also stops once no more than this many vectors, or 4k, are left to score

SHARD_ARROW = pa.schema([("dims", pa.int32()), ("ids", pa.binary()), ("vectors", pa.binary()), ("postings", pa.binary())])
FOUND_ARROW = pa.schema([("query", pa.int64()), ("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])


def whole(vector: Column) -> Column:
    """floor(1024 x) of every component, as double first."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * 1024).cast("bigint"))


def sound(vector: Column) -> Column:
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return vector.isNotNull() & (F.size(vector) > 0) & F.coalesce(F.forall(vector, finite), F.lit(False))


def whole_vectors(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    rows = vectors.filter(F.col(vec_id).isNotNull() & sound(F.col(embedding)))
    return rows.select(F.col(vec_id).cast("bigint").alias("vec_id"), whole(F.col(embedding)).alias("v"))


def matrix(column: pa.ListArray, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


def index(vectors: DataFrame) -> DataFrame:
    """Stored shards of (vec_id, v): ids, vectors, and per dimension the rows by descending value."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}

        def shard(dims: int) -> pa.RecordBatch:
            parts = waiting.pop(dims)
            ids, rows = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
            order = np.argsort(-rows, axis=0, kind="stable").astype(np.uint16).T
            return batch(SHARD_ARROW, {"dims": [dims], "ids": [ids.tobytes()], "vectors": [rows.tobytes()], "postings": [np.ascontiguousarray(order).tobytes()]})

        for rows in batches:
            sizes = np.asarray(rows.column("v").value_lengths())
            for dims in np.unique(sizes):
                own = rows.filter(pa.array(sizes == dims))
                values, ids = matrix(own.column("v"), int(dims)), own.column("vec_id").to_numpy()
                while len(ids):
                    room = SHARD - sum(len(p[0]) for p in waiting.get(int(dims), []))
                    waiting.setdefault(int(dims), []).append((ids[:room], values[:room]))
                    if len(ids) >= room:
                        yield shard(int(dims))
                    ids, values = ids[room:], values[room:]
        for dims in list(waiting):
            yield shard(dims)

    return stored(vectors.mapInArrow(each, "dims int, ids binary, vectors binary, postings binary"), "topk-index")


class Shard:
    """Posting segments of a shard, read by descending impact."""

    def __init__(self, dims: int, ids: bytes, vectors: bytes, postings: bytes) -> None:
        self.ids = np.frombuffer(ids, np.int64)
        self.vectors = np.frombuffer(vectors, np.int64).reshape(-1, dims)
        self.postings = np.frombuffer(postings, np.uint16).reshape(dims, -1).astype(np.int64)
        self.low, self.high = self.vectors.min(axis=0), self.vectors.max(axis=0)
        # Step of a dimension's levels; level l holds impacts from l * step below (l + 1) * step.
        self.step = (self.high - self.low) // LEVELS + 1
        ordered = np.take_along_axis(self.vectors.T, self.postings, axis=1)
        self.up = self.edges((ordered - self.low[:, None])[:, ::-1])
        self.down = self.edges(self.high[:, None] - ordered)

    def edges(self, impacts: np.ndarray) -> np.ndarray:
        """Per dimension, where each level begins among the impacts in ascending order."""
        return np.stack([np.searchsorted(row, np.arange(LEVELS + 1) * step) for row, step in zip(impacts, self.step, strict=True)])

    def best(self, query_id: int, query: np.ndarray, k: int, floor: int | None) -> list[tuple[int, int]]:
        """(score, id) of every row that may be among the k best and reaches `floor`, k at most."""
        n = len(self.ids)
        others = np.flatnonzero(self.ids != query_id)  # the query's own rows, however many, prove nothing
        weight = np.abs(query)
        base = int(np.where(query > 0, query * self.low, query * self.high).sum())
        slack = int((weight * (self.step - 1)).sum())
        dims, levels = np.divmod(np.argsort(-(weight * self.step)[:, None] * np.arange(LEVELS), axis=None, kind="stable"), LEVELS)
        unread = np.full(len(query), LEVELS)  # levels of each dimension still to read
        sums = np.full(n, base, dtype=np.int64)
        alive = np.arange(n)
        # A shard that has no more rows than may be left to score needs no reading.
        for part in np.array_split(np.arange(len(dims)), CHECKS) if n > max(ENOUGH, 4 * k) else ():
            for d, level in zip(dims[part].tolist(), levels[part].tolist(), strict=True):
                unread[d] = level
                if weight[d] and level:
                    edges, row = (self.up, self.postings[d, ::-1]) if query[d] > 0 else (self.down, self.postings[d])
                    sums[row[edges[d, level]:edges[d, level + 1]]] += weight[d] * level * self.step[d]
            # An unread dimension adds less than its next unread level's upper end.
            more = int((weight * np.where(unread > 0, unread * self.step - 1, 0)).sum())
            least = floor if floor is not None else None
            rest = sums[others]
            if len(rest) >= k:
                kth = int(np.partition(rest, len(rest) - k)[len(rest) - k])
                least = kth if least is None else max(least, kth)
            if least is not None:
                alive = others[rest + slack + more >= least]
                if len(alive) <= max(ENOUGH, 4 * k):
                    break
        scores = self.vectors[alive] @ query
        ids = self.ids[alive]
        other = ids != query_id
        scores, ids = scores[other], ids[other]
        if floor is not None:
            scores, ids = scores[reach := scores >= floor], ids[reach]
        order = np.lexsort((ids, -scores))[:k]
        return list(zip(scores[order].tolist(), ids[order].tolist(), strict=True))


def top_k(shards: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best of every query (vec_id, v), ties to the smaller id."""
    spark = shards.sparkSession
    path = scratch_path(spark, "topk-found")
    rows = queries.distinct().toLocalIterator(prefetchPartitions=False)
    number = 0
    while block := [(number + i, r["vec_id"], np.array(r["v"], dtype=np.int64)) for i, r in enumerate(islice(rows, BLOCK))]:
        number += len(block)
        best_of_block(shards, spark.sparkContext.broadcast(block), k).write.mode("append").parquet(path)
    if not number:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint")
    return spark.read.schema("query_id bigint, rank int, vec_id bigint, score bigint").parquet(path)


def best_of_block(shards: DataFrame, block, k: int) -> DataFrame:
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, list[tuple[int, int]]] = {}
        for rows in batches:
            for row in rows.to_pylist():
                shard = Shard(row["dims"], row["ids"], row["vectors"], row["postings"])
                for number, query_id, query in block.value:
                    if len(query) != row["dims"]:
                        continue
                    known = best.get(number, [])
                    floor = known[-1][0] if len(known) == k else None
                    merged = known + shard.best(query_id, query, k, floor)
                    best[number] = sorted(merged, key=lambda x: (-x[0], x[1]))[:k]
        names = {number: query_id for number, query_id, _ in block.value}
        flat = [(n, names[n], vec_id, score) for n, found in best.items() for score, vec_id in found]
        if flat:
            yield batch(FOUND_ARROW, dict(zip(FOUND_ARROW.names, zip(*flat, strict=True), strict=True)))

    found = shards.mapInArrow(each, "query bigint, query_id bigint, vec_id bigint, score bigint")
    rank = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
