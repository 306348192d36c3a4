"""Best-fit packing of tokenised documents into sequences of fixed capacity.

Pieces are counted by length, a histogram of at most `CAPACITY` numbers. Patterns
of one to three lengths that fill a sequence are its columns, and non-negative
least squares says how often each pattern repeats. Repeats are rounded and never
beyond what is left; residual pieces are packed best-fit on the histogram. Where no
pattern helps, and all pieces best-fit need fewer sequences, all are the residual.
The result is a list of (lengths, repeats): its size depends on the capacity,
not on the corpus. Each piece then finds its place from its rank among the
pieces of its length, by looking up a table, so no task gathers a length.

Defined cases: a null or empty text is the closing token alone; documents longer
than the capacity are cut from the end, so only the first piece may be shorter;
repeated rows are packed each; rows with a null doc_id are packed too; extra
columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarrylake.llm.common import batch, release, stored
from quarrylake.llm.tokens import token_ids

CAPACITY = 1024
CLOSING = 2  # token id that ends every document
NNLS_ROUNDS = 300

PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids binary, part int, nth bigint"
PIECES_ARROW = pa.schema([
    ("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()),
    ("ids", pa.binary()), ("part", pa.int32()), ("nth", pa.int64()),
])


def tokenise(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY) -> DataFrame:
    """Pieces of every document, each with its task and its number among the task's
    pieces of the same length; `ids` are little-endian unsigned 32-bit."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, part, seen = token_ids(vocabulary), TaskContext.get().partitionId(), Counter()
        closing = CLOSING.to_bytes(4, "little")
        for rows in batches:
            out = {name: [] for name in PIECES_ARROW.names}
            for doc_id, text in zip(rows.column("doc_id").to_pylist(), rows.column("text").to_pylist(), strict=True):
                ids = tokens.of(text or "") + closing
                total = len(ids) // 4
                start, end, piece = 0, total % capacity or capacity, 0
                while start < total:
                    cut = ids[4 * start:4 * end]
                    length = end - start
                    for name, value in zip(PIECES_ARROW.names, (doc_id, piece, start, length, cut, part, seen[length]), strict=True):
                        out[name].append(value)
                    seen[length] += 1
                    start, end, piece = end, end + capacity, piece + 1
            yield batch(PIECES_ARROW, out)

    return docs.select("doc_id", "text").mapInArrow(each, PIECES)


def patterns(lengths: np.ndarray, capacity: int) -> np.ndarray:
    """All ways to fill a sequence exactly with one to three of the lengths, as rows of
    indices into `lengths` (descending, -1 for none)."""
    at = np.full(capacity + 1, -1)
    at[lengths] = np.arange(len(lengths))
    found = []
    if at[capacity] >= 0:
        found.append(np.array([[at[capacity], -1, -1]]))
    rest = capacity - lengths
    two = (rest > 0) & (rest <= lengths)
    two[two] = at[rest[two]] >= 0
    if two.any():
        a = np.flatnonzero(two)
        found.append(np.stack([a, at[rest[a]], np.full(len(a), -1)], axis=1))
    for a, length in enumerate(lengths):
        second = lengths[(lengths <= length) & (lengths < capacity - length)]
        third = capacity - length - second
        fits = (third > 0) & (third <= second)
        second, third = second[fits], third[fits]
        there = at[third] >= 0
        if there.any():
            b, c = at[second[there]], at[third[there]]
            found.append(np.stack([np.full(len(b), a), b, c], axis=1))
    return np.concatenate(found) if found else np.zeros((0, 3), dtype=int)


def fitted_repeats(columns: np.ndarray, counts: np.ndarray, rounds: int = NNLS_ROUNDS) -> np.ndarray:
    """Non-negative least squares of pattern repeats against length counts.

    Multiplicative updates: all entries of the system are non-negative, so each
    step keeps the repeats non-negative and never raises the squared error.
    """
    n = len(counts)
    filled = columns >= 0
    index = np.where(filled, columns, n)

    def used(repeats: np.ndarray) -> np.ndarray:
        return sum(np.bincount(index[:, k], repeats, n + 1) for k in range(3))[:n]

    def pulled(values: np.ndarray) -> np.ndarray:
        padded = np.append(values, 0.0)
        return padded[index].sum(axis=1)

    target = pulled(counts.astype(float))
    repeats = target / np.maximum(pulled(used(np.ones(len(columns)))), 1e-12)
    for _ in range(rounds):
        repeats *= target / np.maximum(pulled(used(repeats)), 1e-12)
    return repeats


def best_fit(counts: Counter, capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Best-fit decreasing on a histogram: equal sequences are one entry with a count."""
    gaps: dict[int, Counter] = {}
    order: list[int] = []  # gaps that have open sequences, ascending

    def put(lengths: tuple[int, ...], gap: int, n: int) -> None:
        if gap not in gaps:
            gaps[gap] = Counter()
            insort(order, gap)
        gaps[gap][lengths] += n

    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            i = bisect_left(order, length)
            if i == len(order):
                each = capacity // length
                whole, rest = divmod(left, each)
                if whole:
                    put((length,) * each, capacity - each * length, whole)
                if rest:
                    put((length,) * rest, capacity - rest * length, 1)
                break
            gap = order[i]
            lengths, n = next(iter(gaps[gap].items()))
            fits = gap // length
            moved = min(n, left // fits)
            if not moved:
                fits, moved = left, 1
            gaps[gap][lengths] -= moved
            if not gaps[gap][lengths]:
                del gaps[gap][lengths]
                if not gaps[gap]:
                    del gaps[gap]
                    order.remove(gap)
            put(lengths + (length,) * fits, gap - fits * length, moved)
            left -= fits * moved
    return [(lengths, n) for gap in order for lengths, n in gaps[gap].items()]


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[tuple[int, ...], int]]:
    """(lengths, repeats) that use every piece of the histogram exactly once."""
    left = Counter({length: n for length, n in histogram.items() if n})
    if not left:
        return []
    lengths = np.array(sorted(left, reverse=True))
    columns = patterns(lengths, capacity)
    chosen = []
    if len(columns):
        repeats = np.floor(fitted_repeats(columns, np.array([left[v] for v in lengths])) + 0.5).astype(int)
        for row in np.argsort(-repeats, kind="stable"):
            if not repeats[row]:
                break
            used = Counter(int(lengths[i]) for i in columns[row] if i >= 0)
            n = min(int(repeats[row]), *(left[v] // k for v, k in used.items()))
            if n:
                chosen.append((tuple(used.elements()), n))
                left.subtract({v: k * n for v, k in used.items()})
    chosen += best_fit(+left, capacity)
    residual_only = best_fit(Counter({length: n for length, n in histogram.items() if n}), capacity)
    return min(chosen, residual_only, key=lambda found: sum(n for _, n in found))


class Places:
    """Where the r-th piece of a length goes: sequence and offset, by bisection."""

    def __init__(self, chosen: list[tuple[tuple[int, ...], int]], capacity: int) -> None:
        rows, next_rank, first = [], Counter(), 0
        for lengths, n in chosen:
            offset = 0
            for length in lengths:
                rows.append((length, next_rank[length], first, offset))
                next_rank[length] += n
                offset += length
            first += n
        rows.sort()
        self.length, self.rank, self.first, self.offset = (np.array(c, dtype=np.int64) for c in zip(*rows, strict=True)) if rows else (np.zeros(0, np.int64),) * 4
        self.bounds = {int(v): (int(np.searchsorted(self.length, v)), int(np.searchsorted(self.length, v, "right"))) for v in np.unique(self.length)}

    def of(self, lengths: np.ndarray, ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        sequence, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
        for length in np.unique(lengths):
            lo, hi = self.bounds[int(length)]
            here = np.flatnonzero(lengths == length)
            row = lo + np.searchsorted(self.rank[lo:hi], ranks[here], "right") - 1
            sequence[here] = self.first[row] + ranks[here] - self.rank[row]
            offset[here] = self.offset[row]
        return sequence, offset


def place(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Stored pieces plus sequence_id and offset; drops the task's numbering."""
    spark = pieces.sparkSession
    counts = stored(pieces.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n")), "packing-counts")
    # At most `capacity` rows: the histogram that is fitted on the driver.
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    places = spark.sparkContext.broadcast(Places(plan(histogram, capacity), capacity))
    before = F.sum("n").over(Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    ranks = counts.select("length", "part", F.coalesce(before, F.lit(0)).alias("before"))
    numbered = pieces.join(stored(ranks, "packing-ranks"), ["length", "part"]).withColumn("rank", F.col("nth") + F.col("before"))
    names = [c for c in pieces.columns if c not in ("part", "nth")]
    fields = [f"`{c}` {t}" for c, t in numbered.select(names).dtypes] + ["sequence_id bigint", "offset bigint"]

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            sequence, offset = places.value.of(rows.column("length").to_numpy(), rows.column("rank").to_numpy())
            columns = [rows.column(c) for c in names] + [pa.array(sequence), pa.array(offset)]
            yield pa.RecordBatch.from_arrays(columns, names=[*names, "sequence_id", "offset"])

    return numbered.select(*names, "rank").mapInArrow(each, ", ".join(fields))


def pack(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY) -> DataFrame:
    """Every piece of every document with its token ids and its place in a sequence."""
    pieces = stored(tokenise(docs, vocabulary, capacity), "packing-pieces")
    release(docs.sparkSession)
    return place(pieces, capacity)
