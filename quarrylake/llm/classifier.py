"""Quality classifier: histogram gradient-boosted trees over document statistics.

One pass turns every text into a row of statistics. The trees are fitted on a
bounded sample of labelled rows (`TRAIN_ROWS`, chosen by a hash of the id), with
values cut into at most `BINS` bins, level by level to a fixed depth, so a tree is
an array of 2 ** depth - 1 splits and 2 ** depth leaves and the whole model a few
small arrays. Scoring walks all trees for a batch of rows at once in numpy.

Labels, language, source and id never enter a score.

Defined cases: a null or empty text has zero statistics and a score like any
other; rows without a usable label are not learned from, and of labels that
repeat a document the lowest counts; with one class or no labels every score is
that class's share, or one half; repeated rows are returned each; extra columns
are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarrylake.llm.common import stored

TRAIN_ROWS = 40_000
TREES, DEPTH, BINS, RATE, PENALTY, LEAST_ROWS = 80, 4, 64, 0.15, 1.0, 20

STATISTICS = (
    "log_bytes", "log_words", "word_bytes", "upper", "digits", "symbols", "bangs", "stops", "other_marks",
    "beyond_ascii", "line_words", "repeated_lines", "distinct_words", "longest_word", "markless_words", "bar_words",
)

BYTE = np.arange(256)
CLASSES = {
    "upper": (BYTE >= 65) & (BYTE <= 90), "digits": (BYTE >= 48) & (BYTE <= 57), "symbols": np.isin(BYTE, list(b"#*$%&|<>")),
    "bangs": np.isin(BYTE, list(b"!?")), "stops": np.isin(BYTE, list(b".,;:")), "other_marks": np.isin(BYTE, list(b"\"'()[]{}=+-_/\\@~^`")),
    "beyond_ascii": BYTE >= 128,
}
CLASS_MATRIX = np.stack([CLASSES[name] for name in CLASSES], axis=1).astype(np.float64)


def statistics(text: str | None) -> list[float]:
    """The statistics of a whole text, in the order of `STATISTICS`."""
    data = (text or "").encode()
    words = data.split()
    if not words:
        return [0.0] * len(STATISTICS)
    lines = [line for line in data.split(b"\n") if line.strip()]
    counts = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    shares = counts @ CLASS_MATRIX / len(data)
    n, n_lines = len(words), max(1, len(lines))
    return [
        float(np.log1p(len(data))), float(np.log1p(n)), sum(map(len, words)) / n, *shares.tolist(), n / n_lines,
        1 - len(set(lines)) / n_lines, len(set(words)) / n, float(np.log1p(max(map(len, words)))),
        float(counts[46] + counts[33] + counts[63]) / n, words.count(b"|") / n,
    ]


def with_statistics(docs: DataFrame) -> DataFrame:
    """(doc_id, x) of every row, stored."""
    arrow = pa.schema([("doc_id", pa.int64()), ("x", pa.list_(pa.float64()))])

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            x = pa.array([statistics(text) for text in rows.column("text").to_pylist()], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([rows.column("doc_id").cast(pa.int64()), x], schema=arrow)

    return stored(docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(each, "doc_id bigint, x array<double>"), "classifier-statistics")


@dataclass(frozen=True)
class Forest:
    """All trees as arrays: node i of a level has children 2i+1 and 2i+2 in its tree."""

    base: float
    feature: np.ndarray  # trees x (2 ** depth - 1)
    threshold: np.ndarray  # a row goes right if its value is greater
    leaf: np.ndarray  # trees x 2 ** depth

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 of every row; all trees advance a level at a time."""
        total = np.full(len(x), self.base)
        if self.feature.size:
            inner = self.feature.shape[1]
            rows, trees = np.arange(len(x))[:, None], np.arange(len(self.feature))[None, :]
            node = np.zeros((len(x), len(self.feature)), dtype=np.int64)
            for _ in range(int(np.log2(inner + 1))):
                node = 2 * node + 1 + (x[rows, self.feature[trees, node]] > self.threshold[trees, node])
            total += self.leaf[trees, node - inner].sum(axis=1)
        return 1 / (1 + np.exp(-total))


def fit(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH, bins: int = BINS) -> Forest:
    """Logistic boosting; splits maximise the gain over binned gradient sums."""
    inner, leaves = 2**depth - 1, 2**depth
    share = float(y.mean()) if len(y) else 0.5
    if share in (0.0, 1.0) or not len(y):
        base = float(np.log(max(share, 1e-6) / max(1 - share, 1e-6)))
        return Forest(base, np.zeros((0, inner), int), np.zeros((0, inner)), np.zeros((0, leaves)))
    edges = [np.unique(np.quantile(column, np.linspace(0, 1, bins + 1)[1:-1], method="lower")) for column in x.T]
    binned = np.stack([np.searchsorted(e, column, "left") for e, column in zip(edges, x.T, strict=True)], axis=1)
    base = float(np.log(share / (1 - share)))
    total, model = np.full(len(y), base), []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-total))
        gradient, weight = y - p, p * (1 - p)
        feature, threshold, node = np.zeros(inner, int), np.full(inner, np.inf), np.zeros(len(y), dtype=np.int64)
        for level in range(depth):
            first, width = 2**level - 1, 2**level
            gains = np.zeros((width, x.shape[1]))
            cuts = np.zeros((width, x.shape[1]), int)
            for f in range(x.shape[1]):
                cell = (node - first) * bins + binned[:, f]
                g, h, n = (np.bincount(cell, w, width * bins).reshape(width, bins).cumsum(axis=1) for w in (gradient, weight, None))
                worth = lambda a, b: a * a / (b + PENALTY)
                gain = worth(g, h) + worth(g[:, -1:] - g, h[:, -1:] - h) - worth(g[:, -1:], h[:, -1:])
                gain[(n < LEAST_ROWS) | (n[:, -1:] - n < LEAST_ROWS)] = 0
                cuts[:, f] = gain.argmax(axis=1)
                gains[:, f] = gain.max(axis=1)
            for i, f in enumerate(gains.argmax(axis=1)):
                if gains[i, f] > 1e-9:
                    feature[first + i], threshold[first + i] = f, edges[f][cuts[i, f]]
            node = 2 * node + 1 + (x[np.arange(len(y)), feature[node]] > threshold[node])
        at = node - inner
        leaf = RATE * np.bincount(at, gradient, leaves) / (np.bincount(at, weight, leaves) + PENALTY)
        total += leaf[at]
        model.append((feature, threshold, leaf))
    return Forest(base, *(np.stack(part) for part in zip(*model, strict=True)))


def remainder(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 3; rows with remainder 1 are held out."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 3


def training_rows(rows: DataFrame, labels: DataFrame, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """At most `limit` labelled rows that are not held out: those with the least hash of their id."""
    once = labels.filter(F.col("quality").isin(0, 1)).groupBy("doc_id").agg(F.min("quality").alias("quality"))
    known = once.filter(remainder(F.col("doc_id")) != 1)
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)
    found = rows.join(stored(chosen, "classifier-labels"), "doc_id").select("x", "quality").dropDuplicates().toArrow()
    if not found.num_rows:
        return np.zeros((0, len(STATISTICS))), np.zeros(0)
    x = found.column("x").combine_chunks().flatten().to_numpy().reshape(-1, len(STATISTICS))
    y = found.column("quality").to_numpy().astype(float)
    order = np.lexsort((*x.T, y))  # the fit does not depend on the order in which rows arrive
    return x[order], y[order]


def classify(docs: DataFrame, labels: DataFrame, limit: int = TRAIN_ROWS) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row of `docs`."""
    rows = with_statistics(docs)
    model = rows.sparkSession.sparkContext.broadcast(fit(*training_rows(rows, labels, limit)))
    arrow = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            x = part.column("x").flatten().to_numpy().reshape(-1, len(STATISTICS))
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(model.value.score(x))], schema=arrow)

    scored = rows.mapInArrow(each, "doc_id bigint, score double")
    return scored.select(
        "doc_id", F.coalesce(remainder(F.col("doc_id")) == 1, F.lit(False)).alias("held_out"),
        "score", (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
