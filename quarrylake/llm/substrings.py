"""Substring dedup over a compacted De Bruijn graph of word windows.

Every 13 consecutive words are an edge of the graph. Within a document, neighbouring
edges that share their minimizer (the five-word run of least hash, the leftmost of
equal ones) form one path, about five edges long, so a document is a short list of
paths. Equal edges have equal minimizers, in whatever documents they stand; so paths
meet in a join on the minimizer:

- a minimizer of one document only: none of its edges repeats;
- all its paths are equal: the path does not branch anywhere in the corpus and stays
  compacted, one row for all its edges;
- paths differ: it branches, and its edges are opened and compared one by one.

In either case the least document that holds an edge is its source; in every other
document the words under it go. The rows carry source coordinates (document, first
word), the covered words of a document are merged into spans, and the second pass
cuts them from the text. Edges are told apart by two independent 64-bit hashes,
that of the minimizer and that of the window.

Defined cases: null, empty and short texts (under 13 words) have no window and lose
nothing; a null doc_id orders last; rows that repeat id and text are judged alike
and never against each other; a window that repeats inside one document only is
kept; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarrylake.llm.common import release, stored
from quarrylake.llm.neardup import with_text_hash
from quarrylake.llm.shingles import WordHashes, mixed, runs

WINDOW = 13
MINIMIZER = 5
SPREAD = WINDOW - MINIMIZER + 1  # minimizer places in a window, and the most edges of a path
LAST = 2**63 - 1  # order of a null doc_id

KEY = ["doc_id", "text_hash"]
PATH = pa.struct([("m", pa.int64()), ("s", pa.int64()), ("at", pa.int64())])
SCANNED = pa.schema([("doc_id", pa.int64()), ("text_hash", pa.int64()), ("n_words", pa.int64()), ("words_sha", pa.string()), ("paths", pa.list_(PATH))])
EDGES = pa.schema([("doc_id", pa.int64()), ("text_hash", pa.int64()), ("m", pa.int64()), ("w", pa.int64()), ("at", pa.int64())])
CUT = pa.schema([("doc_id", pa.int64()), ("text_hash", pa.int64()), ("n_words", pa.int64()), ("spans", pa.list_(pa.list_(pa.int64()))), ("kept_sha256", pa.string())])

# A path's place: first edge and number of edges in one number.
SIXTEEN = 16


def split_words(text: str) -> list[bytes]:
    return text.encode().split()


def sha_of(words: list[bytes]) -> str:
    return hashlib.sha256(b" ".join(words)).hexdigest()


def paths_of(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Minimizer, content hash and place of every path of a document's word hashes."""
    if len(hashes) < WINDOW:
        return (np.zeros(0, np.int64),) * 3
    small, windows = runs(hashes, MINIMIZER), runs(hashes, WINDOW)
    least = np.arange(len(windows)) + np.lib.stride_tricks.sliding_window_view(small, SPREAD).argmin(axis=1)
    first = np.flatnonzero(np.append(True, least[1:] != least[:-1]))
    length = np.append(first[1:], len(windows)) - first
    # The first and last window overlap, so with their distance they fix the path's words.
    content = mixed(mixed(windows[first], 21) + windows[first + length - 1] * np.uint64(3) + length.astype(np.uint64))
    return small[least[first]].view(np.int64), content.view(np.int64), first * SIXTEEN + length


def scanned(docs: DataFrame) -> DataFrame:
    """Stored per row: key, word count, digest of the words, paths."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        for whole in batches:
            for rows in (whole.slice(i, 2000) for i in range(0, whole.num_rows, 2000)):
                counts, digests, parts = [], [], []
                for text in rows.column("text").to_pylist():
                    words = split_words(text)
                    counts.append(len(words))
                    digests.append(sha_of(words))
                    parts.append(paths_of(known.of(words)))
                offsets = np.cumsum([0] + [len(p[0]) for p in parts])
                fields = [pa.array(np.concatenate([p[i] for p in parts])) for i in range(3)]
                paths = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.StructArray.from_arrays(fields, fields=list(PATH)))
                columns = [rows.column("doc_id"), rows.column("text_hash"), pa.array(counts, pa.int64()), pa.array(digests), paths]
                yield pa.RecordBatch.from_arrays(columns, schema=SCANNED)

    schema = "doc_id bigint, text_hash bigint, n_words bigint, words_sha string, paths array<struct<m:bigint,s:bigint,at:bigint>>"
    return stored(with_text_hash(docs).mapInArrow(each, schema), "substrings-scan")


def order_of(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.col(doc_id), F.lit(LAST))


def same_key(left: DataFrame, right: DataFrame, how: str = "inner") -> DataFrame:
    """Join by (doc_id, text_hash), null ids alike; the right key columns go."""
    named = right.withColumnsRenamed({"doc_id": "__id", "text_hash": "__hash"})
    on = (F.col("text_hash") == F.col("__hash")) & F.col("doc_id").eqNullSafe(F.col("__id"))
    return left.join(named, on, how).drop("__id", "__hash")


def first_copies(scan: DataFrame) -> DataFrame:
    """Stored per key with words: whether an equal word sequence has a smaller document."""
    rows = scan.filter("n_words > 0").select(*KEY, "words_sha", order_of().alias("ord")).distinct()
    least = rows.groupBy("words_sha").agg(F.min("ord").alias("least"))
    return stored(rows.join(least, "words_sha").select(*KEY, (F.col("ord") > F.col("least")).alias("copied")), "substrings-copies")


def repeated_paths(scan: DataFrame) -> DataFrame:
    """Stored paths whose minimizer occurs in two documents: key, m, at, the least
    document of the minimizer, and whether all its paths are equal."""
    rows = scan.select(*KEY, F.explode("paths").alias("p")).select(*KEY, "p.m", "p.s", "p.at")
    groups = rows.groupBy("m").agg(F.min(order_of()).alias("least"), F.max(order_of()).alias("most"), F.min("s").alias("lo"), F.max("s").alias("hi"))
    # Stored, so that the join below is one of two plain shuffles, which Spark splits where a
    # minimizer is hot, and so that the shuffle of the counts is gone by then.
    repeated = stored(groups.filter("least < most").select("m", "least", (F.col("lo") == F.col("hi")).alias("uniform")), "substrings-minimizers")
    release(scan.sparkSession)
    found = rows.select(*KEY, "m", "at").join(repeated, "m")
    # Equal paths only matter where a smaller document has them.
    return stored(found.filter(~F.col("uniform") | (F.col("least") < order_of())), "substrings-paths")


def opened_edges(docs: DataFrame, branching: DataFrame) -> DataFrame:
    """Stored edges (key, m, w, at) of the branching paths."""
    lists = branching.groupBy(*KEY).agg(F.collect_list(F.struct("m", "at")).alias("paths"))  # no more than a document's own

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        for whole in batches:
            for rows in (whole.slice(i, 500) for i in range(0, whole.num_rows, 500)):
                sizes, ms, ws, ats = [], [], [], []
                for text, paths in zip(rows.column("text").to_pylist(), rows.column("paths"), strict=True):
                    windows = runs(known.of(split_words(text)), WINDOW)
                    m, at = (paths.values.field(i).to_numpy() for i in range(2))
                    first, length = np.divmod(at, SIXTEEN)
                    places = np.repeat(first, length) + np.arange(length.sum()) - np.repeat(np.cumsum(length) - length, length)
                    sizes.append(len(places))
                    ms.append(np.repeat(m, length))
                    ws.append(windows[places].view(np.int64))
                    ats.append(places)
                owner = pa.array(np.repeat(np.arange(rows.num_rows), sizes))
                columns = [rows.column("doc_id").take(owner), rows.column("text_hash").take(owner), *(pa.array(np.concatenate(c)) for c in (ms, ws, ats))]
                yield pa.RecordBatch.from_arrays(columns, schema=EDGES)

    texts = same_key(with_text_hash(docs), lists).select(*KEY, "text", "paths")
    return stored(texts.mapInArrow(each, "doc_id bigint, text_hash bigint, m bigint, w bigint, at bigint"), "substrings-edges")


def covered_spans(paths: DataFrame, edges: DataFrame) -> DataFrame:
    """Stored (key, spans): first edge and last edge of every repeated run that has a smaller source."""
    first = F.floor(F.col("at") / SIXTEEN).cast("long")
    compact = paths.filter("uniform").select(*KEY, first.alias("first"), (first + F.col("at") % SIXTEEN - 1).alias("last"))
    sources = edges.groupBy("m", "w").agg(F.min(order_of()).alias("least"), F.max(order_of()).alias("most")).filter("least < most")
    sources = stored(sources.select("m", "w", "least"), "substrings-sources")
    release(edges.sparkSession)
    single = edges.join(sources, ["m", "w"]).filter(F.col("least") < order_of())
    pieces = compact.unionByName(single.select(*KEY, F.col("at").alias("first"), F.col("at").alias("last"))).distinct()
    return stored(pieces.groupBy(*KEY).agg(F.collect_list(F.struct("first", "last")).alias("pieces")), "substrings-spans")


def merged(first: np.ndarray, last: np.ndarray, n_words: int) -> np.ndarray:
    """Which words lie under an edge of the pieces."""
    change = np.zeros(n_words + 1, dtype=np.int64)
    np.add.at(change, first, 1)
    np.add.at(change, last + WINDOW, -1)
    return change.cumsum()[:-1] > 0


def cut_texts(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """Per key with spans: word spans removed (first, end) and the digest of the words kept."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            counts, removed, digests = [], [], []
            for text, pieces in zip(rows.column("text").to_pylist(), rows.column("pieces"), strict=True):
                words = split_words(text)
                gone = merged(pieces.values.field(0).to_numpy(), pieces.values.field(1).to_numpy(), len(words))
                edges = np.flatnonzero(np.diff(np.concatenate([[False], gone, [False]]).astype(np.int8))).reshape(-1, 2)
                counts.append(len(words))
                removed.append(edges.tolist())
                digests.append(sha_of([w for w, g in zip(words, gone.tolist(), strict=True) if not g]))
            columns = [rows.column("doc_id"), rows.column("text_hash"), pa.array(counts, pa.int64()), pa.array(removed, CUT.field("spans").type), pa.array(digests)]
            yield pa.RecordBatch.from_arrays(columns, schema=CUT)

    texts = same_key(with_text_hash(docs), spans).select(*KEY, "text", "pieces")
    return texts.mapInArrow(each, "doc_id bigint, text_hash bigint, n_words bigint, spans array<array<bigint>>, kept_sha256 string")


def repeated_spans(docs: DataFrame) -> DataFrame:
    """Per row of `docs`: doc_id, text_hash, n_words, the word spans that a smaller document
    holds (first, end), and the digest of the words kept, joined by one space."""
    spark = docs.sparkSession
    scan = scanned(docs)
    copies = first_copies(scan)
    release(spark)
    # Copies of a whole document lose all their words and need no further look.
    paths = stored(same_key(repeated_paths(scan), copies.filter("not copied")).drop("copied"), "substrings-open")
    release(spark)
    edges = opened_edges(docs, paths.filter("not uniform"))
    release(spark)
    spans = covered_spans(paths, edges)
    release(spark)
    cut = stored(cut_texts(docs, spans).select(*KEY, "spans", "kept_sha256").dropDuplicates(KEY), "substrings-cut")
    release(spark)
    rows = same_key(same_key(scan.drop("paths"), copies, "left"), cut, "left")
    gone = F.coalesce("copied", F.lit(False)) & (F.col("n_words") >= WINDOW)
    none, all_words = F.array().cast("array<array<bigint>>"), F.array(F.array(F.lit(0).cast("long"), F.col("n_words")))
    return rows.select(
        *KEY, "n_words", F.when(gone, all_words).otherwise(F.coalesce("spans", none)).alias("spans"),
        F.when(gone, F.lit(sha_of([]))).otherwise(F.coalesce("kept_sha256", "words_sha")).alias("kept_sha256"),
    )
