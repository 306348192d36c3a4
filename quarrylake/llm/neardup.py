"""MinHash near-duplicates: one-permutation signatures, bands, star-shaped candidates.

1. One pass over the texts hashes five-word shingles. The top bits of a hash are
   its bin, the least hash of a bin its value: one permutation gives the whole
   signature. Empty bins borrow from a bin that a universal hash of (bin, attempt)
   picks, the same in every document. Bands of consecutive bins are bucket keys.
   For documents with few shingles, where bins say little, the least quarter of
   the hashes are keys instead: two sets at or above the threshold always share
   one of those. Sizes near the border get both kinds, so a pair always has one in common.
2. Documents with equal shingle sets are one class, and only classes go on.
3. In each bucket every class is paired with one centre, the member that meets
   most others over all buckets: pairs grow with bucket sizes, not their squares.
   Buckets that still hold several components get further centres, one of each
   component, until a round finds no link; pairs in one component are not tested.
   An exact prefix join then finds the links left between members of such buckets
   that were no centres: of two linked sets, ordered by rarity, the first shingles meet.
4. Candidate pairs are confirmed on full shingle sets, and components follow by
   repeated minima over confirmed links.

Defined cases: null and empty texts have no shingles, form no links and are kept;
rows without a doc_id take part under null, which orders last; repeated rows are
links of the same class; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarrylake.llm.common import WORD, batch, release, stored
from quarrylake.llm.shingles import WordHashes, mixed, shingle_set

SHINGLE = 5
PERCENT = 75  # links have 100 * intersection >= PERCENT * union

BINS = 256  # a power of two: the top bits of a hash are its bin
ROWS = 5  # bins in a band
BANDS = BINS // ROWS
ATTEMPTS = 64  # donors tried for an empty bin before the nearest full one is taken

# Below this many shingles a set's least hashes are its keys.
FEW = 64

COUNTS = 1 << 18  # counters that rank shingles by rarity; several may share one

BITS = 2048  # size of the bitmap that bounds an intersection from above

SIGNATURE = "doc_id bigint, text_hash bigint, n_shingles bigint, set_a bigint, set_b bigint, keys array<bigint>, bits array<bigint>"
SIGNATURE_ARROW = pa.schema([
    ("doc_id", pa.int64()), ("text_hash", pa.int64()), ("n_shingles", pa.int64()),
    ("set_a", pa.int64()), ("set_b", pa.int64()), ("keys", pa.list_(pa.int64())), ("bits", pa.list_(pa.int64())),
])
PREFIX = "shingle bigint, node bigint, label bigint, n int, at int"
PREFIX_ARROW = pa.schema([("shingle", pa.int64()), ("node", pa.int64()), ("label", pa.int64()), ("n", pa.int32()), ("at", pa.int32())])
SETS_ARROW = pa.schema([("node", pa.int64()), ("shingles", pa.list_(pa.int64()))])


def donors() -> np.ndarray:
    """For each attempt and bin, the bin that an empty one borrows from."""
    bins = np.arange(BINS, dtype=np.uint64)
    return np.stack([(mixed(bins, seed=1 + a) >> np.uint64(32)).astype(np.int64) % BINS for a in range(ATTEMPTS)])


def signature(hashes: np.ndarray, donor: np.ndarray) -> np.ndarray:
    """Least hash per bin of sorted hashes, empty bins densified."""
    shift = np.uint64(64 - BINS.bit_length() + 1)
    edges = np.searchsorted(hashes, np.arange(BINS, dtype=np.uint64) << shift)
    full = np.append(edges[1:], len(hashes)) > edges
    values = np.where(full, hashes[np.minimum(edges, len(hashes) - 1)], np.uint64(0))
    empty = np.flatnonzero(~full)
    for attempt in donor:
        if not len(empty):
            return values
        from_bins = attempt[empty]
        lucky = full[from_bins]
        values[empty[lucky]] = values[from_bins[lucky]]
        empty = empty[~lucky]
    if len(empty):
        there = np.flatnonzero(full)
        values[empty] = values[there[np.searchsorted(there, empty) % len(there)]]
    return values


def bucket_keys(hashes: np.ndarray, donor: np.ndarray) -> np.ndarray:
    """The buckets that a document with these sorted shingle hashes belongs to."""
    n = len(hashes)
    keys = []
    if n < FEW:
        keys.append(mixed(hashes[:n - -(-PERCENT * n // 100) + 1], seed=101))
    if 100 * n >= PERCENT * FEW:
        bands = signature(hashes, donor)[:BANDS * ROWS].reshape(BANDS, ROWS)
        total = np.arange(BANDS, dtype=np.uint64)
        for i in range(ROWS):
            total = mixed(total + bands[:, i], seed=7 + i)
        keys.append(total)
    return np.concatenate(keys)


def bitmap(hashes: np.ndarray) -> np.ndarray:
    """The low bits of the hashes as a set, 64 to a number."""
    there = np.zeros(BITS, dtype=np.uint8)
    there[(hashes % np.uint64(BITS)).astype(np.int64)] = 1
    return np.packbits(there).view(np.int64)


def signatures(docs: DataFrame) -> DataFrame:
    """Per row of (doc_id, text): shingle count, a 128-bit hash of the set, bucket keys."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, donor = WordHashes(), donors()
        none = np.zeros(0, dtype=np.int64)
        for rows in batches:
            out = {name: [] for name in SIGNATURE_ARROW.names}
            out["doc_id"], out["text_hash"] = rows.column("doc_id"), rows.column("text_hash")
            for text in rows.column("text").to_pylist():
                hashes = shingle_set(text, words, SHINGLE)
                out["n_shingles"].append(len(hashes))
                out["set_a"].append(signed(int(np.add.reduce(mixed(hashes, 11)))))
                out["set_b"].append(signed(int(np.add.reduce(mixed(hashes, 13)))))
                out["keys"].append(bucket_keys(hashes, donor).view(np.int64) if len(hashes) else none)
                out["bits"].append(bitmap(hashes))
            yield batch(SIGNATURE_ARROW, out)

    return with_text_hash(docs).mapInArrow(each, SIGNATURE)


def with_text_hash(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, text), the text not null: the first two name a document again later."""
    filled = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return filled.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")


def signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def shingle_sets(texts: DataFrame) -> DataFrame:
    """Full shingle sets of (node, text) rows."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordHashes()
        for rows in batches:
            for part in (rows.slice(i, 500) for i in range(0, rows.num_rows, 500)):
                sets = [shingle_set(text, words, SHINGLE).view(np.int64) for text in part.column("text").to_pylist()]
                yield batch(SETS_ARROW, {"node": part.column("node"), "shingles": sets})

    return texts.select("node", "text").mapInArrow(each, "node bigint, shingles array<bigint>")


def classes_of(sig: DataFrame) -> DataFrame:
    """One row per distinct shingle set: its row number `node`, and the row that stands for it."""
    order = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "text_hash")
    least = sig.filter("n_shingles > 0").groupBy("set_a", "set_b").agg(F.min(order).alias("first"), F.max("n_shingles").alias("n"))
    return stored(least.select("set_a", "set_b", "first.doc_id", "first.text_hash", "n", F.monotonically_increasing_id().alias("node")), "neardup-classes")


def standing(sig: DataFrame, classes: DataFrame) -> DataFrame:
    """The row of `sig` that stands for each class, with `node` and `n`."""
    first = classes.withColumnsRenamed({"doc_id": "first_id", "text_hash": "first_hash"})
    same = F.col("doc_id").eqNullSafe(F.col("first_id")) & (F.col("text_hash") == F.col("first_hash"))
    return sig.join(first, ["set_a", "set_b"]).filter(same)


def crowded_buckets(sig: DataFrame, classes: DataFrame) -> DataFrame:
    """(key, node) of every bucket with two classes or more, with the bucket's size."""
    rows = standing(sig, classes).select("node", F.explode("keys").alias("key"))
    sizes = rows.groupBy("key").agg(F.count(F.lit(1)).alias("size"), F.min("node").alias("lo"), F.max("node").alias("hi"))
    return stored(rows.join(sizes.filter("lo < hi").select("key", "size"), "key").dropDuplicates(["key", "node"]), "neardup-buckets")


def possible(pairs: DataFrame, members: DataFrame) -> DataFrame:
    """The pairs that bitmaps do not rule out.

    A bit that only one of two sets has stands for a shingle, or more, that the
    other lacks, so the bound on the intersection never loses a link.
    """
    side = lambda end: members.select(F.col("node").alias(end), F.col("n").alias(f"n_{end}"), F.col("bits").alias(f"bits_{end}"))
    both = pairs.join(side("b"), "b").join(side("a"), "a")

    def lacking(left: str, right: str) -> Column:
        counts = F.zip_with(left, right, lambda x, y: F.bit_count(x.bitwiseAND(F.bitwise_not(y))))
        return F.aggregate(counts, F.lit(0).cast("bigint"), lambda n, k: n + k)

    most = F.least(F.col("n_a") - lacking("bits_a", "bits_b"), F.col("n_b") - lacking("bits_b", "bits_a"))
    return both.filter(100 * most >= PERCENT * (F.col("n_a") + F.col("n_b") - most)).select("a", "b")


def confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose full sets reach the threshold.

    A set is an array of its own document, so the join moves a row per pair and
    a hot centre is split by the adaptive skew join.
    """
    left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("of_a"))
    right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("of_b"))
    sized = pairs.join(right, "b").join(left, "a")
    common = F.size(F.array_intersect("of_a", "of_b"))
    both = F.size("of_a") + F.size("of_b")
    return sized.filter(100 * common >= PERCENT * (both - common)).select("a", "b")


def components(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """(node, label): the least node that each can reach over undirected links (a, b).

    Every round a node takes the least label among itself and its neighbours and
    then the label of that label, so paths shorten by half; minima are combined
    before the shuffle, so a hub is one row a task.
    """
    both = stored(links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links")
    labels = stored(nodes.select("node", F.col("node").alias("label")), "labels")
    while True:
        near = both.join(labels.select(F.col("node").alias("b"), "label"), "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        lower = labels.join(near, "node", "left").select("node", "label", F.least("label", F.coalesce("near", "label")).alias("next"))
        jump = labels.select(F.col("node").alias("next"), F.col("label").alias("far"))
        moved = stored(lower.join(jump, "next").select("node", F.col("label").alias("old"), F.least("next", "far").alias("label")), "labels")
        labels = moved.select("node", "label")
        if moved.filter("old <> label").isEmpty():
            return labels


def sets_of(docs: DataFrame, members: DataFrame) -> DataFrame:
    """Stored (node, shingles) of the classes that share a bucket, from one text each."""
    named = members.select("node", F.col("doc_id").alias("first_id"), F.col("text_hash").alias("first_hash"))
    same = F.col("doc_id").eqNullSafe(F.col("first_id")) & (F.col("text_hash") == F.col("first_hash"))
    return stored(shingle_sets(with_text_hash(docs).join(named, same)), "neardup-sets")


def open_rows(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows, with labels, of the buckets that hold several components."""
    placed = rows.join(labels, "node")
    open_keys = placed.groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).filter("lo < hi").select("key")
    return placed.join(open_keys, "key")


def star_pairs(rows: DataFrame, labels: DataFrame, used: DataFrame | None, tested: DataFrame | None, nearest: bool) -> tuple[DataFrame, DataFrame]:
    """Pairs (a, b) of one round, and the centres (key, node) it used.

    `rows` are (key, node, weight, n). Only buckets with several components take
    part. A bucket's centre is its heaviest member of a component that gave it no
    centre yet, and is paired with all members of other components whose set
    sizes allow a link. With `nearest` a member only meets its heaviest centre.
    Pairs of earlier rounds are left out.
    """
    placed = stored(open_rows(rows, labels), "neardup-open")
    free = placed
    if used is not None:
        taken = used.join(labels, "node").select("key", "label").distinct()
        free = placed.join(taken, ["key", "label"], "left_anti")
    best = F.max(F.struct("weight", (-F.col("node")).alias("least"), "label", "n")).alias("best")
    centres = free.groupBy("key").agg(best).select("key", (-F.col("best.least")).alias("a"), F.col("best.label").alias("label_a"), F.col("best.n").alias("n_a"), F.col("best.weight").alias("weight_a"))
    centres = stored(centres, "neardup-centres")
    able = 100 * F.least("n", "n_a") >= PERCENT * F.greatest("n", "n_a")
    met = placed.join(centres, "key").filter((F.col("label") != F.col("label_a")) & able)
    if nearest:
        heaviest = F.max(F.struct("weight_a", (-F.col("a")).alias("least"))).alias("best")
        pairs = met.groupBy(F.col("node").alias("b")).agg(heaviest).select((-F.col("best.least")).alias("a"), "b")
    else:
        pairs = met.select("a", F.col("node").alias("b")).distinct()
    if tested is not None:
        pairs = pairs.join(tested.unionByName(tested.select(F.col("b").alias("a"), F.col("a").alias("b"))), ["a", "b"], "left_anti")
    return stored(pairs, "neardup-pairs"), centres.select("key", F.col("a").alias("node"))


def prefixes(sets: DataFrame) -> DataFrame:
    """The shingles of (node, label, shingles) of which two linked sets share one.

    Shingles stand by rarity, the same order in every set, and `at` is the place. A
    counter per hash stands for rarity: any order keeps all links, rare ones first
    only keep the join small.
    """
    spark = sets.sparkSession
    slot = F.col("shingle").bitwiseAND(F.lit(COUNTS - 1)).alias("slot")
    held = sets.select(F.explode("shingles").alias("shingle")).groupBy(slot).agg(F.count(F.lit(1)).alias("times")).toArrow()
    counts = np.zeros(COUNTS, dtype=np.int64)
    counts[held.column("slot").to_numpy()] = held.column("times").to_numpy()
    rarity = spark.sparkContext.broadcast(counts)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        times = rarity.value
        for rows in batches:
            first, sizes, places = [], [], []
            for values in rows.column("shingles"):
                own = values.values.to_numpy()
                n = len(own)
                most = n - -(-PERCENT * n // 100) + 1
                first.append(own[np.lexsort((own, times[own & (COUNTS - 1)]))[:most]])
                sizes.append(np.full(most, n, dtype=np.int32))
                places.append(np.arange(most, dtype=np.int32))
            if first:
                lengths = [len(x) for x in first]
                node, label = (np.repeat(rows.column(c).to_numpy(), lengths) for c in ("node", "label"))
                yield batch(PREFIX_ARROW, {"shingle": np.concatenate(first), "node": node, "label": label, "n": np.concatenate(sizes), "at": np.concatenate(places)})

    return sets.select("node", "label", "shingles").mapInArrow(each, PREFIX)


def rest_pairs(rows: DataFrame, labels: DataFrame, sets: DataFrame, tested: DataFrame) -> DataFrame:
    """Pairs (a, b) of different components, among the members of buckets that hold
    several, that hold every link and leave out the tested pairs.

    The first shingle common to two linked sets stands early enough in both for
    what follows it to reach the threshold, and of the smaller set even for a
    partner of its own size. Members of one component at the same place meet the
    others as one row, so a large component is not joined with itself.
    """
    members = open_rows(rows, labels).select("node", "label").distinct()
    first = stored(prefixes(sets.join(members, "node")), "neardup-prefixes")
    early = (100 + PERCENT) * (F.col("n") - F.col("at")) >= 2 * PERCENT * F.col("n")
    spread = first.groupBy("shingle").agg(F.min("label").alias("lo"), F.max("label").alias("hi"), F.max(early).alias("early"))
    first = stored(first.join(spread.filter("lo < hi and early").select("shingle"), "shingle"), "neardup-crossing")
    place = ["shingle", "label", "n", "at"]
    end = lambda df, name: df.withColumnsRenamed({c: f"{c}_{name}" for c in ("node", "label", "n", "at")})
    large, small = end(first, "a"), end(first.filter(early), "b")
    places = end(first.select(place).distinct(), "a").join(end(first.filter(early).select(place).distinct(), "b"), "shingle")
    after = F.least(F.col("n_a") - F.col("at_a"), F.col("n_b") - F.col("at_b"))
    reach = (100 + PERCENT) * after >= PERCENT * (F.col("n_a") + F.col("n_b"))
    meeting = places.filter((F.col("label_a") != F.col("label_b")) & (F.col("n_b") <= F.col("n_a")) & reach)
    met = meeting.join(large, ["shingle", "label_a", "n_a", "at_a"]).join(small, ["shingle", "label_b", "n_b", "at_b"])
    pairs = met.select(F.least("node_a", "node_b").alias("a"), F.greatest("node_a", "node_b").alias("b")).distinct()
    known = tested.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    return stored(pairs.join(known, ["a", "b"], "left_anti"), "neardup-pairs")


def merged_labels(labels: DataFrame, links: DataFrame) -> DataFrame:
    """Labels after more links: only the labels that the links touch are worked on."""
    end = lambda name: labels.select(F.col("node").alias(name), F.col("label").alias(f"label_{name}"))
    over = links.join(end("a"), "a").join(end("b"), "b").select(F.col("label_a").alias("a"), F.col("label_b").alias("b"))
    over = stored(over.distinct(), "neardup-merges")
    ends = over.select(F.col("a").alias("node")).unionByName(over.select(F.col("b").alias("node"))).distinct()
    after = components(ends, over).select(F.col("node").alias("label"), F.col("label").alias("lower"))
    return stored(labels.join(after, "label", "left").select("node", F.coalesce("lower", "label").alias("label")), "neardup-labels")


def link_classes(docs: DataFrame, sig: DataFrame, classes: DataFrame, buckets: DataFrame) -> DataFrame:
    """(node, label) over all classes that share a bucket, and nothing for the others.

    A first round joins every class to its heaviest centre, which settles most of a
    group of near copies with one pair a member; later rounds only see buckets that
    still hold several components, and go on until one of them finds no link. Only
    centres were tested till then; the last step finds what is left exactly.
    """
    weights = buckets.groupBy("node").agg(F.sum("size").alias("weight"))
    members = stored(standing(sig, classes.join(weights, "node")).select("node", "weight", "n", "bits", "doc_id", "text_hash").dropDuplicates(["node"]), "neardup-members")
    rows = stored(buckets.select("key", "node").join(members.select("node", "weight", "n"), "node"), "neardup-rows")
    sets = sets_of(docs, members)
    release(docs.sparkSession)
    labels, used, tested, nearest = members.select("node", F.col("node").alias("label")), None, None, True
    while True:
        pairs, centres = star_pairs(rows, labels, used, tested, nearest)
        tested = pairs if tested is None else tested.unionByName(pairs)
        found = stored(confirmed(stored(possible(pairs, members), "neardup-possible"), sets), "neardup-links")
        some = not found.isEmpty()
        if some:
            labels = merged_labels(labels, found)
        elif not nearest:
            break
        if not nearest:
            used = centres if used is None else used.unionByName(centres)
        nearest = False
        release(docs.sparkSession)
    release(docs.sparkSession)
    rest = rest_pairs(rows, labels, sets, tested)
    found = stored(confirmed(stored(possible(rest, members), "neardup-possible"), sets), "neardup-links")
    return labels if found.isEmpty() else merged_labels(labels, found)


def near_duplicates(docs: DataFrame) -> DataFrame:
    """Per row of `docs`: doc_id, text_hash, n_shingles, component_id (least doc_id
    reachable over links), kept (doc_id equals component_id) and first_hash, the
    text_hash of the one row, by doc_id and text_hash, that stands for the component."""
    sig = stored(signatures(docs), "neardup-signatures")
    classes = classes_of(sig)
    buckets = crowded_buckets(sig, classes)
    release(docs.sparkSession)
    labels = link_classes(docs, sig, classes, buckets)
    joined = classes.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    order = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "text_hash")
    least = joined.groupBy("label").agg(F.min(order).alias("least"))
    ends = joined.join(least, "label").select("set_a", "set_b", F.col("least.doc_id").alias("component_id"), F.col("least.text_hash").alias("first_hash"))
    ends = stored(ends, "neardup-components")
    linked = sig.filter("n_shingles > 0").select("doc_id", "text_hash", "n_shingles", "set_a", "set_b").join(ends, ["set_a", "set_b"]).drop("set_a", "set_b")
    alone = sig.filter("n_shingles = 0").select("doc_id", "text_hash", "n_shingles", F.col("doc_id").alias("component_id"), F.col("text_hash").alias("first_hash"))
    return linked.unionByName(alone).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """One row of each component, columns unchanged; every row without words stays.

    It is the first row by doc_id, null last, and text; of rows that repeat both, one.
    """
    judged = near_duplicates(docs)
    first = judged.filter("kept and n_shingles > 0 and text_hash = first_hash")
    kept = first.groupBy(F.col("doc_id").alias("kept_id"), F.col("text_hash").alias("kept_hash")).agg(F.count(F.lit(1)).alias("copies"))
    kept = stored(kept, "neardup-kept")
    release(docs.sparkSession)
    own = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("own")  # no name of a column can clash inside
    rows = docs.select(own, "doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash"), F.coalesce(F.col("text").rlike(WORD), F.lit(False)).alias("full"))
    chosen = rows.filter("full").join(kept, F.col("doc_id").eqNullSafe(F.col("kept_id")) & (F.col("text_hash") == F.col("kept_hash")))
    # Only rows that repeat id and text need another look, and only they are shuffled for it.
    once = chosen.filter("copies = 1").unionByName(chosen.filter("copies > 1").dropDuplicates(["kept_id", "kept_hash"]))
    return once.select("own.*").unionByName(rows.filter("not full").select("own.*"))
