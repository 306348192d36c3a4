"""N-gram Jaccard join by token-combination prefixes.

1. Documents with equal sets of three-word shingles are one class; classes are joined.
2. All shingles stand in one order, roughly by rarity. Two linked sets of which one has
   n shingles share a = ceil(PERCENT * n / 100) of them at least, so their first common
   shingle is among its first n - a + 1 and the first k common ones among its first
   n - a + k: the k-prefix. A bucket holds the sets that have a shingle in their
   1-prefix; of a pair only the first common shingle matters.
3. First rounds test members of buckets above `CROWDED` against one centre of their bucket,
   the member of most company with the fewest rare shingles of its own; that settles groups
   of near copies with about one pair a member. Buckets whose members are linked by then are
   closed, others get a fresh centre each round. The rounds end when few links come.
4. In all buckets that are open a rare shingle is a key by itself. A frequent one is no
   key: its members extend their prefixes by one and are indexed under combinations of
   it with every later shingle there; combinations that are crowded again are extended
   to three. A pair whose first common shingle is frequent shares the combination of its
   first two, or three. Frequent are keys of `CROWDED` members or more that fall apart
   under their combinations; where the same members meet again under most of them, as in
   a family of forms, combinations only repeat the key, and it is joined as it is.
5. Within a key the places (set size, place of the last of the combination) meet before
   their members do: what follows the last place bounds what can be shared. A pair
   belongs to one key, that of its first common shingles: it is passed over where the
   rarest `HEAD` shingles ahead of the last place already share more than the key leaves
   open. Small bitmaps are tried inside the join, larger ones after it; the rest is
   confirmed on full sets, read for these members only. Every link between different
   components comes out; no key has a cap.

Shingles are told apart by 64-bit hashes, classes by 128 bits.

Defined cases: null and empty texts have no shingles, form no links and are their own
component; fewer words than a shingle count as one; rows without a doc_id take part
under null, which orders last; repeated rows are one class; extra columns are ignored;
an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarrylake.llm.common import batch, release, stored
from quarrylake.llm.neardup import BITS, bitmap, merged_labels, signed, with_text_hash
from quarrylake.llm.shingles import WordHashes, mixed, shingle_set

SHINGLE = 3
PERCENT = 90  # links have 100 * intersection >= PERCENT * union

COUNTS = 1 << 20  # counters that order shingles by rarity; several may share one
CROWDED = 64  # members from which a key is extended by one more shingle
LONGEST = 3  # shingles in the longest combination; crowded keys of that length are joined as they are
# Two different sets above the threshold share at least nine shingles, so no combination is too long for a link.

HEAD = 16  # shingles of a member, ahead of a key, that tell whether a pair has met before
FOLDED = 8  # numbers of 64 bits that the bitmap is folded to where it travels with a key
FEWER = 2  # a key is extended if its combinations hold less than one pair in so many of its own
SETTLED = 20  # the rounds of one centre a bucket end when they link less than one in so many of its members

SLICE = 500  # texts held as arrays at a time

MEMBER = "doc_id bigint, text_hash bigint, n_shingles bigint, set_a bigint, set_b bigint, prefix array<bigint>, bits array<bigint>"
MEMBER_ARROW = pa.schema([
    ("doc_id", pa.int64()), ("text_hash", pa.int64()), ("n_shingles", pa.int64()), ("set_a", pa.int64()),
    ("set_b", pa.int64()), ("prefix", pa.list_(pa.int64())), ("bits", pa.list_(pa.int64())),
])
SLOT_ARROW = pa.schema([("slot", pa.int32()), ("times", pa.int64())])
SETS_ARROW = pa.schema([("node", pa.int64()), ("shingles", pa.list_(pa.int64()))])


def least_common(n: int) -> int:
    """Shingles that a linked set shares with a set of n, at least."""
    return -(-PERCENT * n // 100)


def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        yield from (whole.slice(i, SLICE) for i in range(0, whole.num_rows, SLICE))


def rarity(docs: DataFrame) -> np.ndarray:
    """Shingles counted per slot of their low bits over all documents."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, times = WordHashes(), np.zeros(COUNTS, dtype=np.int64)
        for rows in slices(batches):
            sets = [shingle_set(text, words, SHINGLE) for text in rows.column("text").to_pylist()]
            if sets:
                times += np.bincount((np.concatenate(sets) & np.uint64(COUNTS - 1)).astype(np.int64), minlength=COUNTS)
        held = np.flatnonzero(times)
        yield batch(SLOT_ARROW, {"slot": pa.array(held, pa.int32()), "times": pa.array(times[held])})

    counted = docs.select("text").mapInArrow(each, "slot int, times bigint").groupBy("slot").agg(F.sum("times").alias("times")).toArrow()
    counts = np.zeros(COUNTS, dtype=np.int64)
    counts[counted.column("slot").to_numpy()] = counted.column("times").to_numpy()
    return counts


def rarest(hashes: np.ndarray, counts: np.ndarray, size: int) -> np.ndarray:
    """The first `size` of distinct hashes, ordered by the count of their slot and then by value."""
    times = counts[(hashes & np.uint64(COUNTS - 1)).astype(np.int64)]
    if size < len(hashes):
        few = np.flatnonzero(times <= np.partition(times, size)[size])  # all that tie with the last one, too
        hashes, times = hashes[few], times[few]
    return hashes[np.lexsort((hashes, times))[:size]]


def described(docs: DataFrame) -> DataFrame:
    """Stored per row of `docs`: set size, 128-bit hash of the set, longest prefix in order, bitmap."""
    times = docs.sparkSession.sparkContext.broadcast(np.minimum(rarity(docs), 2**32 - 1).astype(np.uint32))

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, counts = WordHashes(), times.value
        for rows in slices(batches):
            out = {name: [] for name in MEMBER_ARROW.names}
            out["doc_id"], out["text_hash"] = rows.column("doc_id"), rows.column("text_hash")
            for text in rows.column("text").to_pylist():
                hashes = shingle_set(text, words, SHINGLE)
                n = len(hashes)
                out["n_shingles"].append(n)
                out["set_a"].append(signed(int(np.add.reduce(mixed(hashes, 11)))))
                out["set_b"].append(signed(int(np.add.reduce(mixed(hashes, 13)))))
                out["prefix"].append(rarest(hashes, counts, n - least_common(n) + LONGEST).view(np.int64))
                out["bits"].append(bitmap(hashes))
            yield batch(MEMBER_ARROW, out)

    return stored(with_text_hash(docs).mapInArrow(each, MEMBER), "ngrams-described")


def classes_of(rows: DataFrame) -> DataFrame:
    """Stored per distinct set: its number `node`, size, and the row that stands for it."""
    order = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "text_hash")
    least = rows.filter("n_shingles > 0").groupBy("set_a", "set_b").agg(F.min(order).alias("first"), F.max("n_shingles").alias("n"))
    named = least.select("set_a", "set_b", "first.doc_id", "first.text_hash", F.col("n").cast("int").alias("n"))
    return stored(named.withColumn("node", F.monotonically_increasing_id()), "ngrams-classes")


def same_row(left: DataFrame, right: DataFrame) -> DataFrame:
    """Join by (doc_id, text_hash), null ids alike."""
    named = right.withColumnsRenamed({"doc_id": "first_id", "text_hash": "first_hash"})
    on = F.col("doc_id").eqNullSafe(F.col("first_id")) & (F.col("text_hash") == F.col("first_hash"))
    return left.join(named, on).drop("doc_id", "text_hash", "first_id", "first_hash")


def members_of(rows: DataFrame, classes: DataFrame) -> DataFrame:
    """Stored (node, n, prefix, bits) of one row of each class."""
    first = same_row(rows.select("doc_id", "text_hash", "prefix", "bits"), classes.select("doc_id", "text_hash", "node", "n"))
    return stored(first.dropDuplicates(["node"]), "ngrams-members")


def shared_prefixes(members: DataFrame) -> DataFrame:
    """Stored (key, node, n, at, size, weight) of the 1-prefixes, of shingles that two classes
    have there; a node's weight is the sum of its keys' sizes, each times the places of the
    prefix from the key on. Of a group of near copies all have much the same company, so the
    places tell: own shingles of a changed copy are rare and push the common ones back."""
    reach = (F.col("n") - F.ceil(PERCENT * F.col("n") / 100) + 1).cast("int")
    rows = members.select("node", "n", reach.alias("reach"), F.posexplode(F.slice("prefix", F.lit(1), reach)).alias("at", "key"))
    # The smaller set of a pair has the shingle early enough for a partner of its own size.
    early = (100 + PERCENT) * (F.col("n") - F.col("at")) >= 2 * PERCENT * F.col("n")
    sizes = rows.groupBy("key").agg(F.count(F.lit(1)).alias("size"), F.max(early).alias("early")).filter("size > 1 and early")
    held = stored(rows.join(stored(sizes.select("key", "size"), "ngrams-sizes"), "key"), "ngrams-shared")
    weights = held.groupBy("node").agg(F.sum(F.col("size") * (F.col("reach") - F.col("at"))).alias("weight"))
    return stored(held.drop("reach").join(weights, "node"), "ngrams-keys")


def may_link(common: Column) -> Column:
    """Whether `common` shared shingles of sets sized n_a and n_b can reach the threshold."""
    return (100 + PERCENT) * common >= PERCENT * (F.col("n_a") + F.col("n_b"))


def lacking(left: str, right: str) -> Column:
    """Bits of one bitmap that the other has not; each stands for a shingle, or more, that the other set lacks."""
    counts = F.zip_with(left, right, lambda x, y: F.bit_count(x.bitwiseAND(F.bitwise_not(y))))
    return F.aggregate(counts, F.lit(0), lambda n, k: n + k)


def most_common(left: str, right: str) -> Column:
    """A bound on what two sets share, from their sizes n_a and n_b and bitmaps."""
    return F.least(F.col("n_a") - lacking(left, right), F.col("n_b") - lacking(right, left))


def possible(pairs: DataFrame, members: DataFrame) -> DataFrame:
    """The pairs (a, b) that sizes and bitmaps do not rule out."""
    side = lambda end: members.select(F.col("node").alias(end), F.col("n").alias(f"n_{end}"), F.col("bits").alias(f"bits_{end}"))
    both = pairs.join(side("b"), "b").join(side("a"), "a")
    return both.filter(may_link(most_common("bits_a", "bits_b"))).select("a", "b")


def set_rows(texts: DataFrame) -> DataFrame:
    """Full shingle sets of (node, text) rows."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordHashes()
        for rows in slices(batches):
            sets = [shingle_set(text, words, SHINGLE).view(np.int64) for text in rows.column("text").to_pylist()]
            yield batch(SETS_ARROW, {"node": rows.column("node"), "shingles": sets})

    return texts.select("node", "text").mapInArrow(each, "node bigint, shingles array<bigint>")


def later_shingles(k: int) -> Column:
    """Shingles of the (k + 1)-prefix behind the last one of a key of k."""
    return F.col("n") - F.ceil(PERCENT * F.col("n") / 100) + k - F.col("last")


class Join:
    """What the rounds share: texts, classes and their keys, full sets read so far, labels so far."""

    def __init__(self, docs: DataFrame, classes: DataFrame, members: DataFrame) -> None:
        self.docs, self.classes, self.members = docs, classes, members
        self.keys = shared_prefixes(members)
        self.labels = stored(self.keys.select("node").distinct().select("node", F.col("node").alias("label")), "ngrams-labels")
        self.sets: DataFrame | None = None
        self.tested: DataFrame | None = None

    def sets_of(self, pairs: DataFrame) -> DataFrame:
        """Sets of all nodes of the pairs; those not met before are read from their texts."""
        nodes = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()
        if self.sets is not None:
            nodes = nodes.join(self.sets.select("node"), "node", "left_anti")
        named = stored(self.classes.join(nodes, "node").select("node", "doc_id", "text_hash"), "ngrams-nodes")
        texts = same_row(with_text_hash(self.docs), named).dropDuplicates(["node"])
        fresh = stored(set_rows(texts), "ngrams-sets")
        self.sets = fresh if self.sets is None else self.sets.unionByName(fresh)
        return self.sets

    def link(self, pairs: DataFrame) -> int:
        """Test pairs (a, b) and merge the labels of those that link; tells how many did."""
        self.tested = pairs if self.tested is None else self.tested.unionByName(pairs)
        pairs = stored(possible(pairs, self.members), "ngrams-possible")
        if pairs.isEmpty():
            return 0
        sets = self.sets_of(pairs)
        left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("of_a"))
        right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("of_b"))
        common = F.size(F.array_intersect("of_a", "of_b"))
        both = F.size("of_a") + F.size("of_b")
        linked = pairs.join(right, "b").join(left, "a").filter(100 * common >= PERCENT * (both - common))
        links = stored(linked.select("a", "b"), "ngrams-links")
        found = links.count()
        release(self.docs.sparkSession)
        if found:
            self.labels = merged_labels(self.labels, links)
        return found

    def untested(self, pairs: DataFrame) -> DataFrame:
        """Stored distinct pairs, the smaller node first, without those tested before."""
        sides = lambda df: df.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        pairs = sides(pairs).distinct()
        if self.tested is not None:
            pairs = pairs.join(sides(self.tested), ["a", "b"], "left_anti")
        return stored(pairs, "ngrams-pairs")

    def open_keys(self, rows: DataFrame) -> DataFrame:
        """The rows, with labels and fresh sizes, of the keys that hold several components."""
        placed = rows.drop("label", "size").join(self.labels, "node")
        spread = placed.groupBy("key").agg(F.count(F.lit(1)).alias("size"), F.min("label").alias("lo"), F.max("label").alias("hi"))
        return stored(placed.join(stored(spread.filter("lo < hi").select("key", "size"), "ngrams-sizes"), "key"), "ngrams-open")

    def settle(self) -> DataFrame:
        """Test the members of open buckets above `CROWDED` against the weightiest one, a fresh
        one each round, while a round links one in `SETTLED` of them; returns the rows of all
        open buckets. Below that size a member meets few others in a bucket, linked or not."""
        used = None
        while True:
            rows = self.open_keys(self.keys)
            crowded = rows.filter(F.col("size") > CROWDED)
            if crowded.isEmpty():
                return rows
            fresh = crowded if used is None else crowded.join(used, ["key", "node"], "left_anti")
            centre = F.max(F.struct("weight", (-F.col("node")).alias("least"), "label", "n")).alias("c")
            centres = stored(fresh.groupBy("key").agg(centre), "ngrams-centres")
            taken = centres.select("key", (-F.col("c.least")).alias("node"))
            used = taken if used is None else used.unionByName(taken)
            met = crowded.join(centres, "key").filter(F.col("label") != F.col("c.label"))
            met = met.withColumns({"n_a": F.col("n"), "n_b": F.col("c.n")}).filter(may_link(F.least("n_a", "n_b")))
            best = F.max(F.struct(F.col("c.weight").alias("weight"), F.col("c.least").alias("least"))).alias("best")
            pairs = met.groupBy("node").agg(best).select((-F.col("best.least")).alias("a"), F.col("node").alias("b"))
            linked = self.link(self.untested(pairs))
            if linked * SETTLED < crowded.select("node").distinct().count():
                return self.open_keys(self.keys) if linked else rows

    def pairs_within(self, rows: DataFrame, k: int) -> DataFrame:
        """Pairs of different components whose first k common shingles are a key, at places that allow a link."""
        end = lambda df, name: df.withColumnsRenamed({c: f"{c}_{name}" for c in ("node", "label", "n", "last", "head", "small")})
        place = ["key", "n", "last"]
        places = rows.select(*place).distinct()
        left = F.least(F.col("n_a") - F.col("last_a"), F.col("n_b") - F.col("last_b")) - 1
        meeting = end(places, "a").join(end(places, "b"), "key").filter((F.col("n_a") <= F.col("n_b")) & may_link(left + k))
        held = rows.select(*place, "node", "label", "head", "small")
        met = meeting.join(end(held, "a"), ["key", "n_a", "last_a"]).join(end(held, "b"), ["key", "n_b", "last_b"])
        met = met.filter("label_a <> label_b and (n_a < n_b or node_a < node_b)")
        fresh = F.size(F.array_intersect("head_a", "head_b")) <= k - 1
        return met.filter(fresh & may_link(most_common("small_a", "small_b"))).select(F.col("node_a").alias("a"), F.col("node_b").alias("b"))

    def extended(self, rows: DataFrame, k: int) -> DataFrame:
        """Keys of k shingles extended by every later shingle of the (k + 1)-prefix."""
        later = F.slice("prefix", F.col("last") + 2, later_shingles(k).cast("int"))
        more = rows.join(self.members.select("node", "prefix"), "node").select(F.col("key").alias("parent"), "node", "n", "last", F.posexplode(later).alias("after", "shingle"))
        return more.select("parent", F.xxhash64("parent", "shingle").alias("key"), "node", "n", (F.col("last") + F.col("after") + 1).alias("last"))

    def headed(self, rows: DataFrame) -> DataFrame:
        """The rows with the rarest shingles ahead of the last place of their key, and a small bitmap."""
        every = lambda i: F.sequence(i, F.lit(BITS // 64 - 1), F.lit(FOLDED))
        joined = lambda both, j: both.bitwiseOR(F.get("bits", j))
        fold = F.transform(F.sequence(F.lit(0), F.lit(FOLDED - 1)), lambda i: F.aggregate(every(i), F.lit(0).cast("bigint"), joined))
        own = self.members.select("node", F.slice("prefix", 1, HEAD).alias("head"), fold.alias("small"))
        return rows.join(own, "node").withColumn("head", F.slice("head", F.lit(1), F.col("last")))

    def finish(self, rows: DataFrame) -> None:
        """Every link left between different components, by keys of one to `LONGEST` shingles."""
        level, found = rows.withColumn("last", F.col("at")).select("key", "node", "n", "last", "label", "size"), None
        for k in range(1, LONGEST + 1):
            apart, more = None, None
            if k < LONGEST and not (crowded := level.filter(F.col("size") >= CROWDED)).isEmpty():
                more = stored(self.extended(crowded, k), "ngrams-combinations")
                sizes = more.groupBy("parent", "key").agg(F.count(F.lit(1)).alias("size"))
                below = sizes.groupBy("parent").agg(F.sum(F.col("size") * (F.col("size") - 1)).alias("below"))
                own = crowded.groupBy(F.col("key").alias("parent")).agg(F.count(F.lit(1)).alias("many"))
                apart = stored(below.join(own, "parent").filter(FEWER * F.col("below") < F.col("many") * (F.col("many") - 1)).select("parent"), "ngrams-apart")
            ready = level if apart is None else level.join(apart.withColumnRenamed("parent", "key"), "key", "left_anti")
            ready = stored(self.headed(ready), "ngrams-level")
            release(self.docs.sparkSession)
            pairs = stored(self.pairs_within(ready, k), "ngrams-met")
            found = pairs if found is None else found.unionByName(pairs)
            if apart is None or apart.isEmpty():
                break
            level = self.open_keys(more.join(apart, "parent").drop("parent"))
        self.link(self.untested(found))


def ngram_components(docs: DataFrame) -> DataFrame:
    """Per row of `docs`: doc_id, text_hash, n_shingles, and component_id, the least doc_id reachable by links."""
    rows = described(docs)
    classes = classes_of(rows)
    members = members_of(rows, classes)
    release(docs.sparkSession)
    join = Join(docs, classes, members)
    release(docs.sparkSession)
    join.finish(join.settle())
    joined = classes.join(join.labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    least = joined.groupBy("label").agg(F.min("doc_id").alias("component_id"))
    ends = stored(joined.join(least, "label").select("set_a", "set_b", "component_id"), "ngrams-components")
    linked = rows.filter("n_shingles > 0").select("doc_id", "text_hash", "n_shingles", "set_a", "set_b").join(ends, ["set_a", "set_b"])
    alone = rows.filter("n_shingles = 0").select("doc_id", "text_hash", "n_shingles", F.col("doc_id").alias("component_id"))
    return linked.drop("set_a", "set_b").unionByName(alone)
