"""Mixing sources to target weights by hierarchical budgeting.

Documents hang below source, language and domain. A budget of tokens goes down
that tree: at every node it is shared among the children by weight, a child takes
no more than it can supply (its tokens times the allowed epochs), and what a
child cannot take is shared again among its siblings. A node's budget never
exceeds what lies below it, so only what a whole family cannot supply reaches
the families beside it. Each leaf then reads seeded epochs, every epoch all its
documents in an order of its own, and takes the prefix that its budget pays for;
the document in which the budget ends is taken whole.

Only aggregates of the tree and one bucket of each leaf are ever sorted: a leaf's
order is cut into about as many buckets as the root of its documents, so the
largest sort of a leaf with n documents is over sqrt(n) rows.

Defined cases: tokens are words parted by ASCII blanks; a document without words
costs nothing and is taken where its place in the order falls into the prefix;
null domain, language or source count as the empty name; a null doc_id orders
first; rows that repeat a doc_id within a leaf are taken or left together; weights
default to 1, and a node of weight 0 or without tokens gets nothing; extra columns
are kept by `mix`; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarrylake.llm.common import WORD, release, stored

LEVELS = ("domain", "lang", "source")
LEAST_ID = -(2**63)


def domain_of(source: Column) -> Column:
    """The domain a source belongs to: the bulk crawl, odd-numbered forums, other reference."""
    return F.when(source == "src0", "crawl").when(source.rlike("[13579]$"), "forum").otherwise("reference")


# Target weights by level and name.
WEIGHTS: dict[str, dict[str, int]] = {
    "domain": {"crawl": 2, "forum": 4, "reference": 4},
    "lang": {"en": 5, "de": 2, "fr": 2, "es": 1},
    "source": {},
}


def named(docs: DataFrame, domain: Column | None = None) -> dict[str, Column]:
    """The tree's names of a row."""
    values = (domain_of(F.col("source")) if domain is None else domain, F.col("lang"), F.col("source"))
    return {f"__{level}": F.coalesce(value.cast("string"), F.lit("")) for level, value in zip(LEVELS, values, strict=True)}


def weight_of(level: str, weights: Mapping[str, Mapping[str, int]]) -> Column:
    name = F.col(f"__{level}")
    chosen = F.lit(1)
    for value, weight in sorted(weights.get(level, {}).items()):
        chosen = F.when(name == value, F.lit(int(weight))).otherwise(chosen)
    return chosen.cast("long")


def place_in_epoch(seed: int, epoch: Column, doc_id: Column) -> Column:
    """A document's place in a leaf's epoch: 60 bits of a digest of seed, epoch and id."""
    text = F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"), F.coalesce(doc_id.cast("string"), F.lit("null")))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("long")


def shared(children: DataFrame, parents: list[str]) -> DataFrame:
    """Adds `grant` to (parents..., name, cap, weight, budget): water-filling among siblings.

    A child is full if the level that fills it, given to all that are not fuller,
    stays within the budget; the rest share what remains by weight.
    """
    siblings = Window.partitionBy(*parents) if parents else Window.partitionBy(F.lit(1))
    upto = siblings.orderBy("__level")  # peers at the same level included
    able = F.when(F.col("weight") > 0, F.col("cap")).otherwise(F.lit(0)).cast("long")
    levels = children.withColumn("cap", able).withColumn("__level", F.col("cap") / F.greatest(F.col("weight"), F.lit(1)))
    sums = levels.withColumns({
        "__caps": F.sum("cap").over(upto).cast("double"),
        "__open": (F.sum("weight").over(siblings) - F.sum("weight").over(upto)).cast("double"),
    })
    full = sums.withColumn("__full", F.col("__caps") + F.col("__level") * F.col("__open") <= F.col("budget").cast("double"))
    rest = full.withColumns({
        "__left": (F.col("budget") - F.coalesce(F.sum(F.when(F.col("__full"), F.col("cap"))).over(siblings), F.lit(0))).cast("double"),
        "__among": F.coalesce(F.sum(F.when(~F.col("__full"), F.col("weight"))).over(siblings), F.lit(0)).cast("double"),
    })
    share = F.floor(F.col("__left") * F.col("weight").cast("double") / F.col("__among")).cast("long")
    grant = F.when(F.col("__full"), F.col("cap")).otherwise(F.least(F.col("cap"), share))
    return rest.withColumn("grant", grant).drop("__level", "__caps", "__open", "__full", "__left", "__among")


def leaf_budgets(leaves: DataFrame, share: float, epochs: int, weights: Mapping[str, Mapping[str, int]]) -> DataFrame:
    """Leaves (names, tokens, docs) with the tokens each may spend, `grant`."""
    names = [f"__{level}" for level in LEVELS]
    top = leaves.agg(F.floor(F.sum("tokens") * F.lit(share)).cast("long").alias("budget"))
    above = top
    for depth, level in enumerate(LEVELS, 1):
        parents = names[:depth - 1]
        children = leaves.groupBy(*names[:depth]).agg((F.sum("tokens") * epochs).cast("long").alias("cap"))
        children = children.withColumn("weight", weight_of(level, weights))
        children = children.join(above, parents) if parents else children.join(F.broadcast(above))  # the total is one row
        above = shared(children, parents).select(*names[:depth], F.col("grant").alias("budget"))
    return leaves.join(above.withColumnRenamed("budget", "grant"), names)


def selection(rows: DataFrame, share: float, epochs: int, weights: Mapping[str, Mapping[str, int]], seed: int) -> DataFrame:
    """Per leaf: whole epochs, and where the prefix of the last one ends.

    `rows` is narrow and stored: names, doc_id and tokens of every document.
    """
    names = [f"__{level}" for level in LEVELS]
    leaves = stored(rows.groupBy(*names).agg(F.sum("tokens").alias("tokens"), F.count(F.lit(1)).alias("docs")), "mixing-leaves")
    granted = leaf_budgets(leaves, share, epochs, weights)
    whole = F.when(F.col("tokens") > 0, F.floor(F.col("grant") / F.greatest(F.col("tokens"), F.lit(1)))).otherwise(0).cast("long")
    plans = granted.withColumn("whole", whole).withColumn("rest", F.col("grant") - F.col("whole") * F.col("tokens"))
    plans = stored(plans.select(*names, "tokens", "grant", "whole", "rest", F.ceil(F.sqrt("docs")).cast("long").alias("buckets")), "mixing-plans")
    open_rows = rows.withColumnRenamed("tokens", "cost").join(plans.filter("rest > 0"), names).withColumns({
        "place": place_in_epoch(seed, F.col("whole"), F.col("doc_id")),
        "id": F.coalesce("doc_id", F.lit(LEAST_ID)),
    })
    open_rows = open_rows.withColumn("bucket", F.shiftright(F.shiftright("place", 28) * F.col("buckets"), 32))
    sums = open_rows.groupBy(*names, "bucket", "rest").agg(F.sum("cost").alias("cost"))
    before = F.sum("cost").over(Window.partitionBy(*names).orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)) - F.col("cost")
    edge = stored(sums.withColumn("start", before).filter((F.col("start") < F.col("rest")) & (F.col("rest") <= F.col("start") + F.col("cost"))).select(*names, "bucket", "start"), "mixing-edges")
    inside = open_rows.join(edge, [*names, "bucket"]).groupBy(*names, "start", "rest", "place", "id").agg(F.sum("cost").alias("cost"))
    upto = Window.partitionBy(*names).orderBy("place", "id").rowsBetween(Window.unboundedPreceding, 0)
    paid = inside.withColumn("begin", F.col("start") + F.sum("cost").over(upto) - F.col("cost")).filter("begin < rest")
    last = paid.groupBy(*names).agg(F.max(F.struct("place", "id")).alias("last"))
    return stored(plans.join(last, names, "left").select(*names, "whole", "last.place", "last.id"), "mixing-selection")


def copies(rows: DataFrame, chosen: DataFrame, seed: int) -> DataFrame:
    """The rows once per epoch in which they are taken, numbered by `__epoch`."""
    names = [f"__{level}" for level in LEVELS]
    chosen = chosen.withColumnsRenamed({"whole": "__whole", "place": "__place", "id": "__id"})
    placed = rows.join(chosen, names)
    here, own = place_in_epoch(seed, F.col("__whole"), F.col("doc_id")), F.coalesce("doc_id", F.lit(LEAST_ID))
    inside = F.col("__place").isNotNull() & ((here < F.col("__place")) | ((here == F.col("__place")) & (own <= F.col("__id"))))
    times = placed.withColumn("__times", (F.col("__whole") + F.when(inside, 1).otherwise(0)).cast("int")).filter("__times > 0")
    return times.withColumn("__epoch", F.explode(F.sequence(F.lit(0), F.col("__times") - 1))).drop("__whole", "__place", "__id", "__times")


def counted(docs: DataFrame, domain: Column | None = None) -> DataFrame:
    """One pass over the texts: names, doc_id and tokens of every document, stored."""
    tokens = F.regexp_count(F.coalesce("text", F.lit("")), F.lit(WORD)).cast("long")
    rows = docs.select("doc_id", *[c.alias(n) for n, c in named(docs, domain).items()], tokens.alias("tokens"))
    return stored(rows, "mixing-rows")


def drawn(docs: DataFrame, share: float, epochs: int, weights: Mapping[str, Mapping[str, int]] = WEIGHTS, seed: int = 17, domain: Column | None = None) -> DataFrame:
    """(doc_id, domain, lang, source, n_tokens, epoch) of everything the mixture takes."""
    rows = counted(docs, domain)
    taken = copies(rows, selection(rows, share, epochs, weights, seed), seed)
    return taken.select("doc_id", *[F.col(f"__{level}").alias(level) for level in LEVELS], F.col("tokens").alias("n_tokens"), F.col("__epoch").alias("epoch"))


def mix(docs: DataFrame, share: float, epochs: int, weights: Mapping[str, Mapping[str, int]] = WEIGHTS, seed: int = 17, domain: Column | None = None) -> DataFrame:
    """The rows of `docs` that the mixture takes, once per epoch, columns unchanged."""
    chosen = selection(counted(docs, domain), share, epochs, weights, seed)
    release(docs.sparkSession)
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row")  # no name of a column can clash inside
    rows = docs.select(row, "doc_id", *[c.alias(n) for n, c in named(docs, domain).items()])
    return copies(rows, chosen, seed).select("__row.*")
