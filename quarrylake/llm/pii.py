"""Personal data: fixed patterns, and bootstrapped contextual extraction of further identifiers.

One pass finds the base kinds in the whole text and, beside them, identifier-like
tokens that no base kind covers, each with the words to its left. Base finds and
long hexadecimal tokens are the seeds. Left contexts are the lexical patterns; the
bipartite graph of patterns and distinct identifiers is scored in rounds: a
pattern is worth the mean score of its identifiers (smoothed), an unknown
identifier the mean of its patterns. Patterns that end above a bound, with enough
distinct seeds, mark every identifier found in them.

Defined cases: a null or empty text has no spans; repeated rows are returned as
often as they occur, and an identifier counts once per pattern however often it is
repeated; rows are told apart by a row number of the stored pass, not by doc_id;
extra columns are ignored, or kept by `redact`; an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarrylake.llm.common import release, stored

# The base kinds in their order, then the method's own.
KINDS = ("email", "ip", "card", "phone", "secret")
BASE = KINDS[:4]

# Fixed patterns. A run of digits is only entered at its start, and never given
# back: what follows a run is no digit, so neither could make a match.
EMAIL_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
EMAIL_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

DIGITS = re.compile(r"[0-9]+")
NO_DIGIT = re.compile(r"[^0-9]+")
TOKEN = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._@+:/-")
SECRET_SEED = re.compile(r"(?=[0-9a-f]*[a-f])(?=[0-9a-f]*[0-9])[0-9a-f]{32,}")

LEFT = 80  # characters looked at for the words before an identifier
LEAST_TOKEN = 6

Span = tuple[int, int, int]  # start, rank of the kind, end

SPAN = pa.struct([("start", pa.int32()), ("rank", pa.int32()), ("end", pa.int32())])
SEEN = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("rank", pa.int32()), ("name", pa.int64()), ("near", pa.string()), ("wide", pa.string())])
SPAN_SQL = "array<struct<start:int,rank:int,end:int>>"
SEEN_SQL = "array<struct<start:int,end:int,rank:int,name:bigint,near:string,wide:string>>"


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost, non-overlapping: the longest local part before an @ that a domain follows."""
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in EMAIL_LOCAL:
            start -= 1
        domain = EMAIL_DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            free = domain.end()
            yield start, free
        at = text.find("@", max(at + 1, free))


def luhn(digits: str) -> bool:
    total = 0
    for i, digit in enumerate(map(int, reversed(digits))):
        doubled = digit * 2 if i % 2 else digit
        total += doubled - 9 if doubled > 9 else doubled
    return total % 10 == 0


def at_most_255(digits: str) -> bool:
    """Of a number however long; Python itself refuses to read thousands of digits, zeros too."""
    short = digits.lstrip("0")
    return len(short) < 4 and int(short or "0") <= 255


def base_spans(text: str) -> list[Span]:
    found: list[Span] = []
    if "@" in text:
        found += [(start, 0, end) for start, end in emails(text)]
    if not DIGITS.search(text):
        return sorted(found)
    if "." in text:
        found += [(m.start(), 1, m.end()) for m in IP.finditer(text) if all(at_most_255(p) for p in m[0].split("."))]
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 12:
            digits = NO_DIGIT.sub("", m[0])
            if 12 <= len(digits) <= 19 and luhn(digits):
                found.append((m.start(), 2, m.end()))
    if "+" in text:
        found += [(m.start(), 3, m.end()) for m in PHONE.finditer(text) if 9 <= len(NO_DIGIT.sub("", m[0])) <= 15]
    return sorted(found)


def tokens_outside(text: str, spans: list[Span]) -> Iterator[tuple[int, int]]:
    """Identifier-like tokens with a digit that touch no span."""
    done = 0
    for m in DIGITS.finditer(text):
        if m.start() < done:
            continue
        start, end = m.span()
        while start > done and text[start - 1] in TOKEN:
            start -= 1
        while end < len(text) and text[end] in TOKEN:
            end += 1
        done = end
        while text[end - 1] in ".:/-+@":
            end -= 1
        if end - start >= LEAST_TOKEN and not any(start < e and s < end for s, _, e in spans):
            yield start, end


def context(text: str, start: int) -> tuple[str, str]:
    """The last word before, and the last two, with what is glued to the token; digits alike."""
    left = DIGITS.sub("0", text[max(0, start - LEFT):start].lower())
    before = left.split()
    glued = before.pop() if left and not left[-1].isspace() else ""
    return f"{' '.join(before[-1:])} |{glued}", f"{' '.join(before[-2:])} |{glued}"


def observed(text: str) -> tuple[list[Span], list[tuple]]:
    """Base spans, and all identifiers with kind (-1: unknown), name and contexts."""
    spans = base_spans(text)
    marked = [(s, e, rank) for s, rank, e in spans]
    if DIGITS.search(text):
        for s, e in tokens_outside(text, spans):
            marked.append((s, e, 4 if SECRET_SEED.fullmatch(text, s, e) else -1))
    seen = []
    for s, e, rank in marked:
        name = xxhash.xxh3_64_intdigest(text[s:e].lower().encode())
        near, wide = context(text, s)
        seen.append((s, e, rank, name - (1 << 64) if name >> 63 else name, near, wide))
    return spans, seen


def observe(docs: DataFrame) -> DataFrame:
    """Stored: the columns of `docs` with `__spans`, `__seen` and a row number.

    The text is the column `text`, which is not stored, or that of the struct `__row`, which is.
    """
    nested = "__row" in docs.columns
    names = [c for c in docs.columns if nested or c != "text"]
    own = {field.name: field for field in docs.schema.fields}
    schema = T.StructType([own[c] for c in names]).add("__spans", T.DataType.fromDDL(SPAN_SQL)).add("__seen", T.DataType.fromDDL(SEEN_SQL))

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            texts = rows.column("__row").field("text") if nested else rows.column("text")
            spans, seen = [], []
            for text in texts.to_pylist():
                a, b = observed(text or "")
                spans.append([dict(zip(("start", "rank", "end"), x, strict=True)) for x in a])
                seen.append([dict(zip(("start", "end", "rank", "name", "near", "wide"), x, strict=True)) for x in b])
            columns = [rows.column(c) for c in names] + [pa.array(spans, pa.list_(SPAN)), pa.array(seen, pa.list_(SEEN))]
            yield pa.RecordBatch.from_arrays(columns, names=[*names, "__spans", "__seen"])

    rows = docs.mapInArrow(each, schema)
    return stored(rows.withColumn("__id", F.monotonically_increasing_id()), "pii-observed")


def pattern_scores(seen: DataFrame, rounds: int) -> DataFrame:
    """(pattern, rank, score, seeds): how surely a left context introduces a kind.

    `seen` has (pattern, name, rank) with rank -1 for unknown identifiers.
    """
    edges = stored(seen.distinct(), "pii-edges")
    sizes = edges.groupBy("pattern").agg(F.countDistinct("name").alias("size"))
    seeds = edges.filter("rank >= 0").groupBy("pattern", "rank").agg(F.count(F.lit(1)).alias("seeds"))
    base = stored(seeds.join(sizes, "pattern"), "pii-seeds")
    scores = base.select("pattern", "rank", "seeds", F.round(F.col("seeds") / (F.col("size") + 1), 9).alias("score"))
    unknown = edges.filter("rank < 0").select("pattern", "name")
    degrees = unknown.groupBy("name").agg(F.count(F.lit(1)).alias("degree"))
    # Only kinds that have seeds in a pattern are lent anything there; the rounds read no other edges.
    lines = stored(unknown.join(base.select("pattern", "rank"), "pattern").join(degrees, "name"), "pii-lines")
    for _ in range(rounds):
        scored = lines.join(scores.select("pattern", "rank", "score"), ["pattern", "rank"])
        names = scored.groupBy("name", "rank").agg((F.sum("score") / F.max("degree")).alias("worth"))
        lent = lines.join(names, ["name", "rank"]).groupBy("pattern", "rank").agg(F.sum("worth").alias("lent"))
        scores = stored(base.join(lent, ["pattern", "rank"], "left").select(
            "pattern", "rank", "seeds", F.round((F.col("seeds") + F.coalesce("lent", F.lit(0.0))) / (F.col("size") + 1), 9).alias("score"),
        ), "pii-scores")
    return scores


def with_spans(rows: DataFrame, rounds: int = 3, bound: float = 0.8, least_seeds: int = 5) -> DataFrame:
    """Observed rows plus `spans`: base spans and what confident patterns add.

    Only rows with identifiers beyond the base kinds are joined with patterns;
    all others keep the spans they have.
    """
    seen = rows.select("__id", F.explode("__seen").alias("s")).select("__id", "s.*")
    long = seen.select("name", "rank", F.explode(F.array_distinct(F.array("near", "wide"))).alias("pattern"))
    scores = pattern_scores(long.select("pattern", "name", "rank"), rounds)
    sure = scores.filter((F.col("score") >= bound) & (F.col("seeds") >= least_seeds))
    best = stored(sure.groupBy("pattern").agg(F.max(F.struct("score", (-F.col("rank")).alias("least"))).alias("best")).select("pattern", (-F.col("best.least")).alias("kind"), F.col("best.score").alias("score")), "pii-patterns")
    beyond = F.exists("__seen", lambda s: (s["rank"] < 0) | (s["rank"] >= len(BASE)))
    more = seen.filter((F.col("rank") < 0) | (F.col("rank") >= len(BASE)))
    hits = more.select("__id", "start", "end", F.explode(F.array_distinct(F.array("near", "wide"))).alias("pattern")).join(best, "pattern")
    one = hits.groupBy("__id", "start", "end").agg(F.max(F.struct("score", (-F.col("kind")).alias("least"))).alias("best"))
    span = F.struct("start", (-F.col("best.least")).alias("rank"), "end")
    added = stored(one.groupBy("__id").agg(F.collect_list(span).alias("__added")), "pii-added")
    # A pattern may also point at the kind of a base span; those stay as they are.
    joined = rows.filter(beyond).join(added, "__id", "left").withColumn("spans", F.sort_array(F.concat("__spans", F.coalesce("__added", F.array().cast(SPAN_SQL))))).drop("__added")
    plain = rows.filter(~beyond).withColumn("spans", F.col("__spans"))
    return joined.unionByName(plain)


def kind_name(rank: Column) -> Column:
    return F.element_at(F.array(*[F.lit(k) for k in KINDS]), rank + 1)


def number_of(spans: Column, kind: str) -> Column:
    """How many spans are of the kind."""
    rank = KINDS.index(kind)
    # The test takes the span alone: a second argument, with a default too, would get its index.
    return F.size(F.filter(spans, lambda s: s["rank"] == rank)).cast("long")


def written(spans: Column) -> Column:
    """kind:start:end of every span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", kind_name(s["rank"]), s["start"], s["end"])), ",")


def personal_data(docs: DataFrame, **options) -> DataFrame:
    """Per row: doc_id, `base` (spans of the fixed kinds) and `spans` (all), sorted by
    start, then kind; offsets are code points of the text, the end exclusive."""
    rows = with_spans(observe(docs.select("doc_id", "text")), **options)
    return rows.select("doc_id", F.col("__spans").alias("base"), "spans")


def redacted(text: Column, spans: Column) -> Column:
    """The text with every span, or run of overlapping spans, replaced by its kind in brackets."""
    begin = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(state: Column, s: Column) -> Column:
        fresh = s["start"] >= state["at"]
        piece = F.concat(state["out"], F.substring(text, state["at"] + 1, s["start"] - state["at"]), F.lit("<"), F.upper(kind_name(s["rank"])), F.lit(">"))
        return F.struct(F.greatest(state["at"], s["end"]).alias("at"), F.when(fresh, piece).otherwise(state["out"]).alias("out"))

    end = lambda state: F.concat(state["out"], F.substring(text, state["at"] + 1, F.length(text)))
    return F.when(F.size(spans) > 0, F.aggregate(spans, begin, step, end)).otherwise(text)


def redact(docs: DataFrame, **options) -> DataFrame:
    """All rows of `docs`, spans replaced in `text`, and `n_chars` brought up to date if there."""
    rows = with_spans(observe(docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row"))), **options)
    release(docs.sparkSession)
    clean = rows.select("__row", redacted(F.col("__row.text"), F.col("spans")).alias("__clean"))
    own = {"text": F.col("__clean"), "n_chars": F.coalesce(F.length("__clean").cast("bigint"), F.col("__n_chars"))}
    counted = clean.withColumn("__n_chars", F.col("__row.n_chars") if "n_chars" in docs.columns else F.lit(None).cast("bigint"))
    return counted.select(*[(own[c] if c in own else F.col("__row")[c]).alias(c) for c in docs.columns])
