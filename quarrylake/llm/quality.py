"""Quality rules: robust multivariate outliers per language and source.

Each document becomes a vector of transformed statistics. Per group, a minimum
covariance determinant estimate (concentration steps from medians) describes the
bulk, and vectors far from it by Mahalanobis distance are rejected. Everything is
a column expression: statistics are one projection over the text, the rest works
on a narrow stored table.

Sums run over whole numbers (vectors are kept in thousandths), so the estimate,
and every verdict, does not depend on the order in which partitions are added.

Defined cases: a null or empty text has no words and fails the base rule; null
`lang` or `source` form a group of their own; repeated rows count, and are
returned, as often as they occur; further columns of the input are ignored by
`text_statistics` and kept by `reject_outliers`; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarrylake.llm.common import WORD, key_of, stored, words_of

SYMBOLS = r"[#*$%&|<>]"
WINDOW = 5

# Base rule: too few words, or more than this share of words in repeated windows.
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20

# The vector: name, statistic, and the least standard deviation (thousandths) that
# the estimate may assume; most clean groups have no symbols or repeats at all.
# Lines reach 1000 and repeats 447 behind the base rule: their least deviations let
# either exceed the cutoff of 40 alone.
VECTOR = ("v_length", "v_symbols", "v_upper", "v_lines", "v_repeats")
LEAST_DEVIATION = (60.0, 50.0, 60.0, 100.0, 60.0)
MEDIAN_CHI2 = 4.351  # median of chi-squared with five degrees of freedom


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate `value` once and hand it to `body`."""
    return F.element_at(F.transform(F.array(value), body), 1)


def repeated_words(hashes: Column) -> Column:
    """How many words lie in five-word windows found twice or more, given the window hashes.

    Equal hashes are neighbours after sorting; the starts of repeated windows,
    sorted again, cover up to five words each.
    """

    def covered(starts: Column) -> Column:
        n = F.size(starts)
        gaps = F.transform(
            F.sequence(F.lit(0), n - 1),
            lambda k: F.when(k + 1 < n, F.least(F.lit(WINDOW), F.get(starts, k + 1) - F.get(starts, k))).otherwise(WINDOW),
        )
        return F.when(n > 0, F.aggregate(gaps, F.lit(0), lambda a, g: a + g)).otherwise(0)

    def starts(order: Column) -> Column:
        n = F.size(order)
        same = lambda a, b: F.get(order, a)["hash"] == F.get(order, b)["hash"]
        hits = F.filter(
            F.sequence(F.lit(0), n - 1),
            lambda k: ((k > 0) & same(k - 1, k)) | ((k + 1 < n) & same(k, k + 1)),
        )
        return F.sort_array(F.transform(hits, lambda k: F.get(order, k)["at"]))

    order = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("hash"), i.alias("at"))))
    return F.when(
        F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)
    ).otherwise(let(let(order, starts), covered)).cast("long")


def text_statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """The input's columns plus n_words, word_chars, n_symbols, n_lines, n_dup_lines,
    n_upper and n_repeat_words of the whole text (null: no words)."""
    clash = {"__words", "__lines", "__hashes", "__windows"}
    own = [c for c in docs.columns if c not in clash]
    body = F.coalesce(F.col(text), F.lit(""))
    split = docs.select(
        *own,
        words_of(F.col(text)).alias("__words"),
        F.filter(F.split(body, "\n"), lambda line: line.rlike(WORD)).alias("__lines"),
        F.regexp_count(body, F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        F.regexp_count(body, F.lit(r"\p{Lu}")).cast("long").alias("n_upper"),
    )
    kept = [c for c in own if c != text]
    counted = split.select(
        *kept, "n_symbols", "n_upper",
        F.size("__words").cast("long").alias("n_words"),
        F.length(F.array_join("__words", "")).cast("long").alias("word_chars"),
        F.size("__lines").cast("long").alias("n_lines"),
        (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long").alias("n_dup_lines"),
        F.transform("__words", lambda w: F.xxhash64(w)).alias("__hashes"),
    )
    windows = F.transform(
        F.sequence(F.lit(0), F.size("__hashes") - WINDOW),
        lambda i: F.xxhash64(*[F.get(F.col("__hashes"), i + j) for j in range(WINDOW)]),
    )
    none = F.array().cast("array<bigint>")
    windowed = counted.withColumn("__windows", F.when(F.size("__hashes") > WINDOW, windows).otherwise(none)).drop("__hashes")
    return windowed.withColumn("n_repeat_words", repeated_words(F.col("__windows"))).drop("__windows")


def vector_columns() -> dict[str, Column]:
    """The transformed statistics in thousandths, as whole numbers."""
    share = lambda part, whole: F.sqrt(F.col(part) / F.greatest(F.col(whole), F.lit(1)))
    values = (
        F.log(F.greatest(F.col("word_chars"), F.lit(1)) / F.greatest(F.col("n_words"), F.lit(1))),
        share("n_symbols", "word_chars"),
        share("n_upper", "word_chars"),
        share("n_dup_lines", "n_lines"),
        share("n_repeat_words", "n_words"),
    )
    return {name: F.floor(value * 1000).cast("long") for name, value in zip(VECTOR, values, strict=True)}


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def group_of_pairs(keyed: DataFrame, min_rows: int) -> DataFrame:
    """Group of each language-source pair: the pair itself, or the language alone where
    the pair has fewer than `min_rows` rows, or everything left where the language has too."""
    pairs = keyed.groupBy("__pair", "__lang").agg(F.count(F.lit(1)).alias("__n"))
    small = pairs.filter(F.col("__n") < min_rows).groupBy("__lang").agg(F.sum("__n").alias("__rest"))
    return pairs.join(small, "__lang", "left").select(
        "__pair",
        F.when(F.col("__n") >= min_rows, F.concat(F.lit("s/"), "__pair"))
        .when(F.col("__rest") >= min_rows, F.concat(F.lit("l/"), "__lang"))
        .otherwise(F.lit("all")).alias("__group"),
    )


def medians(rows: DataFrame, names: tuple[str, ...]) -> DataFrame:
    """Lower median of whole-number columns per group, from counts of their values."""
    long = rows.select("__group", F.explode(F.array(*[F.struct(F.lit(n).alias("name"), F.col(n).alias("value")) for n in names])).alias("e"))
    counts = long.groupBy("__group", "e.name", "e.value").agg(F.count(F.lit(1)).alias("n"))
    by = Window.partitionBy("__group", "name")
    ranked = counts.withColumns({"upto": F.sum("n").over(by.orderBy("value").rowsBetween(Window.unboundedPreceding, 0)), "all": F.sum("n").over(by)})
    middle = ranked.filter(2 * F.col("upto") >= F.col("all"))
    return middle.groupBy("__group").agg(*[F.min(F.when(F.col("name") == n, F.col("value"))).alias(f"m_{n}") for n in names])


def start(rows: DataFrame) -> DataFrame:
    """First guess per group: medians, and a diagonal scatter from median deviations."""
    centre = stored(medians(rows, VECTOR), "quality-centre")
    away = rows.join(centre, "__group").select("__group", *[F.abs(F.col(n) - F.col(f"m_{n}")).alias(n) for n in VECTOR])
    spread = medians(away, VECTOR).select("__group", *[F.col(f"m_{n}").alias(f"s_{n}") for n in VECTOR])
    both = centre.join(spread, "__group")
    columns = {f"mean_{i}": F.col(f"m_{n}").cast("double") for i, n in enumerate(VECTOR)}
    for i, n in enumerate(VECTOR):
        for j in range(i):
            columns[f"l_{i}_{j}"] = F.lit(0.0)
        columns[f"l_{i}_{i}"] = F.greatest(1.4826 * F.col(f"s_{n}"), F.lit(LEAST_DEVIATION[i]))
    return stored(both.select("__group", *[c.alias(k) for k, c in columns.items()]), "quality-start")


def distance() -> Column:
    """Squared Mahalanobis distance by forward substitution in the Cholesky factor."""
    z: list[Column] = []
    for i, name in enumerate(VECTOR):
        rest = F.col(name) - F.col(f"mean_{i}")
        for j in range(i):
            rest = rest - F.col(f"l_{i}_{j}") * z[j]
        z.append(rest / F.col(f"l_{i}_{i}"))
    return sum((x * x for x in z[1:]), z[0] * z[0])


def with_distance(rows: DataFrame, estimate: DataFrame) -> DataFrame:
    return rows.join(estimate, "__group").select(*rows.columns, distance().alias("__d2"))


def with_bin(rows: DataFrame) -> DataFrame:
    """Distances on a logarithmic scale of whole steps (an eighth of e each)."""
    return rows.withColumn("__bin", F.floor(8 * F.log1p(F.col("__d2"))).cast("long"))


def cuts(rows: DataFrame, share: float) -> DataFrame:
    """Per group the least bin up to which at least `share` of the rows lie."""
    counts = rows.groupBy("__group", "__bin").agg(F.count(F.lit(1)).alias("n"))
    by = Window.partitionBy("__group")
    ranked = counts.withColumns({"upto": F.sum("n").over(by.orderBy("__bin").rowsBetween(Window.unboundedPreceding, 0)), "all": F.sum("n").over(by)})
    return ranked.filter(F.col("upto") >= share * F.col("all")).groupBy("__group").agg(F.min("__bin").alias("__cut"))


def concentrate(rows: DataFrame, estimate: DataFrame, share: float) -> DataFrame:
    """One concentration step: mean and scatter of the rows nearest to the last estimate."""
    placed = with_bin(with_distance(rows, estimate))
    near = placed.join(stored(cuts(placed, share), "quality-cuts"), "__group").filter(F.col("__bin") <= F.col("__cut"))
    whole = lambda c: F.sum(c.cast("decimal(18,0)"))
    sums = [F.count(F.lit(1)).alias("n")]
    sums += [whole(F.col(n)).alias(f"t_{i}") for i, n in enumerate(VECTOR)]
    sums += [whole(F.col(n) * F.col(VECTOR[j])).alias(f"t_{i}_{j}") for i, n in enumerate(VECTOR) for j in range(i + 1)]
    total = near.groupBy("__group").agg(*sums)
    mean = {f"mean_{i}": F.col(f"t_{i}").cast("double") / F.col("n") for i in range(len(VECTOR))}
    moments = total.select(
        "__group", *[c.alias(k) for k, c in mean.items()],
        *[(F.col(f"t_{i}_{j}").cast("double") / F.col("n") - mean[f"mean_{i}"] * mean[f"mean_{j}"] + (LEAST_DEVIATION[i] ** 2 if i == j else 0.0)).alias(f"c_{i}_{j}") for i in range(len(VECTOR)) for j in range(i + 1)],
    )
    return stored(cholesky(moments), "quality-estimate")


def cholesky(moments: DataFrame) -> DataFrame:
    """The scatter's lower triangular factor, a column an entry.

    The diagonal had the least variances added, so every pivot is at least that.
    """
    p = len(VECTOR)
    for i in range(p):
        for j in range(i + 1):
            rest = F.col(f"c_{i}_{j}")
            for k in range(j):
                rest = rest - F.col(f"l_{i}_{k}") * F.col(f"l_{j}_{k}")
            value = rest / F.col(f"l_{j}_{j}") if i > j else F.sqrt(F.greatest(rest, F.lit(LEAST_DEVIATION[i] ** 2)))
            moments = moments.withColumn(f"l_{i}_{j}", value)
    return moments.select("__group", *[f"mean_{i}" for i in range(p)], *[f"l_{i}_{j}" for i in range(p) for j in range(i + 1)])


def robust_estimate(rows: DataFrame, share: float, steps: int) -> DataFrame:
    """Centre and factor per group after `steps` concentration steps."""
    estimate = start(rows)
    for _ in range(steps):
        estimate = concentrate(rows, estimate, share)
    return estimate


def fit(stats: DataFrame, share: float = 0.75, steps: int = 3, min_rows: int = 50) -> DataFrame:
    """The estimate that each language-source pair is judged by: one row a pair.

    Fitted on the rows that pass the base rule. `__scale` makes half of the
    group's bulk lie below the chi-squared median; `__enough` is false for what
    stays below `min_rows` even after falling back to everything left.
    """
    keyed = stats.filter(~base_failed()).select(key_of(F.col("lang"), F.col("source")).alias("__pair"), key_of(F.col("lang")).alias("__lang"), *[c.alias(n) for n, c in vector_columns().items()])
    groups = stored(group_of_pairs(keyed, min_rows), "quality-groups")
    rows = stored(keyed.join(groups, "__pair").select("__group", *VECTOR), "quality-rows")
    estimate = robust_estimate(rows, share, steps)
    middle = cuts(with_bin(with_distance(rows, estimate)), 0.5)
    scale = F.greatest(F.expm1((F.col("__cut") + 1) / 8.0) / MEDIAN_CHI2, F.lit(1.0))
    sizes = rows.groupBy("__group").agg((F.count(F.lit(1)) >= min_rows).alias("__enough"))
    final = estimate.join(middle.select("__group", scale.alias("__scale")), "__group").join(sizes, "__group")
    return stored(groups.join(final, "__group").drop("__group"), "quality-fit")


def judge(stats: DataFrame, fitted: DataFrame, cutoff: float = 40.0) -> DataFrame:
    """Statistics plus `base_failed`, `distance` (null where there is no estimate) and `kept`."""
    placed = stats.withColumns({**vector_columns(), "base_failed": base_failed(), "__pair": key_of(F.col("lang"), F.col("source"))})
    judged = placed.join(fitted, "__pair", "left").withColumn("distance", distance() / F.col("__scale"))
    far = F.coalesce(F.col("__enough") & (F.col("distance") > cutoff), F.lit(False))
    return judged.withColumn("kept", ~F.col("base_failed") & ~far).select(*stats.columns, "base_failed", "distance", "kept")


def quality_verdicts(docs: DataFrame, cutoff: float = 40.0, **options) -> DataFrame:
    """Per row of `docs` its statistics and verdict, from one pass over the text."""
    stats = stored(text_statistics(docs.select("doc_id", "lang", "source", "text")), "quality-stats")
    return judge(stats, fit(stats, **options), cutoff)


def reject_outliers(docs: DataFrame, cutoff: float = 40.0, **options) -> DataFrame:
    """The rows of `docs` that pass the base rule and are no outliers, columns unchanged.

    Rows are stored once beside their statistics; fitting reads the statistics
    only, and the verdict needs no more than a join with the small fit.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row")
    stats = stored(text_statistics(docs.select(row, "lang", "source", "text")), "quality-stats")
    judged = judge(stats, fit(stats, **options), cutoff).filter("kept")
    return judged.select(*[F.col("__row")[c].alias(c) for c in docs.columns])
