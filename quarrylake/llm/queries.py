"""One query per operator over its whole table; the dictionaries that the entry point adds."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarrylake.llm import (
    centroids, classifier, licenses, mixing, neardup, ngramjoin, packing, periodic, pii, quality, substrings, topk, warc,
)
from quarrylake.llm.common import stored, table
from quarrylake.llm.sql import (
    archive_sql, components_sql, kmeans_sql, license_sql, mixing_sql, periodic_sql, repeats_sql, top_k_sql,
)

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


@query
def op1_content_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A record of every page, written to an archive and read back from it."""
    archive = warc.write_archive(table(spark, sf_dir, "pages"))
    return warc.read_archive(spark, archive).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


SQL["op1_content_archive"] = archive_sql()

MIX = {"share": 0.6, "epochs": 2}


@query
def op2_hierarchical_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document the mixture takes, a row per epoch."""
    return mixing.drawn(table(spark, sf_dir, "documents"), **MIX)


SQL["op2_hierarchical_mixing"] = mixing_sql(**MIX)


@query
def op3_pattern_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece of every document and its place in a sequence of 1024 tokens."""
    vocabulary = public_tokenizers.path("byte_bpe_50k.json")
    pieces = stored(packing.tokenise(table(spark, sf_dir, "documents"), vocabulary), "packing-pieces")
    return packing.place(pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids"))


TOP, EVERY = 10, 100


@query
def op4_impact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best inner products of every hundredth vector, against all vectors."""
    vectors = topk.whole_vectors(table(spark, sf_dir, "embeddings"))
    return topk.top_k(topk.index(vectors), vectors.filter(F.col("vec_id") % EVERY == 0), TOP)


SQL["op4_impact_topk"] = top_k_sql(TOP, EVERY)


@query
def op5_quality_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics, base rule and robust verdict of every document."""
    verdicts = quality.quality_verdicts(table(spark, sf_dir, "documents"))
    return verdicts.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        F.round("distance", 6).alias("distance"),
    )


@query
def op6_license_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License phrases and notices of every document."""
    return licenses.license_labels(table(spark, sf_dir, "documents"))


SQL["op6_license_join"] = license_sql(licenses.PHRASES, licenses.TEMPLATES, licenses.CONTAINMENT)


@query
def op7_bootstrapped_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base personal data of every document, and the spans that learned contexts add."""
    found = pii.personal_data(table(spark, sf_dir, "documents"))
    counts = [pii.number_of(F.col("base"), name).alias(f"n_{name}") for name in pii.BASE]
    base = F.sha2(pii.written(F.col("base")).cast("binary"), 256).alias("base_sha256")
    return found.select("doc_id", *counts, base, pii.written(F.col("spans")).alias("spans"))


@query
def op8_boosted_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document, learned from the labels that are not held out."""
    return classifier.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op9_minhash_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate component of every document."""
    found = neardup.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_shingles", "component_id", "kept")


SQL["op9_minhash_neardup"] = components_sql(neardup.SHINGLE, neardup.PERCENT, kept=True)


@query
def op10_compacted_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that lie in windows held by a smaller document."""
    found = substrings.repeated_spans(table(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s[1] - s[0])
    return found.select("doc_id", "n_words", removed.alias("n_removed"), "kept_sha256")


SQL["op10_compacted_repeats"] = repeats_sql(substrings.WINDOW)

CLUSTERS, ROUNDS, SEED, DIMS = 8, 10, 3, 64


@query
def op11_mean_variance_kmeans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cluster, squared distance and inertia of every vector after ten rounds."""
    vectors = centroids.whole_vectors(table(spark, sf_dir, "embeddings"), DIMS)
    return centroids.clustered(vectors, centroids.fit(vectors, CLUSTERS, ROUNDS, SEED)).drop("centroid")


SQL["op11_mean_variance_kmeans"] = kmeans_sql(CLUSTERS, ROUNDS, SEED, DIMS)


@query
def op12_combination_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Component of every document over links of three-word shingle sets."""
    return ngramjoin.ngram_components(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


SQL["op12_combination_join"] = components_sql(ngramjoin.SHINGLE, ngramjoin.PERCENT, kept=False)

PLANTED = 10  # one document in so many is made periodic


@query
def op13_lyndon_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of words of every document, some made periodic first, and the text they leave."""
    found = periodic.periodic_runs(periodic.with_planted_periods(table(spark, sf_dir, "documents"), PLANTED))
    line = lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))
    best = periodic.strongest(F.col("runs"))
    return found.select("doc_id", F.size("runs").cast("bigint").alias("n_runs"), best.alias("best"), "runs", "collapsed").select(
        "doc_id", "n_runs", "best.start", "best.length", "best.period",
        F.floor(1000 * F.col("best.length") / F.col("best.period")).alias("exponent_milli"),
        F.sha2(F.array_join(F.transform("runs", line), "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


SQL["op13_lyndon_runs"] = periodic_sql(periodic.TIMES, periodic.LEAST, PLANTED)
