import pytest
from pyspark.sql import functions as F

from corpus import empty_documents, odd_documents
from quarrylake.llm import mixing


def rows_of(spark, sizes, words=4):
    rows = [(i, "w " * words, lang, source) for i, (lang, source) in enumerate(key for key, n in sizes.items() for _ in range(n))]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")


def grants(spark, sizes, share, epochs, weights, domain):
    docs = rows_of(spark, sizes)
    rows = mixing.counted(docs, domain)
    leaves = rows.groupBy("__domain", "__lang", "__source").agg(F.sum("tokens").alias("tokens"), F.count("*").alias("docs"))
    found = mixing.leaf_budgets(leaves, share, epochs, weights).collect()
    return {(r["__domain"], r["__lang"], r["__source"]): r["grant"] for r in found}


def test_a_shortage_goes_to_siblings_before_it_goes_to_the_next_family(spark):
    domain = F.when(F.col("source").startswith("a"), "A").otherwise("B")
    sizes = {("x", "a1"): 10, ("x", "a2"): 100, ("y", "a3"): 100, ("x", "b1"): 300}
    got = grants(spark, sizes, 0.5, 1, {"domain": {"A": 1, "B": 1}}, domain)
    # 1020 tokens: 510 each; within A both languages get 255, a1 has only 40 of its 127 and a2 takes the rest.
    assert got[("A", "x", "a1")] == 40 and got[("A", "x", "a2")] == 215 and got[("A", "y", "a3")] == 255
    assert got[("B", "x", "b1")] == 510


def test_what_a_family_cannot_supply_goes_beside_it(spark):
    domain = F.when(F.col("source") == "a", "A").otherwise("B")
    got = grants(spark, {("x", "a"): 10, ("x", "b"): 90}, 0.9, 1, {"domain": {"A": 9, "B": 1}}, domain)
    assert got == {("A", "x", "a"): 40, ("B", "x", "b"): 320}


def test_weight_zero_gets_nothing_and_epochs_repeat(spark):
    domain = F.lit("d")
    docs = rows_of(spark, {("x", "a"): 5, ("x", "b"): 95})
    weights = {"source": {"a": 9, "b": 0}}
    got = mixing.drawn(docs, 0.08, 2, weights, domain=domain).collect()
    assert {r.source for r in got} == {"a"}
    assert sorted(r.epoch for r in got) == [0] * 5 + [1] * 3  # 32 tokens: one whole epoch of 20, then three documents


@pytest.mark.parametrize("share", [0.0, 0.3, 1.0])
def test_whole_documents_up_to_the_budget(spark, share):
    docs = rows_of(spark, {("x", "a"): 40, ("x", "b"): 10, (None, None): 3})
    got = mixing.drawn(docs, share, 1, {}).agg(F.sum("n_tokens")).first()[0] or 0
    assert share * 212 - 3 <= got <= share * 212 + 12


def test_odd_rows_keep_their_columns(spark):
    docs = odd_documents(spark)
    got = mixing.mix(docs, 1.0, 1, {})
    assert got.columns == docs.columns and got.schema == docs.schema
    assert got.exceptAll(docs).count() == 0
    assert mixing.mix(empty_documents(spark), 0.5, 2, {}).count() == 0
