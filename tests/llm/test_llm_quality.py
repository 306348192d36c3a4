import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpus import blank_words, empty_documents, odd_documents
from quarrylake.llm import quality


def plain_statistics(text):
    words = blank_words(text)
    windows = Counter(tuple(words[i:i + 5]) for i in range(len(words) - 4))
    covered = set()
    for i in range(len(words) - 4):
        if windows[tuple(words[i:i + 5])] > 1:
            covered.update(range(i, i + 5))
    lines = [line for line in (text or "").split("\n") if blank_words(line)]
    return {
        "n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": sum(c in "#*$%&|<>" for c in text or ""),
        "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(covered), "n_lines": len(lines),
        "n_upper": sum(c.isupper() for c in text or ""),
    }


def test_statistics_of_odd_texts(spark):
    docs = odd_documents(spark)
    got = quality.text_statistics(docs.select("doc_id", "lang", "source", F.col("text").alias("kept_text"), "text")).collect()
    for r in got:
        want = plain_statistics(r.kept_text)
        assert {k: r[k] for k in want} == want, r.doc_id


@pytest.mark.parametrize("text", ["a b c d e a b c d e", "a a a a a a", "a b c d e x a b c d e y a b c d e", "a a a a a", "a b a b a b a b", "x " * 50])
def test_words_in_repeated_windows(spark, text):
    docs = spark.createDataFrame([(1, "en", "s", text)], "doc_id long, lang string, source string, text string")
    assert quality.text_statistics(docs).first().n_repeat_words == plain_statistics(text)["n_repeat_words"]


def plain_estimate(x, share, steps):
    """The same concentration steps in numpy, on the rows of one group."""
    least = np.diag(np.square(quality.LEAST_DEVIATION))

    def middle(v):
        return np.sort(v, axis=0)[(len(v) + 1) // 2 - 1]

    mean = middle(x).astype(float)
    spread = np.maximum(1.4826 * middle(np.abs(x - mean)), quality.LEAST_DEVIATION)
    scatter = np.diag(np.square(spread))
    cut_of = lambda d, s: np.sort(np.floor(8 * np.log1p(d)))[math.ceil(s * len(d)) - 1]
    distances = lambda: np.einsum("ij,jk,ik->i", x - mean, np.linalg.inv(scatter), x - mean)
    for _ in range(steps):
        d = distances()
        near = x[np.floor(8 * np.log1p(d)) <= cut_of(d, share)]
        mean, scatter = near.mean(axis=0), np.cov(near.T, bias=True) + least
    d = distances()
    return d / max(np.expm1((cut_of(d, 0.5) + 1) / 8) / quality.MEDIAN_CHI2, 1.0)


def test_distances_are_those_of_the_plain_estimate(spark):
    draw = np.random.default_rng(3)
    texts = [" ".join("abcdefghij"[: draw.integers(1, 10)] for _ in range(draw.integers(12, 90))) for _ in range(120)]
    texts += [" ".join(["#*$%", "AB"] * 10 + [f"w{i}{j}" for j in range(20)]) for i in range(12)]
    docs = spark.createDataFrame([(i, "en", "s", t) for i, t in enumerate(texts)], "doc_id long, lang string, source string, text string").repartition(4)
    stats = quality.text_statistics(docs).withColumns(quality.vector_columns()).collect()
    sound = sorted((r.doc_id, [r[v] for v in quality.VECTOR]) for r in stats if r.n_words >= 10 and 100 * r.n_repeat_words <= 20 * r.n_words)
    want = dict(zip([i for i, _ in sound], plain_estimate(np.array([v for _, v in sound]), 0.75, 3), strict=True))
    got = {r.doc_id: r for r in quality.quality_verdicts(docs).collect()}
    assert len(want) > 100
    for i, d in want.items():
        assert got[i].distance == pytest.approx(d, rel=1e-6)
        assert got[i].kept == (d <= 40)
    assert not any(got[i].kept for i in range(120, 132) if i in want)


def test_every_coordinate_rejects_alone(spark):
    clean = [" ".join(f"word{i}x{j}" for j in range(60)) for i in range(100)]
    fresh = lambda n, name: [f"word{name}{j}" for j in range(n)]
    odd = {
        "length": " ".join(w * 4 for w in fresh(60, "longer")),
        "symbols": " ".join(w + "#$%" for w in fresh(60, "s")),
        "upper": " ".join(w.upper() for w in fresh(60, "u")),
        "lines": "\n".join(f"word{j}xab word{j}xbc word{j}xcd\nwordread wordmore" for j in range(30)),
        "repeats": " ".join(fresh(9, "r") + fresh(82, "q") + fresh(9, "r")),
    }
    texts = clean + list(odd.values())
    docs = spark.createDataFrame([(i, "en", "s", t) for i, t in enumerate(texts)], "doc_id long, lang string, source string, text string").repartition(4)
    got = {r.doc_id: r for r in quality.quality_verdicts(docs).collect()}
    assert not any(r.base_failed for r in got.values())
    assert all(got[i].kept for i in range(100))
    assert not [name for i, name in enumerate(odd, 100) if got[i].kept]


def test_small_groups_fall_back_and_reject_nothing(spark):
    docs = odd_documents(spark)
    got = quality.quality_verdicts(docs)
    assert got.count() == docs.count()
    assert got.filter("kept = base_failed").isEmpty()


def test_the_stage_keeps_rows_whole(spark):
    docs = odd_documents(spark)
    got = quality.reject_outliers(docs)
    assert got.schema == docs.schema and got.exceptAll(docs).count() == 0
    assert quality.reject_outliers(empty_documents(spark)).count() == 0


def test_held_out_labels_agree_at_scale(spark):
    folder = "/root/testdata/sf0.01"
    verdicts = quality.quality_verdicts(spark.read.parquet(f"{folder}/documents.parquet"))
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    good = verdicts.join(labels, "doc_id").filter("quality = 1 and not base_failed")
    assert good.filter("not kept").count() <= 0.01 * good.count()
