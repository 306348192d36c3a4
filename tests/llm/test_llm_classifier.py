import zlib

import numpy as np
from pyspark.sql import functions as F

from corpus import empty_documents, odd_documents
from quarrylake.llm import classifier


def test_arrays_walk_like_a_tree():
    draw = np.random.default_rng(0)
    x = draw.normal(size=(800, 5))
    y = ((x[:, 0] > 0.3) ^ (x[:, 1] > 0)).astype(float)
    forest = classifier.fit(x, y, trees=30, depth=3)

    def walk(row):
        total = forest.base
        for feature, threshold, leaf in zip(forest.feature, forest.threshold, forest.leaf, strict=True):
            node = 0
            while node < len(feature):
                node = 2 * node + 1 + bool(row[feature[node]] > threshold[node])
            total += leaf[node - len(feature)]
        return 1 / (1 + np.exp(-total))

    scores = forest.score(x)
    assert np.allclose(scores[:50], [walk(row) for row in x[:50]])
    assert ((scores >= 0.5) == y).mean() > 0.97


def test_one_class_or_none():
    x = np.zeros((5, 3))
    assert classifier.fit(x, np.ones(5)).score(x).min() > 0.99
    assert classifier.fit(x, np.zeros(5)).score(x).max() < 0.01
    assert (classifier.fit(x[:0], np.zeros(0)).score(x) == 0.5).all()


def test_held_out_accuracy_and_no_leak(spark):
    folder = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    got = {r.doc_id: r for r in classifier.classify(docs, labels).collect()}
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 3 == 1) for i, r in got.items())
    truth = {r.doc_id: r.quality for r in labels.collect()}
    held = [(r.predicted, truth[i]) for i, r in got.items() if r.held_out and i in truth]
    assert len(held) > 500
    assert sum(a == b for a, b in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got.values())


def test_labels_of_held_out_rows_and_extra_columns_change_nothing(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    turned = labels.withColumn("quality", F.expr("if(crc32(cast(doc_id as string)) % 3 = 1, 1 - quality, quality)"))
    scores = lambda d, l: sorted((r.doc_id, r.score) for r in classifier.classify(d, l).collect())  # noqa: E731, E741
    assert scores(docs, labels) == scores(docs.drop("lang", "source").repartition(5), turned.repartition(3))


def test_odd_rows(spark):
    docs = odd_documents(spark)
    labels = spark.createDataFrame([(0, 1), (0, 0), (1, None), (None, 1), (7, 5)], "doc_id long, quality int")
    got = classifier.classify(docs, labels).collect()
    assert len(got) == docs.count() and all(0 <= r.score <= 1 for r in got)
    assert classifier.classify(empty_documents(spark), labels).count() == 0
