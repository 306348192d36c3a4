import random

import numpy as np

from corpus import empty_documents, near_components, odd_documents, words
from quarrylake.llm import neardup
from quarrylake.llm.shingles import WordHashes, shingle_set


def edited(split, seed, changes):
    draw, out = random.Random(seed), list(split)
    for _ in range(changes):
        out[draw.randrange(len(out))] = f"new{draw.randrange(10**6)}"
    return out


def corpus():
    """Copies, chains of edits, stars around a base, short texts and texts that share a passage."""
    texts, passage = [], words(999, 60)
    for group in range(12):
        base = words(group, 40 + 30 * group)
        texts.append(base)
        texts += [edited(base, 100 * group + i, 1 + len(base) // 60) for i in range(6)]
        texts.append(base)
        chain = base
        for i in range(4):
            chain = edited(chain, 1000 * group + i, max(1, len(base) // 80))
            texts.append(chain)
    texts += [words(500 + i, 200) + passage for i in range(25)]
    texts += [words(700 + i, 3 + i % 8) for i in range(20)] + [words(700, 3), words(701, 4)]
    short = words(800, 12)
    texts += [short, [*short, "tail"], short[1:], ["x", *short]]
    return [(i, " ".join(t)) for i, t in enumerate(texts)]


def test_components_are_those_of_all_pairs(spark):
    rows = corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    want = near_components(rows)
    got = {r.doc_id: r for r in neardup.near_duplicates(docs).collect()}
    assert {i: r.component_id for i, r in got.items()} == want
    assert all(r.kept == (want[i] == i) for i, r in got.items())


def test_counts_and_components_on_given_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    hashes = WordHashes()
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in neardup.near_duplicates(docs).collect()}
    want = near_components(rows)
    assert got == {i: (len(shingle_set(t, hashes)), want[i]) for i, t in rows}


def test_signatures_estimate_similarity_also_when_bins_are_empty():
    donor, draw = neardup.donors(), np.random.default_rng(1)
    for size in (60, 150, 2000):
        share = []
        for _ in range(40):
            pool = draw.integers(0, 2**63, 2 * size, dtype=np.uint64) * np.uint64(2)
            a, b = np.sort(pool[:size]), np.sort(pool[size // 7:size + size // 7])  # similarity 6/8
            share.append((neardup.signature(a, donor) == neardup.signature(b, donor)).mean())
        assert abs(np.mean(share) - 0.75) < 0.04, size


def test_sets_at_the_threshold_share_a_key():
    donor, draw = neardup.donors(), np.random.default_rng(2)
    for size in (1, 2, 3, 4, 7, 20, 47, 48, 55, 63, 64, 70, 84, 200):
        for _ in range(60):
            common = draw.integers(0, 2**63, size, dtype=np.uint64)
            a = np.unique(common)
            b = np.unique(np.concatenate([common, draw.integers(0, 2**63, size // 3, dtype=np.uint64)]))
            if 100 * len(a) >= 75 * len(b):
                assert np.intersect1d(neardup.bucket_keys(a, donor), neardup.bucket_keys(b, donor)).size, size


def test_links_between_members_that_are_no_centres(spark):
    """A family of pairwise similarity 0.70, in which 20 pairs at 0.757 are planted."""
    places = range(7, 400, 28)[:14]
    rows = []
    for i in range(400):
        rows.append([f"t{w}" for w in range(400)])
        for k, place in enumerate(places):
            rows[i][place] = f"v{i - 1 if i < 40 and i % 2 and k < 3 else i}x{k}"
    rows = [(i, " ".join(own)) for i, own in enumerate(rows)]
    want = near_components(rows)
    assert sum(want[i] != i for i in want) == 20
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert {r.doc_id: r.component_id for r in neardup.near_duplicates(docs).collect()} == want


def test_odd_rows(spark):
    docs = odd_documents(spark)
    got = neardup.near_duplicates(docs).collect()
    assert len(got) == docs.count()
    by_id = {}
    for r in got:
        by_id.setdefault(r.doc_id, set()).add((r.component_id, r.kept))
    assert by_id[2] == by_id[1] == by_id[99] == {(0, False)} and by_id[0] == {(0, True)}
    assert by_id[3] == {(3, True)} and by_id[4] == {(4, True)} and by_id[5] == {(5, True)}
    assert by_id[None] == {(0, False), (None, True)}


def test_one_row_of_a_component_stays(spark):
    docs = odd_documents(spark)
    kept = neardup.drop_near_duplicates(docs)
    assert kept.schema == docs.schema
    got = kept.collect()
    assert set(got) <= set(docs.collect())
    ids = sorted((r.doc_id is None, r.doc_id) for r in got)
    assert ids == [(False, i) for i in (0, *range(3, 14))] + [(True, None)]
    assert neardup.drop_near_duplicates(empty_documents(spark)).count() == 0


def test_one_row_stays_where_ids_are_null_or_shared(spark):
    base = words(3, 200)
    near = [" ".join(edited(base, s, 1)) for s in range(3)]
    for ids in ([None] * 3, [5] * 3, [None, 5, 5], [5, 6, 5]):
        rows = [*zip(ids, near, strict=True), (9, "another text"), (None, None)]
        kept = neardup.drop_near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
        assert len([r for r in kept if r.text in near]) == 1 and len(kept) == 3
        assert next(r.doc_id for r in kept if r.text in near) == (5 if 5 in ids else None)


def test_components_of_long_paths_and_hubs(spark):
    path = [(i, i + 1) for i in range(60)] + [(100, 200 + i) for i in range(50)] + [(300, 301)]
    nodes = spark.createDataFrame([(n,) for n in {x for p in path for x in p} | {999}], "node long")
    got = {r.node: r.label for r in neardup.components(nodes, spark.createDataFrame(path, "a long, b long")).collect()}
    assert {got[i] for i in range(61)} == {0} and {got[200 + i] for i in range(50)} == {100}
    assert got[301] == 300 and got[999] == 999
