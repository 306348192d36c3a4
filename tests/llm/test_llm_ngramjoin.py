import itertools
import random

import numpy as np
import pytest

from corpus import blank_words, empty_documents, lowered, odd_documents, words
from quarrylake.llm import ngramjoin


def shingles(text):
    split = blank_words(lowered(text or ""))
    return {tuple(split[i:i + 3]) for i in range(max(1, len(split) - 2))} if split else set()


def linked(x, y):
    return x and y and 100 * len(x & y) >= 90 * len(x | y)


def plain_components(documents):
    sets = {i: shingles(t) for i, t in documents}
    label = {i: i for i in sets}

    def top(i):
        while label[i] != i:
            i = label[i]
        return i

    for a, b in itertools.combinations(sorted(sets), 2):
        if linked(sets[a], sets[b]):
            p, q = sorted((top(a), top(b)))
            label[q] = p
    return {i: (len(sets[i]), top(i)) for i in sets}


def changed(split, seed, edits):
    draw, out = random.Random(seed), list(split)
    for k in range(edits):
        out[draw.randrange(len(out))] = f"new{seed}x{k}"
    return out


def corpus():
    texts, passage = [], words(999, 60)
    for group in range(8):
        base = words(group, 40 + 60 * group)
        texts += [base, base] + [changed(base, 100 * group + i, 1 + i % (1 + len(base) // 90)) for i in range(8)]
        chain = base
        for i in range(5):
            chain = changed(chain, 1000 * group + i, 1)
            texts.append(chain)
    texts += [words(500 + i, 150) + passage for i in range(90)]
    texts += [words(700 + i, i % 9) for i in range(20)]
    return [(i, " ".join(t)) for i, t in enumerate(texts)]


def components(docs):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in ngramjoin.ngram_components(docs).collect()}


def test_components_are_those_of_all_pairs(spark):
    rows = corpus()
    want = plain_components(rows)
    assert len({c for _, c in want.values()}) < len(want) - 40
    assert components(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)) == want


def bound_keys(monkeypatch, crowded, fewer):
    """Sets the bounds from which keys are extended; returns the lengths that were."""
    monkeypatch.setattr(ngramjoin, "CROWDED", crowded)
    monkeypatch.setattr(ngramjoin, "FEWER", fewer)
    seen, extended = [], ngramjoin.Join.extended
    monkeypatch.setattr(ngramjoin.Join, "extended", lambda self, rows, k: seen.append(k) or extended(self, rows, k))
    return seen


@pytest.mark.parametrize("fewer", [0, 2])
def test_a_family_without_a_centre(spark, monkeypatch, fewer):
    """Documents of one form, pairwise below the threshold but for planted pairs; low
    bounds send its keys through pairs and triples."""
    seen = bound_keys(monkeypatch, 2, fewer)
    rows = []
    for i in range(24):
        form = [f"t{w}" for w in range(200)]
        for k, place in enumerate(range(5, 200, 27)):
            form[place] = f"v{i - 1 if i % 3 == 1 and k < 6 else i}x{k}"
        rows.append((i, " ".join(form)))
    want = plain_components(rows)
    assert sum(i != c for i, (_, c) in want.items()) == len(rows) // 3
    assert components(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)) == want
    if not fewer:
        assert seen == [1, 2]


def test_frequent_shingles_among_different_texts(spark, monkeypatch):
    """Short texts of few words: every key is crowded, and links hang on combinations."""
    seen = bound_keys(monkeypatch, 2, 2)
    draw, rows = random.Random(7), []
    for i in range(60):
        split = [draw.choice("abc") for _ in range(60)]
        rows += [(3 * i, " ".join(split)), (3 * i + 1, " ".join(split[1:])), (3 * i + 2, " ".join(split[:-2]))]
    assert components(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)) == plain_components(rows)
    assert seen


def test_linked_sets_share_a_key():
    """Of two linked sets under any order, the first common shingles lie in both prefixes."""
    draw = np.random.default_rng(5)
    for size in (9, 10, 11, 19, 20, 40, 99, 300):
        for _ in range(50):
            pool = draw.permutation(4 * size)
            a = set(pool[:size].tolist())
            b = set(list(a)[draw.integers(0, size // 10 + 1):]) | set(pool[size:size + draw.integers(0, size // 10 + 1)].tolist())
            if a == b or not linked(a, b):
                continue
            first = [sorted(s)[:len(s) - ngramjoin.least_common(len(s)) + k] for s in (a, b) for k in (1, 2, 3)]
            common = sorted(a & b)
            for k in (1, 2, 3):
                assert set(common[:k]) <= set(first[k - 1]) & set(first[k + 2])


def test_odd_rows(spark):
    docs = odd_documents(spark)
    got = ngramjoin.ngram_components(docs).collect()
    assert len(got) == docs.count()
    by_id = {}
    for r in got:
        by_id.setdefault(r.doc_id, set()).add((r.n_shingles, r.component_id))
    base = {r.doc_id: r.text for r in docs.collect() if r.doc_id is not None}
    want = plain_components(sorted(base.items()))
    assert {i: {v} for i, v in want.items()} == {i: v for i, v in by_id.items() if i is not None}
    assert by_id[None] == {(0, None), (want[0][0], 0)}
    assert ngramjoin.ngram_components(empty_documents(spark)).collect() == []


def test_rows_without_ids_and_with_one_id(spark):
    base = words(3, 100)
    near = [" ".join(changed(base, s, 1)) for s in (1, 2)]
    rows = [(None, " ".join(base)), (None, near[0]), (7, near[1]), (7, " ".join(base)), (9, "other text here")]
    got = sorted((r.doc_id or 0, r.component_id) for r in ngramjoin.ngram_components(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == [(0, 7), (0, 7), (7, 7), (7, 7), (9, 9)]


def test_the_least_changed_copy_weighs_most(spark):
    """Two copies share a rare shingle beside the common ones and have the most company; the
    text they come from has the common ones in front and is the better centre."""
    prefixes = [(0, [100, 101, 102]), (1, [7, 100, 101]), (2, [7, 100, 101]), (3, [9, 100, 101])]
    members = spark.createDataFrame([(node, 20, p) for node, p in prefixes], "node long, n int, prefix array<long>")
    weights = {r.node: r.weight for r in ngramjoin.shared_prefixes(members).collect()}
    assert max(weights, key=weights.get) == 0
