import hashlib
import random
import zlib

import numpy as np
import pytest

from corpus import blank_words, empty_documents, odd_documents
from quarrylake.llm import periodic
from quarrylake.llm.queries import QUERIES


def longest_lyndon_words(text, reverse):
    """By comparing suffixes: up to the next smaller one."""
    key = [-x for x in text] if reverse else list(text)
    n = len(key)
    return [next((j for j in range(i + 1, n) if key[j:] < key[i:]), n) - i for i in range(n)]


def plain_runs(text, times, least):
    """Every stretch of equal items q apart whose shortest period is q."""
    found = set()
    for q in range(1, len(text) // times + 1):
        i = 0
        while i + q < len(text):
            begin = i
            while i + q < len(text) and text[i] == text[i + q]:
                i += 1
            length = i - begin + q
            own = text[begin:begin + length]
            if length >= max(least, times * q) and not any(own[d:] == own[:-d] for d in range(1, q)):
                found.add((begin, length, q))
            i += 1
    return found


def random_texts(seed, count):
    draw = random.Random(seed)
    for _ in range(count):
        letters = draw.choice([1, 2, 3, 5])
        text = [draw.randrange(letters) for _ in range(draw.randrange(1, 50))]
        if draw.random() < 0.3:
            text = text[:draw.randrange(1, 9)] * draw.randrange(3, 9) + text
        yield text


@pytest.mark.parametrize("reverse", [False, True])
def test_grouping_gives_longest_lyndon_words(reverse):
    for text in random_texts(1, 1500):
        assert periodic.lyndon_lengths(text, reverse) == longest_lyndon_words(text, reverse), text
    assert periodic.lyndon_lengths([], reverse) == []


@pytest.mark.parametrize(("times", "least"), [(2, 2), (2, 5), (3, 1), (4, 6)])
def test_roots_extend_to_all_runs(times, least):
    for text in random_texts(2, 1500):
        assert periodic.runs_of(np.array(text), times, least) == plain_runs(text, times, least), text


def test_one_order_alone_misses_runs():
    """Both orders are on the path to the result: each finds runs that the other does not."""
    for text in ([1, 2] * 4 + [1, 1], [2, 1] * 4 + [2, 2]):
        assert plain_runs(text, 4, 6) <= periodic.runs_of(np.array(text), 4, 6)
    rising, falling = [0, 1] * 5 + [0, 0, 2], [0, 1] * 5 + [2]
    roots = [sum(n == 2 for n in periodic.lyndon_lengths(t, r)) for t in (rising, falling) for r in (False, True)]
    assert min(roots) < 3 < max(roots)


def test_stretches_hold_all_runs():
    draw = random.Random(3)
    for _ in range(300):
        texts = [[draw.randrange(12) for _ in range(draw.randrange(0, 40))] for _ in range(4)]
        texts[1] += [draw.randrange(3)] * draw.randrange(9)
        words = np.array([w for t in texts for w in t], dtype=np.int64)
        owner = np.repeat(np.arange(4), [len(t) for t in texts])
        begins = np.cumsum([0] + [len(t) for t in texts])
        parts = periodic.stretches(words, owner, 4, 6)
        got = {(f + s, n, q) for f, e in parts for s, n, q in periodic.runs_of(words[f:e], 4, 6)}
        assert got == {(int(begins[k]) + s, n, q) for k, t in enumerate(texts) for s, n, q in plain_runs(t, 4, 6)}
        assert all(owner[f] == owner[e - 1] for f, e in parts)


def planted(doc_id, split):
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 or not split:
        return split
    g, n = h // 10, len(split)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return split[:a] + [split[a + (i - a) % p] for i in range(a, n)]


def expected(doc_id, text):
    split = planted(doc_id, blank_words(text))
    runs = sorted(plain_runs(split, 4, 6), key=lambda r: (r[0], r[2]))
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    best = None
    for s, n, q in runs:
        if best is None or n * best[2] > best[1] * q:
            best = (s, n, q)
    figures = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    listed = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    return (doc_id, len(runs), *figures, sha(listed), sha(" ".join(w for i, w in enumerate(split) if i not in gone)))


def test_query_on_odd_and_periodic_documents(spark, tmp_path):
    draw = random.Random(4)
    odd = [(r.doc_id, r.text) for r in odd_documents(spark).collect() if len(r.text or "") < 20_000]
    rows = odd + [(1000 + i, " ".join("abc"[draw.randrange(3)] for _ in range(draw.randrange(60)))) for i in range(150)]
    rows += [(5000 + i, " ".join(["x"] * i)) for i in range(12)] + [(6000, "İ ß " * 40), (6001, "a\x1fb \xa0 " * 20)]
    spark.createDataFrame(rows, "doc_id long, text string").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    got = QUERIES["op13_lyndon_runs"](spark, str(tmp_path)).collect()
    key = lambda r: (r[0] is None, str(r))
    assert sorted(map(tuple, got), key=key) == sorted((expected(*r) for r in rows), key=key)


def test_collapsed_text_and_long_documents(spark):
    rows = [(1, "go " + "no no no " * 9 + "end"), (2, None), (3, "word " * 50_000 + "tail"), (4, " ".join(str(i % 7000) for i in range(30_000)))]
    got = {r.doc_id: r for r in periodic.periodic_runs(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1].collapsed == "go no end" and got[2].collapsed == "" and got[2].runs == []
    assert got[3].collapsed == "word tail" and got[3].n_words == 50_001
    assert [tuple(r) for r in got[4].runs] == [(0, 30_000, 7000)]
    odd = odd_documents(spark)
    assert periodic.periodic_runs(odd).count() == odd.count()
    assert periodic.periodic_runs(empty_documents(spark)).collect() == []
