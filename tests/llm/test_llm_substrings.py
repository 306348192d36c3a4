import hashlib
import random

from corpus import blank_words, empty_documents, odd_documents, words
from quarrylake.llm import substrings


def plain(rows, size=13):
    """(n_words, n_removed, digest) per (id, text), from all windows; a null id orders last."""
    order = lambda i: float("inf") if i is None else i
    first = {}
    for i, text in rows:
        split = blank_words(text)
        for p in range(len(split) - size + 1):
            key = tuple(split[p:p + size])
            first[key] = min(first.get(key, order(i)), order(i))
    out = {}
    for i, text in rows:
        split = blank_words(text)
        gone = [False] * len(split)
        for p in range(len(split) - size + 1):
            if first[tuple(split[p:p + size])] < order(i):
                gone[p:p + size] = [True] * size
        kept = " ".join(w for w, g in zip(split, gone, strict=True) if not g)
        out[(i, text)] = (len(split), sum(gone), hashlib.sha256(kept.encode()).hexdigest())
    return out


def results(docs):
    found = substrings.repeated_spans(docs).collect()
    hashes = {(r.doc_id, r.text_hash): r.text for r in substrings.with_text_hash(docs).collect()}
    return [((r.doc_id, hashes[(r.doc_id, r.text_hash)]), (r.n_words, sum(e - s for s, e in r.spans), r.kept_sha256)) for r in found]


def corpus():
    """Shared passages of all lengths around 13, copies, near copies, repeats within one text."""
    draw, texts = random.Random(7), []
    passages = [words(50 + i, n) for i, n in enumerate((11, 12, 13, 14, 20, 60, 200))]
    for i in range(60):
        text = words(i, draw.randrange(5, 120), 5000)
        for passage in draw.sample(passages, 3):
            a = draw.randrange(0, len(passage) // 3)
            at = draw.randrange(len(text) + 1)
            text[at:at] = passage[a:] if draw.random() < 0.5 else passage
        if i % 7 == 0:
            text += text[:30]
        texts.append(text)
    texts += [texts[3], texts[10], texts[20][:50], [*texts[20][:40], "x", *texts[20][40:]], ["a"] * 40, ["a"] * 12, ["a"] * 13, ["a", "b"] * 30]
    return [(i, " ".join(t)) for i, t in enumerate(texts)]


def test_removed_words_are_those_of_all_windows(spark):
    rows = corpus()
    draw = random.Random(1)
    draw.shuffle(rows)
    got = dict(results(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)))
    want = plain(rows)
    assert got == want
    assert sum(n for _, n, _ in want.values()) > 1000


def test_given_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert dict(results(docs)) == plain(rows)


def test_odd_rows(spark):
    docs = odd_documents(spark)
    rows = [(r.doc_id, r.text or "") for r in docs.collect()]
    want = plain(rows)
    got = results(docs)
    assert len(got) == len(rows)
    assert all(value == want[key] for key, value in got)
    assert substrings.repeated_spans(empty_documents(spark)).count() == 0
