from collections import Counter

import corpus_pipeline
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from corpus import blank_words, empty_documents, near_components, odd_documents
from quarrylake.llm import quality
from test_llm_pii import plain_spans
from test_llm_quality import plain_statistics

FOLDER = "/root/testdata/sf0.001"
TAGS = ("<EMAIL>", "<IP>", "<CARD>", "<PHONE>")


def plain_redaction(text):
    out, at = "", 0
    for start, rank, end in plain_spans(text):
        if start >= at:
            out += text[at:start] + TAGS[rank]
        at = max(at, end)
    return out + text[at:]


def stage(spark, number, docs):
    return corpus_pipeline.STAGES[number][1](spark, docs, FOLDER)


@pytest.fixture(scope="module")
def steps(spark, tmp_path_factory):
    """The documents and what each stage makes of the rows of the one before."""
    made = [spark.read.parquet(f"{FOLDER}/documents.parquet")]
    for number, (name, _) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path_factory.mktemp(name) / "rows")
        stage(spark, number, made[-1]).write.parquet(path)
        made.append(spark.read.parquet(path))
    return made


def test_each_stage_does_its_work_on_the_rows_of_the_one_before(spark, steps):
    docs = steps[0]
    assert all(s.dtypes == docs.dtypes for s in steps[1:-1])
    first, sound, single, clean, mixed = ({r.doc_id: r for r in s.collect()} for s in steps[:-1])

    assert all(first[i] == r for i, r in sound.items())
    for i in first.keys() - sound.keys():
        s = plain_statistics(first[i].text)
        failed = s["n_words"] < 10 or 100 * s["n_repeat_words"] > 20 * s["n_words"]
        assert failed or not quality.quality_verdicts(docs).filter(F.col("doc_id") == i).first().kept

    least = near_components([(i, r.text) for i, r in sound.items()])
    assert set(single) == set(least.values()) and all(sound[i] == r for i, r in single.items())

    assert set(clean) == set(single)
    for i, r in clean.items():
        want = plain_redaction(single[i].text)
        assert r.text == want or "<SECRET>" in r.text
        assert r.n_chars == len(r.text)

    assert all(clean[i] == r for i, r in mixed.items())
    words = {i: len(blank_words(r.text)) for i, r in clean.items()}
    drawn = sum(words[r.doc_id] for r in steps[4].collect())
    assert abs(drawn - 0.6 * sum(words.values())) <= 80 * max(words.values()) and drawn > 0

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    pieces, rows = {}, steps[5].collect()
    for r in rows:
        pieces.setdefault(r.doc_id, []).append((r.start, np.frombuffer(bytes(r.ids), "<u4").tolist()))
    copies = Counter(r.doc_id for r in steps[4].select("doc_id").collect())
    for i, found in pieces.items():
        ids = [*tokenizer.encode(mixed[i].text, add_special_tokens=False).ids, 2]
        once = [p for start, p in sorted(found)][::copies[i]]
        assert sum(once, []) == ids and len(found) == copies[i] * -(-len(ids) // 1024)
    assert set(pieces) == set(mixed)


def test_run_is_the_chain_of_its_stages(spark, steps):
    rows = corpus_pipeline.run(spark, FOLDER).select("doc_id", "piece", "start", "length").collect()
    assert Counter(rows) == Counter(steps[-1].select("doc_id", "piece", "start", "length").collect())


def test_odd_rows_pass_every_stage(spark, tmp_path):
    docs = odd_documents(spark)
    for number in range(len(corpus_pipeline.STAGES)):
        out = stage(spark, number, docs)
        got = Counter(map(repr, out.collect()))
        if number < 4:
            assert out.dtypes == docs.dtypes
        own = Counter(map(repr, docs.collect()))
        if number in (0, 1):
            assert not got - own
        if number == 2:
            assert got.total() == own.total() and not any("a.b@c.example.org" in r for r in got)
        if number == 3:
            assert set(got) <= set(own) and got
        if number == 4:
            copies = Counter(r.doc_id for r in docs.collect())
            assert Counter(r.doc_id for r in out.filter("start = 0").collect()) == copies


def test_an_empty_table_passes_every_stage(spark):
    docs = empty_documents(spark)
    for number in range(len(corpus_pipeline.STAGES)):
        assert stage(spark, number, docs).collect() == []


CLASHING = ("__lang", "__id", "__row", "own", "a.b", "place", "label", "kept", "rank")


def test_columns_of_any_name_pass_every_stage(spark):
    docs = odd_documents(spark).withColumns({c: F.concat(F.lit(f"{c}-"), F.coalesce(F.col("doc_id").cast("string"), F.lit("x"))) for c in CLASHING})
    ids = F.coalesce(F.col("doc_id").cast("string"), F.lit("x"))
    for number in range(4):
        out = stage(spark, number, docs)
        assert out.columns == docs.columns and out.count()
        for c in CLASHING:
            assert out.filter(F.col(f"`{c}`") != F.concat(F.lit(f"{c}-"), ids)).count() == 0
