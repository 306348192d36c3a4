from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from corpus import empty_documents, odd_documents
from quarrylake.llm import packing
from quarrylake.llm.tokens import TokenIds, token_ids

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def reference():
    tokenizer = Tokenizer.from_file(VOCABULARY)
    return lambda text: tokenizer.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("text", [
    "a  b", "a \nb", "x\n\n y", " lead", "trail ", "it's  don't\tyes", "<|endoftext|> hi", "a <|endoftext|> b", "x<|endoftext|>y <|endoftext|", "<|pad|>  é <|endoftext|>", "日本語 テキスト", "a  b", "naïve Ünï 12,5 -- #*$", "", "\n", "a\r\n b",
])
def test_ids_are_those_of_the_vocabulary_file(reference, text):
    ids = TokenIds(VOCABULARY)
    assert np.frombuffer(ids.of(text), "<u4").tolist() == reference(text)


@settings(max_examples=200, deadline=None)
@given(st.text(st.sampled_from("ab'sE1 \n\té.!"), max_size=40))
def test_ids_of_any_blanks(text):
    ids = token_ids(VOCABULARY)
    assert np.frombuffer(ids.of(text), "<u4").tolist() == ids.slow.encode(text, add_special_tokens=False).ids


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(0, 50), max_size=20))
def test_a_plan_uses_every_piece_once_and_fills_no_sequence_beyond_capacity(histogram):
    used = Counter()
    for lengths, n in packing.plan(histogram, 64):
        assert sum(lengths) <= 64 and n > 0
        for length in lengths:
            used[length] += n
    assert used == +Counter(histogram)


def test_patterns_beat_plain_best_fit_where_it_is_greedy():
    histogram = {341: 300, 342: 300}
    assert sum(n for _, n in packing.plan(histogram)) == 225
    assert sum(n for _, n in packing.best_fit(Counter(histogram), 1024)) == 250


def test_a_plan_is_never_worse_than_plain_best_fit():
    draw = np.random.default_rng(6)
    for spread in (0.2, 0.3, 0.5):
        histogram = Counter(np.minimum(1024, draw.lognormal(6.2, spread, 30_000).astype(int) + 1).tolist())
        assert sum(n for _, n in packing.plan(histogram)) <= sum(n for _, n in packing.best_fit(Counter(histogram), 1024))


def test_near_the_bound_on_mixed_lengths():
    draw = np.random.default_rng(5)
    histogram = Counter(np.minimum(1024, draw.lognormal(5.5, 1.0, 20_000).astype(int) + 1).tolist())
    bound = -(-sum(k * n for k, n in histogram.items()) // 1024)
    assert sum(n for _, n in packing.plan(histogram)) <= 1.01 * bound


def test_documents_are_cut_and_placed_without_gaps(spark, reference):
    docs = odd_documents(spark).repartition(3)
    got = packing.pack(docs, VOCABULARY).collect()
    whole = {}
    for r in got:
        ids = np.frombuffer(bytes(r.ids), "<u4")
        assert len(ids) == r.length <= 1024 and (r.piece == 0 or r.length == 1024)
        whole.setdefault(r.doc_id, []).append((r.piece, r.start, ids.tolist()))
    texts = {}
    for r in docs.collect():
        texts.setdefault(r.doc_id, []).append(r.text or "")
    for doc_id, all_texts in texts.items():
        want = sorted((0, 0, [*reference(t), 2]) if len(reference(t)) < 1024 else (None, None, None) for t in all_texts if len(reference(t)) < 1024)
        if want and len(want) == len(all_texts):
            assert sorted(whole[doc_id]) == want
        else:
            pieces = [ids for _, _, ids in sorted(whole[doc_id])]
            assert sum(pieces, []) == [*reference(all_texts[0]), 2]
            assert [s for _, s, _ in sorted(whole[doc_id])] == [sum(map(len, pieces[:i])) for i in range(len(pieces))]
    by_sequence = {}
    for r in got:
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in by_sequence.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= 1024


def test_no_documents_no_pieces(spark):
    assert packing.pack(empty_documents(spark), VOCABULARY).count() == 0
