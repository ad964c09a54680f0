"""Counts equal the tokenizers library's unigram model over the same pieces."""

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer, models, pre_tokenizers

from stridelake.llm import op2_token_counts as T
from stridelake.llm.common import vocabulary

PATH = vocabulary("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    vocab, unk = T.pieces(PATH)
    t = Tokenizer(models.Unigram(vocab, unk_id=unk, byte_fallback=True))
    t.pre_tokenizer = pre_tokenizers.Metaspace(replacement=T.MARK, prepend_scheme="always",
                                               split=True)
    return t


def test_odd_rows(odd, rows, library):
    got = sorted(((r.doc_id, r.n_tokens) for r in T.token_counts(odd).collect()), key=str)
    exp = sorted(((r[0], len(library.encode(r[1] or "", add_special_tokens=False).ids))
                  for r in rows), key=str)
    assert got == exp


@settings(max_examples=150, deadline=None)
@given(st.text(st.sampled_from("abeht nr▁é漢\n<0x>"), max_size=30))
def test_any_text(library, text):
    assert T.counter(PATH).text(text) == len(library.encode(text, add_special_tokens=False).ids)


def test_a_long_word(library):
    w = "abcdefghij" * 500
    assert T.counter(PATH).text(w) == len(library.encode(w, add_special_tokens=False).ids)


def test_cache_does_not_change_counts(monkeypatch, sample):
    texts = [r.text for r in sample.limit(20).collect()]
    monkeypatch.setattr(T, "CACHE", 3)
    c = T.Counter(PATH)
    assert [c.text(t) for t in texts] == [T.counter(PATH).text(t) for t in texts]


def test_empty_table(none):
    assert T.token_counts(none).count() == 0
