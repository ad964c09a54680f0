"""Ids and decoded texts equal the tokenizers library's."""

import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from stridelake.llm import op4_bpe as B
from stridelake.llm.common import vocabulary

PATH = vocabulary("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def expected(library, text):
    ids = library.encode(text, add_special_tokens=False).ids
    return (len(ids), sha(" ".join(map(str, ids))),
            sha(library.decode(ids, skip_special_tokens=False)))


def test_odd_rows(odd, rows, library):
    got = sorted(((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256)
                  for r in B.encode_decode(odd).collect()), key=str)
    assert got == sorted(((r[0], *expected(library, r[1] or "")) for r in rows), key=str)


def test_documents(sample, library):
    bpe = B.WordBpe(PATH)
    for r in sample.collect():
        ids = library.encode(r.text, add_special_tokens=False).ids
        assert bpe.encode(r.text) == ids
        assert bpe.decode(ids) == library.decode(ids, skip_special_tokens=False)
        assert bpe.digest(r.text) == expected(library, r.text)


@settings(max_examples=300, deadline=None)
@given(st.text(st.one_of(st.sampled_from("abthqzé'sS1² \n\t\x1c\x85\xa0�漢İΣ́ǆȺ"),
                         st.characters(max_codepoint=0x24F)), max_size=25))
def test_any_text(library, text):
    assert B.word_bpe(PATH).digest(text) == expected(library, text)


def test_cuts_are_between_symbols_that_no_token_holds(library):
    bpe = B.word_bpe(PATH)
    cut = [w for w in ("xqjvbzk", "qzxj", "jqw") if len(bpe.cut(w)) > 1]
    assert cut  # some words are cut
    for w in cut:
        parts = bpe.cut(w)
        assert "".join(x for p in parts for x in p) == w + bpe.end
        for p, q in zip(parts, parts[1:]):
            assert not any((p[-1], q[0]) == pair for t in bpe.ids
                           for s in [bpe.symbols(t)] for pair in zip(s, s[1:]))


def test_long_words_and_texts(library, monkeypatch):
    bpe = B.WordBpe(PATH)
    for w in ("ab" * 3000, "thequickbrown" * 200, "é" * 500):
        assert bpe.encode(w) == library.encode(w, add_special_tokens=False).ids
    monkeypatch.setattr(B, "PIECE_CHARS", 50)
    text = "the quick  brown\nfox " * 100 + "é" * 120 + " end"
    assert bpe.digest(text) == expected(library, text)


def test_small_caches_change_nothing(sample, library, monkeypatch):
    monkeypatch.setattr(B, "CACHE", 4)
    monkeypatch.setattr(B, "WORD_CACHE", 3)
    bpe = B.WordBpe(PATH)
    for r in sample.limit(20).collect():
        assert bpe.digest(r.text) == expected(library, r.text)


def test_empty_table(none):
    assert B.encode_decode(none).count() == 0


def test_the_decoded_text_comes_from_the_ids():
    """A wrong id in the table shows in both digests, so the query does decode."""
    bpe = B.WordBpe(PATH)
    n, ids, decoded = bpe.digest("one two one")
    assert decoded == hashlib.sha256(bpe.decode(bpe.encode("one two one")).encode()).hexdigest()
    wrong = B.WordBpe(PATH)
    first = str(wrong.encode("one")[0])
    other = next(i for i in wrong.text_ids.values() if i != first)
    token = next(t for t, i in wrong.text_ids.items() if i == first)
    wrong.chunks.clear()
    wrong.text_ids[token] = other
    got = wrong.digest("one two one")
    assert got[0] == n and got[1] != ids and got[2] != decoded
