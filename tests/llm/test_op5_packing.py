import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from stridelake.llm import op5_packing as P
from stridelake.llm.common import byte_bpe, vocabulary

PATH = vocabulary("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def check(pieces, texts, library, window):
    """texts: (doc_id, text); ids are told apart by doc_id and text length."""
    seqs = defaultdict(list)
    for p in pieces:
        seqs[p.sequence_id].append(p)
    for s in seqs.values():
        at = 0
        for p in sorted(s, key=lambda p: p.offset):
            assert p.offset == at and p.length > 0
            at += p.length
        assert at <= window and at == s[0].tier and at & (at - 1) == 0  # no padding
    total = 0
    want = defaultdict(list)
    for who, t in texts:
        ids = np.array([*library.encode(t or "", add_special_tokens=False).ids, P.END_ID], "<u4")
        want[who].append(ids)
        total += len(ids)
    assert sum(p.length for p in pieces) == total
    got = defaultdict(list)
    for p in pieces:
        got[p.doc_id].append(p)
    assert set(got) == set(want)
    for who, all_ids in want.items():
        if len(all_ids) == 1:  # every id in exactly one piece
            at, ids = 0, all_ids[0]
            for p in sorted(got[who], key=lambda p: p.start):
                assert p.start == at and p.doc_tokens == len(ids)
                assert p.ids_crc32 == zlib.crc32(ids[at:at + p.length].tobytes())
                at += p.length
            assert at == len(ids)
        else:
            assert sum(p.length for p in got[who]) == sum(map(len, all_ids))
            assert all(any(p.ids_crc32 == zlib.crc32(i[p.start:p.start + p.length].tobytes())
                           for i in all_ids) for p in got[who])


def test_odd_rows(odd, rows, library):
    for kw in ({}, {"window": 64, "round_tokens": 200}):
        check(P.pack(odd, **kw).collect(), [r[:2] for r in rows], library, kw.get("window", 2048))


def test_documents(sample, library):
    check(P.pack(sample).collect(), [(r.doc_id, r.text) for r in sample.collect()], library, 2048)


def test_rounds():
    rnd = random.Random(1)
    for _ in range(200):
        sizes = [rnd.choice([1, 5, 100, rnd.randint(1, 6000)]) for _ in range(rnd.randint(0, 40))]
        full, rest = P.pack_round(sizes, 256, True)
        assert not rest
        at = [0] * len(sizes)
        for d, s, n in sorted(x for q in full for x in q):
            assert s == at[d]
            at[d] += n
        assert at == sizes
        assert all(sum(n for *_, n in q) == P.tier(sum(n for *_, n in q)) <= 256 for q in full)
        full, rest = P.pack_round(sizes, 256, False)
        assert all(sum(n for *_, n in q) == 256 for q in full)
        assert sum(n for *_, n in rest) < 256


def test_each_tier_packs_sequences_of_its_own_size():
    rnd = random.Random(3)
    sizes = [rnd.choice([rnd.randint(1, 60), rnd.randint(60, 300), rnd.randint(300, 3000)])
             for _ in range(600)]
    for last in (False, True):
        full, rest = P.pack_round(sizes, 2048, last, 128)
        at, filled = defaultdict(int), 0
        seqs = [sum(n for *_, n in q) for q in full]
        if last:
            assert not rest
        else:  # the last sequences of a task have other sizes
            assert sum(n for *_, n in rest) < 2048 and set(seqs) <= {2048, 1024, 512, 256, 128}
            for q, size in zip(full, seqs):  # opened from its own tier, filled from shorter ones
                assert size == 128 or q[0][2] > size // 2
                filled += any(n <= size // 4 for *_, n in q[1:])
            assert filled
        for d, s, n in sorted([x for q in full for x in q] + rest):
            assert s == at[d]
            at[d] += n
        assert [at[d] for d in range(len(sizes))] == sizes
    short, _ = P.pack_round([200] * 500 + [400] * 500, 2048, False, 128)
    assert {sum(n for *_, n in q) for q in short} >= {512, 256}


def test_documents_of_all_sizes_make_several_tiers(spark, library):
    rows = [(i, "word " * (30 if i % 3 else 700 if i % 2 else 1500)) for i in range(150)]
    got = P.pack(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)).collect()
    check(got, rows, library, 2048)
    size = {p.sequence_id: p.tier for p in got}
    several = [t for t in set(size.values()) if list(size.values()).count(t) > 1]
    assert 2048 in several and len(several) > 1


def test_step_groups_are_balanced():
    rnd = random.Random(2)
    seqs = [[(0, 0, n), (1, 0, 256 - n)] for n in (rnd.randint(1, 255) for _ in range(80))]
    of = P.step_groups(seqs, 8)
    cost = defaultdict(int)
    for s, g in zip(seqs, of):
        cost[g] += sum(n * n for *_, n in s)
    assert sorted(of.count(g) for g in set(of)) == [8] * 10
    assert max(cost.values()) < 1.1 * min(cost.values())


@pytest.mark.parametrize("text", ["a<|endoftext|>b", " " * 5000 + "x", "a" * 20000, "\x1c​　é",
                                  "I'll don't 'S", "\n\n  \t x"])
def test_ids_equal_the_library(library, text):
    assert byte_bpe(PATH)(text).tolist() == library.encode(text, add_special_tokens=False).ids


def test_empty_table(none):
    assert P.pack(none).count() == 0
