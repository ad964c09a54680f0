import math
import zlib
from collections import Counter

import numpy as np
import pytest

from stridelake.llm import op9_lm as M
from stridelake.llm.common import vocabulary


def toy():
    spell = [bytes([b]) for b in range(256)] + [b" a", b"ab", b" ab", b"bc", b"abc", b"bcabc"]
    return M.Lattice(spell, np.log(np.random.default_rng(1).dirichlet(np.ones(len(spell)))))


def brute(t, s):
    """(probability, expected uses times it) over all segmentations."""
    if not s:
        return 1.0, Counter()
    z, c = 0.0, Counter()
    for k in range(1, len(s) + 1):
        if (i := t.at.get(s[:k])) is not None:
            q = math.exp(t.log_p[i])
            z2, c2 = brute(t, s[k:])
            z += q * z2
            c[i] += q * z2
            for x, y in c2.items():
                c[x] += q * y
    return z, c


WORDS = [b"a", b"abc", b"abcab", b"zab", b"", b"\xff\xc3bc", b"abcabcabc", b"abababab"]


@pytest.mark.parametrize("most", [M.ARRAY_BYTES, 2])
def test_marginals_and_expected_counts(monkeypatch, most):
    monkeypatch.setattr(M, "ARRAY_BYTES", most)  # 2: nearly all by the plain loop
    t = toy()
    weight = np.arange(1.0, len(WORDS) + 1)
    into, exp = np.zeros(len(t.spell)), np.zeros(len(t.spell))
    got = t.words(WORDS, weight, into)
    for w, k, v in zip(WORDS, weight, got):
        z, c = brute(t, b" " + w)
        assert v == pytest.approx(math.log(z), rel=1e-9)
        for i, y in c.items():
            exp[i] += k * y / z
    assert np.allclose(exp, into)


def test_long_words_stay_finite():
    t = toy()
    v = t.words([b"q" * 48, b"ab" * 5000])
    assert np.isfinite(v).all() and v[0] == pytest.approx(
        t.log_p[32] + 48 * t.log_p[ord("q")])


def test_vocabulary_pieces_sum_to_one():
    spell, log_p = M.piece_list(vocabulary("piece_bpe_32k.model"))
    assert len(set(spell)) == len(spell) > 20_000
    assert np.exp(log_p).sum() == pytest.approx(1)
    assert not any(b" " in s[1:] or s != s.lower() for s in spell[256:])


def test_token_probabilities_sum_to_one():
    counts = np.array([5, 1, 1, 2])
    docs, tokens = 3, 12
    mix = M.Mixture(tokens, 5, 2, 1)
    own = (10 ** mix.log10(counts, np.full(4, -np.inf))).sum() + 10 ** mix.end(docs)
    assert own + mix.spelled == pytest.approx(1)


def digest(rows):
    toks = [((r[1] or "").encode().lower().split()) for r in rows]
    out = [zlib.crc32(("" if r[0] is None else str(r[0])).encode()) % 10 == 0 for r in rows]
    c = Counter(w for t, o in zip(toks, out) if not o for w in t)
    c[None] = out.count(False)
    n, v = sum(c.values()), len([x for x in c.values() if x])
    exp = []
    for r, t, o in zip(rows, toks, out):
        t = [*t, None]
        exp.append((r[0], o, len(t), sum(c[w] > 0 for w in t), n,
                    round(sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in t), 6)))
    return sorted(exp, key=str)


@pytest.mark.parametrize("common", [M.COMMON, 5])
def test_base_score(odd, rows, common):
    got = M.lm_scores(odd, rounds=1, common=common).collect()
    assert sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens,
                    round(r.base_score, 6)) for r in got), key=str) == digest(rows)
    assert all(r.score < 0 and math.isfinite(r.score) for r in got)


def test_scores_do_not_depend_on_where_words_are_looked_up(odd):
    a, b = (sorted(((r.doc_id, r.n_tokens, round(r.score, 6)) for r in
                    M.lm_scores(odd, rounds=1, common=n).collect()), key=str) for n in (5, 10_000))
    assert a == b


def test_model_learns(spark, sample):
    """Fitted scores of held-out texts beat the vocabulary's own order."""
    from pyspark.sql import functions as F
    a, b = (M.lm_scores(sample, rounds=n).where("held_out").agg(F.sum("score")).first()[0]
            for n in (0, 2))
    assert b > a


def test_untrained_and_empty(spark, none):
    assert M.lm_scores(none).count() == 0
    out = [i for i in range(200) if zlib.crc32(str(i).encode()) % 10 == 0][:3]
    df = spark.createDataFrame([(i, "a few words") for i in out], "doc_id long, text string")
    for r in M.lm_scores(df).collect():
        assert (r.train_tokens, r.n_known, r.n_tokens) == (0, 0, 4)
        assert r.base_score == 0.0 and math.isfinite(r.score)


def test_frequent_words_are_found_without_a_sort(spark):
    from stridelake.llm.op9_lm import least_step, step_of
    n = [1] * 50 + [2] * 20 + [256] * 3 + [257, 300, 10_000, 10 ** 12]
    w = spark.createDataFrame([(x,) for x in n], "n_all long")
    steps = {r.n_all: r.s for r in w.select("n_all", step_of("n_all").alias("s")).collect()}
    assert sorted(steps, key=lambda x: (steps[x], x)) == sorted(steps) and steps[256] == 256
    assert max(steps.values()) < 1000
    for rows in (0, 1, 3, 6, 7, 27, 76, 77, 500):
        got = w.where(step_of("n_all") >= least_step(w, rows)).count()
        assert got == max(k for k in (0, 1, 2, 3, 4, 7, 27, 77) if k <= rows)
    assert least_step(w.limit(0), 5) == 0
