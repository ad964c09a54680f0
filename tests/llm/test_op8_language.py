import math
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest

from stridelake.llm import op8_language as L
from stridelake.llm.common import text_buffer

SF = "/root/testdata/sf0.01"


def trees_of(texts, order=L.ORDER):
    """Counts by a plain loop: (lang, text) -> Trees, and the counts."""
    n = Counter()
    for lang, t in texts:
        b = b" " * order + t.encode()
        for i in range(order, len(b)):
            n[lang, b[i - order:i + 1]] += 1
    df = pd.DataFrame([(k, int.from_bytes(g, "big"), c) for (k, g), c in n.items()],
                      columns=["lang", "gram", "n"])
    return L.Trees(df, order), n


def brute_bits(n, lang, text, order=L.ORDER):
    seen = defaultdict(Counter)
    for (k, g), c in n.items():
        if k == lang:
            for size in range(order + 1):
                seen[g[order - size:order]][g[order]] += c
    b, bits = b" " * order + text.encode(), 0.0
    for i in range(order, len(b)):
        for size in range(order, -1, -1):
            at = seen.get(b[i - size:i])
            if at is None:
                continue
            total = sum(at.values()) + len(at)
            if b[i] in at:
                bits -= math.log2(at[b[i]] / total)
                break
            bits -= math.log2(len(at) / total)
        else:
            bits += 8
    return bits


def test_code_lengths_are_exact():
    train = [("a", "the cat sat on the mat"), ("a", "then a hat"), ("b", "le chat était là"),
             ("b", "la tête à côté")]
    trees, n = trees_of(train)
    texts = ["the cat", "", "là-bas été", "zzz", "t", "the cat sat on the mat " * 20]
    bits = trees.text_bits(*text_buffer(pa.array(texts)))
    for t, row in zip(texts, bits):
        assert row.tolist() == pytest.approx([brute_bits(n, x, t) for x in ("a", "b")], rel=1e-5)


def test_long_texts_in_slices(monkeypatch):
    trees, _ = trees_of([("a", "abcabcabd"), ("b", "xyzxyz")])
    texts = ["abcabd" * 300, "x", "", "xyzab" * 200]
    whole = trees.text_bits(*text_buffer(pa.array(texts)))
    monkeypatch.setattr(L, "SLICE_BYTES", 50)
    assert np.allclose(trees.text_bits(*text_buffer(pa.array(texts))), whole)


def test_held_out_accuracy(spark):
    d = spark.read.parquet(f"{SF}/documents.parquet")
    out = L.language_id(d).join(d.select("doc_id", "lang"), "doc_id").toPandas()
    h = out[out.held_out]
    assert len(out) == 1000 and len(h) > 100
    assert (h.lang == h.lang_pred).mean() > 0.97


def test_trained_counts_are_the_plain_ones(spark):
    rows = [(1, "the cat", "a"), (2, "le chat", "b"), (3, "a cat", "a"), (4, None, "a"),
            (6, "no language", None)]
    from stridelake.llm.common import held_out
    d = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    use = [(r.lang, r.text) for r in d.where(~held_out(5)).collect() if r.text and r.lang]
    a, b = L.train(d), trees_of(use)[0]
    assert a.langs == b.langs
    for x, y in zip(a.grams + a.cost, b.grams + b.cost):
        assert np.array_equal(x, y, equal_nan=True)


def test_odd_rows(odd, rows, none):
    out = L.language_id(odd).collect()
    assert sorted(str(r.doc_id) for r in out) == sorted(str(r[0]) for r in rows)
    by = {r.doc_id: r for r in out if r.doc_id not in (None, 13)}
    for i in (0, 1, 2, 7):
        assert (by[i].lang_pred, by[i].score) == ("und", 0.0)
    for i in (5, 6, 14):
        assert by[i].lang_pred in ("en", "fr") and 0.5 <= by[i].score <= 1
    assert L.language_id(none).count() == 0
    unlearned = L.language_id(odd, train_on=none).collect()
    assert {(r.lang_pred, r.score) for r in unlearned} == {("und", 0.0)}


def test_ties_go_to_the_first_language():
    trees, _ = trees_of([("b", "same text"), ("a", "same text")])
    assert trees.text_bits(*text_buffer(pa.array(["some text"]))).argmin(axis=1)[0] == 0
    assert trees.langs == ["a", "b"]


def test_the_sample_is_bounded_for_a_repeated_id(spark):
    """Half of all rows are one row; about 50 of the rows of each language are read."""
    docs = spark.range(4000).selectExpr(
        "case when id % 2 = 0 then 1 else id end as doc_id",
        "case when id % 2 = 0 then 'aaaa' else concat('bb', id) end as text", "'en' as lang")
    trees = L.train(docs, rows_per_lang=50)
    seen = []
    real = L.arrow_out

    def keep(fn, df, *a):
        seen.append(df.count())
        return real(fn, df, *a)
    L.arrow_out = keep
    try:
        L.train(docs, rows_per_lang=50)
    finally:
        L.arrow_out = real
    assert trees.langs and 15 < seen[0] < 100
