import random
import re
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from stridelake.llm import op11_collocations as P
from stridelake.llm.queries import SQL


def brute(rows, least, longest=5, top=2000):
    """Plain counts of all phrases, Python integers."""
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            f.update((lang, *w[i:i + k]) for k in range(1, longest + 1) for i in range(len(w) - k + 1))
    cand = {p: a for p, a in f.items() if len(p) > 2 and a >= least}
    inside = Counter()
    for p, a in cand.items():
        for k in range(2, len(p) - 1):
            for i in range(1, len(p) - k + 1):
                q = (p[0], *p[i:i + k])
                inside[q] = max(inside[q], a)
    out = {}
    for p, a in cand.items():
        if 100 * inside[p] >= 100 * a:
            continue
        lang, w = p[0], p[1:]
        s, _, left, right = min((1000 * a * n[lang] // (f[(lang, *w[:k])] * f[(lang, *w[k:])]), k,
                                 f[(lang, *w[:k])], f[(lang, *w[k:])]) for k in range(1, len(w)))
        out.setdefault(lang, []).append((-s, -a, " ".join(w).encode(), left, right))
    return sorted((lang, i + 1, p.decode(), -a, left, right, n[lang], -s) for lang, v in out.items()
                  for i, (s, a, p, left, right) in enumerate(sorted(v)[:top]))


def collected(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.fixture(scope="module")
def many(spark):
    """Phrases that repeat, overlap, end at signs; several languages."""
    rnd = random.Random(9)
    vocabulary = ["the", "Of", "é", "x\0y", "漢", "a-b", "\x1c", " ", "İ", "ß", "q"]
    rows = []
    for _ in range(400):
        w = [rnd.choice(vocabulary[:rnd.randint(2, 11)]) for _ in range(rnd.randint(0, 40))]
        text = "".join(x + rnd.choice([" ", " ", "  ", "\t", " ", ", ", ".", "\n", "\r", "\x0b"]) for x in w)
        rows.append((rnd.choice(["en", "fr", None, ""]), text))
    rows += [("en", "same word " * 900), ("en", None), ("fr", ""), ("one", "alone"), (None, " \t.,")]
    return rows


def test_against_brute_force(spark, many):
    df = spark.createDataFrame(many, "lang string, text string").repartition(4)
    assert collected(P.collocations(df, 5)) == brute(many, 5)
    assert collected(P.collocations(df, 3, longest=2, top=4)) == brute(many, 3, 2, 4)


def test_odd_rows(odd, rows, none):
    assert collected(P.collocations(odd, 3)) == brute([(r[2], r[1]) for r in rows], 3)
    assert P.collocations(none).count() == 0


def test_small_filters_and_tries_change_nothing(spark, many, monkeypatch):
    """A filter of 8 bits passes nearly all; a trie of 50 entries spills all the time."""
    df = spark.createDataFrame(many, "lang string, text string")
    phrases, _ = P.frequent_phrases(df, 5)
    want = collected(phrases)
    coarse, _ = P.frequent_phrases(df, 5, bits=3)
    assert collected(coarse) == want
    batch = pa.RecordBatch.from_pydict({"lang": ["und" if a is None else a for a, _ in many],
                                        "text": [b for _, b in many]})
    whole, parts = Counter(), Counter()
    for sums, most, burst in ((whole, 10 ** 6, 10 ** 6), (parts, 50, 4)):
        if sums is parts:
            monkeypatch.setattr(P, "WORDS_AT_ONCE", 300)
        for b in P.windows_of([batch], 2, 5, None, 26, most, burst, burst):
            for lang, phrase, n in zip(*(c.to_pylist() for c in b.columns)):
                sums[lang, phrase] += n
    assert whole == parts
    assert {(lang, p): n for lang, p, n in want if " " in p} == {
        k: n for k, n in whole.items() if n >= 5}
    full = np.full(1 << 23, 255, dtype=np.uint8)
    sums = Counter()
    for most, words in ((60, 5), (10 ** 6, 10 ** 6)):
        for b in P.pairs_of([batch], full, 26, most, words):
            for h, n in zip(*(c.to_pylist() for c in b.columns)):
                sums[h] += n if words > 5 else -n
    assert sums and not any(sums.values())


def test_trie_bursts_and_spills():
    rnd = random.Random(1)
    want, trie = Counter(), P.HatTrie(burst=8, root_burst=20)
    for _ in range(5000):
        w = [min(rnd.randint(1, 9), rnd.randint(1, 9)) for _ in range(rnd.randint(1, 4))]
        w = tuple(w + [0] * (4 - len(w)))
        want[w] += 1
        trie.add([w])
    trie.burst_root()
    assert trie.entries == len(want)
    assert any(type(c) is dict for c in trie.root.values())
    got = Counter()
    for keep in (len(want) // 2, 0):
        windows, counts = trie.spill(keep)
        assert trie.entries <= keep and windows.tolist() == sorted(windows.tolist())
        assert not {w[0] for w in got} & set(windows[:, 0].tolist())  # subtrees go whole
        got.update(dict(zip(map(tuple, windows.tolist()), counts.tolist())))
    assert got == want and not trie.root and len(trie.spill()[0]) == 0


def test_prefix_sums():
    w = np.array([[1, 2, 0], [1, 2, 3], [1, 3, 3], [2, 0, 0]])
    n = np.array([1, 2, 4, 8])
    ids, sums = P.prefix_sums(w, n, 2)
    assert ids.tolist() == [[1, 2], [1, 3]] and sums.tolist() == [3, 4]
    ids, sums = P.prefix_sums(w, n, 3)
    assert ids.tolist() == [[1, 2, 3], [1, 3, 3]] and sums.tolist() == [2, 4]
    assert P.prefix_sums(w, n, 1)[1].tolist() == [7, 8]


def test_filter_has_all_it_was_given(spark):
    df = spark.createDataFrame([("en", f"w{i}") for i in range(500)], "lang string, phrase string")
    bitmap = P.word_filter(df, 20)
    at = lambda c: np.array([P.word_hash(b"en", b"%s%d" % (c, i)) >> 44
                             for i in range(500)], dtype=np.uint64)
    assert P.has(bitmap, at(b"w")).all() and P.has(bitmap, at(b"v")).mean() < 0.02


def test_scores_past_64_bits(spark):
    a, n, x, y = 9_000_000_000_001, 900_000_000_000_000_007, 9_100_000_000_003, 123_456_789_012
    got = spark.createDataFrame([(a, n, x, y)], "a long, n long, l long, r long").select(
        P.cut_score("a", "n", "l", "r")).first()[0]
    assert got == 1000 * a * n // (x * y)


def test_ranks_in_parts(spark):
    """Many candidates: ranks come from several parts, ties by bytes."""
    df = spark.createDataFrame([("en", f"a{i} b{i}") for i in range(300)] * 3, "lang string, text string")
    got = collected(P.collocations(df, 3, top=20))
    assert [r[2] for r in got] == sorted(f"a{i} b{i}" for i in range(300))[:20]


def test_hot_first_word_spreads(spark):
    runs = spark.createDataFrame([("en", f"hot w{i}", 1) for i in range(4000)] + [("en", "x y", 2)] * 3,
                                 "lang string, phrase string, n long")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = P.merged(runs, [("en", "hot")])
        sizes = [r["count"] for r in got.groupBy(F.spark_partition_id()).count().collect()]
        assert max(sizes) < 2500 and got.where("phrase = 'x y'").first()["n"] == 6
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_sql(spark):
    d = "/root/testdata/sf0.01"
    con = duckdb.connect()
    con.sql(f"create view documents as select * from '{d}/documents.parquet'")
    want = sorted(con.sql(SQL["op11_collocations"].strip()).fetchall())
    assert want and collected(P.collocations(spark.read.parquet(d + "/documents.parquet"))) == want


def test_chains_of_frequent_pairs_are_not_put_out(spark, monkeypatch):
    """All pairs of ten words are frequent, of their chains only some: the runs hold the
    frequent phrases, whatever the number of chains."""
    rnd = random.Random(3)
    rows = [("en", " ".join(rnd.choice("abcdefghij") for _ in range(40))) for _ in range(100)]
    rows += [("en", "a b c d e")] * 40
    runs = []

    def merged(found, hot, old=P.merged):
        runs.append(found.collect())
        return old(found, hot)
    monkeypatch.setattr(P, "merged", merged)
    df = spark.createDataFrame(rows, "lang string, text string").coalesce(1)
    got = collected(P.collocations(df, 25))
    assert got == brute(rows, 25) and any(r[2] == "a b c d e" for r in got)
    by_size = Counter(r["phrase"].count(" ") + 1 for r in runs[0])
    assert by_size[2] == 100 and sum(by_size.values()) < 130


def test_threes_go_by_both_pairs():
    """Of three words with two frequent pairs the hash is summed, across pieces never."""
    batch = pa.RecordBatch.from_pydict({"lang": ["en"] * 3, "text": ["a b c", "a b. c", "x b c"]})
    h = {w: np.array([P.word_hash(b"en", w)], dtype=np.uint64) for w in (b"a", b"b", b"c", b"x")}
    pairs = np.zeros(1 << 23, dtype=np.uint8)
    for v, w in ((b"a", b"b"), (b"b", b"c")):
        at = int(P.pair_hashes(h[v], h[w])[0]) >> P.PAIR_BITS - 26
        pairs[at >> 3] |= 1 << (at & 7)
    got = [r for b in P.pairs_of([batch], None, 26, pairs=pairs) for r in b.to_pylist()]
    assert got == [{"h": int(P.three_hashes(h[b"a"], h[b"b"], h[b"c"])[0]), "n": 1}]


def test_small_partitions_share_a_run(spark, monkeypatch):
    """Rows of the last pass follow its tasks, and those neither small files nor splits."""
    parts = 4 * spark.sparkContext.defaultParallelism
    rows = [("en", " ".join(f"a{i} b{i} c{i}." for i in range(30)))] * parts
    runs = []

    def merged(found, hot, old=P.merged):
        runs.append(found.count())
        return old(found, hot)
    monkeypatch.setattr(P, "merged", merged)
    df = spark.createDataFrame(rows, "lang string, text string").repartition(parts)
    assert collected(P.collocations(df, parts)) == brute(rows, parts)
    assert runs[0] <= 3 * 30 * parts // 4


def test_rare_words_end_no_run(monkeypatch):
    """A vocabulary full of rare words is emptied of them; the trie's counts go on."""
    monkeypatch.setattr(P, "WORDS_AT_ONCE", 50)
    texts = ["a b c. " + " ".join(f"r{i}x{j}" for j in range(60)) for i in range(40)]
    batch = pa.RecordBatch.from_pydict({"lang": ["en"] * 40, "text": texts})
    words = np.zeros(1 << 23, dtype=np.uint8)
    for w in (b"a", b"b", b"c"):
        at = P.word_hash(b"en", w) >> 38
        words[at >> 3] |= 1 << (at & 7)
    got = [r for b in P.windows_of([batch], 2, 5, None, 26, 100, words=words) for r in b.to_pylist()]
    assert sorted((r["phrase"], r["n"]) for r in got) == [("a b", 40), ("a b c", 40), ("b c", 40)]
