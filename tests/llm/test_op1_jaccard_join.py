"""The join against all pairs of full 5-gram sets."""

import random
import re
from collections import Counter
from itertools import combinations

import numpy as np
import pandas as pd
import pytest

from stridelake.llm import op1_jaccard_join as J
from stridelake.llm.components import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, t=0.8):
    sets = []
    for _, x in rows:
        w = WORD.findall(x or "")
        sets.append({tuple(w[i:i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else set()))
    links, root = Counter(), list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a, b in combinations(range(len(rows)), 2):
        both = len(sets[a] & sets[b])
        if both and both >= t * len(sets[a] | sets[b]) - 1e-9:
            links[a] += 1
            links[b] += 1
            root[find(a)] = find(b)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    return sorted(((d, least.get(find(i)), links[i]) for i, (d, _) in enumerate(rows)), key=str)


def got(df):
    return sorted(((r.doc_id, r.class_id, r.n_links) for r in df.collect()), key=str)


def test_odd_rows(odd, rows):
    assert got(J.jaccard_join(odd)) == brute([r[:2] for r in rows])


def test_documents(sample):
    assert got(J.jaccard_join(sample)) == brute([(r.doc_id, r.text) for r in sample.collect()])


def test_large_group_in_blocks(spark):
    """A group of near copies over many blocks; chains of links."""
    rnd = random.Random(3)
    word = [f"w{i}" for i in range(400)]
    base = [rnd.choice(word) for _ in range(150)]
    rows = []
    for i in range(90):
        x = list(base)
        for _ in range(rnd.randint(0, 5)):
            x[rnd.randrange(150)] = rnd.choice(word)
        rows.append((i, " ".join(x)))
    rows += [(100 + i, " ".join(rnd.choice(word) for _ in range(80))) for i in range(20)]
    exp = brute(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert sum(r[2] for r in exp) > 300
    assert got(J.jaccard_join(df, block=16)) == exp
    assert got(J.jaccard_join(df)) == exp


def test_empty_table(none):
    assert J.jaccard_join(none).count() == 0


def test_shuffled_candidate_ids(odd, rows, monkeypatch):
    monkeypatch.setattr(J, "BROADCAST_IDS", 0)
    assert got(J.jaccard_join(odd)) == brute([r[:2] for r in rows])


def test_bands_reach_the_target_recall():
    for t, recall, r in ((0.8, 0.9995, 7), (0.8, 0.99, 5), (0.5, 0.9, 3)):
        b = J.bands_for(t, recall, r)
        assert 1 - (1 - t ** r) ** b >= recall > 1 - (1 - t ** r) ** (b - 1)


def test_overlaps_and_roots():
    rng = np.random.default_rng(0)
    sets = [np.unique(rng.integers(0, 3000, rng.integers(1, 900)).astype(np.uint64))
            for _ in range(30)]
    pairs = np.array(list(combinations(range(30), 2)))
    exp = [len(np.intersect1d(sets[a], sets[b])) for a, b in pairs]
    assert J._overlaps(sets, pairs).tolist() == exp
    assert J._roots(6, np.array([[4, 5], [2, 4], [0, 1]])).tolist() == [0, 0, 2, 3, 2, 2]


def test_only_pairs_across_blocks():
    """A task of two blocks counts links between them only."""
    s = np.arange(50, dtype=np.uint64)
    bands = J.Signer(4, 2).band_hashes(s).view(np.int64)
    pdf = pd.DataFrame({"k": [b"a", b"b", b"c"], "n": [1, 2, 4], "grams": [s.tobytes()] * 3,
                        "bands": [bands] * 3, "part": [0, 0, 1]})
    out = J.verify_block(pdf, 0.8)
    assert dict(zip(out["k"], out["links"])) == {b"a": 4, b"b": 4, b"c": 3}


@pytest.mark.parametrize("edges", [[(i, i + 1) for i in range(40)], [(0, i) for i in range(1, 60)],
                                   [(5, 3), (3, 5), (9, 8), (7, 7)]])
def test_components(spark, edges):
    out = {r.node: r.root for r in components(
        spark.createDataFrame(edges, "a long, b long")).collect()}
    root = {}
    for _ in range(len(edges)):
        for a, b in edges:
            low = min(root.get(a, a), root.get(b, b))
            root[a] = root[b] = low
    assert out == {k: v for k, v in root.items() if k != 7 or len(edges) > 4}
