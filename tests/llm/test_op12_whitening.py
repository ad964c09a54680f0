import math
import random

import numpy as np
import pytest

from stridelake.llm import op12_whitening as W

SCHEMA = "vec_id long, embedding array<float>, label int, x string, n int, component string"


def exact(vectors):
    """n, x, S, deviations, covariance by Python integers and numpy's eigh."""
    x = [[math.floor(64 * float(c)) + 1_000_000 for c in v] for v in vectors]
    n, s = len(x), [sum(c) for c in zip(*x)]
    away = [[n * c - t for c, t in zip(v, s)] for v in x]
    y = np.array([[a / n for a in v] for v in away])
    return n, [sum(a * a for a in v) for v in away], y, y.T @ y / n


@pytest.fixture(scope="module")
def table(spark):
    return spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")


def test_against_eigh(table):
    rows = {r.vec_id: r.embedding for r in table.collect()}
    n, deviation, y, cov = exact(list(rows.values()))
    values, vectors = np.linalg.eigh(cov)
    values, vectors = values[::-1][:32], vectors[:, ::-1][:, :32]
    want = y @ vectors / np.sqrt(values)
    got = W.whitening(table).toPandas()
    assert len(got) == 32 * n and set(got.n) == {n}
    assert got.identity_error.nunique() == 1 and got.identity_error[0] < 1e-10
    z = got.pivot(index="vec_id", columns="component", values="whitened").loc[list(rows)]
    z = z[list(range(1, 33))].to_numpy()
    sign = np.sign((z * want).sum(axis=0))
    assert np.abs(z * sign - want).max() < 1e-8
    assert np.abs(z.T @ z / n - np.eye(32)).max() < 1e-10
    first = got[got.component == 1].set_index("vec_id").loc[list(rows)]
    assert first.deviation.tolist() == deviation
    share = got.drop_duplicates("component").sort_values("component").explained
    assert np.allclose(share, values / np.trace(cov), rtol=1e-10)


def odd_vectors():
    rnd = random.Random(2)
    v = [(i, [rnd.uniform(-3, 3) for _ in range(5)]) for i in range(40)]
    v += [(None, [1.0] * 5), (7, v[7][1]), (7, v[7][1]), (50, None), (51, []), (52, [1.0, None] * 2 + [0.]),
          (53, [float("nan")] * 5), (54, [1.0, 2.0, 3.0, 4.0, float("-inf")]), (55, [1.0, 2.0]),
          (56, [3e38, 0.0, 0.0, 0.0, 0.0])]
    return v


def test_odd_rows(spark):
    df = spark.createDataFrame([(i, e, 0, "x", 1, "c") for i, e in odd_vectors()], SCHEMA).repartition(4)
    kept = [(i, np.float32(e)) for i, e in odd_vectors()[:43]]
    n, deviation, _, cov = exact([e for _, e in kept])
    got = W.whitening(df).toPandas()
    assert len(got) == 43 * 5 and set(got.n) == {43} and got.identity_error[0] < 1e-10
    assert sorted(got[got.component == 1].deviation) == sorted(deviation)
    assert got.vec_id.isna().sum() == 5 and (got.vec_id == 7).sum() == 15
    values = np.linalg.eigvalsh(cov)[::-1]
    assert np.allclose(got.drop_duplicates("component").explained, values / values.sum())


def test_rank_and_degenerate_tables(spark):
    line = [(i, [float(i), 2.0 * i, 5.0]) for i in range(9)]
    got = W.whitening(spark.createDataFrame(line, "vec_id long, embedding array<double>")).toPandas()
    assert len(got) == 9 and got.component.eq(1).all() and np.allclose(got.explained, 1)
    assert abs(got.whitened.pow(2).mean() - 1) < 1e-12
    same = spark.createDataFrame([(i, [1.0, 2.0]) for i in range(4)], "vec_id long, embedding array<float>")
    assert W.whitening(same).count() == 0
    assert W.whitening(spark.createDataFrame([], SCHEMA)).count() == 0


def test_entries_past_64_bit_products(spark):
    """n x - S leaves 64 bits: exact integers take over; a deviation that does too is null."""
    far = [(i, [2.0 ** 54 * (1 if i % 2 else -1), float(i)]) for i in range(6)]
    got = W.whitening(spark.createDataFrame(far, "vec_id long, embedding array<double>")).toPandas()
    assert len(got) >= 6 and got.deviation.isna().all() and got.whitened.abs().max() < 3


@pytest.mark.parametrize("d,rank", [(1, 1), (7, 7), (16, 5), (33, 33)])
def test_factor_and_rotation(d, rank):
    rnd = np.random.default_rng(d)
    b = rnd.normal(size=(d, rank)) * 10.0 ** rnd.uniform(-1, 2, size=rank)
    a = b @ b.T
    low, order = W.pivoted_cholesky(a)
    assert low.shape == (d, rank) and np.allclose(low @ low.T, a[np.ix_(order, order)], rtol=1e-9)
    assert np.allclose(np.triu(low[:rank], 1), 0)
    g = W.one_sided_jacobi(low)
    assert np.allclose(g @ g.T, low @ low.T, rtol=1e-9)
    norms = np.sqrt((g * g).sum(0))
    assert np.abs((g / norms).T @ (g / norms) - np.eye(rank)).max() < 1e-12
    assert np.allclose(np.sort(norms ** 2)[::-1], np.linalg.eigvalsh(a)[::-1][:rank], rtol=1e-6)


def test_rounds_cover_every_pair_once():
    for r in (2, 5, 8):
        pairs = [(int(p), int(q)) for a, b in W.round_robin(r) for p, q in zip(a, b)]
        assert sorted(pairs) == [(i, j) for i in range(r) for j in range(i + 1, r)]
        assert all(len(set(a) | set(b)) == 2 * len(a) for a, b in W.round_robin(r))
