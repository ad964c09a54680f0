import numpy as np
import pytest

from stridelake.llm import op3_quality as Q
from stridelake.llm.common import held_out, text_buffer

import pyarrow as pa

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def scored(spark):
    d = spark.read.parquet(f"{SF}/documents.parquet")
    out = Q.quality(d, Q.labels_table(spark, SF))
    return out.join(Q.labels_table(spark, SF), "doc_id").toPandas()


def test_held_out_accuracy(scored):
    h = scored[scored.held_out]
    assert len(h) > 40
    assert (h.predicted == h.quality).mean() > 0.95
    assert h.predicted[h.quality == 1].mean() > 0.97
    assert h.score.between(0, 1).all()
    assert ((h.score >= 0.3) == (h.predicted == 1)).all()


def test_odd_rows(spark, odd, rows):
    labels = spark.createDataFrame([(i, i % 2) for i in range(100, 140)] + [
        (101, 0), (13, None), (None, 1)], "doc_id long, quality int")
    out = Q.quality(odd, labels).collect()
    assert sorted(str(r.doc_id) for r in out) == sorted(str(r[0]) for r in rows)
    assert all(0 <= r.score <= 1 for r in out)
    same = {r.score for r in out if r.doc_id in (10, 11)}
    assert len(same) == 1  # equal texts, equal scores


def test_without_labels_and_with_one_class(spark, odd, none):
    nothing = spark.createDataFrame([], "doc_id long, quality int")
    assert {r.score for r in Q.quality(odd, nothing).collect()} == {0.5}
    for c in (0, 1):
        one = spark.createDataFrame([(i, c) for i in range(100, 140)], "doc_id long, quality int")
        assert {r.score for r in Q.quality(odd, one).collect()} == {float(c)}
    assert Q.quality(none, nothing).count() == 0


def test_labels_of_the_held_out_fold_change_nothing(spark, odd):
    df = spark.createDataFrame([(i, (i // 3) % 2) for i in range(100, 140)],
                               "doc_id long, quality int")
    turned = df.selectExpr("doc_id", "1 - quality as quality").where(held_out(5))
    a = Q.fit(odd, df)
    b = Q.fit(odd, df.where(~held_out(5)).union(turned))
    assert np.allclose(a.weights, b.weights) and np.allclose(a.y, b.y)


def test_ridge_is_the_direct_solution(spark, odd):
    labels = spark.createDataFrame([(i, i % 2) for i in range(100, 140)], "doc_id long, quality int")
    m = Q.fit(odd, labels)
    rows = Q.training_rows(odd, labels, Q.ROWS).toPandas()
    import zlib
    rows = rows[[zlib.crc32(str(i).encode()) % 5 != 4 for i in rows.doc_id]]
    f = m.features(np.stack(rows["stats"].to_numpy()))
    k = f.shape[1]
    w = np.linalg.solve(f.T @ f + Q.RIDGE * len(f) * np.eye(k) / k, f.T @ rows["label"].to_numpy())
    assert np.allclose(f @ w, f @ m.weights, atol=1e-6)


def test_isotonic_is_pooled_neighbours():
    rng = np.random.default_rng(1)
    x, y = rng.normal(size=200), rng.integers(0, 2, 200).astype(float)
    sx, sy = Q.isotonic(x, y)
    assert (np.diff(sx) > 0).all() and (np.diff(sy) > 0).all()
    assert Q.isotonic(np.arange(4.), np.array([0, 1, 0, 1.]))[1].tolist() == [0, 0.5, 1]


def test_statistics_by_hand():
    texts = ["", "The CAT sat.\nThe CAT sat.", "a a a a", "x*** ##\n\n y"]
    s = {n: c for n, c in zip(Q.STATS, Q.statistics(*text_buffer(pa.array(texts))).T)}
    assert np.expm1(s["log_words"]).round().tolist() == [0, 6, 4, 3]
    assert s["new_lines"].tolist() == [0, 0.5, 1, 1]
    assert s["new_words"][1:].tolist() == [0.5, 0.25, 1]
    assert s["same_as_last"].tolist() == [0, 0, 0.75, 0]
    assert s["top_word"][1:].tolist() == [1 / 3, 1, 1 / 3]
    assert s["shout_words"][1] == pytest.approx(1 / 3)
    assert s["symbol"][3] == pytest.approx(5 / 7)


def test_statistics_do_not_depend_on_neighbours(sample):
    texts = [r.text for r in sample.limit(40).collect()]
    whole = Q.statistics(*text_buffer(pa.array(texts)))
    for i in (0, 7, 39):
        assert np.allclose(whole[i], Q.statistics(*text_buffer(pa.array([texts[i]])))[0])


def test_training_rows_are_bounded_for_a_repeated_id(spark):
    """A third of all rows have one labelled id."""
    ids = "case when id % 3 = 0 then 2 else id end as doc_id"
    docs = spark.range(9000).selectExpr(ids, "concat('some text ', id % 7) as text")
    labels = spark.range(1, 201).selectExpr("id as doc_id", "cast(id % 2 as int) as quality")
    got = Q.training_rows(docs, labels, 100).count()
    assert 130 < got < 270  # about twice 100 of the 3,000 and more that have a label
    assert Q.training_rows(docs, labels, 10_000).count() > 2500
