"""The pipeline's stages on their own inputs and as a whole."""

import pytest

import __spark_entry__ as E
import corpus_pipeline as C
from stridelake.llm.op1_jaccard_join import jaccard_join
from stridelake.llm.op3_quality import labels_table, quality
from stridelake.llm.op8_language import language_id

SF = "/root/testdata/sf0.001"


def key(df):
    return sorted(((r.doc_id, r.text) for r in df.collect()), key=str)


def test_contract():
    assert [n for n, _ in C.STAGES] == ["language", "quality", "near_duplicates", "packing"]
    assert {"pipeline", *(f"op{n}_" for n in range(1, 11))} <= {
        "pipeline" if q == "pipeline" else q[:q.index("_") + 1] for q in E.queries()
        if q == "pipeline" or q.startswith("op")}
    assert C.ORACLE_SQL is None


def test_language_stage(spark, odd, rows):
    out = C.language(spark, odd, SF)
    assert out.columns == C.COLUMNS
    bad = {r.doc_id for r in language_id(odd).collect() if r.lang_pred == "und"}
    assert key(out) == sorted(((r[0], r[1]) for r in rows
                               if r[1] is not None and any(c.isalpha() for c in r[1])), key=str)
    assert {0, 1, 2, 7} <= bad


def test_quality_stage(spark, sample):
    out = C.good(spark, sample, SF)
    kept = {r.doc_id for r in quality(sample, labels_table(spark, SF)).collect() if r.predicted}
    assert out.columns == C.COLUMNS and {r.doc_id for r in out.collect()} == kept
    good = {r.doc_id for r in labels_table(spark, SF).where("quality = 1").collect()}
    assert len(good & kept) > 0.95 * len(good)


def test_near_duplicate_stage(spark, odd, rows, sample):
    out = C.distinct(spark, odd, SF)
    assert out.columns == C.COLUMNS
    text = key(out)
    assert len({t for _, t in text if t and t.strip()}) == len([t for _, t in text
                                                               if t and t.strip()])
    ids = [i for i, _ in text]
    assert 10 in ids and 11 not in ids and 12 not in ids  # the least of its group
    assert ids.count(13) == 2  # one of three equal rows, and the other text
    assert {0, 1, 2} <= set(ids)  # wordless rows have no links
    classes = {}
    for r in jaccard_join(sample).collect():
        classes.setdefault(r.class_id, set()).add(r.doc_id)
    got = {r.doc_id for r in C.distinct(spark, sample, SF).collect()}
    assert got == {min(c) for c in classes.values()}


def test_whole(spark, sample):
    docs = C.language(spark, sample, SF)
    docs = C.distinct(spark, C.good(spark, docs, SF), SF)
    kept = {r.doc_id for r in docs.collect()}
    pieces = C.run(spark, SF).collect()
    assert {p.doc_id for p in pieces} == kept


@pytest.mark.parametrize("stage", [f for _, f in C.STAGES])
def test_empty_tables(spark, none, stage):
    assert stage(spark, none.select(*C.COLUMNS), SF).count() == 0


def test_null_ids_are_kept_once(spark):
    df = spark.createDataFrame([(None, "a b c d e f"), (None, "a b c d e f"), (None, "g h i j k l"),
                                (4, "a b c d e f")],
                               "doc_id long, text string").selectExpr(
        "*", "cast(null as string) lang", "'s' source", "cast(null as bigint) n_chars")
    out = C.distinct(spark, df, SF)
    assert key(out) == [(4, "a b c d e f"), (None, "g h i j k l")]
