"""Documents with everything an operator must bear: null columns, empty and
wordless texts, ties, repeated rows, a long text, columns whose names clash
with those the operators use inside."""

import random

import pytest

SCHEMA = ("doc_id bigint, text string, lang string, source string, n_chars bigint, k bigint, "
          "row string, word string, score double, block int, stats array<double>, halo boolean")
WORDS = ("the a er thonre ingand of to wasti heand orinre éoua çent über straße niño | ### x*** "
         "don't 12 3.5 THE!! (b) ﬁn").split()


def words(rnd, n):
    return " ".join(rnd.choice(WORDS) for _ in range(n))


def make_rows():
    rnd = random.Random(5)
    base = words(rnd, 120)
    near = base.split()
    near[60] = "changed"
    texts = [None, "", " \n\t ", "one", "one two three", "é", "漢字 かな", "#### !!", "a\nb\na\n\nb",
             "x " * 30, base, base, " ".join(near), words(rnd, 60), words(rnd, 400),
             words(rnd, 9000), "<|endoftext|> mid <|startoftext|>", "tab\there\x0bthere\x0cend\r\n",
             "İstanbul ΣΑΣ ǅ", "▁ ▁▁a"]
    rows = [(i, t) for i, t in enumerate(texts)]
    rows += [(13, texts[13]), (13, texts[13]), (13, "another text under the same id"),
             (None, "a text without an id"), (None, None), (None, base)]
    rows += [(100 + i, words(rnd, rnd.randint(1, 150))) for i in range(40)]
    return [(i, t, None if n % 5 == 0 else rnd.choice(["en", "fr"]), None if n % 7 == 0 else "s",
             None if t is None else len(t), n, "r", "w", 0.5, 1, [1.0], True)
            for n, (i, t) in enumerate(rows)]


@pytest.fixture(scope="session")
def rows():
    return make_rows()


@pytest.fixture(scope="session")
def odd(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def sample(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")


def plan_of(df):
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="session")
def plan():
    return plan_of
