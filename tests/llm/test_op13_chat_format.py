import hashlib
import random

import duckdb
import pytest
from pyspark.sql import functions as F

from stridelake.llm import op13_chat_format as C
from stridelake.llm.queries import SQL

SCHEMA = "conv_id long, turn long, role string, text string, t int, turns string, formatted long"
BITS = ["<", "|", "\\", "im_start", "<|im_start|>", "<|im_end|>", "|>", "\n", "assistant", "a", "é", " ",
        "<\\|", "<|nl|>", "漢", "<|", "$1", "\\E"]


def make():
    rnd = random.Random(3)
    text = lambda n: "".join(rnd.choice(BITS) for _ in range(rnd.randint(0, n)))
    rows = [(c, t, rnd.choice(["user", C.ASSISTANT, "system"]), text(12))
            for c in range(60) for t in range(rnd.randint(1, 7))]
    rows += [(100 + c, t, text(4), text(6)) for c in range(40) for t in range(3)]
    rows += [(200, 0, None, None), (200, 1, C.ASSISTANT, None), (200, None, C.ASSISTANT, "last"),
             (201, 2, C.ASSISTANT, "b"), (201, 2, C.ASSISTANT, "a"), (201, 2, C.ASSISTANT, "a"),
             (None, 0, "user", "no id"), (None, None, C.ASSISTANT, "<|im_end|>"),
             (202, 0, C.ASSISTANT, "long <|im_start|> " * 20_000), (203, 0, "", "")]
    return rows


def parse(text):
    """An independent reader: (role, text) of each turn."""
    out = []
    while text:
        assert text.startswith(C.START)
        body, text = text[len(C.START):].split(C.END, 1)
        assert text[:1] == "\n" and C.START not in body
        text = text[1:]
        role, body = body.split("\n", 1)
        out.append((unescape(role.replace(C.NEWLINE, "\n")), unescape(body)))
    return out


def unescape(s):
    out, i = "", 0
    while i < len(s):
        if s[i] == "<":
            j = i + 1
            while s[j:j + 1] == "\\":
                j += 1
            if j > i + 1 and s[j:j + 1] == "|":
                out, i = out + "<" + "\\" * (j - i - 2) + "|", j + 1
                continue
        out, i = out + s[i], i + 1
    return out


@pytest.fixture(scope="module")
def turns():
    by = {}
    for c, t, role, text in make():
        by.setdefault(c, []).append((t is None, t or 0, role or "", text or ""))
    return {c: [x[2:] for x in sorted(v)] for c, v in by.items()}


@pytest.fixture(scope="module")
def table(spark):
    return spark.createDataFrame([(*r, 1, "x", 2) for r in make()], SCHEMA).repartition(5)


def test_output_reads_back(table, turns):
    got = C.chat_format(table).collect()
    assert sorted(str(r.conv_id) for r in got) == sorted(map(str, turns))
    rounds = set()
    for r in got:
        want = turns[r.conv_id]
        assert parse(r.formatted) == want == [(t.role, t.text) for t in r.turns]
        parts = [r.formatted[s.start:s.start + s.length] for s in r.loss]
        assert [unescape(p) for p in parts] == [x for role, x in want if role == C.ASSISTANT]
        assert r.loss_text == "".join(map(unescape, parts))
        assert r.formatted.count(C.START) == r.formatted.count(C.END) == len(want)
        raw = "".join(f"{C.START}{a}\n{b}{C.END}\n" for a, b in want)
        assert (r.rounds == 1) == (r.formatted == raw)
        rounds.add(r.rounds)
    assert rounds == {1, 2}


def test_digest_against_plain_python(table, turns):
    for r in C.chat_digest(table).collect():
        want = turns[r.conv_id]
        loss = "".join(x for role, x in want if role == C.ASSISTANT)
        assert r.n_turns == len(want) and r.loss_chars == len(loss)
        assert r.turns_sha256 == hashlib.sha256(
            "".join(f"{a}\n{b}\n" for a, b in want).encode()).hexdigest()
        assert r.loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()


def test_sql(table):
    """conversation -1 of the SQL aside."""
    con = duckdb.connect()
    con.register("conversations", table.select("conv_id", "turn", "role", "text").toArrow())
    want = con.sql(SQL["op13_chat_format"].strip()).df().query("conv_id != -1 or conv_id.isna()")
    got = C.chat_digest(table).toPandas()
    key = lambda df: sorted(map(str, df[sorted(df)].astype(str).replace(
        {"nan|<NA>": "None", r"\.0$": ""}, regex=True).values.tolist()))
    assert key(got) == key(want)


def test_forged_turns(spark):
    d = "/root/testdata/sf0.001"
    got = {r.conv_id: r for r in C.chat_digest(C.conversations(spark, d)).collect()}
    r = got[-1]
    assert (r.n_turns, r.loss_chars) == (2, len(C.FORGED))
    assert r.loss_sha256 == hashlib.sha256(C.FORGED.encode()).hexdigest()
    n = spark.read.parquet(d + "/conversations.parquet").select("conv_id").distinct().count()
    assert len(got) == n + 1


def test_parser_refuses_what_is_not_in_the_grammar(spark):
    good = [("", 0), ("<|im_start|>a\n<|im_end|>\n", 1), ("<|im_start|>\n\n\n<|im_end|>\n", 1)]
    bad = ["x", "\n", "<|im_end|>\n", "<|im_start|>a<|im_end|>\n", "<|im_start|>a\nb<|im_end|>",
           "<|im_start|>a\nb<|im_end|>\nx", "<|im_start|>a\nb<|im_start|>c<|im_end|>\n",
           "<|im_start|>a\nb<|im_end|><|im_start|>a\nb<|im_end|>\n"]
    df = spark.createDataFrame([(x, n) for x, n in good] + [(x, None) for x in bad], "s string, n int")
    for r in df.select("n", C.parse(F.col("s")).alias("p")).collect():
        assert (None if r.p is None else len(r.p)) == r.n


def test_native_and_empty_table(spark, table, plan):
    text = plan(C.chat_digest(table))
    assert "Python" not in text and "Arrow" not in text
    assert C.chat_digest(spark.createDataFrame([], SCHEMA)).count() == 0
