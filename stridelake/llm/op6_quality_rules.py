"""Quality rules as a short-circuit cascade, in DataFrame functions only.

A rule rejects a document by statistics of its text. On a bounded sample each
rule's cost (time to compute its statistics and test) and selectivity (share it
rejects) are measured; rules run in order of rejections per cost. A document
that a rule rejects is not looked at by later ones: their statistics are
computed only for documents still in, but for those that a caller wants of all
(``always``; the query wants the five of its digest). The order changes the cost and which rule is named as
the first to reject, never which documents are kept.

Words are ``[^\\x20\\x09-\\x0D]+``. ``n_repeat_words`` counts the words inside
3-word windows that occur at least twice: windows are hashed, sorted together
with their positions, neighbours compared. The hash has 64 bits, however long
the text.

Defined results: a null, empty or wordless text has statistics of zero and is
rejected by the length rule. Repeated rows are judged each. Extra columns are
ignored. Very long texts are judged whole. An empty table gives no row.
"""

from __future__ import annotations

import time
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut
from .common import row_sample

#: Within an SQL string.
SPACE = r"\\x20\\x09-\\x0D"
SAMPLE_ROWS = 2000


@dataclass(frozen=True)
class Rule:
    """``rejects`` is SQL over the statistics in ``needs``."""
    name: str
    needs: tuple[str, ...]
    rejects: str


#: The base rules of the digest, then the others.
BASE = [
    Rule("short", ("n_words",), "n_words < 50"),
    Rule("repeats", ("n_words", "n_repeat_words"), "100 * n_repeat_words > 50 * n_words"),
]
RULES = BASE + [
    Rule("symbols", ("word_chars", "n_symbols"), "100 * n_symbols > 4 * word_chars"),
    Rule("lines", ("n_lines", "n_dup_lines"), "100 * n_dup_lines > 50 * n_lines"),
    Rule("word_length", ("word_chars", "n_words"),
         "word_chars < 2 * n_words or word_chars > 20 * n_words"),
    Rule("shouting", ("n_bangs", "n_words"), "100 * n_bangs > 25 * n_words"),
]

#: Statistic -> (SQL, what it is computed from). All but the first three stand
#: for arrays that several statistics share; none has a value before them.
STATISTICS: dict[str, tuple[str, tuple[str, ...]]] = {
    "body": (r"btrim(coalesce(text, ''), ' \t\n\u000b\u000c\r')", ()),
    "words": (f"if(body = '', array(), split(body, '[{SPACE}]+'))", ("body",)),
    "solid": ("array_join(words, '')", ("words",)),
    "lines": (f"filter(split(coalesce(text, ''), '\\n'), l -> l rlike '[^{SPACE}]')", ()),
    "n_words": ("cast(size(words) as bigint)", ("words",)),
    "word_chars": ("cast(length(solid) as bigint)", ("solid",)),
    "n_symbols": ("cast(length(regexp_replace(solid, '[^#*$%&|<>]+', '')) as bigint)", ("solid",)),
    "n_bangs": ("cast(length(regexp_replace(solid, '[^!]+', '')) as bigint)", ("solid",)),
    "n_lines": ("cast(size(lines) as bigint)", ("lines",)),
    "n_dup_lines": ("cast(size(lines) - size(array_distinct(lines)) as bigint)", ("lines",)),
    "hashes": ("transform(words, w -> xxhash64(w))", ("words",)),
    # (hash of the window from word i, i), sorted
    "windows": ("sort_array(transform(slice(hashes, 1, greatest(size(hashes) - 2, 0)), (x, i) -> "
                "struct(xxhash64(x, get(hashes, i + 1), get(hashes, i + 2)) as h, i as i)))",
                ("hashes",)),
    # positions of windows that have an equal neighbour, sorted
    "twice": ("sort_array(transform(filter(if(size(windows) < 2, cast(array() as array<int>), "
              "sequence(0, size(windows) - 1)), j -> "
              "coalesce(get(windows, j).h = get(windows, j - 1).h, false) or "
              "coalesce(get(windows, j).h = get(windows, j + 1).h, false)), "
              "j -> cast(get(windows, j).i as bigint)))", ("windows",)),
    "n_repeat_words": ("if(size(twice) = 0, 0L, 3L + aggregate(sequence(1, greatest(size(twice) - 1"
                       ", 1)), 0L, (n, k) -> n + coalesce(least(get(twice, k) - get(twice, k - 1), "
                       "3L), 0L)))", ("twice",)),
}


def _closure(names, have: set[str]) -> list[str]:
    """Statistics to compute, in order, so that ``names`` can be."""
    out: list[str] = []

    def add(n: str) -> None:
        if n not in have and n not in out:
            for m in STATISTICS[n][1]:
                add(m)
            out.append(n)
    for n in names:
        add(n)
    return out


def with_statistics(df: DataFrame, names, alive: Column | None = None,
                    have: set[str] | None = None) -> DataFrame:
    """Adds the named statistics and what they are computed from; null where
    ``alive`` is false."""
    have = set() if have is None else have
    for n in _closure(names, have):
        value = F.expr(STATISTICS[n][0])
        df = df.withColumn(n, value if alive is None else F.when(alive, value))
        have.add(n)
    return df


def rank_rules(docs: DataFrame, rules: list[Rule], rows: int = SAMPLE_ROWS) -> list[dict]:
    """name, cost (seconds a sample), selectivity, by rejections per cost."""
    sample = cut(row_sample(docs.select("doc_id", "text"), rows), "rule-sample")
    n = max(sample.count(), 1)

    def run(rule: Rule | None) -> tuple[float, int]:
        t = time.perf_counter()
        if rule is None:
            sample.agg(F.sum(F.length("text"))).first()
            return time.perf_counter() - t, 0
        hit = with_statistics(sample, rule.needs).agg(
            F.count_if(F.expr(rule.rejects)).alias("n")).first()["n"]
        return time.perf_counter() - t, hit
    run(None)
    base = run(None)[0]  # reading the sample
    out = []
    for r in rules:
        run(r)  # compiles the plan
        took, hit = run(r)
        out.append({"rule": r, "cost": max(took - base, 1e-3), "selectivity": hit / n})
    return sorted(out, key=lambda x: -x["selectivity"] / x["cost"])


def cascade(docs: DataFrame, rules: list[Rule] | None = None, keep: list[str] | None = None,
            always: Sequence[str] = (), rows: int = SAMPLE_ROWS) -> DataFrame:
    """keep (doc_id), the statistics of the rules, rejected_by (null if none)
    and kept of every row. A statistic is null where its rules weren't reached,
    but for those of ``always``."""
    rules = RULES if rules is None else rules
    keep = keep or ["doc_id"]
    order = [x["rule"] for x in rank_rules(docs, rules, rows)]
    df = docs.select(*(F.col(c).alias(f"_{c}") for c in keep), "text")
    names = list(dict.fromkeys(n for r in rules for n in r.needs))
    have: set[str] = set()
    df = with_statistics(df, [*dict.fromkeys([*always, *order[0].needs])], have=have)
    df = df.withColumn("rejected_by", F.expr(f"if({order[0].rejects}, '{order[0].name}', null)"))
    for r in order[1:]:
        df = with_statistics(df, r.needs, F.col("rejected_by").isNull(), have)
        df = df.withColumn("rejected_by", F.expr(
            f"case when rejected_by is not null then rejected_by when {r.rejects} "
            f"then '{r.name}' end"))
    return df.select(*(F.col(f"_{c}").alias(c) for c in keep), *names, "rejected_by",
                     F.col("rejected_by").isNull().alias("kept"))


#: The contract wants these of every document; what else the rules need, and their
#: tests, stop at the first rule that rejects.
DIGEST = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def quality_rules(docs: DataFrame) -> DataFrame:
    """The digest: doc_id, n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed, kept, rejected_by of every row."""
    base = " or ".join(f"({r.rejects})" for r in BASE)
    return cascade(docs, always=DIGEST).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        F.expr(base).alias("base_failed"), "kept", "rejected_by")
