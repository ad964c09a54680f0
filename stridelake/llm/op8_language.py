"""Language ID by prediction with partial matching (PPM).

Each language has a variable-order byte context tree: how often each byte
followed each context of 0 to ``order`` bytes in its training texts. The
statistics are frozen. A text's code length in a language is exact: each byte
is coded in its longest context that the language has seen; a byte unseen
there costs the escape probability (method C: distinct / (total + distinct))
and is coded one order lower, at last uniformly over 256 bytes. The language
with the shortest code wins; ``score`` is its posterior under equal priors.

Training counts are one distributed pass over a bounded sample: about
``rows_per_lang`` rows of each language (parameter). Scoring visits every byte
of every text: the (order+1)-grams of a slice of texts are looked up once each.

Defined results: a null text, or one without a letter, is ``und`` with score 0,
and so is every text if no training row has a language. A null lang is never
learned from. Equal code lengths go to the alphabetically first language.
Case is folded. Extra columns of the input are ignored. Repeated rows are
scored each. A text of any length is read whole, in slices.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_out, drawn, held_out, kinds_of, slices, text_buffer

ORDER = 4
#: Text bytes whose grams are looked up together (a longer single text takes
#: several rounds).
SLICE_BYTES = 1 << 20
ROWS_PER_LANG = 1500
UND = "und"


def gram_codes(raw: np.ndarray, order: int = ORDER) -> np.ndarray:
    """Each byte with the ``order`` bytes before it as one integer; the text
    is taken as preceded by spaces."""
    p = np.concatenate([np.full(order, 32, dtype=np.uint8), raw])
    n = len(raw)
    g = p[:n].astype(np.int64)
    for k in range(1, order + 1):
        g <<= 8
        g |= p[k:k + n]
    return g


def _slice_codes(raw: np.ndarray, off: np.ndarray, order: int) -> np.ndarray:
    """``gram_codes`` of consecutive texts, contexts not crossing texts."""
    g = gram_codes(raw, order)
    full = (1 << 8 * (order + 1)) - 1
    spaces = int.from_bytes(b" " * (order + 1), "big")
    for k in range(order):  # the k-th byte of each text sees k bytes of it
        at = off[:-1][np.diff(off) > k] + k
        own = (1 << 8 * (k + 1)) - 1
        g[at] = (g[at] & own) | (spaces & (full ^ own))
    return g


class Trees:
    """Frozen context trees of all languages, as sorted arrays by order."""

    def __init__(self, counts: pd.DataFrame, order: int = ORDER):
        """counts: lang, gram (order+1 bytes), n."""
        self.order = order
        self.langs = sorted(counts["lang"].unique())
        width = len(self.langs)
        col = counts["lang"].map({x: i for i, x in enumerate(self.langs)}).to_numpy(dtype=np.int64)
        gram = counts["gram"].to_numpy(dtype=np.int64)
        n = counts["n"].to_numpy(dtype=np.float64)
        self.grams, self.cost, self.contexts, self.escape = [], [], [], []
        for k in range(order + 1):  # k bytes of context
            g, inv = np.unique(gram & ((1 << 8 * (k + 1)) - 1), return_inverse=True)
            c = np.zeros((len(g), width))
            np.add.at(c, (inv, col), n)
            x, at = np.unique(g >> 8, return_inverse=True)
            total, kinds = np.zeros((len(x), width)), np.zeros((len(x), width))
            np.add.at(total, at, c)
            np.add.at(kinds, at, c > 0)
            with np.errstate(divide="ignore", invalid="ignore"):
                cost = -np.log2(c / (total + kinds)[at])
                esc = -np.log2(kinds / (total + kinds))
            self.grams.append(g)
            self.cost.append(np.where(c > 0, cost, np.nan).astype(np.float32))  # nan: unseen
            self.contexts.append(x)
            self.escape.append(np.where(total > 0, esc, 0).astype(np.float32))  # unseen: free

    @staticmethod
    def _find(keys: np.ndarray, x: np.ndarray):
        at = np.minimum(np.searchsorted(keys, x), max(len(keys) - 1, 0))
        return at, keys[at] == x

    def lengths(self, g: np.ndarray) -> np.ndarray:
        """Code length in bits of the last byte of each gram, by language."""
        out = np.zeros((len(g), len(self.langs)), dtype=np.float64)
        todo = np.ones(out.shape, dtype=bool)
        for k in range(self.order, -1, -1):
            own = (1 << 8 * (k + 1)) - 1
            at, hit = self._find(self.grams[k], g & own)
            cost = np.where(hit[:, None], self.cost[k][at], np.nan)
            up, known = self._find(self.contexts[k], (g & own) >> 8)
            esc = np.where(known[:, None], self.escape[k][up], 0)
            seen = ~np.isnan(cost)
            out += np.where(todo, np.where(seen, cost, esc), 0)
            todo &= ~seen
        return out + 8.0 * todo

    def text_bits(self, raw: np.ndarray, off: np.ndarray) -> np.ndarray:
        """Code length of each text by language; texts back to back."""
        out = np.zeros((len(off) - 1, len(self.langs)))
        for i, j in slices(off, SLICE_BYTES):
            lo, hi = int(off[i]), int(off[j])
            for a in range(lo, hi, SLICE_BYTES):  # more than once only in one long text
                b = min(hi, a + SLICE_BYTES)
                if a == lo:
                    g = _slice_codes(raw[a:b], np.minimum(off[i:j + 1], b) - a, self.order)
                else:
                    g = gram_codes(raw[a - self.order:b], self.order)[self.order:]
                code, uniq = pd.factorize(g)
                cost = self.lengths(uniq)
                cuts = np.clip(off[i:j], a, b) - a
                some = np.flatnonzero(np.clip(off[i + 1:j + 1], a, b) - a > cuts)
                for x in range(len(self.langs)):
                    out[i + some, x] += np.add.reduceat(cost[:, x][code], cuts[some])
        return out


def _folded(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    return text_buffer(pc.utf8_lower(col.cast(pa.large_string())))


def train(docs: DataFrame, rows_per_lang: int = ROWS_PER_LANG, order: int = ORDER) -> Trees:
    """Context trees from rows with a lang and fold other than 0; about
    ``rows_per_lang`` rows of each language, each drawn by itself, so a repeated id
    fills no sample."""
    rows = docs.select("doc_id", "text", "lang").where(
        F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(5))
    per = {r["lang"]: r["n"] for r in
           rows.drop("text").groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not per:
        return Trees(pd.DataFrame({"lang": [], "gram": [], "n": []}), order)
    share = F.create_map(*[x for k, n in per.items() for x in
                           (F.lit(k), F.lit(int(min(1.0, rows_per_lang / n) * (1 << 31))))])
    picked = rows.where(drawn() < share[F.col("lang")])

    def count(b: pa.RecordBatch):
        raw, off = _folded(b.column("text"))
        lang, kinds = pd.factorize(b.column("lang").to_pandas())
        out = {"lang": [], "gram": [], "n": []}
        for i, j in slices(off, SLICE_BYTES):
            g = _slice_codes(raw[off[i]:off[j]], off[i:j + 1] - off[i], order)
            of = np.repeat(lang[i:j], np.diff(off[i:j + 1]))
            for x, name in enumerate(kinds):
                u, n = np.unique(g[of == x], return_counts=True)
                out["lang"] += [name] * len(u)
                out["gram"].append(u)
                out["n"].append(n)
        return out | {k: np.concatenate(out[k]) for k in ("gram", "n") if out[k]}

    counts = (arrow_out(count, picked, "lang string, gram bigint, n bigint")
              .groupBy("lang", "gram").agg(F.sum("n").alias("n")))
    return Trees(counts.toPandas(), order)  # bounded by the sample


def classify(docs: DataFrame, trees: Trees, keep: list[str] | None = None) -> DataFrame:
    """keep (doc_id), lang_pred and score of each row of ``docs``."""
    keep = keep or ["doc_id"]
    shared = docs.sparkSession.sparkContext.broadcast(trees)

    def score(b: pa.RecordBatch):
        t = shared.value
        text = b.column("text").cast(pa.large_string())
        some = pc.fill_null(pc.match_substring_regex(text, r"\p{L}"), False).to_numpy(
            zero_copy_only=False)
        pred, p = np.full(len(text), UND, dtype=object), np.zeros(len(text))
        if t.langs and some.any():
            bits = t.text_bits(*_folded(text.filter(pa.array(some))))
            best = bits.argmin(axis=1)
            with np.errstate(under="ignore"):
                odds = np.exp2(bits.min(axis=1)[:, None] - bits).sum(axis=1)
            pred[some], p[some] = np.array(t.langs, dtype=object)[best], 1 / odds
        return {k: b.column(k) for k in keep} | {"lang_pred": pa.array(pred, pa.string()),
                                                 "score": p}
    return arrow_out(score, docs.select(*dict.fromkeys([*keep, "text"])),
                     f"{kinds_of(docs, keep)}, lang_pred string, score double")


def language_id(docs: DataFrame, train_on: DataFrame | None = None,
                rows_per_lang: int = ROWS_PER_LANG) -> DataFrame:
    """doc_id, lang_pred, score, held_out of every row."""
    trees = train(docs if train_on is None else train_on, rows_per_lang)
    return classify(docs, trees).withColumn("held_out", held_out(5))
