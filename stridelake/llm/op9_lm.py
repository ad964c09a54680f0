"""Language-model scores by subword lattices.

Texts are words (``[^\\x20\\x09-\\x0D]+``, A-Z lower-cased) and one end. A word,
with the mark of its start, is spelled by pieces of an existing public
vocabulary and by single bytes; the pieces' scores are probabilities, and all
segmentations count: a forward recursion in log space over the word's bytes
sums them to its marginal probability. A word of the training documents has one
more arc from its start to its end, itself, with its discounted share of the
tokens; what the discount leaves goes to the spelling. Pieces never cross a
word's start, so a text's probability is the product over its words and the
end, and each distinct word is worked out once. All texts' probabilities sum to
one.

Piece scores start from the vocabulary's own order and are fitted to the
training documents (crc32 of the id mod 10 not 0) by ``rounds`` of expected
counts over all their distinct words, each once. Word counts, expected counts and scores
are Spark jobs over all documents; the driver gets only one number per piece
and the ``common`` most frequent words (a fixed number), which tasks look up
directly. The other words of a document meet their scores in a join.

``base_score`` is the additive word-unigram score of the same split: the sum
over tokens of log10((c + 0.1) / (N + 0.1 (V + 1))).

Defined results: a null or empty text is the end alone; a null doc_id counts
as held out; without training documents N is 0, piece scores stay as they
start, and the end has probability one half. Repeated rows are scored and counted each. Extra columns are ignored.
Texts and words of any length are scored whole.
"""

from __future__ import annotations

import functools
import math
from collections import Counter
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut
from .common import arrow_out, held_out, larger, mix64, vocabulary

ROUNDS = 2
COMMON = 200_000
#: Distinct words a task counts before it passes them on.
FLUSH = 400_000
SMOOTH = 0.01
#: Distinct words worked out together.
WORD_ROWS = 100_000
#: Words up to this many bytes are scored in arrays of equal length.
ARRAY_BYTES = 48
ARRAY_CELLS = 1 << 17
_TURN = np.uint64(0x9E3779B97F4A7C15)


# -- pieces ---------------------------------------------------------------
@functools.lru_cache(maxsize=2)
def piece_list(path: str) -> tuple[list[bytes], np.ndarray]:
    """Spelling pieces (a start mark is a space) and their first scores: 256
    single bytes, then the vocabulary's in its order."""
    from .op2_token_counts import MARK, pieces
    out = [bytes([b]) for b in range(256)]
    seen = set(out)
    for p, _ in pieces(path)[0]:
        b = p.replace(MARK, " ").encode()
        # what lower-cased words can hold: no other space, no capital
        if b not in seen and b" " not in b[1:] and b == b.lower() and not (
                p.startswith("<") and p.endswith(">")):
            seen.add(b)
            out.append(b)
    weight = np.concatenate([np.full(256, 1e-5), 1 / np.arange(2, len(out) - 254)])
    return out, np.log(weight / weight.sum())


class Lattice:
    """Piece spellings with log probabilities."""

    #: Table values: no entry; the beginning of a piece but none itself.
    EMPTY, PREFIX = -1, -2

    def __init__(self, spell: list[bytes], log_p: np.ndarray):
        self.spell, self.log_p = spell, log_p
        self.most = max(map(len, spell))
        self.at = {b: i for i, b in enumerate(spell)}
        # an open hash table of pieces and their beginnings, for arrays of words
        entries = {b[:k]: self.PREFIX for b in spell for k in range(1, len(b))} | self.at
        self.bits = max(4, (8 * len(entries)).bit_length())
        self.keys = np.zeros(1 << self.bits, dtype=np.uint64)
        self.values = np.full(1 << self.bits, self.EMPTY, dtype=np.int32)
        for b, v in entries.items():
            h = np.full(1, 77, dtype=np.uint64)
            for c in b:
                h = self._step(h, np.array([c], dtype=np.uint8))
            k = mix64(h)[0]
            s = int(k >> np.uint64(64 - self.bits))
            while self.values[s] != self.EMPTY:
                s = (s + 1) % len(self.keys)
            self.keys[s], self.values[s] = k, v

    @staticmethod
    def _step(h: np.ndarray, byte: np.ndarray) -> np.ndarray:
        h = (h ^ byte) * _TURN
        return h ^ (h >> np.uint64(29))

    def find(self, h: np.ndarray) -> np.ndarray:
        """Table values of hashes."""
        s = (h >> np.uint64(64 - self.bits)).astype(np.int64)
        out = self.values[s]
        todo = np.flatnonzero((out != self.EMPTY) & (self.keys[s] != h))
        while len(todo):
            s[todo] = (s[todo] + 1) % len(self.keys)
            out[todo] = self.values[s[todo]]
            todo = todo[(out[todo] != self.EMPTY) & (self.keys[s[todo]] != h[todo])]
        return out

    def _edges(self, words: np.ndarray) -> list[tuple[int, int, np.ndarray, np.ndarray]]:
        """(start, end, rows, their pieces); of each start the single bytes
        first, which all rows have. Rows leave as soon as no piece begins
        with what they have."""
        m, n = words.shape
        out = []
        for i in range(n):
            rows, h = np.arange(m), np.full(m, 77, dtype=np.uint64)
            for j in range(i, min(n, i + self.most)):
                h = self._step(h, words[rows, j])
                v = self.find(mix64(h))
                hit = v >= 0
                if hit.any():
                    out.append((i, j + 1, rows[hit], v[hit]))
                go = v != self.EMPTY
                rows, h = rows[go], h[go]
                if not len(rows):
                    break
        return out

    def _arrays(self, words: np.ndarray, weight: np.ndarray | None, into: np.ndarray | None):
        """Log probability of each row; with ``weight``, adds the expected
        number of times each piece is used to ``into``. Sums are kept
        relative to the way through the last single byte, so that they stay
        in range."""
        m, n = words.shape
        edges, p = self._edges(words), self.log_p
        by_end: list[list] = [[] for _ in range(n + 1)]
        for e in edges:
            by_end[e[1]].append(e)
        a = np.zeros((n + 1, m))
        for j in range(1, n + 1):
            i, _, _, ids = by_end[j][-1]  # the single byte
            base = a[i] + p[ids]
            total = np.ones(m)
            for i, _, rows, ids in by_end[j][:-1]:
                total[rows] += np.exp(a[i][rows] + p[ids] - base[rows])
            a[j] = base + np.log(total)
        if weight is not None:
            by_start: list[list] = [[] for _ in range(n)]
            for e in edges:
                by_start[e[0]].append(e)
            b = np.zeros((n + 1, m))
            used, pieces = [], []
            for i in range(n - 1, -1, -1):
                j, ids = by_start[i][0][1], by_start[i][0][3]
                base = b[j] + p[ids]
                total = np.ones(m)
                for _, j, rows, ids in by_start[i][1:]:
                    total[rows] += np.exp(b[j][rows] + p[ids] - base[rows])
                b[i] = base + np.log(total)
                for _, j, rows, ids in by_start[i]:
                    used.append(np.exp(a[i][rows] + p[ids] + b[j][rows] - a[n][rows]) * weight[rows])
                    pieces.append(ids)
            into += np.bincount(np.concatenate(pieces), weights=np.concatenate(used),
                                minlength=len(into))
        return a[n]

    def _one(self, word: bytes, weight: float, into: np.ndarray | None) -> float:
        """The same for one long word."""
        n, p, at = len(word), self.log_p, self.at
        edges = [[(j, x) for j in range(i + 1, min(n, i + self.most) + 1)
                  if (x := at.get(word[i:j])) is not None] for i in range(n)]
        a = [-math.inf] * (n + 1)
        a[0] = 0.0
        for i in range(n):
            for j, x in edges[i]:
                a[j] = _log_add(a[j], a[i] + p[x])
        if into is not None:
            b = [-math.inf] * n + [0.0]
            for i in range(n - 1, -1, -1):
                for j, x in edges[i]:
                    b[i] = _log_add(b[i], b[j] + p[x])
                    into[x] += weight * math.exp(a[i] + p[x] + b[j] - a[n])
        return a[n]

    def words(self, words: list[bytes], weight: np.ndarray | None = None,
              into: np.ndarray | None = None) -> np.ndarray:
        """Natural-log marginal probability of each word."""
        out = np.zeros(len(words))
        size = np.array([len(w) for w in words])
        for n in np.unique(size):
            who = np.flatnonzero(size == n)
            if n > ARRAY_BYTES:
                for x in who:
                    out[x] = self._one(b" " + words[x], 0 if weight is None else weight[x], into)
                continue
            step = max(1, ARRAY_CELLS // (int(n) + 1))
            for k in range(0, len(who), step):
                part = who[k:k + step]
                rows = np.frombuffer(b"".join([b" " + words[x] for x in part]),
                                     np.uint8).reshape(len(part), n + 1)
                out[part] = self._arrays(rows, None if weight is None else weight[part], into)
        return out


def _log_add(x: float, y: float) -> float:
    if x < y:
        x, y = y, x
    return x if y == -math.inf else x + math.log1p(math.exp(y - x))


# -- corpus counts ----------------------------------------------------------
def _words(col: pa.Array) -> tuple[list[bytes], np.ndarray]:
    """Words of all texts back to back, and the number of each text's:
    bytes.lower and bytes.split know ASCII only, which is the contract's lower
    case and white space."""
    each = [t.lower().split() for t in col.cast(pa.binary()).fill_null(b"").to_pylist()]
    return list(chain.from_iterable(each)), np.array([len(x) for x in each], dtype=np.int64)


def word_counts(docs: DataFrame) -> DataFrame:
    """word, n_train, n_all of every distinct word of all documents."""
    schema = "word binary, n_train bigint, n_all bigint"

    def run(batches):
        train, rest = Counter(), Counter()

        def flush():
            for part, share in ((train, 1), (rest, 0)):
                words, n = list(part), np.fromiter(part.values(), np.int64, len(part))
                for a in range(0, len(words), 50_000):
                    yield pa.RecordBatch.from_pydict(
                        {"word": pa.array(words[a:a + 50_000], pa.binary()),
                         "n_train": pa.array(n[a:a + 50_000] * share),
                         "n_all": pa.array(n[a:a + 50_000])})
                part.clear()
        for b in batches:
            for part, out in ((train, False), (rest, True)):
                some = pc.equal(b.column("out"), out)
                for k in range(0, b.num_rows, 1000):
                    part.update(_words(b.column("text").slice(k, 1000).filter(
                        some.slice(k, 1000)))[0])
                    if len(train) + len(rest) > FLUSH:
                        yield from flush()
        yield from flush()
    return (docs.select("text", held_out(10).alias("out")).mapInArrow(run, schema)
            .groupBy("word").agg(F.sum("n_train").alias("n_train"), F.sum("n_all").alias("n_all")))


def expected_counts(words: DataFrame, lattice: Lattice) -> np.ndarray:
    """Expected uses of each piece over the training words; one number per
    piece comes to the driver."""
    shared = words.sparkSession.sparkContext.broadcast(lattice)

    def run(batches):
        t = shared.value
        total = np.zeros(len(t.spell))
        for b in larger(batches, WORD_ROWS):
            if b.num_rows:
                t.words(b.column("word").to_pylist(), np.ones(b.num_rows), total)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"piece": pa.array(some, pa.int32()),
                                          "uses": pa.array(total[some], pa.float64())})
    got = (words.where("n_train > 0").select("word")
           .mapInArrow(run, "piece int, uses double")
           .groupBy("piece").agg(F.sum("uses").alias("uses")).toPandas())
    out = np.zeros(len(lattice.spell))
    out[got["piece"].to_numpy()] = got["uses"].to_numpy()
    return out


def fit(words: DataFrame, path: str, rounds: int = ROUNDS) -> Lattice:
    """The lattice of a vocabulary file, fitted to the training words."""
    spell, log_p = piece_list(path)
    lattice = Lattice(spell, log_p)
    for _ in range(rounds):
        uses = expected_counts(words, lattice) + SMOOTH
        lattice = Lattice(spell, np.log(uses / uses.sum()))
    return lattice


class Mixture:
    """Probability of a token from its training count and its spelling."""

    def __init__(self, tokens: int, kinds: int, once: int, twice: int):
        self.tokens = tokens
        self.discount = once / (once + 2 * twice) if once else 0.5
        self.spelled = self.discount * kinds / tokens if tokens else 0.5

    def log10(self, count: np.ndarray, log_spelled: np.ndarray) -> np.ndarray:
        own = np.maximum(count - self.discount, 0) / max(self.tokens, 1)
        with np.errstate(divide="ignore"):
            return np.logaddexp(np.log(own), math.log(self.spelled) + log_spelled) / math.log(10)

    def end(self, documents: int) -> float:
        return math.log10((documents - self.discount) / self.tokens) if documents else -math.log10(2)


# -- scores -----------------------------------------------------------------
def step_of(count: str) -> Column:
    """Counts in steps: each by itself up to 256, then 16 steps to a doubling."""
    c = F.col(count)
    return F.when(c <= 256, c).otherwise(
        F.lit(256) + F.ceil(F.log2(c / F.lit(256.0)) * F.lit(16))).cast("bigint")


def least_step(words: DataFrame, rows: int) -> int:
    """The least step of ``n_all`` that at most ``rows`` words reach: a histogram
    of some hundred steps comes to the driver, no words are sorted."""
    held = 0
    steps = words.groupBy(step_of("n_all").alias("step")).count().collect()
    for r in sorted(steps, key=lambda r: -r["step"]):
        held += r["count"]
        if held > rows:
            return r["step"] + 1
    return 0


def lm_scores(docs: DataFrame, vocab: str | None = None, rounds: int = ROUNDS,
              common: int = COMMON) -> DataFrame:
    """The digest: doc_id, held_out, n_tokens, n_known, train_tokens,
    base_score, score of every row."""
    path = vocab or vocabulary("piece_bpe_32k.model")
    spark = docs.sparkSession
    counts = cut(word_counts(docs), "lm-counts")
    n_docs = docs.where(~held_out(10)).count()
    total, kinds, once, twice = counts.agg(
        F.coalesce(F.sum("n_train"), F.lit(0)),
        *(F.count_if(c) for c in (F.col("n_train") > 0, F.col("n_train") == 1,
                                  F.col("n_train") == 2))).first()
    n, v = total + n_docs, kinds + (n_docs > 0)
    mix = Mixture(n, v, once + (n_docs == 1), twice + (n_docs == 2))
    lattice = spark.sparkContext.broadcast(fit(counts, path, rounds if total else 0))

    def spell(b: pa.RecordBatch):
        seen = b.column("n_train").to_numpy(zero_copy_only=False)
        spelled = lattice.value.words(b.column("word").to_pylist())
        return {k: b.column(k) for k in ("word", "n_train", "n_all")} | {
            "log_p": mix.log10(seen, spelled)}
    words = cut(arrow_out(spell, counts, "word binary, n_train bigint, n_all bigint, log_p double",
                          WORD_ROWS), "lm-words")
    under = n + 0.1 * (v + 1)
    # at most `common` words, most of all tokens
    top = words.where(step_of("n_all") >= least_step(words, common)).toPandas()
    seen, p = top["n_train"].to_numpy(), top["log_p"].to_numpy()
    # known, base score, score by number; the last for words that aren't here
    near = spark.sparkContext.broadcast((
        {bytes(w): i for i, w in enumerate(top["word"])},
        np.stack([np.append(x, 0.0) for x in (seen > 0, np.log10((seen + 0.1) / under), p)])))
    end = np.array([n_docs > 0, math.log10((n_docs + 0.1) / under), mix.end(n_docs)])

    def scored(batches):
        number, value = near.value
        row = TaskContext.get().partitionId() << 40
        for whole in batches:
            for k in range(0, whole.num_rows, 1000):
                b = whole.slice(k, 1000)
                words_, sizes = _words(b.column("text"))
                at = np.fromiter(map(number.get, words_, repeat(len(number))), np.int64,
                                 len(words_))
                of = np.repeat(np.arange(b.num_rows), sizes)
                known, base, p = (np.bincount(of, weights=v[at], minlength=b.num_rows) + e
                                  for v, e in zip(value, end))
                far = np.flatnonzero(at == len(number))
                cuts = np.searchsorted(of[far], np.arange(b.num_rows + 1))
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id"), b.column("held_out"),
                     pa.array(row + np.arange(b.num_rows)), pa.array(sizes + 1),
                     pa.array(np.rint(known).astype(np.int64)), pa.array(base), pa.array(p),
                     pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(
                         [words_[i] for i in far], pa.binary()))],
                    names=["doc_id", "held_out", "row", "n_tokens", "n_known", "base", "score",
                           "others"])
                row += b.num_rows
    rows = cut(docs.select("doc_id", held_out(10).alias("held_out"), "text").mapInArrow(
        scored, "doc_id bigint, held_out boolean, row bigint, n_tokens bigint, n_known bigint, "
                "base double, score double, others array<binary>"), "lm-rows")
    c = F.coalesce("n_train", F.lit(0))
    rest = (rows.select("row", F.explode("others").alias("word"))
            .join(words.select("word", (c > 0).cast("bigint").alias("hit"),
                               F.log10((c + 0.1) / under).alias("base"), "log_p"), "word")
            .groupBy("row").agg(F.sum("hit").alias("more_known"), F.sum("base").alias("more_base"),
                                F.sum("log_p").alias("more")))
    zero = F.lit(0)
    return (rows.drop("others").join(rest, "row", "left").select(
        "doc_id", "held_out", "n_tokens",
        (F.col("n_known") + F.coalesce("more_known", zero)).alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("more_base", zero)).alias("base_score"),
        (F.col("score") + F.coalesce("more", zero)).alias("score")))
