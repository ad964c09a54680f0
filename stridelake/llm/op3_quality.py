"""Quality classifier: random Fourier features, ridge regression, isotonic
calibration.

Document statistics are shares of letter cases, digits, symbols and marks,
lengths, and repeated words, word triples and lines. Cosine features with Gaussian frequencies approximate a Gaussian kernel over
the standardised statistics. Each partition of the training rows sums its part
of the normal equations; their total is solved once for the ridge weights. A
fold the fit hasn't seen (crc32 mod 5 = 4) calibrates the raw score by isotonic
regression, so that ``score`` is the share of label 1 at that raw score.

Labels come from a bounded sample of labelled rows outside fold 0, about
``rows`` of them (parameter); statistics and scores cover all documents.

Defined results: a null or empty text has statistics of zero and gets a score
like any other; a doc_id with several labels counts with its lowest, null
labels are ignored; without training rows every score is 0.5, with one class
the score is that class; a null doc_id is held out and has no label. Repeated
rows are scored each. Extra columns of either table are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import cut
from .common import (IS_SPACE, arrow_out, bounded_sample, held_out, id_crc, kinds_of, mix64,
                     row_draw, slices, text_buffer, word_hashes, word_spans)

ROWS = 30_000
FEATURES = 256
RIDGE = 1e-3
KEEP_FROM = 0.3
SEED = 20_24
FIT_PARTITIONS = 16

STATS = ["log_bytes", "log_words", "log_lines", "bytes_per_word", "words_per_line", "upper",
         "digit", "symbol", "bang", "stop", "other_mark", "non_ascii", "same_as_last", "new_words",
         "top_word", "new_triples", "new_lines", "symbol_words", "shout_words"]


def _class(chars: bytes) -> np.ndarray:
    out = np.zeros(256, dtype=bool)
    out[list(chars)] = True
    return out


_UPPER = _class(bytes(range(65, 91)))
_LOWER = _class(bytes(range(97, 123)) + bytes(range(128, 256)))
_DIGIT = _class(b"0123456789")
_SYMBOL = _class(b"#*$%&|<>")
_BANG = _class(b"!?")
_STOP = _class(b".,;:")
_OTHER = _class(b"\"'()+-/=@[\\]^_`{}~")
_HIGH = _class(bytes(range(128, 256)))


def _sum_by(flags: np.ndarray, off: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return total[off[1:]] - total[off[:-1]]


def _repeats(keys: np.ndarray, of: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys of each document, and how often its commonest occurs."""
    if not len(keys):
        return np.zeros(n), np.zeros(n)
    _, first, times = np.unique(mix64(keys + of.astype(np.uint64) * np.uint64(0x632BE59BD9B4E019)),
                                return_index=True, return_counts=True)
    top = np.zeros(n)
    np.maximum.at(top, of[first], times)
    return np.bincount(of[first], minlength=n), top


def statistics(raw: np.ndarray, off: np.ndarray) -> np.ndarray:
    """STATS of each text; texts back to back."""
    out = np.zeros((len(off) - 1, len(STATS)))
    for i, j in slices(off):
        b, o = raw[off[i]:off[j]], off[i:j + 1] - off[i]
        n = j - i
        size = np.maximum(np.diff(o), 1)
        starts, ends, words = word_spans(b, o)
        of = np.repeat(np.arange(n), words)
        h = word_hashes(b, starts, ends)
        w = np.maximum(words, 1)
        line = b == 10
        lines = _sum_by(line, o) + 1
        solid = np.maximum(size - _sum_by(IS_SPACE[b], o), 1)
        share = [_sum_by(c[b], o) / solid for c in (_UPPER, _DIGIT, _SYMBOL, _BANG, _STOP, _OTHER,
                                                    _HIGH)]
        kinds, top = _repeats(h, of, n)
        same = np.zeros(len(h), dtype=bool)
        same[1:] = (h[1:] == h[:-1]) & (of[1:] == of[:-1])
        if len(h) > 2:
            tri = h[:-2] + mix64(h[1:-1]) * np.uint64(3) + mix64(mix64(h[2:])) * np.uint64(5)
            inside = of[:-2] == of[2:]
            tri, tri_of = tri[inside], of[:-2][inside]
        else:
            tri, tri_of = h[:0], of[:0]
        triples = np.maximum(np.bincount(tri_of, minlength=n), 1)
        # lines as sums of their words' hashes, in the order of the words
        cuts = np.unique(np.concatenate([o[:-1], np.flatnonzero(line) + 1]))
        at = np.searchsorted(starts, cuts)
        filled = np.diff(np.append(at, len(starts))) > 0
        turn = mix64(h + np.arange(len(h), dtype=np.uint64) -
                     np.repeat(at, np.diff(np.append(at, len(starts)))).astype(np.uint64)) \
            if len(h) else h
        line_h = np.add.reduceat(turn, at[filled]) if filled.any() else h[:0]
        line_of = of[at[filled]] if filled.any() else of[:0]
        with_word = np.maximum(np.bincount(line_of, minlength=n), 1)
        marked = np.concatenate([[0], np.cumsum(_SYMBOL[b], dtype=np.int64)])
        up = np.concatenate([[0], np.cumsum(_UPPER[b], dtype=np.int64)])
        low = np.concatenate([[0], np.cumsum(_LOWER[b], dtype=np.int64)])
        shout = (up[ends] - up[starts] > 1) & (low[ends] == low[starts])
        out[i:j] = np.stack([
            np.log1p(np.diff(o)), np.log1p(words), np.log1p(lines), solid / w, words / lines,
            share[0], share[1], share[2], share[3], share[4], share[5], share[6],
            np.bincount(of, weights=same, minlength=n) / w, kinds / w, top / w,
            _repeats(tri, tri_of, n)[0] / triples, _repeats(line_h, line_of, n)[0] / with_word,
            np.bincount(of, weights=marked[ends] > marked[starts], minlength=n) / w,
            np.bincount(of, weights=shout, minlength=n) / w], axis=1)
    return out


class Model:
    """Standardisation, cosine features, ridge weights, calibration steps."""

    def __init__(self, features: int = FEATURES, seed: int = SEED):
        rng = np.random.default_rng(seed)
        d = len(STATS)
        self.mean, self.scale = np.zeros(d), np.ones(d)
        self.freq = rng.normal(size=(d, features)) / np.sqrt(d)  # kernel width: sqrt(d)
        self.phase = rng.uniform(0, 2 * np.pi, features)
        self.weights = np.zeros(features + 1)
        self.x, self.y = np.array([0.0]), np.array([0.5])

    def features(self, stats: np.ndarray) -> np.ndarray:
        z = np.clip((stats - self.mean) / self.scale, -6, 6)
        f = np.cos(z @ self.freq + self.phase) * np.sqrt(2 / len(self.phase))
        return np.hstack([f, np.ones((len(f), 1))])

    def raw(self, stats: np.ndarray) -> np.ndarray:
        return self.features(stats) @ self.weights

    def score(self, stats: np.ndarray) -> np.ndarray:
        return np.clip(np.interp(self.raw(stats), self.x, self.y), 0, 1)


def _matrix(col: pa.Array) -> np.ndarray:
    return col.flatten().to_numpy(zero_copy_only=False).reshape(-1, len(STATS))


def partition_sum(df: DataFrame, fn, shape: tuple[int, ...]) -> np.ndarray:
    """Sum of ``fn(stats, label)`` over all batches: each partition adds up
    its own; ``df`` has at most FIT_PARTITIONS of them."""
    def run(batches):
        total = np.zeros(shape)
        for b in batches:
            if b.num_rows:
                total += fn(_matrix(b.column("stats")),
                            b.column("label").to_numpy(zero_copy_only=False))
        yield pa.RecordBatch.from_pydict({"part": [total.tobytes()]})
    parts = df.select("stats", "label").mapInArrow(run, "part binary").collect()
    return sum((np.frombuffer(p["part"]).reshape(shape) for p in parts), np.zeros(shape))


def isotonic(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rising step function nearest to y over x (pooled neighbours), as the
    mean x and value of each step."""
    order = np.argsort(x, kind="stable")
    steps: list[list[float]] = []  # sum of x, sum of y, rows
    for a, b in zip(x[order], y[order]):
        steps.append([a, b, 1])
        while len(steps) > 1 and steps[-2][1] * steps[-1][2] >= steps[-1][1] * steps[-2][2]:
            top = steps.pop()
            steps[-1] = [p + q for p, q in zip(steps[-1], top)]
    s = np.array(steps)
    return s[:, 0] / s[:, 2], s[:, 1] / s[:, 2]


def training_rows(docs: DataFrame, labels: DataFrame, rows: int) -> DataFrame:
    """doc_id, label, stats of a bounded sample of labelled rows outside fold
    0, written: the statistics of these rows only are computed here."""
    one = (labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull())
           .groupBy("doc_id").agg(F.min("quality").cast("double").alias("label"))
           .where(~held_out(5)))
    one = cut(bounded_sample(one, F.col("doc_id"), rows), "quality-labels")

    def stats(b: pa.RecordBatch):
        s = statistics(*text_buffer(b.column("text")))
        at = np.arange(len(s) + 1) * len(STATS)
        return {"doc_id": b.column("doc_id"), "label": b.column("label"),
                "stats": pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(s.ravel()))}
    # the broadcast side is bounded: about `rows` labels; a labelled id may have any
    # number of rows, of which about twice `rows` in all are drawn
    both = docs.select("doc_id", "text").join(F.broadcast(one), "doc_id")
    both = row_draw(both, 2 * rows)
    return cut(arrow_out(stats, both, "doc_id bigint, label double, stats array<double>")
               .repartition(FIT_PARTITIONS), "quality-train")


def fit(docs: DataFrame, labels: DataFrame, rows: int = ROWS, ridge: float = RIDGE) -> Model:
    """docs: doc_id, text; labels: doc_id, quality."""
    model = Model()
    seen = training_rows(docs, labels, rows)
    d = len(STATS)
    unseen = id_crc() % 5 == 4
    train = seen.where(~unseen)
    sums = partition_sum(train, lambda s, y: np.stack([
        s.sum(0), (s * s).sum(0), np.full(d, len(s)), np.full(d, y.sum())]), (4, d))
    n, ones = sums[2, 0], sums[3, 0]
    if n == 0:
        return model
    if ones in (0, n):
        model.y = np.array([ones / n])
        return model
    model.mean = sums[0] / n
    model.scale = np.sqrt(np.maximum(sums[1] / n - model.mean ** 2, 0)) + 1e-6
    shared = model

    def equations(s, y):
        f = shared.features(s)
        return np.hstack([f.T @ f, (f.T @ y)[:, None]])
    k = len(model.weights)
    both = partition_sum(train, equations, (k, k + 1))
    model.weights = np.linalg.solve(both[:, :k] + ridge * n * np.eye(k) / k, both[:, k])
    check = seen.where(unseen).select("stats", "label").toPandas()  # about 2 x `rows` at most
    if check.empty:
        check = train.select("stats", "label").toPandas()
    raw = model.raw(np.stack(check["stats"].to_numpy()).astype(float))
    model.x, model.y = isotonic(raw, check["label"].to_numpy(dtype=float))
    return model


def classify(docs: DataFrame, model: Model, keep: list[str] | None = None) -> DataFrame:
    """keep (doc_id), score and predicted of each row of ``docs``."""
    keep = keep or ["doc_id"]
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(b: pa.RecordBatch):
        p = shared.value.score(statistics(*text_buffer(b.column("text"))))
        return {k: b.column(k) for k in keep} | {
            "score": p, "predicted": (p >= KEEP_FROM).astype(np.int32)}
    return arrow_out(run, docs.select(*dict.fromkeys([*keep, "text"])),
                     f"{kinds_of(docs, keep)}, score double, predicted int")


def quality(docs: DataFrame, labels: DataFrame, rows: int = ROWS) -> DataFrame:
    """doc_id, score, predicted, held_out of every row."""
    return classify(docs, fit(docs, labels, rows)).withColumn("held_out", held_out(5))


def labels_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
