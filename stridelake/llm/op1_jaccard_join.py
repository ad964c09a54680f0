"""N-gram Jaccard join by MinHash banding.

Texts are sets of word 5-grams (64-bit hashes; a text of one to four words is
one shorter gram). Texts with equal sets form a class and one of them stands
for it, so copies are never paired. Band hashes of MinHash signatures are
shuffled; band and row counts are chosen for the target recall at the
threshold. Classes that share a band are candidates; each candidate group is
verified on the full n-gram sets, in blocks, and gives per class its number of
links and a spanning set of links, not all pairs.

How a group is dealt out: classes joined by band leaders (each class with its
bucket's least class, one row per class and bucket) form a candidate group.
Small groups share tasks; a group over ``block`` classes is split into blocks
and each pair of blocks is a task, so no task holds more than two blocks, and
within a task only pairs that share a band are verified.

Result per row of the input: doc_id, class_id (the least doc_id among all that
links join, directly or not), n_links (rows with a similarity of at least the
threshold, copies included, itself not).

Defined results: a null, empty or wordless text has no grams, no links, and
its own doc_id as class_id, also beside others like it. A null doc_id stays
null, and its links count; a class of null ids only has a null class_id.
Repeated rows are copies of each other. Extra columns are ignored. Very long
texts are read whole, in slices. An empty table gives no row.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut
from .common import arrow_out, kinds_of, mix64, slices, text_buffer, word_hashes, word_spans
from .components import components

WORDS = 5
THRESHOLD = 0.8
RECALL = 0.9995
ROWS_PER_BAND = 7
BLOCK = 768
#: Candidate classes up to which their ids are broadcast to pick their texts;
#: beyond it that join is shuffled.
BROADCAST_IDS = 1_000_000
_TURN = np.uint64(0xD6E8FEB86659FD93)


def bands_for(threshold: float, recall: float, rows: int) -> int:
    """Bands of ``rows`` rows that find a pair at the threshold with at least
    this probability."""
    return math.ceil(math.log(1 - recall) / math.log(1 - threshold ** rows))


def gram_sets(raw: np.ndarray, off: np.ndarray, words: int = WORDS):
    """(values, offsets): the sorted distinct word n-gram hashes of each text."""
    sets, sizes = [np.zeros(0, dtype=np.uint64)], [0]
    for i, j in slices(off):
        b, o = raw[off[i]:off[j]], off[i:j + 1] - off[i]
        starts, ends, counts = word_spans(b, o)
        h = word_hashes(b, starts, ends)
        g = np.zeros(max(len(h) - words + 1, 0), dtype=np.uint64)
        for k in range(words):
            g = mix64(g * _TURN + h[k:k + len(g)])
        first = np.concatenate([[0], np.cumsum(counts)])
        for d in range(j - i):
            n = counts[d]
            if n >= words:
                own = np.sort(g[first[d]:first[d] + n - words + 1])
                own = own[np.concatenate([[True], own[1:] != own[:-1]])]
            elif n:  # a shorter text is one gram, of its words and their number
                own = np.array([n], dtype=np.uint64)
                for x in h[first[d]:first[d] + n]:
                    own = mix64(own * _TURN + x)
            else:
                own = h[:0]
            sets.append(own)
            sizes.append(len(own))
    return np.concatenate(sets), np.cumsum(sizes)


def set_key(s: np.ndarray) -> bytes:
    """128 bits of a set, whatever its order."""
    a, b = mix64(s), mix64(s ^ _TURN)
    return np.array([a.sum(), b.sum() + np.uint64(len(s))], dtype=">u8").tobytes()


class Signer:
    def __init__(self, bands: int, rows: int, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.bands, self.rows = bands, rows
        top = np.iinfo(np.uint64).max
        self.mul = rng.integers(0, top, bands * rows, dtype=np.uint64) | np.uint64(1)
        self.add = rng.integers(0, top, bands * rows, dtype=np.uint64)
        self.salt = rng.integers(0, top, bands, dtype=np.uint64)

    def band_hashes(self, s: np.ndarray) -> np.ndarray:
        """One hash for each band of the set's MinHash signature."""
        low = np.full(len(self.mul), np.iinfo(np.uint64).max, dtype=np.uint64)
        for a in range(0, len(s), 512):
            low = np.minimum(low, (s[a:a + 512, None] * self.mul + self.add).min(axis=0))
        out = self.salt.copy()
        for x in mix64(low).reshape(self.bands, self.rows).T:
            out = mix64(out * _TURN + x)
        return out


def signatures(docs: DataFrame, bands: int, rows: int, keep: list[str]) -> DataFrame:
    """keep, k (key of the n-gram set; null if it is empty), bands."""
    def sign(b: pa.RecordBatch):
        signer, keys, out = Signer(bands, rows), [], []
        values, at = gram_sets(*text_buffer(b.column("text")))
        known: dict[bytes, np.ndarray] = {}
        for lo, hi in zip(at[:-1], at[1:]):
            k = set_key(values[lo:hi]) if hi > lo else None
            if k is not None and k not in known:
                known[k] = signer.band_hashes(values[lo:hi]).view(np.int64)
            keys.append(k)
            out.append(known[k] if k is not None else None)
        return {c: b.column(c) for c in keep} | {"k": pa.array(keys, pa.binary()),
                                                 "bands": pa.array(out, pa.list_(pa.int64()))}
    return arrow_out(sign, docs.select(*keep, "text"),
                     f"{kinds_of(docs, keep)}, k binary, bands array<bigint>")


def sets_of(docs: DataFrame) -> DataFrame:
    """k and grams (packed 64-bit hashes) of every row with a gram."""
    def pack(b: pa.RecordBatch):
        values, at = gram_sets(*text_buffer(b.column("text")))
        some = [values[lo:hi] for lo, hi in zip(at[:-1], at[1:]) if hi > lo]
        return {"k": pa.array([set_key(s) for s in some], pa.binary()),
                "grams": pa.array([s.tobytes() for s in some], pa.binary())} if some else None
    return arrow_out(pack, docs.select("text"), "k binary, grams binary")


def _candidate_pairs(bands: np.ndarray, side: np.ndarray | None) -> np.ndarray:
    """Pairs (i, j) of rows that share a band hash; with ``side``, only pairs
    of one row on each side."""
    n = len(bands)
    flat = bands.ravel()
    order = np.argsort(flat, kind="stable")
    who, key = order // bands.shape[1], flat[order]
    cuts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1], [True]]))
    meet = np.zeros((n, n), dtype=bool)
    for a, b in zip(cuts[:-1], cuts[1:]):
        if b - a > 1:
            w = who[a:b]
            meet[np.ix_(w, w)] = True
    if side is not None:
        meet &= side[:, None] != side[None, :]
    i, j = np.nonzero(np.triu(meet, 1))
    return np.stack([i, j], axis=1)


def _overlaps(sets: list[np.ndarray], pairs: np.ndarray) -> np.ndarray:
    """Size of the intersection of each pair of sets, over bit rows of the
    grams that at least two of the sets hold."""
    values = np.concatenate(sets)
    of = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    order = np.argsort(values, kind="stable")
    v, of = values[order], of[order]
    same = np.concatenate([[False], v[1:] == v[:-1]])
    shared = same | np.concatenate([same[1:], [False]])
    rank = np.cumsum(~same & shared)[shared] - 1
    of = of[shared]
    width = (int(rank[-1]) >> 6) + 1 if len(rank) else 1
    out = np.zeros(len(pairs), dtype=np.int64)
    for lo in range(0, width, 4096):  # columns at once, so that bit rows stay small
        here = (rank >> 6 >= lo) & (rank >> 6 < lo + 4096)
        if not here.any():
            continue
        bits = np.zeros((len(sets), min(4096, width - lo)), dtype=np.uint64)
        np.bitwise_or.at(bits, (of[here], (rank[here] >> 6) - lo),
                         np.uint64(1) << (rank[here] & 63).astype(np.uint64))
        step = max(1, (1 << 21) // bits.shape[1])
        for a in range(0, len(pairs), step):
            p = pairs[a:a + step]
            out[a:a + step] += np.bitwise_count(bits[p[:, 0]] & bits[p[:, 1]]).sum(
                axis=1, dtype=np.int64)
    return out


def _roots(n: int, pairs: np.ndarray) -> np.ndarray:
    """The least row that pairs join each row to."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[pairs[:, 0]], root[pairs[:, 1]])
        new = root.copy()
        np.minimum.at(new, pairs[:, 0], low)
        np.minimum.at(new, pairs[:, 1], low)
        np.minimum.at(new, root[pairs[:, 0]], low)
        np.minimum.at(new, root[pairs[:, 1]], low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def verify_block(pdf: pd.DataFrame, threshold: float) -> pd.DataFrame:
    """k, links (rows linked to a row of the class in this task), other (a
    class that links join it to, or null) of the classes of one task."""
    nothing = pd.DataFrame({"k": [], "links": [], "other": []})
    pdf = pdf.sort_values("k", kind="stable").reset_index(drop=True)
    bands = np.stack(pdf["bands"].to_numpy())
    sides = pdf["part"].to_numpy()
    pairs = _candidate_pairs(bands, sides if sides.min() != sides.max() else None)
    sets = [np.frombuffer(g, dtype=np.uint64) for g in pdf["grams"]]
    size = np.array([len(s) for s in sets])
    if len(pairs):
        a, b = size[pairs[:, 0]], size[pairs[:, 1]]
        pairs = pairs[np.minimum(a, b) >= threshold * np.maximum(a, b) - 1e-9]
    if not len(pairs):
        return nothing
    both = _overlaps(sets, pairs)
    union = size[pairs[:, 0]] + size[pairs[:, 1]] - both
    pairs = pairs[both >= threshold * union - 1e-9]
    if not len(pairs):
        return nothing
    count = pdf["n"].to_numpy()
    links = np.zeros(len(pdf), dtype=np.int64)
    np.add.at(links, pairs[:, 0], count[pairs[:, 1]])
    np.add.at(links, pairs[:, 1], count[pairs[:, 0]])
    root = _roots(len(pdf), pairs)
    at = np.flatnonzero(links > 0)
    k = pdf["k"].to_numpy()
    return pd.DataFrame({"k": k[at], "links": links[at], "other": k[root[at]]})


def jaccard_join(docs: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL,
                 rows: int = ROWS_PER_BAND, block: int = BLOCK,
                 keep: list[str] | None = None) -> DataFrame:
    """keep (doc_id first), class_id, n_links and root (the key of what links
    join, null without grams) of every row of ``docs`` (see the module)."""
    keep = keep or ["doc_id"]
    signed = cut(signatures(docs, bands_for(threshold, recall, rows), rows, keep), "join-signed")
    classes = cut(signed.where(F.col("k").isNotNull()).groupBy("k").agg(
        F.count("*").alias("n"), F.min("doc_id").alias("least"),
        F.first("bands").alias("bands")), "join-classes")
    # candidates: every class of a band bucket with the least class in it
    rows_of = classes.select("k", F.explode("bands").alias("band"))
    buckets = cut(rows_of.groupBy("band").agg(F.min("k").alias("lead"), F.count("*").alias("m"))
                  .where("m > 1").drop("m"), "join-buckets")
    stars = rows_of.join(buckets, "band").where(F.col("k") != F.col("lead")).select(
        F.col("k").alias("a"), F.col("lead").alias("b"))
    groups = cut(components(stars), "join-groups")  # node, root
    # deal the groups out: blocks of large ones, many small ones to a task
    sizes = groups.groupBy("root").agg(F.count("*").alias("m"))
    n_cand = groups.count()
    shares = max(1, n_cand // block)
    large = cut(sizes.where(F.col("m") > block).select(
        "root", F.ceil(F.col("m") / block).cast("int").alias("parts")), "join-large")
    placed = (groups.join(large, "root", "left")
              .select(F.col("node").alias("k"), "root", "parts",
                      F.when(F.col("parts").isNull(), F.lit(0)).otherwise(
                          F.pmod(F.xxhash64("node"), F.col("parts"))).cast("int").alias("part")))
    tasks = placed.select(
        "k", "part", F.explode(F.when(
            F.col("parts").isNull(),
            F.array(F.struct(F.pmod(F.xxhash64("root"), F.lit(shares)).alias("t"),
                             F.lit(-1).alias("i"), F.lit(-1).alias("j"))))
            .otherwise(F.transform(
                F.sequence(F.lit(0), F.col("parts") - 1),
                lambda x: F.struct(F.xxhash64("root").alias("t"),
                                   F.least(x, F.col("part")).alias("i"),
                                   F.greatest(x, F.col("part")).alias("j"))))).alias("task"))
    # the candidates' texts, one for each class
    one = groups.select(F.col("node").alias("k")).join(classes, "k")
    ids = one.select(F.col("least").alias("id"))
    if n_cand <= BROADCAST_IDS:
        ids = F.broadcast(ids)
    texts = docs.select("doc_id", "text").join(ids, F.col("doc_id").eqNullSafe(F.col("id")),
                                               "left_semi")
    sets = cut(sets_of(texts).join(groups.select(F.col("node").alias("k")), "k", "left_semi")
               .dropDuplicates(["k"])
               .join(classes.select("k", "n", "bands"), "k"), "join-sets")
    found = cut(tasks.join(sets, "k").groupBy("task.t", "task.i", "task.j").applyInPandas(
        lambda pdf: verify_block(pdf, threshold), "k binary, links bigint, other binary"),
        "join-links")
    links = found.groupBy("k").agg(F.sum("links").alias("links"))
    joined = components(found.select(F.col("k").alias("a"), F.col("other").alias("b")))
    # class ids: the least doc_id of a component, then of every class
    member = cut(classes.select("k", "n", "least")
                 .join(joined.select(F.col("node").alias("k"), "root"), "k", "left")
                 .join(links, "k", "left")
                 .select("k", "n", "least", F.coalesce("root", "k").alias("root"),
                         F.coalesce("links", F.lit(0)).alias("links")), "join-members")
    least = cut(member.groupBy("root").agg(F.min("least").alias("class_id")), "join-least")
    per_class = cut(member.join(least, "root").select(
        "k", "class_id", (F.col("n") - 1 + F.col("links")).alias("n_links"), "root"), "join-class")
    return (signed.drop("bands").join(per_class, "k", "left")
            .select(*keep,
                    F.when(F.col("k").isNull(), F.col("doc_id")).otherwise(F.col("class_id"))
                    .alias("class_id"),
                    F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), "root"))
