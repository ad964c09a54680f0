r"""Phrase collocations: exact phrase counts by HAT-tries, scored by their weakest cut.

Four passes over whole texts. Words are counted first. The second adds up hashes of
pairs of neighbours that both occur often enough, the third those of three words
whose two pairs do. The fourth counts phrases all of whose neighbouring pairs and
threes do: a phrase is never more frequent than what it contains, so nothing that
could be a candidate is left out. What is frequent reaches the next pass as a bitmap
of hashes whose size is a parameter; an accidental hit costs a count and changes
none. So the phrases that a task puts out are nearly all frequent ones, not the far
more that chain frequent pairs, whose number grows faster than the texts.

In the fourth pass a task counts its windows in a trie over its own word ids. The
root is a hash table of windows until it bursts into one table (the rest of the
window -> count) per first word; a table that grows past a bound bursts again, into
one per next word, and no deeper. When the trie holds too many entries its largest
subtrees are spilled whole, as a sorted run; sums over a run's equal beginnings are
the counts of the phrases. Spark merges the runs per prefix partition: the first
word, or, for the few words with a noticeable share of the corpus, the whole phrase,
so that no partition follows a hot word. A task of this pass takes several partitions
of the texts, where there are more than cores: a run has each phrase once, so fewer
runs of more texts are fewer rows.

Scores take decimals of 38 digits. A candidate is dropped where a candidate one
word longer contains it and is as frequent; a much longer one that contains it
needs no look, since those between are as frequent then. The first ``top`` of a
language come from ranks within salted parts, then among the parts' first ones.

Defined results: a null text has no words, a null lang is ``und``. Texts are taken
whole. Repeated rows count each. Ties in a score go to the more frequent phrase,
then by the phrase's UTF-8 bytes. Extra columns are ignored. A language without
candidates, and an empty table, give no row.
"""

from __future__ import annotations

import math
from array import array
from collections import Counter
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut
from .common import give_back, mix64

MIN_COUNT, MAX_WORDS, TOP = 100, 5, 2000
#: Entries past which the root and a table of suffixes burst.
ROOT_BURST, BURST = 65_536, 4096
#: Entries of a task's trie (and words of its vocabulary) before it spills.
MOST_ENTRIES = 400_000
#: Words (of whole texts) and hashes of pairs or threes that are handled at once.
WORDS_AT_ONCE, PAIRS_AT_ONCE = 200_000, 2_000_000
#: Partitions of texts that a task of the last pass takes, if as many tasks as cores remain.
PARTS_A_TASK = 4
#: Bits of a pair's hash when pairs are counted: few of 10^11 pairs share one.
PAIR_BITS = 40
#: Bits of the filters of frequent words, pairs and threes (8 MB each), as a power of 2.
FILTER_BITS = 26
#: A word with a greater share of all words is a hot prefix (so there are at most 200).
HOT_SHARE = 1 / 200
#: Bounds of the table of frequent phrases that a join may broadcast.
BROADCAST_ROWS, BROADCAST_BYTES = 100_000, 8 << 20

#: A-Z to a-z, ends of pieces to a line feed, a tab to a space.
FOLD = bytes(10 if c in b".,;:!?\n\x0b\x0c\r" else 32 if c == 9 else c + 32 if 65 <= c <= 90
             else c for c in range(256))


# -- filters ----------------------------------------------------------------
def word_hash(lang: bytes, word: bytes) -> int:
    return xxhash.xxh64_intdigest(word, xxhash.xxh32_intdigest(lang))


def pair_hashes(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Of PAIR_BITS bits, from the words' hashes."""
    h = mix64(a * np.uint64(0x9E3779B97F4A7C15) + mix64(b))
    return h >> np.uint64(64 - PAIR_BITS)


def three_hashes(a: np.ndarray, b: np.ndarray, c: np.ndarray) -> np.ndarray:
    return pair_hashes(pair_hashes(a, b), c)


def joined_pairs(a: np.ndarray, h: np.ndarray, pairs: np.ndarray | None, bits: int) -> np.ndarray:
    """Whether a place and the next hold words, and a pair of the filter."""
    joined = (a[:-1] > 0) & (a[1:] > 0)
    if pairs is not None:
        joined &= has(pairs, pair_hashes(h[:-1], h[1:]) >> np.uint64(PAIR_BITS - bits))
    return joined


def has(bitmap: np.ndarray, at: np.ndarray) -> np.ndarray:
    return (bitmap[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 > 0


def bitmap_of(places: DataFrame, bits: int) -> np.ndarray:
    """The places (``at``, from 0) as a bitmap; no more than its size comes back."""
    at = places.select((F.col("at") + 1).alias("at"))  # Spark's bitmaps count from 1
    parts = at.groupBy(F.bitmap_bucket_number("at").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("bits")).collect()
    out = np.zeros(max(1 << bits >> 3, 1), dtype=np.uint8)
    for r in parts:
        piece = np.frombuffer(r["bits"], dtype=np.uint8)
        at = (r["bucket"] - 1) * len(piece)
        piece = piece[:max(len(out) - at, 0)]
        out[at:at + len(piece)] = piece
    return out


def word_filter(words: DataFrame, bits: int) -> np.ndarray:
    def places(batches):
        for b in batches:
            langs, texts = (b.column(k).cast(pa.binary()).to_pylist() for k in (0, 1))
            at = [word_hash(x, w) >> (64 - bits) for x, w in zip(langs, texts)]
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64())], names=["at"])
    return bitmap_of(words.select("lang", "phrase").mapInArrow(places, "at long"), bits)


# -- the trie ----------------------------------------------------------------
class HatTrie:
    """Counts of windows: tuples of word ids, all of one length, 0 behind their end.
    Nodes are dicts from a word id to a child; leaves are hash tables from the rest
    of a window to its count."""

    class Table(dict):
        """Rest of the window -> count."""

    def __init__(self, burst: int = BURST, root_burst: int = ROOT_BURST, depth: int = 2):
        self.front: Counter = Counter()  # the root before it bursts
        self.root: dict = {}
        self.burst, self.root_burst, self.depth, self.entries = burst, root_burst, depth, 0

    def add(self, windows) -> None:
        self.front.update(windows)
        if len(self.front) > self.root_burst:
            self.burst_root()

    def burst_root(self) -> None:
        for window, n in self.front.items():
            node, rest, level = self.root, window, 1
            while True:
                key, rest = rest[0], rest[1:]
                child = node.get(key)
                if child is None:
                    child = node[key] = HatTrie.Table()
                if type(child) is HatTrie.Table:
                    break
                node, level = child, level + 1
            old = child.get(rest)
            if old is not None:
                child[rest] = old + n
                continue
            child[rest] = n
            self.entries += 1
            if len(child) > self.burst and level < self.depth and len(rest) > 1:
                node[key] = self._burst(child)
        self.front.clear()

    @staticmethod
    def _burst(table: dict) -> dict:
        node: dict = {}
        for rest, n in table.items():
            node.setdefault(rest[0], HatTrie.Table())[rest[1:]] = n
        return node

    @staticmethod
    def tables(prefix: tuple, node):
        """(prefix, table) of all leaves below."""
        if type(node) is HatTrie.Table:
            yield prefix, node
        else:
            for key, child in node.items():
                yield from HatTrie.tables((*prefix, key), child)

    def spill(self, keep: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """Takes the largest subtrees out, whole, until ``keep`` entries are left:
        their windows, one a row, and counts, in order."""
        self.burst_root()
        size = {k: sum(len(t) for _, t in self.tables((), c)) for k, c in self.root.items()}
        windows, counts = [], []
        for first in sorted(size, key=size.__getitem__, reverse=True):
            if self.entries <= keep:
                break
            for prefix, table in self.tables((first,), self.root.pop(first)):
                rest = np.fromiter(chain.from_iterable(table), np.int32).reshape(len(table), -1)
                windows.append(np.hstack([np.tile(np.int32(prefix), (len(table), 1)), rest]))
                counts.append(np.fromiter(table.values(), np.int64, len(table)))
            self.entries -= size[first]
        if not windows:
            return np.zeros((0, 1), np.int32), np.zeros(0, np.int64)
        w, n = np.concatenate(windows), np.concatenate(counts)
        order = np.lexsort(w.T[::-1])
        return w[order], n[order]


def prefix_sums(windows: np.ndarray, counts: np.ndarray, size: int):
    """Of a sorted run: its distinct beginnings of ``size`` words and their counts."""
    if not len(windows):
        return windows[:, :size], counts
    new = np.ones(len(windows), dtype=bool)
    new[1:] = (windows[1:, :size] != windows[:-1, :size]).any(axis=1)
    starts = np.flatnonzero(new)
    sums = np.add.reduceat(counts, starts)
    whole = windows[starts, size - 1] > 0
    return windows[starts[whole], :size], sums[whole]


_RUN = pa.schema([("lang", pa.string()), ("phrase", pa.string()), ("n", pa.int64())])
_PAIR = pa.schema([("h", pa.int64()), ("n", pa.int64())])


def _pieces(batch: pa.RecordBatch):
    """(lang, folded text) as bytes."""
    langs, texts = (batch.column(k).cast(pa.binary()).to_pylist() for k in (0, 1))
    for lang, text in zip(langs, texts):
        if text:
            yield lang, text.translate(FOLD)


class Vocabulary:
    """A task's ids of words (from 1), with their hashes; 0 is no word, and stands
    for those that aren't in the filter."""

    def __init__(self, words: np.ndarray | None, bits: int):
        self.words, self.bits = words, bits
        self.clear()

    def clear(self) -> None:
        self.ids: dict[bytes, dict[bytes, int]] = {}
        self.names, self.langs, self.hashes = [b""], [b""], array("Q", [0])

    def __len__(self) -> int:
        return sum(map(len, self.ids.values()))

    def forget(self) -> None:
        """Words that aren't in the filter; the ids of the others stay."""
        self.ids = {lang: {w: i for w, i in known.items() if i} for lang, known in self.ids.items()}

    def line(self, lang: bytes, text: bytes) -> list:
        """The text's ids, a 0 behind each piece."""
        known = self.ids.setdefault(lang, {})
        pieces = [w for p in text.split(b"\n") if (w := p.split())]
        if new := {w for w in chain.from_iterable(pieces) if w not in known}:
            self._add(lang, known, list(new))
        out: list = []
        for p in pieces:
            out += map(known.__getitem__, p)
            out.append(0)
        return out

    def _add(self, lang: bytes, known: dict, new: list) -> None:
        h = np.array([word_hash(lang, w) for w in new], dtype=np.uint64)
        good = np.ones(len(new), dtype=bool) if self.words is None else has(
            self.words, h >> np.uint64(64 - self.bits))
        for w, x, g in zip(new, h.tolist(), good.tolist()):
            known[w] = len(self.names) if g else 0
            if g:
                self.names.append(w)
                self.langs.append(lang)
                self.hashes.append(x)

    def lines(self, batches, at_once: int):
        """(ids, hashes) of whole texts, about so many words at a time."""
        line: list = []
        for b in batches:
            for lang, text in _pieces(b):
                line += self.line(lang, text)
                if len(line) >= at_once:
                    yield self._arrays(line)
                    line = []
        if line:
            yield self._arrays(line)

    def _arrays(self, line: list) -> tuple[np.ndarray, np.ndarray]:
        a = np.array(line, dtype=np.int64)
        return a, np.array(self.hashes, dtype=np.uint64)[a]


def words_of(batches, most: int = MOST_ENTRIES):
    """Sums of words, a run for whatever the task held at a time."""
    held: dict[bytes, Counter] = {}

    def out():
        for lang, sums in held.items():
            for k in range(0, len(words := sorted(sums)), 20_000):
                part = words[k:k + 20_000]
                yield pa.RecordBatch.from_arrays([
                    pa.array([lang] * len(part), pa.binary()).cast(pa.string()),
                    pa.array(part, pa.binary()).cast(pa.string()),
                    pa.array([sums[w] for w in part], pa.int64())], schema=_RUN)
        held.clear()
    for b in batches:
        for lang, text in _pieces(b):
            held.setdefault(lang, Counter()).update(text.split())
            if sum(map(len, held.values())) > most:
                yield from out()
    yield from out()
    give_back()


def pairs_of(batches, words: np.ndarray | None, bits: int, most: int = PAIRS_AT_ONCE,
             most_words: int = MOST_ENTRIES, pairs: np.ndarray | None = None):
    """Sums of hashes of neighbouring words that are both in the filter; given a filter
    of pairs, of three words whose two pairs are in it."""
    known = Vocabulary(words, bits)
    held: list[tuple[np.ndarray, np.ndarray]] = []

    def merge():
        h, n = (np.concatenate(x) for x in zip(*held))
        order = np.argsort(h)
        h, n = h[order], n[order]
        starts = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
        held[:] = [(h[starts], np.add.reduceat(n, starts))]
        return len(starts)

    def out():
        h, n = held.pop()
        for k in range(0, len(h), 100_000):
            yield pa.RecordBatch.from_arrays([pa.array(h[k:k + 100_000].astype(np.int64)),
                                              pa.array(n[k:k + 100_000])], schema=_PAIR)
    size = 0
    for a, h in known.lines(batches, WORDS_AT_ONCE):
        both = joined_pairs(a, h, pairs, bits)
        if pairs is None:
            found = pair_hashes(h[:-1][both], h[1:][both])
        else:
            at = np.flatnonzero(both[:-1] & both[1:])
            found = three_hashes(h[at], h[at + 1], h[at + 2])
        held.append((found, np.ones(len(found), dtype=np.int64)))
        size += len(found)
        if size > most and (size := merge()) > most // 2:
            yield from out()
            size = 0
        if len(known) > most_words:
            known.clear()
    if size:
        merge()
        yield from out()
    give_back()


def windows_of(batches, least: int, longest: int, pairs: np.ndarray | None, bits: int,
               most: int = MOST_ENTRIES, burst: int = BURST, root_burst: int = ROOT_BURST,
               threes: np.ndarray | None = None, words: np.ndarray | None = None):
    """Runs of phrases of ``least`` to ``longest`` words that, as their neighbouring pairs
    and threes, are in the filters. Rare words end no run: they have no ids in the trie."""
    trie = HatTrie(burst, root_burst)
    known = Vocabulary(words, bits)

    def out(keep: int = 0):
        windows, counts = trie.spill(keep)
        names, langs = pa.array(known.names, pa.binary()), pa.array(known.langs, pa.binary())
        for size in range(least, longest + 1):
            ids, n = prefix_sums(windows, counts, size)
            for k in range(0, len(ids), 20_000):
                part = [pa.array(c) for c in ids[k:k + 20_000].T]
                phrase = pc.binary_join_element_wise(*(names.take(c) for c in part), b" ")
                yield pa.RecordBatch.from_arrays(
                    [langs.take(part[0]).cast(pa.string()), phrase.cast(pa.string()),
                     pa.array(n[k:k + 20_000])], schema=_RUN)
    for a, h in known.lines(batches, WORDS_AT_ONCE):
        joined = joined_pairs(a, h, pairs, bits)
        further = joined[:-1] & joined[1:]  # from a place to the second next
        if threes is not None:
            further[further] = has(threes, three_hashes(*(
                x[further] for x in (h[:-2], h[1:-1], h[2:]))) >> np.uint64(PAIR_BITS - bits))
        further = np.concatenate([further, np.zeros(longest, dtype=bool)])
        a = np.concatenate([a, np.zeros(longest, dtype=np.int64)])
        at = np.flatnonzero(joined)
        columns, on = [a[at], a[at + 1]][:longest], np.ones(len(at), dtype=bool)
        for k in range(2, longest):
            on = on & further[at + k - 2]
            columns.append(np.where(on, a[at + k], 0))
        for k in range(0, len(at), WORDS_AT_ONCE):  # also within a very long text
            trie.add(zip(*(c[k:k + WORDS_AT_ONCE].tolist() for c in columns)))
            if trie.entries > most:
                yield from out(most // 2)
        if len(known) > most:
            known.forget()
            if len(known) > most // 2:
                yield from out()
                known.clear()
    yield from out()
    give_back()


# -- counting on Spark --------------------------------------------------------
def merged(runs: DataFrame, hot: list[tuple[str, str]]) -> DataFrame:
    """Sums of the runs, per prefix partition."""
    first = F.substring_index("phrase", " ", 1)
    prefix = F.xxhash64("lang", first)
    if hot:
        is_hot = F.struct("lang", first.alias("phrase")).isin(
            [F.struct(F.lit(x).alias("lang"), F.lit(w).alias("phrase")) for x, w in hot])
        prefix = F.when(is_hot, F.xxhash64("lang", "phrase")).otherwise(prefix)
    return (runs.withColumn("prefix", prefix).repartition("prefix")
            .groupBy("prefix", "lang", "phrase").agg(F.sum("n").alias("n")).drop("prefix"))


def frequent_phrases(docs: DataFrame, min_count: int = MIN_COUNT, longest: int = MAX_WORDS,
                     bits: int = FILTER_BITS) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, n) of phrases of up to ``longest`` words that occur often
    enough, and (lang, words) with the number of all words."""
    sc = docs.sparkSession.sparkContext
    texts = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), "text")
    schema = "lang string, phrase string, n long"
    words = cut(texts.mapInArrow(words_of, schema).groupBy("lang", "phrase")
                .agg(F.sum("n").alias("n")), "collocation-words")
    sizes = cut(words.groupBy("lang").agg(F.sum("n").alias("words")), "collocation-sizes")
    total = sizes.agg(F.sum("words")).first()[0] or 0
    hot = [(r["lang"], r["phrase"]) for r in words.where(
        F.col("n") > F.lit(total * HOT_SHARE)).collect()]  # at most 1 / HOT_SHARE
    often = words.where(F.col("n") >= min_count)
    if longest < 2:
        return often, sizes
    good = sc.broadcast(word_filter(often, bits))

    def hash_filter(words, pairs):
        found = texts.mapInArrow(lambda batches: pairs_of(
            batches, words and words.value, bits, pairs=pairs and pairs.value), "h long, n long")
        return sc.broadcast(bitmap_of(found.groupBy("h").agg(F.sum("n").alias("n")).where(
            F.col("n") >= min_count).select(F.shiftright("h", PAIR_BITS - bits).alias("at")), bits))
    joined = hash_filter(good, None)
    threes = hash_filter(None, joined) if longest > 2 else None
    parts = texts.select(F.spark_partition_id().alias("p")).agg(F.countDistinct("p")).first()[0]
    wide = texts.coalesce(max(sc.defaultParallelism, parts // PARTS_A_TASK))
    runs = wide.mapInArrow(lambda batches: windows_of(
        batches, 2, longest, joined.value, bits, threes=threes and threes.value,
        words=good.value), schema)
    phrases = cut(merged(runs, hot).where(F.col("n") >= min_count), "collocation-phrases")
    return often.unionByName(phrases), sizes


def _small(df: DataFrame) -> DataFrame:
    """Broadcast where the counted rows and bytes allow it."""
    got = df.agg(F.count("*").alias("n"), F.sum(F.octet_length("phrase") + F.octet_length("lang")
                                                + 48).alias("bytes")).first()
    fits = got["n"] <= BROADCAST_ROWS and (got["bytes"] or 0) <= BROADCAST_BYTES
    return F.broadcast(df) if fits else df


def cut_score(a: str, n: str, left: str, right: str) -> Column:
    """floor(1000 a n / (l r)), exact."""
    return F.expr(f"(cast(1000 * {a} as decimal(19,0)) * cast({n} as decimal(18,0))) div "
                  f"(cast({left} as decimal(19,0)) * cast({right} as decimal(18,0)))")


def scored(phrases: DataFrame, sizes: DataFrame) -> DataFrame:
    """lang, phrase, a, l, r, n, score of the candidates that no longer one covers."""
    table = _small(phrases)
    several = phrases.where(F.contains("phrase", F.lit(" "))).select(
        "lang", "phrase", F.split("phrase", " ").alias("w"), F.col("n").alias("a"))
    covers = (several.where(F.size("w") > 2).select("lang", "a", F.explode(F.array(
        F.expr("array_join(slice(w, 1, size(w) - 1), ' ')"),
        F.expr("array_join(slice(w, 2, size(w) - 1), ' ')"))).alias("phrase"))
        .groupBy("lang", "phrase").agg(F.max("a").alias("longer")))
    left = cut(several.join(covers, ["lang", "phrase"], "left")
               .where("longer is null or 100 * longer < 100 * a"), "collocation-candidates")
    cuts = left.select("lang", "phrase", "a", F.explode(F.expr(
        "transform(sequence(1, size(w) - 1), k -> struct(k as k, array_join(slice(w, 1, k), ' ') as "
        "first, array_join(slice(w, k + 1, size(w) - k), ' ') as rest))")).alias("c")).select(
        "lang", "phrase", "a", "c.*")
    for part, name in (("first", "l"), ("rest", "r")):
        cuts = cuts.join(table.select("lang", F.col("phrase").alias(part), F.col("n").alias(name)),
                         ["lang", part])
    # languages may be as many as rows: broadcast only if counted few
    few = sizes.select("lang", F.col("words").alias("n"))
    few = F.broadcast(few) if few.count() <= 10_000 else few
    each = cuts.join(few, "lang").select(
        "lang", "phrase", "a", "n", F.struct(cut_score("a", "n", "l", "r").alias("score"), "k", "l",
                                             "r").alias("cut"))
    return each.groupBy("lang", "phrase").agg(
        F.first("a").alias("a"), F.first("n").alias("n"), F.min("cut").alias("cut")).select(
        "lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")


def collocations(docs: DataFrame, min_count: int = MIN_COUNT, longest: int = MAX_WORDS,
                 top: int = TOP) -> DataFrame:
    """The digest: lang, rank, phrase, a, l, r, n, score of the first ``top``
    phrases of each language."""
    ranked = cut(scored(*frequent_phrases(docs, min_count, longest)), "collocation-scores")
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    parts = max(1, math.isqrt(ranked.count() // max(top, 1)))
    first = ranked.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(parts))).withColumn(
        "rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))).where(
        F.col("rank") <= top)
    return first.withColumn(
        "rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(
        F.col("rank") <= top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
