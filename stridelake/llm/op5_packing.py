"""Hierarchical multi-length packing of documents into sequences.

Each task packs its own documents; nothing is shuffled or collected. A
document gives its full windows first; what is left of it is routed to the
smallest context-size tier (window, window/2, ... down to ``least``) that holds
it. The tiers are packed from the longest down, each into sequences of its own
size: a sequence opens with the longest remainder of its tier, and its gap is
filled from shorter tiers (in the least tier from itself), longest fitting
first. Where nothing fits, the shortest remainder is cut to the gap and its rest
is routed anew, so sequences are full. What can't fill a sequence of its tier
waits for the next round; the last tokens of a task become sequences of
power-of-two sizes, which need no padding. Step groups of ``group`` sequences of
any tiers are balanced by attention cost (the sum of squared piece lengths),
dealt in snake order within a round.

A round holds about ``round_tokens`` tokens, so a task's memory is bounded by
that and its longest document.

Defined results: a null text is an empty one and so only the end id; a null
doc_id stays null; repeated rows are packed each. An empty table gives no
piece. Extra columns of the input are ignored. A lost task is redone with the
same result: ids depend on the partition number and the order within it.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from .common import byte_bpe, give_back, vocabulary

WINDOW = 2048
#: The smallest tier; shorter remainders belong to it.
LEAST = 128
END_ID = 1
GROUP = 8
ROUND_TOKENS = 4_000_000
#: Sequence and group numbers start at the partition's number times this.
SPAN = 1 << 40

SCHEMA = ("doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
          "sequence_id bigint, offset bigint, tier int, step_group bigint")


class Remainders:
    """What is left of documents, as (document, first token) by exact length."""

    def __init__(self):
        self.by: dict[int, list[tuple[int, int]]] = {}
        self.lengths: list[int] = []  # sorted

    def add(self, n: int, item: tuple[int, int]) -> None:
        if n not in self.by:
            self.by[n] = []
            insort(self.lengths, n)
        self.by[n].append(item)

    def take(self, most: int) -> tuple[int, tuple[int, int]] | None:
        """The longest remainder of at most ``most`` tokens."""
        at = bisect_left(self.lengths, most + 1) - 1
        if at < 0:
            return None
        n = self.lengths[at]
        item = self.by[n].pop()
        if not self.by[n]:
            del self.by[n], self.lengths[at]
        return n, item

    def tokens(self) -> int:
        return sum(n * len(x) for n, x in self.by.items())


def tier(n: int) -> int:
    """The smallest power of two of at least ``n``."""
    return 1 << max(n - 1, 0).bit_length()


def route(n: int, window: int, least: int) -> int:
    """The smallest tier (window, window/2, ... down to ``least``) that holds
    ``n`` tokens."""
    size = window
    while size % 2 == 0 and size // 2 >= max(n, least):
        size //= 2
    return size


def pack_round(lengths: list[int], window: int, last: bool, least: int | None = None):
    """Sequences (lists of (document, start, length)) of documents with these
    lengths, and the rest: (document, start, length) that fill no sequence of
    their tier, unless ``last``: then the rest is cut to sequences of powers of
    two. Without ``least``, the window is the only tier."""
    least = window if least is None else min(least, window)
    full, rest = [], Remainders()
    for d, n in enumerate(lengths):
        whole = n - n % window
        full += [[(d, s, window)] for s in range(0, whole, window)]
        if n > whole:
            rest.add(n - whole, (d, whole))
    total = rest.tokens()
    while total:
        size = route(rest.lengths[-1], window, least)  # longer tiers are done
        if total < size:
            if not last:
                break
            size = 1 << (total.bit_length() - 1)
        total -= size
        seq, gap = [], size
        while gap:
            got = rest.take(gap)
            if got is None:  # all are longer: cut the shortest
                n, (d, s) = rest.take(rest.lengths[0])
                rest.add(n - gap, (d, s + gap))
                got = gap, (d, s)
            n, (d, s) = got
            seq.append((d, s, n))
            gap -= n
        full.append(seq)
    return full, [(d, s, n) for n, x in rest.by.items() for d, s in x]


def step_groups(seqs: list[list[tuple[int, int, int]]], group: int) -> list[int]:
    """A group for each sequence: groups of ``group``, of like cost."""
    cost = [sum(n * n for _, _, n in s) for s in seqs]
    order = sorted(range(len(seqs)), key=lambda i: -cost[i])
    many = -(-len(seqs) // group)
    out = [0] * len(seqs)
    for k, i in enumerate(order):
        lap, at = divmod(k, many)
        out[i] = at if lap % 2 == 0 else many - 1 - at
    return out


def pack(docs: DataFrame, window: int = WINDOW, end_id: int = END_ID,
         vocab: str | None = None, group: int = GROUP,
         round_tokens: int = ROUND_TOKENS, least: int = LEAST) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset, tier (size of its sequence), step_group."""
    path = vocab or vocabulary("byte_bpe_50k.json")
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string
    kind = to_arrow_schema(_parse_datatype_string(SCHEMA))

    def run(batches):
        encode = byte_bpe(path)
        base = TaskContext.get().partitionId() * SPAN
        made, groups = 0, 0
        # documents of the round: id, ids from `first` on, first, all tokens
        held: list[tuple[object, np.ndarray, int, int]] = []
        tokens = 0

        def flush(last: bool):
            nonlocal made, groups, held, tokens
            seqs, rest = pack_round([len(x[1]) for x in held], window, last, least)
            of = step_groups(seqs, group)
            out = []
            for k, seq in enumerate(seqs):
                at, size = 0, sum(n for _, _, n in seq)
                for d, s, n in seq:
                    who, ids, first, doc_tokens = held[d]
                    out.append((who, first + s, n, zlib.crc32(ids[s:s + n]), doc_tokens,
                                base + made + k, at, tier(size), base + groups + of[k]))
                    at += n
            made += len(seqs)
            groups += -(-len(seqs) // group)
            held = [(held[d][0], held[d][1][s:s + n].copy(), held[d][2] + s, held[d][3])
                    for d, s, n in rest]
            tokens = sum(len(x[1]) for x in held)
            for a in range(0, len(out), 50_000):
                cols = zip(*out[a:a + 50_000])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, type=f.type) for c, f in zip(cols, kind)], schema=kind)

        for b in batches:
            for who, text in zip(b.column("doc_id").to_pylist(), b.column("text")):
                ids = np.append(encode(text.as_py() or ""), end_id).astype("<u4")
                held.append((who, ids, 0, len(ids)))
                tokens += len(ids)
                if tokens >= round_tokens:
                    yield from flush(False)
        yield from flush(True)
        give_back()
    return docs.select("doc_id", "text").mapInArrow(run, SCHEMA)
