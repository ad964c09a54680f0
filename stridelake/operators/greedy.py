"""Task-side helpers of greedy spacing over sorted Arrow batches.

Rows arrive sorted by a group (hash column ``_g``), then by time. A group may
span batches; only the current one is held.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa


def whole_groups(batches) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables of complete groups, with the groups' boundaries."""
    held: list[pa.RecordBatch] = []
    for b in batches:
        if not b.num_rows:
            continue
        g = b.column("_g").to_numpy()
        other = np.flatnonzero(g != g[-1])
        at = int(other[-1]) + 1 if len(other) else 0  # where the last group begins
        if at == 0 and (not held or held[0].column("_g")[0].as_py() == g[0]):
            held.append(b)  # still the same group
            continue
        yield _bounded([*held, b.slice(0, at)])
        held = [b.slice(at)]
    if held:
        yield _bounded(held)


def _bounded(parts: list[pa.RecordBatch]) -> tuple[pa.Table, np.ndarray]:
    t = pa.Table.from_batches(parts).combine_chunks()
    g = t.column("_g").to_numpy()
    return t, np.concatenate([[0], np.flatnonzero(g[1:] != g[:-1]) + 1, [len(g)]])


def bucket_ways(batches, keys, ts, gap):
    """For each bucket: times of entry and the exit each leads to. Entering
    with a threshold means at the first row at or after it, so of entries with
    one exit the last stands for all."""
    for t, cuts in whole_groups(batches):
        time = t.column(ts).to_numpy()
        entries, exits = [], []
        for a, b in zip(cuts[:-1], cuts[1:]):
            x = time[a:b]
            n = len(x)
            after = np.searchsorted(x, x + gap).tolist()
            end = list(range(n))
            for i in range(n - 1, -1, -1):
                if after[i] < n:
                    end[i] = end[after[i]]
            end = np.array(end)
            # entries lie before the first row a gap after the bucket's first
            some = np.arange(min(n, after[0] + 1))
            last = np.append(end[some[1:]] != end[some[:-1]], True)
            entries.append(x[some[last]])
            exits.append(x[end[some[last]]])
        head = t.take(pa.array(cuts[:-1]))
        kind = pa.list_(t.schema.field(ts).type)
        out = [head.column(k).combine_chunks() for k in [*keys, "_b"]]
        yield pa.RecordBatch.from_arrays(
            [*out, pa.array(entries, kind), pa.array(exits, kind)],
            names=[*keys, "_b", "entry", "exit"])


def _step(entry, leave, reach, last, gap):
    """Thresholds ``reach`` and last kept rows after one more bucket; a threshold
    beyond the bucket's entries meets no row there."""
    at = np.searchsorted(entry, reach)
    meets = at < len(entry)
    out = leave[np.minimum(at, len(entry) - 1)]
    return np.where(meets, out + gap, reach), np.where(meets, out, last)


def compose(batches, keys, gap):
    """The ways of a run of buckets (column ``_p``), from those of its buckets: where
    the walk leaves the run for every place where it may enter. That is in its first
    bucket, as a threshold lies less than a gap behind the run's start, or at the
    first row of the second, behind all rows of the first."""
    for t, cuts in whole_groups(batches):
        entry, leave = t.column("entry").combine_chunks(), t.column("exit").combine_chunks()
        entries, exits = [], []
        for a, b in zip(cuts[:-1], cuts[1:]):
            ways = [(entry[k].values.to_numpy(), leave[k].values.to_numpy())
                    for k in range(int(a), int(b))]
            places = ways[0][0] if len(ways) < 2 else np.append(ways[0][0], ways[1][0][0])
            reach, last = places, places
            for e, x in ways:
                reach, last = _step(e, x, reach, last, gap)
            stands = np.append(last[1:] != last[:-1], True)
            entries.append(places[stands])
            exits.append(last[stands])
        head = t.take(pa.array(cuts[:-1]))
        kind = entry.type
        yield pa.RecordBatch.from_arrays(
            [*(head.column(k).combine_chunks() for k in [*keys, "_p"]), pa.array(entries, kind),
             pa.array(exits, kind)], names=[*keys, "_b", "entry", "exit"])


def follow(batches, keys, gap):
    """The last row kept before each bucket of a run (``_in``: the one before the
    run's first bucket); null for none."""
    for t, cuts in whole_groups(batches):
        entry, leave = t.column("entry").combine_chunks(), t.column("exit").combine_chunks()
        before = t.column("_in")
        out = []
        for a, b in zip(cuts[:-1], cuts[1:]):
            last = before[int(a)].as_py()
            for k in range(int(a), int(b)):
                out.append(last)
                e = entry[k].values.to_numpy()
                at = 0 if last is None else int(np.searchsorted(e, last + gap))
                if at < len(e):
                    last = leave[k].values[at].as_py()
        yield pa.RecordBatch.from_arrays(
            [*(t.column(k).combine_chunks() for k in [*keys, "_b"]),
             pa.array(out, entry.type.value_type)], names=[*keys, "_b", "_last"])


def kept_rows(batches, columns, ts, gap):
    """The rows that the walk keeps."""
    for t, cuts in whole_groups(batches):
        time, before = t.column(ts).to_numpy(), t.column("_last")
        keep = []
        for a, b in zip(cuts[:-1], cuts[1:]):
            x = time[a:b]
            last = before[int(a)].as_py()
            i = 0 if last is None else int(np.searchsorted(x, last + gap))
            while i < b - a:
                keep.append(a + i)
                i += int(np.searchsorted(x[i:], x[i] + gap))
        yield from t.select(columns).take(pa.array(keep, pa.int64())).combine_chunks().to_batches()
