"""Operators with keyed state over streams (``transformWithState``; RocksDB state).

``running_total``: rows per key and tumbling window, each with the key's total so far
(AG-14 / ST-3). The counts are the ordinary windowed aggregate, partial before its
shuffle, so a hot key reaches the state as one row a window; the state is one number a
key. A window comes out once, when the watermark has passed its end; windows of a key
come in order, so the total of closed windows equals the batch one.

``live_sessions``: each sample of a stream with the session that is active then, the
sessions being a stream too (JN-7). Samples and sessions meet per (key, time bucket), so
a hot key is many groups. A group waits for the watermark, the lesser of the two
streams', to pass its bucket: a timer then merges both in time order and frees the
state. Keys are dealt over ``slots`` by hash and a group holds the keys of one slot, as
calls, timers and state cost more a group than a row; more keys ask for more slots. The
state of a group is what one bucket holds of its slot's keys.

Defined results: rows without a key, time, id or (sessions) end are left out, as are rows
later than the watermark. Repeated samples are each given their session. Of sessions
that start together the greatest id counts; a session that ends before it starts holds
no sample. A session ends after ``longest`` at the latest: that bounds its copies.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from .ingest import rate_per_window, run_available

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
LONG = T.LongType()


def run_stateful(df: DataFrame, sink_path: str, checkpoint: str) -> None:
    """``run_available`` with the state store that keyed state needs; the session's own
    setting is back afterwards."""
    conf = df.sparkSession.conf
    before = conf.get(PROVIDER, None)
    conf.set(PROVIDER, ROCKSDB)
    try:
        run_available(df, sink_path, checkpoint)
    finally:
        if before is None:
            conf.unset(PROVIDER)
        else:
            conf.set(PROVIDER, before)


def _totals() -> StatefulProcessor:
    # a class of this call travels to the workers whole
    class Total(StatefulProcessor):
        """(key, windows closed in this batch) -> the same with the total so far."""

        def init(self, handle: StatefulProcessorHandle) -> None:
            self.total = handle.getValueState("total", T.StructType([T.StructField("n", LONG)]))

        def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
            w = pd.concat(list(rows)).sort_values("window_start_ms", ignore_index=True)
            so_far = self.total.get()[0] if self.total.exists() else 0
            w["running_total"] = w["n_rows"].cumsum() + so_far
            self.total.update((int(w["running_total"].iloc[-1]),))
            yield w[["k", "window_start_ms", "n_rows", "running_total"]]

        def close(self) -> None:
            pass

    return Total()


def running_total(stream: DataFrame, key: str, ts: str, window: str,
                  watermark: str) -> DataFrame:
    """(key, window_start_ms, n_rows, running_total) of closed windows."""
    d = stream.where(F.col(key).isNotNull() & F.col(ts).isNotNull())
    closed = rate_per_window(d, key, ts, window, watermark).select(
        F.col(key).alias("k"), F.unix_millis("window_start").alias("window_start_ms"), "n_rows")
    out = T.StructType([closed.schema["k"], T.StructField("window_start_ms", LONG),
                        T.StructField("n_rows", LONG), T.StructField("running_total", LONG)])
    return closed.groupBy("k").transformWithStateInPandas(
        _totals(), outputStructType=out, outputMode="Append",
        timeMode="None").withColumnRenamed("k", key)


def _meetings(key_type: T.DataType, sample_type: T.DataType, session_type: T.DataType,
              width_ms: int) -> StatefulProcessor:
    class Sessions(StatefulProcessor):
        """(slot, bucket): holds its keys' samples and sessions until the bucket's timer."""

        def init(self, handle: StatefulProcessorHandle) -> None:
            self.handle = handle
            k, ms = T.StructField("k", key_type), T.StructField("ms", LONG)
            self.samples = handle.getListState("samples", T.StructType(
                [k, ms, T.StructField("id", sample_type)]))
            self.sessions = handle.getListState("sessions", T.StructType(
                [k, ms, T.StructField("id", session_type), T.StructField("end", LONG)]))

        def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
            for p in rows:
                held = p["held"].astype(bool)
                x = p[~held]
                if len(x):
                    self.samples.appendList(list(zip(x["k"].tolist(), x["ms"].tolist(),
                                                     x["sample"].tolist())))
                x = p[held]
                if len(x):
                    self.sessions.appendList(list(zip(x["k"].tolist(), x["ms"].tolist(),
                                                      x["session"].tolist(), x["till"].tolist())))
            # the same timer however often it is set
            self.handle.registerTimer((int(key[1]) + 1) * width_ms)
            return iter(())

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
            sessions = sorted(self.sessions.get()) if self.sessions.exists() else []
            samples = sorted(self.samples.get()) if self.samples.exists() else []
            found, at, last = [], 0, None  # ``last``: of this key, started at or before ``ms``
            for k, ms, sample in samples:
                if last is not None and last[0] != k:
                    last = None
                while at < len(sessions) and sessions[at][:2] <= (k, ms):
                    last = sessions[at] if sessions[at][0] == k else None
                    at += 1
                if last is not None and ms < last[3]:
                    found.append((k, last[2], sample))
            self.sessions.clear()
            self.samples.clear()
            if found:
                yield pd.DataFrame(found, columns=["k", "session", "sample"])

        def close(self) -> None:
            pass

    return Sessions()


def live_sessions(samples: DataFrame, sessions: DataFrame, key: str, ts: str, sample: str,
                  start: str, end: str, session: str, watermark: str, longest_ms: int,
                  width_ms: int, slots: int = 512) -> DataFrame:
    """(key, session, sample); ``ts``, ``start`` and ``end`` are timestamps, ids are
    integers or strings."""
    kinds = sessions.schema[session].dataType, samples.schema[sample].dataType

    def no(t: T.DataType):  # not null: a numeric column with nulls would come as floats
        return F.lit("" if isinstance(t, T.StringType) else 0).cast(t)
    ms = F.unix_millis("at")
    bucket = F.floor(ms / F.lit(width_ms)).cast("bigint")
    a = (samples.select(F.col(key).alias("k"), F.col(ts).alias("at"), F.lit(False).alias("held"),
                        no(kinds[0]).alias("session"), F.col(sample).alias("sample"),
                        F.lit(0).cast("bigint").alias("till"))
         .dropna().withWatermark("at", watermark).withColumn("bucket", bucket))
    last = F.least(F.unix_millis(end), F.unix_millis(start) + F.lit(longest_ms))
    b = (sessions.where(F.col(end).isNotNull())
         .select(F.col(key).alias("k"), F.col(start).alias("at"), F.lit(True).alias("held"),
                 F.col(session).alias("session"), no(kinds[1]).alias("sample"),
                 last.alias("till"))
         .dropna().withWatermark("at", watermark))
    # to every bucket in which a session that started before it could still be active: a
    # later, shorter session hides an earlier one there too
    b = b.withColumn("bucket", F.explode(F.sequence(
        bucket, F.floor((ms + F.lit(longest_ms)) / F.lit(width_ms)).cast("bigint"))))
    out = T.StructType([T.StructField("k", samples.schema[key].dataType),
                        T.StructField("session", kinds[0]), T.StructField("sample", kinds[1])])
    slot = F.pmod(F.xxhash64("k"), F.lit(slots))
    return (a.unionByName(b).withColumns({"ms": ms, "slot": slot}).groupBy("slot", "bucket")
            .transformWithStateInPandas(
                _meetings(samples.schema[key].dataType, kinds[1], kinds[0], width_ms), outputStructType=out,
                outputMode="Append", timeMode="EventTime").toDF(key, session, sample))
