"""Relational operators the reference needs beyond plain joins.

active_session  the session of the same key that a sample falls in (JN-7), by
                one ordered scan over sessions and samples
new_keys        rows whose key is not yet in a target (JN-1)
pending         source keys minus done keys with a reason (SET-1/2, D26)
global_rank     1..n ranking over the whole table without a single-task
                window: range-partition, rank inside partitions, add the
                row counts of the preceding partitions
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut, per_key
from .sequence import scan


def active_session(samples: DataFrame, sessions: DataFrame, keys: Sequence[str], ts: str,
                   start: str, end: str, width: int, session: str,
                   tiebreak: Sequence[str] = ()) -> DataFrame:
    """The samples that fall in a session of their key, each with the one
    session active then: the last that started at or before it (of equal
    starts the greatest ``session``), if that has not ended (start <= ts <
    end).

    Sessions are merged into the sample stream and one ordered scan carries
    the last start forward, so the cost is linear in samples + sessions, and
    overlapping sessions give no sample twice.
    """
    keys = list(keys)
    kind = {f.name: f.dataType for f in sessions.schema.fields}
    now = F.struct(*[F.col(c).alias(c) for c in (session, start, end)])
    a = sessions.select(*keys, F.col(start).alias(ts), F.lit(0).alias("_k"),
                        F.col(session).alias("_s"), now.alias("_now"),
                        *[F.lit(None).cast(f.dataType).alias(f.name) for f in samples.schema.fields
                          if f.name not in (*keys, ts)])
    # a session sorts before the samples of its first instant
    b = samples.withColumns({"_k": F.lit(1), "_s": F.lit(None).cast(kind[session]),
                             "_now": F.lit(None).cast(a.schema["_now"].dataType)})
    s = scan(a.unionByName(b), keys, ts, width, tiebreak=["_k", "_s", *tiebreak], ffill=["_now"])
    return (s.where((F.col("_k") == 1) & (F.col(ts) < F.col("ffill__now")[end]))
            .select(*samples.columns, *[F.col("ffill__now")[c].alias(c)
                                        for c in (session, start, end)]))


def new_keys(df: DataFrame, done: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``df`` whose key is not in ``done`` (left anti join)."""
    return df.join(per_key(done.select(*keys).distinct(), "done"), list(keys), "left_anti")


def pending(sources: dict[str, DataFrame], done: DataFrame, key: str,
            primary: str) -> DataFrame:
    """Keys present in any source and absent from ``done``.

    ``reason`` is ``not_processed`` when the key is in the primary source
    (its chain can run) and ``no_<primary>`` when only other sources have it
    (it will stay pending until the primary source delivers).
    """
    parts = [df.select(F.col(key).alias(key), F.lit(name == primary).alias("_p"))
             for name, df in sources.items()]
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    u = u.groupBy(key).agg(F.max("_p").alias("_p"))
    out = u.join(per_key(done.select(key).distinct(), "done"), key, "left_anti")
    return out.select(key, F.when(F.col("_p"), F.lit("not_processed"))
                      .otherwise(F.lit(f"no_{primary}")).alias("reason"))


def row_counts(sources: dict[str, DataFrame], key: str) -> DataFrame:
    """Rows of each key in several tables, one column each (AG-15); 0 where a
    table lacks the key. One aggregate over all, no join."""
    parts = [df.groupBy(key).agg(F.count(F.lit(1)).alias(name)) for name, df in sources.items()]
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p, allowMissingColumns=True)
    return u.groupBy(key).agg(*(F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in sources))


def global_rank(df: DataFrame, order: Sequence[Column], out: str = "rank",
                partitions: int | None = None) -> DataFrame:
    """Dense 1..n row number in ``order`` (make it total with a tie-break)."""
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # range partitioning samples its input first: from a written copy, not by
    # running the plan twice
    d = cut(df).repartitionByRange(n, *order).withColumn("_p", F.spark_partition_id())
    d = cut(d)  # one fixed partitioning for both the counts and the ranks
    counts = d.groupBy("_p").agg(F.count(F.lit(1)).alias("_n"))
    # one row per partition: a proven, small broadcast
    offs = counts.select("_p", F.coalesce(F.sum("_n").over(
        Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_off"))
    w = Window.partitionBy("_p").orderBy(*order)
    r = d.withColumn("_rn", F.row_number().over(w))
    r = r.join(F.broadcast(offs), "_p")
    return r.withColumn(out, (F.col("_rn") + F.col("_off")).cast("long")).drop("_p", "_rn", "_off")
