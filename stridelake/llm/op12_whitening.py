"""Embedding whitening: pivoted Cholesky of the centred scatter, then one-sided
Jacobi on its triangular factor.

An entry c becomes the long x = floor(64 c) + 1000000. Spark sums x exactly (n, S),
then each task centres its rows (x - S/n) and multiplies them block by block; the
upper triangle of its scatter leaves as d (d + 1) / 2 rows, which Spark sums. The
driver gets one d x d matrix, whatever the number of rows, factors it as
P' L L' P with the greatest remaining diagonal as pivot (which shows the rank),
and rotates pairs of columns of L until all are orthogonal: squared column norms
are the eigenvalues, normalised columns the components. The scatter is written
before it is read, so one set of components serves all rows, also where tasks
are run again. The whitened rows' own covariance is measured in one more pass.

Defined results: a vector that is null, empty, or has a null or non-finite entry is
dropped, so is one with an entry whose x leaves +-2^62, and one of another length
than most have (of equally frequent lengths the greatest counts). Components whose
eigenvalue is zero by rank are left out: vectors that are all equal give no row. Of
equal eigenvalues any orthonormal basis. Repeated rows count and come out each,
rows without id keep none. ``deviation`` is null where it passes 64 bits. Extra
columns are ignored. An empty table gives no row.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import cut

SCALE, SHIFT = 64, 1_000_000
COMPONENTS = 32
#: Rows that are centred and multiplied at once.
BLOCK_ROWS = 2048
#: Remaining diagonal over the trace, a dimension, that counts as zero.
RANK_TOLERANCE = 1e-14
_LIMIT = float(1 << 62)


def embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/embeddings.parquet")


def usable(table: DataFrame, vector: str = "embedding") -> DataFrame:
    """vec_id and ``x`` (array of long) of the rows to fit and to whiten."""
    c = F.col(vector)

    def fits(e):
        return F.abs(e.cast("double") * SCALE) < _LIMIT
    good = (F.size(c) > 0) & F.forall(c, lambda e: F.coalesce(fits(e), F.lit(False)))
    # Spark may work x out before it filters: no entry may overflow
    rows = table.where(F.coalesce(good, F.lit(False))).select("vec_id", F.transform(
        c, lambda e: F.floor(F.when(fits(e), e.cast("double") * SCALE)) + SHIFT).alias("x"))
    sizes = rows.groupBy(F.size("x").alias("d")).count()
    most = sizes.agg(F.max(F.struct("count", "d")).alias("m")).first()["m"]
    return rows.where(F.size("x") == F.lit(most["d"])) if most else rows


def matrix(col: pa.Array, d: int) -> np.ndarray:
    """Rows of an Arrow list column of d longs each."""
    return np.asarray(col.flatten().to_numpy(zero_copy_only=False)).reshape(-1, d)


@dataclass(frozen=True)
class Fit:
    """n, exact sums, scatter of the centred rows and mean of what was left."""
    n: int
    sums: list[int]
    low: int
    high: int
    scatter: np.ndarray
    rest: np.ndarray


def centred(x: np.ndarray, n: int, sums: list[int], narrow: bool) -> np.ndarray:
    """x - S/n in double precision, from the exact n x - S."""
    if narrow:
        return (n * x - np.array(sums, dtype=np.int64)) / n
    return ((n * x.astype(object) - np.array(sums, dtype=object)) / n).astype(np.float64)


def is_narrow(n: int, sums: list[int], low: int, high: int) -> bool:
    """n x - S fits 64 bits for every entry."""
    return n * max(abs(low), abs(high)) + max(map(abs, sums)) < 1 << 62


def _scatter(rows: DataFrame, make, d: int, name: str) -> tuple[np.ndarray, np.ndarray]:
    """Sums over all rows of y and of y'y, where ``make`` maps a block of x to y
    with d columns: summed in tasks, then by Spark; d (d + 3) / 2 numbers come back."""
    up = np.triu_indices(d)
    schema = pa.schema([("i", pa.int32()), ("j", pa.int32()), ("v", pa.float64())])

    def run(batches):
        total, first, some = np.zeros((d, d)), np.zeros(d), False
        for b in batches:
            for k in range(0, b.num_rows, BLOCK_ROWS):
                y = make(b.column(0).slice(k, BLOCK_ROWS))
                total += y.T @ y
                first += y.sum(axis=0)
                some = True
        if some:
            yield pa.RecordBatch.from_arrays([
                pa.array(np.concatenate([up[0], np.full(d, -1)]), pa.int32()),
                pa.array(np.concatenate([up[1], np.arange(d)]), pa.int32()),
                pa.array(np.concatenate([total[up], first]))], schema=schema)
    parts = cut(rows.select("x").mapInArrow(run, "i int, j int, v double"), name)
    got = parts.groupBy("i", "j").agg(F.sum("v").alias("v")).toPandas()
    out, first = np.zeros((d, d)), np.zeros(d)
    pairs = got[got.i >= 0]
    out[pairs.i, pairs.j] = out[pairs.j, pairs.i] = pairs.v
    singles = got[got.i < 0]
    first[singles.j] = singles.v
    return out, first


def fit(rows: DataFrame) -> Fit | None:
    """Statistics of ``usable`` rows; None where there are none."""
    head = rows.select(F.size("x").alias("d")).first()
    if head is None:
        return None
    d = head["d"]
    # one row a dimension; decimals, so that no sum passes its type
    got = rows.select(F.posexplode("x").alias("i", "e")).groupBy("i").agg(
        F.count("e").alias("n"), F.sum(F.col("e").cast("decimal(20,0)")).alias("s"),
        F.min("e").alias("low"), F.max("e").alias("high")).orderBy("i").collect()
    n, sums = got[0]["n"], [int(r["s"]) for r in got]
    low, high = min(r["low"] for r in got), max(r["high"] for r in got)
    narrow = is_narrow(n, sums, low, high)
    scatter, first = _scatter(
        rows, lambda col: centred(matrix(col, d), n, sums, narrow), d, "whitening-scatter")
    return Fit(n, sums, low, high, scatter, first / n)


def pivoted_cholesky(a: np.ndarray, tolerance: float = RANK_TOLERANCE):
    """L (d x rank, rows in pivot order, lower trapezoidal) and the order, so that
    L L' is ``a`` with rows and columns in that order."""
    d = len(a)
    order = np.arange(d)
    low = np.zeros((d, d))
    left = np.diag(a).astype(np.float64).copy()  # remaining diagonal, in pivot order
    least = tolerance * d * max(left.sum(), 0.0)
    for k in range(d):
        p = k + int(np.argmax(left[k:]))
        if left[p] <= least:
            return low[:, :k], order
        for x in (order, left):
            x[[k, p]] = x[[p, k]]
        low[[k, p], :k] = low[[p, k], :k]
        low[k, k] = np.sqrt(left[k])
        below = a[order[k + 1:], order[k]] - low[k + 1:, :k] @ low[k, :k]
        low[k + 1:, k] = below / low[k, k]
        left[k + 1:] -= low[k + 1:, k] ** 2
    return low, order


def round_robin(r: int):
    """Rounds of disjoint pairs that cover every pair of 0..r-1 once."""
    ring = list(range(r + r % 2))
    for _ in range(len(ring) - 1):
        pairs = [(ring[k], ring[-1 - k]) for k in range(len(ring) // 2)]
        pairs = [(min(p), max(p)) for p in pairs if max(p) < r]
        yield np.array([p[0] for p in pairs]), np.array([p[1] for p in pairs])
        ring = [ring[0], ring[-1], *ring[1:-1]]


def one_sided_jacobi(low: np.ndarray, sweeps: int = 60) -> np.ndarray:
    """The columns rotated in pairs until all are orthogonal."""
    g = low.copy()
    rounds = list(round_robin(g.shape[1])) if g.shape[1] > 1 else []
    for _ in range(sweeps):
        worst = 0.0
        for p, q in rounds:
            a, b = g[:, p], g[:, q]
            aa, bb, ab = (a * a).sum(0), (b * b).sum(0), (a * b).sum(0)
            size = np.sqrt(aa * bb)
            off = np.divide(np.abs(ab), size, out=np.zeros_like(ab), where=size > 0)
            worst = max(worst, float(off.max()))
            turn = off > 1e-16
            zeta = (bb - aa) / np.where(turn, 2 * ab, 1.0)
            t = np.where(zeta >= 0, 1.0, -1.0) / (np.abs(zeta) + np.hypot(1.0, zeta))
            t = np.where(turn, t, 0.0)
            c = 1 / np.hypot(1.0, t)
            s = c * t
            g[:, p], g[:, q] = c * a - s * b, s * a + c * b
        if worst < 4e-16 * len(g):
            break
    return g


def components(scatter: np.ndarray, n: int, most: int = COMPONENTS):
    """Eigenvalues (falling), unit eigenvectors as columns, and the share of the
    trace that each explains."""
    v = scatter / n
    low, order = pivoted_cholesky(v)
    g = one_sided_jacobi(low)
    norms = np.sqrt((g * g).sum(0))
    rank = np.argsort(-norms, kind="stable")[:most]
    vectors = np.zeros((len(v), len(rank)))
    vectors[order] = g[:, rank] / norms[rank]
    values = norms[rank] ** 2
    return values, vectors, values / max(np.trace(v), np.finfo(float).tiny)


def whiten(rows: DataFrame, stats: Fit, most: int = COMPONENTS) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error of
    each of ``usable`` rows and component."""
    n, sums, d = stats.n, stats.sums, len(stats.sums)
    narrow = is_narrow(n, sums, stats.low, stats.high)
    values, vectors, share = components(stats.scatter, n, most)
    k = len(values)
    turned = vectors / np.sqrt(values) if k else vectors
    error = 0.0
    if k:
        mean = stats.rest @ turned  # of the whitened rows
        own, _ = _scatter(rows, lambda col: centred(matrix(col, d), n, sums, narrow) @ turned - mean,
                          k, "whitening-check")
        error = float(np.abs(own / n - np.eye(k)).max())
    reach = n * (stats.high - stats.low)  # no deviation of an entry is greater
    small = narrow and d * reach * reach < 1 << 62
    schema = pa.schema([("vec_id", pa.int64()), ("component", pa.int32()), ("n", pa.int64()),
                        ("deviation", pa.int64()), ("whitened", pa.float64()),
                        ("explained", pa.float64()), ("identity_error", pa.float64())])

    def deviations(x: np.ndarray) -> list:
        if small:
            away = n * x - np.array(sums, dtype=np.int64)
            return (away * away).sum(axis=1)
        away = n * x.astype(object) - np.array(sums, dtype=object)
        return [v if v < 1 << 63 else None for v in (away * away).sum(axis=1)]

    def run(batches):
        for b in batches:
            for at in range(0, b.num_rows if k else 0, BLOCK_ROWS):
                part = b.slice(at, BLOCK_ROWS)
                x, m = matrix(part.column(1), d), part.num_rows
                again = pa.array(np.repeat(np.arange(m), k))
                yield pa.RecordBatch.from_arrays([
                    part.column(0).cast(pa.int64()).take(again),
                    pa.array(np.tile(np.arange(1, k + 1), m), pa.int32()),
                    pa.array(np.full(m * k, n), pa.int64()),
                    pa.array(deviations(x), pa.int64()).take(again),
                    pa.array((centred(x, n, sums, narrow) @ turned).ravel()),
                    pa.array(np.tile(share, m)), pa.array(np.full(m * k, error))], schema=schema)
    return rows.select("vec_id", "x").mapInArrow(
        run, "vec_id long, component int, n long, deviation long, whitened double, "
             "explained double, identity_error double")


def whitening(table: DataFrame, most: int = COMPONENTS) -> DataFrame:
    """The digest of a table with vec_id and embedding."""
    rows = usable(table)
    stats = fit(rows)
    if stats is None:
        return table.sparkSession.createDataFrame(
            [], "vec_id long, component int, n long, deviation long, whitened double, "
                "explained double, identity_error double")
    return whiten(rows, stats, most)
