"""Small column functions (JVM-side expressions only)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def epoch_ms(ts: str | Column) -> Column:
    """Milliseconds since the epoch, floored, for TIMESTAMP or TIMESTAMP_NTZ
    (an NTZ value is read as UTC wall-clock)."""
    c = col(ts).cast("timestamp")
    return _div_floor(F.unix_micros(c), 1000)


def _div_floor(x: Column, n: int) -> Column:
    # integer floor division (x may be negative before 1970)
    q = (x - F.pmod(x, F.lit(n))) / F.lit(n)
    return q.cast("long")


def seconds_to_ms(sec: str | Column) -> Column:
    """Float seconds -> integer ms, truncated (epoch values are >= 0)."""
    return F.floor(col(sec) * F.lit(1000)).cast("long")


def short_id(c: str | Column, n: int = 8) -> Column:
    return F.substring(col(c), 1, n)


def fmt_or_dash(c: str | Column, fmt: str) -> Column:
    """``format_string`` of a number, an em dash for null."""
    return F.coalesce(F.format_string(fmt, col(c)), F.lit("—"))


def zero_pad(c: str | Column, width: int) -> Column:
    return F.lpad(col(c).cast("string"), width, "0")


def frame_file_name(ms: str | Column) -> Column:
    """``frame_<16-digit ms>.jpg``"""
    return F.format_string("frame_%016d.jpg", col(ms))


def chunk_file_name(first_ms: str | Column, chunk_no: str | Column) -> Column:
    """``imu_<16-digit ms>_chunk<4-digit>.csv``"""
    return F.format_string("imu_%016d_chunk%04d.csv", col(first_ms), col(chunk_no))
