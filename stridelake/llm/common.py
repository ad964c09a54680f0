"""Shared helpers: reading ``documents``, folds, bounded samples, and numpy
routines over Arrow string buffers (words, word hashes, byte slices)."""

from __future__ import annotations

import ctypes
import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space of the word pattern ``[^\x20\x09-\x0D]+``.
SPACE_BYTES = b" \t\n\x0b\x0c\r"
IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[list(SPACE_BYTES)] = True

#: Text bytes handled at once by the numpy routines (a longer single text
#: makes a slice of its own).
SLICE_BYTES = 1 << 19


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def id_crc(c: str = "doc_id") -> Column:
    """crc32 of the id as text; a null id counts as the empty text (0)."""
    return F.crc32(F.coalesce(F.col(c).cast("string"), F.lit("")).cast("binary"))


def held_out(mod: int, c: str = "doc_id") -> Column:
    return id_crc(c) % mod == 0


def vocabulary(name: str) -> str:
    """Place of a public vocabulary file (on every executor)."""
    import public_tokenizers
    return public_tokenizers.path(name)


# -- numpy over Arrow strings ---------------------------------------------
def text_buffer(col: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of an Arrow string column; a null is an empty text."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if isinstance(col, pa.ChunkedArray):  # no chunk at all
        col = pa.array([], pa.string())
    if col.null_count:
        col = col.fill_null("")
    col = col.cast(pa.large_string())
    _, off, data = col.buffers()
    off = np.frombuffer(off, dtype=np.int64)[col.offset:col.offset + len(col) + 1] \
        if off is not None and len(col) else np.zeros(1, dtype=np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else \
        np.zeros(0, dtype=np.uint8)
    return raw[off[0]:off[-1]], off - off[0]


def slices(off: np.ndarray, most: int = SLICE_BYTES):
    """Runs [i, j) of whole documents of about ``most`` bytes each."""
    i, n = 0, len(off) - 1
    while i < n:
        j = int(np.searchsorted(off, off[i] + most, side="right")) - 1
        j = min(max(j, i + 1), n)
        yield i, j
        i = j


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (bijective), so that all bits depend on all bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2^64
_BASE_INV = pow(_BASE, -1, 1 << 64)


@functools.lru_cache(maxsize=2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    up = np.full(n + 1, _BASE, dtype=np.uint64)
    down = np.full(n + 1, _BASE_INV, dtype=np.uint64)
    up[0] = down[0] = 1
    return np.cumprod(up), np.cumprod(down)


def word_spans(raw: np.ndarray, off: np.ndarray):
    """Starts, ends and the number of words per document."""
    n = len(raw)
    solid = np.zeros(n + 2, dtype=bool)
    solid[1:-1] = ~IS_SPACE[raw]
    first = np.zeros(n + 1, dtype=bool)
    first[off] = True  # a document's start (and the end of all)
    starts = np.flatnonzero(solid[1:-1] & (~solid[:-2] | first[:-1]))
    ends = np.flatnonzero(solid[1:-1] & (~solid[2:] | first[1:])) + 1
    counts = np.diff(np.searchsorted(starts, off))
    return starts, ends, counts


def word_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each word from prefix sums of a polynomial, no loop."""
    n = len(raw)
    size = 1 << max(16, int(n).bit_length())
    up, down = _powers(size)
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * up[:n], out=sums[1:])
    return mix64((sums[ends] - sums[starts]) * down[starts])


def give_back() -> None:
    """Returns freed memory to the system: a Python worker outlives its task
    and would keep it beside the next stage's."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # not glibc
        pass


def larger(batches, rows: int, size: int = 32 << 20):
    """Record batches put together to at least so many rows or bytes."""
    held: list[pa.RecordBatch] = []
    for b in batches:
        held.append(b)
        if sum(x.num_rows for x in held) >= rows or sum(x.nbytes for x in held) >= size:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held = []
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


def arrow_out(fn, df: DataFrame, schema: str, rows: int = 0) -> DataFrame:
    """``mapInArrow`` where ``fn`` maps one record batch (of at least ``rows``
    rows, where there are) to columns (a dict) or to None; the output schema is
    declared once, as Spark DDL."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string
    kind = to_arrow_schema(_parse_datatype_string(schema))

    def run(batches):
        for b in larger(batches, rows) if rows else batches:
            if b.num_rows and (out := fn(b)) is not None:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(out[f.name], type=f.type) if not isinstance(out[f.name], pa.Array)
                     else out[f.name].cast(f.type) for f in kind], schema=kind)
        give_back()
    return df.mapInArrow(run, schema)


def kinds_of(df: DataFrame, columns: list[str]) -> str:
    """DDL of these columns."""
    kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    return ", ".join(f"`{c}` {kinds[c]}" for c in columns)


def bounded_sample(df: DataFrame, key: Column, rows: int) -> DataFrame:
    """About ``rows`` rows (binomial): those whose key hash falls below a share
    of the hash range that the exact count sets. All rows when there are fewer.
    For keys that are unique and not null; else see ``row_sample``."""
    n = df.count()
    if n <= rows:
        return df
    cut = int(rows / n * (1 << 31))
    return df.where(F.pmod(F.xxhash64(key), F.lit(1 << 31)) < cut)


def row_draw(df: DataFrame, rows: int, n: int | None = None) -> DataFrame:
    """About ``rows`` rows (binomial); all when there are fewer. Each row is
    drawn by itself (by a hash of its id, text and place), so rows of one id, or
    of none, aren't drawn together. ``n``: the number of rows, if known."""
    n = df.count() if n is None else n
    return df if n <= rows else df.where(drawn() < int(rows / n * (1 << 31)))


def drawn() -> Column:
    """An even draw from 0 to 2^31 - 1 for each row by itself."""
    return F.pmod(F.xxhash64("doc_id", "text", F.monotonically_increasing_id()), F.lit(1 << 31))


def row_sample(df: DataFrame, rows: int) -> DataFrame:
    """``row_draw`` of twice ``rows`` at the very most."""
    n = df.count()
    return df if n <= rows else row_draw(df, rows, n).limit(2 * rows)


# -- byte-level BPE ids ----------------------------------------------------
@functools.lru_cache(maxsize=2)
def byte_bpe(json_path: str):
    """text -> uint32 ids, equal to the tokenizers library's for the file
    (add_special_tokens=False). The rank-based encoder built from the same
    merges does the work; a text that it can't take goes to the library."""
    import json

    import tiktoken
    from tokenizers import Tokenizer
    with open(json_path, encoding="utf-8") as f:
        spec = json.load(f)
    specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
    as_byte = {c: b for b, c in byte_alphabet().items()}
    ranks = {bytes(as_byte[c] for c in t): i for t, i in spec["model"]["vocab"].items()
             if t not in specials}
    import public_tokenizers
    fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                             special_tokens=specials)
    slow: list = []

    def encode(text: str) -> np.ndarray:
        try:
            return fast.encode_to_numpy(text, allowed_special="all")
        except BaseException as e:  # the regex engine's limits surface as a panic
            if isinstance(e, (KeyboardInterrupt, SystemExit, MemoryError)):
                raise
            if not slow:
                slow.append(Tokenizer.from_file(json_path))
            return np.array(slow[0].encode(text, add_special_tokens=False).ids, dtype=np.uint32)
    return encode


@functools.cache
def byte_alphabet() -> dict[int, str]:
    """The byte-level alphabet of public BPE vocabularies: printable Latin-1
    bytes stand for themselves, the others for code points from 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(256 + k) for k, b in enumerate(rest)}
