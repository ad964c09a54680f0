"""Token-id files: documents of ids, each compressed on its own with a shared
zstandard dictionary, with an offset index for reading single documents.

Documents are dealt to tasks by ranges of doc_id, so files in order hold them
in ascending doc_id. A task encodes, compresses and writes its documents one by
one and starts a new file after ``file_bytes``. The dictionary is trained on
the serialized ids of a bounded sample of documents; its hash names its file
and stands in every token file.

A file: the documents' compressed ids (little-endian unsigned 16-bit integers,
or 32-bit where the vocabulary needs them); the index: for each document its
offset (uint64, and one more for the end), number of ids (uint64), doc_id
(int64) and whether it has one (uint8); the footer: number of documents, offset
of the index, id width (uint64 each), sha256 of the dictionary, magic. A file's
name is unique to the task attempt that wrote it, and readers take only files
of the manifest, so lost and repeated tasks leave no wrong data.

Defined results: a null or empty text is the end id alone; null doc_ids come
first; rows of one doc_id follow each other in order of a hash of the text;
repeated rows are written each. An empty table gives no file. Extra columns are
ignored. A text of any length is one document, encoded whole.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
import zlib

import numpy as np
import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import _parse_datatype_string

from ..session import cut, full_uri, scratch_path
from .common import arrow_out, byte_bpe, row_sample, vocabulary

END_ID = 2
SAMPLE_DOCS = 2000
#: Texts up to this length take part in the dictionary's sample.
SAMPLE_CHARS = 100_000
DICTIONARY_BYTES = 64 << 10
FILE_BYTES = 64 << 20
LEVEL = 3
MAGIC = b"TOKFILE1"
_FOOTER = struct.Struct("<QQQ32s8s")


class Writer:
    """Appends documents to one file."""

    def __init__(self, out, width: int, dictionary: bytes):
        self.out, self.kind = out, f"<u{width}"
        self.packer = zstandard.ZstdCompressor(level=LEVEL, dict_data=_dict(dictionary),
                                               write_dict_id=False)
        self.hash = hashlib.sha256(dictionary).digest()
        self.width, self.at = width, 0
        self.offsets, self.counts, self.ids = [0], [], []

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.at += self.out.write(self.packer.compress(ids.astype(self.kind).tobytes()))
        self.offsets.append(self.at)
        self.counts.append(len(ids))
        self.ids.append(doc_id)

    def close(self) -> int:
        known = np.array([x is not None for x in self.ids], dtype="<u1")
        ids = np.array([x or 0 for x in self.ids], dtype="<i8")
        for a in (np.array(self.offsets, dtype="<u8"), np.array(self.counts, dtype="<u8"), ids,
                  known):
            self.out.write(a.tobytes())
        self.out.write(_FOOTER.pack(len(ids), self.at, self.width, self.hash, MAGIC))
        self.out.close()
        return self.at


#: Documents in a record batch of what is read back.
READ_ROWS = 2000


class Reader:
    """Documents of one file, by position; only the index is held."""

    def __init__(self, source, dictionary: bytes):
        self.source = source
        end = source.size()
        n, self.index, width, digest, magic = _FOOTER.unpack(
            source.read_at(_FOOTER.size, end - _FOOTER.size))
        if magic != MAGIC:
            raise ValueError("not a token file")
        if digest != hashlib.sha256(dictionary).digest():
            raise ValueError("the file was written with another dictionary")
        self.kind = f"<u{width}"
        raw = source.read_at(end - _FOOTER.size - self.index, self.index)
        self.offsets = np.frombuffer(raw, "<u8", n + 1)
        self.counts = np.frombuffer(raw, "<u8", n, 8 * (n + 1))
        ids = np.frombuffer(raw, "<i8", n, 8 * (2 * n + 1))
        known = np.frombuffer(raw, "<u1", n, 8 * (3 * n + 1))
        self.doc_ids = [int(x) if k else None for x, k in zip(ids, known)]
        self.unpacker = zstandard.ZstdDecompressor(dict_data=_dict(dictionary))

    def __len__(self) -> int:
        return len(self.counts)

    def ids(self, position: int) -> np.ndarray:
        lo, hi = int(self.offsets[position]), int(self.offsets[position + 1])
        return np.frombuffer(self.unpacker.decompress(self.source.read_at(hi - lo, lo)), self.kind)


def _dict(dictionary: bytes) -> zstandard.ZstdCompressionDict | None:
    return zstandard.ZstdCompressionDict(dictionary) if dictionary else None


def _open(uri: str):
    return fs.FileSystem.from_uri(uri)


def train_dictionary(docs: DataFrame, vocab: str, docs_most: int = SAMPLE_DOCS) -> bytes:
    """Dictionary over the serialized ids of about ``docs_most`` documents;
    empty if there is too little to train on."""
    picked = row_sample(docs.select("doc_id", "text"), docs_most).where(
        F.length("text") <= SAMPLE_CHARS)

    def ids(b: pa.RecordBatch):
        encode = byte_bpe(vocab)
        return {"ids": pa.array([encode(t.as_py()).astype("<u2").tobytes()
                                 for t in b.column("text")], pa.binary())}
    some = [bytes(r["ids"]) for r in arrow_out(ids, picked, "ids binary").collect()]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, some).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b""


def write(docs: DataFrame, path: str, vocab: str | None = None, end_id: int = END_ID,
          file_bytes: int = FILE_BYTES) -> DataFrame:
    """Writes the files below ``path`` (a folder that all executors share) and
    returns their manifest: part, file (their order), name, docs, tokens,
    bytes, dictionary (hash)."""
    vocab = vocab or vocabulary("byte_bpe_50k.json")
    path = full_uri(docs.sparkSession, path)
    dictionary = train_dictionary(docs, vocab)
    name = hashlib.sha256(dictionary).hexdigest()
    store, top = _open(path)
    store.create_dir(top, recursive=True)
    with store.open_output_stream(f"{top}/{name}.dict") as f:
        f.write(dictionary)
    order = ["doc_id", "tie", "row"]
    ranged = (docs.select("doc_id", "text", F.xxhash64("text").alias("tie"),
                          F.monotonically_increasing_id().alias("row"))
              .repartitionByRange(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")),
                                  *order).sortWithinPartitions(*order).select("doc_id", "text"))
    schema = ("part int, file int, name string, docs bigint, tokens bigint, bytes bigint, "
              "dictionary string")
    kind = to_arrow_schema(_parse_datatype_string(schema))

    def run(batches):
        encode, part = byte_bpe(vocab), TaskContext.get().partitionId()
        disk, folder = _open(path)
        made: list[tuple] = []
        now: Writer | None = None
        file = ""

        def close():
            size = now.close()
            made.append((part, len(made), file, len(now.counts), int(sum(now.counts)), size, name))
        for b in batches:
            for who, text in zip(b.column("doc_id").to_pylist(), b.column("text")):
                if now is None:
                    file = f"{part:06d}-{len(made):06d}-{uuid.uuid4().hex}.tok"
                    now = Writer(disk.open_output_stream(f"{folder}/{file}"), 2, dictionary)
                now.add(who, np.append(encode(text.as_py() or ""), end_id))
                if now.at >= file_bytes:
                    close()
                    now = None
        if now is not None:
            close()
        yield pa.RecordBatch.from_pylist([dict(zip(kind.names, m)) for m in made], schema=kind)
    return cut(ranged.mapInArrow(run, schema), "token-manifest")


def read(manifest: DataFrame, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document of the files."""
    path = full_uri(manifest.sparkSession, path)
    ahead = Window.orderBy("part", "file").rowsBetween(Window.unboundedPreceding, -1)
    files = manifest.select("name", "dictionary", F.coalesce(  # a row for each file
        F.sum("tokens").over(ahead), F.lit(0)).alias("base"))
    schema = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"
    kind = to_arrow_schema(_parse_datatype_string(schema))

    def run(batches):
        disk, folder = _open(path)
        for f in (f for b in batches for f in b.to_pylist()):
            with disk.open_input_file(f"{folder}/{f['dictionary']}.dict") as d:
                words = d.read()
            with disk.open_input_file(f"{folder}/{f['name']}") as source:
                r, start = Reader(source, words), f["base"]
                for a in range(0, len(r), READ_ROWS):  # what is held is one file's part
                    out = []
                    for k in range(a, min(a + READ_ROWS, len(r))):
                        ids = r.ids(k)
                        out.append((r.doc_ids[k], start, len(ids),
                                    zlib.crc32(ids.astype("<u4").tobytes())))
                        start += len(ids)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t.type) for c, t in zip(zip(*out), kind)], schema=kind)
    return files.repartition(max(1, manifest.count())).mapInArrow(run, schema)  # a task a file


def token_files(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Writes the documents to files and returns what the files hold."""
    path = path or scratch_path(docs.sparkSession, "token-files")
    return read(write(docs, path), path)
