"""Raw sensor sources: IMU CSV chunks, camera frame files, raw sensor lines
(SRC-1, SRC-2, SRC-7), batch or streaming with the same parsing code."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalar import frame_file_name
from ..session import full_uri, path_exists, per_key

# Columns of an IMU CSV chunk, by position (the header text is not used).
IMU_CSV_SCHEMA = T.StructType([
    T.StructField("host_timestamp_ms", T.DoubleType()),
    T.StructField("imu_timestamp_ms", T.LongType()),
    T.StructField("accel_x_g", T.DoubleType()),
    T.StructField("accel_y_g", T.DoubleType()),
    T.StructField("accel_z_g", T.DoubleType()),
    T.StructField("gyro_x_dps", T.DoubleType()),
    T.StructField("gyro_y_dps", T.DoubleType()),
    T.StructField("gyro_z_dps", T.DoubleType()),
])
KEY = "trial_id"
NO_TRIAL = "__HIVE_DEFAULT_PARTITION__"  # the folder of rows without a trial
IMU_SCHEMA = T.StructType(IMU_CSV_SCHEMA.fields + [T.StructField(KEY, T.StringType())])

FRAME_SCHEMA = T.StructType([
    T.StructField(KEY, T.StringType()),
    T.StructField("frame_ts_ms", T.LongType()),
    T.StructField("content", T.BinaryType()),
])

# Frame files are named frame_<16-digit ms>.jpg inside <key>=<id>/ folders.
FRAME_KEY_PATTERN = r"trial_id=([^/]+)"
FRAME_TS_PATTERN = r"frame_(\d+)\.jpg$"


def read_imu_csv(spark: SparkSession, path: str, streaming: bool = False,
                 max_files_per_trigger: int | None = None) -> DataFrame:
    """Hive-partitioned CSV folder ``<path>/trial_id=<id>/*.csv`` with a fixed
    schema; PERMISSIVE: a bad cell becomes null, the row stays. The trial id
    is a string (partition type inference is off)."""
    r = spark.readStream if streaming else spark.read
    r = r.schema(IMU_SCHEMA).option("header", True).option("mode", "PERMISSIVE")
    if not streaming:
        r = r.option("basePath", path)
    elif max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.csv(path)


# Files of a source, by their path below it; the time is of the last change.
FILE_SCHEMA = "path string, size long, time long"
READ_BYTES = 32 << 20  # of files to a reading task, at most
OPEN_BYTES = 64 << 10  # what opening a file counts for
BLOCK_BYTES = 4 << 20
FILE_BYTES = 2 << 10  # what the lines of a small file take beside their text
BLANK = "".join(map(chr, range(33)))  # what a blank line may hold
PACKED = r"\.(gz|bz2|zst)$"  # compressed files that Arrow reads as they are
OTHER_PACKED = r"\.(deflate|snappy|lz4|lzo)$"
FOLDER_PATTERN = rf"(?:^|/){KEY}=([^/]+)/"


def arrow_reads(spark: SparkSession, path: str) -> bool:
    """Whether Python tasks can list and open a folder themselves. Not so for a pattern, for
    a table that a stream writes (its log names the files), for stores unknown to Arrow."""
    from pyarrow import fs
    if re.search(r"[*?\[{%]", path) or path_exists(spark, f"{path}/_spark_metadata"):
        return False
    try:
        fs.FileSystem.from_uri(full_uri(spark, path))
    except (OSError, ValueError, NotImplementedError):
        return False
    return True


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """(path, size, time) of the files below a folder, hidden ones left out. One task lists
    the folder itself, many list what is in its folders; no list comes to the driver."""
    path = full_uri(spark, path)
    kinds = f"{FILE_SCHEMA}, folder boolean"

    def shown(name):  # as Spark's readers have it
        return not (name[0] == "." or name[0] == "_" and "=" not in name
                    or name.endswith("._COPYING_"))

    def listed(store, top, sub, deep):
        from pyarrow import fs
        at = f"{top}/{sub}" if sub else top
        # a folder may go after it was listed, as for Spark's readers; the source may not
        for x in store.get_file_info(fs.FileSelector(at, allow_not_found=deep, recursive=deep)):
            below = x.path[len(at) + 1:]
            if all(map(shown, below.split("/"))):
                yield (f"{sub}/{below}" if sub else below, x.size, x.mtime_ns,
                       x.type == fs.FileType.Directory)

    def batches(rows):
        import pyarrow as pa
        names = ["path", "size", "time", "folder"]
        types = [pa.string(), pa.int64(), pa.int64(), pa.bool_()]
        held = []
        for r in rows:
            held.append(r)
            if len(held) == 2000:
                yield pa.RecordBatch.from_arrays(list(map(pa.array, zip(*held), types)), names)
                held = []
        if held:
            yield pa.RecordBatch.from_arrays(list(map(pa.array, zip(*held), types)), names)

    def first(_):
        from pyarrow import fs
        store, top = fs.FileSystem.from_uri(path)
        yield from batches(listed(store, top, "", False))

    def rest(parts):
        from pyarrow import fs
        store, top = fs.FileSystem.from_uri(path)

        def rows():
            for b in parts:
                for r in b.to_pylist():
                    if r["folder"]:
                        yield from listed(store, top, r["path"], True)
                    else:
                        yield tuple(r.values())
        yield from batches(rows())

    # by number: Spark would put rows as few as a listing's together again
    n = 4 * spark.sparkContext.defaultParallelism
    top = spark.range(1, numPartitions=1).mapInArrow(first, kinds)
    return (top.repartition(n, "path").mapInArrow(rest, kinds)
            .where(~F.col("folder")).drop("folder"))


def whole_lines(f, start: int, stop: int | None) -> Iterator[bytes]:
    """The lines of a file that begin from ``start`` on and before ``stop``, some whole lines
    at a time. A line ends at a line feed or a carriage return; both give a blank line more."""
    def end(b: bytes, at: int = 0) -> int:  # after the first end of a line, or 0
        return min((i + 1 for i in (b.find(b"\n", at), b.find(b"\r", at)) if i >= 0), default=0)

    at, rest, inside = start, b"", start > 0
    if inside:  # the line that goes on at start is another part's
        at -= 1
        f.seek(at)
    while b := f.read(BLOCK_BYTES):
        after = at + len(b)
        if inside:
            if not (cut := end(b)):
                at = after
                if stop is not None and at >= stop:
                    return
                continue
            b, at, inside = b[cut:], at + cut, False
            if stop is not None and at >= stop:
                return
        if stop is not None and after >= stop:
            cut = end(b, max(0, stop - 1 - at))
            if cut:
                yield rest + b[:cut]
                return
        else:
            cut = max(b.rfind(b"\n"), b.rfind(b"\r")) + 1
            if cut:
                yield rest + b[:cut]
                rest, b = b"", b[cut:]
        rest += b
        at = after
    if rest:
        yield rest


def read_imu_files(files: DataFrame, path: str) -> DataFrame:
    """The rows of CSV files listed by ``list_files``, as ``read_imu_csv`` has them: first
    line left out, columns by position, a bad cell null, the trial from the folder's name
    (from the column after the others where no folder names it). Tasks open the files
    themselves, a large one in parts, so that no list of them is held in one place."""
    spark, most = files.sparkSession, READ_BYTES
    path = full_uri(spark, path)
    packed = F.col("path").rlike(PACKED)
    files = files.withColumn("size", F.when(
        F.col("path").rlike(OTHER_PACKED), F.raise_error(F.concat(F.lit("not readable: "), "path")))
        .otherwise(F.col("size")))
    n, size = files.agg(F.count(F.lit(1)), F.sum(F.col("size") + F.lit(OPEN_BYTES))).first()
    tasks = max(1, min(n, spark.sparkContext.defaultParallelism), -(-(size or 0) // most))
    starts = F.when(packed, F.array(F.lit(0).cast("long"))).otherwise(
        F.sequence(F.lit(0).cast("long"), F.greatest(F.col("size") - 1, F.lit(0)),
                   F.lit(most).cast("long")))
    parts = (files.select("path", packed.alias("packed"), F.explode(starts).alias("start"))
             .repartition(tasks))

    def read(batches):
        import pyarrow as pa
        import pyarrow.compute as pc
        from pyarrow import fs
        store, top = fs.FileSystem.from_uri(path)

        def lines(name, packed, start):
            if packed:
                opened, stop = store.open_input_stream(f"{top}/{name}"), None
            else:
                opened, stop = store.open_input_file(f"{top}/{name}"), start + most
            header = start == 0
            with opened as f:
                for i, b in enumerate(whole_lines(f, start, stop)):
                    text = b.decode("utf-8", "replace").replace("\r", "\n")
                    if header and i == 0:
                        text = text.removeprefix("\ufeff")
                    x = pc.split_pattern(pa.array([text]), "\n").flatten()
                    x = x.filter(pc.not_equal(pc.utf8_trim(x, BLANK), ""))
                    if header and len(x):
                        x, header = x[1:], False
                    if len(x):
                        yield x, len(b)

        def batch(held):
            trials, named, texts = zip(*held)
            of = [len(x) for x in texts]
            index = pa.array([i for i, k in enumerate(of) for _ in range(k)], pa.int32())
            return pa.RecordBatch.from_arrays(
                [pa.array(trials, pa.string()).take(index), pa.array(named, pa.bool_()).take(index),
                 pa.concat_arrays(texts)], ["folder", "named", "line"])

        held, size = [], 0
        for b in batches:
            for name, packed, start in zip(*(c.to_pylist() for c in b.columns)):
                m = re.search(FOLDER_PATTERN, name)
                trial = unquote(m[1], "latin-1") if m and m[1] != NO_TRIAL else None
                for x, k in lines(name, packed, start):
                    held.append((trial, m is not None, x))
                    size += k + FILE_BYTES
                    if size >= BLOCK_BYTES:
                        yield batch(held)
                        held, size = [], 0
        if held:
            yield batch(held)

    def parsed(schema):
        ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema)
        return F.from_csv("line", ddl, {"mode": "PERMISSIVE"})

    trial = F.when(F.col("named"), F.col("folder")).otherwise(parsed(IMU_SCHEMA)[KEY])
    # parsed once, as in parse_imu_lines
    return (parts.mapInArrow(read, "folder string, named boolean, line string")
            .select(trial.alias(KEY), F.inline(F.array(parsed(IMU_CSV_SCHEMA))))
            .select(*IMU_SCHEMA.names))


def frames_from_files(files: DataFrame) -> DataFrame:
    """Path -> (trial_id, frame_ts_ms, content). An unmatched path gives an
    empty id and a null timestamp (kept; callers reject it, D24)."""
    p = F.col("path")
    return files.select(F.regexp_extract(p, FRAME_KEY_PATTERN, 1).alias(KEY),
                        F.regexp_extract(p, FRAME_TS_PATTERN, 1).try_cast("bigint")
                        .alias("frame_ts_ms"),
                        F.col("content"))


def read_frames(spark: SparkSession, path: str) -> DataFrame:
    files = (spark.read.format("binaryFile").option("pathGlobFilter", "*.jpg")
             .option("recursiveFileLookup", "true").load(path))
    return frames_from_files(files)


def write_frames(frames: DataFrame, path: str) -> None:
    """(trial_id, frame_ts_ms, content) as one file per frame, named by its
    time in a folder per trial (what ``read_frames`` reads). A file written
    again by a repeated task is the same file."""
    from pyarrow import fs
    path = full_uri(frames.sparkSession, path)

    def run(batches):
        store, top = fs.FileSystem.from_uri(path)
        made = set()
        for b in batches:
            for r in b.to_pylist():
                folder = f"{top}/{KEY}={r[KEY]}"
                if folder not in made:
                    store.create_dir(folder, recursive=True)
                    made.add(folder)
                with store.open_output_stream(f"{folder}/{r['name']}") as f:
                    f.write(r["content"])
            yield b.select([KEY])
    (frames.select(F.col(KEY).cast("string").alias(KEY), "content",
                   frame_file_name(F.col("frame_ts_ms")).alias("name"))
     .mapInArrow(run, f"{KEY} string").write.format("noop").mode("overwrite").save())


def write_trial_csv(rows: DataFrame, path: str, key: str = KEY,
                    rows_per_file: int = 100_000) -> None:
    """CSV files with a header in a folder per trial, added to what is there. A trial's
    rows are one file, those of a long one several of about ``rows_per_file`` rows, so that
    no task holds a hot trial. Written by Arrow: a file costs one call of the store, no
    commit of its own."""
    path = full_uri(rows.sparkSession, path)
    run = uuid.uuid4().hex[:12]  # a file written again by a repeated task is the same file
    columns = [c for c in rows.columns if c != key]
    one = rows.withColumn("_k", F.struct(key))  # equal where the key is null
    n = per_key(one.groupBy("_k").agg(F.ceil(F.count(F.lit(1)) / F.lit(rows_per_file))
                                      .alias("_n")), "trial-files")
    part = F.pmod(F.xxhash64(*columns), F.col("_n"))
    d = (one.join(n, "_k").withColumn("_part", part)
         .withColumn("_g", F.xxhash64(key, "_part"))
         # as text, as Spark's own writer has them
         .select(F.col(key).cast("string").alias(key),
                 *(F.col(c).cast("string").alias(c) for c in columns), "_part", "_g")
         .repartition(key, "_part").sortWithinPartitions("_g", key, "_part"))

    def write(batches):
        from pyarrow import csv, fs

        from ..operators.greedy import whole_groups
        store, top = fs.FileSystem.from_uri(path)
        for t, cuts in whole_groups(batches):
            for a, b in zip(cuts[:-1], cuts[1:]):
                trial, i = (t.column(c)[int(a)].as_py() for c in (key, "_part"))
                folder = f"{top}/{key}={NO_TRIAL if trial is None else trial}"
                store.create_dir(folder, recursive=True)
                with store.open_output_stream(f"{folder}/part-{run}-{i}.csv") as f:
                    csv.write_csv(t.select(columns).slice(a, b - a), f)
            yield from t.select([key]).to_batches()
    d.mapInArrow(write, f"{key} string").write.format("noop").mode("overwrite").save()


def rejected_imu_lines(lines: DataFrame, value: str = "value") -> DataFrame:
    """(value, reason) of the lines that ``parse_imu_lines`` drops: ``fields``
    (not seven) or ``number`` (a field is none)."""
    d = lines.select(F.col(value).alias("value"), F.split(F.trim(F.col(value)), ",").alias("_p"))
    number = F.trim(F.get("_p", 0)).try_cast("bigint").isNull() | F.exists(
        F.slice("_p", 2, 6), lambda x: F.trim(x).try_cast("double").isNull())
    reason = (F.when(F.coalesce(F.size("_p"), F.lit(0)) != 7, F.lit("fields"))
               .when(number, F.lit("number")))
    return d.select("value", reason.alias("reason")).where(F.col("reason").isNotNull())


def parse_imu_lines(lines: DataFrame, value: str = "value") -> DataFrame:
    """Raw sensor lines ``millis,ax,ay,az,gx,gy,gz``: exactly seven fields,
    an integer and six numbers; other lines are dropped (SRC-7).

    The parsed record is kept with ``inline(filter(array(rec), ok))`` rather
    than select + filter: a filter over the projected fields would be
    rewritten to re-split the line once per field.
    """
    names = ["ax", "ay", "az", "gx", "gy", "gz"]
    parts = F.col("_parts")
    rec = F.struct(F.size(parts).alias("_n"),
                   F.trim(F.get(parts, 0)).try_cast("bigint").alias("millis"),
                   *[F.trim(F.get(parts, i + 1)).try_cast("double").alias(n)
                     for i, n in enumerate(names)])

    def ok(r):
        c = r["_n"] == 7
        for f in ["millis"] + names:
            c = c & r[f].isNotNull()
        return c

    # split once, build the record once (generated code), then keep it
    d = lines.select(F.split(F.trim(F.col(value)), ",").alias("_parts"))
    d = d.select(rec.alias("_rec"))
    return d.select(F.inline(F.filter(F.array(F.col("_rec")), ok))).drop("_n")


def read_raw_lines(spark: SparkSession, path: str, streaming: bool = False) -> DataFrame:
    r = spark.readStream if streaming else spark.read
    return parse_imu_lines(r.text(path))


def source_trial_ids(spark: SparkSession, prefix: str, key: str = KEY) -> DataFrame:
    """Distinct trial ids present under a source prefix (SRC-6), from file
    paths only: the ``content`` column of the binary-file source is never
    read when it is not selected, so this lists, it does not load."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
             .load(prefix).select("path"))
    ids = F.regexp_extract(F.col("path"), f"{key}=([^/]+)", 1)
    return files.select(ids.alias(key)).filter(F.col(key) != "").distinct()
