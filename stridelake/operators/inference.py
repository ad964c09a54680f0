"""Per-frame landmark detection as a Spark job (UD-3).

The detector itself is pluggable: ``detector_factory()`` is called once per
task (model load) and the returned callable maps frame bytes to a list of
landmark dicts. A frame that cannot be decoded, shows no person, or makes
the detector fail yields an empty list, never a missing row; ``detect_batches``
also names the reason. The job runs in ``mapInPandas`` over Arrow batches, in
parallel over frame partitions. Frames without a timestamp are rejected before
inference.

``stub_detector`` is a deterministic stand-in (no pose model ships here):
it reads comma-separated floats and places landmark 23 + j at
(v[3j], v[3j+1]) with visibility |v[3j+2]| * 10.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

LANDMARK = T.StructType([
    T.StructField("landmark_id", T.LongType()),
    T.StructField("x", T.FloatType()),
    T.StructField("y", T.FloatType()),
    T.StructField("z", T.FloatType()),
    T.StructField("visibility", T.FloatType()),
    T.StructField("presence", T.FloatType()),
])
OUT_SCHEMA = T.StructType([
    T.StructField("trial_id", T.StringType()),
    T.StructField("frame_ts_ms", T.LongType()),
    T.StructField("landmarks", T.ArrayType(LANDMARK)),
])

BATCH_SCHEMA = T.StructType([*OUT_SCHEMA.fields, T.StructField("reason", T.StringType())])

Detector = Callable[[bytes], list]
BatchDetector = Callable[[list[bytes]], list[list]]


def stub_detector_factory(n_points: int = 6, first_id: int = 23) -> Callable[[], Detector]:
    def factory() -> Detector:
        def detect(content: bytes) -> list:
            # float32 text -> the exact float32 value, then double arithmetic
            v = np.array(content.decode("utf-8").split(","), dtype=np.float32).astype(np.float64)
            out = []
            for j in range(n_points):
                if 3 * j + 2 >= len(v):
                    break
                out.append({"landmark_id": first_id + j, "x": np.float32(v[3 * j]),
                            "y": np.float32(v[3 * j + 1]), "z": np.float32(0.0),
                            "visibility": np.float32(abs(v[3 * j + 2]) * 10.0),
                            "presence": np.float32(1.0)})
            return out
        return detect
    return factory


def rejected_frames(frames: DataFrame, key: str = "trial_id",
                    ts: str = "frame_ts_ms") -> DataFrame:
    """The frames that the detection job leaves out (no time), without their
    content."""
    return frames.where(F.col(ts).isNull()).select(F.col(key).cast("string").alias("trial_id"),
                                                   F.lit("no_time").alias("reason"))


def failed_frames(detected: DataFrame) -> DataFrame:
    """The frames of ``detect_batches`` without landmarks for a reason."""
    return detected.where(F.col("reason").isNotNull()).select("trial_id", "frame_ts_ms", "reason")


def in_batches(sizes: list[int], frames: int, size: int) -> Iterator[slice]:
    """Runs of neighbours of at most ``frames`` items and ``size`` bytes; an item above
    ``size`` is a run of its own."""
    a = held = 0
    for i, n in enumerate(sizes):
        if i > a and (i - a == frames or held + n > size):
            yield slice(a, i)
            a, held = i, 0
        held += n
    if a < len(sizes):
        yield slice(a, len(sizes))


#: Models of this worker process by name: a reused worker loads each one once.
_models: dict = {}


def loaded(model: str | None, factory: Callable[[], BatchDetector]) -> BatchDetector:
    if model is None:
        return factory()
    if model not in _models:
        _models[model] = factory()
    return _models[model]


def detect_batches(frames: DataFrame, detector_factory: Callable[[], BatchDetector],
                   model: str | None = None, batch_frames: int = 32,
                   batch_bytes: int = 8 << 20, key: str = "trial_id", ts: str = "frame_ts_ms",
                   content: str = "content") -> DataFrame:
    """(trial_id, frame_ts_ms, content) -> (trial_id, frame_ts_ms, landmarks, reason).

    The detector gets up to ``batch_frames`` frames and ``batch_bytes`` bytes a call and
    returns one list of landmarks for each. If a call fails, or returns another number
    of lists, its frames are given one by one, so that a bad frame costs only itself.
    ``reason`` is null where the detector ran, ``no_content`` for a null frame, else the
    class of the error; such frames have an empty list. With a ``model`` name the loaded
    detector stays in the worker process for later tasks; the name must change with the
    model. A factory that fails fails the job: no frame is at fault. Frames without a
    time are left out (``rejected_frames``); repeated frames stay."""
    src = frames.filter(F.col(ts).isNotNull()).select(
        F.col(key).cast("string").alias("trial_id"), F.col(ts).alias("frame_ts_ms"),
        F.col(content).alias("content"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        detect = loaded(model, detector_factory)

        def answer(some: list[bytes]) -> list[tuple[list, str | None]]:
            try:
                found = detect(some)
                if len(found) != len(some):
                    raise ValueError("not one list a frame")
                return [(x, None) for x in found]
            except Exception as e:  # data, not a failure of the task
                if len(some) == 1:
                    return [([], type(e).__name__)]
                return [answer([x])[0] for x in some]

        for pdf in batches:
            out: list[tuple[list, str | None]] = [([], "no_content")] * len(pdf)
            there = [i for i, x in enumerate(pdf["content"]) if x is not None]
            data = [bytes(pdf["content"].iloc[i]) for i in there]
            for part in in_batches([len(x) for x in data], batch_frames, batch_bytes):
                for i, x in zip(there[part], answer(data[part])):
                    out[i] = x
            yield pd.DataFrame({"trial_id": pdf["trial_id"], "frame_ts_ms": pdf["frame_ts_ms"],
                                "landmarks": [x for x, _ in out], "reason": [r for _, r in out]})

    return src.mapInPandas(run, BATCH_SCHEMA)


def one_by_one(detector_factory: Callable[[], Detector]) -> Callable[[], BatchDetector]:
    """A detector of single frames as one of batches; its error names its frame's."""
    def factory() -> BatchDetector:
        detect = detector_factory()
        return lambda some: [detect(x) for x in some]
    return factory


def detect_landmarks(frames: DataFrame, detector_factory: Callable[[], Detector],
                     key: str = "trial_id", ts: str = "frame_ts_ms",
                     content: str = "content") -> DataFrame:
    """(trial_id, frame_ts_ms, content) -> (trial_id, frame_ts_ms, landmarks): the
    detector one frame a call, reasons dropped."""
    return detect_batches(frames, one_by_one(detector_factory), batch_frames=1, key=key, ts=ts,
                          content=content).drop("reason")
