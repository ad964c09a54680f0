"""Thresholds and constants, as frozen parameter objects.

Every operator takes one of these, so the same code runs on real sensor
units (the defaults) and on rescaled mappings of other tables.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# ---------------------------------------------------------------------------
# These must equal the reference pipeline for equal results.
#   sensor range limits:        accel 8.0 g, gyro 2000.0 deg/s (strict >)
#   landmark trust:             visibility > 0.5
#   seated when knee angle <    120.0 degrees
#   3 m mark position:          x 0.818, y 0.735
#   cut line direction:         dx 1.0, dy -2.10
#   landmark ids:               left/right hip 23/24, knee 25/26, ankle 27/28
#   state smoothing window:     1.0 s, centred, majority strictly > 0.5
#   step peak threshold:        1.1 g
#   minimum step spacing:       0.3 s
#   frailty cut-off:            duration >= 12.0 s
#   IMU samples per CSV chunk:  500
# ---------------------------------------------------------------------------
ACCEL_RANGE_G = 8.0
GYRO_RANGE_DPS = 2000.0
VISIBILITY_MIN = 0.5
SEATED_ANGLE_MAX = 120.0
MARK_X, MARK_Y = 0.818, 0.735
DIR_X, DIR_Y = 1.0, -2.10
LEFT_HIP, RIGHT_HIP = 23, 24
LEFT_KNEE, RIGHT_KNEE = 25, 26
LEFT_ANKLE, RIGHT_ANKLE = 27, 28
DWELL_S = 1.0
STEP_THRESHOLD_G = 1.1
STEP_MIN_GAP_S = 0.3
FRAIL_S = 12.0
CHUNK_ROWS = 500

# Quality rule names (our English labels, in rule order).
NULL_VALUE = "null_value"
ACCEL_OUT_OF_RANGE = "accel_out_of_range"
GYRO_OUT_OF_RANGE = "gyro_out_of_range"
DUPLICATE_TIMESTAMP = "duplicate_timestamp"

ACCEL_COLS = ("accel_x_g", "accel_y_g", "accel_z_g")
GYRO_COLS = ("gyro_x_dps", "gyro_y_dps", "gyro_z_dps")


@dataclass(frozen=True)
class TrialParams:
    """Event-chain parameters (times in ms unless the name says _s)."""

    dwell_ms: int = int(DWELL_S * 1000)
    frail_s: float = FRAIL_S
    # Width of the time buckets that split one trial over many tasks. Must be
    # at least half the dwell window; rows of one bucket land in one task.
    bucket_ms: int = 10 * 60 * 1000

    @property
    def frame(self) -> tuple[int, int]:
        """Centred window (t - w/2, t + w/2] as an integer range frame."""
        half = self.dwell_ms // 2
        return (-(half - 1), half)


@dataclass(frozen=True)
class StepParams:
    threshold: float = STEP_THRESHOLD_G
    min_gap_ms: int = int(STEP_MIN_GAP_S * 1000)
    bucket_ms: int = 10 * 60 * 1000


@dataclass(frozen=True)
class PoseParams:
    visibility_min: float = VISIBILITY_MIN
    seated_angle_max: float = SEATED_ANGLE_MAX
    mark_x: float = MARK_X
    mark_y: float = MARK_Y
    dir_x: float = DIR_X
    dir_y: float = DIR_Y
    hips: tuple[int, int] = (LEFT_HIP, RIGHT_HIP)
    knees: tuple[int, int] = (LEFT_KNEE, RIGHT_KNEE)
    ankles: tuple[int, int] = (LEFT_ANKLE, RIGHT_ANKLE)
    # "null" switches the zero-length-limb case to an unknown angle (D8).
    degenerate: str = "reference"


@dataclass(frozen=True)
class QualityParams:
    accel_range: float = ACCEL_RANGE_G
    gyro_range: float = GYRO_RANGE_DPS
    accel_cols: tuple[str, ...] = ACCEL_COLS
    gyro_cols: tuple[str, ...] = GYRO_COLS
    extra_null_cols: tuple[str, ...] = field(default_factory=tuple)
