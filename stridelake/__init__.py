"""stridelake: sensor-trial analytics on Spark.

Main entry points (see README for the full map):

    from stridelake import trial_events, motion_metrics, fuse, tag_imu, clean
    from stridelake import pose_features, detect_landmarks, scan, min_spacing
"""

from .operators.inference import detect_landmarks, stub_detector_factory
from .operators.pose import pose_features
from .operators.quality import clean, reject_report, tag_imu, tag_rules
from .operators.relations import active_session, global_rank, pending
from .operators.sequence import frame_sums, range_frame, scan
from .operators.signals import (fill_states, interpolate_at, local_peaks, min_spacing,
                                smooth_flags, state_runs, transitions, window_counts)
from .operators.trials import fuse, motion_metrics, trial_events
from .params import PoseParams, QualityParams, StepParams, TrialParams
from .session import get_session

__all__ = [
    "PoseParams", "QualityParams", "StepParams", "TrialParams", "active_session", "clean",
    "detect_landmarks", "fill_states", "frame_sums", "fuse", "get_session", "global_rank",
    "interpolate_at", "local_peaks", "min_spacing", "motion_metrics", "pending", "pose_features",
    "range_frame", "reject_report", "scan", "smooth_flags", "state_runs", "stub_detector_factory", "tag_imu",
    "tag_rules", "transitions", "trial_events", "window_counts",
]
