"""Pipeline specifications: YAML with a base file beside it, checked against closed sets."""

from __future__ import annotations

import math
import os
from dataclasses import dataclass, field, fields

import yaml

from ..functions.geometry import Box, axis_name
from ..operators.registration import BACKENDS, RegistrationConfig
from ..operators.selection import METHODS
from ..operators.tracking import TrackerConfig

CLUSTERERS = ("dbscan", "euclidean_clustering", "ground_removed_dbscan", "hdbscan", "voxel_grid_connected_components", "range_image_connected_components", "range_image_depth_jump", "beam_neighbor_region_growing")
ACCUMULATORS = ("voxel_fusion", "weighted_voxel_fusion", "registration_voxel_fusion", "occupancy_consensus_fusion")
POST = ("tracklet_stitching", "co_moving_track_merge", "articulated_vehicle_merge", "trajectory_smoothing")


class ConfigError(ValueError):
    pass


@dataclass(frozen=True)
class Spec:
    """One dataflow. Lengths are in the unit of the points."""

    box: Box
    #: Along which objects move.
    axis: str = "y"
    clusterer: str = "dbscan"
    eps: float = 1.15
    voxel: float = 0.25
    min_points: int = 20
    vehicle_min_points: int = 20
    vehicle_max_points: int = 10_000
    jump_abs: float = 0.45
    jump_ratio: float = 0.08
    min_component: int = 8
    neighbour_rows: int = 1
    neighbour_cols: int = 1
    #: Of sensor-space clusterers: points beyond these ranges, and rows below this one, take no part.
    range_min: float = 0.0
    range_max: float = math.inf
    ground_rows: int = 0
    hdbscan_cluster: int = 20
    hdbscan_samples: int = 10
    ground_distance: float = 0.12
    ground_samples: int = 120
    ground_level: float = 0.75
    tracker: TrackerConfig = field(default_factory=TrackerConfig)
    min_track_hits: int = 4
    accumulator: str = "voxel_fusion"
    selection: str = "auto"
    use_all_frames: bool = True
    top_k: int = 10
    keep: int = 8
    bins: int = 10
    chunk_voxel: float = 0.07
    fusion_voxel: float = 0.05
    aggregate_voxel: float = 0.06
    min_observations: int = 1
    consensus_ratio: float = 0.35
    weights: str = "point_count"
    registration: RegistrationConfig = field(default_factory=RegistrationConfig)
    outlier_neighbours: int = 12
    outlier_ratio: float = 2.3
    min_saved_points: int = 180
    min_quality: float = 0.0
    #: Of long vehicles and merged groups.
    min_quality_long: float = 0.0
    save_world: bool = False
    require_exit: bool = True
    exit_margin: float = 0.9
    #: Units a metre, for the few lengths that are fixed in metres.
    metre: float = 1.0
    #: Post-processors, in order.
    post: tuple[str, ...] = ()
    smoothing_window: int = 0
    stitch_gap: int = 4
    stitch_distance: float = 2.5
    merge_lateral: float = 0.8
    merge_longitudinal: float = 4.0
    merge_overlap: int = 5
    merge_overlap_ratio: float = 0.6
    gap_window: int = 5
    link_overlap: int = 4
    link_overlap_ratio: float = 0.5
    link_lateral: float = 0.9
    link_vertical: float = 0.6
    link_gap: float = 2.5
    link_gap_std: float = 0.6
    link_speed: float = 0.5
    link_length: float = 6.5
    #: Steps of accumulation, off unless asked for.
    long_vehicles: bool = False
    long_length: float = 4.5
    line_ratio: float = 0.1
    touch_margin: float = 0.12
    truncate_at_lane_end: bool = False
    quality_window: bool = False
    window_points: float = 0.4
    window_extent: float = 0.35
    window_least: int = 4
    shape_ratio: float = 0.0
    deskew: bool = False
    underfill_fallback: bool = False
    underfill_chunks: int = 4
    tail_bridge: bool = False
    bridge_gap: float = 1.5
    bridge_lateral: float = 0.8
    bridge_vertical: float = 0.5
    cap_points: int = 0
    cap_bins: int = 16
    symmetry: bool = False

    def __post_init__(self) -> None:
        for name, value, known in (("clusterer", self.clusterer, CLUSTERERS), ("accumulator", self.accumulator, ACCUMULATORS), ("selection", self.selection, METHODS), ("registration backend", self.registration.backend, BACKENDS)):
            if value not in known:
                raise ConfigError(f"unknown {name} {value!r}; known: {', '.join(known)}")
        object.__setattr__(self, "post", tuple(self.post))
        object.__setattr__(self, "axis", axis_name(self.axis))
        if unknown := set(self.post) - set(POST):
            raise ConfigError(f"unknown post-processors {sorted(unknown)}; known: {', '.join(POST)}")
        for name in ("eps", "voxel", "fusion_voxel", "chunk_voxel", "aggregate_voxel", "metre", "long_length"):
            if getattr(self, name) <= 0:
                raise ConfigError(f"{name} must be positive")
        if self.vehicle_min_points > self.vehicle_max_points:
            raise ConfigError("vehicle_min_points is above vehicle_max_points")
        if self.range_max <= self.range_min:
            raise ConfigError("range_max is not above range_min")
        if not 0 < self.consensus_ratio <= 1:
            raise ConfigError("consensus_ratio must be in (0, 1]")


def merged(base: dict, over: dict) -> dict:
    """``over`` on ``base``: maps merge, anything else is replaced."""
    out = dict(base)
    for k, v in over.items():
        out[k] = merged(out[k], v) if isinstance(v, dict) and isinstance(out.get(k), dict) else v
    return out


def read(path: str) -> dict:
    with open(path, encoding="utf-8") as file:
        return yaml.safe_load(file) or {}


def load(path: str) -> dict:
    """A YAML file on top of the base.yaml beside it."""
    base = os.path.join(os.path.dirname(path), "base.yaml")
    return merged(read(base), read(path)) if os.path.exists(base) and os.path.basename(path) != "base.yaml" else read(path)


def spec(raw: dict) -> Spec:
    """A ``Spec`` from the sections ``box``, ``tracker``, ``registration`` and plain keys; unknown keys are errors."""
    if "box" not in raw:
        raise ConfigError("box is missing")
    raw = dict(raw)
    parts = {"box": Box(*(tuple(raw["box"][a]) for a in "xyz"))}
    raw.pop("box", None)
    for name, kind in (("tracker", TrackerConfig), ("registration", RegistrationConfig)):
        if name in raw:
            own = raw.pop(name)
            if bad := set(own) - {f.name for f in fields(kind)}:
                raise ConfigError(f"unknown keys in {name}: {sorted(bad)}")
            parts[name] = kind(**own)
    if bad := set(raw) - {f.name for f in fields(Spec)}:
        raise ConfigError(f"unknown keys: {sorted(bad)}")
    return Spec(**parts, **raw)
