"""Presets and benchmark manifests by the names they are published under.

A preset has sections (input, preprocessing, clustering, ...) that lie over the
base.yaml beside it. ``preset`` checks it and gives the ``Spec`` of its
dataflow with what a run needs beside that; lengths are metres.
"""

from __future__ import annotations

import logging
import os
from dataclasses import dataclass, field
from typing import Any

from pyarrow import fs

from ..functions.geometry import Box
from ..operators.registration import RegistrationConfig
from ..operators.tracking import TrackerConfig
from ..sources.frames import store
from .config import ConfigError, Spec, load

log = logging.getLogger("pointlane")

# Sections and keys of published presets, each with the field of ``Spec`` that takes it.
# "-": the key is known, and what it sets is handled below or is no part of the tables of a run.
KEYS = {
    "input": {"paths": "-", "format": "-"},
    "preprocessing": {"lane_box": "-", "bootstrap_frames": "-"},
    "clustering": {
        "algorithm": "clusterer", "eps": "eps", "voxel_size": "voxel", "min_points": "min_points", "vehicle_min_points": "vehicle_min_points", "vehicle_max_points": "vehicle_max_points",
        "plane_distance_threshold": "ground_distance", "plane_ransac_n": "-", "plane_num_iterations": "ground_samples", "ground_normal_z_min": "ground_level",
        "hdbscan_min_cluster_size": "hdbscan_cluster", "hdbscan_min_samples": "hdbscan_samples",
        "sensor_range_min": "range_min", "sensor_range_max": "range_max", "sensor_depth_jump_ratio": "jump_ratio", "sensor_depth_jump_abs": "jump_abs", "sensor_min_component_size": "min_component",
        "sensor_neighbor_rows": "neighbour_rows", "sensor_neighbor_cols": "neighbour_cols", "sensor_ground_row_ignore": "ground_rows",
    },
    "tracking": {
        "algorithm": "tracker.algorithm", "max_dist": "tracker.max_dist", "max_missed": "tracker.max_missed", "min_track_hits": "min_track_hits",
        "sticky_extra_dist_per_missed": "tracker.sticky_extra_dist_per_missed", "sticky_max_dist": "tracker.sticky_max_dist",
        "kf_init_var": "tracker.kf_init_var", "kf_process_var": "tracker.kf_process_var", "kf_meas_var": "tracker.kf_meas_var", "association_size_weight": "tracker.association_size_weight",
        "fragment_parent_min_length": "-", "fragment_max_lateral_offset": "-", "fragment_max_vertical_offset": "-", "fragment_child_max_length_ratio": "-", "fragment_child_max_point_ratio": "-", "fragment_max_rear_gap": "-", "fragment_child_max_age": "-",
    },
    "aggregation": {
        "algorithm": "accumulator", "symmetry_completion": "symmetry", "motion_deskew": "deskew", "truncate_after_lane_end_touch": "truncate_at_lane_end",
        "frame_selection_method": "selection", "use_all_frames": "use_all_frames", "top_k_frames": "top_k", "keyframe_keep": "keep",
        "chunk_quality_filter": "quality_window", "chunk_min_points_ratio_to_peak": "window_points", "chunk_min_extent_ratio_to_peak": "window_extent", "chunk_min_segment_length": "window_least",
        "frame_selection_line_axis": "axis", "frame_selection_line_ratio": "line_ratio", "frame_selection_touch_margin": "touch_margin", "frame_downsample_voxel": "chunk_voxel",
        "shape_consistency_filter": "-", "shape_consistency_max_extent_ratio": "-",
        "registration_backend": "registration.backend", "registration_max_corr_dist": "registration.max_corr_dist", "registration_max_iter": "registration.max_iter",
        "registration_min_fitness": "registration.min_fitness", "registration_max_translation": "registration.max_translation", "global_registration_voxel": "registration.voxel",
        "enable_registration_underfill_fallback": "underfill_fallback", "registration_min_kept_chunks": "underfill_chunks",
        "fusion_voxel_size": "fusion_voxel", "fusion_min_observations": "min_observations", "fusion_weight_mode": "weights", "consensus_ratio": "consensus_ratio",
        "min_track_quality_for_save": "min_quality", "min_saved_aggregate_points": "min_saved_points",
        "enable_confidence_point_cap": "-", "confidence_point_cap_max_points": "-", "confidence_point_cap_bins": "cap_bins",
        "long_vehicle_mode": "long_vehicles", "long_vehicle_length_threshold": "long_length", "length_coverage_bins": "bins", "min_track_quality_for_save_long_vehicle": "min_quality_long",
        "enable_tail_bridge": "tail_bridge", "tail_bridge_longitudinal_gap_max": "bridge_gap", "tail_bridge_lateral_gap_max": "bridge_lateral", "tail_bridge_vertical_gap_max": "bridge_vertical",
        "enable_post_filter_stat_outlier_removal": "-", "post_filter_stat_nb_neighbors": "-", "post_filter_stat_std_ratio": "outlier_ratio", "aggregate_voxel": "aggregate_voxel",
    },
    "postprocessing": {
        "enable_tracklet_stitching": "-", "stitching_max_gap": "stitch_gap", "stitching_max_center_dist": "stitch_distance",
        "enable_articulated_vehicle_merge": "-", "articulated_gap_eval_window_frames": "gap_window", "articulated_min_overlap_frames": "link_overlap", "articulated_min_overlap_ratio": "link_overlap_ratio",
        "articulated_max_lateral_offset": "link_lateral", "articulated_max_vertical_offset": "link_vertical", "articulated_max_hitch_gap": "link_gap", "articulated_max_hitch_gap_std": "link_gap_std",
        "articulated_max_speed_delta": "link_speed", "articulated_min_combined_length": "link_length",
        "enable_co_moving_track_merge": "-", "parallel_merge_max_lateral_offset": "merge_lateral", "parallel_merge_max_longitudinal_gap": "merge_longitudinal",
        "parallel_merge_min_overlap_frames": "merge_overlap", "parallel_merge_min_overlap_ratio": "merge_overlap_ratio",
        "enable_trajectory_smoothing": "-", "smoothing_window": "smoothing_window", "enable_track_quality_scoring": "-",
    },
    "classification": {"enabled": "-", "backend": "-", "pointnext_root": "-", "checkpoint_path": "-", "model_cfg_path": "-", "class_names": "-", "device": "-"},
    "class_normalization": {"enabled": "-", "aliases": "-"},
    "output": {"root_dir": "-", "save_world": "save_world", "save_aggregate_intensity": "-", "require_track_exit": "require_exit", "track_exit_edge_margin": "exit_margin"},
    "visualization": {
        "enabled": "-", "color_by_intensity": "-", "show_full_frame_pcd": "-", "show_tracker_debug": "-", "show_track_outcome_debug": "-", "show_articulated_merge_debug": "-",
        "max_points": "-", "max_cluster_points": "-", "max_assoc_dist": "-",
    },
}
#: Post-processors by their switches, in the order they run.
SWITCHES = {"enable_tracklet_stitching": "tracklet_stitching", "enable_articulated_vehicle_merge": "articulated_vehicle_merge", "enable_co_moving_track_merge": "co_moving_track_merge", "enable_trajectory_smoothing": "trajectory_smoothing"}
#: What holds where a preset is silent and ``Spec`` says otherwise.
DEFAULTS = {"aggregation": {"chunk_quality_filter": True, "enable_tail_bridge": True, "registration_backend": "small_gicp"}, "postprocessing": {"smoothing_window": 3}}
#: The least that a number may be, the numbers that are shares, the switches, and names from closed sets.
LEAST = {
    "preprocessing": {"bootstrap_frames": 0},
    "clustering": {"sensor_min_component_size": 1, "sensor_neighbor_rows": 0, "sensor_neighbor_cols": 0, "sensor_ground_row_ignore": 0, "hdbscan_min_cluster_size": 2, "hdbscan_min_samples": 1},
    "tracking": {"min_track_hits": 1},
    "aggregation": {"top_k_frames": 1, "keyframe_keep": 1, "chunk_min_segment_length": 1, "min_saved_aggregate_points": 0, "registration_min_kept_chunks": 1, "confidence_point_cap_max_points": 1, "confidence_point_cap_bins": 1, "length_coverage_bins": 2},
    "postprocessing": {
        "stitching_max_gap": 0, "articulated_gap_eval_window_frames": 1, "articulated_min_overlap_frames": 1, "articulated_max_lateral_offset": 0, "articulated_max_vertical_offset": 0, "articulated_max_hitch_gap": 0,
        "articulated_max_hitch_gap_std": 0, "articulated_max_speed_delta": 0, "articulated_min_combined_length": 0, "parallel_merge_min_overlap_frames": 1, "smoothing_window": 1,
    },
}
SHARES = {
    "aggregation": ("chunk_min_points_ratio_to_peak", "chunk_min_extent_ratio_to_peak", "min_track_quality_for_save", "min_track_quality_for_save_long_vehicle"),
    "postprocessing": ("articulated_min_overlap_ratio", "parallel_merge_min_overlap_ratio"),
}
FLAGS = {
    "aggregation": ("symmetry_completion", "motion_deskew", "truncate_after_lane_end_touch", "use_all_frames", "chunk_quality_filter", "shape_consistency_filter", "enable_registration_underfill_fallback", "enable_confidence_point_cap", "long_vehicle_mode", "enable_tail_bridge", "enable_post_filter_stat_outlier_removal"),
    "postprocessing": (*SWITCHES, "enable_track_quality_scoring"),
    "classification": ("enabled",),
    "class_normalization": ("enabled",),
    "output": ("save_world", "save_aggregate_intensity", "require_track_exit"),
    "visualization": ("enabled", "color_by_intensity", "show_full_frame_pcd", "show_tracker_debug", "show_track_outcome_debug", "show_articulated_merge_debug"),
}
NAMES = {
    "input": {"format": ("a42_pb",)},
    "tracking": {"algorithm": ("euclidean_nn", "kalman_nn", "hungarian_kalman")},
    "aggregation": {"fusion_weight_mode": ("uniform", "point_count", "quality")},
    "classification": {"backend": ("pointnext",), "device": ("auto", "cpu", "cuda", "mps")},
}


@dataclass(frozen=True)
class Preset:
    """A dataflow and what surrounds it: inputs, output folder, class names."""

    spec: Spec
    paths: tuple[str, ...] = ()
    root: str = "runs"
    intensity: bool = False
    classify: bool = False
    backend: str = "pointnext"
    class_names: tuple[str, ...] = ()
    aliases: dict[str, str] = field(default_factory=dict)


@dataclass(frozen=True)
class Manifest:
    """A benchmark: every preset on every sequence."""

    sequences: dict[str, str]
    presets: dict[str, str]
    root: str = "benchmarks"
    name: str = "curated_proxy"
    warmup: int = 1
    measure: int = 1


def is_published(raw: dict) -> bool:
    return "preprocessing" in raw


def _check(raw: dict[str, dict[str, Any]]) -> None:
    def each(table: dict):
        for section, keys in table.items():
            for key in keys:
                if key in raw.get(section, {}):
                    yield f"{section}.{key}", raw[section][key], keys[key] if isinstance(keys, dict) else None

    for name, value, _ in each(FLAGS):
        if not isinstance(value, bool):
            raise ConfigError(f"{name} must be true or false, not {value!r}")
    for name, value, known in each(NAMES):
        if value not in known:
            raise ConfigError(f"unknown {name} {value!r}; known: {', '.join(known)}")
    for name, value, _ in [*each(LEAST), *each(SHARES)]:
        if isinstance(value, bool) or not isinstance(value, (int, float)):
            raise ConfigError(f"{name} must be a number, not {value!r}")
    for name, value, least in each(LEAST):
        if value < least:
            raise ConfigError(f"{name} must be {least} or more, not {value}")
    for name, value, _ in each(SHARES):
        if not 0 <= value <= 1:
            raise ConfigError(f"{name} must be from 0 to 1, not {value}")


def _aliases(table: Any) -> dict[str, str]:
    if not isinstance(table, dict):
        raise ConfigError("class_normalization.aliases must be a map")
    for pair in table.items():
        if not all(isinstance(name, str) and name.strip() for name in pair):
            raise ConfigError(f"class_normalization.aliases holds a blank or a name that is no text: {pair}")
    return table


def beside(path: str, folder: str) -> str:
    """A path as it is named in a file of ``folder``; addresses and absolute paths stay."""
    return path if "://" in path or os.path.isabs(path) else os.path.normpath(os.path.join(folder, path))


def bind(raw: dict[str, dict[str, Any]], folder: str = "") -> Preset:
    """A preset from its sections; keys and values that are unknown are errors. What else stands beside the sections is left alone, with a warning."""
    if stray := sorted(set(raw) - set(KEYS)):
        log.warning("no sections of a preset, left alone: %s", ", ".join(stray))
    raw = {section: own for section, own in raw.items() if section in KEYS}
    for section, own in raw.items():
        if not isinstance(own, dict):
            raise ConfigError(f"section {section} must be a map")
        if bad := set(own) - set(KEYS[section]):
            raise ConfigError(f"unknown keys in {section}: {sorted(bad)}")
    _check(raw)
    raw = {section: DEFAULTS.get(section, {}) | raw.get(section, {}) for section in KEYS}
    box = raw["preprocessing"].get("lane_box")
    if not isinstance(box, list) or len(box) != 6:
        raise ConfigError("preprocessing.lane_box must be six numbers: two bounds for each of x, y and z")
    if raw["clustering"].get("plane_ransac_n", 3) != 3:
        raise ConfigError("clustering.plane_ransac_n: planes are laid through three points")
    parts: dict[str, dict[str, Any]] = {"": {}, "tracker": {}, "registration": {}}
    for section, keys in KEYS.items():
        for key, to in keys.items():
            if to != "-" and key in raw[section]:
                part, _, name = to.rpartition(".")
                parts[part][name] = raw[section][key]
    fuse, post = raw["aggregation"], raw["postprocessing"]
    parts[""] |= {
        "post": tuple(name for switch, name in SWITCHES.items() if post.get(switch, False)),
        "shape_ratio": fuse.get("shape_consistency_max_extent_ratio", 2.0) if fuse.get("shape_consistency_filter", False) else 0.0,
        "outlier_neighbours": fuse.get("post_filter_stat_nb_neighbors", 12) if fuse.get("enable_post_filter_stat_outlier_removal", True) else 0,
        "cap_points": fuse.get("confidence_point_cap_max_points", 2048) if fuse.get("enable_confidence_point_cap", False) else 0,
    }
    try:
        spec = Spec(box=Box(*(tuple(map(float, box[k : k + 2])) for k in (0, 2, 4))), tracker=TrackerConfig(**parts["tracker"]), registration=RegistrationConfig(**parts["registration"]), **parts[""])
    except TypeError as error:
        raise ConfigError(f"a value of the wrong kind: {error}") from error
    classes, names = raw["classification"], raw["class_normalization"]
    chosen = tuple(sorted(str(c) for c in classes.get("class_names", ())))
    if classes.get("enabled", False) and not (chosen and all(c.strip() for c in chosen)):
        raise ConfigError("classification.class_names must name every class")
    aliases = _aliases(names.get("aliases", {}))
    return Preset(
        spec, tuple(beside(str(p), folder) for p in raw["input"].get("paths", ())), str(raw["output"].get("root_dir", "runs")), raw["output"].get("save_aggregate_intensity", False),
        classes.get("enabled", False), classes.get("backend", "pointnext"), chosen, aliases if names.get("enabled", False) else {},
    )


def present(paths: tuple[str, ...]) -> tuple[str, ...]:
    """``paths``, once each is known to be there."""
    if not paths:
        raise ConfigError("input.paths names no file")
    for path in paths:
        system, inner = store(path)
        if system.get_file_info(inner).type == fs.FileType.NotFound:
            raise ConfigError(f"{path} is not there")
    return paths


def preset(path: str) -> Preset:
    """The preset of a YAML file on top of the base.yaml beside it. Inputs are not looked for: ``present`` does that."""
    return bind(load(path), os.path.dirname(os.path.abspath(path)))


def manifest(raw: dict, folder: str = "") -> Manifest:
    """A benchmark from its map; sequences and presets go by the names of their files."""
    if bad := set(raw) - {"name", "output_root", "warmup_runs", "measure_runs", "sequences", "presets"}:
        raise ConfigError(f"unknown keys: {sorted(bad)}")
    named = {}
    for key in ("sequences", "presets"):
        paths = [beside(str(p), folder) for p in raw.get(key, ())]
        named[key] = {os.path.splitext(os.path.basename(p.rstrip("/")))[0]: p for p in paths}
        if not paths:
            raise ConfigError(f"{key} names no file")
        if len(named[key]) < len(paths):
            raise ConfigError(f"{key} holds two files of one name")
    warmup, measure = int(raw.get("warmup_runs", 1)), int(raw.get("measure_runs", 1))
    if warmup < 0 or measure < 1:
        raise ConfigError("warmup_runs must be 0 or more, measure_runs 1 or more")
    return Manifest(named["sequences"], named["presets"], str(raw.get("output_root", "benchmarks")), str(raw.get("name", "curated_proxy")), warmup, measure)
