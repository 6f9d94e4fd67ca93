"""The dataflow: crop, cluster, track, post-process, select, fuse, decide.

Each stage is a table, and those that several stages use are written once. The
point table is joined again by (frame, label) only where points are needed;
trackers see detections alone, post-processors a row for a track and frame.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import association, clustering, crop, fusion, groups, postprocess, registration, selection, tracking
from ..sources.scratch import Keep, scratch
from .config import Spec

FRAME, TRACK = ["seq_id", "frame_index"], ["seq_id", "track_id"]


def cluster(points: DataFrame, spec: Spec, keep: Keep | None = None) -> DataFrame:
    """Points of the lane with ``label``."""
    lane = crop.frames_with_enough(crop.lane_crop(points, spec.box), spec.vehicle_min_points).drop("frame_points")
    name = spec.clusterer
    if name == "dbscan":
        return clustering.cluster_dbscan(lane, spec.eps, spec.min_points, keep)
    if name == "euclidean_clustering":
        return clustering.cluster_euclidean(lane, spec.eps, keep)
    if name == "ground_removed_dbscan":
        return clustering.cluster_ground_removed(lane, spec.eps, spec.min_points, spec.ground_distance, spec.ground_samples, spec.ground_level, keep=keep)
    if name == "hdbscan":
        return clustering.cluster_hdbscan(lane, spec.hdbscan_cluster, spec.hdbscan_samples)
    if name == "voxel_grid_connected_components":
        return clustering.cluster_voxels(lane, spec.voxel, keep)
    if spec.range_min > 0 or math.isfinite(spec.range_max):
        lane = lane.where(F.col("range").between(spec.range_min, spec.range_max))
    if spec.ground_rows > 0:
        lane = lane.where(F.col("row_index") >= spec.ground_rows)
    cells = clustering.sensor_cells(lane)
    links = clustering.cell_links(cells, name, spec.jump_abs, spec.jump_ratio, spec.eps, spec.neighbour_rows, spec.neighbour_cols)
    return clustering.label_points(lane, clustering.cell_components(cells, links, spec.min_component))


def observed(found: DataFrame, states: DataFrame) -> DataFrame:
    """Tracked frames with the center the tracker gives and the detection's bounds."""
    seen = states.where(F.col("status").isin("spawned", "matched")).select("seq_id", "track_id", "frame_id", "detection_id", "cx", "cy", "cz")
    box = found.select("seq_id", F.col("frame_index").alias("frame_id"), "detection_id", "label", F.col("point_count").alias("n_points"), F.col("frame_timestamp_ns").alias("ts_ns"), *[f"{n}_{a}" for n in ("min", "max") for a in "xyz"])
    return seen.join(box, ["seq_id", "frame_id", "detection_id"])


def joined_tracks(tracks: DataFrame, mapping: DataFrame) -> DataFrame:
    """Tracks under their new ids."""
    return tracks.join(mapping, TRACK).groupBy("seq_id", F.col("new_id").alias("track_id")).agg(
        F.sum("hit_count").alias("hit_count"), F.greatest(F.max("age"), F.max("last_frame") - F.min("first_frame") + 1).alias("age"), F.min("missed").alias("missed"), F.bool_or("ended_by_missed").alias("ended_by_missed"),
        F.min("first_frame").alias("first_frame"), F.max("last_frame").alias("last_frame"), F.sum("spawned_count").alias("spawned_count"), F.sum("matched_count").alias("matched_count"), F.sum("missed_count").alias("missed_count"),
    )


def renamed(rows: DataFrame, mapping: DataFrame) -> DataFrame:
    return rows.join(mapping, TRACK).withColumn("track_id", F.col("new_id")).drop("new_id")


def post_process(observations: DataFrame, tracks: DataFrame, spec: Spec, keep: Keep) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """(observations, (seq_id, track_id, frame_id, label) of their points, tracks, link states), in the order of ``spec.post``."""
    members = observations.select(*TRACK, "frame_id", "label")
    observations = observations.drop("label", "detection_id")
    nothing = "seq_id string, track_id int, group_id int, group_kind string, role string, partner_id int, gap_mean double, component_track_ids array<int>"
    linked = observations.sparkSession.createDataFrame([], nothing)
    for k, name in enumerate(spec.post):
        mapping = links = None
        if name == "tracklet_stitching":
            mapping = keep(f"mapping{k}", postprocess.stitch(observations, association.gap_pairs(observations, spec.stitch_gap, spec.stitch_distance)))
            observations = renamed(observations, mapping)
        elif name == "co_moving_track_merge":
            limits = (spec.merge_lateral, spec.merge_longitudinal, spec.merge_overlap, spec.merge_overlap_ratio)
            may = postprocess.co_moving_pairs(observations, *limits, scale=spec.metre).select("seq_id", "a", "b")
            pairs = postprocess.fragment_links(observations, may.join(postprocess.long_candidates(observations, spec.long_length), ["seq_id", "a", "b"]))
            lead = postprocess.lead_choice(observations, ahead_by=0.25 * spec.metre)
            pairs = pairs.select("seq_id", F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).join(lead, ["seq_id", "a", "b"])
            links = postprocess.link_states(pairs.select("seq_id", "lead", F.when(F.col("lead") == F.col("a"), F.col("b")).otherwise(F.col("a")).alias("rear")), "fragment")
            links = keep(f"links{k}", links)
            # Parts of a long vehicle stay tracks of their own; the others merge.
            free = observations.join(linked.unionByName(links).select(*TRACK), TRACK, "left_anti")
            merges = keep(f"mapping{k}", postprocess.co_moving_merges(free, *limits, scale=spec.metre))
            mapping = observations.select(*TRACK).distinct().join(merges, TRACK, "left").withColumn("new_id", F.coalesce("new_id", "track_id"))
            observations = postprocess.merge_by_frame(observations, mapping).drop("source_track_ids")
        elif name == "articulated_vehicle_merge":
            n = observations.groupBy(*TRACK).agg(F.count("*").alias("n"))
            decided = postprocess.articulated_decision(
                postprocess.articulated_metrics(observations, spec.gap_window, scale=spec.metre), n, spec.link_overlap, spec.link_overlap_ratio, spec.link_lateral, spec.link_vertical, spec.link_gap, spec.link_gap_std, spec.link_length, spec.link_speed, scale=spec.metre
            )
            free = decided.join(linked.select("seq_id", F.col("track_id").alias("a")), ["seq_id", "a"], "left_anti").join(linked.select("seq_id", F.col("track_id").alias("b")), ["seq_id", "b"], "left_anti")
            links = keep(f"links{k}", postprocess.link_states(postprocess.best_partners(free, observations), "articulated"))
        elif name == "trajectory_smoothing":
            observations = postprocess.smooth(observations, spec.smoothing_window)
        if mapping is not None:
            members, tracks = renamed(members, mapping), joined_tracks(tracks, mapping)
            observations = keep(f"observations{k}", observations)
        if links is not None:
            linked = linked.unionByName(links)
    return observations, members, tracks, linked


def bridged(cloud: DataFrame, spec: Spec, keep: Keep | None = None) -> DataFrame:
    """Clouds with the gaps between their parts filled along the axis."""
    parts = fusion.cloud_components(cloud, 3 * spec.fusion_voxel, keep)
    return cloud.unionByName(fusion.tail_bridge(parts, spec.bridge_gap, spec.bridge_lateral, spec.bridge_vertical, spec.fusion_voxel, spec.axis))


def chosen_frames(observations: DataFrame, long: DataFrame, spec: Spec) -> tuple[DataFrame, DataFrame | None]:
    """(the frames of each track to fuse, tail candidates of long vehicles): cut at the lane's end, window of good chunks, selection, coverage of long vehicles, shape."""
    low, high = spec.box.bounds(spec.axis)
    line = low + spec.line_ratio * (high - low)
    rows = selection.truncate_at_lane_end(observations, low, spec.touch_margin, spec.axis) if spec.truncate_at_lane_end else observations
    tails = None
    if spec.quality_window:
        window = selection.quality_window(rows, spec.window_points, spec.window_extent, spec.window_least)
        if spec.long_vehicles:
            tails = selection.tail_candidates(rows.join(long, TRACK, "left_semi"), spec.axis).select(*TRACK, "frame_id")
            window = selection.with_tails(window, rows, tails, spec.window_points, spec.window_extent)
        rows = window
    pick = lambda of, method: selection.select(of, method, spec.use_all_frames, spec.top_k, spec.keep, spec.bins, line, spec.touch_margin, spec.axis)
    instead = selection.long_vehicle_method(spec.selection, spec.use_all_frames)
    if spec.long_vehicles and instead != spec.selection:
        chosen = pick(rows.join(long, TRACK, "left_anti"), spec.selection).unionByName(pick(rows.join(long, TRACK, "left_semi"), instead))
    else:
        chosen = pick(rows, spec.selection)
    if spec.long_vehicles:
        chosen = selection.with_coverage(chosen, rows, long, rows.select(*TRACK, "frame_id").where("false") if tails is None else tails, axis=spec.axis)
    if spec.shape_ratio > 0:
        chosen = selection.shape_consistent(chosen, spec.shape_ratio)
    return chosen, tails


def accumulate(labelled: DataFrame, observations: DataFrame, members: DataFrame, quality: DataFrame, spec: Spec, keep: Keep | None = None, links: DataFrame | None = None) -> DataFrame:
    """The fused cloud of each track: choose frames, bring their points together, fuse, clean, bridge, cap, complete.

    ``links``: their rears and fragments, where long, take chunks back that registration rejected.
    """
    keep = keep or scratch(labelled.sparkSession)
    long = quality.where("is_long_vehicle").select(*TRACK)
    chosen, tails = chosen_frames(observations, long, spec)
    chosen = keep("chosen", chosen)
    keys = chosen.select(*TRACK, "frame_id", *[F.col(f"c{a}").alias(f"__c{a}") for a in "xyz"]).join(members, [*TRACK, "frame_id"])
    chunk = labelled.withColumnRenamed("frame_index", "frame_id").join(keys, ["seq_id", "frame_id", "label"])
    if spec.deskew and "point_timestamp_ns" in chunk.columns:
        chunk = fusion.deskew(chunk.withColumnRenamed("point_timestamp_ns", "point_ns"), observations, least_speed=spec.metre)
    at = (lambda a: F.col(a).cast("double")) if spec.save_world else (lambda a: F.col(a) - F.col(f"__c{a}"))
    local = chunk.select("seq_id", "track_id", "frame_id", *[at(a).alias(a) for a in "xyz"], F.col("intensity").cast("double").alias("intensity"))
    local = fusion.voxel_mean(local, [*TRACK, "frame_id"], spec.chunk_voxel).select(*TRACK, "frame_id", "x", "y", "z", "intensity")
    weights = None
    if spec.accumulator == "registration_voxel_fusion":
        moved = keep("registered", registration.register(local, spec.registration))
        if spec.underfill_fallback:
            moved = registration.fill_up(moved, local, spec.underfill_chunks)
        if spec.long_vehicles:
            nothing = chosen.select(*TRACK, "frame_id").where("false")
            rears = nothing.select(*TRACK) if links is None else links.where("role IN ('rear', 'fragment')").select(*TRACK).distinct()
            tails = nothing if tails is None else tails
            moved = registration.restore_rejected(moved, local.join(long, TRACK, "left_semi"), rears, tails)
        weights = moved.groupBy(*TRACK, "frame_id").agg(F.first("weight").alias("weight"))
        local = moved.drop("weight", "registration")
    elif spec.accumulator == "weighted_voxel_fusion":
        weights = fusion.chunk_weights(chosen, spec.weights, quality)
    consensus = spec.consensus_ratio if spec.accumulator == "occupancy_consensus_fusion" else None
    cloud = fusion.fuse(local, spec.fusion_voxel, weights, spec.min_observations, consensus, "weight" if weights is not None else "uniform")
    cloud = cloud.select(*TRACK, "x", "y", "z", "intensity", "confidence")
    if spec.outlier_neighbours > 0:
        cloud = fusion.remove_outliers(cloud, spec.outlier_neighbours, spec.outlier_ratio, keep)
    if spec.tail_bridge and spec.long_vehicles:
        cloud = cloud.join(long, TRACK, "left_anti").unionByName(bridged(cloud.join(long, TRACK, "left_semi"), spec, keep))
    cloud = fusion.revoxelise(cloud, spec.aggregate_voxel)
    if spec.cap_points > 0:
        cloud = fusion.confidence_cap(cloud, spec.cap_points, spec.cap_bins, spec.axis)
    return fusion.complete_symmetry(cloud, spec.aggregate_voxel, spec.axis) if spec.symmetry else cloud


def run(points: DataFrame, spec: Spec, frames: DataFrame | None = None, keep: Keep | None = None) -> dict[str, DataFrame]:
    """All tables of a run: detections, states, observations, tracks, links, quality, clouds, results.

    ``keep`` stores a named table and gives it back; every stage is built from
    the stored tables before it. Left out: the cluster's shared folder.
    Trackers step on each of ``frames`` (seq_id, frame_index), those in which
    nothing is detected too; left out: on each frame that has points.
    """
    keep = keep or scratch(points.sparkSession)
    if frames is None:
        frames = points.select("seq_id", "frame_index").distinct()
    labelled = keep("labelled", cluster(points, spec, keep))
    found = keep("detections", clustering.detections(labelled, spec.vehicle_min_points, spec.vehicle_max_points))
    states = keep("states", tracking.track(found, spec.tracker, frames))
    observations, members, tracks, links = post_process(observed(found, states), tracking.tracks(states), spec, keep)
    observations, tracks, links = keep("observations", observations), keep("tracks", tracks), keep("links", links)
    quality = keep("quality", postprocess.quality(observations, tracks, spec.axis, spec.long_length))
    clouds = keep("clouds", accumulate(labelled, observations, members, quality, spec, keep, links))
    sized = fusion.dimensions(clouds, spec.axis)
    low = spec.box.bounds(spec.axis)[0]
    gone = fusion.exited(observations, tracks, low, spec.exit_margin, spec.axis).join(quality.select(*TRACK, "quality_score", "is_long_vehicle"), TRACK, "left")
    threshold = F.when(F.col("is_long_vehicle") & F.lit(spec.long_vehicles), spec.min_quality_long).otherwise(spec.min_quality)
    results = keep("results", fusion.decide(gone, sized, spec.min_track_hits, spec.min_saved_points, threshold, spec.require_exit))
    if spec.long_vehicles and not links.isEmpty():
        # Tracks too short for a cloud of their own have none to give.
        candidates = clouds.join(results.where("status <> 'skipped_min_hits'").select(*TRACK), TRACK, "left_semi")
        clouds, results = groups.merge_long_vehicles(
            candidates, observations, tracks, quality, links, results, keep, clearance=max(0.05 * spec.metre, spec.aggregate_voxel, spec.fusion_voxel), neighbours=spec.outlier_neighbours, ratio=spec.outlier_ratio,
            voxel=max(0.04 * spec.metre, 0.75 * spec.aggregate_voxel), bridge=(lambda cloud: bridged(cloud.drop("vx", "vy", "vz"), spec, keep)) if spec.tail_bridge else None, lane_end=low, margin=spec.exit_margin,
            least_points=spec.min_saved_points, least_quality=spec.min_quality_long, require_exit=spec.require_exit, save_world=spec.save_world, axis=spec.axis,
        )
    return {"detections": found, "states": states, "observations": observations, "tracks": tracks, "links": links, "quality": quality, "clouds": clouds, "results": results}
