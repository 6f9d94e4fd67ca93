"""Groups of linked tracks (the parts of one long vehicle): their clouds become one, which passes the gates again.

Everything is a grouping or a join on (seq_id, track): only the row of edges by
member, one for each track of a group, comes together in one place.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.scratch import Keep
from . import fusion, postprocess
from .tiles import components

TRACK = ["seq_id", "track_id"]
MERGED = "merged_into_long_vehicle_group"


def link_groups(links: DataFrame, keep: Keep | None = None) -> DataFrame:
    """(seq_id, track_id, group_id, role, gap_mean) of tracks that links join, over any number of links.

    ``links``: as ``postprocess.link_states`` gives them. A track that follows
    another anywhere is a rear (or fragment); the group has the id of its least
    track that only leads.
    """
    found = components(links.select("seq_id", F.col("track_id").alias("a"), F.col("partner_id").alias("b")), ["seq_id"], keep)
    has = lambda role: F.count_if(F.col("role") == role) > 0
    gap = F.max(F.when(F.col("role") != "lead", F.col("gap_mean"))) if "gap_mean" in links.columns else F.lit(None).cast("double")
    roles = links.groupBy(*TRACK).agg(F.when(has("rear"), "rear").when(has("fragment"), "fragment").otherwise("lead").alias("role"), gap.alias("gap_mean"))
    rows = roles.join(found.select("seq_id", F.col("node").cast("int").alias("track_id"), "component"), TRACK)
    whole = Window.partitionBy("seq_id", "component")
    group = F.coalesce(F.min(F.when(F.col("role") == "lead", F.col("track_id"))).over(whole), F.min("track_id").over(whole))
    return rows.select(*TRACK, group.alias("group_id"), "role", "gap_mean")


def shifts(world: DataFrame, groups: DataFrame, direction: DataFrame, clearance: float, axis: str = "y") -> DataFrame:
    """(seq_id, track_id, group_id, role, shift) of the members with points, of groups whose lead and one more have some.

    From the lead backwards each rear that reaches into what is ahead of it is
    moved behind it, by its gap (0 at least) and the clearance; other parts stay.
    """
    edges = world.groupBy(*TRACK).agg(F.min(axis).alias("low"), F.max(axis).alias("high"))
    rows = groups.join(edges, TRACK).join(direction.select("seq_id", F.col("track_id").alias("group_id"), "direction"), ["seq_id", "group_id"])
    # Along the motion: front is the larger end.
    ahead = F.col("direction") > 0
    front, back = F.when(ahead, F.col("high")).otherwise(-F.col("low")), F.when(ahead, F.col("low")).otherwise(-F.col("high"))
    part = F.struct((F.col("track_id") != F.col("group_id")).alias("follows"), (-front).alias("place"), "track_id", "role", front.alias("front"), back.alias("back"), F.greatest(F.coalesce("gap_mean", F.lit(0.0)), F.lit(0.0)).alias("gap"))
    whole = rows.groupBy("seq_id", "group_id", "direction").agg(F.sort_array(F.collect_list(part)).alias("parts")).where((F.size("parts") >= 2) & ~F.col("parts")[0]["follows"])
    none = F.array().cast("array<struct<track_id:int,role:string,move:double>>")

    def step(state, x):
        moves = (x["role"] == "rear") & x["follows"]
        move = F.when(moves, F.least(F.lit(0.0), state["behind"] - x["gap"] - clearance - x["front"])).otherwise(F.lit(0.0))
        behind = F.when(~x["follows"], x["back"]).when(moves, F.least(state["behind"], x["back"] + move)).otherwise(state["behind"])
        done = F.struct(x["track_id"].cast("int").alias("track_id"), x["role"].alias("role"), move.alias("move"))
        return F.struct(behind.alias("behind"), F.concat(state["done"], F.array(done)).alias("done"))

    start = F.struct(F.lit(0.0).cast("double").alias("behind"), none.alias("done"))
    moved = whole.select("seq_id", "group_id", "direction", F.explode(F.aggregate("parts", start, step)["done"]).alias("p"))
    return moved.select("seq_id", "p.track_id", "group_id", "p.role", (F.col("p.move") * F.col("direction")).alias("shift"))


def merged_clouds(world: DataFrame, moves: DataFrame, neighbours: int, ratio: float, voxel: float, keep: Keep, axis: str = "y") -> DataFrame:
    """One cloud a group under the group's id, in the world: members shifted and put together, outliers removed, voxelised again."""
    own = world.join(moves.select(*TRACK, "group_id", "shift"), TRACK)
    cloud = own.withColumn(axis, F.col(axis) + F.col("shift")).withColumn("track_id", F.col("group_id")).drop("group_id", "shift")
    if neighbours > 0:
        few = max(6, neighbours // 2)
        cloud = fusion.remove_outliers(cloud, few, 1.25 * ratio, keep, least=few)
    return fusion.revoxelise(cloud, voxel)


def group_tracks(observations: DataFrame, tracks: DataFrame, quality: DataFrame, moves: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(observations, tracks) of the groups: frames joined, the greatest age and quality, the fewest misses."""
    mapping = moves.select(*TRACK, F.col("group_id").alias("new_id"))
    rows = postprocess.merge_by_frame(observations, mapping)
    parts = tracks.join(mapping, TRACK).join(quality.select(*TRACK, "quality_score"), TRACK, "left")
    joined = parts.groupBy("seq_id", F.col("new_id").alias("track_id")).agg(
        F.max("age").alias("age"), F.min("missed").alias("missed"), F.bool_or("ended_by_missed").alias("ended_by_missed"), F.max(F.coalesce("quality_score", F.lit(0.0))).alias("quality_score"), F.array_sort(F.collect_set(parts["track_id"])).alias("members")
    )
    return rows, joined.join(rows.groupBy(*TRACK).agg(F.count("*").alias("hit_count")), TRACK)


def regate(results: DataFrame, tracks: DataFrame, clouds: DataFrame, moves: DataFrame, least_points: int, least_quality: float, require_exit: bool) -> DataFrame:
    """``results`` with the rows of groups decided again; members other than the lead are merged into it.

    ``tracks``: the groups' (with exited and quality_score), ``clouds``: theirs.
    """
    again = fusion.decide(tracks, fusion.dimensions(clouds), 0, least_points, least_quality, require_exit)
    again = again.select(*[F.col(c).alias(f"of_{c}") for c in TRACK], *[F.col(c).alias(f"new_{c}") for c in ("hit_count", "age", "missed", "ended_by_missed", "exited", "quality_score", "n_points", "status", "stage", "summary")])
    own = moves.select(*[F.col(c).alias(f"at_{c}") for c in TRACK], "group_id")
    rows = results.join(own, [F.col(c) == F.col(f"at_{c}") for c in TRACK], "left").join(again, [F.col(c) == F.col(f"of_{c}") for c in TRACK], "left")
    lead, member = F.col("of_track_id").isNotNull(), F.col("group_id").isNotNull() & F.col("of_track_id").isNull()
    text = F.format_string("track %04d: %s (track %04d)", "track_id", F.lit(MERGED), "group_id")
    new = {c: F.when(lead, F.col(f"new_{c}")).otherwise(F.col(c)) for c in ("hit_count", "age", "missed", "ended_by_missed", "exited", "quality_score") if c in results.columns}
    new |= {
        "n_points": F.when(lead, F.col("new_n_points")).when(member, F.lit(0).cast("long")).otherwise(F.col("n_points")),
        "status": F.when(member, MERGED).when(lead, F.col("new_status")).otherwise(F.col("status")),
        "stage": F.when(member, "merge").when(lead, F.col("new_stage")).otherwise(F.col("stage")),
        "summary": F.when(member, text).when(lead, F.col("new_summary")).otherwise(F.col("summary")),
    }
    return rows.select(*[new[c].alias(c) if c in new else F.col(c) for c in results.columns], F.when(lead | member, F.coalesce("group_id", "track_id")).alias("merged_target_track_id"))


def merge_long_vehicles(clouds: DataFrame, observations: DataFrame, tracks: DataFrame, quality: DataFrame, links: DataFrame, results: DataFrame, keep: Keep, *, clearance: float, neighbours: int, ratio: float, voxel: float, bridge=None, lane_end: float, margin: float, least_points: int, least_quality: float, require_exit: bool, save_world: bool = False, axis: str = "y") -> tuple[DataFrame, DataFrame]:
    """(clouds, results) after the groups of ``links`` were merged and decided again.

    A group's cloud stands under its lead's id, relative to the lead's front
    unless ``save_world``; its members' own clouds go. Groups of whose lead, or
    of all but one, there is no cloud stay as they are.
    """
    clouds = clouds.drop("vx", "vy", "vz")
    world = clouds if save_world else keep("world", fusion.candidate_world(clouds, observations))
    direction = postprocess.motion(observations, axis).select(*TRACK, "direction")
    moves = keep("moves", shifts(world, link_groups(links, keep), direction, clearance, axis))
    merged = merged_clouds(world, moves, neighbours, ratio, voxel, keep, axis)
    if bridge is not None:
        merged = bridge(merged)
    merged = keep("merged", merged.drop("vx", "vy", "vz"))
    rows, joined = group_tracks(observations, tracks, quality, moves)
    gone = fusion.exited(rows, joined, lane_end, margin, axis)
    decided = keep("regated", regate(results, gone, merged, moves, least_points, least_quality, require_exit))
    if not save_world:
        lead = moves.where("track_id = group_id").select(*TRACK)
        anchor = fusion.front_anchor(world.join(lead, TRACK, "left_semi"), direction, axis)
        merged = merged.join(anchor, TRACK).withColumns({a: F.col(a) - F.col(f"anchor_{a}") for a in "xyz"}).drop(*[f"anchor_{a}" for a in "xyz"])
    apart = clouds.join(moves.select(*TRACK), TRACK, "left_anti")
    return apart.unionByName(merged.select(*apart.columns)), decided
