"""Registration of a track's chunks to a growing model, in numpy, one track per grouped map."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TRACK = ["seq_id", "track_id"]


def valid_transform(m: np.ndarray, max_translation: float | None) -> bool:
    """4 x 4, finite, affine last row, a determinant of 0.001 to 5 in size, and a bounded translation."""
    m = np.asarray(m, float)
    if m.shape != (4, 4) or not np.isfinite(m).all() or not np.allclose(m[3], [0, 0, 0, 1], atol=1e-3):
        return False
    det = abs(np.linalg.det(m[:3, :3]))
    return 1e-3 <= det <= 5 and (max_translation is None or np.linalg.norm(m[:3, 3]) <= max_translation)


def apply(m: np.ndarray, p: np.ndarray) -> np.ndarray:
    out = p @ m[:3, :3].T + m[:3, 3]
    return out[np.isfinite(out).all(1)]


def downsample(p: np.ndarray, size: float) -> np.ndarray:
    if size <= 0 or not len(p):
        return p
    _, back, n = np.unique(np.floor(p / size).astype(np.int64), axis=0, return_inverse=True, return_counts=True)
    return np.stack([np.bincount(back.ravel(), p[:, k]) / n for k in range(3)], 1)


def nearest(p: np.ndarray, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index into q, distance) for each p, in blocks."""
    at, far = np.empty(len(p), int), np.empty(len(p))
    for k in range(0, len(p), 512):
        d = ((p[k : k + 512, None] - q[None]) ** 2).sum(2)
        at[k : k + 512] = d.argmin(1)
        far[k : k + 512] = np.sqrt(d.min(1))
    return at, far


def normals(p: np.ndarray, k: int = 12) -> tuple[np.ndarray, np.ndarray]:
    """(least axis, covariance) of each point's neighbourhood."""
    d = ((p[:, None] - p[None]) ** 2).sum(2)
    near = p[np.argsort(d, 1)[:, : min(k, len(p))]]
    centred = near - near.mean(1, keepdims=True)
    cov = np.einsum("nki,nkj->nij", centred, centred) / near.shape[1]
    return np.linalg.eigh(cov)[1][:, :, 0], cov


def exponential(xi: np.ndarray) -> np.ndarray:
    """Rigid motion of a small rotation vector and translation."""
    w, t = xi[:3], xi[3:]
    angle = np.linalg.norm(w)
    k = np.array([[0, -w[2], w[1]], [w[2], 0, -w[0]], [-w[1], w[0], 0]])
    r = np.eye(3) + k if angle < 1e-12 else np.eye(3) + np.sin(angle) / angle * k + (1 - np.cos(angle)) / angle**2 * k @ k
    m = np.eye(4)
    m[:3, :3], m[:3, 3] = r, t
    return m


def icp(source: np.ndarray, target: np.ndarray, reach: float, rounds: int, start: np.ndarray | None = None, generalised: bool = False) -> tuple[np.ndarray, float]:
    """(transform, share of source points with a partner within ``reach``): point to plane, or plane to plane."""
    m = np.eye(4) if start is None else start
    normal, cov_t = normals(target)
    if generalised:
        flat = lambda c: (lambda e: np.einsum("nik,k,njk->nij", e, np.array([1e-3, 1, 1]), e))(np.linalg.eigh(c)[1])
        cov_s, cov_t = flat(normals(source)[1]), flat(cov_t)
    for _ in range(rounds):
        p = source @ m[:3, :3].T + m[:3, 3]
        at, far = nearest(p, target)
        ok = far <= reach
        if ok.sum() < 6:
            break
        p, q = p[ok], target[at[ok]]
        # r(xi) = p - q + [-p]x w + t
        jac = np.zeros((len(p), 3, 6))
        jac[:, 0, 1], jac[:, 0, 2], jac[:, 1, 0], jac[:, 1, 2], jac[:, 2, 0], jac[:, 2, 1] = p[:, 2], -p[:, 1], -p[:, 2], p[:, 0], p[:, 1], -p[:, 0]
        jac[:, :, 3:] = np.eye(3)
        if generalised:
            weight = np.linalg.inv(cov_t[at[ok]] + m[:3, :3] @ cov_s[ok] @ m[:3, :3].T)
        else:
            n = normal[at[ok]]
            weight = n[:, :, None] * n[:, None, :]
        h = np.einsum("nki,nkl,nlj->ij", jac, weight, jac) + 1e-9 * np.eye(6)
        g = np.einsum("nki,nkl,nl->i", jac, weight, p - q)
        xi = -np.linalg.solve(h, g)
        m = exponential(xi) @ m
        if np.linalg.norm(xi) < 1e-7:
            break
    return m, float((nearest(source @ m[:3, :3].T + m[:3, 3], target)[1] <= reach).mean())


def rigid(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Least-squares rigid motion of paired points (Kabsch)."""
    u, _, v = np.linalg.svd((p - p.mean(0)).T @ (q - q.mean(0)))
    r = v.T @ np.diag([1, 1, np.sign(np.linalg.det(v.T @ u.T))]) @ u.T
    m = np.eye(4)
    m[:3, :3], m[:3, 3] = r, q.mean(0) - r @ p.mean(0)
    return m


def features(p: np.ndarray, radius: float) -> np.ndarray:
    """Point feature histograms: angles of neighbours' normals, weighted over the neighbourhood (Rusu et al. 2009)."""
    normal, _ = normals(p)
    normal = normal * np.sign(np.where((s := (normal * (p - p.mean(0))).sum(1)) == 0, 1, s))[:, None]
    d = np.linalg.norm(p[:, None] - p[None], axis=2)
    close = (d <= radius) & (d > 0)
    out = np.zeros((len(p), 33))
    for k in range(len(p)):
        other = np.flatnonzero(close[k])
        if not len(other):
            continue
        line = (p[other] - p[k]) / d[k, other][:, None]
        u = normal[k]
        v = np.cross(line, u)
        w = np.cross(u, v)
        for n, angle in enumerate(((v * normal[other]).sum(1), line @ u, np.arctan2((w * normal[other]).sum(1), normal[other] @ u) / np.pi)):
            out[k, 11 * n : 11 * n + 11] = np.histogram(angle, 11, (-1, 1))[0] / len(other)
    weight = np.where(close, 1 / np.maximum(d, 1e-9), 0)
    return out + weight @ out / np.maximum(close.sum(1), 1)[:, None]


def feature_match(source: np.ndarray, target: np.ndarray, reach: float, size: float, rounds: int = 400, seed: int = 0) -> np.ndarray:
    """Coarse transform from feature correspondences by RANSAC."""
    p, q = downsample(source, size), downsample(target, size)
    if len(p) < 4 or len(q) < 4:
        return np.eye(4)
    fp, fq = features(p, 5 * size), features(q, 5 * size)
    partner = ((fp[:, None] - fq[None]) ** 2).sum(2).argmin(1)
    rng, best = np.random.default_rng(seed), (np.eye(4), -1.0)
    for _ in range(rounds):
        pick = rng.choice(len(p), 3, replace=False)
        m = rigid(p[pick], q[partner[pick]])
        inside = float((np.linalg.norm(apply(m, p) - q[partner], axis=1) <= reach).mean())
        if inside > best[1]:
            best = m, inside
    return best[0]


@dataclass(frozen=True)
class RegistrationConfig:
    backend: str = "icp_point_to_plane"
    max_corr_dist: float = 0.95
    max_iter: int = 80
    min_fitness: float = 0.25
    max_translation: float = 3.2
    voxel: float = 0.12


def _point_to_plane(s, t, c):
    return icp(s, t, c.max_corr_dist, c.max_iter)


def _generalised(s, t, c):
    return icp(s, t, c.max_corr_dist, c.max_iter, generalised=True)


def _feature_then_local(s, t, c):
    return icp(s, t, c.max_corr_dist, c.max_iter, feature_match(s, t, c.max_corr_dist, c.voxel))


#: Backends; None: needs a package that may be absent, and chunks then pass unchanged as ``registration_skipped``.
BACKENDS: dict[str, Callable | None] = {
    "icp_point_to_plane": _point_to_plane, "generalized_icp": _generalised, "feature_global_then_local": _feature_then_local,
    "small_gicp": None, "kiss_matcher": None, "kiss_matcher_then_icp": None,
}


def align_chunks(chunks: list[np.ndarray], config: RegistrationConfig) -> list[tuple[int, np.ndarray, float, str]]:
    """(chunk, points, weight, status) of kept chunks: the first is the model, accepted ones join it."""
    if config.backend not in BACKENDS:
        raise ValueError(f"unknown registration backend {config.backend!r}")
    backend = BACKENDS[config.backend]
    if backend is None:
        return [(k, c, 1.0, "registration_skipped") for k, c in enumerate(chunks)]
    out, model = [(0, chunks[0], 1.0, "model")] if chunks else [], chunks[0] if chunks else None
    for k, chunk in enumerate(chunks[1:], 1):
        if len(chunk) < 8 or len(model) < 8:
            continue
        try:
            m, fitness = backend(downsample(chunk, config.voxel), model, config)
        except np.linalg.LinAlgError:
            continue
        if fitness < config.min_fitness or not valid_transform(m, config.max_translation):
            continue
        moved = apply(m, chunk)
        out.append((k, moved, max(0.1, fitness), "accepted"))
        model = downsample(np.vstack([model, moved]), max(0.03, config.voxel))
    return out


def register(chunk_points: DataFrame, config: RegistrationConfig) -> DataFrame:
    """Kept chunks' points moved onto the model of their track, with the chunk's weight and status."""
    out = "seq_id string, track_id int, frame_id int, x double, y double, z double, intensity double, weight double, registration string"

    def run(key, track: pd.DataFrame) -> pd.DataFrame:
        parts = [(f, part) for f, part in track.groupby("frame_id", sort=True)]
        rows = []
        for k, points, weight, status in align_chunks([p[["x", "y", "z"]].to_numpy(float) for _, p in parts], config):
            frame, part = parts[k]
            rows.append(pd.DataFrame({"seq_id": key[0], "track_id": key[1], "frame_id": frame, "x": points[:, 0], "y": points[:, 1], "z": points[:, 2], "intensity": part["intensity"].to_numpy(float), "weight": weight, "registration": status}))
        return pd.concat(rows) if rows else pd.DataFrame(columns=[c.split(" ")[0] for c in out.split(", ")])

    return chunk_points.groupBy(*TRACK).applyInPandas(run, out)


#: Weight of a rejected chunk that is used all the same.
REJECTED_WEIGHT = 0.35


def fill_up(kept: DataFrame, chunk_points: DataFrame, least: int) -> DataFrame:
    """Tracks of which registration kept fewer than ``least`` chunks, and not all, use all their chunks unmoved, weight 1.

    ``kept``: as ``register`` gives it; ``chunk_points``: its input.
    """
    n = chunk_points.groupBy(*TRACK).agg(F.countDistinct("frame_id").alias("n"))
    k = kept.groupBy(*TRACK).agg(F.countDistinct("frame_id").alias("k"), F.bool_or(F.col("registration") == "registration_skipped").alias("skipped"))
    low = n.join(k, TRACK, "left").where(~F.coalesce("skipped", F.lit(False)) & (F.coalesce("k", F.lit(0)) < F.lit(max(1, least))) & (F.coalesce("k", F.lit(0)) < F.col("n"))).select(*TRACK)
    all_ = chunk_points.select(*TRACK, "frame_id", *[F.col(a).cast("double").alias(a) for a in ("x", "y", "z", "intensity")], F.lit(1.0).alias("weight"), F.lit("fallback").alias("registration"))
    return kept.join(low, TRACK, "left_anti").unionByName(all_.join(low, TRACK, "left_semi"))


def restore_rejected(kept: DataFrame, chunk_points: DataFrame, rears: DataFrame, tails: DataFrame) -> DataFrame:
    """Rejected chunks come back unmoved with a low weight for rear and fragment tracks and where one of them is a tail candidate.

    ``rears``: (seq_id, track_id); ``tails``: (seq_id, track_id, frame_id).
    """
    frame = [*TRACK, "frame_id"]
    lost = chunk_points.join(kept.select(*frame).distinct(), frame, "left_anti")
    wanted = rears.select(*TRACK).union(lost.join(tails, frame, "left_semi").select(*TRACK)).distinct()
    back = lost.join(wanted, TRACK, "left_semi").select(*frame, *[F.col(a).cast("double").alias(a) for a in ("x", "y", "z", "intensity")], F.lit(REJECTED_WEIGHT).alias("weight"), F.lit("restored").alias("registration"))
    return kept.unionByName(back)
