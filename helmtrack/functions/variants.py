"""Variants of centre trajectories and their distances from a true one: numpy kernels over blocks (rows, steps)."""

from __future__ import annotations

import numpy as np

from helmtrack.functions import kinematics as kin
from helmtrack.functions import profiles

#: Weights of a variant's ends along and across, mean offset across, mean distance, shape and heading.
ALONG, ACROSS, SIDEWAYS, MEAN, SHAPE, HEADING = 0.55, 2.4, 1.8, 0.8, 1.0, 1.2
#: Fixed value: weight of the way along in the distance of ends.
END_ALONG = 0.35

MEASURES = ("end_distance", "end_along", "end_across", "mean_distance", "shape_distance", "side_mean", "side_most", "side_shape", "heading")


def at_times(path: np.ndarray, horizon: np.ndarray, steps: int) -> np.ndarray:
    """Each row's first ``horizon`` values drawn out evenly to so many steps."""
    place = (horizon[:, None] - 1) * np.linspace(0.0, 1.0, steps)
    low = np.minimum(np.floor(place).astype(int), np.maximum(horizon[:, None] - 2, 0))
    a, b = np.take_along_axis(path, low, 1), np.take_along_axis(path, np.minimum(low + 1, horizon[:, None] - 1), 1)
    return a + (b - a) * (place - low)


def sign_sequences(curvature: np.ndarray, threshold: float, least: int) -> list[list[int]]:
    """Signs of the runs of at least so many values at or beyond the threshold, without repeats, for each row."""
    n, steps = curvature.shape
    if not n:
        return []
    sign = np.where(curvature >= threshold, 1, np.where(curvature <= -threshold, -1, 0)).ravel()
    edge = np.flatnonzero(np.concatenate([[True], (sign[1:] != sign[:-1]) | (np.arange(1, len(sign)) % steps == 0)]))
    size = np.diff(np.append(edge, len(sign)))
    good = (sign[edge] != 0) & (size >= least)
    row, kept = edge[good] // steps, sign[edge[good]]
    fresh = np.ones(len(kept), bool)
    fresh[1:] = (row[1:] != row[:-1]) | (kept[1:] != kept[:-1])
    ends = np.searchsorted(row[fresh], np.arange(n), "right")
    values = kept[fresh].tolist()
    return [values[a:b] for a, b in zip([0, *ends[:-1].tolist()], ends.tolist())]


def curvature(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return kin.dynamics(x, y)[3]


def measured(x: np.ndarray, y: np.ndarray, refs: list, share: np.ndarray) -> tuple[dict, np.ndarray, np.ndarray]:
    """Distances of variants (targets, variants, steps) from the reference of their target (of ``refs``: horizons, x, y; horizon 0 is none) for
    which their weighted sum is least, the first of equal ones; that sum; and its horizon. ``share`` is the true way's length, 1 at least, for each
    point. What depends on the target alone is worked out once for all of its variants."""
    even = np.arange(1, x.shape[2] + 1) / x.shape[2]
    rx, ry = x - even * x[..., -1:], y - even * y[..., -1:]
    vx, vy = np.diff(x, axis=2, prepend=0.0), np.diff(y, axis=2, prepend=0.0)
    speed = np.hypot(vx, vy)
    best, horizon = np.full(x.shape[:2], np.inf), np.zeros(x.shape[:2], np.int64)
    found = {m: np.full(x.shape[:2], np.inf) for m in MEASURES}
    for h, gx, gy in refs:
        (tx, ty), (qx, qy), (hx, hy) = profiles.tangents(gx, gy), profiles.residual(gx, gy), kin.steps_from_origin(gx, gy)
        own = np.hypot(hx, hy)[:, None]
        gx, gy, tx, ty, qx, qy, hx, hy = (v[:, None] for v in (gx, gy, tx, ty, qx, qy, hx, hy))
        dx, dy, sx, sy = x - gx, y - gy, rx - qx, ry - qy
        across = np.abs(dy * tx - dx * ty)
        now = {"end_along": np.abs(dx[..., -1] * tx[..., -1] + dy[..., -1] * ty[..., -1]), "end_across": across[..., -1]}
        now |= {"side_mean": across.mean(2), "side_most": across.max(2), "side_shape": np.abs(sy * tx - sx * ty).mean(2)}
        now["end_distance"] = np.hypot(END_ALONG * now["end_along"], now["end_across"])
        now["mean_distance"], now["shape_distance"] = np.hypot(dx, dy).mean(2), np.hypot(sx, sy).mean(2)
        moving = (speed > 1e-3) & (own > 1e-3)
        cosine = np.clip((vx * hx + vy * hy) / np.maximum(speed * own, 1e-6), -1.0, 1.0)
        now["heading"] = ((1 - cosine) * moving).sum(2) / np.maximum(moving.sum(2), 1)
        score = ALONG * now["end_along"] + ACROSS * now["end_across"] + SIDEWAYS * now["side_mean"] + MEAN * now["mean_distance"] + SHAPE * now["shape_distance"] + HEADING * now["heading"] * share[:, None]
        better = (score < best) & (h > 0)[:, None]
        best, horizon = np.where(better, score, best), np.where(better, h[:, None], horizon)
        for m in MEASURES:
            found[m] = np.where(better, now[m], found[m])
    return found, best, horizon
