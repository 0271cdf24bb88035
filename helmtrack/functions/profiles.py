"""Edits, diagnostics and shapes of trajectories: numpy kernels over blocks (rows, steps) for ``kinematics.with_kernel``."""

from __future__ import annotations

import numpy as np

from helmtrack.functions import kinematics as kin
from helmtrack.functions import resample

#: Limits of generated trajectories (speed m/s, step m, acceleration m/s2, jerk m/s3, curvature 1/m), the
#: end's tolerance and the greatest change of a point (m).
LIMITS = {"speed": 15.0, "step": 1.5, "low": -6.0, "high": 2.0, "jerk": 80.0, "curvature": 1.0, "end": 0.25, "change": 6.0}
#: Acceleration and jerk of a rough speed curve; mean difference from a true one that excuses it,
#: unless it is rough by the factor.
ROUGH_ACCEL, ROUGH_JERK, LIKE_TRUTH, VERY_ROUGH = 12.0, 80.0, 3.0, 4.0


def smoothed(v: np.ndarray, passes: int) -> np.ndarray:
    """Weights 1 2 3 2 1 over 9 with repeated edges; what isn't finite counts as 0; short rows stay."""
    out = np.where(np.isfinite(v), v, 0.0)
    n = out.shape[1]
    if n < 5:
        return out
    for _ in range(passes):
        padded = np.pad(out, ((0, 0), (2, 2)), mode="edge")
        out = sum(w * padded[:, i : i + n] for i, w in enumerate((1, 2, 3, 2, 1))) / 9.0
    return out


def inside_smoothed(v: np.ndarray, passes: int, side: float = 0.2) -> np.ndarray:
    """Each inner value with ``side`` of both neighbours; the ends stay; rows of fewer than six values too."""
    out = v.copy()
    for _ in range(passes if v.shape[1] >= 6 else 0):
        out[:, 1:-1] = side * (out[:, :-2] + out[:, 2:]) + (1 - 2 * side) * out[:, 1:-1]
    return out


def smooth_dynamics(x: np.ndarray, y: np.ndarray, speed_passes: int = 1, accel_passes: int = 2, curvature_passes: int = 1) -> tuple:
    """Speed, then smoothed; its differences as acceleration, then smoothed; and the smoothed curvature."""
    raw, _, _, bend = kin.dynamics(x, y)
    speed = smoothed(raw, speed_passes)
    accel = smoothed(np.diff(speed, axis=1, prepend=speed[:, :1]) / kin.DT, accel_passes)
    return speed, accel, smoothed(bend, curvature_passes)


def dynamic_feature(x: np.ndarray, y: np.ndarray) -> tuple:
    """Smoothed acceleration, then smoothed curvature, in one array."""
    _, accel, bend = smooth_dynamics(x, y)
    return (np.concatenate([accel, bend], axis=1),)


def profile_speed(x, y, vx=None, vy=None, vz=None) -> np.ndarray:
    """Speed of the velocity columns where they are there and finite throughout a row, else of the points."""
    steps = kin.scalar_profile(x, y)[1]
    if vx is None or vy is None or vz is None:
        return steps
    parts = np.stack([vx, vy, vz])
    return np.where(np.isfinite(parts).all((0, 2))[:, None], np.sqrt((parts**2).sum(0)), steps)


def by_speed(x: np.ndarray, y: np.ndarray, speed: np.ndarray) -> tuple:
    """The same path to the same end, its points as dense as an edited speed profile has them. NaN where profile or path
    have no way."""
    way = np.cumsum(np.clip(speed, 0.0, kin.SPEED_MAX) * kin.DT, axis=1)
    total = np.hypot(*kin.steps_from_origin(x, y)).sum(1)
    good = np.isfinite(way).all(1) & (way[:, -1] > 1e-6) & (total > 1e-6) & (x.shape[1] > 1)
    share = np.where(good[:, None], way, 1.0) / np.where(good, way[:, -1], 1.0)[:, None]
    px, py = (np.concatenate([np.zeros((len(v), 1)), v], axis=1) for v in (x, y))
    gone = np.concatenate([np.zeros((len(x), 1)), np.cumsum(resample.lengths(x, y), axis=1)], axis=1)
    out = [resample.along(gone, v, np.clip(share, 0.0, 1.0) * total[:, None]) for v in (px, py)]
    return tuple(np.where(good[:, None], v, np.nan) for v in out)


def keyframes(steps: int, interval: int = 8, with_start: bool = False) -> list[int]:
    """Every ``interval``-th frame, and the last."""
    if steps <= 0:
        return []
    interval = max(1, interval)
    return sorted({*range(0 if with_start else min(interval, steps - 1), steps, interval), steps - 1})


def dragged(x: np.ndarray, y: np.ndarray, frame: np.ndarray, to_x: np.ndarray, to_y: np.ndarray, radius: float = 10.0, lock_start: bool = True) -> tuple:
    """One frame moved to a point; its neighbours follow by a bell curve over frames. A locked start stays. Rows
    whose target isn't finite stay."""
    n = x.shape[1]
    at = np.clip(frame.astype(int), 0, n - 1)
    rows = np.arange(len(x))
    weight = np.exp(-0.5 * ((np.arange(n) - at[:, None]) / max(1.0, radius)) ** 2)
    if lock_start:
        weight[:, 0] = 0.0
    out = []
    finite = np.isfinite(to_x) & np.isfinite(to_y)
    for v, to in ((x, to_x), (y, to_y)):
        moved = v + weight * np.where(finite, to - v[rows, at], 0.0)[:, None]
        moved[rows, at] = np.where(finite & ~(lock_start & (at == 0)), to, v[rows, at])
        out.append(moved)
    return tuple(out)


def rough_speed(speed: np.ndarray, truth: np.ndarray | None = None) -> tuple:
    """1 for smooth speed curves, greatest acceleration, greatest jerk. Fewer than four values or any that isn't
    finite: not smooth. A rough curve that is like the true one is excused, if it isn't very rough."""
    good = np.isfinite(speed).all(1) & (speed.shape[1] >= 4)
    accel = np.diff(np.where(good[:, None], speed, 0.0), axis=1) / kin.DT
    jerk = np.diff(accel, axis=1) / kin.DT
    most = [np.abs(v).max(1, initial=0.0) for v in (accel, jerk)]
    over = lambda f: (most[0] > ROUGH_ACCEL * f) | (most[1] > ROUGH_JERK * f)
    like = np.zeros(len(speed), bool)
    if truth is not None and truth.shape[1] >= 2:
        place = np.linspace(0, 1, speed.shape[1])
        spread = np.stack([np.interp(place, np.linspace(0, 1, truth.shape[1]), t) for t in truth]) if len(truth) else truth
        like = np.isfinite(truth).all(1) & (np.abs(speed - spread).mean(1) <= LIKE_TRUTH)
    return (good & (~over(1.0) | (like & ~over(VERY_ROUGH)))).astype(float), *most


def violations(x: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
    """Which frames go beyond which limit."""
    step, speed, accel, jerk = kin.scalar_profile(x, y)
    bend = kin.dynamics(x, y)[3]
    return {
        "speed": speed > LIMITS["speed"],
        "step": step > LIMITS["step"],
        "acceleration": (accel > LIMITS["high"]) | (accel < LIMITS["low"]),
        "jerk": np.abs(jerk) > LIMITS["jerk"],
        "curvature": np.abs(bend) > LIMITS["curvature"],
    }


def quality(x: np.ndarray, y: np.ndarray) -> tuple:
    """1 for rows without bad accelerations or jumps, then how many frames have each."""
    found = violations(x, y)
    bad, jumps = found["acceleration"].sum(1), (found["step"] | found["speed"]).sum(1)
    return ((bad + jumps) == 0).astype(float), bad.astype(float), jumps.astype(float)


def violation_score(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Weighted excess of each extreme over its limit, plus the number of violations."""
    step, speed, accel, jerk = kin.scalar_profile(x, y)
    bend = np.abs(kin.dynamics(x, y)[3]).max(1)
    extremes = ((speed.max(1), "speed", 10), (step.max(1), "step", 10), (accel.max(1), "high", 5), (accel.min(1), "low", 5), (np.abs(jerk).max(1), "jerk", 2), (bend, "curvature", 8))
    excess = sum(w * np.maximum(0.0, v / LIMITS[name] - 1.0) for v, name, w in extremes)
    return excess + sum(v.sum(1) for v in violations(x, y).values())


def optimised(x: np.ndarray, y: np.ndarray, passes: int = 24) -> tuple:
    """Rows within the limits stay. Others are smoothed by 0 to ``passes`` passes and slowed to the acceleration limits, the end kept, all of
    these at once: the first that breaks no limit is taken, else the best score, in which points moved too far count, if it is below that of
    the row as it is. Third, 1 where the result is within the limits."""
    clean = lambda u, v: ~np.any([f.any(1) for f in violations(u, v).values()], axis=0)
    out = [x.copy(), y.copy()]
    rows = np.flatnonzero(~clean(x, y))
    if len(rows) and x.shape[1] > 1:
        tries = passes + 1
        shape = [np.stack([inside_smoothed(v[rows], n) for n in range(tries)]).reshape(tries * len(rows), -1) for v in (x, y)]
        slowed = resample.limited_resample(*shape)
        tried = [np.where(np.isfinite(slowed[0]).all(1)[:, None], s, g) for s, g in zip(slowed, shape)]
        for t, v in zip(tried, (x, y)):
            t[:, -1] = np.tile(v[rows, -1], tries)
        moved = np.hypot(*(t - np.tile(v[rows], (tries, 1)) for t, v in zip(tried, (x, y)))).max(1)
        score = (violation_score(*tried) + 2.0 * np.maximum(0.0, moved - LIMITS["change"])).reshape(tries, -1)
        fine = clean(*tried).reshape(tries, -1)
        pick = np.where(fine.any(0), fine.argmax(0), score.argmin(0))
        each = np.arange(len(rows))
        better = fine.any(0) | (score[pick, each] < violation_score(x[rows], y[rows]))
        for o, t in zip(out, tried):
            o[rows[better]] = t.reshape(tries, len(rows), -1)[pick[better], each[better]]
    return out[0], out[1], clean(*out).astype(float)


def transformed(x: np.ndarray, y: np.ndarray, speed: np.ndarray, ramp: np.ndarray, bend: np.ndarray) -> tuple:
    """A centre driven faster by a factor that rises along the way by ``ramp``, its turning scaled by ``bend``."""
    dx, dy = kin.steps_from_origin(x, y)
    step = np.hypot(dx, dy)
    yaw = kin.headings(dx, dy, step > 1e-4)
    place = np.linspace(-0.5, 0.5, x.shape[1])
    ahead = step * np.maximum(0.05, speed[:, None] * (1 + ramp[:, None] * place))
    turn = yaw[:, :1] + bend[:, None] * (yaw - yaw[:, :1])
    return np.cumsum(ahead * np.cos(turn), axis=1), np.cumsum(ahead * np.sin(turn), axis=1)


def residual(x: np.ndarray, y: np.ndarray) -> tuple:
    """What is left of each point without the even way to the end."""
    share = np.arange(1, x.shape[1] + 1) / x.shape[1]
    return x - share * x[:, -1:], y - share * y[:, -1:]


def tangents(x: np.ndarray, y: np.ndarray) -> tuple:
    """Unit tangents from the point before to the one after; where these hardly differ, as before (at first, as
    after); (1, 0) in rows that never move. A normal is (-ty, tx)."""
    after, before = ([np.concatenate([v[:, 1:], v[:, -1:]], 1) for v in (x, y)], [np.concatenate([np.zeros((len(v), 1)), v[:, :-1]], 1) for v in (x, y)])
    tx, ty = after[0] - before[0], after[1] - before[1]
    norm = np.hypot(tx, ty)
    moving = norm > 1e-4
    last = np.maximum.accumulate(np.where(moving, np.arange(x.shape[1]), -1), axis=1)
    at = np.where(last < 0, moving.argmax(1)[:, None], last)
    any_ = moving.any(1)[:, None]
    size = np.maximum(np.take_along_axis(norm, at, 1), 1e-6)
    return np.where(any_, np.take_along_axis(tx, at, 1) / size, 1.0), np.where(any_, np.take_along_axis(ty, at, 1) / size, 0.0)


def heading_error(x: np.ndarray, y: np.ndarray, true_x: np.ndarray, true_y: np.ndarray) -> tuple:
    """The mean of 1 - cos of the angle between steps, over steps in which both move."""
    (dx, dy), (gx, gy) = kin.steps_from_origin(x, y), kin.steps_from_origin(true_x, true_y)
    a, b = np.hypot(dx, dy), np.hypot(gx, gy)
    moving = (a > 1e-3) & (b > 1e-3)
    cosine = np.clip((dx * gx + dy * gy) / np.maximum(a * b, 1e-6), -1.0, 1.0)
    return (((1 - cosine) * moving).sum(1) / np.maximum(moving.sum(1), 1),)


def aligned(x: np.ndarray, y: np.ndarray) -> tuple:
    """From the first point, along the initial motion: the way to the first of the next seven points that is over 0.25
    away, else to the last point, else as it is."""
    dx, dy = x - x[:, :1], y - y[:, :1]
    way = np.hypot(dx, dy)
    probe = way[:, :8] > 0.25
    at = np.where(probe.any(1), probe.argmax(1), x.shape[1] - 1)
    rows = np.arange(len(x))
    size = way[rows, at]
    still = size <= 1e-6
    ux, uy = (np.where(still, other, v[rows, at] / np.where(still, 1.0, size))[:, None] for v, other in ((dx, 1.0), (dy, 0.0)))
    return dx * ux + dy * uy, dy * ux - dx * uy


def shape_stats(x: np.ndarray, y: np.ndarray) -> tuple:
    """End, widest lateral, signed lateral area by trapezoids, and the heading of the last few points."""
    tail = max(2, min(5, x.shape[1]))
    dx, dy = (v[:, -1] - v[:, -tail] for v in (x, y)) if x.shape[1] >= tail else (np.zeros(len(x)),) * 2
    area = ((x[:, 1:] - x[:, :-1]) * (y[:, 1:] + y[:, :-1]) / 2).sum(1)
    return x[:, -1], y[:, -1], np.abs(y).max(1), area, np.where(np.hypot(dx, dy) > 1e-6, np.arctan2(dy, dx), 0.0)


def thinned(v: np.ndarray, points: int) -> np.ndarray:
    """So many evenly placed values of each row; halves go to the even place."""
    return v if v.shape[1] <= points else v[:, np.round(np.linspace(0, v.shape[1] - 1, points)).astype(int)]


def at_fraction(x: np.ndarray, y: np.ndarray, fraction: np.ndarray) -> tuple:
    """The point at a share of each row's own length (from its first point)."""
    gone = np.concatenate([np.zeros((len(x), 1)), np.cumsum(resample.lengths(x, y, origin=False), axis=1)], axis=1)
    want = (np.clip(fraction, 0.0, 1.0) * gone[:, -1])[:, None]
    return tuple(np.where(gone[:, -1] > 1e-6, resample.along(gone, v, want)[:, 0], v[:, 0]) for v in (x, y))


def nearest_fraction(x: np.ndarray, y: np.ndarray, to_x: np.ndarray, to_y: np.ndarray) -> tuple:
    """The share of the length at which each row's path comes nearest to a point; the first of equally near ones."""
    dx, dy = np.diff(x), np.diff(y)
    size = np.hypot(dx, dy)
    lengths = np.insert(np.cumsum(size, axis=1), 0, 0.0, axis=1)
    usable = size > 1e-6
    along = ((to_x[:, None] - x[:, :-1]) * dx + (to_y[:, None] - y[:, :-1]) * dy) / np.where(usable, size**2, 1.0)
    t = np.clip(along, 0.0, 1.0)
    off = np.hypot(to_x[:, None] - x[:, :-1] - t * dx, to_y[:, None] - y[:, :-1] - t * dy)
    at = np.where(usable, off, np.inf).argmin(1)
    rows = np.arange(len(x))
    total = lengths[:, -1]
    return (np.where(total > 1e-6, (lengths[rows, at] + t[rows, at] * size[rows, at]) / np.where(total > 1e-6, total, 1.0), 0.0),)
