"""Columns of output rows out of positions, speeds of histories and at the start, and edits of a speed curve: numpy kernels over blocks (rows, steps)."""

from __future__ import annotations

import numpy as np

from helmtrack.functions import profiles, resample

#: Step (s), speed under which a point stands, speed of a vehicle of which nothing is known and its ceiling, ceiling of
#: a first or last step's speed, steps of a mean, frames on either side of a local mean.
DT, STANDING, UNKNOWN, CEILING, STEP_CEILING, MEAN_STEPS, REACH = 0.1, 1e-3, 2.0, 12.0, 15.0, 5, 3
#: Passes over points and speeds of a history, passes of an edited curve, share of the bridge between two edits.
POINT_PASSES, SPEED_PASSES, EDIT_PASSES, BRIDGE = 2, 1, 2, 0.35


def _before(v: np.ndarray, first=0.0) -> np.ndarray:
    return np.concatenate([np.broadcast_to(np.asarray(first, float), (len(v), 1)) if np.ndim(first) == 0 else first, v[:, :-1]], axis=1)


def _carried(yaw: np.ndarray, moving: np.ndarray) -> np.ndarray:
    """Headings of standing points as before, at first as after; 0 in rows that never move."""
    last = np.maximum.accumulate(np.where(moving, np.arange(yaw.shape[1]), -1), axis=1)
    at = np.where(last < 0, moving.argmax(1)[:, None], last)
    return np.where(moving.any(1)[:, None], np.take_along_axis(yaw, at, 1), 0.0)


def components(x: np.ndarray, y: np.ndarray, z: np.ndarray) -> tuple:
    """vx, vy, vz from the origin on, qz, qw of the heading (qx and qy are 0), and the heading's gradient by frame as curvature. Headings are
    unwrapped, then carried over points that stand."""
    velocity = [(v - _before(v)) / DT for v in (x, y, z)]
    yaw = np.arctan2(velocity[1], velocity[0])
    if x.shape[1] > 1:
        yaw = _carried(np.unwrap(yaw, axis=1), np.hypot(velocity[0], velocity[1]) >= STANDING)
    bend = np.gradient(yaw, axis=1) if x.shape[1] > 1 else np.zeros_like(yaw)
    return *velocity, np.sin(yaw / 2), np.cos(yaw / 2), bend


def smooth_kinematics(x: np.ndarray, y: np.ndarray, z: np.ndarray, speed_passes: int = 1, accel_passes: int = 2, bend_passes: int = 1) -> tuple:
    """vx, vy, vz, ax, ay, az and curvature of frames: the first transition counts twice, velocities are smoothed, then their differences, then
    the heading's change by the way between points (the first is from the origin)."""
    velocity, accel = [], []
    for v in (x, y, z):
        raw = np.diff(v, axis=1, prepend=v[:, :1]) / DT
        if v.shape[1] > 1:
            raw[:, 0] = raw[:, 1]
        velocity.append(profiles.smoothed(raw, speed_passes) if speed_passes else np.where(np.isfinite(raw), raw, 0.0))
        accel.append(profiles.smoothed(np.diff(velocity[-1], axis=1, prepend=velocity[-1][:, :1]) / DT, accel_passes))
    moving = np.hypot(velocity[0], velocity[1]) > STANDING
    yaw = np.unwrap(_carried(np.arctan2(velocity[1], velocity[0]), moving), axis=1)
    way = np.hypot(x - _before(x), y - _before(y))
    bend = np.diff(yaw, axis=1, prepend=yaw[:, :1]) / np.maximum(way, 1e-6)
    bend[:, 0] = 0.0
    return *velocity, *accel, profiles.smoothed(np.where(np.isfinite(bend), bend, 0.0), bend_passes)


def inner_smoothed(v: np.ndarray, passes: int = POINT_PASSES) -> np.ndarray:
    """Weights 1 2 3 2 1 over 9 for all but two values at each end; rows of fewer than five stay. At least one pass."""
    out, n = v.copy(), v.shape[1]
    for _ in range(max(1, passes) if n >= 5 else 0):
        out[:, 2:-2] = sum(w * out[:, i : n - 4 + i] for i, w in enumerate((1, 2, 3, 2, 1))) / 9.0
    return out


def shown_speed(speed: np.ndarray, passes: int) -> np.ndarray:
    """A speed curve smoothed for show: at least one pass, never below 0; rows of fewer than five are only cut at 0."""
    return np.maximum(profiles.smoothed(speed, max(1, passes)) if speed.shape[1] >= 5 else speed, 0.0)


def history_speeds(x: np.ndarray, y: np.ndarray, z: np.ndarray) -> tuple:
    """The raw speed of each history frame (the first transition counts twice), and the one for show, of smoothed points and smoothed, whose last value
    is that of the smoothed points."""

    def raw(a, b, c):
        if a.shape[1] < 2:
            return np.zeros_like(a)
        step = np.sqrt(np.diff(a, axis=1) ** 2 + np.diff(b, axis=1) ** 2 + np.diff(c, axis=1) ** 2) / DT
        return np.concatenate([step[:, :1], step], axis=1)

    smooth = raw(*(inner_smoothed(v) for v in (x, y, z)))
    shown = shown_speed(smooth, SPEED_PASSES)
    shown[:, -1:] = smooth[:, -1:]
    return raw(x, y, z), shown


def history_start_speed(x: np.ndarray, y: np.ndarray, valid: np.ndarray) -> tuple:
    """The speed at the end of a history of valid points, smoothed for show, at most CEILING; UNKNOWN with fewer than two. ``valid`` is 1 or 0."""
    out = np.full(len(x), UNKNOWN)
    count = (valid > 0).sum(1)
    for n in np.unique(count[count >= 2]):
        rows = np.flatnonzero(count == n)
        a, b = (inner_smoothed(v[rows][valid[rows] > 0].reshape(len(rows), n)) for v in (x, y))
        step = np.hypot(a[:, -1] - a[:, -2], b[:, -1] - b[:, -2])
        out[rows] = np.where(np.isfinite(step), np.clip(step / DT, 0.0, CEILING), UNKNOWN)
    return (out,)


def first_step_speed(x: np.ndarray, y: np.ndarray) -> tuple:
    """The speed of the first future step, from the origin."""
    return (np.clip(np.hypot(x[:, 0], y[:, 0]) / DT, 0.0, STEP_CEILING),)


def mean_step_speed(x: np.ndarray, y: np.ndarray) -> tuple:
    """The mean speed of the first steps; steps that aren't numbers don't count."""
    step = resample.lengths(x, y)[:, :MEAN_STEPS]
    known = ~np.isnan(step)
    return (np.where(known.any(1), np.where(known, step, 0.0).sum(1) / np.maximum(known.sum(1), 1) / DT, np.nan),)


def array_start_speed(x: np.ndarray, y: np.ndarray, reach: int = REACH) -> tuple:
    """The mean of the first ``reach`` + 1 speeds of an output row, smoothed once."""
    return (profiles.smoothed(resample.lengths(x, y) / DT, 1)[:, : reach + 1].mean(1),)


def edited_speed(speed: np.ndarray, frame: np.ndarray, value: np.ndarray, radius: np.ndarray, last: np.ndarray, initial: np.ndarray) -> tuple:
    """A speed curve pulled to a value at a frame, by a cosine window of a radius; if the last edit (NaN: none) was more than a frame away, the frames between are
    pulled too, less. Then smoothed and limited in acceleration, from an initial speed where that is finite."""
    at = np.arange(speed.shape[1])[None]
    away = np.abs(at - frame[:, None])
    weight = (1 + np.cos(np.pi * away / np.maximum(radius, 1.0)[:, None])) / 2
    pull = np.where(away <= radius[:, None], weight, 0.0)
    out = speed + (value[:, None] - speed) * pull
    low, high = np.fmin(last, frame)[:, None], np.fmax(last, frame)[:, None]
    between = (np.abs(frame - last) > 1)[:, None] & (at >= low) & (at <= high) & (away <= np.maximum(radius, 1.0)[:, None])
    out = out + (value[:, None] - out) * np.where(between, BRIDGE * weight, 0.0)
    out = profiles.smoothed(out, EDIT_PASSES)
    return (resample.limited_speed(out, initial, top=resample.TOP),)
