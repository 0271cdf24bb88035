"""Kinematics of trajectories: numpy kernels over blocks of equally long rows, run by Spark in Arrow batches.

A kernel takes arrays of shape (rows, steps) and loops over steps at most, never over rows.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from helmtrack.functions.curves import frechet_pairs

DT = 0.1
ACCEL_MIN, ACCEL_MAX, SPEED_MAX = -6.0, 2.0, 15.0
#: Rows that a kernel gets at a time, whatever the size of Arrow's batches: full batches come only with larger tables.
PIECE = 1024


def pieces(batches, rows: int = PIECE):
    """Arrow batches in slices of at most so many rows."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def _blocks(columns: list, usable: np.ndarray):
    """For rows whose lists are alike in length: their numbers, and each column as an array of (rows, steps) or (rows,)."""
    lists = [pa.types.is_list(c.type) for c in columns]
    lengths = np.stack([np.nan_to_num(c.value_lengths().to_numpy(zero_copy_only=False)).astype(np.int64) if k else np.ones(len(c), np.int64) for c, k in zip(columns, lists)], axis=1)
    rows = np.flatnonzero(usable & (lengths > 0).all(1))
    kinds, which = np.unique(lengths[rows], axis=0, return_inverse=True)
    for kind in range(len(kinds)):
        at = rows[which.ravel() == kind]
        taken = [c.take(pa.array(at)) for c in columns]
        yield at, [np.asarray(t.flatten(), float).reshape(len(at), -1) if k else np.asarray(t, float) for t, k in zip(taken, lists)]


def _column(parts: list, n: int, is_list: bool) -> pa.Array:
    """Blocks of (row numbers, values) as one column of n rows; null where no block has a row."""
    kind = pa.list_(pa.float64()) if is_list else pa.float64()
    arrays = []
    for at, block in parts:
        block = np.ascontiguousarray(block, float)
        arrays.append(pa.ListArray.from_arrays(pa.array(np.arange(len(at) + 1) * block.shape[1], pa.int32()), pa.array(block.ravel())) if is_list else pa.array(block))
    place = np.full(n, -1)
    rows = np.concatenate([at for at, _ in parts]) if parts else np.zeros(0, np.int64)
    place[rows] = np.arange(len(rows))
    whole = pa.concat_arrays(arrays) if arrays else pa.array([], kind)
    return whole.take(pa.array(place, mask=place < 0)).cast(kind)


def with_kernel(df: DataFrame, inputs: list[str], outputs: dict[str, str], kernel: Callable[..., tuple]) -> DataFrame:
    """``df`` with columns added by a kernel. Inputs are arrays of doubles, or numbers; rows whose arrays are alike in length
    meet in a block, of at most PIECE rows. Outputs name ``array<double>`` or ``double`` columns. Rows with a null input or of no steps get nulls."""
    keep = [c for c in df.columns if c not in outputs]
    df = df.select(*keep)
    schema = ", ".join([f"`{c}` {df.schema[c].dataType.simpleString()}" for c in keep] + [f"`{c}` {k}" for c, k in outputs.items()])

    def run(batches):
        for batch in pieces(batches):
            columns = [batch.column(c) for c in inputs]
            usable = np.ones(batch.num_rows, bool)
            for c in columns:
                usable &= np.asarray(c.is_valid())
            parts: list[list] = [[] for _ in outputs]
            for at, blocks in _blocks(columns, usable):
                for part, block in zip(parts, kernel(*blocks)):
                    part.append((at, block))
            arrays = [_column(part, batch.num_rows, k.startswith("array")) for part, k in zip(parts, outputs.values())]
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in keep] + arrays, names=[*keep, *outputs])

    return df.mapInArrow(run, schema)


def steps_from_origin(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Differences of future points; the first is from the origin."""
    return np.diff(x, axis=1, prepend=0.0), np.diff(y, axis=1, prepend=0.0)


def headings(dx: np.ndarray, dy: np.ndarray, moving: np.ndarray) -> np.ndarray:
    """Unwrapped headings; a step that hardly moves keeps the heading before it, and before the first moving
    step that one's. 0 for rows that never move."""
    yaw = np.arctan2(dy, dx)
    n = yaw.shape[1]
    last = np.maximum.accumulate(np.where(moving, np.arange(n), -1), axis=1)
    first = moving.argmax(1)
    yaw = np.take_along_axis(yaw, np.where(last < 0, first[:, None], last), 1)
    return np.where(moving.any(1)[:, None], np.unwrap(yaw, axis=1), 0.0)


def dynamics(x: np.ndarray, y: np.ndarray, dt: float = DT) -> tuple:
    """Speed, vector acceleration (two arrays) and signed curvature of future points."""
    dx, dy = steps_from_origin(x, y)
    step = np.hypot(dx, dy)
    speed = step / dt
    ax, ay = (np.diff(d / dt, axis=1, prepend=(d / dt)[:, :1]) / dt for d in (dx, dy))
    yaw = headings(dx, dy, speed > 1e-3)
    curvature = np.diff(yaw, axis=1, prepend=yaw[:, :1]) / np.maximum(step, 1e-6)
    curvature[:, 0] = 0.0
    return speed, ax, ay, np.where(np.isfinite(curvature), curvature, 0.0)


def scalar_profile(x: np.ndarray, y: np.ndarray, dt: float = DT) -> tuple:
    """Step distance, speed, scalar acceleration and jerk of future points; first entries of the last two 0."""
    step = np.hypot(*steps_from_origin(x, y))
    speed = step / dt
    accel = np.diff(speed, axis=1, prepend=speed[:, :1]) / dt
    jerk = np.diff(accel, axis=1, prepend=accel[:, :1]) / dt
    return step, speed, accel, jerk


def rollout(acceleration: np.ndarray, curvature: np.ndarray, initial_speed: np.ndarray, dt: float = DT, max_speed: float = SPEED_MAX) -> tuple:
    """Points of a profile of acceleration and curvature driven from an initial speed. The first entries of
    both play no part."""
    n, steps = acceleration.shape
    speed, yaw = np.clip(initial_speed, 0.0, max_speed), np.zeros(n)
    x, y, at_x, at_y = np.zeros((n, steps)), np.zeros((n, steps)), np.zeros(n), np.zeros(n)
    for i in range(steps):
        if i:
            speed = np.clip(speed + acceleration[:, i] * dt, 0.0, max_speed)
        ds = speed * dt
        if i:
            yaw = yaw + curvature[:, i] * ds
        at_x, at_y = at_x + np.cos(yaw) * ds, at_y + np.sin(yaw) * ds
        x[:, i], y[:, i] = at_x, at_y
    return x, y


def bezier(control: np.ndarray, t: np.ndarray) -> np.ndarray:
    """A Bezier curve of any degree at the values t, by repeated interpolation of its control points."""
    work = np.repeat(control[None, :, :], len(t), 0).astype(float)
    while work.shape[1] > 1:
        work = (1 - t)[:, None, None] * work[:, :-1] + t[:, None, None] * work[:, 1:]
    return work[:, 0]


def bezier_chain(points: np.ndarray, samples: int = 96) -> np.ndarray:
    """Cubic pieces through all points, with the tangents of their neighbours' chord."""
    if len(points) < 2:
        return points
    tangent = np.concatenate([points[1:2] - points[:1], (points[2:] - points[:-2]) / 2, points[-1:] - points[-2:-1]])
    t = np.linspace(0.0, 1.0, samples, endpoint=False)
    pieces = [bezier(np.stack([a, a + u / 3, b - v / 3, b]), t) for a, b, u, v in zip(points, points[1:], tangent, tangent[1:])]
    return np.concatenate([*pieces, points[-1:]])


def frechet(a: np.ndarray, b: np.ndarray) -> float:
    """Discrete Frechet distance of two curves (points by rows)."""
    return float(frechet_pairs(np.asarray(a, float)[None], np.asarray(b, float)[None])[0])
