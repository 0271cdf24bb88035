"""Dragged ends: costs by a plain loop, minima against random and coordinate search, previews and refusals."""

from __future__ import annotations

import numpy as np

from helmtrack.functions import drag, kinematics, profiles, resample

T = np.arange(1, 65) * 0.1
X = np.stack([6 * T, 5 * T, 7 * T - 0.2 * T**2, 4 * T])
Y = np.stack([0 * T, 0.15 * T**2, -0.1 * T**2, 0.3 * np.sin(T)])
DX, DY = np.array([2.0, -1.5, 3.0, 0.5]), np.array([1.5, 2.0, -1.0, -2.5])


def plain_cost(i, values):
    knots = np.vstack([[0, 0], values.reshape(5, 2), [DX[i], DY[i]]])
    t, k = np.linspace(0, 1, 64), np.linspace(0, 1, 7)
    x, y = X[i] + np.interp(t, k, knots[:, 0]), Y[i] + np.interp(t, k, knots[:, 1])
    now, own = (kinematics.dynamics(a[None], b[None]) for a, b in ((x, y), (X[i], Y[i])))
    accel = np.mean([(now[1] - own[1]) ** 2, (now[2] - own[2]) ** 2])
    moved = np.mean([(x - X[i]) ** 2, (y - Y[i]) ** 2])
    return accel + 80 * np.mean((now[3] - own[3]) ** 2) + 0.03 * moved + 0.02 * np.mean((now[0] - own[0]) ** 2)


def test_cost_is_that_of_a_plain_loop():
    task = drag.Drag(X, Y, DX, DY)
    v = np.random.default_rng(1).normal(size=(4, 3, 10))
    assert np.allclose(task.cost(v), [[plain_cost(i, v[i, j]) for j in range(3)] for i in range(4)])
    assert np.allclose(task.cost(v[:, 0]), task.cost(v)[:, 0])
    u = np.linspace(0, 1, 7)[1:-1]
    assert np.allclose(task.start[0].reshape(5, 2), np.outer(3 * u**2 - 2 * u**3, [2.0, 1.5]))


def test_solution_is_no_worse_than_long_searches():
    task = drag.Drag(X, Y, DX, DY)
    v = task.solved()
    best = task.cost(v)
    assert (v >= task.low).all() and (v <= task.high).all() and (best <= task.cost(task.start)).all()
    rng = np.random.default_rng(2)
    walk, cost = task.start.copy(), task.cost(task.start)
    for size in np.geomspace(1.0, 1e-3, 400):
        tried = np.clip(walk[:, None] + rng.normal(0, size, (4, 40, 10)) * rng.integers(0, 2, (4, 40, 10)), task.low[:, None], task.high[:, None])
        costs = task.cost(tried)
        at = costs.argmin(1)
        rows = np.flatnonzero(costs[np.arange(4), at] < cost)
        walk[rows], cost[rows] = tried[rows, at[rows]], costs[rows, at[rows]]
    assert (best <= cost * 1.001 + 1e-9).all()


def test_bounds_hold():
    task = drag.Drag(X[:1], Y[:1], DX[:1], DY[:1])
    task.low, task.high = task.start - 0.05, task.start + 0.02
    v = task.solved()
    assert (v >= task.low).all() and (v <= task.high).all() and ((v == task.low) | (v == task.high)).any()


def test_dragged_ends_and_refusals():
    x, y = np.concatenate([X, X[:4]]), np.concatenate([Y, Y[:4]])
    to_x = np.concatenate([X[:, -1] + DX / 4, [X[0, -1] + 60, -3.0, np.nan, X[3, -1] + 0.1]])
    to_y = np.concatenate([Y[:, -1] + DY / 4, [0, 0, 0, Y[3, -1]]])
    speed = np.array([6, 5, 7, 4, 6, 5, 7, 60.0])
    gx, gy = drag.dragged(x, y, to_x, to_y, speed)
    good = np.isfinite(gx).all(1)
    assert good[:4].sum() >= 3 and not good[4:7].any() and not good[7]
    assert (np.hypot(gx[good, -1] - to_x[good], gy[good, -1] - to_y[good]) <= 0.2).all()
    accel = kinematics.scalar_profile(gx[good], gy[good])[2]
    assert accel.min() >= -6.2 and accel.max() <= 2.2
    assert np.isnan(drag.dragged(X[:, :3], Y[:, :3], X[:, 2], Y[:, 2], speed[:4])[0]).all()


def test_preview_takes_the_most_passes_that_the_limits_allow():
    speed = np.array([6.0, 5.0, 7.0, 4.0])
    rng = np.random.default_rng(4)
    x, y = X + rng.normal(0, 0.01, X.shape), Y + rng.normal(0, 0.01, Y.shape)
    got = drag.preview(x, y, speed)
    for i in range(4):
        first = resample.limited_resample(x[i : i + 1], y[i : i + 1], speed[i : i + 1], anchored=True)
        want = first
        for passes in (4, 3, 2, 1):
            if not np.isfinite(first[0]).all():
                break
            again = resample.limited_resample(*(profiles.inside_smoothed(v, passes) for v in first), speed[i : i + 1], anchored=True)
            if np.isfinite(again[0]).all():
                want = again
                break
        assert np.allclose(got[0][i], want[0][0], equal_nan=True) and np.allclose(got[1][i], want[1][0], equal_nan=True)
