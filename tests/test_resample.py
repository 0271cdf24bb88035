"""Resampled paths against plain loops: passes both ways, again and again, and a long bisection of the bias."""

from __future__ import annotations

import numpy as np
import pytest

from helmtrack.functions import profiles, resample

STEPS = 40


def paths() -> tuple[np.ndarray, np.ndarray]:
    """Curved, stopping, jumping, resting, backward and very fast paths."""
    rng = np.random.default_rng(5)
    t = np.arange(1, STEPS + 1) * 0.1
    rows = [
        (8 * t, 0.1 * t**2),
        (4 * t - 0.45 * t**2, np.sin(t)),
        (np.minimum(6 * t, 9), np.zeros(STEPS)),
        (0 * t, 0 * t),
        (5 * t, 3 * t + (t > 2) * 4),
        (14.5 * t, 2 * t),
        (40 * t, 0 * t),
        (0.01 * t, 0 * t),
        (-2 * t, 0.3 * t),
        (np.cumsum(rng.uniform(0, 1.4, STEPS)), np.cumsum(rng.normal(0, 0.2, STEPS))),
        (np.cumsum(np.where(t < 2, 0.1, 1.2)), 0 * t),
        (np.cumsum(np.where(t < 2, 1.3, 0.02)), 0 * t),
    ]
    return np.stack([r[0] for r in rows]), np.stack([r[1] for r in rows])


X, Y = paths()


def two_way(speed, fixed, rounds, low, high):
    """Clamped against the neighbour before, then against the one after; held entries stay."""
    v = [min(max(s, 0.0), 15.0) for s in speed]
    v = [s if np.isnan(f) else min(max(f, 0.0), 15.0) for s, f in zip(v, fixed)]
    for _ in range(rounds):
        for i in range(1, len(v)):
            if np.isnan(fixed[i]):
                v[i] = min(max(v[i], max(0.0, v[i - 1] + low)), min(15.0, v[i - 1] + high))
        for i in range(len(v) - 2, -1, -1):
            if np.isnan(fixed[i]):
                v[i] = min(max(v[i], max(0.0, v[i + 1] - high)), min(15.0, v[i + 1] - low))
    return np.array(v)


def bisected(profile, total):
    low, high, best = -15.0, 15.0, (np.inf, None)
    for _ in range(60):
        bias = (low + high) / 2
        speed = profile(bias)
        way = speed.sum() * 0.1
        best = min(best, (abs(way - total), bias), key=lambda b: b[0])
        low, high = (bias, high) if way < total else (low, bias)
    return best[0], profile(best[1])


def plain_path(x, y, speed, keep):
    px, py = np.append(0, x), np.append(0, y)
    gone = np.append(0, np.cumsum(np.hypot(np.diff(px), np.diff(py))))
    way = np.minimum(np.cumsum(speed * 0.1), gone[-1])
    if abs(way[-1] - gone[-1]) <= keep:
        way[-1] = gone[-1]
    return np.interp(way, gone, px), np.interp(way, gone, py)


@pytest.mark.parametrize(("initial", "anchored"), [(None, False), (3.0, False), (6.0, True)])
def test_limited_resample(initial, anchored):
    start = None if initial is None else np.full(len(X), initial)
    got = resample.limited_resample(X, Y, start, anchored)
    kept = 0
    for i in range(len(X)):
        step = np.hypot(np.diff(X[i], prepend=0), np.diff(Y[i], prepend=0))
        total = step.sum()
        if total <= 1e-6:
            assert (got[0][i] == 0).all() and (got[1][i] == 0).all()
            continue
        head = [] if initial is None else [initial]
        fixed = np.full(STEPS + len(head), np.nan)
        fixed[: len(head) * (2 if anchored else 1)] = initial if head else np.nan
        profile = lambda b: two_way([*head, *(step / 0.1 + b)], fixed, 12, -0.599, 0.199)[len(head) :]
        miss, speed = bisected(profile, total)
        allowed = max(0.25, 0.02 * total)
        want = plain_path(X[i], Y[i], speed, allowed)
        now = np.hypot(np.diff(want[0], prepend=0), np.diff(want[1], prepend=0)) / 0.1
        accel = np.diff(now, prepend=now[0] if initial is None else initial) / 0.1
        if miss > allowed or accel.min() < -6.2 or accel.max() > 2.2:
            assert np.isnan(got[0][i]).all() and np.isnan(got[1][i]).all()
        else:
            kept += 1
            assert np.allclose(got[0][i], want[0], atol=1e-6) and np.allclose(got[1][i], want[1], atol=1e-6)
    assert 3 <= kept < len(X) - 1


def one_way(speed, start):
    v, last = [], start
    for s in np.clip(speed, 0, 15):
        last = min(max(s, max(0.0, last - 0.6)), last + 0.2)
        v.append(last)
    return np.array(v)


def test_from_speed():
    for initial in (0.0, 4.0, np.nan):
        got = resample.from_speed(X, Y, np.full(len(X), initial))
        same = 0
        for i in range(len(X)):
            step = np.hypot(np.diff(X[i], prepend=0), np.diff(Y[i], prepend=0))
            allowed = max(0.25, 0.02 * step.sum())
            miss, speed = bisected(lambda b: one_way(np.clip(step / 0.1, 0, 15) + b, initial), step.sum()) if initial == initial else (np.inf, None)
            same += miss > allowed
            want = (X[i], Y[i]) if miss > allowed else plain_path(X[i], Y[i], speed, allowed)
            assert np.allclose(got[0][i], want[0], atol=1e-6) and np.allclose(got[1][i], want[1], atol=1e-6)
        assert same == len(X) if initial != initial else 0 < same < len(X)


def test_repaired_path_and_its_acceleration():
    initial = np.where(np.arange(len(X)) % 2, 2.0, np.nan)
    got = resample.repaired_path(X, Y, initial)
    good = np.isfinite(got[0]).all(1)
    assert 3 <= good.sum() < len(X)
    ends = np.hypot(got[0][:, -1] - X[:, -1], got[1][:, -1] - Y[:, -1])
    assert (ends[good] < 1e-9).all()
    assert (got[2][good] >= -6).all() and (got[2][good] <= 2).all() and (got[2][good & np.isnan(initial), 0] == 0).all()
    i = int(np.flatnonzero(good & np.isnan(initial) & (X[:, -1] > 5))[0])
    step = np.hypot(np.diff(X[i], prepend=0), np.diff(Y[i], prepend=0))
    miss, speed = bisected(lambda b: np.minimum(one_way_free(np.clip(step / 0.1, 0, 15) + b), 15), step.sum())
    assert np.allclose(got[0][i], plain_path(X[i], Y[i], speed, 0.25)[0], atol=1e-6)


def one_way_free(speed):
    v = [max(speed[0], 0.0)]
    for s in speed[1:]:
        v.append(min(max(max(s, 0.0), max(0.0, v[-1] - 0.6)), v[-1] + 0.2))
    return np.array(v)


def test_repaired_velocity():
    rng = np.random.default_rng(8)
    vx, vy = rng.uniform(-1, 9, (4, 12)), rng.normal(0, 1, (4, 12))
    vx[1, :3] = vy[1, :3] = 0
    vx[2], vy[2] = 0, 0
    dt = rng.uniform(0.05, 0.2, (4, 11))
    initial = np.array([np.nan, 5.0, 3.0, 20.0])
    x, y, accel = resample.repaired_velocity(vx, vy, dt, initial)
    for i in range(4):
        raw = np.hypot(vx[i], vy[i])
        speed = [raw[0] if np.isnan(initial[i]) else min(initial[i], 15.0)]
        for j in range(11):
            speed.append(min(max(raw[j + 1], max(0.0, speed[-1] - 6 * dt[i, j])), speed[-1] + 2 * dt[i, j]))
        moving = np.flatnonzero(raw > 1e-3)
        units = [np.array([1.0, 0.0])] * 12
        for j in range(12):
            if len(moving):
                k = max([m for m in moving if m <= j], default=moving[0])
                units[j] = np.array([vx[i, k], vy[i, k]]) / raw[k]
        at = np.zeros(2)
        for j in range(11):
            at = at + (units[j] * speed[j] + units[j + 1] * speed[j + 1]) / 2 * dt[i, j]
            assert np.allclose((x[i, j], y[i, j]), at)
            assert np.isclose(accel[i, j], np.clip((speed[j + 1] - speed[j]) / dt[i, j], -6, 2))
    assert np.isnan(resample.repaired_velocity(vx[:1], vy[:1], -dt[:1], initial[:1])[0]).all()


def test_frames_of_sections():
    cases = [([1, 1, 1], 2, [1, 1, 0]), ([0, 3, 5, 3], 2, [0, 1, 1, 0]), ([0, 0], 5, [5, 0]), ([1, 2, 0, 1], 11, [3, 5, 0, 3]), ([2, 1, 1], 4, [2, 1, 1]), ([1], 0, [0]), ([], 3, [])]
    for sections, frames, want in cases:
        got = resample.shared_frames(np.array(sections, float), frames)
        assert got.tolist() == want and got.sum() == (frames if len(sections) else 0)
    rng = np.random.default_rng(1)
    for _ in range(300):
        sections, frames = rng.integers(0, 5, rng.integers(1, 7)).astype(float), int(rng.integers(0, 80))
        assert resample.shared_frames(sections, frames).sum() == frames
    assert resample.held_frames([1.0, 2.0], 64) == [10, 20] and resample.held_frames([5.0, 5.0, 5.0], 64) == [20, 21, 21]
    assert sum(resample.held_frames([9.0, 0.1], 20)) <= 18 and resample.held_frames([9.0], 2) == [0]


def test_stops_on_the_way():
    dense_x = np.linspace(0, 30, 97)[None]
    fractions, durations = [[0.5, 0.2, None, 0.9]], [[1.0, 0.5, 2.0, 0.04]]
    x, y = resample.stopping_resample(dense_x, dense_x * 0, np.array([4.0]), fractions, durations, 64)
    assert x.shape == (1, 64) and np.isclose(x[0, -1], 30) and (np.diff(x[0]) >= -1e-12).all()
    assert np.isclose(x[0], 15.0).sum() == 10 and np.isclose(x[0], 6.0).sum() == 5
    frames = resample.shared_frames(np.array([6.0, 9.0, 15.0]), 49)
    u = np.arange(1, frames[0] + 1) / (frames[0] + 1)
    assert np.allclose(x[0, : frames[0]], 6 * (1 - (1 - u) ** 2))
    w = np.arange(1, frames[1] + 1) / (frames[1] + 1)
    assert np.allclose(x[0, frames[0] + 5 : frames[0] + 5 + frames[1]], 6 + 9 * (3 * w**2 - 2 * w**3))
    z = np.arange(1, frames[2] + 1) / frames[2]
    assert np.allclose(x[0, -frames[2] :], 15 + 15 * z**2)
    plain = resample.stopping_resample(dense_x, dense_x * 0, np.array([4.0]), [None], [None], 64)
    assert np.allclose(plain, resample.scheduled_resample(dense_x, dense_x * 0, np.array([4.0]), 64))
    rest = resample.stopping_resample(np.full((1, 5), 2.0), np.full((1, 5), 3.0), np.array([1.0]), fractions, durations, 8)
    assert (rest[0] == 2).all() and (rest[1] == 3).all()


def test_stop_at_the_end():
    dense_x = np.concatenate([np.linspace(0, 20, 97)[None], np.linspace(0, 90, 97)[None], np.full((1, 97), 4.0)])
    x, y = resample.final_stop_resample(dense_x, dense_x * 0, np.array([5.0, 5.0, 5.0]), np.array([1.0, 1.0, 1.0]), 64)
    assert (x[0, -10:] == 20).all() and np.isclose(x[0, 53], 20) and np.isnan(x[1]).all() and (x[2] == 4).all()
    base = resample.scheduled_resample(dense_x[:1], dense_x[:1] * 0, np.array([5.0]), 54)[0][0]
    wished = np.append(np.diff(base, prepend=0) / 0.1, np.zeros(10))
    fixed = np.append(np.full(54, np.nan), np.zeros(10))
    miss, speed = bisected(lambda b: two_way(wished + np.append(np.full(54, b), np.zeros(10)), fixed, 12, -0.599, 0.199), 20.0)
    want = np.minimum(np.cumsum(speed * 0.1), 20.0)
    assert np.allclose(x[0, :53], want[:53], atol=1e-6)
    assert profiles.quality(x[:1], y[:1])[0][0] == 1
    assert np.isnan(resample.final_stop_resample(dense_x[:1], dense_x[:1] * 0, np.array([5.0]), np.array([9.0]), 4)[0]).all()


def test_optimised_takes_the_first_clean_pass_or_the_best_score():
    rng = np.random.default_rng(3)
    x = np.cumsum(rng.uniform(0.2, 1.3, (8, 30)), axis=1)
    y = np.cumsum(rng.normal(0, 0.15, (8, 30)), axis=1)
    x[0], y[0] = np.arange(1, 31) * 0.5, 0
    got = profiles.optimised(x, y)
    clean = lambda u, v: not any(f.any() for f in profiles.violations(u, v).values())
    for i in range(8):
        u, v = x[i : i + 1], y[i : i + 1]
        best, score, done = (u, v), profiles.violation_score(u, v)[0], clean(u, v)
        for n in range(25):
            if done:
                break
            shape = profiles.inside_smoothed(u, n), profiles.inside_smoothed(v, n)
            slowed = resample.limited_resample(*shape)
            tried = [t.copy() for t in (slowed if np.isfinite(slowed[0]).all() else shape)]
            tried[0][:, -1], tried[1][:, -1] = u[:, -1], v[:, -1]
            new = profiles.violation_score(*tried)[0] + 2 * max(0.0, np.hypot(tried[0] - u, tried[1] - v).max() - 6.0)
            done = clean(*tried)
            if done or new < score:
                best, score = tried, new
        assert np.allclose(got[0][i], best[0][0]) and np.allclose(got[1][i], best[1][0]) and got[2][i] == done
