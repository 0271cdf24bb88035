"""Row components, histories, speeds at the start and speed edits against plain loops, row by row."""

from __future__ import annotations

import numpy as np

from helmtrack.functions import rows

rng = np.random.default_rng(12)
X = np.cumsum(rng.uniform(-0.3, 1.0, (7, 16)), axis=1)
Y = np.cumsum(rng.normal(0, 0.6, (7, 16)), axis=1)
Z = np.cumsum(rng.normal(0, 0.05, (7, 16)), axis=1)
for v in (X, Y, Z):
    v[1] = 0
    v[2, :4] = 0
    v[3, 6:9] = v[3, 5:6]
KERNEL = np.array([1, 2, 3, 2, 1]) / 9


def test_components():
    vx, vy, vz, qz, qw, bend = rows.components(X, Y, Z)
    for i in range(7):
        p = np.vstack([np.zeros(3), np.column_stack([X[i], Y[i], Z[i]])])
        v = np.diff(p, axis=0) / 0.1
        yaw = np.unwrap(np.arctan2(v[:, 1], v[:, 0]))
        moving = [j for j in range(16) if np.hypot(v[j, 0], v[j, 1]) >= 1e-3]
        want = [yaw[max([m for m in moving if m <= j], default=moving[0])] if moving else 0.0 for j in range(16)]
        assert np.allclose(np.column_stack([vx[i], vy[i], vz[i]]), v) and np.allclose(qz[i], np.sin(np.array(want) / 2)) and np.allclose(qw[i], np.cos(np.array(want) / 2))
        assert np.allclose(bend[i], np.gradient(want))
    one = rows.components(X[:, :1], Y[:, :1], Z[:, :1])
    assert one[0].shape == (7, 1) and (one[5] == 0).all()


def smooth(v, passes):
    v = np.where(np.isfinite(v), v, 0.0)
    for _ in range(passes if len(v) >= 5 else 0):
        v = np.convolve(np.pad(v, 2, mode="edge"), KERNEL, mode="valid")
    return v


def test_smooth_kinematics():
    got = rows.smooth_kinematics(X, Y, Z)
    for i in range(7):
        p = np.column_stack([X[i], Y[i], Z[i]])
        raw = np.diff(p, axis=0, prepend=p[:1]) / 0.1
        raw[0] = raw[1]
        v = np.column_stack([smooth(raw[:, d], 1) for d in range(3)])
        a = np.column_stack([smooth(np.append(0, np.diff(v[:, d]) / 0.1), 2) for d in range(3)])
        yaw = np.arctan2(v[:, 1], v[:, 0])
        moving = [j for j in range(16) if np.hypot(*v[j, :2]) > 1e-3]
        yaw = np.unwrap([yaw[max([m for m in moving if m <= j], default=moving[0])] if moving else 0.0 for j in range(16)])
        way = np.hypot(*np.diff(p[:, :2], axis=0).T)
        bend = smooth(np.append(0, np.diff(yaw) / np.maximum(way, 1e-6)), 1)
        assert np.allclose(np.column_stack([g[i] for g in got[:3]]), v) and np.allclose(np.column_stack([g[i] for g in got[3:6]]), a) and np.allclose(got[6][i], bend)


def shown_points(p, passes=2):
    p = p.copy()
    for _ in range(passes if len(p) >= 5 else 0):
        q = p.copy()
        for j in range(2, len(p) - 2):
            p[j] = KERNEL @ q[j - 2 : j + 3]
    return p


def test_history_speeds():
    raw, shown = rows.history_speeds(X, Y, Z)
    for i in range(7):
        p = np.column_stack([X[i], Y[i], Z[i]])
        speed = lambda q: np.append(np.linalg.norm(q[1] - q[0]), np.linalg.norm(np.diff(q, axis=0), axis=1)) / 0.1
        assert np.allclose(raw[i], speed(p))
        own = speed(shown_points(p))
        want = smooth(own, 1)
        want[-1] = own[-1]
        assert np.allclose(shown[i], want)
    assert rows.history_speeds(X[:, :1], Y[:, :1], Z[:, :1])[1].tolist() == [[0.0]] * 7 and rows.shown_speed(np.array([[-1.0, 2.0]]), 0).tolist() == [[0.0, 2.0]]


def test_speeds_at_the_start():
    valid = np.ones((7, 16))
    valid[0, 3:5], valid[4, 1:], valid[5] = 0, 0, 0
    valid[6, 4:] = 0
    got = rows.history_start_speed(X, Y, valid)[0]
    for i in range(7):
        p = np.column_stack([X[i], Y[i]])[valid[i] > 0]
        q = shown_points(p) if len(p) > 1 else p
        want = min(np.linalg.norm(q[-1] - q[-2]) / 0.1, 12.0) if len(p) > 1 else 2.0
        assert np.isclose(got[i], want)
    assert np.allclose(rows.first_step_speed(X, Y)[0], np.minimum(np.hypot(X[:, 0], Y[:, 0]) / 0.1, 15))
    steps = np.hypot(np.diff(X, axis=1, prepend=0), np.diff(Y, axis=1, prepend=0))
    assert np.allclose(rows.mean_step_speed(X, Y)[0], steps[:, :5].mean(1) / 0.1)
    holed = X.copy()
    holed[0, 2], holed[1] = np.nan, np.nan
    mean = rows.mean_step_speed(holed, Y)[0]
    assert np.isclose(mean[0], np.mean([steps[0, 0], steps[0, 1], steps[0, 4]]) / 0.1) and np.isnan(mean[1])
    assert np.allclose(rows.array_start_speed(X, Y)[0], [smooth(s / 0.1, 1)[:4].mean() for s in steps])


def test_edited_speed():
    speed = rng.uniform(0, 9, (5, 16))
    frame, value, radius = np.array([0, 8, 15, 5, 3.0]), np.array([4.0, 9.0, 0.0, 6.0, 7.0]), np.array([4, 3, 5, 0, 6.0])
    last, initial = np.array([np.nan, 2, 14, 9, 12.0]), np.array([np.nan, 5.0, np.nan, 3.0, 20.0])
    got = rows.edited_speed(speed, frame, value, radius, last, initial)[0]
    for i in range(5):
        v, c, r = speed[i].copy(), int(frame[i]), int(radius[i])
        for j in range(max(0, c - r), min(15, c + r) + 1):
            w = 0.5 * (1 + np.cos(np.pi * abs(j - c) / max(r, 1)))
            v[j] = v[j] * (1 - w) + value[i] * w
        if not np.isnan(last[i]) and abs(c - last[i]) > 1:
            for j in range(int(min(last[i], c)), int(max(last[i], c)) + 1):
                d = abs(j - c) / max(r, 1)
                if d <= 1:
                    w = 0.35 * 0.5 * (1 + np.cos(np.pi * d))
                    v[j] = v[j] * (1 - w) + value[i] * w
        v = np.clip(smooth(v, 2), 0, 15)
        at = None if np.isnan(initial[i]) else min(initial[i], 15.0)
        for j in range(16):
            if at is not None:
                v[j] = min(max(v[j], max(0.0, at - 0.6)), min(15.0, at + 0.2))
            at = v[j]
        assert np.allclose(got[i], v)
