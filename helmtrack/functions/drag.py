"""A centre's end dragged to another place: offsets at a few knots that change its dynamics least, within bounds. Kernels over blocks (rows, steps).

All rows are optimised together: each has a dense inverse Hessian of its ten variables (BFGS), gradients by central differences, and steps that
are cut to the bounds and halved until they help. A variable at a bound that its gradient holds there takes no part in a step.
"""

from __future__ import annotations

import numpy as np

from helmtrack.functions import kinematics as kin
from helmtrack.functions import profiles, resample

#: Weights of acceleration, curvature, deviation and speed; knots; smoothing passes of a preview.
ACCELERATION, CURVATURE, DEVIATION, SPEED, KNOTS, PASSES = 1.0, 80.0, 0.03, 0.02, 7, 4
#: The end may be dragged so far (at least, at most, by length of the way); bounds beyond the straight offsets (at least, by
#: the distance dragged); how far behind the start an end and a point may lie, and how near the target the result must end.
LEAST_DRAG, MOST_DRAG, DRAG_SHARE, ROOM, ROOM_SHARE, BEHIND_END, BEHIND, NEAR = 8.0, 22.0, 0.65, 3.0, 0.75, -0.25, -1.0, 0.2
#: Greatest speed, acceleration and curvature (at least; and by a factor and more of those of the centre).
MOST_SPEED, MOST_ACCEL, MOST_BEND = (28.0, 1.8, 4.0), (65.0, 2.4, 8.0), (1.25, 3.0, 0.08)
#: Rounds, halvings of a step, step of a difference and relative gain under which a row is done.
ROUNDS, HALVINGS, DIFFERENCE, GAIN = 60, 12, 1e-5, 1e-7


def preview(x: np.ndarray, y: np.ndarray, speed: np.ndarray) -> tuple:
    """A path limited from an initial speed that holds its first step, then smoothed by as many passes as the limits allow, and limited
    again. NaN where the path itself can't be limited."""
    out = list(resample.limited_resample(x, y, speed, anchored=True))
    left = np.flatnonzero(np.isfinite(out[0]).all(1))
    first = [v.copy() for v in out]
    for passes in range(PASSES, 0, -1):
        if not len(left):
            break
        found = resample.limited_resample(*(profiles.inside_smoothed(v[left], passes) for v in first), speed[left], anchored=True)
        good = np.isfinite(found[0]).all(1)
        for o, f in zip(out, found):
            o[left[good]] = f[good]
        left = left[~good]
    return out[0], out[1]


class Drag:
    """The cost of knot offsets (rows, 10) for paths and the offsets of their ends."""

    def __init__(self, x: np.ndarray, y: np.ndarray, dx: np.ndarray, dy: np.ndarray):
        self.x, self.y, self.end = x, y, np.stack([dx, dy], axis=1)
        place = np.linspace(0.0, 1.0, x.shape[1]) * (KNOTS - 1)
        low = np.minimum(place.astype(int), KNOTS - 2)
        self.mix = np.zeros((KNOTS, x.shape[1]))
        np.add.at(self.mix, (low, np.arange(x.shape[1])), 1.0 - (place - low))
        np.add.at(self.mix, (low + 1, np.arange(x.shape[1])), place - low)
        self.own = kin.dynamics(x, y)
        u = np.linspace(0.0, 1.0, KNOTS)[1:-1]
        self.start = ((3.0 - 2.0 * u) * u * u)[None, :, None] * self.end[:, None, :]
        room = np.maximum(ROOM, ROOM_SHARE * np.hypot(dx, dy))[:, None]
        self.low, self.high = (np.tile(v, (1, KNOTS - 2)) for v in (np.minimum(0.0, self.end) - room, np.maximum(0.0, self.end) + room))
        self.start = self.start.reshape(len(x), -1)

    def path(self, v: np.ndarray) -> tuple:
        """Points for offsets of shape (rows, k, 10), or (rows, 10)."""
        knots = v.reshape(*v.shape[:-1], KNOTS - 2, 2)
        end = np.broadcast_to(self.end.reshape(len(self.x), *[1] * (v.ndim - 2), 1, 2), (*knots.shape[:-2], 1, 2))
        offset = np.concatenate([np.zeros_like(end), knots, end], axis=-2)
        lead = [slice(None)] + [None] * (v.ndim - 2)
        return tuple(base[tuple(lead)] + offset[..., i] @ self.mix for i, base in enumerate((self.x, self.y)))

    def cost(self, v: np.ndarray) -> np.ndarray:
        x, y = self.path(v)
        flat = lambda a: a.reshape(-1, self.x.shape[1])
        many = int(np.prod(v.shape[1:-1])) if v.ndim > 2 else 1
        speed, ax, ay, bend = kin.dynamics(flat(x), flat(y))
        own = [np.repeat(o, many, axis=0) for o in self.own]
        moved = (flat(x) - np.repeat(self.x, many, axis=0)) ** 2 + (flat(y) - np.repeat(self.y, many, axis=0)) ** 2
        parts = ACCELERATION * ((ax - own[1]) ** 2 + (ay - own[2]) ** 2) / 2 + CURVATURE * (bend - own[3]) ** 2 + DEVIATION * moved / 2 + SPEED * (speed - own[0]) ** 2
        total = parts.mean(1)
        return np.where(np.isfinite(total), total, 1e12).reshape(v.shape[:-1])

    def gradient(self, v: np.ndarray) -> np.ndarray:
        step = DIFFERENCE * np.eye(v.shape[1])
        both = self.cost(np.concatenate([v[:, None] + step, v[:, None] - step], axis=1))
        n = v.shape[1]
        return (both[:, :n] - both[:, n:]) / (2 * DIFFERENCE)

    def solved(self) -> np.ndarray:
        """Offsets within the bounds that cost least as far as the rounds go."""
        v = np.clip(self.start, self.low, self.high)
        n, k = v.shape
        cost, grad = self.cost(v), self.gradient(v)
        inverse = np.tile(np.eye(k), (n, 1, 1))
        done = np.zeros(n, bool)
        halves = 0.5 ** np.arange(HALVINGS)
        for _ in range(ROUNDS):
            held = ((v <= self.low) & (grad > 0)) | ((v >= self.high) & (grad < 0))
            free = np.where(held, 0.0, grad)
            step = -np.where(held, 0.0, np.einsum("nij,nj->ni", inverse, free))
            uphill = (step * free).sum(1) >= 0
            step[uphill] = -free[uphill]
            inverse[uphill] = np.eye(k)
            tried = np.clip(v[:, None] + halves[None, :, None] * step[:, None], self.low[:, None], self.high[:, None])
            costs = self.cost(tried)
            best = costs.argmin(1)
            rows = np.arange(n)
            better = (costs[rows, best] < cost) & ~done
            done |= ~better | (cost - costs[rows, best] <= GAIN * np.maximum(cost, 1e-12))
            new = np.where(better[:, None], tried[rows, best], v)
            new_grad = self.gradient(new)
            s, t = new - v, new_grad - grad
            v, cost, grad = new, np.where(better, costs[rows, best], cost), new_grad
            if done.all():
                break
            along = (s * t).sum(1)
            good = better & (along > 1e-12)
            rho = np.where(good, 1.0 / np.where(good, along, 1.0), 0.0)[:, None, None]
            left = np.eye(k) - rho * s[:, :, None] * t[:, None, :]
            inverse = left @ inverse @ np.swapaxes(left, 1, 2) + rho * s[:, :, None] * s[:, None, :]
        return v


def dragged(x: np.ndarray, y: np.ndarray, to_x: np.ndarray, to_y: np.ndarray, speed: np.ndarray) -> tuple:
    """Each path with its end at a target, as a preview. NaN where the target is too far or behind, the path too short, or the result doesn't end near the target
    or has greater speeds, accelerations or curvatures than are sane for the path."""
    out = [np.full(x.shape, np.nan) for _ in "xy"]
    dx, dy = to_x - x[:, -1], to_y - y[:, -1]
    way = np.hypot(*kin.steps_from_origin(x, y)).sum(1)
    reach = np.maximum(LEAST_DRAG, np.minimum(MOST_DRAG, DRAG_SHARE * np.maximum(way, 1.0)))
    with np.errstate(invalid="ignore"):
        asked = np.isfinite(to_x) & np.isfinite(to_y) & (to_x >= BEHIND_END) & (np.hypot(dx, dy) <= reach) & np.isfinite(way) & (x.shape[1] >= 4)
    rows = np.flatnonzero(asked)
    if not len(rows):
        return out[0], out[1]
    task = Drag(x[rows], y[rows], dx[rows], dy[rows])
    px, py = preview(*task.path(task.solved()), speed[rows])
    good = np.isfinite(px).all(1)
    rows, px, py = rows[good], px[good], py[good]
    if not len(rows):
        return out[0], out[1]
    now, own = kin.dynamics(px, py), kin.dynamics(x[rows], y[rows])
    scalar = kin.scalar_profile(px, py)[2]
    extreme = lambda d: (d[0].max(1), np.hypot(d[1], d[2]).max(1), np.abs(d[3]).max(1))
    sane = (np.hypot(px[:, -1] - to_x[rows], py[:, -1] - to_y[rows]) <= NEAR) & (px.min(1) >= BEHIND)
    sane &= (scalar.min(1) >= resample.BRAKE - resample.SLACK) & (scalar.max(1) <= resample.PUSH + resample.SLACK)
    for (least, factor, more), a, b in zip((MOST_SPEED, MOST_ACCEL, MOST_BEND), extreme(now), extreme(own)):
        sane &= a <= np.maximum(least, factor * b + more)
    out[0][rows[sane]], out[1][rows[sane]] = px[sane], py[sane]
    return out[0], out[1]
