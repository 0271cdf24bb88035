"""Paths driven anew: at limited accelerations, from a given speed, with stops on the way or at the end. Kernels over blocks (rows, steps).

A speed profile is limited by one pass ahead: after it all steps are within the limits, so that a pass back changes nothing. A stop
at the end adds a ramp, the speeds from which it can still be reached; the lower of both is within the limits too. To keep the length of
a path all wished speeds are shifted by one bias; the length driven grows with it, and the bias is found by cutting its range again and again.
"""

from __future__ import annotations

import numpy as np

#: Step (s), accelerations (m/s2), margin that edited paths keep from them, top speed (m/s).
DT, BRAKE, PUSH, MARGIN, TOP = 0.1, -6.0, 2.0, 0.01, 15.0
#: Length that may be missed (m, share of the way), slack of the check afterwards, least speed of an even pace.
MISSED, MISSED_SHARE, SLACK, CRAWL = 0.25, 0.02, 0.2, 0.2
#: Ways and speeds below which nothing moves.
STILL, STANDING = 1e-6, 1e-3
#: How often a bias range is cut, in half or less each time.
CUTS = 20


def lengths(x: np.ndarray, y: np.ndarray, origin: bool = True) -> np.ndarray:
    """Lengths of the pieces of each path; the first is from the origin, if asked for."""
    dx, dy = (np.diff(v, axis=1, prepend=0.0) if origin else np.diff(v, axis=1) for v in (x, y))
    return np.hypot(dx, dy)


def along(gone: np.ndarray, values: np.ndarray, way: np.ndarray) -> np.ndarray:
    """Values at ways along paths, for all rows at once; ``gone`` ascends, ends stay."""
    piece = np.clip((gone[:, None, :] <= way[:, :, None]).sum(2) - 1, 0, gone.shape[1] - 2)
    at = lambda v, k: np.take_along_axis(v, piece + k, 1)
    size = at(gone, 1) - at(gone, 0)
    part = np.clip(np.where(size > 0, (way - at(gone, 0)) / np.where(size > 0, size, 1.0), 1.0), 0.0, 1.0)
    return at(values, 0) + (at(values, 1) - at(values, 0)) * part


def limited_speed(wished: np.ndarray, start: np.ndarray | None = None, dt=DT, low: float = BRAKE, high: float = PUSH, top: float = np.inf) -> np.ndarray:
    """Speeds nearest to the wished ones, each within the accelerations from the one before; the first one is free, or follows ``start``
    where that is finite. ``dt`` is one number, or one for each step."""
    wished = np.clip(np.where(np.isfinite(wished), wished, 0.0), 0.0, top)
    out = wished.copy()
    step = np.broadcast_to(np.asarray(dt, float), wished.shape[-1:]) if np.ndim(dt) < 2 else dt
    last = wished[..., 0] if start is None else np.where(np.isfinite(start), np.clip(start, 0.0, top), wished[..., 0])
    for i in range(0 if start is not None else 1, wished.shape[-1]):
        reach = np.maximum(step[..., i], STILL)
        if i == 0:
            free = ~np.isfinite(start)
            out[..., 0] = np.where(free, wished[..., 0], np.clip(wished[..., 0], np.maximum(0.0, last + low * reach), last + high * reach))
        else:
            out[..., i] = np.clip(wished[..., i], np.maximum(0.0, last + low * reach), np.minimum(top, last + high * reach))
        last = out[..., i]
    return out


def biased(profile, total: np.ndarray, dt: float = DT) -> tuple[np.ndarray, np.ndarray]:
    """(speeds, miss): of the profiles that a bias of -TOP to TOP gives, those whose way is nearest to the total. ``profile`` takes biases of
    shape (rows, k) and returns (rows, k, steps). The way is made of straight pieces in the bias, so each cut tries the middle of the range
    and the place where the chord of its ends meets the total."""
    off = lambda bias: profile(bias).sum(2) * dt - total[:, None]
    ends = np.tile([-TOP, TOP], (len(total), 1)).astype(float)
    miss = off(ends)
    for _ in range(CUTS):
        rise = miss[:, 1] - miss[:, 0]
        part = np.where(rise > 0, -miss[:, 0] / np.where(rise > 0, rise, 1.0), 0.5)
        tried = np.sort(ends[:, :1] + (ends[:, 1:] - ends[:, :1]) * np.stack([np.clip(part, 0.0, 1.0), np.full(len(part), 0.5)], axis=1), axis=1)
        every, offs = np.concatenate([ends[:, :1], tried, ends[:, 1:]], axis=1), np.concatenate([miss[:, :1], new := off(tried), miss[:, 1:]], axis=1)
        low = (new < 0).sum(1)[:, None]
        ends, miss = (np.concatenate([np.take_along_axis(v, low, 1), np.take_along_axis(v, low + 1, 1)], axis=1) for v in (every, offs))
    both = profile(ends)
    miss = np.abs(miss)
    nearer = miss.argmin(1)
    rows = np.arange(len(total))
    return both[rows, nearer], miss[rows, nearer]


def _allowed(total: np.ndarray) -> np.ndarray:
    return np.maximum(MISSED, MISSED_SHARE * total)


def _driven(x, y, gone, speed, total, dt=DT) -> tuple:
    """Points after each step at the speeds; an end that is nearly reached is reached."""
    way = np.minimum(np.cumsum(speed * dt, axis=1), total[:, None])
    near = np.abs(way[:, -1] - total) <= _allowed(total)
    way[near, -1] = total[near]
    return along(gone, x, way), along(gone, y, way), way


def _from_origin(x, y) -> tuple:
    piece = lengths(x, y)
    gone = np.concatenate([np.zeros((len(x), 1)), np.cumsum(piece, axis=1)], axis=1)
    px, py = (np.concatenate([np.zeros((len(v), 1)), v], axis=1) for v in (x, y))
    return piece, gone, px, py


def limited_resample(x: np.ndarray, y: np.ndarray, initial: np.ndarray | None = None, anchored: bool = False, dt: float = DT, margin: float = MARGIN) -> tuple:
    """The same path from the origin at accelerations within the limits less a margin, from an initial speed where that is finite; ``anchored``
    holds the first step at that speed. NaN where the length can't be kept or the result breaks the limits by more than a little; rows
    without a way rest at the origin."""
    piece, gone, px, py = _from_origin(x, y)
    total = gone[:, -1]
    start = np.full(len(x), np.nan) if initial is None else np.asarray(initial, float)
    known = np.isfinite(start)
    low, high = BRAKE + margin, PUSH - margin

    def profile(bias):
        wished = piece[:, None, :] / dt + bias[:, :, None]
        if anchored:
            wished[:, :, 0] = np.where(known, start, wished[:, :, 0].T).T
        return limited_speed(wished, np.broadcast_to(start[:, None], bias.shape), dt, low, high, TOP)

    speed, miss = biased(profile, total, dt)
    out_x, out_y, _ = _driven(px, py, gone, speed, total, dt)
    now = lengths(out_x, out_y) / dt
    accel = np.diff(now, axis=1, prepend=now[:, :1]) / dt
    accel[:, 0] = np.where(known, (now[:, 0] - start) / dt, accel[:, 0])
    bad = (miss > _allowed(total)) | (accel.min(1) < BRAKE - SLACK) | (accel.max(1) > PUSH + SLACK) | (x.shape[1] < 2)
    rest = total <= STILL
    return tuple(np.where(rest[:, None], 0.0, np.where(bad[:, None], np.nan, v)) for v in (out_x, out_y))


def from_speed(x: np.ndarray, y: np.ndarray, speed: np.ndarray) -> tuple:
    """The same path from the origin, driven from a given speed within the limits; as it is where the speed is NaN or the length can't be
    kept, at the origin where there is no way."""
    out = [x.copy(), y.copy()]
    rows = np.flatnonzero(np.isfinite(speed))
    if len(rows) and x.shape[1] > 1:
        piece, gone, px, py = _from_origin(x[rows], y[rows])
        total = gone[:, -1]
        wished, start = np.clip(piece / DT, 0.0, TOP), np.clip(speed[rows], 0.0, TOP)
        best, miss = biased(lambda bias: limited_speed(wished[:, None, :] + bias[:, :, None], np.broadcast_to(start[:, None], bias.shape), top=TOP), total)
        held, rest = miss <= _allowed(total), total <= STILL
        for o, new in zip(out, _driven(px, py, gone, best, total)):
            o[rows] = np.where(rest[:, None], 0.0, np.where(held[:, None], new, o[rows]))
    return out[0], out[1]


def repaired_path(x: np.ndarray, y: np.ndarray, initial: np.ndarray) -> tuple:
    """A true path kept to its end at accelerations within the limits, and the acceleration of each step; NaN where that can't be done."""
    piece, gone, px, py = _from_origin(x, y)
    total = gone[:, -1]
    wished, start = np.clip(piece / DT, 0.0, TOP), np.where(np.isfinite(initial), np.clip(initial, 0.0, TOP), np.nan)
    best, miss = biased(lambda bias: np.minimum(limited_speed(wished[:, None, :] + bias[:, :, None], np.broadcast_to(start[:, None], bias.shape)), TOP), total)
    out_x, out_y, _ = _driven(px, py, gone, best, total)
    accel = np.diff(best, axis=1, prepend=np.where(np.isfinite(start), start, best[:, 0])[:, None]) / DT
    rest = (total <= STILL)[:, None]
    bad = (miss > _allowed(total))[:, None] | (x.shape[1] < 2) | ~np.isfinite(total)[:, None]
    return tuple(np.where(rest, 0.0, np.where(bad, np.nan, v)) for v in (out_x, out_y, np.clip(accel, BRAKE, PUSH)))


def repaired_velocity(vx: np.ndarray, vy: np.ndarray, dt: np.ndarray, initial: np.ndarray) -> tuple:
    """A path of velocities in the frame of its start, the speed limited from an initial one where that is finite: directions stay (where
    nothing moves, as before; at first, as after), points are trapezoids of the velocities. ``dt`` has a value for each step; x, y and the
    acceleration have one entry fewer than the velocities."""
    raw = np.hypot(vx, vy)
    wished = raw.copy()
    wished[:, 0] = np.where(np.isfinite(initial), np.clip(initial, 0.0, TOP), wished[:, 0])
    reach = np.concatenate([np.full((len(dt), 1), DT), dt], axis=1)
    speed = limited_speed(wished, dt=reach)
    moving = raw > STANDING
    last = np.maximum.accumulate(np.where(moving, np.arange(raw.shape[1]), -1), axis=1)
    at = np.where(last < 0, moving.argmax(1)[:, None], last)
    size = np.take_along_axis(raw, at, 1)
    ever = moving.any(1)[:, None]
    ux, uy = (np.where(ever, np.take_along_axis(v, at, 1) / np.where(ever, size, 1.0), other) for v, other in ((vx, 1.0), (vy, 0.0)))
    trapezoids = lambda v: np.cumsum((v[:, :-1] + v[:, 1:]) / 2 * dt, axis=1)
    accel = np.clip(np.diff(speed, axis=1) / np.maximum(dt, STILL), BRAKE, PUSH)
    bad = ~(dt > 0).all(1)[:, None] | ~np.isfinite(raw).all(1)[:, None]
    return tuple(np.where(bad, np.nan, v) for v in (trapezoids(ux * speed), trapezoids(uy * speed), accel))


def _even_shares(total: np.ndarray, initial: np.ndarray, steps: int, dt: float) -> np.ndarray:
    """Shares of the way after each step of a speed that changes evenly from the initial one and keeps the mean, both ends at CRAWL at least."""
    twice = 2.0 * total / (steps * dt)
    first = np.clip(initial, CRAWL, np.maximum(twice, CRAWL))
    last = np.maximum(twice - first, CRAWL)
    u = np.arange(1, steps + 1) / steps
    return u * (2.0 * first[:, None] + (last - first)[:, None] * u) / (first + last)[:, None]


def scheduled_resample(x: np.ndarray, y: np.ndarray, initial: np.ndarray, steps: int, dt: float = DT) -> tuple:
    """Points of each path after 1 to ``steps`` steps of a speed that changes evenly, from its first point to its last. A path without a
    way stays at its first point."""
    gone = np.concatenate([np.zeros((len(x), 1)), np.cumsum(lengths(x, y, origin=False), axis=1)], axis=1)
    total = gone[:, -1]
    way = np.minimum(_even_shares(total, initial, steps, dt), 1.0) * total[:, None]
    rest = (total <= STILL)[:, None]
    return tuple(np.where(rest, v[:, :1], along(gone, v, way)) for v in (x, y))


def shared_frames(sections: np.ndarray, frames: int) -> np.ndarray:
    """Frames for sections of a path by their lengths: one for each that has a length and the rest by largest remainders, or one for each of
    the longest if there are too few. Earlier sections come first among equals."""
    out = np.zeros(len(sections), int)
    real = np.flatnonzero(sections > STILL)
    if frames <= 0 or not len(sections):
        return out
    if not len(real):
        out[0] = frames
    elif frames <= len(real):
        out[real[np.argsort(-sections[real], kind="stable")[:frames]]] = 1
    else:
        exact = (frames - len(real)) * sections[real] / sections[real].sum()
        whole = np.floor(exact)
        more = np.argsort(-(exact - whole), kind="stable")[: int(frames - len(real) - whole.sum())]
        whole[more] += 1
        out[real] = 1 + whole.astype(int)
    return out


def held_frames(durations: list, steps: int, dt: float = DT) -> list[int]:
    """Frames that stops last. Where they leave fewer than two frames to move they are scaled, at least one each, and the longest are cut."""
    held = [round(d / dt) for d in durations]
    most = max(0, steps - 2)
    if sum(held) > most:
        factor = most / sum(held)
        held = [max(1, round(h * factor)) if h > 0 else 0 for h in held]
        while sum(held) > most:
            held[held.index(max(held))] -= 1
    return held


def _eased(frames: int, from_stop: bool, to_stop: bool) -> np.ndarray:
    """Shares of a section after each of its frames, slow at the ends at which the path stands."""
    u = np.arange(1, frames + 1) / (frames + 1 if to_stop else max(frames, 1))
    if from_stop and to_stop:
        return u * u * (3.0 - 2.0 * u)
    return u * u if from_stop else u * (2.0 - u) if to_stop else u


def stopping_way(total: float, fractions: list, durations: list, steps: int, dt: float = DT) -> np.ndarray | None:
    """Ways after each step along a path that stands at shares of it for a time; None if no stop lasts a frame."""
    stops = [(float(np.clip(f, 0.0, 1.0)), d) for f, d in zip(fractions or [], durations or []) if f is not None and d is not None and np.isfinite(f) and np.isfinite(d) and round(d / dt) > 0]
    if not stops:
        return None
    kept = [(f, h) for (f, _), h in zip(stops, held_frames([d for _, d in stops], steps, dt)) if h > 0]
    kept.sort(key=lambda s: s[0])
    bounds = np.array([0.0, *(f * total for f, _ in kept), total])
    frames = shared_frames(np.maximum(np.diff(bounds), 0.0), max(0, steps - sum(h for _, h in kept)))
    parts = []
    for i, n in enumerate(frames):
        parts.append(bounds[i] + (bounds[i + 1] - bounds[i]) * _eased(int(n), i > 0, i < len(kept)))
        if i < len(kept):
            parts.append(np.full(kept[i][1], bounds[i + 1]))
    way = np.concatenate(parts)[:steps]
    return np.concatenate([way, np.full(steps - len(way), way[-1] if len(way) else total)])


def stopping_resample(x: np.ndarray, y: np.ndarray, initial: np.ndarray, fractions: list, durations: list, steps: int, dt: float = DT) -> tuple:
    """Points of each path after 1 to ``steps`` steps with its own stops (a list of shares and one of durations for each row); paths without
    stops go at an even change of speed."""
    gone = np.concatenate([np.zeros((len(x), 1)), np.cumsum(lengths(x, y, origin=False), axis=1)], axis=1)
    total = gone[:, -1]
    way = np.minimum(_even_shares(total, initial, steps, dt), 1.0) * total[:, None]
    for i, (f, d) in enumerate(zip(fractions, durations)):
        own = stopping_way(float(total[i]), f, d, steps, dt)
        if own is not None:
            way[i] = own
    rest = (total <= STILL)[:, None]
    return tuple(np.where(rest, v[:, :1], along(gone, v, np.clip(way, 0.0, total[:, None]))) for v in (x, y))


def final_stop_resample(x: np.ndarray, y: np.ndarray, initial: np.ndarray, duration: np.ndarray, steps: int, dt: float = DT) -> tuple:
    """Points of each path after 1 to ``steps`` steps that end with a stand of the given time at its last point: speeds follow the even change of
    speed as far as accelerations and the stop allow. NaN where fewer than three frames are left to move, the length can't be
    kept or the result has bad accelerations or jumps; paths without a way stay at their last point."""
    from helmtrack.functions import profiles

    out = [np.full((len(x), steps), np.nan) for _ in "xy"]
    gone = np.concatenate([np.zeros((len(x), 1)), np.cumsum(lengths(x, y, origin=False), axis=1)], axis=1)
    total = gone[:, -1]
    held = np.clip(np.round(np.where(np.isfinite(duration), duration, 0.0) / dt).astype(int), 1, max(1, steps - 3))
    for hold in np.unique(held):
        rows = np.flatnonzero((held == hold) & (total > STILL))
        moving = steps - int(hold)
        if moving < 3 or not len(rows):
            continue
        wished = lengths(*scheduled_resample(x[rows], y[rows], initial[rows], moving, dt)) / dt
        ramp = np.minimum(np.arange(moving, 0, -1) * -(BRAKE + MARGIN) * dt, TOP)
        speed, miss = biased(lambda bias: np.minimum(limited_speed(wished[:, None, :] + bias[:, :, None], None, dt, BRAKE + MARGIN, PUSH - MARGIN, TOP), ramp), total[rows], dt)
        px, py, _ = _driven(x[rows], y[rows], gone[rows], speed, total[rows], dt)
        bad = miss > _allowed(total[rows])
        found = [np.concatenate([np.where(bad[:, None], np.nan, p), np.repeat(v[rows, -1:], hold, axis=1)], axis=1) for p, v in ((px, x), (py, y))]
        good = ~bad
        good[good] = profiles.quality(found[0][good], found[1][good])[0] > 0
        for o, f in zip(out, found):
            o[rows[good]] = f[good]
    rest = total <= STILL
    for o, v in zip(out, (x, y)):
        o[rest] = v[rest, -1:]
    return out[0], out[1]
