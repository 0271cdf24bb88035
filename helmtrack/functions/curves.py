"""Curves as blocks of points: discrete Frechet distances of many pairs at once, sampling, and lines that follow a history.

A curve is a list of numbers with ``width`` of them for each point.
"""

from __future__ import annotations

import numpy as np

#: Cells of an antidiagonal that are held at a time: pairs of curves go in pieces of that size.
CELLS = 1 << 20


def _pairs(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    n, m = a.shape[1], b.shape[1]
    # Entry i + 1 of an antidiagonal is the cell (i, t - i); entry 0 and cells outside stay infinite.
    before = np.full((len(a), n + 1), np.inf)
    last = before.copy()
    for t in range(n + m - 1):
        low, high = max(0, t - m + 1), min(n, t + 1)
        i = np.arange(low, high)
        apart = ((a[:, i] - b[:, t - i]) ** 2).sum(2)
        reach = np.minimum(np.minimum(last[:, i + 1], last[:, i]), before[:, i]) if t else np.zeros((len(a), 1))
        before, last = last, np.full((len(a), n + 1), np.inf)
        last[:, i + 1] = np.maximum(apart, reach)
    return np.sqrt(last[:, n])


def frechet_pairs(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Discrete Frechet distance of each curve of ``a`` (pairs, points, width) and the curve of ``b`` in the same place: the
    table of a pair is filled by antidiagonals, for all pairs of a piece together."""
    step = max(1, CELLS // max(1, a.shape[1] * a.shape[2]))
    found = [_pairs(a[k : k + step], b[k : k + step]) for k in range(0, len(a), step)]
    return np.concatenate(found) if found else np.zeros(0)


def reached(apart) -> np.ndarray:
    """The least of the greatest entry on the ways through a table of cells, by rows; a cell has its entries for all pairs at once."""
    before = None
    for row in apart:
        now: list = []
        for j, cell in enumerate(row):
            ways = ([] if before is None else before[j : j + 1] + before[max(j - 1, 0) : j]) + now[-1:]
            least = ways[0] if ways else cell
            for way in ways[1:]:
                least = np.minimum(least, way)
            now.append(np.maximum(cell, least))
        before = now
    return before[-1]


def squares_between(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared discrete Frechet distances of all curves of ``a`` (n, points, width) from all of ``b``, each cell of the table for all pairs at once."""
    square = lambda i, j: sum((a[:, None, i, c] - b[None, :, j, c]) ** 2 for c in range(a.shape[2]))
    return reached(((square(i, j) for j in range(b.shape[1])) for i in range(a.shape[1])))


#: Curves of each side, and then pairs, whose tables ``squares_near`` fills at a time.
TILE, SLICE = (64, 1024), 1 << 13


def _near_diagonal(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For all pairs of ``a`` and ``b`` (points, width, curves) the squares on ways at most one cell beside the diagonal, and the least square
    two cells beside it, in arrays that are used again for each cell."""
    n, width, shape = len(a), a.shape[1], (a.shape[2], b.shape[2])
    low, high, middle, cell, part = (np.empty(shape) for _ in range(5))

    def square(i: int, j: int, out: np.ndarray) -> np.ndarray:
        for c in range(width):
            to = part if c else out
            np.subtract(a[i, c][:, None], b[j, c], out=to)
            np.multiply(to, to, out=to)
            if c:
                np.add(out, part, out=out)
        return out

    square(0, 0, middle)
    low.fill(np.inf)
    high.fill(np.inf)
    for i in range(1, n):
        for beside, at in ((high, (i - 1, i)), (low, (i, i - 1))):
            np.minimum(beside, middle, out=beside)
            np.maximum(beside, square(*at, cell), out=beside)
        np.minimum(middle, high, out=middle)
        np.minimum(middle, low, out=middle)
        np.maximum(middle, square(i, i, cell), out=middle)
    low.fill(np.inf)
    for i in range(n - 2):
        np.minimum(low, square(i, i + 2, cell), out=low)
        np.minimum(low, square(i + 2, i, cell), out=low)
    return middle, low


def squares_near(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """What ``squares_between`` gives, for curves that mostly keep step: only cells near the diagonal of a pair's table are looked at. Any way
    that goes farther off meets a cell two beside it; pairs where one of these is nearer have their whole tables filled."""
    n, m = a.shape[1], b.shape[1]
    whole, left = np.full((len(a), len(b)), np.inf), np.zeros((len(a), len(b)), bool)
    p, q = np.ascontiguousarray(a.transpose(1, 2, 0)), np.ascontiguousarray(b.transpose(1, 2, 0))
    for i in range(0, len(a) if n and m else 0, TILE[0]):
        for j in range(0, len(b), TILE[1]):
            at = slice(i, i + TILE[0]), slice(j, j + TILE[1])
            if n == m:
                whole[at], beside = _near_diagonal(p[:, :, at[0]], q[:, :, at[1]])
                np.logical_not(beside >= whole[at], out=left[at])
            else:
                whole[at] = squares_between(a[at[0]], b[at[1]])
    row, column = np.nonzero(left)
    for k in range(0, len(row), SLICE):
        at = row[k : k + SLICE], column[k : k + SLICE]
        whole[at] = _whole(p[:, :, at[0]], q[:, :, at[1]])
    return whole


def _whole(u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Squared distances of each curve of ``u`` (points, width, pairs) from that of ``v`` in the same place, from their whole tables."""
    square = lambda k, m: sum((u[k, c] - v[m, c]) ** 2 for c in range(u.shape[1]))
    return reached(((square(k, m) for m in range(len(v))) for k in range(len(u))))


#: Cells on each side of the diagonal that ``squares_within`` looks at; rows after which it drops pairs.
BESIDE, CHECKED = 2, 8


def squares_within(a: np.ndarray, b: np.ndarray, limit: np.ndarray) -> np.ndarray:
    """Squared discrete Frechet distances of each curve of ``a`` (pairs, points, width) from that of ``b`` in the same place, where they are at most the
    square ``limit`` of the pair; larger ones, and those that are no number, may be infinite. Ways within the limit mostly stay near the diagonal of a
    table. A pair is dropped where all ways near it are beyond the limit and so are the cells next to these, which any other way must meet; a pair
    where such a cell is nearer has its whole table filled."""
    out, n = np.full(len(a), np.inf), a.shape[1]
    u, v = (np.ascontiguousarray(x.transpose(1, 2, 0)) for x in (a, b))
    if n != b.shape[1]:
        for k in range(0, len(a), SLICE):
            out[k : k + SLICE] = _whole(u[:, :, k : k + SLICE], v[:, :, k : k + SLICE])
        return np.where(np.isnan(out), np.inf, out)
    square = lambda i, j: sum((u[i, c] - v[j, c]) ** 2 for c in range(u.shape[1]))
    live, beside, row, opened = np.arange(len(a)), np.full(len(a), np.inf), {}, []
    for i in range(n):
        now: dict = {}
        for j in range(max(0, i - BESIDE), min(n, i + BESIDE + 1)):
            cell = square(i, j)
            ways = [w for w in (row.get(j), row.get(j - 1), now.get(j - 1)) if w is not None]
            for way in ways[1:]:
                ways[0] = np.minimum(ways[0], way)
            now[j] = np.maximum(cell, ways[0]) if ways else cell
        row = now
        for j in (i - BESIDE - 1, i + BESIDE + 1):
            if 0 <= j < n:
                beside = np.minimum(beside, square(i, j))
        if i % CHECKED == CHECKED - 1 and i < n - 1:
            least = row[i]
            for cell in row.values():
                least = np.minimum(least, cell)
            stays = least <= limit[live]
            if 4 * stays.sum() <= 3 * len(live):
                opened.append(live[~stays & ~(beside > limit[live])])
                live, beside, row, u, v = live[stays], beside[stays], {j: cell[stays] for j, cell in row.items()}, u[:, :, stays], v[:, :, stays]
    out[live] = row[n - 1] if n else np.inf
    opened.append(live[~(beside >= np.minimum(out[live], limit[live]))])
    opened = np.concatenate(opened)
    for k in range(0, len(opened), SLICE):
        at = opened[k : k + SLICE]
        out[at] = _whole(a[at].transpose(1, 2, 0), b[at].transpose(1, 2, 0))
    return np.where(np.isnan(out), np.inf, out)


#: Curves of each side whose bounds are held at a time; numbers beyond which there are no bounds in single precision.
BOUNDED, GREATEST = 256, 1e15


def bounded_sums(a: np.ndarray, b: np.ndarray, above: bool = False) -> tuple[np.ndarray, np.ndarray] | None:
    """For each curve of ``a`` (n, points, width), and for each of ``b``, what the sum of its distances from all of the other side is at least, or
    with ``above`` at most. Of two curves the greatest square on the diagonal of their table is what the square of their distance is at most. Any other way
    meets a cell next to the diagonal, and all have both ends: the greater of the nearest such cell and the ends, where it is less than that, is what it
    is at least. Squares are products of matrices in single precision, and bounds are wider by what these may be off. None for other numbers of
    points or numbers that don't fit."""
    n, width = a.shape[1:]
    if not n or b.shape[1:] != a.shape[1:] or not (np.abs(a) < GREATEST).all() or not (np.abs(b) < GREATEST).all():
        return None
    u, v = a.transpose(1, 0, 2), b.transpose(1, 0, 2)
    # Cells of the diagonal, then those above and those below it, each from a place between its points.
    at = np.concatenate([np.arange(n), np.arange(n - 1), np.arange(1, n)])
    to = np.concatenate([np.arange(n), np.arange(1, n), np.arange(n - 1)])
    middle = (u.mean(1)[at] + v.mean(1)[to])[:, None] / 2
    p, q = u[at] - middle, v[to] - middle
    square, one = (lambda x: (x * x).sum(2, keepdims=True)), (lambda x: np.ones((*x.shape[:2], 1)))
    off = (8 + width) * 4 * 2.0**-24 * ((p2 := square(p)).max(initial=0.0) + (q2 := square(q)).max(initial=0.0))
    p = np.concatenate([-2 * p, p2, one(p)], axis=2).astype(np.float32)
    q = np.concatenate([q, one(q), q2], axis=2).astype(np.float32).transpose(0, 2, 1).copy()
    rows, columns = np.zeros(len(a)), np.zeros(len(b))
    for i in range(0, len(a), BOUNDED):
        for j in range(0, len(b), BOUNDED):
            x, y = p[:, i : i + BOUNDED], q[:, :, j : j + BOUNDED]
            most = np.maximum(x[0] @ y[0], x[n - 1] @ y[n - 1])
            least, cell = (np.full_like(most, np.inf) if n == 1 else x[n] @ y[n]), np.empty_like(most)
            for k in range(n + 1, 0 if above else len(at)):
                np.minimum(least, np.matmul(x[k], y[k], out=cell), out=least)
            np.maximum(least, most, out=least)
            for k in range(1, n - 1):
                np.maximum(most, np.matmul(x[k], y[k], out=cell), out=most)
            if above:
                most += np.float32(off)
            else:
                np.minimum(most, least, out=most)
                most -= np.float32(off)
            np.sqrt(np.maximum(most, 0, out=most), out=most)
            rows[i : i + BOUNDED] += most.sum(1, dtype=float)
            columns[j : j + BOUNDED] += most.sum(0, dtype=float)
    return rows, columns


def points_of(curve: list, width: int) -> np.ndarray:
    return np.asarray(curve, float).reshape(-1, width)


def frechet_table(a: list, b: list) -> np.ndarray:
    """Distances of all curves of ``a`` from all of ``b``; lengths may differ."""
    out = np.empty((len(a), len(b)))
    by_length = lambda curves: {n: [i for i, c in enumerate(curves) if len(c) == n] for n in {len(c) for c in curves}}
    of_b = by_length(b)
    for rows in by_length(a).values():
        x = np.stack([a[i] for i in rows])
        for columns in of_b.values():
            out[np.ix_(rows, columns)] = np.sqrt(squares_near(x, np.stack([b[j] for j in columns])))
    return out


def sampled(points: int, wanted: int) -> list[int]:
    """The places of ``wanted`` points spread over a curve, halves going to the even place; all places of shorter ones."""
    return list(range(points)) if points <= wanted else [round(k * (points - 1) / (wanted - 1)) for k in range(wanted)]


#: Points of a history line's grid and of the plain axis, how far they reach, the least step and spread.
GRID, AXIS, AHEAD, LEAST_AHEAD, BEHIND, AXIS_BEHIND = 160, 120, 5.0, 20.0, -1.0, -10.0
STILL, MERGED = 1e-6, 3
#: Squared distances that count as equal.
TIED = 1e-9


def _total(values: np.ndarray) -> np.ndarray:
    """A sum in order of the steps, so that SQL can have the same."""
    out = np.zeros(len(values))
    for column in values.T:
        out = out + column
    return out


def history_line(hx: np.ndarray, hy: np.ndarray, ahead: float) -> np.ndarray:
    """The reference line of one history: a parabola (a line where there are but two different x to 3 digits) fitted to its
    points and drawn from behind them to ``ahead`` and more, by x, with the origin among its points. A history without spread at the
    origin is a ray along x; one without points is the axis."""
    fine = np.isfinite(hx) & np.isfinite(hy)
    x, y = hx[fine], hy[fine]
    if len(x) < 2:
        grid = np.linspace(AXIS_BEHIND, max(LEAST_AHEAD, ahead + AHEAD), AXIS)
        return np.stack([grid, np.zeros(AXIS)], axis=1)
    same = x.min() == x.max()
    mean_x, mean_y = x[0] if same else _total(x[None])[0] / len(x), _total(y[None])[0] / len(x)
    u, v = x - mean_x, y - mean_y
    u2, u3, u4, uv, u2v = (_total(t[None])[0] for t in (u * u, u * u * u, u * u * (u * u), u * v, u * u * v))
    bent = len(np.unique(np.round(x, MERGED))) > 2
    if same:
        if mean_x == 0.0:
            end = max(ahead + AHEAD, LEAST_AHEAD)
            step = np.array([x[-1] - x[-2], y[-1] - y[-2]])
            length = np.sqrt(step[0] * step[0] + step[1] * step[1])
            step = step / length if length >= STILL else np.array([1.0, 0.0])
            return np.array([[x[0], y[0]], [x[-1], y[-1]], [x[-1] + step[0] * end, y[-1] + step[1] * end]])
        # Of all lines through the point the one of least coefficients, each scaled by its column.
        c0, c1, c2, mean_x = mean_y / 2, mean_y / (2 * mean_x), 0.0, 0.0
    elif bent:
        n = float(len(x))
        det = u2 * (n * u4 - u2 * u2) - n * u3 * u3
        c1 = (uv * (n * u4 - u2 * u2) - u3 * (n * u2v)) / det
        c2 = (u2 * (n * u2v) - n * u3 * uv) / det
        c0 = mean_y - c2 * (u2 / n)
    else:
        c0, c1, c2 = mean_y, uv / u2, 0.0
    start, stop = min(float(x.min()), BEHIND), max(ahead + AHEAD, LEAST_AHEAD)
    grid = start + np.arange(GRID) * ((stop - start) / (GRID - 1))
    w = grid - mean_x
    line = np.concatenate([np.stack([grid, c0 + (c1 * w + c2 * (w * w))], axis=1), [[0.0, 0.0]]])
    return line[np.argsort(line[:, 0], kind="stable")]


def projected(points: np.ndarray, line: np.ndarray) -> np.ndarray:
    """(s, l) of each point: the way along the line to the nearest place on it, from where the origin lies, and the offset to its left.
    Ends of the line aren't extended; of pieces equally near (squares within 1e-9, as on both sides of a corner) the first counts."""
    a, d = line[:-1], np.diff(line, axis=0)
    length = np.sqrt(d[:, 0] * d[:, 0] + d[:, 1] * d[:, 1])
    a, d, length = a[length > STILL], d[length > STILL], length[length > STILL]
    if not len(length):
        return points.copy()
    gone = np.concatenate([[0.0], np.cumsum(length)])[:-1]
    p = np.concatenate([points, [[0.0, 0.0]]])
    rx, ry = p[:, :1] - a[:, 0], p[:, 1:] - a[:, 1]
    t = np.clip((rx * d[:, 0] + ry * d[:, 1]) / (length * length), 0.0, 1.0)
    ox, oy = p[:, :1] - (a[:, 0] + d[:, 0] * t), p[:, 1:] - (a[:, 1] + d[:, 1] * t)
    square = ox * ox + oy * oy
    near = np.argmax(square <= square.min(axis=1, keepdims=True) + TIED, axis=1)
    row = np.arange(len(p))
    s = gone[near] + t[row, near] * length[near]
    left = (d[near, 0] * oy[row, near] - d[near, 1] * ox[row, near]) / length[near]
    return np.stack([s - s[-1], left], axis=1)[:-1]


def frenet(x: np.ndarray, y: np.ndarray, hx: np.ndarray, hy: np.ndarray, dt: float = 0.1) -> tuple:
    """s, l and their rates for blocks of trajectories and the local history of each."""
    found = np.stack([projected(np.stack([a, b], axis=1), history_line(c, d, float(np.nanmax(a)))) for a, b, c, d in zip(x, y, hx, hy)])
    s, left = found[:, :, 0], found[:, :, 1]
    rate = lambda v: np.gradient(v, dt, axis=1) if v.shape[1] > 1 else np.zeros_like(v)
    return s, left, rate(s), rate(left)
