"""Column functions of poses and cameras: quaternions (x, y, z, w), local frames, object boxes, projection."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from helmtrack.functions.arrays import finite

#: Least way (m) over how many steps that tells a heading; least side of an object's box (m).
HEADING_WAY, HEADING_STEPS, LEAST_SIDE = 0.2, 5, 0.2


def _total(values: list[Column]) -> Column:
    out = values[0]
    for v in values[1:]:
        out = out + v
    return out


def normal_quaternion(q: list[Column]) -> list[Column]:
    """Components over their norm, which counts as 1e-8 at least."""
    norm = F.greatest(F.sqrt(_total([c * c for c in q])), F.lit(1e-8))
    return [c / norm for c in q]


def rotation_matrix(q: list[Column]) -> list[list[Column]]:
    """The rows of the matrix of a quaternion of any length but 0."""
    square = _total([c * c for c in q])
    x, y, z, w = q
    entry = lambda v: v * 2.0 / square
    return [
        [1.0 - entry(y * y + z * z), entry(x * y - z * w), entry(x * z + y * w)],
        [entry(x * y + z * w), 1.0 - entry(x * x + z * z), entry(y * z - x * w)],
        [entry(x * z - y * w), entry(y * z + x * w), 1.0 - entry(x * x + y * y)],
    ]


def rotated(v: list[Column], q: list[Column], inverse: bool = False) -> list[Column]:
    """A vector turned by a quaternion, or back."""
    m = rotation_matrix(q)
    return [_total([(m[j][i] if inverse else m[i][j]) * v[j] for j in range(3)]) for i in range(3)]


def quaternion_yaw(q: list[Column]) -> Column:
    x, y, z, w = q
    return F.atan2((w * z + x * y) * 2.0, w * w + x * x - y * y - z * z)


def motion_yaw(xs: Column, ys: Column, q: list[Column], steps: int = HEADING_STEPS, least: float = HEADING_WAY) -> Column:
    """The heading at the last point of a history: of the way over the last steps, if that is long enough, else
    the quaternion's yaw."""
    first = F.greatest(F.size(xs) - steps, F.lit(1))
    dx, dy = (F.element_at(v, -1) - F.element_at(v, first) for v in (xs, ys))
    return F.when(F.sqrt(dx * dx + dy * dy) >= least, F.atan2(dy, dx)).otherwise(quaternion_yaw(q))


def local_points(xs: Column, ys: Column, x0: Column, y0: Column, yaw: Column) -> tuple[Column, Column]:
    """Points in the frame of a pose: x ahead, y to the left."""
    ahead = F.zip_with(xs, ys, lambda x, y: (x - x0) * F.cos(yaw) + (y - y0) * F.sin(yaw))
    left = F.zip_with(xs, ys, lambda x, y: (y - y0) * F.cos(yaw) - (x - x0) * F.sin(yaw))
    return ahead, left


def to_bev(xs: Column, ys: Column) -> tuple[Column, Column, Column]:
    """x ahead, y left as the bird's-eye axes right, ahead, up (0)."""
    return F.transform(ys, lambda y: -y), xs, F.transform(xs, lambda _: F.lit(0.0))


def integrated(seconds: Column, velocity: Column) -> Column:
    """Positions after each step of one velocity component, by trapezoids; null unless all steps take time.
    ``seconds`` and ``velocity`` are as long as each other."""
    n = F.size(seconds) - 1
    dt = F.zip_with(F.slice(seconds, 2, n), F.slice(seconds, 1, n), lambda b, a: b - a)
    mean = F.zip_with(F.slice(velocity, 1, n), F.slice(velocity, 2, n), lambda a, b: (a + b) / 2)
    add = lambda out, d: F.concat(out, F.array(F.coalesce(F.try_element_at(out, F.lit(-1)), F.lit(0.0)) + d))
    way = F.aggregate(F.zip_with(dt, mean, lambda t, v: t * v), F.array().cast("array<double>"), add)
    return F.when((n > 0) & F.forall(dt, lambda t: finite(t) & (t > 0)), way)


def object_centre(x: Column, y: Column, x_kf: Column | None = None, y_kf: Column | None = None) -> tuple[Column, Column]:
    """An object's centre as x ahead, y left. It is stored as right, backward; the filtered pair is taken if both of
    it are finite; of the plain pair what isn't finite is 0."""
    right, back = (F.when(finite(v), v).otherwise(0.0) for v in (x, y))
    if x_kf is not None and y_kf is not None:
        both = finite(x_kf) & finite(y_kf)
        right, back = F.when(both, x_kf).otherwise(right), F.when(both, y_kf).otherwise(back)
    return -back, -right


def object_footprint(x: Column, y: Column, heading: Column, length: Column, width: Column) -> Column:
    """The corners of an object's box around (x, y), as structs: ahead left, ahead right, back right, back left."""
    turn = F.when(finite(heading), heading).otherwise(0.0)
    half_l, half_w = (F.greatest(F.when(finite(v), v).otherwise(0.0), F.lit(LEAST_SIDE)) / 2 for v in (length, width))
    corner = lambda a, b: F.struct((x + F.cos(turn) * half_l * a - F.sin(turn) * half_w * b).alias("x"), (y + F.sin(turn) * half_l * a + F.cos(turn) * half_w * b).alias("y"))
    return F.array(corner(1, 1), corner(1, -1), corner(-1, -1), corner(-1, 1))


def object_group(kind: Column) -> Column:
    """Types 1 to 4, 5 to 8, and all others."""
    return F.when(kind.between(1, 4), 1).when(kind.between(5, 8), 2).otherwise(3)


def projected(point: list[Column], camera: list[list[Column]], intrinsics: list[Column], distortion: list[Column] | None = None, cull: bool = True) -> Column:
    """A bird's-eye point (right, ahead, up) in an image: struct u, v, z. ``camera`` holds the three rows of four of the
    transform, ``intrinsics`` fx, fy, cx, cy, ``distortion`` the rational model's k1, k2, p1, p2, k3 to k6. Points
    behind the camera are (-1, -1, 0)."""
    cam = [_total([row[i] * point[i] for i in range(3)]) + row[3] for row in camera]
    x, y = cam[0] / cam[2], cam[1] / cam[2]
    fx, fy, cx, cy = intrinsics
    if distortion:
        k1, k2, p1, p2, k3, k4, k5, k6 = distortion
        r2 = x * x + y * y
        above, below = (1.0 + r2 * (a + r2 * (b + r2 * c)) for a, b, c in ((k1, k2, k3), (k4, k5, k6)))
        radial = above / F.when(F.abs(below) > 1e-12, below).otherwise(1.0)
        cross = x * y * 2.0
        x, y = x * radial + p1 * cross + p2 * (r2 + x * x * 2.0), y * radial + p2 * cross + p1 * (r2 + y * y * 2.0)
    seen = cam[2] > 0 if cull else cam[2] != 0
    return F.struct(*[F.when(seen, v).otherwise(w).alias(n) for n, v, w in (("u", fx * x + cx, -1.0), ("v", fy * y + cy, -1.0), ("z", cam[2], 0.0))])


def visible(pixel: Column, width: Column | int, height: Column | int) -> Column:
    """Ahead of the camera and inside the image."""
    return (pixel["z"] > 0) & (pixel["u"] >= 0) & (pixel["u"] < width) & (pixel["v"] >= 0) & (pixel["v"] < height)
