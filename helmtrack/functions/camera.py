"""From image points to the ground: numpy kernels over blocks (rows, points)."""

from __future__ import annotations

import numpy as np

#: Newton steps of the inverse distortion, and the sizes under which a plane is parallel to a ray or a transform can't be inverted.
NEWTON, PARALLEL = 20, 1e-9


def undistorted(x: np.ndarray, y: np.ndarray, k: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Points whose rational distortion (k1, k2, p1, p2, k3 to k6 by rows) is (x, y): Newton's method on both coordinates from the distorted point
    on. NaN where it doesn't come to rest."""
    k1, k2, p1, p2, k3, k4, k5, k6 = (k[:, i : i + 1] for i in range(8))
    u, v = x.copy(), y.copy()
    for _ in range(NEWTON):
        r = u * u + v * v
        above, below = 1 + r * (k1 + r * (k2 + r * k3)), 1 + r * (k4 + r * (k5 + r * k6))
        rise_above, rise_below = k1 + r * (2 * k2 + 3 * r * k3), k4 + r * (2 * k5 + 3 * r * k6)
        below = np.where(np.abs(below) > 1e-12, below, 1.0)
        g = above / below
        dg = (rise_above - g * rise_below) / below
        off_u = u * g + 2 * p1 * u * v + p2 * (r + 2 * u * u) - x
        off_v = v * g + 2 * p2 * u * v + p1 * (r + 2 * v * v) - y
        a, d = g + 2 * u * u * dg + 2 * p1 * v + 6 * p2 * u, g + 2 * v * v * dg + 2 * p2 * u + 6 * p1 * v
        b = 2 * u * v * dg + 2 * p1 * u + 2 * p2 * v
        det = a * d - b * b
        det = np.where(np.abs(det) > 1e-14, det, np.nan)
        u, v = u - (d * off_u - b * off_v) / det, v - (a * off_v - b * off_u) / det
    rest = np.hypot(off_u, off_v) < 1e-9
    return np.where(rest, u, np.nan), np.where(rest, v, np.nan)


def image_to_ground(u: np.ndarray, v: np.ndarray, intrinsics: np.ndarray, distortion: np.ndarray, transform: np.ndarray) -> tuple:
    """(x ahead, y left) of image points on the plane on which the vehicle stands: the ray of the point without distortion, turned into bird's-eye
    axes, where it meets height 0. NaN for points whose ray doesn't come down ahead of the camera, and for cameras whose
    transform can't be inverted."""
    fx, fy, cx, cy = (intrinsics[:, i : i + 1] for i in range(4))
    a, b = undistorted((u - cx) / fx, (v - cy) / fy, distortion)
    t = transform.reshape(-1, 3, 4)
    turn = t[:, :, :3]
    sound = np.isfinite(t).all((1, 2)) & (np.abs(np.linalg.det(np.where(np.isfinite(turn), turn, 0.0))) > 1e-12)
    back = np.linalg.inv(np.where(sound[:, None, None], turn, np.eye(3)))
    centre = -(back @ t[:, :, 3:])[:, :, 0]
    ray = np.einsum("rij,rjn->rin", back, np.stack([a, b, np.ones_like(a)], axis=1))
    with np.errstate(divide="ignore", invalid="ignore"):
        scale = -centre[:, 2:] / ray[:, 2]
    met = (np.abs(ray[:, 2]) >= PARALLEL) & (scale > 0) & sound[:, None]
    right, ahead = (np.where(met, centre[:, i : i + 1] + scale * ray[:, i], np.nan) for i in (0, 1))
    return ahead, -right
