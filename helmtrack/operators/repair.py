"""Repair of true futures: kept to their path where accelerations allow it, else rebuilt from velocities; and which of raw and repaired is shown."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from helmtrack.functions import kinematics, resample


def _finite(a: Column) -> Column:
    return F.coalesce(F.forall(a, lambda v: v.isNotNull() & ~F.isnan(v)), F.lit(False)) & (F.size(a) > 0)


def repaired(rows: DataFrame) -> DataFrame:
    """``rows`` (x, y: future points in the frame of the start, or null; vx, vy: velocities in that frame at the start and each point, or
    null; dt: seconds of each step; speed: at the start, or null) with fixed_x, fixed_y, fixed_accel and ``repair``: ``path`` where the
    path can be kept to its end, else ``velocity`` where velocities are there and time goes ahead, else ``none`` with nulls."""
    start = rows.withColumn("_speed", F.coalesce("speed", F.lit(float("nan"))))
    kind = "array<double>"
    path = kinematics.with_kernel(start, ["x", "y", "_speed"], {"_px": kind, "_py": kind, "_pa": kind}, resample.repaired_path)
    both = kinematics.with_kernel(path, ["vx", "vy", "dt", "_speed"], {"_vx": kind, "_vy": kind, "_va": kind}, resample.repaired_velocity)
    how = F.when(_finite(F.col("_px")), "path").when(_finite(F.col("_vx")), "velocity").otherwise("none")
    pick = lambda a, b: F.when(F.col("repair") == "path", F.col(a)).when(F.col("repair") == "velocity", F.col(b))
    out = both.withColumn("repair", how).withColumns({"fixed_x": pick("_px", "_vx"), "fixed_y": pick("_py", "_vy"), "fixed_accel": pick("_pa", "_va")})
    return out.select(*rows.columns, "fixed_x", "fixed_y", "fixed_accel", "repair")


def shown(rows: DataFrame, mode: str) -> DataFrame:
    """``rows`` of ``repaired`` (with ``valid``, whether each future point is covered) with gt_x and gt_y: the raw or the repaired points by ``mode``, null
    where any point isn't valid; a repair that failed shows the raw points."""
    if mode not in ("raw", "repaired"):
        raise ValueError(f"mode must be raw or repaired, not {mode}")
    whole = F.coalesce(F.forall("valid", lambda v: F.coalesce(v, F.lit(False))), F.lit(False))
    point = lambda raw, fixed: F.when(whole, F.coalesce(F.col(fixed), F.col(raw)) if mode == "repaired" else F.col(raw))
    return rows.withColumns({"gt_x": point("x", "fixed_x"), "gt_y": point("y", "fixed_y")})
