"""K-Means in stages: windows are split by rules, each part has its own fit over its own rows, and labels are numbered on from part to part.

Rows are windows with a feature, x, y, curvature_sum (of absolute values), curvature, speed at the start, and where stops count, speeds or
min_speed. Fits run one after the other by MLlib over parts that don't overlap; only centres, as many as clusters, reach the driver.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from helmtrack.functions import arrays
from helmtrack.operators import features, filters, match
from helmtrack.sources.shared import kept


def _finite(v: Column) -> Column:
    return v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf"))


def straight(**limits) -> Column:
    """Gentle windows at speed: ``filters.is_straight`` over the columns x, y and speed."""
    return F.coalesce(filters.is_straight(F.col("x"), F.col("y"), F.col("speed"), **limits), F.lit(False))


def curvature_part(threshold: float, gentle: Column, s_curve: Column | None = None) -> Column:
    """straight up to the threshold; beyond it s_curve where asked for, then straight by shape, else turn. Null where the sum isn't finite."""
    total = F.col("curvature_sum")
    bent = F.when(F.coalesce(s_curve, F.lit(False)), "s_curve") if s_curve is not None else F.when(F.lit(False), "s_curve")
    return F.when(~_finite(total), F.lit(None)).when(total <= threshold, "straight").otherwise(F.coalesce(bent, F.when(gentle, "straight"), F.lit("turn")))


def stops(threshold: float, seconds: float = 0.0, dt: float = 0.1) -> Column:
    """Windows that stop: so many seconds in a row (speeds) at or under the threshold, or, without a time, a least speed under it."""
    if seconds > 0:
        return F.coalesce(arrays.continuously_low(F.col("speeds"), threshold, int(-(-round(seconds / dt, 9) // 1))), F.lit(False))
    return _finite(F.col("min_speed")) & (F.col("min_speed") < threshold)


def staged(rows: DataFrame, part: Column, clusters: dict[str, int], seed: int = 42, feature: str = "feature") -> tuple[DataFrame, DataFrame, float]:
    """(``rows`` with part, cluster and distance from its centre, in place of columns of these names; cluster, part, centre; inertia of all). Parts are numbered in the order of ``clusters``,
    whose numbers are kept free for a part even where it has fewer rows; a part without rows has no centre. Rows of a null part drop out; a part with
    rows and no clusters is an error."""
    parted = kept(rows.withColumn("part", part).where("part IS NOT NULL"), "staged-rows")
    counts = {r["part"]: r["count"] for r in parted.groupBy("part").count().collect()}  # a row for each part
    if wrong := sorted(p for p in counts if clusters.get(p, 0) < 1):
        raise ValueError(f"rows in parts without clusters: {', '.join(wrong)}")
    labelled, centres, inertia, offset = [], [], 0.0, 0
    columns = [c for c in rows.columns if c not in ("part", "cluster", "distance")]
    for name, wanted in clusters.items():
        if counts.get(name):
            found, middle, cost = features.kmeans(parted.where(F.col("part") == name), feature, wanted, seed)
            middle = middle.withColumn("cluster", F.col("cluster") + offset).withColumn("part", F.lit(name))
            off = F.sqrt(match.squared_distance(F.col(feature), F.col("centre")))
            met = found.drop("distance").withColumn("cluster", F.col("cluster") + offset).join(F.broadcast(middle.drop("part")), "cluster")  # a row for each cluster
            labelled.append(met.select(*columns, "part", "cluster", off.alias("distance")))
            centres.append(middle.select("cluster", "part", "centre"))
            inertia += cost
        offset += max(wanted, 0)
    if not labelled:
        raise ValueError("no rows to cluster")
    return reduce(DataFrame.unionByName, labelled), reduce(DataFrame.unionByName, centres), inertia


def split_by_curvature(rows: DataFrame, straight_clusters: int, turn_clusters: int, threshold: float, gentle: Column, seed: int = 42) -> tuple[DataFrame, DataFrame, float]:
    """Two parts, straight and turn. A row whose curvature isn't finite is an error."""
    if not rows.where(~_finite(F.col("curvature_sum"))).isEmpty():
        raise ValueError("rows without finite curvature have no part")
    return staged(rows, curvature_part(threshold, gentle), {"straight": straight_clusters, "turn": turn_clusters}, seed)


def stops_and_curvature(rows: DataFrame, stop: Column, stop_clusters: int, clusters: dict[str, int], threshold: float, gentle: Column, s_curve: tuple[float, int] | None = None, lateral_weight: float = 0.0, endpoint_weight: float = 0.0, seed: int = 42) -> tuple:
    """(stops, the rest), each as ``staged`` returns it. Stops have their own labels and a feature with weighted offsets to the right; of the rest, rows without
    finite curvature drop out. No stops is an error. ``clusters`` has straight, turn and, where ``s_curve`` (threshold, least run) is given, s_curve."""
    marked = kept(rows.withColumn("_stop", stop), "staged-marked")
    halting = marked.where("_stop").drop("_stop")
    if halting.isEmpty():
        raise ValueError("no window stops")
    xy = F.flatten(F.zip_with("x", "y", lambda a, b: F.array(a, b)))
    halting = halting.withColumn("stop_feature", features.stop_feature(F.col("feature"), xy, lateral_weight, endpoint_weight))
    curve = arrays.has_s_curve(F.col("curvature"), *s_curve) if s_curve and clusters.get("s_curve", 0) > 0 else None
    rest = marked.where(~F.col("_stop")).drop("_stop")
    first = staged(halting, F.lit("stop"), {"stop": stop_clusters}, seed, "stop_feature")
    second = staged(rest, curvature_part(threshold, gentle, curve), clusters, seed) if not rest.where(_finite(F.col("curvature_sum"))).isEmpty() else None
    return first, second
