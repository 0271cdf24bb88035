"""Features of windows for clustering, and clustering by MLlib. A window's ``xy`` is x0, y0, x1, y1, ..."""

from __future__ import annotations

from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def points_x(xy: Column) -> Column:
    return F.filter(xy, lambda _, i: i % 2 == 0)


def points_y(xy: Column) -> Column:
    return F.filter(xy, lambda _, i: i % 2 == 1)


def window_feature(xy: Column, mode: str = "all_xy", endpoint_weight: float = 0.0, lateral_weight: float = 0.0) -> Column:
    """All coordinates (and the weighted end point), or the end's right offset, or that and its way ahead; then,
    if weighted, the right offsets of all points."""
    end_x, end_y = F.element_at(xy, -2), F.element_at(xy, -1)
    if mode == "final_lateral":
        parts = [F.array(-end_y)]
    elif mode == "final_xy":
        parts = [F.array(-end_y, end_x)]
    else:
        parts = [xy] + ([F.array(end_x * endpoint_weight, end_y * endpoint_weight)] if endpoint_weight > 0 else [])
    if lateral_weight > 0:
        parts.append(F.transform(points_y(xy), lambda y: -y * lateral_weight))
    return F.concat(*parts)


def stop_feature(base: Column, xy: Column, lateral_weight: float, endpoint_weight: float) -> Column:
    """A feature with stronger right offsets, for windows that stop."""
    parts = [base]
    if lateral_weight > 0:
        parts.append(F.transform(points_y(xy), lambda y: -y * lateral_weight))
    if endpoint_weight > 0:
        parts.append(F.array(-F.element_at(xy, -1) * endpoint_weight))
    return F.concat(*parts)


def speed_bucket(speed: Column, width: float) -> Column:
    """The nearest multiple of ``width`` (halves go up) of a speed that is at least 0; NaN and infinity are 0."""
    bad = F.isnan(speed) | (F.abs(speed) == float("inf"))
    plain = F.greatest(F.when(bad | speed.isNull(), 0.0).otherwise(speed), F.lit(0.0))
    return F.floor(plain / width + 0.5) * width if 0 < width < float("inf") else plain


def standardised(trace: Column, mean: Column, std: Column) -> Column:
    return F.transform(trace, lambda v, i: (v - F.get(mean, i)) / F.get(std, i))


def turn_side(xy: Column) -> Column:
    """``right`` for windows that end to the right of their axis or on it, else ``left``."""
    return F.when(-F.element_at(xy, -1) >= 0, "right").otherwise("left")


def lateral_area(xy: Column) -> Column:
    """The signed area between a window's path and its axis, by trapezoids."""
    x, y = points_x(xy), points_y(xy)
    n = F.size(x)
    parts = F.zip_with(F.arrays_zip(F.slice(x, 1, n - 1).alias("x"), F.slice(y, 1, n - 1).alias("y")), F.arrays_zip(F.slice(x, 2, n - 1).alias("x"), F.slice(y, 2, n - 1).alias("y")), lambda a, b: (b["x"] - a["x"]) * (a["y"] + b["y"]) / 2)
    return F.aggregate(parts, F.lit(0.0), lambda s, v: s + v)


def kmeans(rows: DataFrame, feature: str, k: int, seed: int = 42, max_iter: int = 300) -> tuple[DataFrame, DataFrame, float]:
    """(``rows`` with ``cluster``; cluster, centre; inertia). Of fewer rows than k, as many clusters as rows."""
    ready = rows.withColumn("_feature", array_to_vector(F.col(feature))).cache()
    n = ready.count()
    if not n:
        raise ValueError("no rows to cluster")
    if k < 1:
        raise ValueError("k must be at least 1")
    if min(k, n) == 1:  # MLlib starts at two clusters
        mean = ready.select(F.posexplode(feature)).groupBy("pos").agg(F.avg("col").alias("m"))
        centre = [r.m for r in mean.orderBy("pos").collect()]  # as long as one feature
        off = F.aggregate(F.transform(feature, lambda v, i: F.pow(v - F.get(F.lit(centre), i), 2)), F.lit(0.0), lambda s, v: s + v)
        inertia = float(ready.agg(F.sum(off)).first()[0])
        ready.unpersist()
        return rows.withColumn("cluster", F.lit(0)), rows.sparkSession.createDataFrame([(0, centre)], "cluster int, centre array<double>"), inertia
    model = KMeans(k=min(k, n), seed=seed, maxIter=max_iter, featuresCol="_feature", predictionCol="cluster").fit(ready)
    centre_rows = [(i, [float(v) for v in c]) for i, c in enumerate(model.clusterCenters())]
    centres = rows.sparkSession.createDataFrame(centre_rows, "cluster int, centre array<double>")
    inertia = float(model.summary.trainingCost)
    ready.unpersist()
    return model.transform(rows.withColumn("_feature", array_to_vector(F.col(feature)))).drop("_feature"), centres, inertia
