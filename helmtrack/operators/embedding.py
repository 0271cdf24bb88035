"""Two-dimensional views of curves: principal axes of flat features, and classical scaling of Frechet distances by landmarks; labels of behaviour.

Only a covariance matrix, as wide as a feature, or the curves of at most LANDMARKS rows reach the driver.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from helmtrack.functions.curves import frechet_table, points_of
from helmtrack.functions.kinematics import pieces

LANDMARKS = 400
#: Weights of widest offset and heading for the straightest medoid, and of the end for the sharpest turn.
WIDEST, HEADING, END = 0.35, 8.0, 0.02


def _directed(axes: np.ndarray) -> np.ndarray:
    """Axes by rows, each with its greatest entry positive."""
    at = np.abs(axes).argmax(1)
    return axes * np.where(axes[np.arange(len(axes)), at] < 0, -1.0, 1.0)[:, None]


def principal_axes(rows: DataFrame, flat: str, axes: int = 2) -> tuple[np.ndarray, np.ndarray]:
    """(mean, axes by rows) of features of one width: a pass for the mean, a pass for the products of what is left, each task with one row."""

    def moments(centre):
        def run(batches):
            n, first, second = 0, 0.0, 0.0
            for batch in pieces(batches):
                if batch.num_rows:
                    x = np.stack([np.asarray(v, float) for v in batch.column(0).to_pylist()]) - centre
                    n, first, second = n + len(x), first + x.sum(0), second + x.T @ x
            if n:
                yield pa.RecordBatch.from_arrays([pa.array([n]), pa.array([first.tolist()]), pa.array([np.ravel(second).tolist()])], names=["n", "first", "second"])

        return run

    def summed(centre):
        parts = rows.select(flat).mapInArrow(moments(centre), "n long, first array<double>, second array<double>")
        n = parts.agg(F.sum("n")).first()[0]
        if not n:
            raise ValueError("no rows")
        total = lambda c: np.array([r.v for r in parts.select(F.posexplode(c).alias("i", "v")).groupBy("i").agg(F.sum("v").alias("v")).orderBy("i").collect()])  # as wide as a feature
        return n, total

    n, total = summed(0.0)
    mean = total("first") / n
    _, total = summed(mean)
    width = len(mean)
    _, vectors = np.linalg.eigh(total("second").reshape(width, width))
    return mean, _directed(vectors[:, ::-1][:, :axes].T)


def projected(rows: DataFrame, key: str, flat: str, mean: np.ndarray, axes: np.ndarray) -> DataFrame:
    """(key, place array<double>): features along the axes."""

    def run(batches):
        for batch in pieces(batches):
            x = np.stack([np.asarray(v, float) for v in batch.column(1).to_pylist()]) if batch.num_rows else np.zeros((0, len(mean)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(((x - mean) @ axes.T).tolist(), pa.list_(pa.float64()))], names=[key, "place"])

    return rows.select(key, flat).mapInArrow(run, f"{key} {rows.schema[key].dataType.simpleString()}, place array<double>")


def scaled(rows: DataFrame, width: int = 2, landmarks: int = LANDMARKS, seed: int = 42, axes: int = 2) -> DataFrame:
    """(key, place) of rows (key, curve): classical scaling of the Frechet distances of at most ``landmarks`` curves, drawn by a hash of seed and key; all
    curves, those too, are placed by their distances from them. With no more rows than landmarks this is the classical scaling of all pairs."""
    drawn = rows.select("key", "curve").orderBy(F.xxhash64(F.lit(seed), "key"), "key").limit(landmarks).collect()
    if not drawn:
        return rows.select("key", F.array().cast("array<double>").alias("place"))
    library = [points_of(r["curve"], width) for r in sorted(drawn, key=lambda r: r["key"])]
    squares = frechet_table(library, library) ** 2
    mean = squares.mean(0)
    values, vectors = np.linalg.eigh(-0.5 * (squares - mean - mean[:, None] + mean.mean()))
    order = np.argsort(values)[::-1][:axes]
    values, vectors = np.maximum(values[order], 0.0), _directed(vectors[:, order].T)
    pull = np.where(values[:, None] > 1e-12, vectors / np.sqrt(np.maximum(values, 1e-12))[:, None], 0.0)

    def run(batches):
        for batch in pieces(batches):
            d = frechet_table([points_of(c, width) for c in batch.column("curve").to_pylist()], library) ** 2 if batch.num_rows else np.zeros((0, len(library)))
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array((-0.5 * (d - mean) @ pull.T).tolist(), pa.list_(pa.float64()))], names=["key", "place"])

    return rows.select("key", "curve").mapInArrow(run, "key long, place array<double>")


def behaviour_labels(stats: DataFrame) -> DataFrame:
    """(cluster, behaviour) of medoids (cluster, end_y, widest, heading), a row for each cluster: the straightest one; of those that end to the left, and of
    those to the right, the one that turns most, the others being detours. Ends that aren't numbers take what names are left, in the order of clusters."""
    straightness = F.abs("end_y") + WIDEST * F.col("widest") + HEADING * F.abs("heading")
    first = Window.orderBy(straightness, "cluster")  # as many rows as clusters
    ranked = stats.withColumn("straight", F.row_number().over(first) == 1)
    side = F.when(F.col("straight"), "straight").when(F.isnan("end_y"), "other").when(F.col("end_y") >= 0, "left").otherwise("right")
    sharp = F.abs("heading") + END * F.abs("end_y")
    ranked = ranked.withColumn("side", side).withColumn("turn", F.row_number().over(Window.partitionBy("side").orderBy(F.desc(sharp), "cluster")))
    named = ranked.withColumn("behaviour", F.when(F.col("side").isin("left", "right"), F.concat("side", F.when(F.col("turn") == 1, "_turn").otherwise("_detour"))).when(F.col("straight"), "straight"))
    used = F.collect_set("behaviour").over(Window.partitionBy())
    free = F.array_except(F.array(*map(F.lit, ("straight", "left_turn", "right_turn", "left_detour", "right_detour"))), used)
    left_over = F.row_number().over(Window.partitionBy(F.col("behaviour").isNull()).orderBy("cluster"))
    return named.withColumns({"_free": free, "_k": left_over}).select("cluster", F.coalesce("behaviour", F.get("_free", F.col("_k") - 1), F.lit("other")).alias("behaviour"))


def summary(labels: DataFrame, medoids: list[int], stats: DataFrame) -> DataFrame:
    """(cluster, behaviour, size, medoid, mean_to_medoid) of assigned rows (key, cluster, distance) and the medoids' shapes."""
    places = labels.sparkSession.createDataFrame([(i, m) for i, m in enumerate(medoids)], "cluster int, medoid long")  # k rows
    sizes = labels.groupBy("cluster").agg(F.count("*").alias("size"), F.avg("distance").alias("mean_to_medoid"))
    return places.join(behaviour_labels(stats), "cluster", "left").join(sizes, "cluster").select("cluster", "behaviour", "size", "medoid", "mean_to_medoid")
