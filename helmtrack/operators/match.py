"""Matching of traces with cluster centres and members, and top-k selections."""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from helmtrack.sources.shared import kept

#: Numbers of a block of a centre library, and of the differences that a task holds at a time.
MAX_CENTRE_VALUES = 4_000_000


def squared_distance(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, x: s + x)


def mean_pointwise(ax: Column, ay: Column, bx: Column, by: Column) -> Column:
    """The mean distance of two trajectories, point by point."""
    squares = F.zip_with(F.zip_with(ax, bx, lambda p, q: (p - q) * (p - q)), F.zip_with(ay, by, lambda p, q: (p - q) * (p - q)), lambda u, v: F.sqrt(u + v))
    return F.aggregate(squares, F.lit(0.0), lambda s, x: s + x) / F.size(ax)


def nearest_centres(rows: DataFrame, key: str, trace: str, centres: DataFrame, centre_key: str, centre_trace: str, k: int) -> DataFrame:
    """The k nearest centres of each row, with rank and squared distance; ties go to the smaller centre. The centre table goes to the
    tasks in blocks of at most MAX_CENTRE_VALUES numbers, one pass over the rows for each; every pass keeps k per row, and where
    there are several the best of these are ranked. A task holds as many differences at a time."""
    width = centres.select(F.max(F.size(centre_trace)), F.count("*")).first()
    blocks = max(1, -(-(width[0] or 0) * width[1] // MAX_CENTRE_VALUES))
    kinds = [rows.schema[key].dataType.simpleString(), centres.schema[centre_key].dataType.simpleString()]
    schema = f"{key} {kinds[0]}, {centre_key} {kinds[1]}, distance double, rank int"
    dealt = centres.select(centre_key, centre_trace, F.pmod(F.xxhash64(centre_key), F.lit(blocks)).alias("_block"))
    found = []
    for block in range(blocks):
        part = dealt.where(F.col("_block") == block).orderBy(centre_key).toPandas()
        found.append(rows.select(key, trace).mapInPandas(_nearest_of(part[centre_key].to_numpy(), part[centre_trace], key, trace, centre_key, k), schema))
    if blocks == 1:
        return found[0]
    best = reduce(DataFrame.unionByName, found).drop("rank")
    return best.withColumn("rank", F.row_number().over(Window.partitionBy(key).orderBy("distance", centre_key))).where(F.col("rank") <= k)


def _nearest_of(names: np.ndarray, traces, key: str, trace: str, centre_key: str, k: int):
    table = np.stack(traces.to_numpy()).astype(float) if len(names) else np.zeros((0, 0))
    step = max(1, MAX_CENTRE_VALUES // max(1, table.size))

    def best(batches):
        for part in batches:
            out = []
            for start in range(0, len(part) if len(names) else 0, step):
                piece = part.iloc[start : start + step]
                x = np.stack(piece[trace].to_numpy()).astype(float)
                d = ((x[:, None, :] - table[None, :, :]) ** 2).sum(2)
                order = np.argsort(d, axis=1, kind="stable")[:, :k]
                n = order.shape[1]
                out.append(pd.DataFrame({key: np.repeat(piece[key].to_numpy(), n), centre_key: names[order.ravel()], "distance": np.take_along_axis(d, order, 1).ravel(), "rank": np.tile(np.arange(1, n + 1), len(piece))}))
            if out:
                yield pd.concat(out)

    return best


def top_k(rows: DataFrame, by: list[str], order: list, k: int) -> DataFrame:
    """The first k rows of each group; ``order`` must be total. Adds ``rank``."""
    return rows.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col("rank") <= k)


def medoids(members: DataFrame, cluster: str, key: str, distance: str) -> DataFrame:
    """The member of each cluster that is nearest to its centre; ties go to the smaller key."""
    return members.groupBy(cluster).agg(F.min(F.struct(distance, key)).alias("m")).select(cluster, F.col(f"m.{key}").alias("medoid"), F.col(f"m.{distance}").alias(distance))


def end_direction(xs: Column, ys: Column) -> tuple[Column, Column]:
    """The unit vector of the last step that moves (more than 1e-6), or of the end point if none does."""
    n = F.size(xs)
    step = lambda i: F.struct((F.get(xs, i) - F.get(xs, i - 1)).alias("dx"), (F.get(ys, i) - F.get(ys, i - 1)).alias("dy"))
    steps = F.when(n > 1, F.transform(F.sequence(F.lit(1), F.greatest(n - 1, F.lit(1))), step))
    moving = F.filter(steps, lambda s: F.sqrt(s["dx"] * s["dx"] + s["dy"] * s["dy"]) > 1e-6)
    last = F.try_element_at(moving, F.lit(-1))
    dx, dy = F.coalesce(last["dx"], F.element_at(xs, -1)), F.coalesce(last["dy"], F.element_at(ys, -1))
    norm = F.sqrt(dx * dx + dy * dy)
    return F.when(norm > 1e-6, dx / norm).otherwise(1.0), F.when(norm > 1e-6, dy / norm).otherwise(0.0)


def endpoint_error(xs: Column, ys: Column, end_x: Column, end_y: Column) -> tuple[Column, Column]:
    """Longitudinal and lateral error of an end point in the frame of the trajectory's own end."""
    ux, uy = end_direction(xs, ys)
    dx, dy = end_x - F.element_at(xs, -1), end_y - F.element_at(ys, -1)
    return dx * ux + dy * uy, dy * ux - dx * uy


def in_box(longitudinal: Column, lateral: Column, max_lateral: float = 2.0, max_short: float = 5.0, max_long: float = 4.0) -> Column:
    return (F.abs(lateral) <= max_lateral) & (longitudinal >= -max_short) & (longitudinal <= max_long)


def feasible_clusters_first(members: DataFrame, by: list[str], cluster_distance: str, cluster: str, feasible: Column, k: int) -> DataFrame:
    """Feasible members of the k nearest clusters that have any: infeasible clusters are passed over."""
    order = Window.partitionBy(*by).orderBy(cluster_distance, cluster)
    return members.where(feasible).withColumn("cluster_rank", F.dense_rank().over(order)).where(F.col("cluster_rank") <= k)


def nearest_clusters_first(members: DataFrame, by: list[str], cluster_distance: str, cluster: str, feasible: Column, k: int) -> DataFrame:
    """Feasible members of the k nearest clusters, whether or not those have any."""
    order = Window.partitionBy(*by).orderBy(cluster_distance, cluster)
    return members.withColumn("cluster_rank", F.dense_rank().over(order)).where((F.col("cluster_rank") <= k) & feasible)


def diverse(candidates: DataFrame, by: list[str], score: str, key: str, x: str, y: str, least: float, k: int, apart: float | None = None, end: float | None = None, shape: float | None = None, offset: str | None = None, inside: float = 0.05, share: float = 0.6, bonus: float = 1.4, most: float = 0.75) -> DataFrame:
    """Greedy choice per group: in order of score (null last) and key, a candidate stays, up to k, if it is far enough from all that stay: its mean point
    distance is at least ``least`` and more than ``apart``, and not both its end nearer than ``end`` and its residual shape nearer than
    ``shape``. With ``offset`` candidates beyond ``inside`` come first, with a bonus for their offset (up to ``most``), until they are their share of k,
    then those not beyond it up to the rest, then any. Each of k rounds takes every group's first candidate and drops those too near it, so all
    candidates take part and no group is gathered in a task; a round's rest is written, so that the next doesn't compute it again."""
    names, quota = list(candidates.columns), int(-(-k * share // 1))
    left, chosen = candidates.withColumns({"_in": F.lit(0), "_out": F.lit(0)}), []
    for rank in range(1, k + 1):
        plain = [F.col(score).isNull().alias("unscored"), F.col(score).alias("score"), F.col(key).alias("key")]
        if offset is not None:
            within = F.coalesce(F.col(offset) > inside, F.lit(False))
            early = within & (F.col("_in") < quota)
            phase = F.when(early, 0).when(~within & (F.col("_out") < k - quota), 1).otherwise(2)
            plain = [phase.alias("phase"), plain[0], F.when(early, F.col(score) - bonus * F.greatest(F.lit(0.0), F.least(F.col(offset), F.lit(most)))).otherwise(F.col(score)).alias("score"), plain[2]]
        first = kept(left.groupBy(*by).agg(F.min_by(F.struct(*left.columns), F.struct(*plain)).alias("first")).select("first.*"), "diverse-first")
        chosen.append(first.select(*names, F.lit(rank).alias("rank")))
        if rank == k:
            break
        went_in = F.coalesce(F.col(offset) > inside, F.lit(False)) if offset is not None else F.lit(False)
        counts = first.withColumns({"_in": F.col("_in") + went_in.cast("int"), "_out": F.col("_out") + (~went_in).cast("int")})
        taken = counts.select(*[F.col(c).alias(f"_{c}") for c in (*by, key, x, y)], F.col("_in").alias("_now_in"), F.col("_out").alias("_now_out"))
        same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in by]
        mean = mean_pointwise(F.col(x), F.col(y), F.col(f"_{x}"), F.col(f"_{y}"))
        far = (mean >= least) & ~F.isnan(mean)
        if apart is not None:
            far &= mean > apart
        if end is not None and shape is not None:
            last = lambda c: F.element_at(c, -1)
            ends = F.sqrt((last(x) - last(f"_{x}")) * (last(x) - last(f"_{x}")) + (last(y) - last(f"_{y}")) * (last(y) - last(f"_{y}")))
            rest = lambda c: F.transform(c, lambda v, i: v - (i + 1) / F.size(c) * F.element_at(c, -1))
            far &= ~((ends < end) & (mean_pointwise(rest(x), rest(y), rest(f"_{x}"), rest(f"_{y}")) < shape))
        met = left.drop("_in", "_out").join(taken, same).where(~F.col(key).eqNullSafe(F.col(f"_{key}")) & far)
        left = kept(met.select(*names, F.col("_now_in").alias("_in"), F.col("_now_out").alias("_out")), "diverse-left")
    return reduce(DataFrame.unionByName, chosen) if chosen else candidates.withColumn("rank", F.lit(0)).limit(0)
