"""Diverse candidates for true windows by clusters of acceleration and curvature, as joins of frames.

Targets meet their nearest clusters, clusters their members by an equi-join, and members their end points, which are
rolled out once for each speed bucket and member that meet, not for each pair of target and member.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from helmtrack.functions import arrays, kinematics, profiles
from helmtrack.operators import features, match

#: Clusters per target, members per cluster, weight of the end's distance, speed bucket (m/s).
CLUSTERS, MEMBERS, END_WEIGHT, BUCKET = 2, 2, 0.15, 0.5
#: Weights of a centre's end, mean and shape distance.
PRESELECT = (1.2, 0.8, 0.7)


def dynamic_features(windows: DataFrame) -> DataFrame:
    """``windows`` (x, y) with ``feature``: smoothed acceleration, then smoothed curvature."""
    return kinematics.with_kernel(windows, ["x", "y"], {"feature": "array<double>"}, profiles.dynamic_feature)


def centre_of(members: DataFrame) -> DataFrame:
    """(cluster, centre): element-wise means of the members' features."""
    from helmtrack.operators.aggregates import mean_trace

    return mean_trace(members, ["cluster"], "feature").select("cluster", F.col("mean").alias("centre"))


def _half(name: str, second: bool):
    n = (F.size(name) / 2).cast("int")
    return F.slice(name, n + 1 if second else F.lit(1), n)


def _rolled(rows: DataFrame, feature: str, speed: str) -> DataFrame:
    """``rows`` with ``x`` and ``y``: the feature's acceleration and curvature driven from a speed."""
    rows = rows.withColumns({"_a": _half(feature, False), "_c": _half(feature, True)})
    return kinematics.with_kernel(rows, ["_a", "_c", speed], {"x": "array<double>", "y": "array<double>"}, kinematics.rollout).drop("_a", "_c")


def by_clusters(targets: DataFrame, members: DataFrame, clusters: int = CLUSTERS, per_cluster: int = MEMBERS, end_weight: float = END_WEIGHT, bucket: float = BUCKET) -> DataFrame:
    """``targets`` (target, x, y, feature, speed) x ``members`` (member, cluster, feature): for each target its nearest
    clusters, of each the members whose end is in the target's box, by feature distance plus the weighted
    distance of the ends; the chosen ones are rolled out at the target's own speed. Rows: target, cluster, member,
    rank, score, longitudinal, lateral, x, y."""
    near = match.nearest_centres(targets, "target", "feature", centre_of(members), "cluster", "centre", clusters).select("target", "cluster")
    want = targets.select("target", F.col("x").alias("gx"), F.col("y").alias("gy"), F.col("feature").alias("gf"), "speed", features.speed_bucket(F.col("speed"), bucket).alias("bucket"))
    asked = near.join(want.select("target", "bucket"), "target").select("cluster", "bucket").distinct()
    ends = _rolled(asked.join(members, "cluster"), "feature", "bucket").select("bucket", "member", F.element_at("x", -1).alias("ex"), F.element_at("y", -1).alias("ey"))
    pairs = near.join(want, "target").join(members, "cluster").join(ends, ["bucket", "member"])
    along, across = match.endpoint_error(F.col("gx"), F.col("gy"), F.col("ex"), F.col("ey"))
    pairs = pairs.withColumns({"longitudinal": along, "lateral": across}).where(match.in_box(F.col("longitudinal"), F.col("lateral")))
    apart = F.sqrt(match.squared_distance(F.col("feature"), F.col("gf"))) + end_weight * F.sqrt(F.col("longitudinal") ** 2 + F.col("lateral") ** 2)
    best = match.top_k(pairs.withColumn("score", apart), ["target", "cluster"], ["score", "member"], per_cluster)
    return _rolled(best, "feature", "speed").select("target", "cluster", "member", "rank", "score", "longitudinal", "lateral", "x", "y")


def output_rows(truths: DataFrame, found: DataFrame) -> DataFrame:
    """``truths`` (target, dataset, clip, t0_us, x, y) as sample 0 from ``gt``, then each target's candidates from 1 on, in
    the order of cluster, rank and member, with frame times."""
    head = truths.select("target", "dataset", "clip", "t0_us", F.lit(0).alias("sample_idx"), F.lit("gt").alias("source"), "x", "y")
    place = F.row_number().over(Window.partitionBy("target").orderBy("cluster", "rank", "member"))
    rest = found.select("target", place.alias("sample_idx"), F.lit("acc_curvature_cluster").alias("source"), "x", "y").join(truths.select("target", "dataset", "clip", "t0_us"), "target")
    rows = head.unionByName(rest.select(head.columns))
    return rows.withColumn("timestamp", F.transform("x", lambda _, i: F.col("t0_us") + (i + 1) * 100_000))


def preselected(targets: DataFrame, centres: DataFrame, k: int) -> DataFrame:
    """The k centres (centre, cx, cy) of each target (target, x, y) with the least weighted sum of the distances of ends,
    points and residual shapes. A library of centres is small: it is broadcast within Spark's own limit."""
    shapes = lambda df, x, y, a, b: kinematics.with_kernel(df, [x, y], {a: "array<double>", b: "array<double>"}, profiles.residual)
    t, c = shapes(targets.select("target", "x", "y"), "x", "y", "rx", "ry"), shapes(centres.select("centre", "cx", "cy"), "cx", "cy", "sx", "sy")
    last = lambda name: F.element_at(name, -1)
    end = F.sqrt((last("cx") - last("x")) ** 2 + (last("cy") - last("y")) ** 2)
    mean = match.mean_pointwise(F.col("x"), F.col("y"), F.col("cx"), F.col("cy"))
    shape = match.mean_pointwise(F.col("rx"), F.col("ry"), F.col("sx"), F.col("sy"))
    score = sum(w * v for w, v in zip(PRESELECT, (end, mean, shape)))
    return match.top_k(t.join(c).select("target", "centre", score.alias("score")), ["target"], ["score", "centre"], k)


def variants(centres: DataFrame, speeds: list[float], ramps: list[float], bends: list[float]) -> DataFrame:
    """Every centre under every speed factor, ramp and turning factor, numbered in that order: the grid is a few rows."""
    grid = [(i, s, r, b) for i, (s, r, b) in enumerate((s, r, b) for s in speeds for r in ramps for b in bends)]
    table = F.broadcast(centres.sparkSession.createDataFrame(grid, "step int, speed double, ramp double, bend double"))
    rows = centres.select("centre", "cx", "cy").join(table).withColumn("variant", F.col("centre") * len(grid) + F.col("step"))
    return kinematics.with_kernel(rows, ["cx", "cy", "speed", "ramp", "bend"], {"x": "array<double>", "y": "array<double>"}, profiles.transformed)


def member_choice(members: DataFrame, by: str) -> DataFrame:
    """The member of each cluster with the least value of ``by``; ties go to the smaller member."""
    return members.groupBy("cluster").agg(F.min_by("member", F.struct(by, "member")).alias("member"))


def members_index(members: DataFrame, k: int) -> DataFrame:
    """Members of clusters 0 to k - 1 in order, empty ones too; for reports, as a cluster becomes one row."""
    every = members.sparkSession.range(k).select(F.col("id").cast("int").alias("cluster"))
    return every.join(members, "cluster", "left").groupBy("cluster").agg(F.array_sort(F.collect_list("member")).alias("members"))


def category_counts(rows: DataFrame) -> DataFrame:
    """Rows and kept candidates of each category."""
    return rows.groupBy("category").agg(F.count("*").alias("n"), F.sum("kept").alias("kept"))


def trace_speed_max(rows: DataFrame) -> DataFrame:
    """Greatest speed and absolute acceleration over all trajectories."""
    speed = F.transform(F.zip_with(arrays.differences(F.col("x")), arrays.differences(F.col("y")), lambda a, b: F.sqrt(a * a + b * b)), lambda s: s / kinematics.DT)
    rows = rows.select(speed.alias("speed")).withColumn("accel", F.transform(arrays.differences(F.col("speed"), False), lambda d: F.abs(d) / kinematics.DT))
    return rows.agg(F.max(F.array_max("speed")).alias("max_speed"), F.max(F.array_max("accel")).alias("max_accel"))
