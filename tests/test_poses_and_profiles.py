"""Pose, profile and shape functions against plain numpy, row by row."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from helmtrack.functions import arrays, kinematics, pose, profiles, resample
from helmtrack.operators import asof, candidates, features, filters, match

rng = np.random.default_rng(7)
X = np.cumsum(rng.uniform(0.1, 1.2, (6, 20)), axis=1)
Y = np.cumsum(rng.normal(0, 0.3, (6, 20)), axis=1)


def test_quaternions(spark):
    q, v = rng.normal(size=(20, 4)), rng.normal(size=(20, 3))
    df = spark.createDataFrame([tuple(map(float, (*a, *b))) for a, b in zip(q, v)], "x double, y double, z double, w double, a double, b double, c double")
    cols = [F.col(c) for c in "xyzw"]
    vec = [F.col(c) for c in "abc"]
    there = pose.rotated(vec, cols)
    got = df.select(*pose.normal_quaternion(cols), *there, *pose.rotated(there, cols, inverse=True), pose.quaternion_yaw(cols)).collect()
    for row, (x, y, z, w), p in zip(got, q / np.linalg.norm(q, axis=1, keepdims=True), v):
        assert np.allclose(row[:4], (x, y, z, w))
        u = np.array([x, y, z])
        turned = p + 2 * np.cross(u, np.cross(u, p) + w * p)  # Rodrigues' form
        assert np.allclose(row[4:7], turned) and np.allclose(row[7:10], p)
        assert np.isclose(row[10], np.arctan2(2 * (w * z + x * y), 1 - 2 * (y * y + z * z)))


def test_heading_and_local_frame(spark):
    rows = [([float(i) for i in range(7)], [float(i) for i in range(7)], 0.0, 0.0, 0.0, 1.0), ([0.0] * 7, [0.0] * 7, 0.0, 0.0, np.sin(0.4), np.cos(0.4)), ([1.0], [2.0], 0.0, 0.0, 0.0, 1.0)]
    df = spark.createDataFrame([tuple(float(v) if np.isscalar(v) else v for v in r) for r in rows], "xs array<double>, ys array<double>, x double, y double, z double, w double")
    yaw = pose.motion_yaw(F.col("xs"), F.col("ys"), [F.col(c) for c in "xyzw"])
    assert np.allclose([r.yaw for r in df.select(yaw.alias("yaw")).collect()], [np.pi / 4, 0.8, 0.0])
    ahead, left = pose.local_points(F.col("xs"), F.col("ys"), F.lit(0.0), F.lit(0.0), F.lit(np.pi / 4))
    row = df.select(ahead.alias("a"), left.alias("l")).first()
    assert np.allclose(row.a, np.arange(7) * np.sqrt(2)) and np.allclose(row.l, 0)


def test_integrated_velocity(spark):
    t, v = [0.0, 0.1, 0.3, 0.4], [1.0, 2.0, 4.0, 4.0]
    df = spark.createDataFrame([(t, v), ([0.0, 0.1, 0.1], [1.0, 1.0, 1.0])], "t array<double>, v array<double>")
    got = [r.p for r in df.select(pose.integrated(F.col("t"), F.col("v")).alias("p")).collect()]
    assert np.allclose(got[0], np.cumsum(np.diff(t) * (np.array(v[1:]) + v[:-1]) / 2)) and got[1] is None


def test_objects_and_projection(spark):
    nan = float("nan")
    df = spark.createDataFrame([(1.0, 2.0, 5.0, 6.0), (1.0, 2.0, nan, 6.0), (nan, 2.0, None, None)], "x double, y double, x_kf double, y_kf double")
    got = df.select(*pose.object_centre(*[F.col(c) for c in df.columns])).collect()
    assert [tuple(r) for r in got] == [(-6.0, -5.0), (-2.0, -1.0), (-2.0, -0.0)]
    box = df.limit(1).select(pose.object_footprint(F.col("x"), F.col("y"), F.lit(np.pi / 2), F.lit(4.0), F.lit(0.0)).alias("b")).first().b
    assert np.allclose([(c.x, c.y) for c in box], [(0.9, 4.0), (1.1, 4.0), (1.1, 0.0), (0.9, 0.0)])
    camera, k, point = rng.normal(size=(3, 4)), rng.normal(0, 0.01, 8), np.array([1.0, 20.0, 0.5])
    camera[2] = [0.0, 1.0, 0.0, 0.5]
    cam = camera @ np.append(point, 1)
    a, b = cam[0] / cam[2], cam[1] / cam[2]
    r2 = a * a + b * b
    radial = (1 + k[0] * r2 + k[1] * r2**2 + k[4] * r2**3) / (1 + k[5] * r2 + k[6] * r2**2 + k[7] * r2**3)
    u = 900 * (a * radial + 2 * k[2] * a * b + k[3] * (r2 + 2 * a * a)) + 640
    v = 800 * (b * radial + k[2] * (r2 + 2 * b * b) + 2 * k[3] * a * b) + 360
    lit = lambda values: [F.lit(float(x)) for x in values]
    for p, want in ((point, (u, v, cam[2])), (np.array([1.0, -20.0, 0.5]), (-1, -1, 0))):
        pixel = pose.projected(lit(p), [lit(r) for r in camera], lit([900, 800, 640, 360]), lit(k))
        row = spark.range(1).select(pixel.alias("p"), pose.visible(pixel, 10**6, 10**6).alias("s")).first()
        assert np.allclose(tuple(row.p), want) and row.s == (want[2] > 0 and want[0] >= 0 and want[1] >= 0)


def test_smoothing_and_features(spark):
    trace = [float(v) for v in rng.normal(size=30)] + [float("nan"), float("inf"), 1.0]
    df = spark.createDataFrame([(trace,)], "t array<double>")
    for passes in (0, 1, 2, 3):
        want = np.where(np.isfinite(trace), trace, 0)
        for _ in range(passes):
            p = np.pad(want, 2, mode="edge")
            want = np.convolve(p, np.array([1, 2, 3, 2, 1]) / 9, mode="valid")
        assert np.allclose(df.select(arrays.smooth5(F.col("t"), passes)).first()[0], want)
        assert np.allclose(profiles.smoothed(np.array([trace]), passes)[0], want)
    speed, accel, bend = profiles.smooth_dynamics(X, Y)
    feature = profiles.dynamic_feature(X, Y)[0]
    assert np.allclose(feature, np.hstack([accel, bend]))
    for x, y, s in zip(X, Y, speed):
        raw = np.hypot(np.diff(x, prepend=0), np.diff(y, prepend=0)) / 0.1
        assert np.allclose(np.convolve(np.pad(raw, 2, mode="edge"), np.array([1, 2, 3, 2, 1]) / 9, mode="valid"), s)


def test_nan_ends_runs(spark):
    nan = float("nan")
    df = spark.createDataFrame([([1.0, nan, nan, nan, 1.0],), ([0.2, 0.2, nan, -0.2, -0.2],), ([0.2, 0.2, -0.2, -0.2],)], "t array<double>")
    t = F.col("t")
    got = df.select(arrays.max_run(t, lambda x: x >= 0.5).alias("run"), arrays.has_s_curve(t, 0.1, 2).alias("s"), arrays.sign_runs(t, 0.1, 2).alias("signs"), arrays.continuously_low(t, 0.3, 2).alias("low")).collect()
    assert [(r.run, r.s, r.signs, r.low) for r in got] == [(1, False, [], False), (0, False, [1, -1], True), (0, True, [1, -1], True)]
    assert spark.range(1).select(arrays.frame_times(F.lit(5), 3)).first()[0] == [100005, 200005, 300005]


def test_edits():
    assert profiles.keyframes(20) == [8, 16, 19] and profiles.keyframes(5) == [4] and profiles.keyframes(0) == [] and profiles.keyframes(17, 8, True) == [0, 8, 16]
    frame, tx, ty = np.array([0, 5, 19, 7, 40, 3.0]), X[:, 3] + 1, Y[:, 3] - 2
    ty[3] = np.nan
    x, y = profiles.dragged(X, Y, frame, tx, ty)
    for i in range(6):
        at = int(min(frame[i], 19))
        if i in (0, 3):
            continue
        w = np.exp(-0.5 * ((np.arange(20) - at) / 10) ** 2)
        w[0] = 0
        assert np.allclose(x[i], X[i] + w * (tx[i] - X[i, at])) and np.isclose(y[i, at], ty[i])
    assert np.allclose(x[3], X[3]) and np.allclose(x[:, 0], X[:, 0])
    x, y = profiles.by_speed(X, Y, np.ones_like(X))
    steps = np.hypot(np.diff(x, prepend=0), np.diff(y, prepend=0))
    assert np.allclose(x[:, -1], X[:, -1]) and (steps.max(1) <= np.hypot(np.diff(X, prepend=0), np.diff(Y, prepend=0)).sum(1) / 20 + 1e-9).all()
    assert np.isnan(profiles.by_speed(X, Y, np.zeros_like(X))[0]).all()
    best = profiles.optimised(X, Y)
    assert (profiles.violation_score(*best[:2]) <= profiles.violation_score(X, Y) + 1e-9).all() and np.allclose(best[0][:, -1], X[:, -1])
    even = np.tile(np.arange(1, 21) * 0.5, (1, 1))
    assert np.array_equal(profiles.optimised(even, even * 0)[0], even) and profiles.quality(even, even * 0)[0][0] == 1
    smooth, accel, jerk = profiles.rough_speed(np.array([[1, 1, 1, 1.0], [1, 9, 1, 9.0], [np.nan, 1, 1, 1]]))
    assert smooth.tolist() == [1, 0, 0] and accel[1] == 80 and jerk[1] == 1600


def test_schedule_paths_and_shapes():
    x, y = resample.scheduled_resample(np.insert(X, 0, 0, 1), np.insert(Y, 0, 0, 1), np.full(6, 3.0), 16)
    for i in range(6):
        px, py = np.append(0, X[i]), np.append(0, Y[i])
        s = np.append(0, np.cumsum(np.hypot(np.diff(px), np.diff(py))))
        mean = s[-1] / 1.6
        v0 = min(max(3.0, 0.2), max(2 * mean, 0.2))
        v1 = max(0.2, 2 * mean - v0)
        t = np.arange(1, 17) * 0.1
        d = v0 * t + (v1 - v0) / 1.6 * t * t / 2
        d = np.maximum.accumulate(d) * s[-1] / d[-1]
        assert np.allclose(x[i], np.interp(d, s, px)) and np.allclose(y[i], np.interp(d, s, py))
    fx, fy = profiles.at_fraction(X, Y, np.linspace(0, 1, 6))
    back = profiles.nearest_fraction(X, Y, fx, fy)[0]
    assert np.allclose(profiles.at_fraction(X, Y, back), (fx, fy), atol=1e-9)
    ax, ay = profiles.aligned(X, Y)
    assert np.allclose(np.hypot(ax, ay), np.hypot(X - X[:, :1], Y - Y[:, :1])) and np.allclose(ax[:, 0], 0)
    end_x, end_y, widest, area, heading = profiles.shape_stats(X, Y)
    assert np.allclose(area, [np.trapezoid(b, a) for a, b in zip(X, Y)]) and np.allclose(heading, np.arctan2(Y[:, -1] - Y[:, -5], X[:, -1] - X[:, -5]))
    assert np.allclose(profiles.heading_error(X, Y, X, Y)[0], 0) and np.allclose(profiles.residual(X, Y)[0][:, -1], 0)
    tx, ty = profiles.tangents(X, Y)
    assert np.allclose(np.hypot(tx, ty), 1)
    same = profiles.transformed(X, Y, np.ones(6), np.zeros(6), np.ones(6))
    assert np.allclose(same, (X, Y))
    assert profiles.thinned(np.arange(10.0)[None], 4).tolist() == [[0, 3, 6, 9]]
    curve = kinematics.bezier_chain(np.array([[0, 0], [1, 1], [2, 0.0]]))
    assert np.allclose(curve[[0, 96, -1]], [[0, 0], [1, 1], [2, 0]])

    def plain(a, b, i, j):
        d = np.hypot(*(a[i] - b[j]))
        ways = [plain(a, b, *k) for k in ((i - 1, j), (i, j - 1), (i - 1, j - 1)) if min(k) >= 0]
        return max(d, min(ways)) if ways else d

    a, b = rng.normal(size=(5, 2)), rng.normal(size=(6, 2))
    assert np.isclose(kinematics.frechet(a, b), plain(a, b, 4, 5))
    assert np.allclose(np.diff(resample.limited_speed(np.array([[0, 9, 0.0]]))), [[0.2, -0.2]])


def test_rollout_against_a_loop():
    a, c, v0 = rng.normal(0, 2, (5, 30)), rng.normal(0, 0.1, (5, 30)), np.array([0, 3, 20, 5, -1.0])
    x, y = kinematics.rollout(a, c, v0)
    for i in range(5):
        v, yaw, px, py = min(max(v0[i], 0), 15), 0.0, 0.0, 0.0
        for j in range(30):
            if j:
                v = min(max(v + a[i, j] * 0.1, 0), 15)
                yaw += c[i, j] * v * 0.1
            px, py = px + np.cos(yaw) * v * 0.1, py + np.sin(yaw) * v * 0.1
            assert np.isclose(x[i, j], px) and np.isclose(y[i, j], py)


def test_extrapolation_and_frames(spark):
    right = spark.createDataFrame([("a", 0, 0.0, 1), ("a", 10, 5.0, 2), ("a", 30, 7.0, 3), ("b", 5, 4.0, 9)], "k string, at long, value double, idx int")
    left = spark.createDataFrame([("a", -10), ("a", 5), ("a", 10), ("a", 50), ("b", 99), ("c", 1)], "k string, ts long")
    got = {(r.k, r.ts): r.value for r in asof.interpolated(left, right, ["k"], "ts", "at", "value").collect()}
    assert got == {("a", -10): -5.0, ("a", 5): 2.5, ("a", 10): 5.0, ("a", 50): 9.0, ("b", 99): 4.0, ("c", 1): None}
    near = asof.frames_near(left, right, ["k"], "ts", "at", 20).collect()
    assert sorted((r.k, r.ts, r.idx) for r in near) == [("a", -10, 1), ("a", 5, 1), ("a", 10, 2), ("a", 50, 3)]
    frames = asof.native_frame(left.withColumn("stored", F.lit(77)), right, ["k"], "ts", "at", "idx", "stored", 5).collect()
    assert {(r.k, r.ts): r.frame for r in frames} == {("a", -10): 77, ("a", 5): 1, ("a", 10): 2, ("a", 50): 77, ("b", 99): 77, ("c", 1): 77}


def test_categories_and_trends(spark):
    straight = ([1.0 * i for i in range(1, 9)], [0.0] * 8)
    rows = [(*straight, [5.0] * 8, [0.0] * 8, "straight"), ([0.1] * 8, [0.0] * 8, [0.0] * 8, [0.0] * 8, "stop"), (straight[0], [1.0] * 8, [5.0] * 8, [0.1] * 8, "left"), (straight[0], [-1.0] * 8, [5.0] * 8, [-0.1] * 8, "right"), (*straight, [5.0] * 8, [0.1] * 4 + [-0.1] * 4, "s_curve")]
    df = spark.createDataFrame(rows, "x array<double>, y array<double>, v array<double>, c array<double>, want string")
    got = df.select(filters.category(*[F.col(c) for c in "xyvc"], F.lit(False)).alias("got"), "want").collect()
    assert [r.got for r in got] == [r.want for r in got]
    cases = [([], "straight", [], True), ([], "left", [], False), ([1], "left", [], True), ([1], "right", [], False), ([1], "right", [[], [1]], True), ([-1], "straight", [[1]], False), ([1, -1], "s_curve", [[-1, 1]], False), ([1, -1], "s_curve", [[1]], True), ([1], "s_curve", [], False), ([-1], "other", [], True)]
    df = spark.createDataFrame(cases, "s array<int>, k string, t array<array<int>>, want boolean")
    got = df.select(filters.trend_allowed(F.col("s"), F.col("k"), F.col("t")).alias("got"), "want").collect()
    assert [r.got for r in got] == [r.want for r in got]


def test_filters(spark):
    df = spark.createDataFrame([(1, "gt", "9007199254740993", 3), (2, "vla", "x", None), (3, None, "4.9", 1)], "i int, source string, v string, sample_idx int")
    assert [r.i for r in filters.pseudo_truth(df).orderBy("i").collect()] == [2, 3]
    assert [r.v for r in df.select(filters.safe_int(F.col("v"), -1).alias("v")).collect()] == [9007199254740993, -1, 4]
    assert [r.sample_key for r in filters.row_keys(df, [], "i", "sample_idx", "i").orderBy("i").collect()] == [3, 1, 1]
    named = df.withColumn("dataset", F.lit("d"))
    assert filters.dataset_filter(named, "all").count() == 3 == filters.dataset_filter(named, "d").count()
    with pytest.raises(ValueError, match="no rows"):
        filters.dataset_filter(named, "e")
    assert [r.next_at for r in filters.next_labelled(named, ["dataset"], "i", "source", "vla").orderBy("i").collect()] == [2, None, None]
    assert filters.start_sample(named, ["i"], source="vla", i=None).first().i == 2
    assert filters.gt_overlap_free(df, spark.createDataFrame([(2,), (2,)], "i int"), "i").count() == 1
    rules = filters.export_rules(F.col("x"), F.col("y"))
    paths = spark.createDataFrame([([1.0, 2.0, 3.0], [0.0] * 3), ([0.1, 0.1, 3.0], [0.0] * 3), ([2.0, 4.0, 6.0], [0.0] * 3), ([-1.0, -2.0, -3.0], [0.0] * 3)], "x array<double>, y array<double>")
    assert [r.w for r in paths.select(filters.reject_reason(rules).alias("w")).collect()] == [None, "accel", "fast", "backward"]
    assert spark.range(1).select(filters.expandable(F.lit(14), F.lit(None).cast("array<int>")), filters.expandable(F.lit(15), F.lit(None).cast("array<int>"))).first()[:] == (False, True)
    whole = paths.select(filters.is_straight(F.col("x"), F.col("y"), F.lit(9.0), 5.0, 2.0, 1.0, 1.0, 0.1).alias("s")).collect()
    assert [r.s for r in whole] == [True, True, True, False]


def test_candidates_against_loops(spark):
    n, steps = 40, 12
    a, c, v = rng.normal(0, 0.3, (n, steps)), rng.normal(0, 0.02, (n, steps)), rng.uniform(3, 5, n)
    feature = np.hstack([a, c])
    members = spark.createDataFrame([(i, i % 5, f.tolist()) for i, f in enumerate(feature)], "member int, cluster int, feature array<double>")
    gx, gy = kinematics.rollout(a[:6], c[:6], v[:6])
    targets = spark.createDataFrame([(i, gx[i].tolist(), gy[i].tolist(), feature[i].tolist(), float(v[i])) for i in range(6)], "target int, x array<double>, y array<double>, feature array<double>, speed double")
    found = candidates.by_clusters(targets, members)
    got = sorted((r.target, r.cluster, r["rank"], r.member) for r in found.collect())
    centres = np.stack([feature[k::5].mean(0) for k in range(5)])
    wanted = []
    for t in range(6):
        bucket = np.floor(v[t] / 0.5 + 0.5) * 0.5
        ex, ey = (e[:, -1] for e in kinematics.rollout(a, c, np.full(n, bucket)))
        u = np.array([gx[t, -1] - gx[t, -2], gy[t, -1] - gy[t, -2]])
        u /= np.linalg.norm(u)
        d = np.stack([ex - gx[t, -1], ey - gy[t, -1]], 1)
        along, across = d @ u, d @ np.array([-u[1], u[0]])
        score = np.linalg.norm(feature - feature[t], axis=1) + 0.15 * np.hypot(along, across)
        for k in np.argsort(np.linalg.norm(centres - feature[t], axis=1))[:2]:
            ok = [m for m in range(k, n, 5) if abs(across[m]) <= 2 and -5 <= along[m] <= 4]
            wanted += [(t, int(k), r + 1, m) for r, m in enumerate(sorted(ok, key=lambda m: score[m])[:2])]
    assert got == sorted(wanted)
    truths = targets.select("target", F.lit("d").alias("dataset"), F.lit("c").alias("clip"), F.lit(1000).cast("long").alias("t0_us"), "x", "y")
    rows = candidates.output_rows(truths, found).collect()
    assert len(rows) == 6 + len(wanted) and {r.sample_idx for r in rows if r.source == "gt"} == {0} and rows[0].timestamp[:2] == [101000, 201000]
    library = targets.select(F.col("target").alias("centre"), F.col("x").alias("cx"), F.col("y").alias("cy"))
    near = candidates.preselected(targets, library, 2).where("rank = 1").collect()
    assert all(r.target == r.centre for r in near)
    grid = candidates.variants(library, [0.8, 1.0], [0.0], [1.0, 2.0]).where("variant = 2").first()  # speed 1, turning as it is
    assert np.allclose(grid.x, gx[0]) and np.allclose(grid.y, gy[0])
    assert [r.members for r in candidates.members_index(members.where("cluster < 1"), 2).orderBy("cluster").collect()] == [list(range(0, n, 5)), []]
    top = candidates.trace_speed_max(targets).first()
    assert np.isclose(top.max_speed, (np.hypot(np.diff(gx, prepend=0), np.diff(gy, prepend=0)) / 0.1).max())
    only = match.feasible_clusters_first(spark.createDataFrame([(1, 0.1, 5, False), (1, 0.2, 6, True), (1, 0.3, 7, True)], "t int, d double, c int, ok boolean"), ["t"], "d", "c", F.col("ok"), 1).collect()
    both = match.nearest_clusters_first(spark.createDataFrame([(1, 0.1, 5, False), (1, 0.2, 6, True), (1, 0.3, 7, True)], "t int, d double, c int, ok boolean"), ["t"], "d", "c", F.col("ok"), 2).collect()
    assert [r.c for r in only] == [6] == [r.c for r in both]
    assert features.kmeans(members, "feature", 1)[1].count() == 1
