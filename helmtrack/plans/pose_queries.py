"""Queries over poses, cameras and shapes: ``events`` and ``lineitem`` give the numbers, ``embeddings`` the paths."""

from __future__ import annotations

from pyspark.sql import functions as F

from helmtrack.functions import kinematics, pose, profiles
from helmtrack.operators import filters
from helmtrack.plans.registry import query
from helmtrack.plans.trace_queries import POINTS, traces, trajectories

Q = "q AS (SELECT event_id, value AS x, value * value - 1 AS y, 2 - value AS z, CAST(event_id % 7 AS DOUBLE) + 0.5 AS w, CAST(user_id % 11 AS DOUBLE) - 5 AS a, CAST(event_id % 13 AS DOUBLE) AS b, value + 1 AS c FROM events)"


def _poses(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/events.parquet")
    v = F.col("value")
    return rows.select(
        "event_id", v.alias("x"), (v * v - 1).alias("y"), (2 - v).alias("z"), ((F.col("event_id") % 7).cast("double") + 0.5).alias("w"),
        ((F.col("user_id") % 11).cast("double") - 5).alias("a"), (F.col("event_id") % 13).cast("double").alias("b"), (v + 1).alias("c"),
    )


QUATERNION, VECTOR = "xyzw", "abc"


def _cols(names):
    return [F.col(n) for n in names]


def _rounded(columns, names, places=4):
    return [F.round(c, places).alias(n) for c, n in zip(columns, names)]


@query(f"WITH {Q}, n AS (SELECT *, greatest(sqrt(x * x + y * y + z * z + w * w), 1e-8) AS s FROM q) SELECT event_id, round(x / s, 4) AS x, round(y / s, 4) AS y, round(z / s, 4) AS z, round(w / s, 4) AS w FROM n")
def f1_normal_quaternion(spark, sf_dir):
    return _poses(spark, sf_dir).select("event_id", *_rounded(pose.normal_quaternion(_cols(QUATERNION)), "xyzw"))


@query(f"""WITH {Q}, n AS (SELECT *, sqrt(x * x + y * y + z * z + w * w) AS s FROM q), u AS (SELECT event_id, a, b, c, x / s AS x, y / s AS y, z / s AS z, w / s AS w FROM n),
t AS (SELECT *, y * c - z * b + w * a AS tx, z * a - x * c + w * b AS ty, x * b - y * a + w * c AS tz FROM u)
SELECT event_id, round(a + 2 * (y * tz - z * ty), 3) AS a, round(b + 2 * (z * tx - x * tz), 3) AS b, round(c + 2 * (x * ty - y * tx), 3) AS c FROM t""")
def f3_rotated(spark, sf_dir):
    """By the matrix (F2); the SQL turns the vector by cross products."""
    return _poses(spark, sf_dir).select("event_id", *_rounded(pose.rotated(_cols(VECTOR), _cols(QUATERNION)), "abc", 3))


@query(f"WITH {Q} SELECT event_id, round(a, 3) AS a, round(b, 3) AS b, round(c, 3) AS c FROM q")
def f3_rotated_back(spark, sf_dir):
    """There and back again is the vector itself."""
    there = pose.rotated(_cols(VECTOR), _cols(QUATERNION))
    return _poses(spark, sf_dir).select("event_id", *_rounded(pose.rotated(there, _cols(QUATERNION), inverse=True), "abc", 3))


@query(f"""WITH {POINTS}, e AS (SELECT vec_id, max(CASE WHEN i = 63 THEN x END) - max(CASE WHEN i = 58 THEN x END) AS dx, max(CASE WHEN i = 63 THEN y END) - max(CASE WHEN i = 58 THEN y END) AS dy FROM pts GROUP BY vec_id)
SELECT vec_id, round(CASE WHEN sqrt(dx * dx + dy * dy) >= 0.2 THEN atan2(dy, dx) ELSE 0 END, 4) AS yaw FROM e""")
def f4_motion_yaw(spark, sf_dir):
    yaw = pose.motion_yaw(F.col("x"), F.col("y"), [F.lit(0.0), F.lit(0.0), F.lit(0.0), F.lit(1.0)])
    return trajectories(spark, sf_dir).select("vec_id", F.round(yaw, 4).alias("yaw"))


@query(f"""WITH {POINTS}, d AS (SELECT vec_id, i, 0.1 * (e + lag(e) OVER w) / 2 AS step FROM flat WINDOW w AS (PARTITION BY vec_id ORDER BY i))
SELECT vec_id, i - 1 AS i, round(sum(step) OVER (PARTITION BY vec_id ORDER BY i ROWS UNBOUNDED PRECEDING), 5) AS value FROM d WHERE i > 0""")
def f7_integrated(spark, sf_dir):
    seconds = F.transform("trace", lambda _, i: i * F.lit(0.1))
    rows = traces(spark, sf_dir).select("vec_id", F.posexplode(pose.integrated(seconds, F.col("trace"))).alias("i", "value"))
    return rows.select("vec_id", F.col("i").cast("long").alias("i"), F.round("value", 5).alias("value"))


CAMERA = [[1.0, 0.1, 0.0, 0.2], [0.0, 0.05, -1.0, 1.4], [0.1, 1.0, 0.0, 0.5]]
INTRINSICS, DISTORTION = [900.0, 880.0, 960.0, 640.0], [0.02, -0.01, 0.001, 0.002, 0.003, 0.01, 0.002, 0.001]


@query(f"""WITH {Q}, p AS (SELECT event_id, a + 0.1 * b + 0.2 AS x, 0.05 * b - c + 1.4 AS y, 0.1 * a + b + 0.5 AS z FROM q), r AS (SELECT *, x / z AS px, y / z AS py, (x / z) * (x / z) + (y / z) * (y / z) AS r2 FROM p),
d AS (SELECT *, (1 + 0.02 * r2 - 0.01 * r2 * r2 + 0.003 * r2 * r2 * r2) AS up, (1 + 0.01 * r2 + 0.002 * r2 * r2 + 0.001 * r2 * r2 * r2) AS down FROM r),
u AS (SELECT event_id, z, 900 * (px * up / down + 0.002 * px * py + 0.002 * (r2 + 2 * px * px)) + 960 AS u, 880 * (py * up / down + 0.001 * (r2 + 2 * py * py) + 0.004 * px * py) + 640 AS v FROM d)
SELECT event_id, round(CASE WHEN z > 0 THEN u ELSE -1 END, 2) AS u, round(CASE WHEN z > 0 THEN v ELSE -1 END, 2) AS v, z > 0 AND u >= 0 AND u < 1920 AND v >= 0 AND v < 1280 AS visible FROM u""")
def f48_projected(spark, sf_dir):
    lit = lambda values: [F.lit(v) for v in values]
    pixel = pose.projected(_cols(VECTOR), [lit(r) for r in CAMERA], lit(INTRINSICS), lit(DISTORTION))
    rows = _poses(spark, sf_dir).select("event_id", pixel.alias("p"))
    return rows.select("event_id", F.round("p.u", 2).alias("u"), F.round("p.v", 2).alias("v"), pose.visible(F.col("p"), 1920, 1280).alias("visible"))


@query(f"""WITH {Q}, k AS (SELECT event_id, CASE WHEN event_id % 3 > 0 THEN z ELSE x END AS r, CASE WHEN event_id % 3 > 0 THEN w ELSE y END AS back, a, greatest(b, 0.2) / 2 AS l, greatest(c, 0.2) / 2 AS h FROM q)
SELECT event_id, round(-back, 4) AS ahead, round(-r, 4) AS aside, round(cos(a) * l - sin(a) * h, 4) AS corner_x, round(sin(a) * l + cos(a) * h, 4) AS corner_y, CASE WHEN event_id % 10 BETWEEN 1 AND 4 THEN 1 WHEN event_id % 10 BETWEEN 5 AND 8 THEN 2 ELSE 3 END AS grp FROM k""")
def f51_objects(spark, sf_dir):
    """Filtered centres where they are finite (two of three), a corner of the box, and the group of the type (X49)."""
    kf = lambda c: F.when(F.col("event_id") % 3 > 0, F.col(c)).otherwise(float("nan"))
    ahead, aside = pose.object_centre(F.col("x"), F.col("y"), kf("z"), kf("w"))
    corner = pose.object_footprint(F.lit(0.0), F.lit(0.0), F.col("a"), F.col("b"), F.col("c"))[0]
    return _poses(spark, sf_dir).select("event_id", *_rounded([ahead, aside, corner["x"], corner["y"]], ["ahead", "aside", "corner_x", "corner_y"]), pose.object_group(F.col("event_id") % 10).alias("grp"))


ENDS = POINTS + ", ends AS (SELECT vec_id, max(CASE WHEN i = 63 THEN x END) AS ex, max(CASE WHEN i = 63 THEN y END) AS ey, max(CASE WHEN i = 59 THEN x END) AS tx, max(CASE WHEN i = 59 THEN y END) AS ty, max(CASE WHEN i = 0 THEN x END) AS x0, max(CASE WHEN i = 0 THEN y END) AS y0, max(abs(y)) AS widest FROM pts GROUP BY vec_id)"


def _kernel(rows, inputs, names, kernel):
    return kinematics.with_kernel(rows, inputs, {n: "array<double>" for n in names}, kernel)


def _points(rows, x, y, places=4):
    each = rows.select("vec_id", F.posexplode(F.arrays_zip(F.col(x).alias("x"), F.col(y).alias("y"))).alias("i", "p"))
    return each.select("vec_id", F.col("i").cast("long").alias("i"), F.round("p.x", places).alias("x"), F.round("p.y", places).alias("y"))


@query(f"WITH {ENDS} SELECT p.vec_id AS vec_id, i, round(x - (i + 1) / 64.0 * ex, 4) AS x, round(y - (i + 1) / 64.0 * ey, 4) AS y FROM pts p JOIN ends e ON p.vec_id = e.vec_id")
def f36_residual(spark, sf_dir):
    return _points(_kernel(trajectories(spark, sf_dir), ["x", "y"], ["rx", "ry"], profiles.residual), "rx", "ry")


@query(f"""WITH {ENDS}, far AS (SELECT p.vec_id, min(i) AS far_at FROM pts p JOIN ends e ON p.vec_id = e.vec_id WHERE i BETWEEN 1 AND 7 AND sqrt((x - x0) * (x - x0) + (y - y0) * (y - y0)) > 0.25 GROUP BY p.vec_id),
dir AS (SELECT p.vec_id, x0, y0, (x - x0) / sqrt((x - x0) * (x - x0) + (y - y0) * (y - y0)) AS ux, (y - y0) / sqrt((x - x0) * (x - x0) + (y - y0) * (y - y0)) AS uy FROM pts p JOIN ends e ON p.vec_id = e.vec_id LEFT JOIN far f ON p.vec_id = f.vec_id WHERE i = coalesce(far_at, 63))
SELECT p.vec_id AS vec_id, i, round((x - x0) * ux + (y - y0) * uy, 4) AS x, round((y - y0) * ux - (x - x0) * uy, 4) AS y FROM pts p JOIN dir d ON p.vec_id = d.vec_id""")
def f42_aligned(spark, sf_dir):
    return _points(_kernel(trajectories(spark, sf_dir), ["x", "y"], ["ax", "ay"], profiles.aligned), "ax", "ay")


@query(f"""WITH {ENDS}, area AS (SELECT vec_id, sum(dx * (2 * y - dy) / 2) AS area FROM steps WHERE i > 0 GROUP BY vec_id)
SELECT e.vec_id AS vec_id, round(ex, 4) AS end_x, round(ey, 4) AS end_y, round(widest, 4) AS widest, round(area, 4) AS area, round(atan2(ey - ty, ex - tx), 4) AS heading FROM ends e JOIN area a ON e.vec_id = a.vec_id""")
def f46_shape_stats(spark, sf_dir):
    names = ["end_x", "end_y", "widest", "area", "heading"]
    rows = kinematics.with_kernel(trajectories(spark, sf_dir), ["x", "y"], {n: "double" for n in names}, profiles.shape_stats)
    return rows.select("vec_id", *_rounded([F.col(n) for n in names], names))


@query(f"""WITH {POINTS}, s AS (SELECT vec_id, i, step / 0.1 AS v FROM kin), a AS (SELECT vec_id, i, (v - lag(v) OVER w) / 0.1 AS a FROM s WINDOW w AS (PARTITION BY vec_id ORDER BY i)), j AS (SELECT vec_id, i, a, (a - lag(a) OVER w) / 0.1 AS j FROM a WINDOW w AS (PARTITION BY vec_id ORDER BY i))
SELECT vec_id, CASE WHEN max(abs(a)) > 12 OR max(abs(j)) > 80 THEN 0.0 ELSE 1.0 END AS smooth, round(max(abs(a)), 3) AS max_accel, round(max(CASE WHEN i > 1 THEN abs(j) END), 3) AS max_jerk FROM j GROUP BY vec_id""")
def f27_rough_speed(spark, sf_dir):
    names = ["smooth", "max_accel", "max_jerk"]
    rows = kinematics.with_kernel(trajectories(spark, sf_dir), ["x", "y"], {n: "double" for n in names}, lambda x, y: profiles.rough_speed(profiles.profile_speed(x, y)))
    return rows.select("vec_id", "smooth", *_rounded([F.col(n) for n in names[1:]], names[1:], 3))


@query(f"""WITH {POINTS}, v AS (SELECT vec_id, i, step, step / 0.1 AS v, coalesce(step / 0.1 - lag(step / 0.1) OVER w, 0) / 0.1 AS a FROM kin WINDOW w AS (PARTITION BY vec_id ORDER BY i))
SELECT vec_id, CAST(count(*) FILTER (WHERE a < -6 OR a > 2) AS DOUBLE) AS bad, CAST(count(*) FILTER (WHERE step > 1.5 OR v > 15) AS DOUBLE) AS jumps FROM v GROUP BY vec_id""")
def f26_quality(spark, sf_dir):
    rows = kinematics.with_kernel(trajectories(spark, sf_dir), ["x", "y"], {n: "double" for n in ("good", "bad", "jumps")}, profiles.quality)
    return rows.select("vec_id", "bad", "jumps")


@query(f"""WITH {POINTS}, f AS (SELECT vec_id, i, x, y, exp(-0.5 * ((i - 20) / 10.0) * ((i - 20) / 10.0)) AS w FROM pts)
SELECT vec_id, i, round(CASE WHEN i = 0 THEN x ELSE x + w END, 4) AS x, round(CASE WHEN i = 0 THEN y ELSE y - 2 * w END, 4) AS y FROM f""")
def f29_dragged(spark, sf_dir):
    """Frame 20 moved by (1, -2)."""
    rows = trajectories(spark, sf_dir).withColumns({"frame": F.lit(20.0), "to_x": F.get("x", F.lit(20)) + 1.0, "to_y": F.get("y", F.lit(20)) - 2.0})
    return _points(_kernel(rows, ["x", "y", "frame", "to_x", "to_y"], ["mx", "my"], profiles.dragged), "mx", "my")


@query(f"""WITH {POINTS}, t AS (SELECT vec_id, i, step * greatest(0.05, 0.9 * (1 + 0.2 * (i / 63.0 - 0.5))) AS s, first_value(yaw) OVER w + 0.5 * (yaw - first_value(yaw) OVER w) AS h FROM kin WINDOW w AS (PARTITION BY vec_id ORDER BY i))
SELECT vec_id, i, round(sum(s * cos(h)) OVER w, 4) AS x, round(sum(s * sin(h)) OVER w, 4) AS y FROM t WINDOW w AS (PARTITION BY vec_id ORDER BY i ROWS UNBOUNDED PRECEDING)""")
def f38_transformed(spark, sf_dir):
    """Every step goes ahead here, so headings need no unwrapping."""
    rows = trajectories(spark, sf_dir).withColumns({"speed": F.lit(0.9), "ramp": F.lit(0.2), "bend": F.lit(0.5)})
    return _points(_kernel(rows, ["x", "y", "speed", "ramp", "bend"], ["vx", "vy"], profiles.transformed), "vx", "vy")


@query(f"""WITH {ENDS}, k AS (SELECT vec_id, i, step, yaw, coalesce(yaw - lag(yaw) OVER w, 0) / greatest(step, 1e-6) AS c FROM kin WINDOW w AS (PARTITION BY vec_id ORDER BY i)), m AS (SELECT vec_id, avg(step / 0.1) AS mean, sum(abs(c)) AS bend FROM k GROUP BY vec_id)
SELECT e.vec_id AS vec_id, CASE WHEN ex < 2 OR mean < 0.35 THEN 'stop' WHEN bend <= 0.15 THEN 'straight' WHEN ey <= 0 THEN 'right' ELSE 'left' END AS category FROM ends e JOIN m ON e.vec_id = m.vec_id""")
def p15_category(spark, sf_dir):
    """With a least run longer than a trace no window is an s_curve; tests cover those."""
    rows = kinematics.with_kernel(trajectories(spark, sf_dir), ["x", "y"], {n: "array<double>" for n in ("v", "ax", "ay", "c")}, kinematics.dynamics)
    kind = filters.category(F.col("x"), F.col("y"), F.col("v"), F.col("c"), F.lit(False), min_run=100)
    return rows.select("vec_id", kind.alias("category"))
