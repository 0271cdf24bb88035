"""Queries over traces: ``embeddings`` as 64-step signals, and trajectories made of them."""

from __future__ import annotations

from pyspark.sql import functions as F

from helmtrack.functions import arrays, kinematics, resample
from helmtrack.operators import aggregates, match
from helmtrack.plans.registry import query

FLAT = "flat AS (SELECT vec_id, label, unnest(range(len(embedding))) AS i, CAST(unnest(embedding) AS DOUBLE) AS e FROM embeddings)"
POINTS = FLAT + """, pts AS (SELECT vec_id, label, i, sum(0.5 + abs(e)) OVER w AS x, sum(e) OVER w AS y FROM flat WINDOW w AS (PARTITION BY vec_id ORDER BY i ROWS UNBOUNDED PRECEDING)),
steps AS (SELECT vec_id, label, i, x, y, x - coalesce(lag(x) OVER w, 0) AS dx, y - coalesce(lag(y) OVER w, 0) AS dy FROM pts WINDOW w AS (PARTITION BY vec_id ORDER BY i)),
kin AS (SELECT *, sqrt(dx * dx + dy * dy) AS step, atan2(dy, dx) AS yaw FROM steps)"""


def traces(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return rows.select("vec_id", "label", F.col("embedding").cast("array<double>").alias("trace"))


def trajectories(spark, sf_dir):
    """x and y as running sums of the traces, so that every step goes ahead."""
    rows = traces(spark, sf_dir)
    kernel = lambda e: ((0.5 + abs(e)).cumsum(1), e.cumsum(1))
    return kinematics.with_kernel(rows, ["trace"], {"x": "array<double>", "y": "array<double>"}, kernel)


def _long(rows, key, name):
    return rows.select(key, F.posexplode(name).alias("i", "value")).select(key, "i", F.round("value", 6).alias("value"))


@query(f"WITH {FLAT} SELECT vec_id, i, round(e - coalesce(lag(e) OVER (PARTITION BY vec_id ORDER BY i), 0), 6) AS value FROM flat")
def w7_differences(spark, sf_dir):
    return _long(traces(spark, sf_dir).select("vec_id", arrays.differences(F.col("trace")).alias("d")), "vec_id", "d")


@query(f"""WITH {FLAT}, n AS (SELECT vec_id, i, e, coalesce(lag(e, 2) OVER w, first_value(e) OVER w) AS a, coalesce(lag(e, 1) OVER w, first_value(e) OVER w) AS b, lead(e, 1) OVER w AS c, lead(e, 2) OVER w AS d,
  last_value(e) OVER (PARTITION BY vec_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS z FROM flat WINDOW w AS (PARTITION BY vec_id ORDER BY i))
SELECT vec_id, i, round((a + coalesce(d, z) + 2 * (b + coalesce(c, z)) + 3 * e) / 9, 6) AS value FROM n""")
def w10_smooth5(spark, sf_dir):
    return _long(traces(spark, sf_dir).select("vec_id", arrays.smooth5(F.col("trace")).alias("s")), "vec_id", "s")


@query(f"WITH {FLAT}, n AS (SELECT vec_id, i, e, lag(e) OVER w AS a, lead(e) OVER w AS b FROM flat WINDOW w AS (PARTITION BY vec_id ORDER BY i)) SELECT vec_id, i, round(CASE WHEN a IS NULL OR b IS NULL THEN e ELSE 0.25 * (a + b) + 0.5 * e END, 6) AS value FROM n")
def w11_smooth3(spark, sf_dir):
    return _long(traces(spark, sf_dir).select("vec_id", arrays.smooth3(F.col("trace")).alias("s")), "vec_id", "s")


@query(f"WITH {FLAT}, n AS (SELECT vec_id, i, e, lag(e) OVER w AS a, lead(e) OVER w AS b FROM flat WINDOW w AS (PARTITION BY vec_id ORDER BY i)) SELECT vec_id, i, round(CASE WHEN a IS NULL OR b IS NULL THEN e ELSE 0.2 * (a + b) + 0.6 * e END, 6) AS value FROM n")
def w12_smooth_curvature(spark, sf_dir):
    return _long(traces(spark, sf_dir).select("vec_id", arrays.smooth3(F.col("trace"), 0.2, 6).alias("s")), "vec_id", "s")


RUNS = FLAT + ", m AS (SELECT vec_id, i, e, i - row_number() OVER (PARTITION BY vec_id, {test} ORDER BY i) AS g, {test} AS hit FROM flat)"


@query(f"WITH {RUNS.replace('{test}', 'e >= 0.0')}, r AS (SELECT vec_id, g, count(*) AS n FROM m WHERE hit GROUP BY vec_id, g) SELECT e.vec_id AS vec_id, CAST(coalesce(max(r.n), 0) AS INTEGER) AS longest FROM embeddings e LEFT JOIN r ON e.vec_id = r.vec_id GROUP BY e.vec_id")
def w15_max_run(spark, sf_dir):
    return traces(spark, sf_dir).select("vec_id", arrays.max_run(F.col("trace"), lambda x: x >= 0.0).alias("longest"))


@query(f"""WITH {FLAT}, s AS (SELECT vec_id, i, CASE WHEN e >= 0.03 THEN 1 WHEN e <= -0.03 THEN -1 ELSE 0 END AS s FROM flat),
g AS (SELECT vec_id, i, s, i - row_number() OVER (PARTITION BY vec_id, s ORDER BY i) AS g FROM s), r AS (SELECT vec_id, s, g, min(i) AS first FROM g WHERE s <> 0 GROUP BY vec_id, s, g HAVING count(*) >= 3),
o AS (SELECT vec_id, s, first, lag(s) OVER (PARTITION BY vec_id ORDER BY first) AS p FROM r),
t AS (SELECT vec_id, string_agg(CAST(s AS VARCHAR), ',' ORDER BY first) AS seq FROM o WHERE p IS NULL OR p <> s GROUP BY vec_id)
SELECT e.vec_id AS vec_id, coalesce(t.seq, '') AS sequence FROM embeddings e LEFT JOIN t ON e.vec_id = t.vec_id""")
def w16_sign_runs(spark, sf_dir):
    found = arrays.sign_runs(F.col("trace"), 0.03, 3)
    return traces(spark, sf_dir).select("vec_id", F.array_join(found.cast("array<string>"), ",").alias("sequence"))


@query(f"WITH {RUNS.replace('{test}', 'e < 0.05')} SELECT vec_id, CAST(min(i) AS INTEGER) AS first, CAST(max(i) AS INTEGER) AS last FROM m WHERE hit GROUP BY vec_id, g HAVING count(*) >= 5")
def w9_stop_segments(spark, sf_dir):
    runs = traces(spark, sf_dir).select("vec_id", F.explode(arrays.low_runs(F.col("trace"), 0.05, 5)).alias("run"))
    return runs.select("vec_id", "run.first", "run.last")


@query(f"""WITH {FLAT}, a AS (SELECT vec_id, i, e, row_number() OVER (PARTITION BY vec_id ORDER BY i) AS k FROM flat WHERE abs(e) >= 0.1), f AS (SELECT vec_id, max(CASE WHEN e * p < 0 THEN 1 ELSE 0 END) AS flip FROM (SELECT vec_id, e, lag(e) OVER (PARTITION BY vec_id ORDER BY k) AS p FROM a) GROUP BY vec_id),
m AS (SELECT vec_id, i, sign(e) AS s, i - row_number() OVER (PARTITION BY vec_id, sign(e), abs(e) >= 0.1 ORDER BY i) AS g, abs(e) >= 0.1 AS hit FROM flat), r AS (SELECT vec_id, s, g, count(*) AS n FROM m WHERE hit GROUP BY vec_id, s, g),
b AS (SELECT vec_id, max(CASE WHEN s > 0 THEN n ELSE 0 END) AS up, max(CASE WHEN s < 0 THEN n ELSE 0 END) AS down FROM r GROUP BY vec_id)
SELECT e.vec_id AS vec_id, coalesce(up >= 2 AND down >= 2 AND flip = 1, false) AS s_curve FROM embeddings e LEFT JOIN b ON e.vec_id = b.vec_id LEFT JOIN f ON e.vec_id = f.vec_id""")
def p13_s_curve(spark, sf_dir):
    return traces(spark, sf_dir).select("vec_id", arrays.has_s_curve(F.col("trace"), 0.1, 2).alias("s_curve"))


@query(f"""WITH {POINTS}, d AS (SELECT *, step / 0.1 AS speed, lag(dx) OVER w AS pdx, lag(dy) OVER w AS pdy, lag(yaw) OVER w AS pyaw FROM kin WINDOW w AS (PARTITION BY vec_id ORDER BY i))
SELECT vec_id, i, round(speed, 5) AS speed, round(CASE WHEN i = 0 THEN 0 ELSE (dx - pdx) / 0.01 END, 5) AS ax, round(CASE WHEN i = 0 THEN 0 ELSE (dy - pdy) / 0.01 END, 5) AS ay, round(CASE WHEN i = 0 THEN 0 ELSE (yaw - pyaw) / step END, 5) AS curvature FROM d""")
def f21_dynamics(spark, sf_dir):
    out = {c: "array<double>" for c in ("speed", "ax", "ay", "curvature")}
    rows = kinematics.with_kernel(trajectories(spark, sf_dir), ["x", "y"], out, kinematics.dynamics)
    each = rows.select("vec_id", F.posexplode(F.arrays_zip(*out)).alias("i", "p"))
    return each.select("vec_id", "i", *[F.round(f"p.{c}", 5).alias(c) for c in out])


@query(f"""WITH {POINTS}, v AS (SELECT vec_id, i, step / 0.1 AS speed FROM kin), a AS (SELECT vec_id, i, speed, CASE WHEN i = 0 THEN 0 ELSE (speed - lag(speed) OVER w) / 0.1 END AS accel FROM v WINDOW w AS (PARTITION BY vec_id ORDER BY i)),
j AS (SELECT *, CASE WHEN i = 0 THEN 0 ELSE (accel - lag(accel) OVER w) / 0.1 END AS jerk FROM a WINDOW w AS (PARTITION BY vec_id ORDER BY i))
SELECT vec_id, round(max(speed), 4) AS max_speed, round(min(accel), 4) AS min_accel, round(max(accel), 4) AS max_accel, round(max(abs(jerk)), 3) AS max_jerk FROM j GROUP BY vec_id""")
def f25_diagnostics(spark, sf_dir):
    kernel = lambda x, y: (lambda s: (s[1].max(1), s[2].min(1), s[2].max(1), abs(s[3]).max(1)))(kinematics.scalar_profile(x, y))
    out = {c: "double" for c in ("max_speed", "min_accel", "max_accel", "max_jerk")}
    rows = kinematics.with_kernel(trajectories(spark, sf_dir), ["x", "y"], out, kernel)
    return rows.select("vec_id", *[F.round(c, 3 if c == "max_jerk" else 4).alias(c) for c in out])


@query("WITH " + FLAT + ", m AS (SELECT label, i, avg(e) AS v FROM flat GROUP BY label, i) SELECT label, i, round(v, 6) AS value FROM m")
def a2_mean_trace(spark, sf_dir):
    return _long(aggregates.mean_trace(traces(spark, sf_dir), ["label"], "trace"), "label", "mean")


@query(f"""WITH {FLAT}, c AS (SELECT i, quantile_cont(abs(e), 0.99) AS clip FROM flat GROUP BY i), l AS (SELECT f.i AS i, c.clip AS clip, greatest(least(f.e, c.clip), -c.clip) AS v FROM flat f JOIN c ON f.i = c.i)
SELECT i AS pos, round(clip, 6) AS clip, round(avg(v), 6) AS mean, round(CASE WHEN stddev_pop(v) < 1e-6 THEN 1 ELSE stddev_pop(v) END, 6) AS std FROM l GROUP BY i, clip""")
def a4_trace_stats(spark, sf_dir):
    found = aggregates.trace_stats(traces(spark, sf_dir), "trace")
    return found.select("pos", *[F.round(c, 6).alias(c) for c in ("clip", "mean", "std")])


@query(f"WITH {FLAT} SELECT round(quantile_cont(e, 0.5), 6) AS median, round(quantile_cont(e, 0.75) - quantile_cont(e, 0.25), 6) AS iqr FROM flat")
def a5_spread(spark, sf_dir):
    found = aggregates.spread(traces(spark, sf_dir), "trace")
    return found.select(F.round("median", 6).alias("median"), F.round("iqr", 6).alias("iqr"))


CENTRES = FLAT + """, cen AS (SELECT label AS c, i, avg(e) AS v FROM flat GROUP BY label, i), dist AS (SELECT f.vec_id AS vec_id, f.label AS label, c.c AS centre, sum((f.e - c.v) * (f.e - c.v)) AS d FROM flat f JOIN cen c ON f.i = c.i GROUP BY f.vec_id, f.label, c.c)"""


@query(f"WITH {CENTRES}, r AS (SELECT vec_id, centre, d, row_number() OVER (PARTITION BY vec_id ORDER BY d, centre) AS rank FROM dist) SELECT vec_id, centre, CAST(rank AS INTEGER) AS rank, round(d, 6) AS distance FROM r WHERE rank <= 2")
def t2_nearest_centres(spark, sf_dir):
    rows = traces(spark, sf_dir)
    centres = aggregates.mean_trace(rows, ["label"], "trace").select(F.col("label").alias("centre"), "mean")
    found = match.nearest_centres(rows, "vec_id", "trace", centres, "centre", "mean", 2)
    return found.select("vec_id", "centre", "rank", F.round("distance", 6).alias("distance"))


@query(f"WITH {CENTRES}, own AS (SELECT label, vec_id, d, row_number() OVER (PARTITION BY label ORDER BY d, vec_id) AS k FROM dist WHERE centre = label) SELECT label, vec_id AS medoid FROM own WHERE k = 1")
def a13_medoids(spark, sf_dir):
    rows = traces(spark, sf_dir)
    centres = aggregates.mean_trace(rows, ["label"], "trace")
    members = rows.join(centres, "label").select("label", "vec_id", match.squared_distance(F.col("trace"), F.col("mean")).alias("distance"))
    return match.medoids(members, "label", "vec_id", "distance").select("label", "medoid")


@query("SELECT r.k AS cluster, count(e.vec_id) AS size FROM (SELECT CAST(unnest(range(12)) AS INTEGER) AS k) r LEFT JOIN embeddings e ON e.label = r.k GROUP BY r.k")
def a3_cluster_sizes(spark, sf_dir):
    return aggregates.cluster_sizes(traces(spark, sf_dir), 12, "label").withColumnRenamed("label", "cluster")


@query(f"""WITH {POINTS}, e AS (SELECT vec_id, label, x, y, dx / step AS ux, dy / step AS uy FROM kin WHERE i = 63), m AS (SELECT label, min(vec_id) AS first FROM e GROUP BY label), g AS (SELECT e.* FROM e JOIN m ON e.vec_id = m.first),
b AS (SELECT e.vec_id AS vec_id, g.vec_id AS truth, (e.x - g.x) * g.ux + (e.y - g.y) * g.uy AS lon, (e.y - g.y) * g.ux - (e.x - g.x) * g.uy AS lat FROM e JOIN g ON e.label = g.label)
SELECT vec_id, truth, round(lon, 5) AS longitudinal, round(lat, 5) AS lateral, abs(lat) <= 2 AND lon >= -5 AND lon <= 4 AS inside FROM b""")
def p16_endpoint_box(spark, sf_dir):
    rows = trajectories(spark, sf_dir)
    firsts = rows.groupBy("label").agg(F.min(F.struct("vec_id", "x", "y")).alias("g"))
    joined = rows.join(firsts, "label")
    lon, lat = match.endpoint_error(F.col("g.x"), F.col("g.y"), F.element_at("x", -1), F.element_at("y", -1))
    return joined.select("vec_id", F.col("g.vec_id").alias("truth"), F.round(lon, 5).alias("longitudinal"), F.round(lat, 5).alias("lateral"), match.in_box(lon, lat).alias("inside"))


@query(f"WITH {POINTS}, m AS (SELECT label, min(vec_id) AS first FROM pts GROUP BY label) SELECT p.vec_id AS vec_id, round(avg(sqrt((p.x - g.x) * (p.x - g.x) + (p.y - g.y) * (p.y - g.y))), 5) AS distance FROM pts p JOIN m ON p.label = m.label JOIN pts g ON g.vec_id = m.first AND g.i = p.i GROUP BY p.vec_id")
def f34_mean_distance(spark, sf_dir):
    rows = trajectories(spark, sf_dir)
    firsts = rows.groupBy("label").agg(F.min(F.struct("vec_id", "x", "y")).alias("g"))
    found = match.mean_pointwise(F.col("x"), F.col("y"), F.col("g.x"), F.col("g.y"))
    return rows.join(firsts, "label").select("vec_id", F.round(found, 5).alias("distance"))


@query()
def f32_rollout(spark, sf_dir):
    """Traces driven as acceleration, with their reverse as curvature, from 5 m/s; end points."""
    rows = traces(spark, sf_dir).withColumns({"curvature": F.reverse("trace"), "speed": F.lit(5.0)})
    out = {"x": "array<double>", "y": "array<double>"}
    rolled = kinematics.with_kernel(rows, ["trace", "curvature", "speed"], out, kinematics.rollout)
    return rolled.select("vec_id", F.element_at("x", -1).alias("end_x"), F.element_at("y", -1).alias("end_y"))


@query()
def f11_limited_resample(spark, sf_dir):
    """Trajectories resampled within the acceleration limits; null where that can't keep their length."""
    out = {"rx": "array<double>", "ry": "array<double>"}
    rows = kinematics.with_kernel(trajectories(spark, sf_dir), ["x", "y"], out, resample.limited_resample)
    return rows.select("vec_id", F.element_at("rx", -1).alias("end_x"), F.element_at("ry", -1).alias("end_y"))


@query()
def t6_diverse(spark, sf_dir):
    """Of each label's trajectories, from the nearest to its mean on, up to 5 that are far enough apart."""
    rows = trajectories(spark, sf_dir)
    centres = aggregates.mean_trace(traces(spark, sf_dir), ["label"], "trace")
    scored = rows.join(centres, "label").select("label", "vec_id", "x", "y", match.squared_distance(F.col("trace"), F.col("mean")).alias("score"))
    return match.diverse(scored, ["label"], "score", "vec_id", "x", "y", 1.0, 5).select("label", "vec_id", "rank")
