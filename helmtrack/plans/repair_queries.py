"""Queries over calibrations, image points, repaired and resampled trajectories, and views of clusters."""

from __future__ import annotations

from pyspark.sql import functions as F

from helmtrack.functions import camera, kinematics, profiles, resample, rows
from helmtrack.operators import clips, embedding, medoids, repair
from helmtrack.plans.curve_queries import compared
from helmtrack.plans.registry import query
from helmtrack.plans.trace_queries import FLAT, POINTS, traces, trajectories
from helmtrack.sources import calibration


@query("""WITH k AS (SELECT user_id, epoch_us(ts) AS at, min(event_id) AS first FROM events WHERE event_type = 'purchase' GROUP BY user_id, epoch_us(ts)),
s AS (SELECT event_id, user_id, epoch_us(ts) AS t FROM events WHERE event_type = 'click'),
r AS (SELECT s.event_id AS event_id, k.first AS calibration, k.at - s.t AS away, row_number() OVER (PARTITION BY s.event_id ORDER BY abs(k.at - s.t), k.at) AS p FROM s JOIN k ON s.user_id = k.user_id)
SELECT event_id, calibration, away FROM r WHERE p = 1""")
def j6_nearest_calibration(spark, sf_dir):
    """Each click with the purchase of its user that is nearest in time, the earlier of two equally near ones."""
    rows = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", "user_id", "event_type", F.unix_micros(F.col("ts").cast("timestamp")).alias("t"))
    known = rows.where("event_type = 'purchase'").groupBy("user_id", F.col("t").alias("at")).agg(F.min("event_id").alias("calibration"))
    known = known.withColumn("when", F.col("at"))
    found = calibration.nearest_in_time(rows.where("event_type = 'click'"), known, ["user_id"], "t", "at", ["calibration", "when"])
    return found.select("event_id", "calibration", (F.col("when") - F.col("t")).alias("away"))


#: A camera 1.5 m up that looks ahead and a little down, without distortion: rows of its transform, and its intrinsics.
_DOWN = (0.98, 0.19899748742132398)
_TRANSFORM = [1.0, 0.0, 0.0, 0.2, 0.0, -_DOWN[1], -_DOWN[0], 1.5 * _DOWN[0], 0.0, _DOWN[0], -_DOWN[1], 1.5 * _DOWN[1]]
_LENS = [1000.0, 900.0, 960.0, 540.0]


@query(f"""WITH {FLAT}, p AS (SELECT vec_id, i, (960 + 2000 * e - {_LENS[2]}) / {_LENS[0]} AS a, (900 + 1200 * e - {_LENS[3]}) / {_LENS[1]} AS b FROM flat),
r AS (SELECT vec_id, i, a AS rx, -{_DOWN[1]} * b + {_DOWN[0]} AS ry, -{_DOWN[0]} * b - {_DOWN[1]} AS rz FROM p)
SELECT vec_id, i, CASE WHEN rz < -1e-9 THEN round(-(1.5 / rz) * ry, 5) END AS x, CASE WHEN rz < -1e-9 THEN round(-(-0.2 - (1.5 / rz) * rx), 5) END AS y FROM r""")
def f50_ground_points(spark, sf_dir):
    """Traces as image points, put on the ground; null where their ray doesn't come down."""
    lit = lambda v: F.array(*(F.lit(float(x)) for x in v))
    rows = traces(spark, sf_dir).select("vec_id", F.transform("trace", lambda e: 960 + 2000 * e).alias("u"), F.transform("trace", lambda e: 900 + 1200 * e).alias("v"))
    rows = rows.withColumns({"k": lit(_LENS), "d": lit([0.0] * 8), "t": lit(_TRANSFORM)})
    found = kinematics.with_kernel(rows, ["u", "v", "k", "d", "t"], {"x": "array<double>", "y": "array<double>"}, camera.image_to_ground)
    each = found.select("vec_id", F.posexplode(F.arrays_zip("x", "y")).alias("i", "p"))
    return each.select("vec_id", "i", *[F.when(~F.isnan(f"p.{c}"), F.round(f"p.{c}", 5)).alias(c) for c in "xy"])


@query()
def f8_truth_repair(spark, sf_dir):
    """Trajectories as raw truths, every other one with its steps doubled, repaired by path or velocity."""
    rows = trajectories(spark, sf_dir)
    scale = F.when(F.col("vec_id") % 2 == 0, 1.0).otherwise(2.0)
    rows = rows.select("vec_id", *[F.transform(c, lambda v: v * scale).alias(c) for c in "xy"])
    step = lambda c: F.transform(c, lambda v, i: (v - F.when(i > 0, F.get(c, i - 1)).otherwise(0.0)) / kinematics.DT)
    rows = rows.withColumns({"vx": F.concat(F.array(F.lit(5.0)), step("x")), "vy": F.concat(F.array(F.lit(0.0)), step("y")), "dt": F.transform("x", lambda _: F.lit(kinematics.DT)), "speed": F.lit(5.0)})
    found = repair.repaired(rows)
    return found.select("vec_id", "repair", F.round(F.element_at("fixed_x", -1), 4).alias("end_x"), F.round(F.element_at("fixed_y", -1), 4).alias("end_y"), F.round(F.array_max("fixed_accel"), 4).alias("most"))


@query(f"""WITH {POINTS}, g AS (SELECT vec_id, i, x, y, sum(sqrt(power(x - px, 2) + power(y - py, 2))) OVER (PARTITION BY vec_id ORDER BY i ROWS UNBOUNDED PRECEDING) AS gone
  FROM (SELECT vec_id, i, x, y, coalesce(lag(x) OVER w, x) AS px, coalesce(lag(y) OVER w, y) AS py FROM pts WINDOW w AS (PARTITION BY vec_id ORDER BY i))),
t AS (SELECT vec_id, max(gone) AS total FROM g GROUP BY vec_id),
s AS (SELECT vec_id, total, unnest(range(64)) AS k FROM t),
w AS (SELECT vec_id, k, total, CASE WHEN k < 22 THEN 0.4 * total * (1 - (1 - (k + 1) / 23.0) * (1 - (k + 1) / 23.0)) WHEN k < 32 THEN 0.4 * total ELSE 0.4 * total + 0.6 * total * ((k - 31) / 32.0) * ((k - 31) / 32.0) END AS way FROM s),
m AS (SELECT w.vec_id AS vec_id, w.k AS k, w.way AS way, max(g.i) AS i FROM w JOIN g ON w.vec_id = g.vec_id AND g.gone <= w.way AND g.i < 63 GROUP BY w.vec_id, w.k, w.way)
SELECT m.vec_id AS vec_id, m.k AS k, round(a.x + (b.x - a.x) * greatest(least((m.way - a.gone) / (b.gone - a.gone), 1.0), 0.0), 5) AS x, round(a.y + (b.y - a.y) * greatest(least((m.way - a.gone) / (b.gone - a.gone), 1.0), 0.0), 5) AS y
FROM m JOIN g a ON m.vec_id = a.vec_id AND a.i = m.i JOIN g b ON m.vec_id = b.vec_id AND b.i = m.i + 1""")
def f15_stop_on_the_way(spark, sf_dir):
    """Trajectories driven anew in 64 steps with a stop of one second after two fifths of the way."""
    kernel = lambda x, y: resample.stopping_resample(x, y, x[:, 0] * 0 + 5.0, [[0.4]] * len(x), [[1.0]] * len(x), 64)
    rows = kinematics.with_kernel(trajectories(spark, sf_dir), ["x", "y"], {"sx": "array<double>", "sy": "array<double>"}, kernel)
    each = rows.select("vec_id", F.posexplode(F.arrays_zip("sx", "sy")).alias("k", "p"))
    return each.select("vec_id", "k", F.round("p.sx", 5).alias("x"), F.round("p.sy", 5).alias("y"))


@query()
def f16_final_stop(spark, sf_dir):
    """Trajectories slowed to half, nearly straightened, begun at the origin and driven anew so that the last second is spent at the end; null where that can't be."""
    kernel = lambda x, y: resample.final_stop_resample((x - x[:, :1]) / 2, (y - y[:, :1]) / 20, x[:, 0] * 0 + 5.0, x[:, 0] * 0 + 1.0, 64)
    rows = kinematics.with_kernel(trajectories(spark, sf_dir), ["x", "y"], {"sx": "array<double>", "sy": "array<double>"}, kernel)
    return rows.select("vec_id", F.round(F.get("sx", F.lit(40)), 4).alias("x40"), F.round(F.element_at("sx", -1), 4).alias("end_x"), F.round(F.element_at("sy", -1), 4).alias("end_y"))


@query()
def ml7_scaled_places(spark, sf_dir):
    """Places of the trajectories in a plane by their Frechet distances from landmarks."""
    found = embedding.scaled(compared(spark, sf_dir))
    return found.select(F.col("key").alias("vec_id"), *[F.round(F.get("place", F.lit(i)), 5).alias(c) for i, c in enumerate("ab")])


@query()
def f47_behaviours(spark, sf_dir):
    """Clusters around medoids with their behaviour, size and mean distance."""
    labels, keys = medoids.scalable_medoids(compared(spark, sf_dir), 5)
    aligned = kinematics.with_kernel(trajectories(spark, sf_dir).where(F.col("vec_id").isin(keys)), ["x", "y"], {"ax": "array<double>", "ay": "array<double>"}, profiles.aligned)
    shape = kinematics.with_kernel(aligned, ["ax", "ay"], {c: "double" for c in ("end_x", "end_y", "widest", "area", "heading")}, profiles.shape_stats)
    place = F.element_at(F.create_map(*[F.lit(v) for i, k in enumerate(keys) for v in (int(k), i)]), F.col("vec_id").cast("int"))
    table = embedding.summary(labels, keys, shape.select(place.alias("cluster"), "end_y", "widest", "heading"))
    return table.select("cluster", "behaviour", "size", "medoid", F.round("mean_to_medoid", 6).alias("mean_to_medoid"))


#: Frames of users as clips, numbered in order of time.
CLIPS = "f AS (SELECT user_id, event_id, value, row_number() OVER (PARTITION BY user_id ORDER BY epoch_us(ts), event_id) - 1 AS k FROM events)"


@query(f"""WITH {CLIPS}, n AS (SELECT user_id, k, value, count(*) OVER w AS n, sum(abs(value)) OVER w AS total, min(value) OVER w AS least FROM f WINDOW w AS (PARTITION BY user_id ORDER BY k ROWS BETWEEN 1 FOLLOWING AND 4 FOLLOWING))
SELECT user_id, k, CASE WHEN n = 4 THEN round(total, 5) END AS total, CASE WHEN n = 4 THEN round(least, 5) END AS least, round(value, 5) AS now FROM n""")
def x1_window_scores(spark, sf_dir):
    """For each event of a user the sum and the least of the next four values, out of the user's values as a clip."""
    rows = spark.read.parquet(f"{sf_dir}/events.parquet").select(F.lit("d").alias("dataset"), F.col("user_id").cast("string").alias("clip"), F.struct(F.unix_micros(F.col("ts").cast("timestamp")).alias("t"), "event_id").alias("at"), "user_id", "value")
    place = F.expr("row_number() OVER (PARTITION BY clip ORDER BY at) - 1")
    found = clips.sliced(rows.select("dataset", "clip", "user_id", place.cast("int").alias("t0_index")), rows, "at", {"v": F.col("value")}, 4)
    shown = lambda c: F.when(~F.isnan(c), F.round(c, 5))
    return found.select("user_id", F.col("t0_index").cast("long").alias("k"), shown(clips.absolute_sum(F.col("v"))).alias("total"), shown(clips.least(F.col("v"))).alias("least"), F.round("v_t0", 5).alias("now"))


@query("""WITH r AS (SELECT conv_id, turn, text, row_number() OVER (PARTITION BY conv_id, turn ORDER BY text DESC) AS p FROM conversations WHERE role = 'assistant' AND text IS NOT NULL),
u AS (SELECT DISTINCT conv_id, turn FROM conversations WHERE role = 'user') SELECT u.conv_id AS conv_id, u.turn AS turn, coalesce(r.text, '') AS cot FROM u LEFT JOIN r ON u.conv_id = r.conv_id AND r.turn = u.turn + 1 AND r.p = 1""")
def j8_reasoning(spark, sf_dir):
    """Each turn of a user with the answer as its reasoning, of several the last in order, or ''."""
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    key = lambda turn: [F.lit("d").alias("dataset"), F.col("conv_id").cast("string").alias("clip"), turn.alias("t0_us"), F.lit(0).alias("sample_idx")]
    asked = rows.where("role = 'user'").select(*key(F.col("turn")), "conv_id", "turn").distinct()
    texts = rows.where("role = 'assistant' AND text IS NOT NULL").select(*key(F.col("turn") - 1), F.col("text").alias("cot"), F.col("text").alias("place"))
    return clips.with_reasoning(asked, texts, "place").select("conv_id", "turn", "cot")


@query("""WITH f AS (SELECT event_type, CAST(user_id AS VARCHAR) AS clip, event_id, value, count(*) OVER w AS n, sum(value) OVER w AS total FROM events WINDOW w AS (PARTITION BY event_type ORDER BY CAST(user_id AS VARCHAR), event_id ROWS BETWEEN 3 PRECEDING AND CURRENT ROW))
SELECT event_id, CASE WHEN n = 4 THEN round(total, 5) END AS total FROM f""")
def w5_borrowed_history(spark, sf_dir):
    """The sum of each event's value and the three before it, borrowed from the users before where a user's events begin."""
    rows = spark.read.parquet(f"{sf_dir}/events.parquet").select(F.col("event_type").alias("dataset"), F.col("user_id").cast("string").alias("clip"), "event_id", "value")
    found = clips.borrowed_history(rows, "event_id", "value", 4)
    return found.select("event_id", F.round(F.aggregate("history", F.lit(0.0), lambda s, v: s + v), 5).alias("total"))


@query(f"""WITH {POINTS}, n AS (SELECT vec_id, i, dx / 0.1 AS vx, dy / 0.1 AS vy, yaw, lag(yaw) OVER w AS a, lead(yaw) OVER w AS b FROM kin WINDOW w AS (PARTITION BY vec_id ORDER BY i))
SELECT vec_id, i, round(vx, 5) AS vx, round(vy, 5) AS vy, round(sin(yaw / 2), 6) AS qz, round(cos(yaw / 2), 6) AS qw, round(CASE WHEN a IS NULL THEN b - yaw WHEN b IS NULL THEN yaw - a ELSE (b - a) / 2 END, 6) AS curvature FROM n""")
def f23_row_components(spark, sf_dir):
    """Velocity, heading and curvature by frame of the trajectories, as output rows have them."""
    out = {c: "array<double>" for c in ("vx", "vy", "vz", "qz", "qw", "bend")}
    found = kinematics.with_kernel(trajectories(spark, sf_dir).withColumn("z", F.transform("x", lambda _: F.lit(0.0))), ["x", "y", "z"], out, rows.components)
    each = found.select("vec_id", F.posexplode(F.arrays_zip(*out)).alias("i", "p"))
    return each.select("vec_id", "i", *[F.round(f"p.{c}", 5).alias(c) for c in ("vx", "vy")], *[F.round(f"p.{c}", 6).alias(n) for c, n in (("qz", "qz"), ("qw", "qw"), ("bend", "curvature"))])


@query(f"""WITH {POINTS}, s AS (SELECT vec_id, i, step, row_number() OVER (PARTITION BY vec_id ORDER BY i) AS k FROM kin)
SELECT vec_id, round(least(max(CASE WHEN k = 1 THEN step END) / 0.1, 15.0), 5) AS first, round(avg(CASE WHEN k <= 5 THEN step END) / 0.1, 5) AS mean FROM s GROUP BY vec_id""")
def f54_start_speeds(spark, sf_dir):
    """Speeds at the start of the trajectories: of the first step, and the mean of five."""
    found = kinematics.with_kernel(trajectories(spark, sf_dir), ["x", "y"], {"first": "double", "mean": "double"}, lambda x, y: (*rows.first_step_speed(x, y), *rows.mean_step_speed(x, y)))
    return found.select("vec_id", F.round("first", 5).alias("first"), F.round("mean", 5).alias("mean"))
