"""Queries over frames: ``events`` as telemetry, with user_id as clip and ``value`` as position or speed."""

from __future__ import annotations

from pyspark.sql import functions as F

from helmtrack.operators import aggregates, asof, filters, timeindex
from helmtrack.plans.registry import query

#: Limits in the time scale of ``events``: frames some hours apart.
GAP_US, SPEED, STEP = 86_400_000_000, 0.01, 21_600_000_000

FRAMES = "frames AS (SELECT event_id, user_id, event_type, value, epoch_us(ts) AS ts_us FROM events)"
SEGMENTS = FRAMES + f""", marked AS (
  SELECT *, CASE WHEN lag(ts_us) OVER w IS NULL OR (ts_us - lag(ts_us) OVER w > 0 AND ts_us - lag(ts_us) OVER w <= {GAP_US}
    AND abs(value - lag(value) OVER w) <= {SPEED} * (ts_us - lag(ts_us) OVER w) / 1e6) THEN 0 ELSE 1 END AS brk
  FROM frames WINDOW w AS (PARTITION BY user_id ORDER BY ts_us)
), segments AS (
  SELECT *, CAST(sum(brk) OVER (PARTITION BY user_id ORDER BY ts_us ROWS UNBOUNDED PRECEDING) AS BIGINT) AS segment FROM marked
)"""


def frames(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/events.parquet")
    return rows.select("event_id", "user_id", "event_type", "value", F.unix_micros(F.col("ts").cast("timestamp")).alias("ts_us"), "props")


def segments(spark, sf_dir):
    return timeindex.continuity_segments(frames(spark, sf_dir), ["user_id"], position=("value",), max_gap_us=GAP_US, max_speed=SPEED)


@query(f"WITH {SEGMENTS} SELECT user_id, segment, min(ts_us) AS start_us, max(ts_us) AS end_us, count(*) AS n_frames FROM segments GROUP BY user_id, segment")
def w1_continuity_segments(spark, sf_dir):
    return timeindex.segment_bounds(segments(spark, sf_dir), ["user_id"])


@query(f"""WITH {SEGMENTS}, bounds AS (SELECT user_id, segment, min(ts_us) AS s, max(ts_us) AS e FROM segments GROUP BY user_id, segment)
SELECT x.user_id AS user_id, x.event_id AS event_id, x.ts_us AS t0_us FROM segments x JOIN bounds b ON x.user_id = b.user_id AND x.segment = b.segment
WHERE x.ts_us >= b.s AND x.ts_us + 2 * {STEP} <= b.e""")
def w3_full_future(spark, sf_dir):
    marked = segments(spark, sf_dir)
    samples = marked.select("user_id", "event_id", F.col("ts_us").alias("t0_us"), "segment")
    return timeindex.full_future(samples, timeindex.segment_bounds(marked, ["user_id"]), ["user_id"], horizon=2, step_us=STEP).drop("segment")


@query(f"WITH {FRAMES}, r AS (SELECT *, row_number() OVER (PARTITION BY user_id, ts_us // 3600000000 ORDER BY event_id) AS k FROM frames) SELECT user_id, event_id, ts_us // 3600000000 AS hour FROM r WHERE k = 1")
def a7_dedup_timestamps(spark, sf_dir):
    hourly = frames(spark, sf_dir).select("user_id", "event_id", F.floor(F.col("ts_us") / 3_600_000_000).alias("hour"))
    return timeindex.dedup_timestamps(hourly, ["user_id"], "hour", "event_id")


@query(f"""WITH {FRAMES}, i AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts_us) - 1 AS frame_index, count(*) OVER (PARTITION BY user_id) AS n_frames FROM frames)
SELECT user_id, event_id, frame_index FROM i WHERE frame_index >= 4 AND frame_index <= n_frames - 1 - 8 AND (frame_index - 1) % 3 = 0""")
def p6_stride_index(spark, sf_dir):
    indexed = timeindex.frame_index(frames(spark, sf_dir), ["user_id"])
    return timeindex.stride_index(indexed, start=1, stride=3, history=4, future=8).select("user_id", "event_id", "frame_index")


@query(f"""WITH {FRAMES}, i AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts_us) - 1 AS frame_index, count(*) OVER (PARTITION BY user_id) AS n_frames FROM frames)
SELECT user_id, event_id, frame_index FROM i WHERE n_frames - 9 > 4 AND frame_index >= 4 AND frame_index < n_frames - 9 AND (frame_index - 4) % 5 = 0 AND abs(value) >= 20""")
def p8_speed_candidates(spark, sf_dir):
    indexed = timeindex.frame_index(frames(spark, sf_dir), ["user_id"])
    return timeindex.speed_candidates(indexed, F.col("value"), 20.0, history=4, horizon=8, stride=5).select("user_id", "event_id", "frame_index")


@query(f"""WITH {FRAMES}, w AS (SELECT user_id, event_id, list(value) OVER (PARTITION BY user_id ORDER BY ts_us ROWS BETWEEN 1 FOLLOWING AND 5 FOLLOWING) AS f FROM frames)
SELECT user_id, event_id, f[1] AS next_value, f[5] AS last_value FROM w WHERE len(f) = 5""")
def w4_future_window(spark, sf_dir):
    found = timeindex.future_window(frames(spark, sf_dir), ["user_id"], "value", 5).where("future IS NOT NULL")
    return found.select("user_id", "event_id", F.col("future")[0].alias("next_value"), F.col("future")[4].alias("last_value"))


@query(f"""WITH {FRAMES}, w AS (SELECT user_id, event_id, list(value) OVER (PARTITION BY user_id ORDER BY ts_us ROWS BETWEEN 3 PRECEDING AND CURRENT ROW) AS h FROM frames)
SELECT user_id, event_id, h[1] AS oldest_value FROM w WHERE len(h) = 4""")
def w5_history_window(spark, sf_dir):
    found = timeindex.history_window(frames(spark, sf_dir), ["user_id"], "value", 4).where("history IS NOT NULL")
    return found.select("user_id", "event_id", F.col("history")[0].alias("oldest_value"))


@query(f"""WITH {FRAMES}, t AS (SELECT user_id, count(*) AS total FROM frames WHERE event_type <> 'purchase' GROUP BY user_id), g AS (SELECT user_id, count(*) AS generated FROM frames WHERE event_type = 'purchase' GROUP BY user_id)
SELECT coalesce(t.user_id, g.user_id) AS user_id, coalesce(total, 0) AS total, coalesce(generated, 0) AS generated, greatest(coalesce(total, 0) - coalesce(generated, 0), 0) AS missing FROM t FULL JOIN g ON t.user_id = g.user_id""")
def a9_coverage_counts(spark, sf_dir):
    rows = frames(spark, sf_dir)
    return timeindex.coverage_counts(rows.where("event_type <> 'purchase'"), rows.where("event_type = 'purchase'"), ["user_id"])


SIDES = FRAMES + ", l AS (SELECT user_id, event_id, ts_us FROM frames WHERE event_type = 'click'), r AS (SELECT user_id, ts_us, value FROM frames WHERE event_type = 'purchase')"


def _sides(spark, sf_dir):
    rows = frames(spark, sf_dir)
    return rows.where("event_type = 'click'").select("user_id", "event_id", "ts_us"), rows.where("event_type = 'purchase'").select("user_id", F.col("ts_us").alias("at_us"), "value")


@query(f"""WITH {SIDES}, p AS (SELECT l.user_id, l.event_id, l.ts_us, r.ts_us AS at_us, r.value, row_number() OVER (PARTITION BY l.event_id ORDER BY abs(r.ts_us - l.ts_us), r.ts_us) AS k FROM l LEFT JOIN r ON l.user_id = r.user_id)
SELECT user_id, event_id, at_us AS match_us, value AS match_value FROM p WHERE k = 1""")
def j1_nearest(spark, sf_dir):
    left, right = _sides(spark, sf_dir)
    found = asof.nearest(left, right, ["user_id"], "ts_us", "at_us", ["value"])
    return found.select("user_id", "event_id", F.col("match.at").alias("match_us"), F.col("match.value").alias("match_value"))


@query(f"""WITH {SIDES}
SELECT l.user_id AS user_id, l.event_id AS event_id, max(CASE WHEN r.ts_us <= l.ts_us THEN r.ts_us END) AS before_us, min(CASE WHEN r.ts_us >= l.ts_us THEN r.ts_us END) AS after_us
FROM l LEFT JOIN r ON l.user_id = r.user_id GROUP BY l.user_id, l.event_id""")
def j2_bracket(spark, sf_dir):
    left, right = _sides(spark, sf_dir)
    found = asof.bracket(left, right, ["user_id"], "ts_us", "at_us", ["value"])
    return found.select("user_id", "event_id", F.col("before.at").alias("before_us"), F.col("after.at").alias("after_us"))


@query(f"""WITH {SIDES}, b AS (SELECT l.user_id, l.event_id, l.ts_us, max(CASE WHEN r.ts_us <= l.ts_us THEN r.ts_us END) AS lo, min(CASE WHEN r.ts_us >= l.ts_us THEN r.ts_us END) AS hi FROM l LEFT JOIN r ON l.user_id = r.user_id GROUP BY l.user_id, l.event_id, l.ts_us)
SELECT user_id, event_id, coalesce(lo = ts_us, false) OR coalesce(hi - lo <= {4 * GAP_US}, false) AS covered FROM b""")
def j2_covered(spark, sf_dir):
    left, right = _sides(spark, sf_dir)
    return asof.covered(left, right, ["user_id"], "ts_us", "at_us", 4 * GAP_US).select("user_id", "event_id", "covered")


@query(f"""WITH {SIDES}, s AS (SELECT *, (lead(value) OVER w - value) / (lead(ts_us) OVER w - ts_us) AS ahead, (value - lag(value) OVER w) / (ts_us - lag(ts_us) OVER w) AS behind FROM r WINDOW w AS (PARTITION BY user_id ORDER BY ts_us)),
b AS (SELECT l.user_id, l.event_id, l.ts_us, max(CASE WHEN r.ts_us <= l.ts_us THEN r.ts_us END) AS lo, min(CASE WHEN r.ts_us >= l.ts_us THEN r.ts_us END) AS hi FROM l LEFT JOIN r ON l.user_id = r.user_id GROUP BY l.user_id, l.event_id, l.ts_us)
SELECT b.user_id AS user_id, b.event_id AS event_id, round(s.value + CASE WHEN b.ts_us = s.ts_us THEN 0 ELSE coalesce(CASE WHEN lo IS NOT NULL AND hi IS NULL THEN s.behind ELSE s.ahead END, 0) * (b.ts_us - s.ts_us) END, 4) AS value
FROM b LEFT JOIN s ON b.user_id = s.user_id AND s.ts_us = coalesce(lo, hi)""")
def f5_interpolated(spark, sf_dir):
    left, right = _sides(spark, sf_dir)
    return asof.interpolated(left, right, ["user_id"], "ts_us", "at_us", "value").select("user_id", "event_id", F.round("value", 4).alias("value"))


@query(f"""WITH {SIDES}, p AS (SELECT l.event_id, abs(r.ts_us - l.ts_us) AS d, r.ts_us AS at_us, row_number() OVER (PARTITION BY l.event_id ORDER BY abs(r.ts_us - l.ts_us), r.ts_us) AS k FROM l JOIN r ON l.user_id = r.user_id AND abs(r.ts_us - l.ts_us) <= {GAP_US})
SELECT l.user_id AS user_id, l.event_id AS event_id, p.at_us AS match_us FROM l LEFT JOIN p ON l.event_id = p.event_id AND p.k = 1""")
def j5_tolerance_join(spark, sf_dir):
    left, right = _sides(spark, sf_dir)
    found = asof.nearest(left, right, ["user_id"], "ts_us", "at_us", [], GAP_US)
    return found.select("user_id", "event_id", F.col("match.at").alias("match_us"))


@query(f"WITH {FRAMES} SELECT user_id, event_id, round(avg(value) OVER (PARTITION BY user_id ORDER BY ts_us ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING), 4) AS local_mean FROM frames")
def a16_local_mean(spark, sf_dir):
    found = aggregates.local_mean(frames(spark, sf_dir), ["user_id"], "ts_us", "value")
    return found.select("user_id", "event_id", F.round("local_mean", 4).alias("local_mean"))


@query(f"""WITH {FRAMES}, d AS (SELECT *, value - lag(value) OVER (PARTITION BY user_id ORDER BY ts_us) AS step FROM frames),
r AS (SELECT CASE WHEN value < 1 THEN 'slow' WHEN step < -100 OR step > 100 THEN 'accel' WHEN value > 200 THEN 'fast' ELSE 'kept' END AS reason FROM d)
SELECT reason, count(*) AS n FROM r GROUP BY reason""")
def p11_reject_reasons(spark, sf_dir):
    from pyspark.sql import Window

    step = F.col("value") - F.lag("value").over(Window.partitionBy("user_id").orderBy("ts_us"))
    rows = frames(spark, sf_dir).withColumn("step", step)
    rules = [("slow", F.col("value") < 1), ("accel", (F.col("step") < -100) | (F.col("step") > 100)), ("fast", F.col("value") > 200)]
    return aggregates.reason_counts(rows.withColumn("reject_reason", filters.reject_reason(rules)))
