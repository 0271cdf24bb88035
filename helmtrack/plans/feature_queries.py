"""Queries over window features: traces as windows of 32 points, and speed buckets of events."""

from __future__ import annotations

from pyspark.sql import functions as F

from helmtrack.operators import features
from helmtrack.plans.registry import query
from helmtrack.plans.trace_queries import FLAT, traces


@query("SELECT event_id, floor(greatest(value, 0.0) / 2.5 + 0.5) * 2.5 AS bucket FROM events")
def f33_speed_bucket(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/events.parquet")
    return rows.select("event_id", features.speed_bucket(F.col("value"), 2.5).alias("bucket"))


@query(f"""WITH {FLAT}, e AS (SELECT vec_id, max(CASE WHEN i = 62 THEN e END) AS x, max(CASE WHEN i = 63 THEN e END) AS y FROM flat GROUP BY vec_id)
SELECT vec_id, 0 AS part, round(-y, 6) AS value FROM e UNION ALL SELECT vec_id, 1, round(x, 6) FROM e UNION ALL SELECT vec_id, 2 + i // 2, round(-2 * e, 6) FROM flat WHERE i % 2 = 1""")
def f41_window_feature(spark, sf_dir):
    found = features.window_feature(F.col("trace"), "final_xy", lateral_weight=2.0)
    each = traces(spark, sf_dir).select("vec_id", F.posexplode(found).alias("part", "value"))
    return each.select("vec_id", "part", F.round("value", 6).alias("value"))


@query(f"WITH {FLAT} SELECT vec_id, CASE WHEN -e >= 0 THEN 'right' ELSE 'left' END AS side FROM flat WHERE i = 63")
def ml4_turn_side(spark, sf_dir):
    return traces(spark, sf_dir).select("vec_id", features.turn_side(F.col("trace")).alias("side"))


@query(f"""WITH {FLAT}, p AS (SELECT vec_id, i // 2 AS k, max(CASE WHEN i % 2 = 0 THEN e END) AS x, max(CASE WHEN i % 2 = 1 THEN e END) AS y FROM flat GROUP BY vec_id, i // 2),
s AS (SELECT vec_id, (x - lag(x) OVER w) * (y + lag(y) OVER w) / 2 AS a FROM p WINDOW w AS (PARTITION BY vec_id ORDER BY k)) SELECT vec_id, round(coalesce(sum(a), 0), 6) AS area FROM s GROUP BY vec_id""")
def f46_lateral_area(spark, sf_dir):
    return traces(spark, sf_dir).select("vec_id", F.round(features.lateral_area(F.col("trace")), 6).alias("area"))


@query()
def ml1_kmeans(spark, sf_dir):
    """12 clusters of the traces by MLlib's K-Means."""
    return features.kmeans(traces(spark, sf_dir), "trace", 12)[0].select("vec_id", "cluster")
