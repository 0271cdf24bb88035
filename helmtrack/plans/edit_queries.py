"""Queries over edits and keys: event types as generated, candidate and deleted rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from helmtrack.operators import edits, filters, match
from helmtrack.plans.frame_queries import FRAMES, frames
from helmtrack.plans.registry import query


@query(f"WITH {FRAMES} SELECT f.event_id AS event_id, f.user_id AS user_id FROM frames f WHERE event_type = 'click' AND NOT EXISTS (SELECT 1 FROM frames p WHERE p.event_type = 'purchase' AND p.user_id = f.user_id AND p.ts_us // 86400000000 = f.ts_us // 86400000000)")
def j10_staged_deletes(spark, sf_dir):
    rows = frames(spark, sf_dir).withColumn("day", F.floor(F.col("ts_us") / 86_400_000_000))
    left = edits.without_keys(rows.where("event_type = 'click'"), rows.where("event_type = 'purchase'"), ["user_id", "day"])
    return left.select("event_id", "user_id")


@query(f"""WITH {FRAMES}, d AS (SELECT DISTINCT user_id, ts_us // 86400000000 AS day, event_type FROM frames)
SELECT user_id, day, 'video' AS origin FROM d WHERE event_type = 'view' UNION ALL
SELECT user_id, day, 'generated' FROM d g WHERE event_type = 'click' AND NOT EXISTS (SELECT 1 FROM d v WHERE v.event_type = 'view' AND v.user_id = g.user_id AND v.day = g.day)""")
def u2_merged_index(spark, sf_dir):
    days = frames(spark, sf_dir).select("user_id", F.floor(F.col("ts_us") / 86_400_000_000).alias("day"), "event_type").distinct()
    return edits.merged_index(days.where("event_type = 'view'"), days.where("event_type = 'click'"), ["user_id", "day"])


@query("""SELECT user_id, count(*) AS n_tables FROM (SELECT DISTINCT user_id, event_type FROM events WHERE event_type IN ('click', 'purchase', 'view')) GROUP BY user_id""")
def u4_key_union(spark, sf_dir):
    rows = frames(spark, sf_dir)
    return edits.key_union(*[rows.where(F.col("event_type") == t) for t in ("click", "purchase", "view")], keys=["user_id"])


@query("SELECT event_id, user_id, value FROM events WHERE event_type = 'view' UNION ALL SELECT event_id, user_id, NULL FROM events WHERE event_type = 'click'")
def u3_appended(spark, sf_dir):
    rows = frames(spark, sf_dir)
    base = rows.where("event_type = 'view'").select("event_id", "user_id", "value")
    return edits.appended(base, rows.where("event_type = 'click'").select("event_id", "user_id", "props"))


@query("SELECT l_orderkey, max(l_linenumber) + 1 AS next_sample FROM lineitem GROUP BY l_orderkey")
def a11_next_sample_index(spark, sf_dir):
    return edits.next_sample_index(spark.read.parquet(f"{sf_dir}/lineitem.parquet"), ["l_orderkey"], "l_linenumber")


@query("""SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS edit_version, CASE WHEN o_orderstatus = 'F' THEN 'close' END AS edit_operation, CASE WHEN o_orderstatus = 'F' THEN true END AS edited_by_gui FROM orders""")
def f55_stamped(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey", "o_orderstatus")
    done = edits.stamped(rows, F.col("o_orderstatus") == "F", "close", F.lit("2024-01-01 00:00:00"))
    return done.select("o_orderkey", "edit_version", "edit_operation", "edited_by_gui")


@query("""SELECT p.p_partkey AS p_partkey, coalesce(c.v, p.p_retailprice) AS p_retailprice FROM part p LEFT JOIN (SELECT l_partkey, max(l_extendedprice) AS v FROM lineitem WHERE l_quantity >= 49 GROUP BY l_partkey) c ON p.p_partkey = c.l_partkey""")
def x36_row_update(spark, sf_dir):
    part = spark.read.parquet(f"{sf_dir}/part.parquet").select("p_partkey", "p_retailprice")
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet").where("l_quantity >= 49")
    changes = lines.groupBy(F.col("l_partkey").alias("p_partkey")).agg(F.max("l_extendedprice").alias("p_retailprice"))
    return edits.updated(part, changes, ["p_partkey"])


@query("""WITH b AS (SELECT l_suppkey, count(*) AS n FROM lineitem GROUP BY l_suppkey), a AS (SELECT l_suppkey, count(*) AS n FROM lineitem WHERE l_returnflag <> 'R' GROUP BY l_suppkey),
g AS (SELECT x.l_suppkey, count(*) AS n FROM lineitem x WHERE NOT EXISTS (SELECT 1 FROM lineitem y WHERE y.l_returnflag <> 'R' AND y.l_suppkey = x.l_suppkey AND y.l_orderkey = x.l_orderkey AND y.l_linenumber = x.l_linenumber) GROUP BY x.l_suppkey)
SELECT b.l_suppkey AS l_suppkey, 'delete' AS operation, b.n AS rows_before, coalesce(a.n, 0) AS rows_after, coalesce(g.n, 0) AS affected_rows FROM b LEFT JOIN a ON b.l_suppkey = a.l_suppkey LEFT JOIN g ON b.l_suppkey = g.l_suppkey""")
def k7_audit_rows(spark, sf_dir):
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select("l_suppkey", "l_orderkey", "l_linenumber", "l_returnflag")
    return edits.audit_rows(lines, lines.where("l_returnflag <> 'R'"), ["l_suppkey"], ["l_orderkey", "l_linenumber"], "delete")


@query("""SELECT event_type, replace(replace(lower(trim(coalesce(event_type, ''))), '-', '_'), ' ', '_') AS source, count(*) AS n FROM events GROUP BY event_type""")
def p2_normal_source(spark, sf_dir):
    rows = frames(spark, sf_dir).withColumn("source", filters.normal_source(F.col("event_type")))
    return rows.groupBy("event_type", "source").agg(F.count("*").alias("n"))


@query("""SELECT event_id, CAST(coalesce(TRY_CAST(json_extract_string(props, '$.k') AS BIGINT), -1) AS BIGINT) AS k FROM events""")
def p3_safe_int(spark, sf_dir):
    return frames(spark, sf_dir).select("event_id", filters.safe_int(F.get_json_object("props", "$.k"), -1).alias("k"))


@query("""WITH r AS (SELECT o_custkey, o_orderkey, o_totalprice, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rank FROM orders) SELECT o_custkey, o_orderkey, rank FROM r WHERE rank <= 3""")
def t5_members_top_n(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_custkey", "o_orderkey", "o_totalprice")
    return match.top_k(rows, ["o_custkey"], [F.col("o_totalprice").desc(), "o_orderkey"], 3).select("o_custkey", "o_orderkey", "rank")


@query("""SELECT d.source AS source, list_sort(list_distinct(list(d.lang))) AS scenes, count(*) AS n FROM documents d JOIN labels l ON d.doc_id = l.doc_id WHERE l.quality = 1 GROUP BY d.source""")
def j9_scene_labels(spark, sf_dir):
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    joined = docs.select("doc_id", "source", "lang").join(labels.where("quality = 1").select("doc_id"), "doc_id")
    return joined.groupBy("source").agg(F.array_sort(F.collect_set("lang")).alias("scenes"), F.count("*").alias("n"))
