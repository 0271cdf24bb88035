"""Edits of trajectory tables as set operations; each gives a new table, nothing is changed in place."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def without_keys(rows: DataFrame, deleted: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key isn't staged for deletion."""
    return rows.join(deleted.select(*keys).distinct(), keys, "left_anti")


def merged_index(video: DataFrame, generated: DataFrame, keys: list[str]) -> DataFrame:
    """Video samples, and generated ones that the video doesn't have."""
    extra = generated.select(*keys).distinct().join(video.select(*keys), keys, "left_anti")
    return video.select(*keys).withColumn("origin", F.lit("video")).unionByName(extra.withColumn("origin", F.lit("generated")))


def key_union(*tables: DataFrame, keys: list[str]) -> DataFrame:
    """The distinct keys of all tables, and how many tables hold each."""
    out = tables[0].select(*keys).distinct()
    for table in tables[1:]:
        out = out.unionByName(table.select(*keys).distinct())
    return out.groupBy(*keys).agg(F.count("*").alias("n_tables"))


def appended(rows: DataFrame, extra: DataFrame) -> DataFrame:
    """``extra`` below ``rows``: missing columns null, unknown ones dropped."""
    known = [c for c in extra.columns if c in rows.columns]
    return rows.unionByName(extra.select(*known), allowMissingColumns=True)


def next_sample_index(rows: DataFrame, by: list[str], sample: str = "sample_idx") -> DataFrame:
    """Per group: one more than the largest sample index, or the number of rows where none has one."""
    return rows.groupBy(*by).agg(F.coalesce(F.max(sample) + 1, F.count("*")).alias("next_sample"))


def stamped(rows: DataFrame, affected: Column, operation: str, at: Column) -> DataFrame:
    """Edit metadata: the version of affected rows grows by one, and they tell operation and time."""
    hit = F.coalesce(affected, F.lit(False))
    version = F.coalesce(F.col("edit_version"), F.lit(0)) if "edit_version" in rows.columns else F.lit(0)
    old = lambda c, kind: F.col(c) if c in rows.columns else F.lit(None).cast(kind)
    return rows.withColumns({
        "edit_version": (version + hit.cast("int")).cast("int"),
        "edited_by_gui": F.when(hit, True).otherwise(old("edited_by_gui", "boolean")),
        "edit_operation": F.when(hit, operation).otherwise(old("edit_operation", "string")),
        "edit_time": F.when(hit, at).otherwise(old("edit_time", "string")),
    })


def updated(rows: DataFrame, changes: DataFrame, keys: list[str]) -> DataFrame:
    """Rows with the columns of ``changes`` where the key matches; nulls in ``changes`` change nothing."""
    names = [c for c in changes.columns if c not in keys]
    renamed = changes.select(*keys, *[F.col(c).alias(f"_new_{c}") for c in names])
    joined = rows.join(renamed, keys, "left")
    return joined.select(*[F.coalesce(f"_new_{c}", c).alias(c) if c in names else c for c in rows.columns])


def latest_backup(log: DataFrame, target: str, order: str, present: DataFrame) -> DataFrame:
    """Of each target: its last log row whose backup is still there."""
    there = log.join(present, "backup_file", "left_semi")
    last = Window.partitionBy(target).orderBy(F.col(order).desc())
    return there.withColumn("_rank", F.row_number().over(last)).where("_rank = 1").drop("_rank")


def audit_rows(before: DataFrame, after: DataFrame, by: list[str], keys: list[str], operation: str) -> DataFrame:
    """One log row per file: rows before and after, and rows that went or came."""
    old, new = before.groupBy(*by).agg(F.count("*").alias("rows_before")), after.groupBy(*by).agg(F.count("*").alias("rows_after"))
    gone = before.join(after, [*by, *keys], "left_anti").groupBy(*by).agg(F.count("*").alias("gone"))
    come = after.join(before, [*by, *keys], "left_anti").groupBy(*by).agg(F.count("*").alias("come"))
    joined = old.join(new, by, "full").join(gone, by, "left").join(come, by, "left")
    zero = lambda c: F.coalesce(c, F.lit(0))
    return joined.select(*by, F.lit(operation).alias("operation"), zero("rows_before").alias("rows_before"), zero("rows_after").alias("rows_after"), (zero("gone") + zero("come")).alias("affected_rows"))
