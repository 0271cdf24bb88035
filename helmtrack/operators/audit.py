"""Audited writes of small tables: a backup of what was there, a new version beside it, and a log row.

A table is a folder of versions; the newest complete one (Spark writes _SUCCESS last) is what a reader gets, so a write
that fails half-way changes nothing. The log is Parquet, one appended row for each write or restore.
"""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LOG_SCHEMA = "edit_time string, operation string, target string, version string, backup string, rows_before long, rows_after long, affected_rows long, metadata map<string,string>"


def slug(text: str, longest: int = 80) -> str:
    """Letters, digits, dot, dash and underscore stay; runs of others become one underscore."""
    return re.sub(r"[^A-Za-z0-9._-]+", "_", text.strip()).strip("_")[:longest] or "edit"


def _stamp() -> str:
    return dt.datetime.now(dt.timezone.utc).strftime("%Y%m%dT%H%M%S%fZ")


def log(spark: SparkSession, root: str) -> DataFrame:
    """All log rows; none where nothing was written yet."""
    try:
        return spark.read.schema(LOG_SCHEMA).parquet(f"{root}/_log").select("*")
    except Exception as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        return spark.createDataFrame([], LOG_SCHEMA)


def tail(entries: DataFrame, n: int) -> DataFrame:
    """The last n log rows, latest first."""
    return entries.orderBy(F.desc("edit_time")).limit(n)


def current(spark: SparkSession, root: str, target: str) -> DataFrame | None:
    """The newest version of a target; None before its first write."""
    last = log(spark, root).where(F.col("target") == target).orderBy(F.desc("edit_time")).select("version").first()
    return spark.read.parquet(f"{root}/{target}/{last.version}") if last else None


def write(rows: DataFrame, root: str, target: str, operation: str, affected: int, metadata: dict[str, str] | None = None, order: tuple[str, ...] = ()) -> str:
    """Writes a new version of a target and logs it. Its name is returned; the version before is its backup."""
    spark = rows.sparkSession
    was = log(spark, root).where(F.col("target") == target).orderBy(F.desc("edit_time")).first()
    version = f"{_stamp()}-{slug(operation)}"
    path = f"{root}/{target}/{version}"
    (rows.orderBy(*order) if order else rows).write.parquet(path)
    after = spark.read.parquet(path).count()
    entry = (_stamp(), operation, target, version, was.version if was else None, was.rows_after if was else 0, after, affected, {k: str(v) for k, v in (metadata or {}).items()})
    spark.createDataFrame([entry], LOG_SCHEMA).coalesce(1).write.mode("append").parquet(f"{root}/_log")
    return version


def latest_backup(spark: SparkSession, root: str, target: str) -> str | None:
    """The version before the newest one of a target."""
    last = log(spark, root).where(F.col("target") == target).orderBy(F.desc("edit_time")).select("backup").first()
    return last.backup if last else None


def restore(spark: SparkSession, root: str, target: str) -> str:
    """Writes the latest backup as a new version. A target without one is an error."""
    backup = latest_backup(spark, root, target)
    if backup is None:
        raise ValueError(f"no backup of {target!r}")
    return write(spark.read.parquet(f"{root}/{target}/{backup}"), root, target, "restore", 0, {"restored_from_backup": backup})


def save_deletes(spark: SparkSession, root: str, target: str, staged: DataFrame, t0_us: int, keys: tuple[str, str] = ("t0_us", "sample_idx")) -> int:
    """Drops the staged rows of one t0 from a target and writes it; how many went is returned."""
    rows = current(spark, root, target)
    here = staged.where(F.col(keys[0]) == t0_us).select(*keys).distinct()
    left = rows.join(here, list(keys), "left_anti")
    gone = rows.count() - left.count()
    if gone:
        write(left, root, target, "delete", gone, {"t0_us": str(t0_us)}, keys)
    return gone
