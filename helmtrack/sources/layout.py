"""The data set's folder layout: ``<root>/<dataset>/data-<kind>/<clip>.<kind>.parquet``, read as one scan by Spark.

Data set and clip come from each row's file path, so that filters on them and on columns reach the scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Fixed value: columns of an object table and their types.
OBJECT_FIELDS = (
    "timestamp long, frame_index long, source string, object_id long, object_type long, confidence double, x double, y double, z double, x_kf double, y_kf double, z_kf double, "
    "heading double, origin_heading double, length double, width double, height double, vx_rel double, vy_rel double, vz_rel double, vx_abs double, vy_abs double, vz_abs double, "
    "life_time double, lost_time double, object_timestamp long"
)


def _named(rows: DataFrame, path, kind: str) -> DataFrame:
    dataset = F.regexp_extract(path, r"([^/]+)/data-[^/]+/[^/]+$", 1)
    clip = F.regexp_extract(path, rf"([^/]+)\.{kind}\.[^/.]+$", 1)
    return rows.withColumns({"dataset": dataset, "clip": clip})


def _pattern(root: str, kind: str, datasets: list[str] | None, suffix: str = "parquet") -> list[str]:
    """Globs of the files; naming data sets prunes the listing itself."""
    return [f"{root}/{d}/data-{kind}/*.{kind}.{suffix}" for d in (datasets or ["*"])]


def clip_files(spark: SparkSession, root: str, kind: str, suffix: str = "parquet") -> DataFrame:
    """dataset, clip and path of the files of a kind, from the listing alone; no file is read."""
    found = spark.read.format("binaryFile").load(_pattern(root, kind, None, suffix)).select("path")
    return _named(found, F.col("path"), kind)


def datasets(files: DataFrame) -> DataFrame:
    return files.select("dataset").distinct().orderBy("dataset")


def clips(files: DataFrame) -> DataFrame:
    """Distinct clips without their camera's suffix, in order."""
    stem = F.regexp_replace("clip", r"_fovs_.*$", "").alias("clip")
    return files.select("dataset", stem).distinct().orderBy("dataset", "clip")


def master_clips(files: DataFrame) -> DataFrame:
    """Clips of the files that belong to no single camera."""
    return clips(files.where(~F.contains("clip", F.lit("_fovs_"))))


def scan(spark: SparkSession, root: str, kind: str, columns: list[str] | None = None, only: list[str] | None = None) -> DataFrame:
    """All rows of a kind with dataset and clip; ``columns`` reach the files' scan."""
    rows = spark.read.option("mergeSchema", "true").parquet(*_pattern(root, kind, only))
    kept = rows.select(*(columns or rows.columns), F.col("_metadata.file_path").alias("_path"))
    return _named(kept, F.col("_path"), kind).drop("_path")


def egomotion(spark: SparkSession, root: str, only: list[str] | None = None) -> DataFrame:
    """One row per dataset and timestamp: of rows of several clips with one timestamp the first clip's."""
    first = Window.partitionBy("dataset", "timestamp").orderBy("clip")
    return scan(spark, root, "egomotion", only=only).withColumn("_n", F.row_number().over(first)).where("_n = 1").drop("_n")


def objects(spark: SparkSession, root: str) -> DataFrame:
    """Objects with all columns of OBJECT_FIELDS; missing ones are null."""
    rows = scan(spark, root, "objects")
    fields = [f.split() for f in OBJECT_FIELDS.split(", ")]
    return rows.select("dataset", "clip", *[(F.col(n) if n in rows.columns else F.lit(None)).cast(t).alias(n) for n, t in fields])


def trajectories(rows: DataFrame) -> DataFrame:
    """Nested rows with as many x as y, four points at least, all finite."""
    whole = lambda c: F.forall(c, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return rows.where((F.size("x") == F.size("y")) & (F.size("x") >= 4) & whole("x") & whole("y"))


def clip_order(frames: DataFrame) -> DataFrame:
    """(dataset, clip, first_us) ordered by each clip's first frame in file order; clips without one come last. ``frames`` are rows of ``scan``, whose
    files tell the place of each row, however they are split."""
    first = frames.withColumn("_at", F.col("_metadata.row_index")).groupBy("dataset", "clip").agg(F.min_by("timestamp", "_at").alias("first_us"))
    return first.orderBy("dataset", F.asc_nulls_last("first_us"), "clip")


def segment_at(samples: DataFrame, frames: DataFrame, t0: str = "t0_us") -> DataFrame:
    """All frames of the segment that holds each sample's time: that of the nearest frame of the sample's clip. For a
    clip without frames, all frames of its data set."""
    from helmtrack.operators.asof import nearest

    found = nearest(samples, frames, ["dataset", "clip"], t0, "timestamp", ["segment"]).withColumn("_segment", F.col("match.segment")).drop("match")
    here = frames.select("dataset", F.struct(*[c for c in frames.columns if c != "dataset"]).alias("frame"), F.col("segment").alias("_segment"))
    known = found.where("_segment IS NOT NULL").join(here, ["dataset", "_segment"]).drop("_segment")
    unknown = found.where("_segment IS NULL").drop("_segment").join(here.drop("_segment"), "dataset")
    return known.unionByName(unknown)
