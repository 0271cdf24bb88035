"""Aggregates over traces (arrays of one length) and their groups, by position."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from helmtrack.operators.quantiles import exact_quantiles


def by_position(rows: DataFrame, by: list[str], trace: str) -> DataFrame:
    """One row per position of a trace."""
    return rows.select(*by, F.posexplode(trace).alias("pos", "value"))


def mean_trace(rows: DataFrame, by: list[str], trace: str) -> DataFrame:
    """Per group: the element-wise mean trace (``mean``) and the number of rows (``n_rows``)."""
    means = by_position(rows, by, trace).groupBy(*by, "pos").agg(F.avg("value").alias("value"), F.count("*").alias("n"))
    ordered = F.array_sort(F.collect_list(F.struct("pos", "value")))
    return means.groupBy(*by).agg(F.transform(ordered, lambda p: p["value"]).alias("mean"), F.max("n").alias("n_rows"))


def trace_stats(rows: DataFrame, trace: str, percentile: float = 0.99) -> DataFrame:
    """Per position: the clip value (percentile of absolute values), and mean and deviation of the clipped
    values; deviations under 1e-6 count as 1."""
    flat = by_position(rows, [], trace)
    clip = exact_quantiles(flat.select("pos", F.abs("value").alias("value")), ["pos"], [percentile]).select("pos", F.col("value").alias("clip"))
    limited = flat.join(F.broadcast(clip), "pos").withColumn("value", F.greatest(F.least("value", "clip"), -F.col("clip")))  # a row per position
    stats = limited.groupBy("pos", "clip").agg(F.avg("value").alias("mean"), F.stddev_pop("value").alias("std"))
    return stats.withColumn("std", F.when(F.col("std") < 1e-6, 1.0).otherwise(F.col("std")))


def standardised(rows: DataFrame, key: str, trace: str, stats: DataFrame) -> DataFrame:
    """Traces less the mean and over the deviation of each position, without clipping: (key, z)."""
    packed = stats.agg(F.array_sort(F.collect_list(F.struct("pos", "mean", "std"))).alias("stats"))  # one row, as long as a trace
    joined = rows.crossJoin(F.broadcast(packed))
    return joined.select(key, F.zip_with(trace, "stats", lambda v, s: (v - s["mean"]) / s["std"]).alias("z"))


def spread(rows: DataFrame, trace: str) -> DataFrame:
    """Median and interquartile range over all positions and rows."""
    found = exact_quantiles(by_position(rows, [], trace).select("value"), [], [0.25, 0.5, 0.75])
    at = lambda share: F.max(F.when(F.col("share") == share, F.col("value")))
    return found.agg(at(0.5).alias("median"), (at(0.75) - at(0.25)).alias("iqr"))


def cluster_sizes(assigned: DataFrame, k: int, cluster: str = "cluster") -> DataFrame:
    """Sizes of clusters 0 to k - 1, empty ones too."""
    every = assigned.sparkSession.range(k).select(F.col("id").cast("int").alias(cluster))
    counted = assigned.groupBy(cluster).agg(F.count("*").alias("size"))
    return every.join(counted, cluster, "left").select(cluster, F.coalesce("size", F.lit(0)).alias("size"))


def reason_counts(rows: DataFrame, reason: str = "reject_reason") -> DataFrame:
    return rows.groupBy(F.coalesce(F.col(reason), F.lit("kept")).alias("reason")).agg(F.count("*").alias("n"))


def local_mean(frames: DataFrame, by: list[str], ts: str, value: str, reach: int = 3) -> DataFrame:
    """Adds ``local_mean`` over the frames at most ``reach`` before or after; NaN values are passed over."""
    near = Window.partitionBy(*by).orderBy(ts).rowsBetween(-reach, reach)
    return frames.withColumn("local_mean", F.avg(F.when(~F.isnan(value), F.col(value))).over(near))
