"""Time indexing of frames: continuity segments, coverage of a horizon, windows and candidate indexes.

Times are microseconds as long. Defaults are those of 0.1 s telemetry; every limit is a parameter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MAX_GAP_US, MAX_SPEED_MPS, STEP_US, HORIZON, HISTORY = 300_000, 80.0, 100_000, 64, 16


def dedup_timestamps(frames: DataFrame, by: list[str], ts: str = "ts_us", order: str = "clip") -> DataFrame:
    """One frame of each timestamp: the first in clip order."""
    rank = Window.partitionBy(*by, ts).orderBy(order)
    return frames.withColumn("_rank", F.row_number().over(rank)).where("_rank = 1").drop("_rank")


def continuity_segments(frames: DataFrame, by: list[str], ts: str = "ts_us", position: tuple[str, ...] = ("x",), max_gap_us: int = MAX_GAP_US, max_speed: float = MAX_SPEED_MPS) -> DataFrame:
    """Adds ``segment``: a frame goes on with its predecessor's if 0 < dt <= max_gap and the step is at most
    max_speed * dt, both inclusive; else it starts the next one."""
    order = Window.partitionBy(*by).orderBy(ts)
    dt = F.col(ts) - F.lag(ts).over(order)
    step = F.sqrt(sum(F.pow(F.col(p) - F.lag(p).over(order), 2) for p in position))
    goes_on = (dt > 0) & (dt <= max_gap_us) & (step <= max_speed * dt / 1e6)
    marked = frames.withColumn("_break", F.when(F.lag(ts).over(order).isNull() | goes_on, 0).otherwise(1))
    running = F.sum("_break").over(order.rowsBetween(Window.unboundedPreceding, 0))
    return marked.withColumn("segment", running).drop("_break")


def segment_bounds(segments: DataFrame, by: list[str], ts: str = "ts_us") -> DataFrame:
    """Start, end and number of frames of each segment."""
    return segments.groupBy(*by, "segment").agg(F.min(ts).alias("start_us"), F.max(ts).alias("end_us"), F.count("*").alias("n_frames"))


def full_future(samples: DataFrame, bounds: DataFrame, by: list[str], t0: str = "t0_us", horizon: int = HORIZON, step_us: int = STEP_US) -> DataFrame:
    """Samples whose times t0, t0 + step, ..., t0 + horizon * step are all covered by frames of the sample's
    segment. With a step no longer than the largest gap that is so just if the segment spans them, so no
    grid is exploded. ``samples`` carry ``segment`` (that of their nearest frame)."""
    joined = samples.join(bounds, [*by, "segment"])
    return joined.where((F.col(t0) >= F.col("start_us")) & (F.col(t0) + horizon * step_us <= F.col("end_us"))).select(*samples.columns)


def frame_index(frames: DataFrame, by: list[str], ts: str = "ts_us") -> DataFrame:
    """Adds ``frame_index``, from 0, and ``n_frames`` of the clip."""
    clip = Window.partitionBy(*by)
    return frames.withColumns({"frame_index": F.row_number().over(clip.orderBy(ts)) - 1, "n_frames": F.count("*").over(clip)})


def stride_index(indexed: DataFrame, start: int = 0, stop: int | None = None, stride: int = 1, history: int = 0, future: int = 0) -> DataFrame:
    """Frames from start to stop (inclusive) by stride that have so many frames before and after them."""
    last = F.col("n_frames") - 1 - future
    last = F.least(last, F.lit(stop)) if stop is not None else last
    first = max(start, history)
    return indexed.where((F.col("frame_index") >= first) & (F.col("frame_index") <= last) & (F.pmod(F.col("frame_index") - start, F.lit(stride)) == 0))


def speed_candidates(indexed: DataFrame, speed: Column, min_speed: float, history: int = HISTORY, horizon: int = HORIZON, stride: int = 30) -> DataFrame:
    """Frames from ``history`` on by stride, at least ``horizon`` + 1 before the end, that are fast enough;
    none where that range is a single frame or empty."""
    last = F.col("n_frames") - horizon - 1
    at = F.col("frame_index")
    return indexed.where((last > history) & (at >= history) & (at < last) & (F.pmod(at - history, F.lit(stride)) == 0) & (F.abs(speed) >= min_speed))


def future_window(frames: DataFrame, by: list[str], value: str, steps: int, ts: str = "ts_us") -> DataFrame:
    """Adds ``future``, the next ``steps`` values; null if there are fewer."""
    ahead = Window.partitionBy(*by).orderBy(ts).rowsBetween(1, steps)
    found = F.collect_list(value).over(ahead)
    return frames.withColumn("future", F.when(F.size(found) == steps, found))


def history_window(frames: DataFrame, by: list[str], value: str, steps: int, ts: str = "ts_us") -> DataFrame:
    """Adds ``history``, this value and the ``steps`` - 1 before it; null if there are fewer. With the
    dataset alone in ``by`` it borrows from the clips before."""
    behind = Window.partitionBy(*by).orderBy(ts).rowsBetween(1 - steps, 0)
    found = F.collect_list(value).over(behind)
    return frames.withColumn("history", F.when(F.size(found) == steps, found))


def coverage_counts(candidates: DataFrame, generated: DataFrame, by: list[str]) -> DataFrame:
    """Per clip: total candidates, generated ones and max(0, total - generated)."""
    total = candidates.groupBy(*by).agg(F.count("*").alias("total"))
    made = generated.groupBy(*by).agg(F.count("*").alias("generated"))
    joined = total.join(made, by, "full").select(*by, F.coalesce("total", F.lit(0)).alias("total"), F.coalesce("generated", F.lit(0)).alias("generated"))
    return joined.withColumn("missing", F.greatest(F.col("total") - F.col("generated"), F.lit(0).cast("long")))
