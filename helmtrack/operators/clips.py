"""Windows met with their source clip: slices of its frames by position, what is derived from them, and reasoning texts by key.

A clip's frames become one row of arrays (a clip is a recording of bounded length); windows join it by data set and clip and take
their slice. A clip that very many windows share is split by Spark's skew joins, as its array is one row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

KEY = ["dataset", "clip", "t0_us", "sample_idx"]


def clip_arrays(frames: DataFrame, order: str, values: dict[str, Column]) -> DataFrame:
    """(dataset, clip, one array for each value): the frames of each clip in order; a value that is null is NaN."""
    kept = F.struct(F.col(order).alias("_at"), *[F.coalesce(v.cast("double"), F.lit(float("nan"))).alias(n) for n, v in values.items()])
    packed = frames.select("dataset", "clip", kept.alias("f")).groupBy("dataset", "clip").agg(F.array_sort(F.collect_list("f")).alias("f"))
    return packed.select("dataset", "clip", *[F.col(f"f.{n}").alias(n) for n in values])


def _finite(a: Column) -> Column:
    return F.forall(a, lambda v: ~F.isnan(v) & (F.abs(v) != float("inf")))


def sliced(rows: DataFrame, frames: DataFrame, order: str, values: dict[str, Column], steps: int) -> DataFrame:
    """``rows`` (dataset, clip, t0_index) with, for each value, its ``steps`` frames after t0_index as an array, all NaN where the clip ends before or one of
    them isn't finite, and ``<value>_t0``, that of t0_index, NaN where it isn't there. A window whose clip has no frames has NaN."""
    arrays = clip_arrays(frames, order, values).select("dataset", "clip", F.struct(*values).alias("_frames"))
    met = rows.join(arrays, ["dataset", "clip"], "left")
    start = F.greatest(F.col("t0_index") + 2, F.lit(1)).cast("int")
    out = []
    for name in values:
        whole = F.coalesce(F.col(f"_frames.{name}"), F.array().cast("array<double>"))
        part = F.slice(whole, start, steps)
        good = (F.col("t0_index") >= 0) & (F.size(part) == steps) & _finite(part)
        out.append(F.when(good, part).otherwise(F.array_repeat(F.lit(float("nan")), steps)).alias(name))
        now = F.when(F.col("t0_index") >= 0, F.get(whole, F.col("t0_index").cast("int")))
        out.append(F.when(F.abs(now) != float("inf"), now).otherwise(F.lit(float("nan"))).alias(f"{name}_t0"))
    return met.select(*rows.columns, *out)


def absolute_sum(trace: Column) -> Column:
    """The curvature score of a window: NaN where its trace is."""
    return F.aggregate(trace, F.lit(0.0), lambda s, v: s + F.abs(v))


def least(trace: Column) -> Column:
    """The least speed of a window; NaN where its trace is."""
    return F.when(F.exists(trace, F.isnan), F.lit(float("nan"))).otherwise(F.array_min(trace))


def window_scores(rows: DataFrame, frames: DataFrame, order: str, steps: int) -> DataFrame:
    """``rows`` with curvature_trace, curvature_sum, speed_trace, min_speed and t0_speed out of their clip's curvature, vx, vy and vz."""
    speed = F.sqrt(F.col("vx") * F.col("vx") + F.col("vy") * F.col("vy") + F.col("vz") * F.col("vz"))
    found = sliced(rows, frames, order, {"curvature_trace": F.col("curvature"), "speed_trace": speed}, steps)
    found = found.withColumns({"curvature_sum": absolute_sum(F.col("curvature_trace")), "min_speed": least(F.col("speed_trace"))})
    return found.withColumnRenamed("speed_trace_t0", "t0_speed").drop("curvature_trace_t0")


def with_reasoning(rows: DataFrame, texts: DataFrame, place: str, text: str = "cot") -> DataFrame:
    """``rows`` (dataset, clip, t0_us, sample_idx) with ``text``: that of their key, of several the last by ``place``, or ''. Keys that a text lacks
    are '' or 0, as in its file."""
    plain = [F.coalesce(c, F.lit("" if c in KEY[:2] else 0)).alias(c) for c in KEY]
    last = texts.select(*plain, place, text).groupBy(*KEY).agg(F.max_by(F.coalesce(text, F.lit("")), place).alias("_text"))
    met = rows.drop(text).join(last, KEY, "left")
    return met.select(*[c for c in rows.columns if c != text], F.coalesce("_text", F.lit("")).alias(text))


def borrowed_history(frames: DataFrame, order: str, value: str, steps: int, clips: int | None = None) -> DataFrame:
    """``frames`` (dataset, clip) with ``history``: this value and the ``steps`` - 1 before it, where its own clip begins out of the end of the clips
    before it by name, of as many of these as it takes or at most of ``clips`` (0: none); null if there are fewer. Times of clips aren't compared. Only the ends
    of clips go through a window over a data set; frames are ordered within their clip alone."""
    last = Window.partitionBy("dataset", "clip").orderBy(F.desc(order))
    ends = frames.select("dataset", "clip", order, value).withColumn("_back", F.row_number().over(last)).where(F.col("_back") < steps)
    tails = ends.groupBy("dataset", "clip").agg(F.transform(F.array_sort(F.collect_list(F.struct((-F.col("_back")).alias("at"), F.col(value).alias("v")))), lambda f: f["v"]).alias("_tail"))
    everyone = frames.select("dataset", "clip").distinct().join(tails, ["dataset", "clip"], "left")
    reach = steps - 1 if clips is None else min(clips, steps - 1)
    before = Window.partitionBy("dataset").orderBy("clip").rowsBetween(-reach, -1)
    lent = F.flatten(F.collect_list("_tail").over(before)) if reach > 0 else F.array().cast(frames.select(F.array(value)).dtypes[0][1])
    lent = everyone.select("dataset", "clip", lent.alias("_lent"))
    own = F.collect_list(F.struct(value)).over(Window.partitionBy("dataset", "clip").orderBy(order).rowsBetween(1 - steps, 0))
    met = frames.withColumn("_own", F.transform(own, lambda f: f[value])).join(lent, ["dataset", "clip"], "left")
    whole = F.concat("_lent", "_own")
    return met.withColumn("history", F.when(F.size(whole) >= steps, F.slice(whole, -steps, steps))).select(*frames.columns, "history")
