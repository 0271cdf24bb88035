"""As-of joins in time without range joins: both sides are united, ordered, and carried along by windows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def bracket(left: DataFrame, right: DataFrame, by: list[str], left_ts: str, right_ts: str, values: list[str]) -> DataFrame:
    """Each left row with ``before`` (the latest right row at or before it) and ``after`` (the earliest at or
    after it), structs of ``at`` and the values; null where there is none. One shuffle on ``by``."""
    kept = F.struct(*left.columns)
    shape = F.struct(F.col(right_ts).cast("long").alias("at"), *values)
    a = left.select(*by, F.col(left_ts).cast("long").alias("_t"), F.lit(1).alias("_side"), kept.alias("_left"))
    b = right.where(F.col(right_ts).isNotNull()).select(*by, F.col(right_ts).cast("long").alias("_t"), F.lit(0).alias("_side"), shape.alias("_right"))
    both = a.unionByName(b, allowMissingColumns=True)
    up = Window.partitionBy(*by).orderBy("_t", "_side").rowsBetween(Window.unboundedPreceding, 0)
    down = Window.partitionBy(*by).orderBy(F.col("_t").desc(), "_side").rowsBetween(Window.unboundedPreceding, 0)
    found = both.withColumns({"before": F.last("_right", ignorenulls=True).over(up), "after": F.last("_right", ignorenulls=True).over(down)})
    return found.where("_side = 1").select("_left.*", "before", "after")


def nearest(left: DataFrame, right: DataFrame, by: list[str], left_ts: str, right_ts: str, values: list[str], tolerance_us: int | None = None) -> DataFrame:
    """Each left row with ``match``, the nearest right row in time; of two equally near the earlier one. A
    match farther than the tolerance (inclusive) is null."""
    both = bracket(left, right, by, left_ts, right_ts, values)
    behind, ahead = F.col(left_ts) - F.col("before.at"), F.col("after.at") - F.col(left_ts)
    match = F.when(F.col("after").isNull() | (behind <= ahead), F.col("before")).otherwise(F.col("after"))
    joined = both.withColumn("match", match).drop("before", "after")
    if tolerance_us is None:
        return joined
    return joined.withColumn("match", F.when(F.abs(F.col("match.at") - F.col(left_ts)) <= tolerance_us, F.col("match")))


def covered(left: DataFrame, right: DataFrame, by: list[str], left_ts: str, right_ts: str, max_gap_us: int) -> DataFrame:
    """Adds ``covered``: hit exactly, or between two right rows at most max_gap apart. No extrapolation."""
    both = bracket(left, right, by, left_ts, right_ts, [])
    exact = F.col("before.at") == F.col(left_ts)
    between = (F.col("after.at") - F.col("before.at")) <= max_gap_us
    return both.withColumn("covered", F.coalesce(exact | between, exact, F.lit(False))).drop("before", "after")


def interpolated(left: DataFrame, right: DataFrame, by: list[str], left_ts: str, right_ts: str, value: str) -> DataFrame:
    """Adds ``value`` at the left time: linear between its neighbours, and outside them on the line through the two
    nearest rows. With one right row only, that row's value."""
    order = Window.partitionBy(*by).orderBy(right_ts)
    slope = lambda row: (F.col(value) - row(value).over(order)) / (F.col(right_ts) - row(right_ts).over(order))
    sloped = right.withColumns({"_ahead": slope(F.lead), "_behind": slope(F.lag)})
    both = bracket(left, sloped, by, left_ts, right_ts, [value, "_ahead", "_behind"])
    base = F.coalesce("before", "after")
    incline = F.when(F.col("before").isNull() | F.col("after").isNotNull(), base["_ahead"]).otherwise(base["_behind"])
    off = F.col(left_ts) - base["at"]
    return both.withColumn(value, base[value] + F.when(off != 0, F.coalesce(incline, F.lit(0.0)) * off).otherwise(0.0)).drop("before", "after")


def frames_near(left: DataFrame, right: DataFrame, by: list[str], left_ts: str, right_ts: str, tolerance_us: int) -> DataFrame:
    """All right rows of the one frame that is nearest to each left row, at most the tolerance away (inclusive): an
    as-of lookup among distinct frames, then an equi-join. Left rows without such a frame are left out."""
    frames = right.select(*by, right_ts).distinct()
    at = nearest(left, frames, by, left_ts, right_ts, [], tolerance_us).where("match IS NOT NULL").withColumn("_at", F.col("match.at")).drop("match")
    return at.join(right.withColumnRenamed(right_ts, "_at"), [*by, "_at"]).withColumnRenamed("_at", right_ts)


def native_frame(left: DataFrame, right: DataFrame, by: list[str], left_ts: str, right_ts: str, index: str, stored: str, tolerance_us: int) -> DataFrame:
    """Adds ``frame``: the index of the frame at the left time, else of the nearest within the tolerance, else the
    stored index."""
    found = nearest(left, right, by, left_ts, right_ts, [index], tolerance_us)
    return found.withColumn("frame", F.coalesce(F.col(f"match.{index}"), F.col(stored))).drop("match")
