"""Exact quantiles of groups without a group in a task: ranges of values are cut into bins again and again around each wanted place.

A pass counts values by bins of the range in which a wanted order statistic lies, with Spark's partial counts before the shuffle, so at most BINS rows
of a wanted place are sent by a task; the bin that holds it, from its least to its greatest value, is the next range. Passes end when the bin's
least and greatest value are equal; their number is the logarithm, to the base BINS, of a range over the gaps around the wanted value. Groups and places are few (positions of a trace); their ranges travel with the tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from helmtrack.sources.shared import kept

#: Bins of a range; groups times places up to which ranges are broadcast.
BINS, FEW = 4096, 100_000


def exact_quantiles(values: DataFrame, by: list[str], shares: list[float]) -> DataFrame:
    """(by..., share, value) of rows (by..., value): the value at each share of a group's sorted values, between two neighbours by their distance. Nulls
    and NaN don't count; groups without values are left out."""
    values = values.where(F.col("value").isNotNull() & ~F.isnan("value")).select(*by, "value")
    sizes = kept(values.groupBy(*by).agg(F.count("*").alias("n"), F.min("value").alias("low"), F.max("value").alias("high")), "quantile-sizes")
    wanted = sizes.select("*", F.explode(F.array(*map(F.lit, shares))).alias("share")).withColumn("place", F.col("share") * (F.col("n") - 1))
    ends = F.array(F.floor("place"), F.least(F.floor("place") + 1, F.col("n") - 1))
    targets = wanted.select(*by, "low", "high", F.explode(ends).alias("rank")).distinct().withColumn("before", F.lit(0).cast("long"))
    small = sizes.count() * len(shares) <= FEW
    found = []
    while True:
        targets = kept(targets, "quantile-ranges")
        done = targets.where("low = high").select(*by, "rank", F.col("low").alias("value"))
        found.append(done)
        left = targets.where("low < high")
        if left.isEmpty():
            break
        targets = _narrowed(values, left, by, small)
    known = found[0]
    for more in found[1:]:
        known = known.unionByName(more)
    low, high = (known.select(*by, F.col("rank").alias(r), F.col("value").alias(v)) for r, v in (("_r0", "_v0"), ("_r1", "_v1")))
    asked = wanted.withColumns({"_r0": F.floor("place"), "_r1": F.least(F.floor("place") + 1, F.col("n") - 1)})
    value: Column = F.col("_v0") + (F.col("_v1") - F.col("_v0")) * (F.col("place") - F.col("_r0"))
    return asked.join(low, [*by, "_r0"]).join(high, [*by, "_r1"]).select(*by, "share", value.alias("value"))


def _narrowed(values: DataFrame, targets: DataFrame, by: list[str], small: bool) -> DataFrame:
    """For each target (by..., low, high, rank, before) the range of the bin in which it lies; ``before`` counts the values below it."""
    ranges = targets.select(*by, "low", "high", "before").distinct()
    ranges = F.broadcast(ranges) if small else ranges
    met = values.join(ranges, by) if by else values.crossJoin(F.broadcast(ranges))  # one group: a few rows
    inside = met.where((F.col("value") >= F.col("low")) & (F.col("value") <= F.col("high")))
    part = (F.col("value") / 2 - F.col("low") / 2) / (F.col("high") / 2 - F.col("low") / 2)  # halves: the width itself may be too large
    bins = inside.withColumn("bin", F.least(F.floor(part * BINS), F.lit(BINS - 1)))
    key = [*by, "low", "high", "before"]
    counts = bins.groupBy(*key, "bin").agg(F.count("*").alias("c"), F.min("value").alias("least"), F.max("value").alias("most"))
    running = Window.partitionBy(*key).orderBy("bin")
    placed = counts.withColumn("upto", F.col("before") + F.sum("c").over(running)).withColumn("start", F.col("upto") - F.col("c"))
    hit = targets.join(placed, key).where((F.col("rank") >= F.col("start")) & (F.col("rank") < F.col("upto")))
    return hit.select(*by, F.col("least").alias("low"), F.col("most").alias("high"), "rank", F.col("start").alias("before"))
