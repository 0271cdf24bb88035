"""Column functions over one trace (an array of doubles)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def shifted(a: Column, first: Column) -> Column:
    """The trace one step later, with ``first`` in front."""
    return F.concat(F.array(first), F.slice(a, 1, F.greatest(F.size(a) - 1, F.lit(0))))


def differences(a: Column, from_origin: bool = True) -> Column:
    """Steps of a trace. A future trace starts from 0; otherwise the first step is 0."""
    before = shifted(a, F.lit(0.0) if from_origin else F.element_at(a, 1))
    return F.zip_with(a, before, lambda x, p: x - p)


def finite(x: Column) -> Column:
    """Neither null, NaN nor infinite. Spark orders NaN above all numbers, so comparisons need this guard."""
    return F.coalesce(~F.isnan(x) & (F.abs(x) != float("inf")), F.lit(False))


def smooth5(a: Column, passes: int = 1) -> Column:
    """Weights 1 2 3 2 1 over 9 with repeated edges; non-finite values count as 0. Traces of fewer than five
    values stay."""
    at = lambda t, i: F.get(t, F.greatest(F.least(i, F.size(t) - 1), F.lit(0)))
    weighted = lambda t: F.transform(t, lambda x, i: (at(t, i - 2) + at(t, i + 2) + 2.0 * (at(t, i - 1) + at(t, i + 1)) + 3.0 * x) / 9.0)
    out = F.transform(a, lambda x: F.when(finite(x), x).otherwise(0.0))
    for _ in range(passes):
        out = F.get(F.transform(F.array(out), weighted), F.lit(0))  # bound once, not computed anew for each element
    return F.when(F.size(a) < 5, a).otherwise(out)


def smooth3(a: Column, side: float = 0.25, least: int = 5) -> Column:
    """Weights side, 1 - 2 side, side inside; the ends stay. Short traces stay."""
    inside = lambda x, i: F.when((i == 0) | (i == F.size(a) - 1), x).otherwise(side * (F.get(a, i - 1) + F.get(a, i + 1)) + (1 - 2 * side) * x)
    return F.when(F.size(a) < least, a).otherwise(F.transform(a, inside))


def max_run(a: Column, test) -> Column:
    """The longest run of values that pass the test; NaN passes none."""
    start = F.struct(F.lit(0).alias("run"), F.lit(0).alias("best"))

    def step(s, x):
        run = F.when(test(x) & ~F.isnan(x), s["run"] + 1).otherwise(0)
        return F.struct(run.alias("run"), F.greatest(s["best"], run).alias("best"))

    return F.aggregate(a, start, step, lambda s: s["best"])


def sign_runs(a: Column, threshold: float, min_run: int) -> Column:
    """The sequence of signs of runs of at least ``min_run`` values beyond the threshold; a sign that follows
    itself is told once."""
    kind = "array<int>"
    start = F.struct(F.array().cast(kind).alias("seq"), F.lit(0).alias("sign"), F.lit(0).alias("run"))

    def closed(s):
        fresh = (s["sign"] != 0) & (s["run"] >= min_run) & (F.coalesce(F.try_element_at(s["seq"], F.lit(-1)), F.lit(0)) != s["sign"])
        return F.when(fresh, F.concat(s["seq"], F.array(s["sign"]))).otherwise(s["seq"])

    def step(s, x):
        sign = F.when(F.isnan(x), 0).when(x >= threshold, 1).when(x <= -threshold, -1).otherwise(0)
        same = sign == s["sign"]
        return F.struct(
            F.when(same, s["seq"]).otherwise(closed(s)).alias("seq"),
            sign.alias("sign"),
            F.when(sign == 0, 0).when(same, s["run"] + 1).otherwise(1).alias("run"),
        )

    return F.aggregate(a, start, step, closed)


def low_runs(a: Column, threshold: float, min_frames: int) -> Column:
    """Runs of at least ``min_frames`` values strictly below the threshold, as (first, last) positions; a
    value that isn't finite ends a run."""
    kind = "array<struct<first:int,last:int>>"
    start = F.struct(F.array().cast(kind).alias("found"), F.lit(-1).alias("since"), F.lit(0).alias("at"))

    def closed(s):
        long = (s["since"] >= 0) & (s["at"] - s["since"] >= min_frames)
        run = F.array(F.struct(s["since"].alias("first"), (s["at"] - 1).alias("last"))).cast(kind)
        return F.when(long, F.concat(s["found"], run)).otherwise(s["found"])

    def step(s, x):
        low = (x < threshold) & ~F.isnan(x) & (F.abs(x) != float("inf"))
        return F.struct(
            F.when(low, s["found"]).otherwise(closed(s)).alias("found"),
            F.when(~low, -1).when(s["since"] < 0, s["at"]).otherwise(s["since"]).alias("since"),
            (s["at"] + 1).alias("at"),
        )

    return F.aggregate(a, start, step, closed)


def has_s_curve(a: Column, threshold: float, min_run: int) -> Column:
    """Both signs have a long enough run beyond the threshold, and significant neighbours change sign. False for
    a trace with a value that isn't finite."""
    if threshold <= 0:
        return F.lit(False)
    strong = F.filter(a, lambda x: F.abs(x) >= threshold)
    flips = F.exists(F.zip_with(strong, shifted(strong, F.element_at(strong, 1)), lambda x, p: x * p), lambda p: p < 0)
    return F.forall(a, finite) & (F.size(strong) > 1) & (max_run(a, lambda x: x >= threshold) >= min_run) & (max_run(a, lambda x: x <= -threshold) >= min_run) & flips


def continuously_low(a: Column, threshold: float, frames: int) -> Column:
    """So many values in a row at or below the threshold."""
    return max_run(a, lambda x: x <= threshold) >= frames


def frame_times(t0: Column, steps: int, step_us: int = 100_000) -> Column:
    """The times of the future frames 1 to ``steps``."""
    return F.transform(F.sequence(F.lit(1), F.lit(steps)), lambda i: t0 + i * step_us)
