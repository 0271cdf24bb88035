"""Row predicates and normalisation of keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Names under which a row's source may be written.
SOURCE_ALIASES = {
    "ground_truth": "gt",
    "groundtruth": "gt",
    "manual": "manual_bezier",
    "bezier": "manual_bezier",
}


def normal_source(source: Column) -> Column:
    """Trimmed, lower case, with ``_`` for ``-`` and space, aliases resolved; null is the empty string."""
    plain = F.translate(F.lower(F.trim(F.coalesce(source, F.lit("")))), "- ", "__")
    out = plain
    for alias, name in SOURCE_ALIASES.items():
        out = F.when(plain == alias, name).otherwise(out)
    return out


def is_protected(source: Column) -> Column:
    """Only rows marked as ground truth are protected from edits."""
    return normal_source(source) == "gt"


def pseudo_truth(rows: DataFrame, source: str = "source") -> DataFrame:
    """Rows that aren't ground truth; all of them where there is no such column."""
    return rows.where(~is_protected(F.col(source))) if source in rows.columns else rows


def safe_int(value: Column, default: int = 0, least: int | None = None) -> Column:
    """A whole number, or the default where the value is null, NaN or no number."""
    number = value.try_cast("double")
    exact = value.cast("string").try_cast("decimal(38,6)").try_cast("long")  # a double would round beyond 2^53
    out = F.coalesce(exact, F.when(~F.isnan(number), number).try_cast("long"), F.lit(default).cast("long"))
    return F.greatest(out, F.lit(least).cast("long")) if least is not None else out


def row_keys(rows: DataFrame, by: list[str], t0: str, sample: str, order: str) -> DataFrame:
    """Adds ``sample_key``: the sample index, or for want of it the row's position in its group."""
    position = F.row_number().over(Window.partitionBy(*by).orderBy(order)) - 1
    return rows.withColumn("sample_key", F.coalesce(F.col(sample), position))


def dataset_filter(rows: DataFrame, wanted: str | None, column: str = "dataset") -> DataFrame:
    """Rows of one dataset; of all for '' or 'all'. It is an error if none match."""
    if not wanted or wanted.lower() == "all":
        return rows
    found = rows.where(F.col(column) == wanted)
    if found.isEmpty():
        raise ValueError(f"no rows of dataset {wanted!r}")
    return found


def reject_reason(rules: list[tuple[str, Column]]) -> Column:
    """The first rule that holds, in order; null for rows that pass."""
    out = F.lit(None).cast("string")
    for name, rule in reversed(rules):
        out = F.when(F.coalesce(rule, F.lit(False)), name).otherwise(out)
    return out


def export_rules(xs: Column, ys: Column, dt: float = 0.1, min_speed: float = 0.0, max_speed: float = 15.0, low: float = -6.0, high: float = 2.0, max_second: float = 10.0) -> list[tuple[str, Column]]:
    """Why a future window isn't exported, in the order in which reasons are counted."""
    from helmtrack.functions.arrays import differences

    step = F.zip_with(differences(xs), differences(ys), lambda a, b: F.sqrt(a * a + b * b))
    speed = F.transform(step, lambda s: s / dt)
    accel = F.slice(F.transform(differences(speed, False), lambda d: d / dt), 2, 1 << 20)
    return [
        ("slow", F.array_max(speed) < min_speed),
        ("accel", (F.array_min(accel) < low) | (F.array_max(accel) > high)),
        ("backward", F.element_at(xs, -1) < 0),
        ("fast", F.array_max(speed) > max_speed),
        ("second_difference", F.array_max(F.transform(accel, F.abs)) > max_second),
    ]


def is_straight(xs: Column, ys: Column, speed: Column, min_speed: float, min_forward: float, max_final: float, max_lateral: float, max_slope: float) -> Column:
    """Fast, far enough ahead, and hardly to the side: at the end, anywhere, and as a slope."""
    final_x, final_y = F.element_at(xs, -1), F.element_at(ys, -1)
    widest = F.array_max(F.transform(ys, F.abs))
    slope = F.abs(final_y) / F.greatest(F.abs(final_x), F.lit(1e-6))
    return (speed >= min_speed) & (final_x >= min_forward) & (F.abs(final_y) <= max_final) & (widest <= max_lateral) & (slope <= max_slope)


#: Least way ahead (m) and mean speed (m/s) of a window that goes anywhere, and the sum of absolute
#: curvatures up to which it counts as straight.
STOP_FORWARD, STOP_SPEED, STRAIGHT_CURVATURE = 2.0, 0.35, 0.15


def category(xs: Column, ys: Column, speed: Column, curvature: Column, straight: Column, threshold: float = 0.01, min_run: int = 3) -> Column:
    """stop, s_curve, straight, then left or right by the side of the end; the order matters. ``straight`` is the
    geometry predicate for gentle windows at speed; NaN speeds don't count in the mean."""
    from helmtrack.functions.arrays import has_s_curve

    add = lambda s, v: s + v
    known = F.filter(speed, lambda v: ~F.isnan(v))
    mean = F.aggregate(known, F.lit(0.0), add) / F.nullif(F.size(known), F.lit(0))
    bend = F.aggregate(F.transform(curvature, F.abs), F.lit(0.0), add)
    return (
        F.when((F.element_at(xs, -1) < STOP_FORWARD) | (mean < STOP_SPEED), "stop")
        .when(has_s_curve(curvature, threshold, min_run) & (bend > STRAIGHT_CURVATURE), "s_curve")
        .when((bend <= STRAIGHT_CURVATURE) | straight, "straight")
        .otherwise(F.when(F.element_at(ys, -1) <= 0, "right").otherwise("left"))
    )


def first_change(sequence: Column) -> Column:
    """The first two neighbouring signs that differ, as one array; null where none do."""
    n = F.greatest(F.size(sequence) - 1, F.lit(0))
    pairs = F.zip_with(F.slice(sequence, 1, n), F.slice(sequence, 2, n), lambda a, b: F.array(a, b))
    return F.try_element_at(F.filter(pairs, lambda p: p[0] != p[1]), F.lit(1))


def trend_allowed(sequence: Column, kind: Column, truths: Column) -> Column:
    """Whether a candidate's curvature sign sequence fits. ``truths`` are the sequences of the true windows; empty ones
    don't count. An s_curve needs the first change of one of them, or any change where they have none; another
    category one of them; where there is none, straight needs no sign, left only plus, right only minus."""
    known = F.filter(truths, lambda t: F.size(t) > 0)
    changes = F.filter(F.transform(known, first_change), lambda c: c.isNotNull())
    own = first_change(sequence)
    curve = F.when(F.size(changes) > 0, F.coalesce(F.array_contains(changes, own), F.lit(False))).otherwise(own.isNotNull())
    alone = (
        F.when(kind == "straight", F.size(sequence) == 0)
        .when(kind == "left", (F.size(sequence) > 0) & F.forall(sequence, lambda s: s >= 0))
        .when(kind == "right", (F.size(sequence) > 0) & F.forall(sequence, lambda s: s <= 0))
        .otherwise(F.lit(True))
    )
    return F.when(kind == "s_curve", curve).when(F.size(known) > 0, F.exists(known, lambda t: t == sequence)).otherwise(alone)


def gt_overlap_free(rows: DataFrame, allowed: DataFrame, column: str) -> DataFrame:
    """Rows whose value is in the allowed set, by a semi-join."""
    return rows.join(allowed.select(column).distinct(), column, "left_semi")


def expandable(t0_index: Column, history: Column, steps: int = 16) -> Column:
    """A sample has its history in its own clip, or brings one along."""
    return (t0_index >= steps - 1) | history.isNotNull()


def next_labelled(rows: DataFrame, by: list[str], order: str, label: str, wanted: str) -> DataFrame:
    """Adds ``next_at``: where the nearest later row of the group with the wanted label is."""
    ahead = Window.partitionBy(*by).orderBy(order).rowsBetween(1, Window.unboundedFollowing)
    return rows.withColumn("next_at", F.first(F.when(F.col(label) == wanted, F.col(order)), ignorenulls=True).over(ahead))


def start_sample(rows: DataFrame, order: list[str], **keys) -> DataFrame:
    """The first row, by ``order``, that has all the given keys; keys that are None don't count."""
    for name, value in keys.items():
        rows = rows if value is None else rows.where(F.col(name) == value)
    return rows.orderBy(*order).limit(1)
