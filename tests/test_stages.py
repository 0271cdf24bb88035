"""Staged K-Means: parts by plain rules, labels that are numbered on, centres that are means of their rows."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from helmtrack.operators import stages

LIMITS = {"min_speed": 6.0, "min_forward": 20.0, "max_final": 1.0, "max_lateral": 1.0, "max_slope": 0.1}
SCHEMA = "i int, feature array<double>, x array<double>, y array<double>, curvature_sum double, curvature array<double>, speed double, speeds array<double>, min_speed double, part string, distance double"


def windows():
    rng = np.random.default_rng(3)
    rows, part = [], {}
    for i in range(90):
        kind = ("straight", "gentle", "turn", "s_curve", "stop")[i % 5] if i < 80 else "odd"
        x = np.linspace(0.5, 30.0 if kind != "stop" else 3.0, 12)
        y = np.linspace(0, {"turn": 9.0, "s_curve": 0.5}.get(kind, 0.1), 12)
        bend = {"straight": 0.001, "gentle": 0.1, "turn": 0.1, "stop": 0.1, "odd": 0.1}.get(kind, 0.1) * np.ones(12)
        if kind == "s_curve":
            bend[6:] *= -1
        total = float("nan") if kind == "odd" else float(np.abs(bend).sum())
        speeds = np.where(np.arange(12) > 5, 0.2, 8.0) if kind == "stop" else np.full(12, 8.0)
        feature = rng.normal(size=3) + {"turn": 5, "stop": 9}.get(kind, 0)
        rows.append((i, feature.tolist(), x.tolist(), y.tolist(), total, bend.tolist(), 8.0, speeds.tolist(), float(speeds.min()), "clash", 0.0))
        part[i] = kind
    return rows, part


def check(found, centres, inertia, wanted, key="feature"):
    """Each row is in its part, at its nearest centre of it, which is the mean of its rows."""
    middle = {r.cluster: (r.part, np.array(r.centre)) for r in centres.collect()}
    got = found.collect()
    assert {r.i: r.part for r in got} == wanted and len(got) == len(wanted)
    for c, (part, centre) in middle.items():
        own = [np.array(r[key]) for r in got if r.cluster == c]
        assert own and np.allclose(np.mean(own, axis=0), centre, atol=1e-6)
    for r in got:
        d = {c: np.linalg.norm(np.array(r[key]) - v) for c, (p, v) in middle.items() if p == r.part}
        assert np.isclose(r.distance, d[r.cluster]) and np.isclose(r.distance, min(d.values()))
    assert np.isclose(inertia, sum(r.distance**2 for r in got))
    return {p: sorted(c for c, (q, _) in middle.items() if q == p) for p in {p for p, _ in middle.values()}}


def test_split_by_curvature(spark):
    rows, kinds = windows()
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    gentle = stages.straight(**LIMITS)
    with pytest.raises(ValueError, match="finite"):
        stages.split_by_curvature(df, 3, 2, 0.5, gentle)
    wanted = {i: {"straight": "straight", "gentle": "straight", "s_curve": "straight", "turn": "turn", "stop": "turn"}[k] for i, k in kinds.items() if k != "odd"}
    labels = check(*stages.split_by_curvature(df.where("NOT isnan(curvature_sum)"), 3, 2, 0.5, gentle), wanted)
    assert labels == {"straight": [0, 1, 2], "turn": [3, 4]}


def test_stops_then_curvature(spark):
    rows, kinds = windows()
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    gentle = stages.straight(**LIMITS)
    for stop in (stages.stops(0.3, 0.6), stages.stops(0.3)):
        (halting, *more), (rest, *others) = stages.stops_and_curvature(df, stop, 4, {"straight": 2, "turn": 30, "s_curve": 2}, 0.5, gentle, (0.05, 3), 1.5, 2.0)
        assert check(halting, *more, {i: "stop" for i, k in kinds.items() if k == "stop"}, "stop_feature") == {"stop": [0, 1, 2, 3]}
        first = next(r for r in halting.collect())
        assert len(first.stop_feature) == 3 + 12 + 1 and np.isclose(first.stop_feature[-1], -2.0 * first.y[-1]) and np.isclose(first.stop_feature[4], -1.5 * first.y[1])
        wanted = {i: {"gentle": "straight"}.get(k, k) for i, k in kinds.items() if k not in ("odd", "stop")}
        assert check(rest, *others, wanted) == {"straight": [0, 1], "turn": list(range(2, 18)), "s_curve": [32, 33]}
    (_, (rest, *others)) = stages.stops_and_curvature(df, stop, 4, {"straight": 2, "turn": 1}, 0.5, gentle)
    assert check(rest, *others, {i: "straight" if k != "turn" else "turn" for i, k in wanted.items() if k != "gentle"} | {i: "straight" for i, k in kinds.items() if k == "gentle"}) == {"straight": [0, 1], "turn": [2]}
    with pytest.raises(ValueError, match="stops"):
        stages.stops_and_curvature(df, stages.stops(0.1), 4, {"straight": 2, "turn": 1}, 0.5, gentle)
    with pytest.raises(ValueError, match="turn"):
        stages.staged(df, stages.curvature_part(0.5, gentle), {"straight": 2})
    assert stages.stops_and_curvature(df.where("i % 5 = 4"), stages.stops(0.3), 2, {"straight": 2, "turn": 1}, 0.5, gentle)[1] is None
    with pytest.raises(ValueError, match="no rows"):
        stages.staged(df.where("i < 0"), F.lit("straight"), {"straight": 2})
