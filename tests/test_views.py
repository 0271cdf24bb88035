"""Exact quantiles, embeddings, labels, repair cascade and the full greedy rule against plain numpy."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from helmtrack.functions import curves, resample
from helmtrack.operators import embedding, match, quantiles, repair, rules


def test_quantiles_of_groups(spark, monkeypatch):
    monkeypatch.setattr(quantiles, "BINS", 16)
    rng = np.random.default_rng(1)
    groups = {0: rng.normal(size=501), 1: np.full(7, 2.5), 2: np.array([1.0]), 3: np.concatenate([np.zeros(90), [1e6, -1e6, 1e-3]]), 4: rng.integers(0, 3, 200).astype(float), 5: np.exp(rng.normal(0, 5, 100))}
    rows = [(g, float(v)) for g, values in groups.items() for v in values] + [(0, None), (1, float("nan")), (9, None)]
    df = spark.createDataFrame(rows, "g int, value double").withColumn("low", F.lit("clash")).repartition(5)
    shares = [0.0, 0.25, 0.5, 0.99, 1.0]
    got = {(r.g, r.share): r.value for r in quantiles.exact_quantiles(df, ["g"], shares).collect()}
    assert set(got) == {(g, s) for g in groups for s in shares}
    for (g, s), v in got.items():
        assert np.isclose(v, np.quantile(groups[g], s), rtol=1e-12, atol=0)
    whole = {r.share: r.value for r in quantiles.exact_quantiles(df.where("g = 0"), [], shares).collect()}
    assert all(np.isclose(v, np.quantile(groups[0], s)) for s, v in whole.items())
    monkeypatch.setattr(quantiles, "FEW", 0)
    assert {(r.g, r.share): r.value for r in quantiles.exact_quantiles(df, ["g"], shares).collect()} == got
    assert quantiles.exact_quantiles(df.limit(0), ["g"], shares).count() == 0


def test_principal_axes_and_places(spark):
    x = np.random.default_rng(2).normal(size=(80, 5)) * [3, 1, 0.5, 0.2, 0.1] + 1000
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "key long, flat array<double>").repartition(4)
    mean, axes = embedding.principal_axes(df, "flat")
    _, _, vt = np.linalg.svd(x - x.mean(0), full_matrices=False)
    assert np.allclose(mean, x.mean(0)) and np.allclose(axes, embedding._directed(vt[:2]), atol=1e-8)
    places = {r.key: r.place for r in embedding.projected(df, "key", "flat", mean, axes).collect()}
    assert np.allclose([places[i] for i in range(80)], (x - x.mean(0)) @ axes.T, atol=1e-6)
    with pytest.raises(ValueError, match="no rows"):
        embedding.principal_axes(df.limit(0), "flat")


def test_scaling_by_landmarks(spark):
    """Curves of one point are at plain distances: their places give these again, whether or not all are landmarks."""
    points = np.random.default_rng(3).normal(size=(60, 2))
    df = spark.createDataFrame([(i, p.tolist()) for i, p in enumerate(points)], "key long, curve array<double>").repartition(3)
    real = np.linalg.norm(points[:, None] - points, axis=2)
    for landmarks in (60, 12):
        got = {r.key: r.place for r in embedding.scaled(df, landmarks=landmarks).collect()}
        place = np.array([got[i] for i in range(60)])
        assert np.allclose(np.linalg.norm(place[:, None] - place, axis=2), real, atol=1e-8)
    bent = np.cumsum(np.random.default_rng(4).normal(size=(25, 6, 2)), axis=1)
    d2 = curves.frechet_table(list(bent), list(bent)) ** 2
    j = np.eye(25) - 1 / 25
    values, vectors = np.linalg.eigh(-0.5 * j @ d2 @ j)
    wanted = embedding._directed(vectors[:, ::-1][:, :2].T).T * np.sqrt(np.maximum(values[::-1][:2], 0))
    df = spark.createDataFrame([(i, c.ravel().tolist()) for i, c in enumerate(bent)], "key long, curve array<double>")
    got = {r.key: r.place for r in embedding.scaled(df).collect()}
    assert np.allclose([got[i] for i in range(25)], wanted, atol=1e-8)
    assert embedding.scaled(df.limit(0)).count() == 0


def test_behaviour_labels(spark):
    stats = [(0, 5.0, 5.0, 0.4), (1, 0.1, 0.2, 0.0), (2, -6.0, 6.0, -0.9), (3, -1.0, 1.0, -0.1), (4, 9.0, 9.0, 1.2), (5, float("nan"), 1.0, 0.0), (6, -2.0, 2.0, -0.1)]
    df = spark.createDataFrame(stats, "cluster int, end_y double, widest double, heading double")
    got = {r.cluster: r.behaviour for r in embedding.behaviour_labels(df).collect()}
    assert got == {0: "left_detour", 1: "straight", 2: "right_turn", 3: "right_detour", 4: "left_turn", 5: "other", 6: "right_detour"}
    few = {r.cluster: r.behaviour for r in embedding.behaviour_labels(df.where("cluster in (1, 2, 5)")).collect()}
    assert few == {1: "straight", 2: "right_turn", 5: "left_turn"}
    labels = spark.createDataFrame([(7, 1, 0.0), (8, 1, 2.0), (9, 2, 0.0)], "key long, cluster int, distance double")
    table = {r.cluster: (r.behaviour, r["size"], r.medoid, r.mean_to_medoid) for r in embedding.summary(labels, [5, 7, 9], df).collect()}
    assert table == {1: ("straight", 2, 7, 1.0), 2: ("right_turn", 1, 9, 0.0)}


def test_each_branch_of_the_repair(spark):
    t = np.arange(1, 31) * 0.1
    even, wild = (5 * t).tolist(), (40 * t).tolist()
    zero, v, dt = [0.0] * 30, [5.0] * 31, [0.1] * 30
    ok, hole = [True] * 30, [True] * 29 + [False]
    rows = [
        (1, even, zero, v, [0.0] * 31, dt, 5.0, ok, "path"),
        (2, wild, zero, v, [0.0] * 31, dt, None, ok, "velocity"),
        (3, None, None, v, [0.0] * 31, dt, 2.0, ok, "velocity"),
        (4, wild, zero, None, None, dt, 5.0, ok, "none"),
        (5, wild, zero, v, [0.0] * 31, [0.1] * 29 + [0.0], 5.0, ok, "none"),
        (6, even, zero, v, [0.0] * 31, dt, None, hole, "path"),
        (7, [], [], v, [0.0] * 31, dt, None, None, "velocity"),
        (8, even[:29] + [float("nan")], zero, v, [0.0] * 31, dt, 5.0, ok, "velocity"),
    ]
    df = spark.createDataFrame(rows, "id int, x array<double>, y array<double>, vx array<double>, vy array<double>, dt array<double>, speed double, valid array<boolean>, want string")
    got = {r.id: r for r in repair.repaired(df).collect()}
    assert {i: r.repair for i, r in got.items()} == {r[0]: r[-1] for r in rows}
    assert np.allclose(got[1].fixed_x, even, atol=1e-6) and np.allclose(got[2].fixed_x, even)
    slow = resample.repaired_velocity(np.array([v]), np.zeros((1, 31)), np.array([dt]), np.array([2.0]))
    assert np.allclose(got[3].fixed_x, slow[0][0]) and np.allclose(got[3].fixed_accel[:10], 2.0) and got[4].fixed_x is None
    fixed = repair.repaired(df)
    shown = {mode: {r.id: r.gt_x for r in repair.shown(fixed, mode).collect()} for mode in ("raw", "repaired")}
    assert shown["raw"][1] == even and shown["raw"][6] is None and shown["repaired"][6] is None and shown["repaired"][7] is None
    assert shown["repaired"][4] == wild and shown["repaired"][2] == got[2].fixed_x and shown["raw"][2] == wild
    with pytest.raises(ValueError, match="mode"):
        repair.shown(fixed, "other")


@pytest.mark.parametrize("category", ["left", "straight"])
def test_the_full_greedy_rule(spark, category):
    """Rounds over groups of any size choose what the rule for one bounded group chooses."""
    setting = {"div_mean": 0.85, "div_end": 0.95, "div_shape": 0.58}
    rng = np.random.default_rng(9)
    rows, wanted = [], set()
    for g in range(6):
        n = 40
        x = np.cumsum(rng.uniform(0.3, 0.6, (n, 6)), axis=1)
        y = rng.normal(0, 3.0, (n, 1)) * np.linspace(0.2, 1, 6) ** 2
        score, offset = rng.integers(0, 12, n).astype(float), rng.uniform(-0.2, 0.9, n) * (g != 5)
        kept = rules.choose(category, 6, score, offset, x, y, setting)
        wanted |= {(g, i, rank) for rank, i in enumerate(kept, 1)}
        rows += [(g, i, float(score[i]), float(offset[i]), x[i].tolist(), y[i].tolist()) for i in range(n)]
    df = spark.createDataFrame(rows, "g int, i int, score double, turned double, x array<double>, y array<double>").repartition(3)
    extra = {"offset": "turned"} if category == "left" else {}
    found = match.diverse(df, ["g"], "score", "i", "x", "y", 0.85, 6, apart=0.5, end=0.95, shape=0.58, **extra)
    assert {(r.g, r.i, r["rank"]) for r in found.collect()} == wanted and len(wanted) > 18


def test_nearest_centres_in_blocks(spark, monkeypatch):
    """Whether the library is one block or many, with equal centres among them."""
    rng = np.random.default_rng(4)
    x, c = rng.normal(size=(70, 3)), rng.normal(size=(25, 3))
    c[20:] = c[:5]
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "i long, t array<double>").repartition(3)
    centres = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(c)], "c int, m array<double>")
    d = ((x[:, None] - c) ** 2).sum(2)
    order = np.argsort(d, axis=1, kind="stable")[:, :4]
    wanted = {(i, int(order[i, r]), r + 1, round(float(d[i, order[i, r]]), 9)) for i in range(70) for r in range(4)}
    for most in (4_000_000, 20):
        monkeypatch.setattr(match, "MAX_CENTRE_VALUES", most)
        found = match.nearest_centres(rows, "i", "t", centres, "c", "m", 4).collect()
        assert {(r.i, r.c, r["rank"], round(r.distance, 9)) for r in found} == wanted and len(found) == 280
    assert match.nearest_centres(rows, "i", "t", centres.limit(0), "c", "m", 4).count() == 0
