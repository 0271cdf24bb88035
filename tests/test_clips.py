"""Slices of clips, their scores and reasoning texts against plain lists."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import functions as F

from helmtrack.operators import clips


def test_slices_and_scores_of_windows(spark):
    rng = np.random.default_rng(2)
    frames, tables = [], {}
    for dataset, clip, n in (("a", "c1", 30), ("a", "c2", 9), ("b", "c1", 12)):
        table = rng.normal(size=(n, 4))
        if (dataset, clip) == ("a", "c1"):
            table[20, 0] = np.nan
            table[11, 1] = np.inf
        tables[dataset, clip] = table
        frames += [(dataset, clip, i * 100, *map(float, row), "x") for i, row in enumerate(table)]
    frames = [f[:3] + (None,) + f[4:] if f[:3] == ("b", "c1", 700) else f for f in frames]
    tables["b", "c1"][7, 0] = np.nan
    df = spark.createDataFrame(frames, "dataset string, clip string, timestamp long, curvature double, vx double, vy double, vz double, min_speed string").repartition(5)
    asked = [(i, d, c, k) for i, (d, c, k) in enumerate((d, c, k) for (d, c), t in tables.items() for k in (-1, 0, 3, len(t) - 6, len(t) - 5, len(t) - 1, len(t), len(t) + 9))]
    asked += [(900, "z", "c9", 0), (901, None, "c1", 0), (902, "a", "c1", None), (0, "a", "c1", -1)]
    rows = spark.createDataFrame(asked, "i int, dataset string, clip string, t0_index int")
    got = clips.window_scores(rows, df, "timestamp", 5).collect()
    assert len(got) == len(asked)
    for r in got:
        table = tables.get((r.dataset, r.clip), np.zeros((0, 4)))
        k = -1 if r.t0_index is None else r.t0_index
        part = table[k + 1 : k + 6] if k >= 0 else table[:0]
        bend, speed = part[:, 0], np.sqrt((part[:, 1:] ** 2).sum(1))
        same = lambda x, y: (math.isnan(x) and math.isnan(y)) or math.isclose(x, y, rel_tol=1e-12)
        whole = lambda v: len(v) == 5 and np.isfinite(v).all()
        assert same(r.curvature_sum, np.abs(bend).sum() if whole(bend) else math.nan)
        assert same(r.min_speed, speed.min() if whole(speed) else math.nan)
        assert all(same(x, y) for x, y in zip(r.speed_trace, speed if whole(speed) else [math.nan] * 5)) and len(r.curvature_trace) == 5
        now = np.sqrt((table[k, 1:] ** 2).sum()) if 0 <= k < len(table) else math.nan
        assert same(r.t0_speed, now if np.isfinite(now) else math.nan)
    assert clips.window_scores(rows.limit(0), df, "timestamp", 5).count() == 0
    assert clips.window_scores(rows, df.limit(0), "timestamp", 5).where("NOT isnan(min_speed)").count() == 0


def test_last_reasoning_of_a_key(spark):
    rows = spark.createDataFrame([("d", "c", 5, 0, "old"), ("d", "c", 5, 1, "old"), ("d", "c", 6, 0, None), ("", "", 0, 0, "x"), (None, "c", 5, 0, "y")], "dataset string, clip string, t0_us long, sample_idx int, cot string")
    texts = spark.createDataFrame([("d", "c", 5, 0, "first", 1), ("d", "c", 5, 0, "second", 2), ("d", "c", 5, 1, None, 3), (None, None, None, None, "bare", 4)], "dataset string, clip string, t0_us long, sample_idx int, cot string, place int")
    got = {(r.dataset, r.t0_us, r.sample_idx): r.cot for r in clips.with_reasoning(rows, texts, "place").collect()}
    assert got == {("d", 5, 0): "second", ("d", 5, 1): "", ("d", 6, 0): "", ("", 0, 0): "bare", (None, 5, 0): ""}
    assert clips.with_reasoning(rows, texts.where(F.lit(False)), "place").where("cot <> ''").count() == 0


def test_history_borrowed_from_earlier_clips(spark):
    table = {("a", "c1"): [1, 2], ("a", "c2"): [3], ("a", "c3"): [4, 5, 6, 7], ("b", "c0"): [8], ("b", "c9"): [9, 10, 11]}
    rows = [(d, c, 50 - 9 * n + k, float(v), "x") for n, ((d, c), values) in enumerate(table.items()) for k, v in enumerate(values)]
    df = spark.createDataFrame(rows, "dataset string, clip string, t long, v double, history string").drop("history").withColumn("_x", F.lit(1)).repartition(3)
    for clips_, reach in ((None, 9), (1, 1), (0, 0)):
        want = {}
        for (d, c), values in table.items():
            earlier = [v for (e, b), vs in sorted(table.items()) if e == d and b < c for v in [(b, vs)]][-reach:] if reach else []
            lent = [x for _, vs in earlier for x in vs[-3:]]
            for k, v in enumerate(values):
                whole = (lent + values[: k + 1])[-4:]
                want[d, c, v] = [float(x) for x in whole] if len(lent) + k + 1 >= 4 else None
        got = {(r.dataset, r.clip, r.v): r.history for r in clips.borrowed_history(df, "t", "v", 4, clips_).collect()}
        assert got == want
    assert clips.borrowed_history(df.limit(0), "t", "v", 4).count() == 0
