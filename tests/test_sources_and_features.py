from __future__ import annotations

import pytest

from helmtrack.operators import features
from helmtrack.sources import text


def test_windows_round_trip(spark, tmp_path):
    path = tmp_path / "future.txt"
    path.write_text("# note\n\n1 d c 100 4 1.0 2.0 3.0 4.0\n2 d c 200 5 1.0 2.0 3.0 4.5 6 7\n")
    lenient = text.future_windows(spark, str(path), 2, strict=False).orderBy("traj_id").collect()
    assert [(r.traj_id, r.t0_us, r.xy) for r in lenient] == [(1, 100, [1.0, 2.0, 3.0, 4.0]), (2, 200, [1.0, 2.0, 3.0, 4.5])]
    assert [len(r.compare_xy) for r in text.windows_with_horizon(spark, str(path), 2).orderBy("traj_id").collect()] == [4, 6]
    with pytest.raises(Exception, match="Bad row with 11 columns"):
        text.future_windows(spark, str(path), 2).collect()
    lines = [r.value for r in text.window_lines(text.future_windows(spark, str(path), 2, strict=False)).collect()]
    assert "1 d c 100 4 1.000000 2.000000 3.000000 4.000000" in lines


def test_centres_json_lines_and_clips(spark, tmp_path):
    (tmp_path / "c.txt").write_text("# head\nCENTER 3 12 0.5 1.5\nMEMBER 1\n")
    assert [tuple(r) for r in text.centres(spark, str(tmp_path / "c.txt")).collect()] == [(3, 12, [0.5, 1.5])]
    (tmp_path / "cot.jsonl").write_text('{"clip_id": "a", "cot": "old"}\nnot json\n{"clip_id": "a", "cot": "new"}\n{"clip_id": "b", "cot": "x"}\n')
    rows = text.json_lines(spark, str(tmp_path / "cot.jsonl"), "clip_id string, cot string")
    assert sorted((r.clip_id, r.cot) for r in text.last_of_key(rows, ["clip_id"]).collect()) == [("a", "new"), ("b", "x")]
    clips = spark.createDataFrame([("d", "a", 2, 0), ("d", "a", 1, 0), ("d", "b", 1, 1)], "dataset string, clip string, t0_us long, sample_idx int")
    for _ in range(2):
        text.write_clips(clips, str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == 3


def test_speed_buckets_and_kmeans(spark):
    rows = spark.createDataFrame([(1, 1.25), (2, float("nan")), (3, -4.0), (4, 3.7), (5, None)], "k int, v double")
    got = {r.k: r.b for r in rows.select("k", features.speed_bucket(rows.v, 2.5).alias("b")).collect()}
    assert got == {1: 2.5, 2: 0.0, 3: 0.0, 4: 2.5, 5: 0.0}
    points = spark.createDataFrame([(i, [float(i % 2) * 10, float(i) / 100]) for i in range(20)], "id int, f array<double>")
    labelled, centres, inertia = features.kmeans(points, "f", 2)
    assert centres.count() == 2 and inertia < 1.0
    assert len({(r.id % 2, r.cluster) for r in labelled.collect()}) == 2
