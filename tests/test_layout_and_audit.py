from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from helmtrack.operators import audit, timeindex
from helmtrack.sources import layout, text


def test_layout(spark, tmp_path):
    root = str(tmp_path)
    for dataset, clip, start in (("b", "c2", 300), ("a", "c2", 0), ("a", "c1", 200), ("b", "c1_fovs_FC", 5)):
        rows = spark.range(3).select((F.col("id") * 100 + start).alias("timestamp"), F.col("id").cast("double").alias("x"))
        path = tmp_path / dataset / "data-egomotion"
        path.mkdir(parents=True, exist_ok=True)
        rows.toPandas().to_parquet(path / f"{clip}.egomotion.parquet")
    files = layout.clip_files(spark, root, "egomotion")
    assert [r.dataset for r in layout.datasets(files).collect()] == ["a", "b"]
    assert [tuple(r) for r in layout.clips(files).collect()] == [("a", "c1"), ("a", "c2"), ("b", "c1"), ("b", "c2")]
    assert [tuple(r) for r in layout.master_clips(files).collect()] == [("a", "c1"), ("a", "c2"), ("b", "c2")]
    ego = layout.egomotion(spark, root, ["a"])
    assert sorted((r.timestamp, r.clip) for r in ego.collect()) == [(0, "c2"), (100, "c2"), (200, "c1"), (300, "c1"), (400, "c1")]
    scan = layout.scan(spark, root, "egomotion", ["x"])
    assert scan.columns == ["x", "dataset", "clip"] and "timestamp" not in scan._jdf.queryExecution().executedPlan().toString()
    order = layout.clip_order(layout.scan(spark, root, "egomotion", only=["a"])).collect()
    assert [(r.clip, r.first_us) for r in order] == [("c2", 0), ("c1", 200)]
    nested = spark.createDataFrame([([1.0] * 4, [1.0] * 4), ([1.0] * 4, [1.0] * 3), ([1.0] * 3, [1.0] * 3), ([1.0] * 3 + [float("nan")], [1.0] * 4)], "x array<double>, y array<double>")
    assert layout.trajectories(nested).count() == 1
    frames = spark.createDataFrame([("a", "c1", 0, 1), ("a", "c1", 10, 1), ("a", "c2", 99, 2)], "dataset string, clip string, timestamp long, segment int")
    got = layout.segment_at(spark.createDataFrame([("a", "c1", 8), ("a", "zz", 1)], "dataset string, clip string, t0_us long"), frames).collect()
    assert sorted((r.clip, r.frame.timestamp) for r in got) == [("c1", 0), ("c1", 10), ("zz", 0), ("zz", 10), ("zz", 99)]


def test_clips_written_apart_both_stay(spark, tmp_path):
    rows = spark.createDataFrame([("d", "a", 2, 0), ("d", "b", 1, 1)], "dataset string, clip string, t0_us long, sample_idx int")
    for clip in "aba":
        text.write_clips(rows.where(F.col("clip") == clip), str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == 2


def test_audited_writes_and_restore(spark, tmp_path):
    root = str(tmp_path)
    assert audit.current(spark, root, "t") is None and audit.latest_backup(spark, root, "t") is None
    with pytest.raises(ValueError, match="no backup"):
        audit.restore(spark, root, "t")
    rows = spark.createDataFrame([(1, 0, "x"), (1, 1, "y"), (2, 0, "z")], "t0_us long, sample_idx int, v string")
    audit.write(rows, root, "t", "save all", 3)
    assert audit.save_deletes(spark, root, "t", rows.where("sample_idx = 0"), 1) == 1
    assert audit.save_deletes(spark, root, "t", rows.where("sample_idx = 0"), 7) == 0
    assert sorted(r.v for r in audit.current(spark, root, "t").collect()) == ["y", "z"]
    audit.restore(spark, root, "t")
    assert sorted(r.v for r in audit.current(spark, root, "t").collect()) == ["x", "y", "z"]
    entries = audit.tail(audit.log(spark, root), 2).collect()
    assert [(e.operation, e.rows_before, e.rows_after, e.affected_rows) for e in entries] == [("restore", 2, 3, 0), ("delete", 3, 2, 1)]
    assert audit.slug("  save / all ") == "save_all" and timeindex
