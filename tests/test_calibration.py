"""Calibration readers and their cascade over written folders, and image points put back on the ground."""

from __future__ import annotations

import json
from pathlib import Path

import numpy as np
from pyspark.sql import functions as F

from helmtrack.functions import camera, kinematics, pose
from helmtrack.sources import calibration


def xml(**matrices) -> str:
    parts = [f'<{name} type_id="opencv-matrix"><rows>{r}</rows><cols>{c}</cols><dt>d</dt><data>{data}</data></{name}>' for name, (r, c, data) in matrices.items()]
    return '<?xml version="1.0"?>\n<opencv_storage>\n' + "\n".join(parts) + "\n</opencv_storage>\n"


def write(path: Path, text: str) -> None:
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding="utf-8")


LARGE = (3, 3, "2000 0 1900 0 2200 1000\n 0 0 1")
SMALL = (3, 3, "900 0 960 0 910 540 0 0 1")
MILLIMETRES = (4, 4, "1 0 0 1000 0 1 0 2000 0 0 1 3000 0 0 0 1")
METRES = (3, 4, "1 0 0 1.5 0 1 0 -2.5 0 0 1 3e0")


def folder(root: Path, dataset: str, cameras: dict) -> None:
    for name, (intrinsic, extrinsic) in cameras.items():
        at = root / dataset / "calibration" / name if dataset else root / "calibration" / name
        if intrinsic:
            write(at / "cameraIntrinsic.xml", intrinsic)
        if extrinsic:
            write(at / "cameraExtrinsic.xml", extrinsic)


def test_cascade_of_calibrations(spark, tmp_path):
    root, lines = tmp_path / "data", tmp_path / "global"
    front = xml(camIntrinsicMat=LARGE, distortion_coefficients=(8, 1, "1 2 3 4 5 6 7 8")), xml(extrinsicMatrix=MILLIMETRES)
    folder(root, "demo_converted", {"fc120": front, "fl": (xml(camIntrinsicMat=SMALL), xml(extrinsicMatrix=METRES)), "rr": (xml(camIntrinsicMat=SMALL), None), "other": front})
    folder(root, "plain", {"rc": (xml(camIntrinsicMat=SMALL, distortion_coefficients=(2, 1, "1 2")), xml(extrinsicMatrix=METRES))})
    folder(root, "broken", {"fc120": front, "fr": (xml(camIntrinsicMat=(3, 3, "1 2 3")), xml(extrinsicMatrix=METRES))})
    folder(root, "garbled_converted", {"fc120": ("<opencv_storage><camIntr", xml(extrinsicMatrix=METRES))})
    folder(root, "odd", {"fc120": (front[0], xml(extrinsicMatrix=(2, 6, "1 0 0 4 0 1 0 5 0 0 1 6")))})
    t = lambda *move: [1, 0, 0, move[0], 0, 1, 0, move[1], 0, 0, 1, move[2]]
    record = lambda dataset, segment, cams, **more: json.dumps({"dataset": dataset, "segment": segment, "cameras": {c: {"T_bev_m_to_camera_m_3x4": m} for c, m in cams.items()}, **more})
    write(lines / "manifest.json", json.dumps({"camera_models": {"FC": {"fx": 20, "fy": 30, "cx": 40, "cy": 50, "distortion_coefficients_k1_k2_p1_p2_k3_k4_k5_k6": [0.5], "raw_image_width": 640}}}))
    name = lambda d: lines / f"{d}{calibration.SUFFIX}.jsonl"
    write(name("demo"), record("demo", "clip", {"FC": t(9, 9, 9)}) + "\n")
    nested = [[1, 0, 0, 4], [0, 1, 0, 5], [0, 0, 1, -6e-1]]
    write(name("broken"), "\n".join([record("another", "clip", {"FC": t(0, 0, 0)}), "", record("broken", "clip", {"FC": nested, "XX": t(7, 8, 9)}, timestamp=50), "not json", record("broken", "clip", {"FC": t(1, 1, 1)}, timestamp=70)]) + "\n")
    write(name("garbled"), record("garbled", "clip", {"FC": t(2, 2, 2)}) + "\n" + record("garbled", "late", {"FC": t(3, 3, 3)}, timestamp=5) + "\n")
    write(name("odd"), record("odd", "other", {"FC": t(2, 2, 2)}) + "\n")
    asked = [("demo_converted", "clip"), ("demo", "clip"), ("plain_converted", "clip"), ("broken", "clip"), ("broken", "none"), ("garbled_converted", "clip"), ("garbled_converted", "late"), ("odd", "clip"), ("nothing", "clip")]
    segments = spark.createDataFrame(asked * 2, "dataset string, segment string")
    got = {(r.dataset, r.segment, r.camera): r for r in calibration.for_segments(spark, segments, str(root), str(lines)).collect()}
    wanted = {("demo_converted", "clip", "FC"), ("demo_converted", "clip", "FL"), ("demo", "clip", "FC"), ("demo", "clip", "FL"), ("plain_converted", "clip", "RC"), ("broken", "clip", "FC"), ("broken", "clip", "XX"), ("garbled_converted", "clip", "FC"), ("garbled_converted", "late", "FC")}
    assert set(got) == wanted
    first = got["demo_converted", "clip", "FC"]
    assert (first.fx, first.fy, first.cx, first.cy) == (1000.0, 1100.0, 950.0, 500.0) and first.origin == "xml" and (first.width, first.height) == (1920, 1080)
    assert [first.transform[i] for i in (3, 7, 11)] == [1.0, 2.0, 3.0] and first.distortion == [1, 2, 3, 4, 5, 6, 7, 8]
    side = got["demo", "clip", "FL"]
    assert (side.fx, side.cx) == (900.0, 960.0) and [side.transform[i] for i in (3, 7, 11)] == [1.5, -2.5, 3.0] and side.distortion == [0.0] * 8
    assert got["plain_converted", "clip", "RC"].distortion == [1.0, 2.0] + [0.0] * 6
    line = got["broken", "clip", "FC"]
    assert line.origin == "jsonl" and (line.fx, line.fy, line.cx, line.cy, line.width, line.height) == (20, 30, 40, 50, 640, 1080) and line.distortion == [0.5] + [0.0] * 7
    assert [line.transform[i] for i in (3, 7, 11)] == [4.0, 5.0, -0.6] and got["broken", "clip", "XX"].fx == 1000.0
    assert got["garbled_converted", "late", "FC"].transform[3] == 3.0
    without = calibration.for_segments(spark, segments, None, str(lines))
    assert {(r.dataset, r.camera, r.origin) for r in without.where("dataset like 'demo%'").collect()} == {("demo_converted", "FC", "jsonl"), ("demo", "FC", "jsonl")}


def test_nearest_calibration_in_time(spark, tmp_path):
    t = [1, 0, 0, 4, 0, 1, 0, 5, 0, 0, 1, 6]
    rows = [("s", 100, "a"), ("s", 200, "b"), ("s", 200, "c"), ("z", None, "d")]
    text = "\n".join(json.dumps({k: v for k, v in {"dataset": "whatever", "segment": s, "timestamp": at, "cameras": {cam: {"T_bev_m_to_camera_m_3x4": t}}}.items() if v is not None}) for s, at, cam in rows)
    write(tmp_path / f"d{calibration.SUFFIX}.jsonl", text + "\n")
    known = calibration.timed(spark, str(tmp_path))
    assert {(r.dataset, r.segment, r.timestamp): [c.camera for c in r.cameras] for r in known.collect()} == {("d", "s", 100): ["a"], ("d", "s", 200): ["c"], ("d", "z", 0): ["d"]}
    samples = spark.createDataFrame([("d", "s", 149), ("d", "s", 150), ("d", "s", 151), ("d", "s", -5), ("d", "z", 9), ("e", "s", 1), ("d", "s", None)], "dataset string, segment string, t0_us long")
    found = calibration.nearest_in_time(samples, known, ["dataset", "segment"], "t0_us", "timestamp", ["cameras"])
    assert sorted((r.segment, r.t0_us, r.cameras[0].camera) for r in found.where("t0_us IS NOT NULL").collect()) == [("s", -5, "a"), ("s", 149, "a"), ("s", 150, "a"), ("s", 151, "c"), ("z", 9, "d")]


def test_image_points_return_to_the_ground(spark):
    rng = np.random.default_rng(6)
    k = [0.2, -0.05, 0.001, -0.002, 0.01, 0.25, -0.02, 0.005]
    yaw, pitch = 0.1, 0.05
    base = np.array([[1, 0, 0], [0, 0, -1], [0, 1, 0]], float)  # right, down, ahead
    turn = np.array([[1, 0, 0], [0, np.cos(pitch), -np.sin(pitch)], [0, np.sin(pitch), np.cos(pitch)]]) @ base @ np.array([[np.cos(yaw), -np.sin(yaw), 0], [np.sin(yaw), np.cos(yaw), 0], [0, 0, 1]])
    place = np.array([0.3, -1.2, 1.6])
    t = np.column_stack([turn, -turn @ place])
    ground = np.column_stack([rng.uniform(6, 40, 60), rng.uniform(-6, 6, 60)])
    rows = [(i, float(a), float(b)) for i, (a, b) in enumerate(ground)]
    df = spark.createDataFrame(rows, "i int, ahead double, left double")
    lit = lambda v: [F.lit(float(x)) for x in v]
    pixel = pose.projected([-F.col("left"), F.col("ahead"), F.lit(0.0)], [lit(r) for r in t], lit([1100, 1080, 960, 540]), lit(k))
    df = df.withColumn("p", pixel).select("i", "ahead", "left", F.array("p.u").alias("u"), F.array("p.v").alias("v"), F.array(*lit([1100, 1080, 960, 540])).alias("k4"), F.array(*lit(k)).alias("k8"), F.array(*lit(t.ravel())).alias("t"))
    back = kinematics.with_kernel(df, ["u", "v", "k4", "k8", "t"], {"x": "array<double>", "y": "array<double>"}, camera.image_to_ground).collect()
    assert len(back) == 60
    assert max(abs(r.x[0] - r.ahead) + abs(r.y[0] - r.left) for r in back) < 1e-6
    sky = camera.image_to_ground(np.array([[960.0]]), np.array([[10.0]]), np.array([[1100, 1080, 960, 540.0]]), np.array([k]), t.ravel()[None])
    flat = camera.image_to_ground(np.array([[960.0]]), np.array([[900.0]]), np.array([[1100, 1080, 960, 540.0]]), np.array([k]), np.zeros((1, 12)))
    assert np.isnan(sky).all() and np.isnan(flat).all()
