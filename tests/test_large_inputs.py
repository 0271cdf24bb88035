"""Steps that were too slow, or held too much, on larger tables: the bounded ways give what the plain ones give."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from helmtrack.operators import rules


def walks(n: int, steps: int = 64, seed: int = 5) -> tuple[np.ndarray, np.ndarray]:
    e = np.random.default_rng(seed).normal(0, 0.125, (n, steps))
    return np.cumsum(0.5 + abs(e), axis=1) / 2, np.cumsum(e, axis=1) / 2


@pytest.mark.parametrize("category", ["straight", "stop", "left", "s_curve"])
def test_only_steps_that_may_pass_are_measured_in_full(spark, monkeypatch, category):
    x, y = walks(9)
    rows = [dict(target=i, category=category, x=a, y=b, later_x=a, later_y=b, speed=None, horizons=[56, 60, 64], centre=0, cx=x[0].tolist(), cy=y[0].tolist()) for i, (a, b) in enumerate(zip(x[1:].tolist(), y[1:].tolist()))]
    few = rules._measured_block(rows)
    monkeypatch.setattr(rules, "_may_pass", lambda x, y, refs, length, offset, kind: np.ones(offset.shape, bool))
    every = rules._measured_block(rows)
    assert every.num_rows == len(rows) * len(rules.grid("turn" if category == "left" else category))
    assert few.num_rows < every.num_rows / 3
    passed = lambda batch: {tuple(r) for r in rules.gated(spark.createDataFrame(batch.to_pandas()).withColumn("category", F.lit(category))).collect()} if batch.num_rows else set()
    assert passed(few) == passed(every)
    assert passed(every) or category != "left"


def curve_rows(spark, curves: list):
    return spark.createDataFrame([(i, [float(v) for v in c]) for i, c in enumerate(curves)], "key long, curve array<double>")


def odd_curves() -> list:
    """Copies, points that repeat (at no distance from those that don't), ties, two numbers of points, and a heap that ends at one place."""
    rng = np.random.default_rng(3)
    free = [rng.normal(0, 1, 8).round(1).tolist() for _ in range(150)]
    heap = [[*rng.normal(0, 1, 6).round(1), 2.0, 2.0] for _ in range(60)]
    return [*free, *heap, *free[:20], *free[:5], [0, 0, 1, 1, 2, 2], [0, 0, 0, 0, 1, 1, 2, 2], [0, 0, 1, 1, 2, 2, 2, 2], *(rng.normal(0, 1, 6).tolist() for _ in range(20))]


@pytest.mark.parametrize("block", [16, 512])
def test_nearest_of_all_is_that_of_all_pairs(spark, monkeypatch, block):
    from helmtrack.functions.curves import frechet_table, points_of
    from helmtrack.operators import nearest

    monkeypatch.setattr(nearest.blocked, "__defaults__", (block,))
    made = odd_curves()
    points = [points_of(c, 2) for c in made]
    d = frechet_table(points, points)
    np.fill_diagonal(d, np.inf)
    found = {r["key"]: (r["nearest"], r["distance"]) for r in nearest.nearest_of_all(curve_rows(spark, made)).collect()}
    assert found == {i: (int(d[i].argmin()), d[i].min()) for i in range(len(made))}
    assert nearest.nearest_of_all(curve_rows(spark, made[:1])).count() == 0


def test_kernels_get_pieces_of_large_batches(spark):
    from helmtrack.functions import kinematics

    rows = spark.range(3000).coalesce(1).select("id", F.array(F.col("id").cast("double"), F.lit(1.0)).alias("x"))
    kernel = lambda x: (x[:, 0] * 2, np.full(len(x), float(len(x))))
    found = kinematics.with_kernel(rows, ["x"], {"twice": "double", "n": "double"}, kernel).collect()
    assert [r["twice"] for r in sorted(found)] == [2.0 * i for i in range(3000)]
    assert max(r["n"] for r in found) <= kinematics.PIECE


def keeping_step(n: int, points: int, width: int = 2) -> np.ndarray:
    """Curves of which some keep step, some double back, and two hold no numbers."""
    made = np.cumsum(np.random.default_rng(points).normal(0.4, 0.6, (n, points, width)), axis=1)
    made[n // 2 :: 3] *= -1
    made[3, points // 2, 0], made[7] = np.nan, np.inf
    return made


@pytest.mark.parametrize(("points", "width"), [(1, 2), (2, 2), (3, 1), (5, 3), (16, 2)])
def test_tables_near_the_diagonal_are_whole_tables(monkeypatch, points, width):
    from helmtrack.functions import curves

    monkeypatch.setattr(curves, "TILE", (7, 16))
    monkeypatch.setattr(curves, "SLICE", 50)
    a, b = keeping_step(40, points, width), keeping_step(60, points, width)
    assert np.array_equal(curves.squares_near(a, b), curves.squares_between(a, b), equal_nan=True)
    assert (curves.frechet_table([np.zeros((0, width))], list(a)) == np.inf).all()


@pytest.mark.parametrize("summed", [3, 2048])
def test_exact_medoids_send_on_sums_only(spark, monkeypatch, summed):
    """Not a row for each pair; equal curves have equal sums in whatever blocks they lie."""
    from helmtrack.functions.curves import frechet_table
    from helmtrack.operators import medoids

    made = np.cumsum(np.random.default_rng(9).normal(0.3, 0.3, (45, 5, 2)), axis=1)
    made[30:] = made[:15]
    rows = curve_rows(spark, made.reshape(45, -1).tolist())
    d = frechet_table(list(made), list(made))
    monkeypatch.setattr(medoids, "SUMMED", summed)
    monkeypatch.setattr(medoids, "pair_distances", None)
    sums = {r["key"]: r["total"] for r in medoids._sums(rows.withColumn("cluster", F.col("key").cast("int") % 2), 2).collect()}
    assert sums == {i: pytest.approx(d[i, i % 2 :: 2].sum()) for i in range(45)}
    assert all(sums[i] == sums[j] for i in range(15) for j in (i + 30,))
    labels, keys = medoids.exact_medoids(rows, 4)
    assert keys[0] == np.round(d.sum(1), 9).argmin()
    assert {r["key"]: (r["cluster"], r["distance"]) for r in labels.collect()} == {i: (d[i, keys].argmin(), d[i, keys].min()) for i in range(45)}
    for c, medoid in enumerate(keys):
        own = np.flatnonzero(d[:, keys].argmin(1) == c)
        assert medoid == own[np.round(d[np.ix_(own, own)].sum(1), 9).argmin()]


def test_sums_change_by_curves_that_moved(spark, monkeypatch):
    from helmtrack.functions.curves import frechet_table
    from helmtrack.operators import medoids

    made = np.cumsum(np.random.default_rng(4).normal(0.3, 0.3, (60, 5, 2)), axis=1)
    d = frechet_table(list(made), list(made))
    monkeypatch.setattr(medoids, "SUMMED", 4)
    met, sums = [], medoids._sums
    monkeypatch.setattr(medoids, "_sums", lambda rows, width: (met.append({(r[0], r[1]): r[2] for r in rows.groupBy("cluster", "part").count().collect()}), sums(rows, width))[1])
    rows = curve_rows(spark, made.reshape(60, -1).tolist())
    # 0 loses few, 1 loses more than half, 2 gains and loses, 3 stays, 4 ends, 5 begins
    old = np.repeat([0, 1, 2, 3, 4], 12)
    new = old.copy()
    new[:3], new[12:20], new[24:26], new[48:] = 2, 2, 0, 5
    labelled = lambda of: rows.withColumn("cluster", F.element_at(F.array(*map(F.lit, of.tolist())), (F.col("key") + 1).cast("int")))
    found = medoids._renewed_sums(labelled(new), medoids.kept(sums(labelled(old), 2), "test-sums"), 2)
    assert {r["key"]: (r["cluster"], r["total"]) for r in found.collect()} == {i: (new[i], pytest.approx(d[i, new == new[i]].sum(), abs=1e-12)) for i in range(60)}
    assert met == [{(0, 0): 9, (0, 1): 2, (0, 2): 3, (1, 1): 4, (2, 0): 10, (2, 1): 11, (2, 2): 2, (3, 0): 12, (5, 1): 12}]


def test_nearest_curve_looks_at_all_points(spark, tmp_path):
    """Four points spread over a trajectory have other nearest ones."""
    import duckdb
    from oracle import assert_same

    from helmtrack.functions import curves
    from helmtrack.plans import registry

    x, y = walks(40)
    e = np.diff(2 * y, axis=1, prepend=0.0)
    spark.createDataFrame([(i, 0, t) for i, t in enumerate(e.tolist())], "vec_id long, label int, embedding array<double>").coalesce(1).write.parquet(str(tmp_path / "rows"))
    duckdb.sql(f"COPY (FROM '{tmp_path}/rows/*.parquet') TO '{tmp_path}/embeddings.parquet'")
    points = np.stack([2 * x, 2 * y], axis=2)
    d = {n: curves.squares_between(points[:, at], points[:, at]) for n, at in ((64, range(64)), (4, curves.sampled(64, 4)))}
    for table in d.values():
        np.fill_diagonal(table, np.inf)
    found = registry.QUERIES["j16_nearest_curve"](spark, str(tmp_path))
    assert {r["vec_id"]: r["nearest"] for r in found.collect()} == dict(enumerate(d[64].argmin(1)))
    assert (d[64].argmin(1) != d[4].argmin(1)).any()
    assert_same(found, registry.ORACLES["j16_nearest_curve"], str(tmp_path))


@pytest.mark.parametrize(("points", "width"), [(1, 2), (3, 1), (16, 2), (40, 2)])
def test_squares_within_a_limit_are_whole_tables(points, width):
    from helmtrack.functions import curves

    a, b = keeping_step(40, points, width), keeping_step(60, points, width)
    with np.errstate(invalid="ignore"):
        d = curves.squares_between(a, b)
        d = np.where(np.isnan(d), np.inf, d)
        i, j = np.indices(d.shape).reshape(2, -1)
        for limit in (np.inf, *np.quantile(d[np.isfinite(d)], [0.05, 0.5])):
            found = curves.squares_within(a[i], b[j], np.full(len(i), limit)).reshape(d.shape)
            assert np.array_equal(found[d <= limit], d[d <= limit]) and (found[d > limit] > limit).all()


@pytest.mark.parametrize("part", [7, 256])
def test_blocks_that_meet_find_the_nearest_of_all_pairs(monkeypatch, part):
    import pyarrow as pa

    from helmtrack.functions import curves
    from helmtrack.operators import nearest

    monkeypatch.setattr(nearest, "PART", part)
    monkeypatch.setattr(nearest, "PAIRS", 100)
    x, y = walks(90, 24)
    points = np.stack([x, y], axis=2)
    places = np.concatenate([points[:, ::6].mean(0) + s for s in ([0, 3.0], [0, -3.0])])
    marks = nearest.marked(points, places)
    d = curves.squares_between(points, points)
    assert (np.abs(marks[:, None] - marks).max(2) <= np.sqrt(d) + 1e-5).all()
    np.fill_diagonal(d, np.inf)
    table = lambda at: pa.table({"key": at, "curve": points[at].reshape(len(at), -1).tolist(), "marks": marks[at].tolist()})
    of = [nearest._Block(table(at), 2) for at in (np.arange(0, 90, 2), np.arange(1, 90, 2))]
    for block, other in ((of[0], of[0]), (of[1], of[1]), of):
        nearest._meet(block, other)
    found = {k: (s, n) for block in of for k, s, n in zip(block.keys, block.square, block.nearest)}
    assert found == {i: (d[i].min(), d[i].argmin()) for i in range(90)}


@pytest.mark.parametrize(("points", "width"), [(1, 2), (2, 1), (16, 2), (16, 3)])
def test_bounds_of_sums(monkeypatch, points, width):
    from helmtrack.functions import curves

    monkeypatch.setattr(curves, "BOUNDED", 16)
    a, b = (np.delete(keeping_step(n, points, width) + 1e4, [3, 7], 0) for n in (40, 60))
    b[:5] = a[:5]
    d = np.sqrt(curves.squares_between(a, b))
    for above in (False, True):
        for found, wanted in zip(curves.bounded_sums(a, b, above), (d.sum(1), d.sum(0))):
            assert ((found >= wanted) if above else (found <= wanted)).all()
    assert curves.bounded_sums(a, keeping_step(60, points, width)) is None
    assert curves.bounded_sums(a, np.concatenate([b, b], axis=1)) is None


def test_few_curves_have_their_distances_summed(spark, monkeypatch):
    """Of a cluster only those whose bounds leave it open."""
    from helmtrack.functions import curves
    from helmtrack.operators import medoids

    x, y = walks(400)
    made = np.stack([2 * x, 2 * y], axis=2)[:, curves.sampled(64, 16)]
    d = curves.frechet_table(list(made), list(made))
    rows = curve_rows(spark, made.reshape(400, -1).tolist()).withColumn("cluster", F.col("key").cast("int") % 2)
    monkeypatch.setattr(medoids, "TRIED", 1)
    tried, costs = [], medoids._costs
    monkeypatch.setattr(medoids, "_costs", lambda some, labels, width: (tried.append(some.count()), costs(some, labels, width))[1])
    best = [np.round(d[c::2, c::2].sum(1), 9).argmin() * 2 + c for c in (0, 1)]
    assert medoids._chosen(rows, medoids.kept(medoids._sums(rows, 2, 64, bounds=True), "test-bounds"), 2) == {0: best[0], 1: best[1]}
    assert sum(tried) < 40
    nothing = rows.select("cluster", "key", F.lit(0.0).alias("total"))
    assert medoids._chosen(rows, nothing, 2) == {0: best[0], 1: best[1]}
    assert sum(tried) > 400
