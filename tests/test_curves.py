"""Frechet distances, Frenet coordinates and K-Medoids against plain loops."""

from __future__ import annotations

import numpy as np
import pytest

from helmtrack.functions import curves
from helmtrack.operators import medoids


def plain_frechet(a, b) -> float:
    table = {}
    for i in range(len(a)):
        for j in range(len(b)):
            before = [table[c] for c in ((i - 1, j), (i, j - 1), (i - 1, j - 1)) if c in table]
            table[i, j] = max(float(np.linalg.norm(np.asarray(a[i]) - b[j])), min(before) if before else 0.0)
    return table[len(a) - 1, len(b) - 1]


def test_frechet_of_curves_of_all_lengths():
    rng = np.random.default_rng(1)
    a = [rng.normal(size=(n, w)).round(1) for n, w in ((1, 2), (2, 2), (7, 2), (7, 2), (12, 2))]
    b = [rng.normal(size=(n, 2)).round(1) for n in (1, 3, 7, 7)]
    assert np.allclose(curves.frechet_table(a, b), [[plain_frechet(x, y) for y in b] for x in a], atol=1e-12)
    wide = rng.normal(size=(30, 5, 4))
    assert np.allclose(curves.frechet_pairs(wide[:15], wide[15:]), [plain_frechet(x, y) for x, y in zip(wide[:15], wide[15:])])
    assert curves.frechet_table([], b).shape == (0, 4)


def test_pieces_of_pairs_give_the_same(monkeypatch):
    rng = np.random.default_rng(2)
    a, b = rng.normal(size=(50, 6, 2)), rng.normal(size=(50, 4, 2))
    whole = curves.frechet_pairs(a, b)
    monkeypatch.setattr(curves, "CELLS", 30)
    assert (curves.frechet_pairs(a, b) == whole).all()
    assert (np.diag(curves.frechet_table(list(a), list(b))) == whole).all()


def test_sampled_places():
    assert curves.sampled(64, 16) == np.linspace(0, 63, 16).round().astype(int).tolist()
    assert curves.sampled(10, 4) == [0, 3, 6, 9] and curves.sampled(5, 16) == [0, 1, 2, 3, 4]


def test_history_line_is_the_fitted_parabola():
    x = np.linspace(-8, 0, 16)
    y = 0.03 * x * x - 0.2 * x + np.sin(x) * 0.01
    line = curves.history_line(x, y, 30.0)
    grid = np.sort(np.append(np.linspace(-8, 35, 160), 0.0))
    wanted = np.polyval(np.polyfit(x, y, 2), grid)
    assert np.allclose(line[:, 0], grid) and (line[np.isclose(line[:, 0], 0.0)] == 0).all()
    assert np.allclose(line[~np.isclose(grid, 0.0), 1], wanted[~np.isclose(grid, 0.0)], atol=1e-9)
    straight = curves.history_line(np.array([-1.0, -1.0, 0.0, 0.0]), np.array([1.0, 1.0, 0.5, 0.5]), 3.0)
    assert np.allclose(straight[straight[:, 0] != 0, 1], 0.5 - 0.5 * straight[straight[:, 0] != 0, 0])
    assert straight[:, 0].min() == -1.0 and straight[:, 0].max() == 20.0


@pytest.mark.parametrize("count", [0, 1])
def test_history_without_points_is_the_axis(count):
    nothing = np.full(3, np.nan)
    nothing[:count] = 1.0
    line = curves.history_line(nothing, nothing, 40.0)
    assert len(line) == 120 and line[0].tolist() == [-10.0, 0.0] and line[-1].tolist() == [45.0, 0.0]


def test_history_that_stands():
    still = curves.history_line(np.zeros(16), np.zeros(16), 2.0)
    assert still.tolist() == [[0.0, 0.0], [0.0, 0.0], [20.0, 0.0]]
    sideways = curves.history_line(np.zeros(3), np.array([0.0, 1.0, 2.0]), 30.0)
    assert sideways.tolist() == [[0.0, 0.0], [0.0, 2.0], [0.0, 37.0]]
    x, y = np.full(4, 2.0), np.array([1.0, 2.0, 3.0, 4.0])
    scaled = np.vander(x, 2) / np.sqrt((np.vander(x, 2) ** 2).sum(0))
    c1, c0 = np.linalg.pinv(scaled) @ y / np.sqrt((np.vander(x, 2) ** 2).sum(0))
    line = curves.history_line(x, y, 1.0)
    drawn = line[line[:, 0] != 0]
    assert np.allclose(drawn[:, 1], c0 + c1 * drawn[:, 0])


def test_projection_on_each_piece_and_beyond_the_ends():
    line = np.array([[-2.0, 0.0], [0.0, 0.0], [0.0, 0.0], [2.0, 0.0], [2.0, 3.0]])
    found = curves.projected(np.array([[-3.0, 1.0], [1.0, 0.5], [1.0, -0.5], [3.0, 2.0], [2.0, 9.0], [2.5, -0.5]]), line)
    assert np.allclose(found, [[-2, 1], [1, 0.5], [1, -0.5], [4, -1], [5, 0], [2, -0.5]])
    assert curves.projected(np.array([[1.0, 2.0]]), np.zeros((3, 2))).tolist() == [[1.0, 2.0]]


def test_frenet_rates():
    x = np.cumsum(np.ones((2, 6)), axis=1)
    h = np.tile(np.linspace(-3, 0, 16), (2, 1))
    s, left, ds, dl = curves.frenet(x, x * 0.1, h, h * 0)
    assert np.allclose(s, x) and np.allclose(left, x * 0.1) and np.allclose(ds, 10) and np.allclose(dl, 1)


def some_curves(n: int, points: int = 6) -> np.ndarray:
    """Bundles of curves, with copies among them."""
    rng = np.random.default_rng(n)
    made = np.cumsum(rng.normal(size=(n, points, 2)) + rng.integers(-2, 3, size=(n, 1, 2)), axis=1).round(3)
    made[n // 2 : n // 2 + n // 10] = made[: n // 10]
    return made


def frame(spark, made):
    rows = [(i, c.ravel().tolist(), c.ravel().tolist(), "x", 0) for i, c in enumerate(made)]
    return spark.createDataFrame(rows, "key long, curve array<double>, flat array<double>, distance string, cluster int").repartition(3)


def plain_rounds(d, medoids_of, first, k, rounds, renew):
    medoid = first
    for _ in range(rounds):
        labels = d[:, medoid].argmin(1)
        fresh = list(medoid)
        for c in range(k):
            members = np.flatnonzero(labels == c)
            fresh[c] = int(renew(members, labels, medoid[c])) if len(members) else int(d[:, medoid].min(1).argmax())
        if fresh == medoid:
            break
        medoid = fresh
    labels = d[:, medoid].argmin(1)
    return labels, d[np.arange(len(d)), np.asarray(medoid)[labels]], medoid


def best_sum(d):
    return lambda members, *_: members[np.round(d[np.ix_(members, members)].sum(1), 9).argmin()]


@pytest.mark.parametrize(("n", "k", "block"), [(500, 5, 64), (40, 7, 3), (3, 9, 64), (1, 2, 64)])
def test_exact_medoids(spark, monkeypatch, n, k, block):
    made = some_curves(n)
    d = curves.frechet_table(list(made), list(made))
    first = [int(np.round(d.sum(1), 9).argmin())]
    while len(first) < min(k, n):
        near = d[:, first].min(1)
        near[first] = -1
        first.append(int(near.argmax()))
    labels, distance, wanted = plain_rounds(d, None, first, min(k, n), 50, best_sum(d))
    monkeypatch.setattr(medoids, "BLOCK", block)
    found, keys = medoids.exact_medoids(frame(spark, made), k)
    got = {r.key: (r.cluster, r.distance) for r in found.collect()}
    assert keys == wanted
    assert got == {i: (labels[i], pytest.approx(distance[i])) for i in range(n)}


def test_pairs_and_means(spark):
    made = some_curves(70)
    d = curves.frechet_table(list(made), list(made))
    pairs = medoids.pair_distances(frame(spark, made), block=16)
    got = {(r.a, r.b): r.distance for r in pairs.collect()}
    assert got == {(i, j): d[i, j] for i in range(70) for j in range(i + 1, 70)} and pairs.count() == len(got)
    nearest = {r.key: r.nearest for r in medoids.nearest_curves(pairs).collect()}
    assert nearest == {i: min((d[i, j], j) for j in range(70) if j != i)[1] for i in range(70)}
    labels, keys = medoids.exact_medoids(frame(spark, made), 4)
    both = pairs.union(pairs.select("b", "a", "distance"))
    of = {r.key: r.cluster for r in labels.collect()}
    for r in medoids.mean_distances(both, labels).collect():
        own = [i for i in of if of[i] == r.cluster]
        assert (r.size, r.mean_intra, r.mean_to_medoid) == (len(own), pytest.approx(d[np.ix_(own, own)].mean()), pytest.approx(d[own, keys[r.cluster]].mean()))
    assert medoids.pair_distances(frame(spark, made).limit(0)).count() == 0


def plain_first(flat, k):
    first = [int(((flat - flat.mean(0)) ** 2).sum(1).argmin())]
    while len(first) < k:
        near = np.min([((flat - flat[i]) ** 2).sum(1) for i in first], axis=0)
        near[first] = -1
        first.append(int(near.argmax()))
    return first


def test_scalable_medoids_with_room_for_all(spark):
    """Where all members are tried and judge, the rounds are those of a plain loop."""
    made = some_curves(120)
    flat = made.reshape(120, -1)
    d = curves.frechet_table(list(made), list(made))

    def renew(members, labels, now):
        if len(members) <= 2:
            return members[0]
        order = members[np.lexsort((members, ((flat[members] - flat[members].mean(0)) ** 2).sum(1)))]
        return order[np.round(d[np.ix_(order, members)].sum(1), 9).argmin()]

    labels, distance, wanted = plain_rounds(d, None, plain_first(flat, 5), 5, 50, renew)
    found, keys = medoids.scalable_medoids(frame(spark, made), 5)
    assert keys == wanted
    assert {r.key: (r.cluster, r.distance) for r in found.collect()} == {i: (labels[i], pytest.approx(distance[i])) for i in range(120)}


def test_scalable_medoids_with_few_judges(spark):
    """Each cluster has at most so many candidates and judges; every curve still gets its nearest medoid."""
    made = some_curves(300)
    d = curves.frechet_table(list(made), list(made))
    rows = frame(spark, made)
    assigned = medoids.kept(medoids._assigned(rows, [3, 50], 2), "test-assigned")
    roles = medoids._roles(assigned, [3, 50], 8, 20, 42).collect()
    for c in (0, 1):
        own = [r for r in roles if r.cluster == c]
        assert 8 <= sum(r.place is not None for r in own) <= 9 and 20 <= len(own) <= 29
    assert roles and {tuple(r) for r in medoids._roles(assigned.repartition(7), [3, 50], 8, 20, 42).collect()} == {tuple(r) for r in roles}
    found, keys = medoids.scalable_medoids(rows, 4, rounds=3, candidates=8, judges=20)
    got = {r.key: (r.cluster, r.distance) for r in found.collect()}
    assert got == {i: (d[i, keys].argmin(), pytest.approx(d[i, keys].min())) for i in range(300)}


def test_nothing_to_cluster(spark):
    for clustered in (medoids.exact_medoids, medoids.scalable_medoids):
        with pytest.raises(ValueError, match="no curves"):
            clustered(frame(spark, some_curves(10)).limit(0), 3)
