"""The greedy choice of diverse trajectories against plain Python, over all candidates of a group."""

from __future__ import annotations

import random

import numpy as np

from helmtrack.plans import registry, trace_queries


def test_diverse_goes_through_every_candidate(spark, monkeypatch):
    """Sixty near copies come first by score; farther trajectories are still found."""
    rng = random.Random(3)
    rows = [(i, 1, [0.01 * rng.random() for _ in range(8)]) for i in range(60)]
    rows += [(100 + i, 1, [0.4 * (i - 4) + 0.01 * rng.random() for _ in range(8)]) for i in range(9)]
    rows += [(200 + i, 2, [rng.uniform(-1, 1) for _ in range(8)]) for i in range(50)] + [(300, None, [1.0] * 8)]
    monkeypatch.setattr(trace_queries, "traces", lambda s, _: s.createDataFrame(rows, "vec_id long, label int, trace array<double>").repartition(3))
    wanted = set()
    for label in (1, 2):
        traces = {i: np.array(t) for i, at, t in rows if at == label}
        mean = np.mean(list(traces.values()), axis=0)
        points = {i: np.stack([(0.5 + abs(t)).cumsum(), t.cumsum()], 1) for i, t in traces.items()}
        kept = []
        for i in sorted(traces, key=lambda i: (((traces[i] - mean) ** 2).sum(), i)):
            if len(kept) < 5 and all(np.linalg.norm(points[i] - points[j], axis=1).mean() >= 1.0 for j in kept):
                kept.append(i)
        wanted |= {(label, i, n + 1) for n, i in enumerate(kept)}
    got = {(r.label, r.vec_id, r["rank"]) for r in registry.QUERIES["t6_diverse"](spark, "").collect()}
    assert got == wanted
    assert sum(label == 1 for label, *_ in got) == 5
