from __future__ import annotations

import json

import numpy as np
from oracle import SF_DIR
from pyspark.sql import functions as F

from helmtrack.llm import ann, chat

ROWS = "vec_id long, embedding array<float>, rank string"


def cosines(vectors: np.ndarray, queries: np.ndarray) -> np.ndarray:
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    return (queries / np.linalg.norm(queries, axis=1, keepdims=True)) @ unit.T


def test_nearest_recall_and_scores(spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    data = {r.vec_id: np.array(r.embedding, float) for r in rows.collect()}
    ids = np.array(sorted(data))
    every = np.stack([data[i] for i in ids])
    found = {}
    for r in ann.nearest(rows, F.col("vec_id") % 50 == 0, k=5).collect():
        found.setdefault(r.query_id, {})[r.rank] = (r.vec_id, r.score)
    assert set(found) == {i for i in data if i % 50 == 0}
    hits = 0
    for q, near in found.items():
        score = cosines(every, data[q][None])[0]
        score[ids == q] = -2
        best = np.lexsort((ids, -score))[:5]
        hits += len({ids[b] for b in best} & {v for v, _ in near.values()})
        assert sorted(near) == [1, 2, 3, 4, 5]
        assert all(abs(score[np.flatnonzero(ids == v)[0]] - s) < 1e-12 for v, s in near.values())
        order = [(-near[k][1], near[k][0]) for k in sorted(near)]
        assert order == sorted(order)
    assert hits >= 0.9 * 5 * len(found)


def test_vectors_that_take_no_part(spark):
    rows = [(0, [1.0, 0.0], "x"), (1, [1.0, 0.0], "x"), (2, [0.0, 0.0], "x"), (3, None, "x"), (4, [float("nan"), 1.0], "x"), (5, [None, 1.0], "x"), (50, [-1.0, 0.5], "x")]
    got = ann.nearest(spark.createDataFrame(rows, ROWS), F.col("vec_id") % 50 == 0, k=5).select("query_id", "rank", "vec_id").collect()
    assert sorted(map(tuple, got)) == [(0, 1, 1), (0, 2, 50), (50, 1, 0), (50, 2, 1)]
    assert ann.nearest(spark.createDataFrame([], ROWS), F.col("vec_id") % 50 == 0, k=5).count() == 0


def test_chat_records_are_canonical(spark):
    rows = spark.read.parquet(f"{SF_DIR}/conversations.parquet")
    found = chat.linked_turns(rows).collect()
    assert found
    for r in found:
        record = json.loads(r.record)
        assert list(record) == sorted(record) and record["id"] == r.call_id


def test_chat_of_odd_rows(spark):
    schema = spark.read.parquet(f"{SF_DIR}/conversations.parquet").schema
    assert chat.linked_turns(spark.createDataFrame([], schema)).count() == 0
    odd = [(1, 0, "user", None), (1, 1, "assistant", "orphan or answer"), (1, 3, "assistant", "no call"), (None, 1, "user", "x"), (2, 0, "user", ""), (2, 0, "user", "")]
    names = [f.name for f in schema]
    by_name = [dict(zip(("conv_id", "turn", "role", "text"), r)) for r in odd]
    got = chat.linked_turns(spark.createDataFrame([tuple(r[n] for n in names) for r in by_name], schema)).collect()
    status = {(r.conv_id, r.call_id): r.status for r in got}
    assert status == {(1, "call_0"): "invalid", (1, "call_2"): "orphan", (2, "call_0"): "pending"}
