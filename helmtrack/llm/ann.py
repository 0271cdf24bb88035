"""Approximate nearest neighbours by NN-descent and greedy graph search, under cosine similarity.

Vectors are dealt to buckets by a hash of their identifier. The graph starts from the nearest pairs of
buckets under a few such deals and is refined by rounds of two joins. First, every vector goes to a sample of its neighbours, so
that those who share a neighbour meet there. Where they meet they are compared, if one of them came by a new
edge, and the best finds for each go back to it and into its list. All exchanges are rows of packed arrays
between buckets: a bucket's work is bounded, and no vector sits in more than a bounded sample of meetings.

A query starts from its own list in the graph. Each step looks up the neighbours, both ways, of the best
vectors that it has not yet looked at, has the unseen ones compared where they are kept, and keeps a pool of
the best. The pool's best are compared again in double precision on the original vectors.

Equal vectors are one vertex; each keeps its smallest identifiers, as many as a query can ask for.

Defined results: vectors that are null, zero, or hold null or non-finite components take no part, nor do
rows with a null identifier or with another length than most vectors have. Of rows that share an identifier
one takes part. Ties in score go to the smaller identifier. A query with fewer than k candidates gets all. An
empty table gives an empty result. Other columns play no part.
"""

from __future__ import annotations

import pickle
from functools import partial

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from helmtrack.llm.common import written
from helmtrack.llm.words import mixed

#: Vertices of a bucket; neighbours kept; edges sampled of each age; visitors of a meeting of each age;
#: finds that go back to a visitor; rounds.
BUCKET, NEIGHBOURS, SAMPLE, VISITORS, FINDS, ROUNDS = 512, 24, 12, 24, 8, 7
#: Deals of the vertices into buckets whose nearest pairs start the graph.
DEALS = 3
#: Vertices that a query looks up at a time, at most, and the size of its pool; steps; queries in a row.
LOOKUPS, POOL, STEPS, QUERIES = 96, 512, 7, 64

FIELDS = "bucket long, kind int, payload binary"
_ROWS = pa.schema([("bucket", pa.int64()), ("kind", pa.int32()), ("payload", pa.binary())])


def _dump(*arrays) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(pickle.dumps(arrays, protocol=5))


def _load(payload: bytes) -> tuple:
    return pickle.loads(zstandard.ZstdDecompressor().decompress(payload))


def _rows(rows: list[tuple]) -> pa.Table:
    return pa.Table.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*rows) if rows else [[]] * 3, _ROWS)], schema=_ROWS)


def _kinds(table: pa.Table) -> dict[int, list]:
    """A group's payloads by kind, in an order that doesn't depend on their arrival."""
    found: dict[int, list] = {}
    for kind, payload in sorted(zip(table.column("kind").to_pylist(), table.column("payload").to_pylist())):
        found.setdefault(kind, []).append(_load(payload))
    return found


def _bucket_of(ids: np.ndarray, buckets: int, deal: int = 0) -> np.ndarray:
    return (mixed(ids.astype(np.int64).view(np.uint64), 41 + 10 * deal) % np.uint64(buckets)).astype(np.int64)


def _split(to: np.ndarray):
    """(bucket, positions) for each bucket that occurs."""
    order = np.argsort(to, kind="stable")
    cuts = np.flatnonzero(np.append(True, to[order][1:] != to[order][:-1])) if len(to) else []
    for part in np.split(order, cuts[1:]) if len(to) else []:
        yield int(to[part[0]]), part


def _small(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Vectors in 8 bits with a scale each, for the comparisons that build the graph."""
    scale = np.maximum(np.abs(vectors).max(1), 1e-30) / 127
    return np.rint(vectors / scale[:, None]).astype(np.int8), scale.astype(np.float32)


def _drawn(ids: np.ndarray, near: np.ndarray, marks: np.ndarray, turn: int) -> np.ndarray:
    """Which edges are sampled this round: up to SAMPLE of those with the mark, by a hash."""
    lot = mixed(near.view(np.uint64) * np.uint64(2) + mixed(ids.view(np.uint64), 43)[:, None], turn)
    lot = np.where(marks & (near >= 0), lot >> np.uint64(1), np.uint64(1) << np.uint64(63))
    order = np.argsort(lot, axis=1, kind="stable")[:, :SAMPLE]
    out = np.zeros(near.shape, bool)
    np.put_along_axis(out, order, True, 1)
    return out & marks & (near >= 0)


def _best(owner: np.ndarray, other: np.ndarray, score: np.ndarray, k: int, prefer: np.ndarray | None = None) -> np.ndarray:
    """Positions of the k best of each owner, each other one once, best first; ``prefer`` breaks repeats."""
    prefer = np.zeros(len(owner), np.int8) if prefer is None else prefer
    order = np.lexsort((prefer, other, owner))
    fresh = np.ones(len(order), bool)
    fresh[1:] = (owner[order][1:] != owner[order][:-1]) | (other[order][1:] != other[order][:-1])
    order = order[fresh]
    order = order[np.lexsort((other[order], -score[order], owner[order]))]
    start = np.flatnonzero(np.append(True, owner[order][1:] != owner[order][:-1])) if len(order) else np.zeros(0, np.int64)
    rank = np.arange(len(order)) - np.repeat(start, np.diff(np.append(start, len(order))))
    return order[rank < k]


def _vertices(table: pa.Table, width: int) -> pa.Table:
    ids = table.column("id").to_numpy()
    vectors = np.array(table.column("vector").to_pylist(), np.float32).reshape(len(ids), width)
    order = np.argsort(ids, kind="stable")
    return _rows([(table.column("bucket")[0].as_py(), 0, _dump(ids[order], vectors[order]))])


def _started(batches):
    """A bucket's first graph: the nearest of its own vertices."""
    for batch in batches:
        out = []
        for bucket, payload in zip(batch.column("bucket").to_pylist(), batch.column("payload").to_pylist()):
            ids, vectors = _load(payload)
            scores = vectors @ vectors.T
            np.fill_diagonal(scores, -9)
            near, score = np.full((len(ids), NEIGHBOURS), -1, np.int64), np.full((len(ids), NEIGHBOURS), -9, np.float32)
            k = min(NEIGHBOURS, len(ids) - 1)
            order = np.argsort(-scores, axis=1, kind="stable")[:, :k]
            near[:, :k], score[:, :k] = ids[order], np.take_along_axis(scores, order, 1)
            out.append((bucket, 1, _dump(ids, near, score, near >= 0)))
        yield from _rows(out).to_batches()


def _introduced(table: pa.Table, buckets: int) -> pa.Table:
    """The nearest pairs of a bucket of another deal, on their way to the vertices' own buckets: they connect
    the first graphs of the buckets."""
    ids, vectors = _kinds(table)[0][0]
    scores = vectors @ vectors.T
    np.fill_diagonal(scores, -9)
    k = min(SAMPLE, len(ids) - 1)
    order = np.argsort(-scores, axis=1, kind="stable")[:, :k]
    owner, other, score = np.repeat(ids, k), ids[order].ravel(), np.take_along_axis(scores, order, 1).ravel()
    return _rows([(b, 3, _dump(owner[at], other[at], score[at])) for b, at in _split(_bucket_of(owner, buckets))])


def _visits(table: pa.Table, turn: int, buckets: int) -> pa.Table:
    """A bucket's vectors on their way to sampled neighbours, in a table for each bucket visited."""
    kinds = _kinds(table)
    (_, vectors), (ids, near, score, new) = kinds[0][0], kinds[1][0]
    small, scale = _small(vectors)
    fresh, old = _drawn(ids, near, new, turn), _drawn(ids, near, ~new, turn)
    row, column = np.nonzero(fresh | old)
    host, is_new, bar = near[row, column], fresh[row, column], score[:, -1]
    out = []
    for bucket, at in _split(_bucket_of(host, buckets)):
        who, place = np.unique(row[at], return_inverse=True)
        out.append((bucket, 2, _dump(ids[who], small[who], scale[who], bar[who], host[at], place.astype(np.int32), is_new[at])))
    return _rows(out)


def _meetings(table: pa.Table, turn: int, buckets: int) -> pa.Table:
    """At each vertex: its visitors and itself compared, and the finds for each on their way to it."""
    kinds = _kinds(table)
    if 0 not in kinds or 2 not in kinds:
        return _rows([])
    ids, vectors = kinds[0][0]
    offsets = np.cumsum([0, *(len(v[0]) for v in kinds[2])])
    guests = np.concatenate([*(v[0] for v in kinds[2]), ids])
    coded = np.concatenate([v[1] * v[2][:, None] for v in kinds[2]] + [vectors]).astype(np.float32)
    bar = np.concatenate([*(v[3] for v in kinds[2]), np.full(len(ids), -9, np.float32)])
    host = np.searchsorted(ids, np.concatenate([v[4] for v in kinds[2]]))
    guest = np.concatenate([v[5] + o for v, o in zip(kinds[2], offsets)]).astype(np.int64)
    new = np.concatenate([v[6] for v in kinds[2]])
    lot = mixed(guests[guest].view(np.uint64) + mixed(ids[host].view(np.uint64), 44), turn)
    width = 2 * VISITORS + 1
    members = np.full((len(ids), width), -1, np.int64)
    for side, age in enumerate((new, ~new)):
        at = np.flatnonzero(age)
        at = at[np.lexsort((lot[at], host[at]))]
        start = np.searchsorted(host[at], np.arange(len(ids)))
        rank = np.arange(len(at)) - start[host[at]]
        at, rank = at[rank < VISITORS], rank[rank < VISITORS]
        members[host[at], side * VISITORS + rank] = guest[at]
    members[:, -1] = offsets[-1] + np.arange(len(ids))
    young = np.zeros(width, bool)
    young[:VISITORS] = True
    owner, other, score = [], [], []
    for start in range(0, len(ids), 64):
        group = members[start : start + 64]
        x = coded[np.maximum(group, 0)]
        s = np.matmul(x, x.transpose(0, 2, 1))
        named = guests[np.maximum(group, 0)]
        no = (group < 0)[:, :, None] | (group < 0)[:, None, :] | (named[:, :, None] == named[:, None, :]) | ~(young[:, None] | young[None, :])
        s[no | (s <= bar[np.maximum(group, 0)][:, :, None])] = -9
        top = np.argpartition(-s, FINDS, axis=2)[:, :, :FINDS]
        value = np.take_along_axis(s, top, 2)
        g, i, j = np.nonzero(value > -9)
        owner.append(named[g, i])
        other.append(named[g, top[g, i, j]])
        score.append(value[g, i, j])
    owner, other, score = (np.concatenate(v) for v in (owner, other, score))
    keep = _best(owner, other, score, NEIGHBOURS)
    owner, other, score = owner[keep], other[keep], score[keep]
    return _rows([(b, 3, _dump(owner[at], other[at], score[at])) for b, at in _split(_bucket_of(owner, buckets))])


def _merged(table: pa.Table, turn: int) -> pa.Table:
    """A bucket's lists with the finds that came in; edges sampled this round are no longer new."""
    kinds = _kinds(table)
    ids, near, score, new = kinds[1][0]
    new = new & ~_drawn(ids, near, new, turn) if turn >= 0 else new
    finds = kinds.get(3, [])
    row = np.concatenate([np.repeat(np.arange(len(ids)), NEIGHBOURS), *(np.searchsorted(ids, f[0]) for f in finds)])
    other = np.concatenate([near.ravel(), *(f[1] for f in finds)])
    value = np.concatenate([score.ravel(), *(f[2] for f in finds)])
    fresh = np.concatenate([new.ravel(), *(np.ones(len(f[0]), bool) for f in finds)])
    come = np.concatenate([np.zeros(near.size, np.int8), *(np.ones(len(f[0]), np.int8) for f in finds)])
    real = np.flatnonzero(other >= 0)
    at = real[_best(row[real], other[real], value[real], NEIGHBOURS, come[real])]
    start = np.searchsorted(row[at], np.arange(len(ids)))
    place = np.arange(len(at)) - start[row[at]]
    near, score, new = np.full(near.shape, -1, np.int64), np.full(score.shape, -9, np.float32), np.zeros(new.shape, bool)
    near[row[at], place], score[row[at], place], new[row[at], place] = other[at], value[at], fresh[at]
    return _rows([(table.column("bucket")[0].as_py(), 1, _dump(ids, near, score, new))])


def _reversed(batches, buckets: int):
    """Edges on their way to their end vertex, for the lookups both ways."""
    for batch in batches:
        for payload in batch.column("payload").to_pylist():
            ids, near, _, _ = _load(payload)
            row, column = np.nonzero(near >= 0)
            end = near[row, column]
            yield from _rows([(b, 4, _dump(end[at], ids[row[at]])) for b, at in _split(_bucket_of(end, buckets))]).to_batches()


def _adjacent(table: pa.Table) -> pa.Table:
    """A bucket's vertices with their neighbours both ways, sorted by vertex."""
    kinds = _kinds(table)
    ids, near, _, _ = kinds[1][0]
    row, column = np.nonzero(near >= 0)
    one = np.concatenate([ids[row], *(k[0] for k in kinds.get(4, []))])
    two = np.concatenate([near[row, column], *(k[1] for k in kinds.get(4, []))])
    pairs = np.unique(np.stack([one, two]), axis=1)
    return _rows([(table.column("bucket")[0].as_py(), 5, _dump(pairs[0], pairs[1]))])


def _asked(table: pa.Table) -> pa.Table:
    """The queries of a bucket of queries: vectors, own identifiers, and their lists as first pools."""
    kinds = _kinds(table)
    keys = np.concatenate([k[0] for k in kinds[6]])
    vectors = np.concatenate([k[1] for k in kinds[6]])
    near, score = np.concatenate([k[2] for k in kinds[6]]), np.concatenate([k[3] for k in kinds[6]])
    order = np.argsort(keys, kind="stable")
    pools = [(n[n >= 0], s[n >= 0], np.zeros((n >= 0).sum(), bool)) for n, s in zip(near[order], score[order])]
    seen = [np.sort(np.append(p[0], k)) for p, k in zip(pools, keys[order])]
    return _rows([(table.column("bucket")[0].as_py(), 7, _dump(keys[order], vectors[order], pools, seen))])


def _frontier(pool: tuple) -> np.ndarray:
    """Positions in a pool, best first, of the vertices to look up next."""
    return np.flatnonzero(~pool[2])[:LOOKUPS]


def _looked_up(batches, buckets: int):
    for batch in batches:
        for bucket, payload in zip(batch.column("bucket").to_pylist(), batch.column("payload").to_pylist()):
            pools = _load(payload)[2]
            picked = [p[0][_frontier(p)] for p in pools]
            query, vertex = np.repeat(np.arange(len(pools)), [len(p) for p in picked]), np.concatenate([*picked, np.zeros(0, np.int64)])
            yield from _rows([(b, 8, _dump(bucket, query[at], vertex[at])) for b, at in _split(_bucket_of(vertex, buckets))]).to_batches()


def _neighbours(table: pa.Table) -> pa.Table:
    """The neighbours of the vertices looked up, on their way to the queries."""
    kinds = _kinds(table)
    if 5 not in kinds:
        return _rows([])
    one, two = kinds[5][0]
    out = []
    for bucket, query, vertex in kinds.get(8, []):
        low, high = np.searchsorted(one, vertex, "left"), np.searchsorted(one, vertex, "right")
        n = high - low
        at = np.repeat(low - (np.cumsum(n) - n), n) + np.arange(n.sum())
        found = np.unique(np.stack([np.repeat(query, n), two[at]]), axis=1)
        out.append((bucket, 9, _dump(found[0].astype(np.int32), found[1])))
    return _rows(out)


def _unseen(table: pa.Table, buckets: int) -> pa.Table:
    """A bucket of queries marks what it looked up, and sends its unseen candidates with its vectors."""
    kinds = _kinds(table)
    bucket = table.column("bucket")[0].as_py()
    keys, vectors, pools, seen = kinds[7][0]
    for p in pools:
        p[2][_frontier(p)] = True
    query = np.concatenate([np.zeros(0, np.int32), *(k[0] for k in kinds.get(9, []))])
    other = np.concatenate([np.zeros(0, np.int64), *(k[1] for k in kinds.get(9, []))])
    wanted_q, wanted = [], []
    order = np.argsort(query, kind="stable")
    query, other = query[order], other[order]
    cuts = np.searchsorted(query, np.arange(len(pools) + 1))
    for q in range(len(pools)):
        fresh = np.setdiff1d(other[cuts[q] : cuts[q + 1]], seen[q])
        seen[q] = np.union1d(seen[q], fresh)
        wanted.append(fresh)
        wanted_q.append(np.full(len(fresh), q, np.int32))
    wanted, wanted_q = np.concatenate(wanted), np.concatenate(wanted_q)
    bar = np.array([p[1][POOL - 1] if len(p[1]) >= POOL else -9 for p in pools], np.float32)
    out = [(bucket, 7, _dump(keys, vectors, pools, seen))]
    for b, at in _split(_bucket_of(wanted, buckets)):
        who, place = np.unique(wanted_q[at], return_inverse=True)
        out.append((b, 10, _dump(bucket, who, vectors[who], bar[who], place.astype(np.int32), wanted[at])))
    return _rows(out)


def _compared(table: pa.Table) -> pa.Table:
    """Candidates compared where their vectors are kept; those that can enter the pool go back."""
    kinds = _kinds(table)
    if 0 not in kinds:
        return _rows([])
    ids, vectors = kinds[0][0]
    out = []
    for bucket, who, query, bar, place, wanted in kinds.get(10, []):
        score = np.einsum("ij,ij->i", vectors[np.searchsorted(ids, wanted)], query[place])
        good = score > bar[place]
        out.append((bucket, 11, _dump(who[place[good]], wanted[good], score[good].astype(np.float32))))
    return _rows(out)


def _pooled(table: pa.Table) -> pa.Table:
    kinds = _kinds(table)
    keys, vectors, pools, seen = kinds[7][0]
    finds = kinds.get(11, [])
    query = np.concatenate([np.zeros(0, np.int32), *(f[0] for f in finds)])
    other, score = np.concatenate([np.zeros(0, np.int64), *(f[1] for f in finds)]), np.concatenate([np.zeros(0, np.float32), *(f[2] for f in finds)])
    order = np.argsort(query, kind="stable")
    cuts = np.searchsorted(query[order], np.arange(len(pools) + 1))
    for q, p in enumerate(pools):
        at = order[cuts[q] : cuts[q + 1]]
        names, values = np.concatenate([p[0], other[at]]), np.concatenate([p[1], score[at]])
        done = np.concatenate([p[2], np.zeros(len(at), bool)])
        best = np.lexsort((names, -values))[:POOL]
        pools[q] = (names[best], values[best], done[best])
    return _rows([(table.column("bucket")[0].as_py(), 7, _dump(keys, vectors, pools, seen))])


def _listed(batches, many: int):
    """The best of each pool: (query vertex, candidate vertex)."""
    for batch in batches:
        for payload in batch.column("payload").to_pylist():
            keys, _, pools, _ = _load(payload)
            n = [min(many, len(p[0])) for p in pools]
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(keys, n)), pa.array(np.concatenate([*(p[0][:many] for p in pools), np.zeros(0, np.int64)]))], names=["vertex", "other"])


def nearest(rows: DataFrame, is_query, k: int = 5, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """For each row with ``is_query`` (a Column): its k nearest other rows found, as query_id, rank, vec_id,
    score."""
    usable = F.col(key).isNotNull() & F.col(vector).isNotNull() & F.forall(vector, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))) & F.exists(vector, lambda v: v != 0)
    clean = rows.where(F.coalesce(usable, F.lit(False))).select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("original"), F.coalesce(is_query, F.lit(False)).alias("asks"))
    width = clean.groupBy(F.size("original").alias("w")).count().orderBy(F.desc("count"), "w").first()
    if width is None:
        return rows.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    clean = clean.where(F.size("original") == width["w"]).dropDuplicates(["id"])
    # One vertex for equal vectors; groups are first reduced by a salt, then as a whole, to k + 1 identifiers.
    lowest = lambda c: F.slice(F.array_sort(c), 1, k + 1)
    salted = clean.groupBy("original", F.pmod(F.xxhash64("id"), F.lit(64)).alias("salt")).agg(lowest(F.collect_list("id")).alias("ids"))
    classes = salted.groupBy("original").agg(lowest(F.flatten(F.collect_list("ids"))).alias("ids")).withColumn("vertex", F.col("ids")[0])
    classes = written(classes, "vectors")
    total = classes.count()
    buckets = max(1, -(-total // BUCKET))
    norm = F.sqrt(F.aggregate("original", F.lit(0.0), lambda s, v: s + v * v))

    def dealt(deal):
        def run(batches):
            for batch in batches:
                where = pa.array(_bucket_of(batch.column("id").to_numpy(), buckets, deal))
                yield pa.RecordBatch.from_arrays([where, batch.column("id"), batch.column("vector")], names=["bucket", "id", "vector"])

        rows = unit.mapInArrow(run, "bucket long, id long, vector array<float>")
        return rows.groupBy("bucket").applyInArrow(lambda t: _vertices(t, width["w"]), FIELDS)

    unit = classes.select(F.col("vertex").alias("id"), F.transform("original", lambda v: (v / norm).cast("float")).alias("vector"))
    base = written(dealt(0), "vertices")
    graph = base.mapInArrow(_started, FIELDS)

    def by_bucket(df, function, *arguments):
        return df.groupBy("bucket").applyInArrow(lambda table: function(table, *arguments), FIELDS)

    for deal in range(1, DEALS):
        graph = graph.union(by_bucket(dealt(deal), _introduced, buckets))
    graph = written(by_bucket(graph, _merged, -1), "graph")
    for turn in range(ROUNDS):
        visits = by_bucket(base.union(graph), _visits, turn, buckets)
        finds = by_bucket(base.union(visits), _meetings, turn, buckets)
        graph = written(by_bucket(graph.union(finds), _merged, turn), "graph")
    adjacent = written(by_bucket(graph.union(graph.mapInArrow(partial(_reversed, buckets=buckets), FIELDS)), _adjacent), "adjacent")

    # Queries: the vertices of rows that ask, QUERIES in a bucket of their own.
    asking = clean.where("asks").select("id", "original").join(classes.select("original", "vertex", "ids"), "original")
    asking = written(asking.select("id", "vertex"), "asking")
    groups = max(1, -(-asking.select("vertex").distinct().count() // QUERIES))
    wanted = asking.select("vertex").distinct().mapInArrow(partial(_placed_queries, buckets=buckets), FIELDS)
    first = by_bucket(base.union(graph).union(wanted), _first_pools, groups)
    queries = written(by_bucket(first, _asked), "queries")
    for _ in range(STEPS):
        looked = queries.mapInArrow(partial(_looked_up, buckets=buckets), FIELDS)
        near = by_bucket(adjacent.union(looked), _neighbours)
        unseen = written(by_bucket(queries.union(near), _unseen, buckets), "unseen")
        scored = by_bucket(base.union(unseen.where("kind = 10")), _compared)
        queries = written(by_bucket(unseen.where("kind = 7").union(scored), _pooled), "queries")
    pairs = queries.mapInArrow(partial(_listed, many=4 * k + 12), "vertex long, other long")
    return _ranked(pairs, asking, classes, k)


def _placed_queries(batches, buckets: int):
    for batch in batches:
        ids = batch.column("vertex").to_numpy()
        yield from _rows([(b, 12, _dump(np.sort(ids[at]))) for b, at in _split(_bucket_of(ids, buckets))]).to_batches()


def _first_pools(table: pa.Table, groups: int) -> pa.Table:
    """A bucket's query vertices with their vectors and lists, on their way to buckets of queries."""
    kinds = _kinds(table)
    if 12 not in kinds:
        return _rows([])
    (ids, vectors), (_, near, score, _) = kinds[0][0], kinds[1][0]
    wanted = np.unique(np.concatenate([k[0] for k in kinds[12]]))
    at = np.searchsorted(ids, wanted)
    return _rows([(b, 6, _dump(wanted[p], vectors[at[p]], near[at[p]], score[at[p]])) for b, p in _split(_bucket_of(wanted, groups))])


def _ranked(pairs: DataFrame, asking: DataFrame, classes: DataFrame, k: int) -> DataFrame:
    """Exact scores of the vertices found, spread to their identifiers, and the k best of each query."""
    own = asking.select("vertex").distinct().select("vertex", F.col("vertex").alias("other"))
    found = pairs.union(own).distinct()  # a query's equals are its nearest
    one = classes.select("vertex", F.col("original").alias("a"))
    two = classes.select(F.col("vertex").alias("other"), F.col("original").alias("b"), "ids")
    both = found.join(one, "vertex").join(two, "other")
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p * q), F.lit(0.0), lambda s, v: s + v)
    score = dot(F.col("a"), F.col("b")) / (F.sqrt(dot(F.col("a"), F.col("a"))) * F.sqrt(dot(F.col("b"), F.col("b"))))
    scored = both.select("vertex", score.alias("score"), "ids")
    best = scored.withColumn("_rank", F.row_number().over(Window.partitionBy("vertex").orderBy(F.desc("score"), F.col("ids")[0]))).where(F.col("_rank") <= 2 * k + 2)
    each = asking.select(F.col("id").alias("query_id"), "vertex").join(best, "vertex").select("query_id", "score", F.explode("ids").alias("vec_id")).where("vec_id <> query_id")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return each.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
