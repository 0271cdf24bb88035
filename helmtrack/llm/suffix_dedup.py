"""Removal of repeated byte passages with suffix arrays.

A byte goes if it is covered by a string of SPAN bytes that also starts in a document with a smaller
identifier. All strings are judged on the input.

1. Every window of SPAN bytes holds REACH strings of SPAN - REACH + 1 bytes; the one of least hash is its
   anchor. Equal windows have equal anchors, and neighbouring windows mostly share one, so a chunk of
   documents sends only its distinct anchors (a few per cent of its bytes) to the bucket of their hash,
   which answers which of them other documents hold too.
2. For shared anchors, a chunk sends the passages around them: the windows of one anchor in a row, at most
   REACH of them, as one string, each distinct string once with the smallest identifier that holds it.
3. A bucket is cut into shards of passages that only need comparing among themselves. Strings that are equal are
   merged by binary search over sorted hashes and compared in full. Where an anchor has several different
   passages, a suffix array of the shard, by Larsson-Sadakane refinement, and its common prefixes, by
   Kasai's method run over all passages abreast, bring equal windows together, whatever surrounds them; the
   smallest identifier of each class answers each window.
4. The chunk covers its bytes by the windows that were answered.

Every chunk sends a distinct passage once, so a passage that very many documents share loads no bucket
with more than one entry per chunk.

Defined results: a null text is empty; its text stays null. A null identifier counts as larger than any
other. Rows of one identifier don't repeat each other. Texts shorter than SPAN bytes lose nothing. An empty
table gives an empty result. If removal splits a character, its bytes left count in kept_sha256 but are
dropped from the returned text. Columns of ``docs`` that clash with the added ones are replaced.
"""

from __future__ import annotations

import hashlib
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from helmtrack.llm.chunks import arrow_rows, bucket_bits, by_bucket, chunked, opened
from helmtrack.llm.common import pack, pack_sorted, unpack, unpack_sorted, written
from helmtrack.llm.words import mixed

SPAN = 50
#: Windows that one passage may hold, at most 32: a mask of its windows is one 32-bit integer.
REACH = 32
#: Bits of an anchor's hash beyond those of its bucket.
SPARE = 30
#: Passages of one suffix array, unless one anchor has more.
SHARD = 3000
LAST_ID = (1 << 63) - 1
_BASE = 0xD6E8FEB86659FD93


def anchors(codes: np.ndarray, span: int, bits: int) -> np.ndarray:
    """The anchor's hash of each window of ``span`` bytes. A least hash has many leading zeros, so it is mixed again
    before its leading bits choose a bucket. SPARE bits beyond the bucket's are kept: anchors that then collide
    only look shared, and their passages are compared in full."""
    k = span - REACH + 1
    grown, size = codes.astype(np.uint64) + np.uint64(1), 1
    out, done, rest = None, 0, k
    while rest:  # hashes of lengths 1, 2, 4, ... are put together to length k
        if rest & 1:
            if out is None:
                out, done = grown, size
            else:
                n = len(codes) - done - size + 1
                out = out[:n] * np.uint64(pow(_BASE, size, 1 << 64)) + grown[done : done + n]
                done += size
        rest >>= 1
        if rest:
            n = len(codes) - 2 * size + 1
            grown = grown[:n] * np.uint64(pow(_BASE, size, 1 << 64)) + grown[size : size + n]
            size *= 2
    low, width = mixed(out), 1
    n = len(low) - REACH + 1
    while width * 2 <= REACH:
        low = np.minimum(low[:-width], low[width:])
        width *= 2
    low = mixed(np.minimum(low[:n], low[REACH - width : REACH - width + n]), 51)
    return low >> _dropped(bits) << _dropped(bits)


def _dropped(bits: int) -> np.uint64:
    return np.uint64(max(0, 64 - bits - SPARE))


class Chunk:
    """A chunk's texts and the anchors of all their windows."""

    def __init__(self, payload: bytes, span: int, bits: int):
        self.table = opened(payload)
        self.ids = [LAST_ID if i is None else i for i in self.table.column("doc_id").to_pylist()]
        self.texts = [(t or "").encode() for t in self.table.column("text").to_pylist()]
        lows = [anchors(np.frombuffer(t, np.uint8), span, bits) if len(t) >= span else np.zeros(0, np.uint64) for t in self.texts]
        self.low = np.concatenate([*lows, np.zeros(0, np.uint64)])
        n = np.array([len(x) for x in lows], np.int64)
        self.doc = np.repeat(np.arange(len(lows), dtype=np.int32), n)
        self.start = np.arange(len(self.low), dtype=np.int32) - np.repeat((np.cumsum(n) - n).astype(np.int32), n)

    def distinct(self) -> tuple[np.ndarray, np.ndarray]:
        """The distinct anchors, ascending, and whether several identifiers of the chunk hold each."""
        rank = np.unique(self.ids, return_inverse=True)[1] if self.ids else np.zeros(0, np.int64)
        step = np.ones(len(self.low), bool)
        step[1:] = (self.low[1:] != self.low[:-1]) | (self.doc[1:] != self.doc[:-1])
        low, doc = self.low[step], rank[self.doc[step]]
        order = np.argsort(low, kind="stable")
        low, doc = low[order], doc[order]
        head = np.flatnonzero(np.append(True, low[1:] != low[:-1])) if len(low) else np.zeros(0, np.int64)
        several = np.minimum.reduceat(doc, head) != np.maximum.reduceat(doc, head) if len(head) else np.zeros(0, bool)
        return low[head], several


_ANCHORS = pa.schema([("bucket", pa.int64()), ("chunk", pa.int64()), ("keys", pa.binary()), ("several", pa.binary())])
_BACK = pa.schema([("chunk", pa.int64()), ("bucket", pa.int64()), ("payload", pa.binary())])


def _send_anchors(batches, span: int, bits: int):
    for batch in batches:
        for chunk, payload in zip(batch.column("chunk").to_pylist(), batch.column("payload").to_pylist()):
            keys, several = Chunk(payload, span, bits).distinct()
            rows = [(b, chunk, pack_sorted(keys[i:j] >> _dropped(bits)), np.packbits(several[i:j]).tobytes()) for b, i, j in by_bucket(keys, bits)]
            yield from arrow_rows(rows, _ANCHORS).to_batches()


def _shared(table: pa.Table) -> pa.Table:
    """For each anchor that a chunk sent: whether several documents hold it."""
    chunk, bucket = table.column("chunk").to_pylist(), table.column("bucket").to_pylist()
    keys = [unpack_sorted(k) for k in table.column("keys").to_pylist()]
    several = [np.unpackbits(np.frombuffer(s, np.uint8), count=len(k)).astype(bool) for s, k in zip(table.column("several").to_pylist(), keys)]
    _, inverse, n = np.unique(np.concatenate(keys), return_inverse=True, return_counts=True)
    found = n > 1
    found[inverse[np.concatenate(several)]] = True
    found = found[inverse]
    ends = np.cumsum([len(k) for k in keys])
    return arrow_rows([(c, b, np.packbits(found[e - len(k) : e]).tobytes()) for c, b, k, e in zip(chunk, bucket, keys, ends)], _BACK)


def _content_hash(lanes: np.ndarray) -> np.ndarray:
    """A hash of each row of bytes, whose number is a multiple of 8."""
    words = np.ascontiguousarray(lanes).view("<u8")
    out = np.zeros(len(lanes), np.uint64)
    for j in range(words.shape[1]):
        out = mixed(out + words[:, j], j)
    return out


def _lane(span: int) -> int:
    """Bytes of a passage's lane: its longest string and at least one end mark, a multiple of 8."""
    return -(-(span + REACH) // 8) * 8


def _same_as_previous(key: np.ndarray, lanes: np.ndarray) -> np.ndarray:
    same = np.zeros(len(key), bool)
    near = np.flatnonzero(key[1:] == key[:-1]) + 1
    same[near] = (lanes[near] == lanes[near - 1]).all(1)
    return same


class Passages:
    """The passages of a chunk around its shared anchors: low, lanes, windows and least of the distinct ones
    in the order of their anchors, and which of them is where (doc, start, n)."""

    def __init__(self, chunk: Chunk, answers: list[bytes], span: int, bits: int):
        keys, _ = chunk.distinct()
        counts = [j - i for _, i, j in by_bucket(keys, bits)]
        shared = [np.unpackbits(np.frombuffer(p, np.uint8), count=n).astype(bool) for p, n in zip(answers, counts)]
        wanted = keys[np.concatenate(shared)] if shared else keys[:0]
        self.any = len(wanted) > 0
        if not self.any:
            return
        at = np.flatnonzero(wanted[np.minimum(np.searchsorted(wanted, chunk.low), len(wanted) - 1)] == chunk.low)
        fresh = np.ones(len(at), bool)  # a run of windows ends with its anchor, its document, or a gap
        fresh[1:] = (np.diff(at) != 1) | (chunk.low[at[1:]] != chunk.low[at[:-1]]) | (chunk.doc[at[1:]] != chunk.doc[at[:-1]])
        head = np.flatnonzero(fresh)
        place = np.arange(len(at)) - np.repeat(head, np.diff(np.append(head, len(at))))
        head = np.flatnonzero(place % REACH == 0)
        n = np.diff(np.append(head, len(at)))
        first = at[head]
        low, doc, start = chunk.low[first], chunk.doc[first], chunk.start[first]
        data = np.frombuffer(b"".join(chunk.texts) + bytes(_lane(span)), np.uint8)
        offset = np.cumsum([0, *map(len, chunk.texts)])[doc] + start
        columns = np.arange(_lane(span))
        lanes = data[offset[:, None] + columns]
        lanes[columns >= (n + span - 1)[:, None]] = 0xFF  # no UTF-8 text holds this byte
        mark = _content_hash(lanes)
        order = np.lexsort((mark, low))
        low, mark, lanes = low[order], mark[order], lanes[order]
        self.doc, self.start, self.n = doc[order], start[order], n[order]
        repeated = _same_as_previous(mark, lanes) & np.append(False, low[1:] == low[:-1])
        self.which = np.cumsum(~repeated) - 1
        head = np.flatnonzero(~repeated)
        self.least = np.minimum.reduceat(np.array(chunk.ids, np.int64)[self.doc], head)
        self.low, self.lanes, self.windows = low[head], lanes[head], self.n[head]


def _ordered(table: pa.Table) -> tuple[list[bytes], list[bytes], list[bytes]]:
    """The payloads of a chunk's own row and of its answers to each of two questions, by bucket."""
    kinds: tuple = ([], [], [])
    for kind, bucket, payload in zip(*(table.column(c).to_pylist() for c in ("kind", "bucket", "payload"))):
        kinds[kind].append((bucket, payload))
    return tuple([p for _, p in sorted(k, key=lambda r: r[0])] for k in kinds)


def _send_passages(table: pa.Table, span: int, bits: int) -> pa.Table:
    """From a chunk and the answers to its anchors: its passages by bucket."""
    own, shared, _ = _ordered(table)
    number = table.column("chunk")[0].as_py()
    found = Passages(Chunk(own[0], span, bits), shared, span, bits)
    out = []
    for b, i, j in by_bucket(found.low, bits) if found.any else []:
        parts = (found.low[i:j].astype("<u8"), found.least[i:j].astype("<i8"), found.windows[i:j].astype("u1"), found.lanes[i:j])
        out.append((number, b, pack(np.frombuffer(b"".join(x.tobytes() for x in parts), np.uint8), thorough=True)))
    return arrow_rows(out, _BACK)


def suffix_array(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions in the order of their suffixes, and the inverse. Larsson-Sadakane: groups of equal 8-byte
    prefixes are refined by the rank of the suffix that many bytes on, with the length doubled each time;
    positions that stand alone are not looked at again. The end of the text sorts before any byte."""
    n = len(codes)
    padded = np.concatenate([codes, np.zeros(7, np.uint8)]).astype(np.uint64)
    key = np.zeros(n, np.uint64)
    for j in range(8):
        key = (key << np.uint64(8)) | padded[j : j + n]
    order = np.argsort(key, kind="stable")
    sorted_key = key[order]
    head = np.append(True, sorted_key[1:] != sorted_key[:-1])
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(head, np.arange(n), 0))
    size = 8
    while True:
        alone = head & np.append(head[1:], True)
        todo = np.flatnonzero(~alone)
        if not len(todo):
            break
        places = order[todo]
        ahead = np.where(places + size < n, rank[np.minimum(places + size, n - 1)], -1 - places)
        by = np.lexsort((ahead, rank[places]))
        places, ahead = places[by], ahead[by]
        old = rank[places]
        order[todo] = places
        fresh = np.ones(len(todo), bool)
        fresh[1:] = (old[1:] != old[:-1]) | (ahead[1:] != ahead[:-1])
        rank[places] = np.maximum.accumulate(np.where(fresh, todo, 0))
        head[todo] = fresh
        size *= 2
    place = np.empty(n, np.int64)
    place[order] = np.arange(n)
    return order, place


def common_prefixes(codes: np.ndarray, order: np.ndarray, place: np.ndarray, lane: int, windows: np.ndarray, span: int) -> tuple[np.ndarray, np.ndarray]:
    """For the i-th window of each lane (row, i): the suffix before it in the array, and whether the two have
    a common prefix of ``span`` bytes. Kasai's method: the next suffix of a lane has a common prefix at most
    one byte shorter, so each lane's length falls by one and grows by comparing on; all lanes go abreast."""
    lanes = np.arange(len(windows)) * lane
    before = np.full((len(windows), REACH), -1, np.int64)
    equal = np.zeros((len(windows), REACH), bool)
    length = np.zeros(len(windows), np.int64)
    for i in range(REACH):
        live = np.flatnonzero(windows > i)
        here = lanes[live] + i
        at = place[here]
        prior = np.where(at > 0, order[np.maximum(at - 1, 0)], -1)
        h = np.where(prior >= 0, np.maximum(length[live] - 1, 0), 0)
        going = np.flatnonzero(prior >= 0)
        while len(going):
            going = going[h[going] < span]
            going = going[codes[here[going] + h[going]] == codes[np.minimum(prior[going] + h[going], len(codes) - 1)]]
            h[going] += 1
        length[live] = h
        before[live, i] = prior
        equal[live, i] = h >= span
    return before, equal


def smallest_holders(lanes: np.ndarray, windows: np.ndarray, least: np.ndarray, span: int) -> np.ndarray:
    """For the i-th window of each passage: the smallest identifier of a passage that holds it."""
    lane = lanes.shape[1]
    codes = np.concatenate([lanes.ravel(), np.full(span, 0xFF, np.uint8)])
    order, place = suffix_array(codes)
    _, equal = common_prefixes(codes, order, place, lane, windows, span)
    row, i = np.nonzero(np.arange(REACH) < windows[:, None])
    here = place[row * lane + i]
    by = np.argsort(here)
    row, i = row[by], i[by]
    # Between two equal windows in the array there are only windows equal to both.
    head = np.flatnonzero(~equal[row, i])
    smallest = np.minimum.reduceat(least[row], head)
    out = np.full((len(lanes), REACH), LAST_ID, np.int64)
    out[row, i] = np.repeat(smallest, np.diff(np.append(head, len(row))))
    return out


def _answer(table: pa.Table, span: int) -> pa.Table:
    """For each passage that a chunk sent: the mask of windows that a smaller identifier holds too."""
    chunk, bucket = table.column("chunk").to_pylist(), table.column("bucket").to_pylist()
    lane = _lane(span)
    parts = []
    for body in table.column("payload").to_pylist():
        raw = unpack(body, np.uint8)
        m = len(raw) // (17 + lane)
        cuts = np.cumsum([0, 8 * m, 8 * m, m, lane * m])
        parts.append(tuple(raw[i:j] for i, j in zip(cuts, cuts[1:])))
    low = np.concatenate([p[0].view("<u8") for p in parts])
    least = np.concatenate([p[1].view("<i8") for p in parts])
    windows = np.concatenate([p[2] for p in parts]).astype(np.int64)
    lanes = np.concatenate([p[3].reshape(-1, lane) for p in parts])
    order = np.lexsort((_content_hash(lanes), low))
    key, rows = low[order], lanes[order]
    repeated = _same_as_previous(key, rows)
    which = np.empty(len(order), np.int64)
    which[order] = np.cumsum(~repeated) - 1
    head = np.flatnonzero(~repeated)
    smallest = np.minimum.reduceat(least[order], head)
    each, rows, key = windows[order][head], rows[head], key[head]
    held = np.repeat(smallest[:, None], REACH, 1)
    near = key[1:] == key[:-1]
    several = np.append(False, near) | np.append(near, False)
    todo = np.flatnonzero(several)
    starts = np.flatnonzero(np.append(True, key[todo][1:] != key[todo][:-1])) if len(todo) else todo
    cuts = starts[np.diff(starts // SHARD, prepend=-1) > 0]  # passages of one anchor stay together
    for part in np.split(todo, cuts[1:]) if len(todo) else []:
        held[part] = smallest_holders(rows[part], each[part], smallest[part], span)
    found = (held[which] < least[:, None]) & (np.arange(REACH) < windows[:, None])
    masks = found @ (1 << np.arange(REACH, dtype=np.int64))
    ends = np.cumsum([len(p[2]) for p in parts])
    return arrow_rows([(c, b, pack(masks[e - len(p[2]) : e].astype("<u4"))) for c, b, p, e in zip(chunk, bucket, parts, ends)], _BACK)


def _removed(table: pa.Table, span: int, bits: int, schema: pa.Schema) -> pa.Table:
    """From a chunk and the answers to its anchors and passages: its rows with the bytes removed."""
    own, shared, answers = _ordered(table)
    chunk = Chunk(own[0], span, bits)
    docs, texts = chunk.table, chunk.texts
    ends = np.cumsum([0, *map(len, texts)])
    gone = np.zeros(int(ends[-1]), bool)
    found = Passages(chunk, shared, span, bits)
    if found.any:
        masks = np.concatenate([unpack(p, "<u4") for p in answers])[found.which].astype(np.int64)
        masks[np.array(chunk.ids, np.int64)[found.doc] > found.least[found.which]] = (1 << REACH) - 1
        hit, i = np.nonzero((masks[:, None] >> np.arange(REACH) & 1).astype(bool) & (np.arange(REACH) < found.n[:, None]))
        at = ends[found.doc[hit]] + found.start[hit] + i
        change = np.bincount(at, minlength=len(gone) + 1) - np.bincount(at + span, minlength=len(gone) + 1)
        gone = np.cumsum(change)[: len(gone)] > 0
    out = []
    for k, text in enumerate(texts):
        lost = gone[ends[k] : ends[k + 1]]
        removed = int(lost.sum())
        kept = np.frombuffer(text, np.uint8)[~lost].tobytes() if removed else text
        spans = int(lost[0]) + int((lost[1:] & ~lost[:-1]).sum()) if removed else 0
        out.append((kept.decode("utf-8", "ignore"), len(text), removed, spans, hashlib.sha256(kept).hexdigest()))
    columns = {f.name: docs.column(f.name) for f in docs.schema}
    text, n_bytes, n_removed, n_spans, digest = zip(*out)
    columns |= {"text": pa.array([None if was is None else t for t, was in zip(text, docs.column("text").to_pylist())], pa.string())}
    columns |= {"n_bytes": pa.array(n_bytes, pa.int64()), "n_removed": pa.array(n_removed, pa.int64()), "n_spans": pa.array(n_spans, pa.int64()), "kept_sha256": pa.array(digest, pa.string())}
    return pa.Table.from_arrays([columns[f] for f in schema.names], names=schema.names)


ADDED = ("n_bytes", "n_removed", "n_spans", "kept_sha256")


def remove_repeats(docs: DataFrame, span: int = SPAN) -> DataFrame:
    """``docs`` with repeated passages removed from ``text``, and n_bytes, n_removed, n_spans, kept_sha256."""
    docs = docs.select(*[F.col(c).cast("long").alias(c) if c == "doc_id" else c for c in docs.columns if c not in ADDED])
    chunks = chunked(docs)
    bits = bucket_bits(chunks)
    back = "chunk long, bucket long, payload binary"
    sent = chunks.mapInArrow(partial(_send_anchors, span=span, bits=bits), "bucket long, chunk long, keys binary, several binary")
    shared = written(sent.groupBy("bucket").applyInArrow(_shared, back), "shared-anchors").withColumn("kind", F.lit(1))
    asked = chunks.select("chunk", F.lit(-1).cast("long").alias("bucket"), "payload", F.lit(0).alias("kind")).unionByName(shared)
    passages = asked.groupBy("chunk").applyInArrow(lambda t: _send_passages(t, span, bits), back)
    answers = passages.groupBy("bucket").applyInArrow(lambda t: _answer(t, span), back).withColumn("kind", F.lit(2))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    schema = f"{fields}, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    names = pa.schema([(c, pa.null()) for c in [*docs.columns, *ADDED]])
    return asked.unionByName(answers).groupBy("chunk").applyInArrow(lambda t: _removed(t, span, bits, names), schema)
