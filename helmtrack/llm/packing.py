"""Packing token sequences into windows of fixed length by non-negative least squares.

A document's tokens are cut at multiples of the window; its full pieces fill sequences of their own. What
counts for the plan is the histogram of the remaining tails, which has fewer bins than the window has
tokens. Shallow combinations of two or three tail lengths that fill a window exactly are its columns, their
repeat counts are solved by non-negative least squares, rounded within the supply, and greedily topped up.
Tails that no combination takes are laid end to end, cut where a window ends. So only the very last
sequence of that row has padding.

Tails of one length differ only in rank, so a place follows from (length, rank) by arithmetic. Ranks are
counted within (length, salt) and joined with running counts: no length is one task's work.

Defined results: a null text is empty and has the end token alone. Repeated rows are packed each. An empty
table gives an empty result. Other columns play no part.
"""

from __future__ import annotations

import zlib
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from helmtrack.llm.bpe import coder
from helmtrack.llm.common import written

#: Lengths that may complete a combination of three.
FILLERS = 16
#: Steps of the multiplicative update that solves the least squares.
STEPS = 300
#: Rows of one length and salt, and the most salts.
SALT_ROWS, SALTS = 256, 4096


def combinations(histogram: np.ndarray, window: int) -> np.ndarray:
    """Triples of lengths (0: none) that fill the window, over lengths that occur: all pairs, all with two
    equal lengths, and all with one of the most frequent lengths."""
    lengths = np.arange(1, window)
    pairs = np.stack([lengths, window - lengths, np.zeros_like(lengths)], 1)
    twins = np.stack([lengths, lengths, window - 2 * lengths], 1)
    fillers = np.argsort(-histogram, kind="stable")[:FILLERS]
    a, f = np.meshgrid(lengths, fillers)
    mixed = np.stack([a.ravel(), f.ravel(), window - a.ravel() - f.ravel()], 1)
    every = np.sort(np.concatenate([pairs, twins[twins[:, 2] > 0], mixed[(mixed > 0).all(1)]]), 1)[:, ::-1]
    every = np.unique(every, axis=0)
    supply = histogram.copy()
    supply[0] = 1
    return every[(supply[every] > 0).all(1)]


def solve(histogram: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Combinations and how often each is used; the supply of no length is exceeded."""
    columns = combinations(histogram, window)
    if not len(columns):
        return columns, np.zeros(0, np.int64)
    want = histogram.astype(float)
    want[0] = 0.0

    def product(x):
        total = np.bincount(columns.ravel(), np.repeat(x, 3), minlength=window)
        total[0] = 0.0
        return total

    x = want[columns].sum(1) / 3.0 + 1e-9
    target = want[columns].sum(1)
    for _ in range(STEPS):
        x *= target / np.maximum(product(x)[columns].sum(1), 1e-12)
    left = histogram.astype(np.int64)
    left[0] = np.iinfo(np.int64).max
    used = np.zeros(len(columns), np.int64)
    for wanted in (np.rint(x).astype(np.int64), np.full(len(columns), left[1:].sum())):  # the second: greedy topping up
        for j in np.argsort(-x, kind="stable"):
            need = {n: int((columns[j] == n).sum()) for n in columns[j].tolist() if n}
            if r := min([int(wanted[j]), *(int(left[n]) // m for n, m in need.items())]):
                used[j] += r
                for n, m in need.items():
                    left[n] -= r * m
    return columns[used > 0], used[used > 0]


class Plan:
    """Where the tail of each (length, rank) goes. Its arrays are bounded by the window."""

    def __init__(self, histogram: np.ndarray, window: int):
        self.window, self.histogram = window, histogram
        columns, used = solve(histogram, window)
        first = np.cumsum(np.append(0, used))
        self.whole = int(first[-1])  # sequences that combinations fill
        taken = np.zeros(window, np.int64)
        spans = []
        for lengths, n, base in zip(columns.tolist(), used.tolist(), first.tolist()):
            offset = 0
            for length in filter(None, lengths):
                spans.append((length, int(taken[length]), base, offset))
                taken[length] += n
                offset += length
        spans.sort()
        self.spans = np.array(spans, np.int64).reshape(-1, 4)
        self.taken = taken
        rest = (histogram - taken) * np.arange(window)
        rest[0] = 0
        self.base = np.cumsum(rest) - rest
        self.loose = -(-int(rest.sum()) // window)  # sequences of tails laid end to end

    def place(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sequence and offset of each tail's first token; a tail may go on in the next sequence."""
        sequence, offset = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
        planned = rank < self.taken[length]
        if planned.any():
            keys = self.spans[:, 0] << 44 | self.spans[:, 1]
            at = np.searchsorted(keys, length[planned] << 44 | rank[planned], "right") - 1
            sequence[planned] = self.spans[at, 2] + rank[planned] - self.spans[at, 1]
            offset[planned] = self.spans[at, 3]
        loose = ~planned
        position = self.base[length[loose]] + (rank[loose] - self.taken[length[loose]]) * length[loose]
        sequence[loose], offset[loose] = self.whole + position // self.window, position % self.window
        return sequence, offset


def _crc(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())


def _tokenised(batches, tokenizer: str, end_id: int, window: int, kind: str):
    bpe = coder(tokenizer)
    for batch in batches:
        rows = []
        for coded in bpe.encode_many([(t or "").encode() for t in batch.column("text").to_pylist()]):
            ids = np.append(np.frombuffer(coded, "<u4"), np.uint32(end_id))
            full = len(ids) // window
            tail = ids[full * window :]
            rows.append((len(ids), full, [_crc(ids[k * window : (k + 1) * window]) for k in range(full)], len(tail), _crc(tail), tail.astype(kind).tobytes()))
        types = (pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.int64(), pa.int64(), pa.binary())
        columns = [pa.array(list(c), t) for c, t in zip(zip(*rows) if rows else [[]] * 6, types)]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], names=["doc_id", "doc_tokens", "full", "full_crc32", "tail_length", "tail_crc32", "tail"])


def tokenised(docs: DataFrame, tokenizer: str, end_id: int, window: int) -> DataFrame:
    """Per document: its number of tokens with the end token, checksums of its full pieces, and its tail.
    Written to the shared folder, since histogram and placement both read it."""
    kind = "<u2" if Tokenizer.from_file(tokenizer).get_vocab_size() <= 65536 else "<u4"
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        partial(_tokenised, tokenizer=tokenizer, end_id=end_id, window=window, kind=kind),
        "doc_id long, doc_tokens long, full long, full_crc32 array<long>, tail_length long, tail_crc32 long, tail binary",
    )
    return written(rows, "tokenised").withColumn("kind", F.lit(kind))


def _placed(batches, plan: Plan):
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    window, above = plan.window, plan.whole + plan.loose
    for batch in batches:
        table = {c: batch.column(c).to_pylist() for c in ("doc_id", "doc_tokens", "full", "full_crc32", "tail_crc32", "tail", "kind", "full_before")}
        length, rank = (batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("tail_length", "rank"))
        sequence, offset = plan.place(length, rank)
        out = []
        for i, (doc, total, full, crcs, crc, tail, kind, before) in enumerate(zip(*table.values())):
            out += [(doc, k * window, window, crcs[k], total, above + before + k, 0) for k in range(full)]
            start, n, s, o = full * window, int(length[i]), int(sequence[i]), int(offset[i])
            if n and o + n <= window:
                out.append((doc, start, n, crc, total, s, o))
            elif n:
                ids, cut = np.frombuffer(tail, kind), window - o
                out.append((doc, start, cut, _crc(ids[:cut]), total, s, o))
                out.append((doc, start + cut, n - cut, _crc(ids[cut:]), total, s + 1, 0))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(list(c), pa.int64()) for c in zip(*out)], names=names)


def pack(docs: DataFrame, tokenizer: str, end_id: int = 1, window: int = 2048) -> DataFrame:
    """Pieces of all documents: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    pieces = tokenised(docs, tokenizer, end_id, window)
    counted = pieces.groupBy("tail_length").agg(F.count("*").alias("n"), F.sum("full").alias("full")).collect()  # at most one row a length
    histogram = np.zeros(window, np.int64)
    for row in counted:
        histogram[row["tail_length"]] = row["n"]
    plan = Plan(histogram, window)
    salts = int(min(SALTS, max(1, -(-int(histogram.max()) // SALT_ROWS))))
    salted = pieces.withColumn("salt", F.pmod(F.xxhash64("doc_id", "tail_crc32"), F.lit(salts)))
    within = Window.partitionBy("tail_length", "salt").orderBy("doc_id", "tail_crc32", "doc_tokens")
    before = within.rowsBetween(Window.unboundedPreceding, -1)
    ranked = salted.withColumns({"place": F.row_number().over(within) - 1, "full_here": F.coalesce(F.sum("full").over(before), F.lit(0))})
    order = Window.partitionBy("tail_length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    sums = salted.groupBy("tail_length", "salt").agg(F.count("*").alias("n"), F.sum("full").alias("full"))
    sums = sums.select("tail_length", "salt", F.coalesce(F.sum("n").over(order), F.lit(0)).alias("rank_base"), F.coalesce(F.sum("full").over(order), F.lit(0)).alias("full_base"))
    full = np.zeros(window, np.int64)
    for row in counted:
        full[row["tail_length"]] = row["full"]
    earlier = F.element_at(F.array(*[F.lit(int(x)) for x in np.cumsum(full) - full]), (F.col("tail_length") + 1).cast("int"))
    located = ranked.join(sums, ["tail_length", "salt"]).withColumns({"rank": F.col("rank_base") + F.col("place"), "full_before": F.col("full_base") + F.col("full_here") + earlier})
    located = located.select("doc_id", "doc_tokens", "full", "full_crc32", "tail_length", "tail_crc32", "tail", "kind", "rank", "full_before")
    return located.mapInArrow(partial(_placed, plan=plan), "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")
