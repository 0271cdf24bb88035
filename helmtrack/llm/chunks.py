"""Documents in chunks of bounded size, and hashed keys exchanged between chunks and buckets.

A job over sub-document keys (n-grams, byte windows) would shuffle a row for each key. Here a chunk of
documents sorts and pre-aggregates its own keys, sends each bucket (a range of key hashes) one packed array,
and gets an array of answers in the same order. Spark partitions and shuffles chunks and buckets as rows;
no key takes more than one entry per chunk, so a key that most documents hold doesn't load one bucket.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from helmtrack.llm.common import written

#: Text bytes of a chunk, unless one document has more; chunk bytes for which there is one bucket.
CHUNK_BYTES, BUCKET_BYTES = 1_000_000, 4_000_000


def _sealed(batches, size: int):
    part, number = TaskContext.get().partitionId(), 0
    held: list[pa.RecordBatch] = []
    held_bytes = 0

    def seal():
        nonlocal number, held, held_bytes
        table = pa.Table.from_batches(held).combine_chunks()
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", compression_level=4))) as out:
            out.write_table(table)
        row = pa.RecordBatch.from_arrays(
            [pa.array([part << 32 | number]), pa.array([held_bytes]), pa.array([sink.getvalue().to_pybytes()], pa.binary())],
            names=["chunk", "bytes", "payload"],
        )
        number, held, held_bytes = number + 1, [], 0
        return row

    for batch in batches:
        text = batch.column("text")
        ends = np.cumsum(pc.fill_null(pc.binary_length(text), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        start = 0
        while start < batch.num_rows:
            done = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, done + size - held_bytes, "right")))
            held.append(batch.slice(start, stop - start))
            held_bytes += int(ends[stop - 1] - done)
            start = stop
            if held_bytes >= size or stop < batch.num_rows:
                yield seal()
    if held:
        yield seal()


def chunked(docs: DataFrame, size: int = CHUNK_BYTES) -> DataFrame:
    """The rows of ``docs`` in written chunks: chunk, bytes, payload (an Arrow stream of whole rows)."""
    return written(docs.mapInArrow(lambda batches: _sealed(batches, size), "chunk long, bytes long, payload binary"), "chunks")


def opened(payload: bytes) -> pa.Table:
    return pa.ipc.open_stream(payload).read_all()


def bucket_bits(chunks: DataFrame) -> int:
    """Buckets are the ranges of this many leading bits of a key; their number follows the input."""
    total = chunks.agg(F.sum("bytes")).first()[0] or 0
    return max(5, int(np.ceil(np.log2(max(total, 1) / BUCKET_BYTES))))


def by_bucket(keys: np.ndarray, bits: int) -> list[tuple[int, int, int]]:
    """(bucket, start, stop) of each bucket that the ascending keys reach."""
    if not len(keys):
        return []
    which = (keys >> np.uint64(64 - bits)).astype(np.int64)
    starts = np.flatnonzero(np.append(True, which[1:] != which[:-1]))
    return [(int(which[i]), int(i), int(j)) for i, j in zip(starts, np.append(starts[1:], len(keys)))]


def arrow_rows(rows: list[tuple], schema: pa.Schema) -> pa.Table:
    return pa.Table.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*rows) if rows else [[]] * len(schema), schema)], schema=schema)
