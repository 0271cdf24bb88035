"""Exact duplicates by content sort.

Texts are normalised (A-Z lower-cased, nothing else) and range-partitioned by sampled splitters on their
first bytes, a hash and the identifier; within a partition Spark's external sort places equal texts next
to each other, and neighbours are compared in full. The identifier is part of the splitters, so a group of
copies may span partitions: each partition tells of its runs in rows of at most RUN_ROWS or so identifiers,
and a summary of each group's runs is joined back to them.

Defined results: a null text counts as empty, so null and empty texts are equal. A null identifier is
smaller than any other. Repeated rows are members of their group one by one; of repeated rows of the
identifier that stays, one stays. An empty table gives an empty result. Other columns play no part.
"""

from __future__ import annotations

import hashlib
import string

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LOWER = bytes.maketrans(string.ascii_uppercase.encode(), string.ascii_lowercase.encode())
#: Bytes of a text that take part in the splitters; the sort itself compares whole texts.
SPLITTER_BYTES = 32
#: Identifiers in one row of a run.
RUN_ROWS = 4096


def _normalised(batches):
    for batch in batches:
        texts = [(t or "").encode().translate(LOWER) for t in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("row_hash"), pa.array(texts, pa.binary())], names=["doc_id", "row_hash", "content"])


_RUNS = pa.schema([("text_sha256", pa.string()), ("ids", pa.list_(pa.int64())), ("hashes", pa.list_(pa.int64())), ("first", pa.int64()), ("last", pa.int64()), ("n", pa.int64())])


def _runs(batches):
    """One row for each run of equal neighbours, or for each RUN_ROWS or so of its rows; rows of one
    identifier stay together."""
    content, ids, hashes, out = None, [], [], []

    def close():
        if ids:
            digest = hashlib.sha256(content).hexdigest()
            out.append((digest, list(ids), list(hashes), ids[0], ids[-1], len(ids)))
            ids.clear()
            hashes.clear()

    for batch in batches:
        for i, h, text in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "row_hash", "content"))):
            if text != content or len(ids) >= RUN_ROWS and i != ids[-1]:
                close()
                content = text
            ids.append(i)
            hashes.append(h)
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*out), _RUNS)], schema=_RUNS)
            out.clear()
    close()
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*out), _RUNS)], schema=_RUNS)


def exact_dedup(docs: DataFrame, keep: str = "smallest") -> DataFrame:
    """Per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256 and row_hash, the xxhash64 of
    its text as given. ``keep`` is "smallest" or "largest": which identifier of a group stays."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("row_hash"))
    content = rows.mapInArrow(_normalised, "doc_id long, row_hash long, content binary")
    content = content.withColumns({"head": F.substring("content", 1, SPLITTER_BYTES), "mixed": F.xxhash64("content")})
    ordered = content.repartitionByRange("head", "mixed", "doc_id").sortWithinPartitions("head", "mixed", "content", "doc_id")
    runs = ordered.mapInArrow(_runs, "text_sha256 string, ids array<long>, hashes array<long>, first long, last long, n long")
    # A summary of each group's runs is joined back to them: no task holds a whole group. Spark's min() passes over nulls.
    lowest = F.when(F.max(F.col("first").isNull()), F.lit(None)).otherwise(F.min("first"))
    groups = runs.groupBy("text_sha256").agg((F.max("last") if keep == "largest" else lowest).alias("keep_id"), F.sum("n").alias("group_size"))
    joined = runs.join(groups, "text_sha256")
    each = joined.select("*", F.posexplode(F.arrays_zip("ids", "hashes")).alias("place", "row"))
    edge, at = ("last", F.col("n") - 1) if keep == "largest" else ("first", F.lit(0))
    return each.select(
        F.col("row.ids").alias("doc_id"),
        "keep_id",
        "group_size",
        (F.col(edge).eqNullSafe(F.col("keep_id")) & (F.col("place") == at)).alias("kept"),
        "text_sha256",
        F.col("row.hashes").alias("row_hash"),
    )


def without_copies(docs: DataFrame, keep: str = "smallest") -> DataFrame:
    """``docs`` without the rows that ``exact_dedup`` drops, with all their columns."""
    stay = exact_dedup(docs, keep).where("kept").select(F.col("doc_id").alias("_id"), F.col("row_hash").alias("_hash"))
    left = docs.withColumn("_h", F.xxhash64("text"))
    on = left["doc_id"].eqNullSafe(stay["_id"]) & (left["_h"] == stay["_hash"])
    return left.join(stay, on, "left_semi").dropDuplicates(["doc_id", "_h"]).drop("_h")
