"""Line dedup in DataFrame functions alone: lines that many documents share go, in all documents but one.

A line's key is the line without space and 0x09-0x0D at both ends, A-Z lower-cased. Keys of at least ``min_chars`` code
points that at least ``min_docs`` documents hold lose all their lines but those in the document of the largest identifier.

Keys are hashed to 128 bits and range-partitioned by sampled splitters on (hash, document), so that a line that a
third of all documents hold spans partitions; within a partition Spark's external sort orders them by hash,
document and position. In that stream the first occurrence of each key in each document is marked; their number and
the largest identifier are summed for each key, with partial sums before the shuffle. Frequent keys are joined back to
the stream (Spark splits skewed partitions of that join), and what a document loses is kept as a bitmap compressed to run lengths:
kept, dropped, kept, ... lines. Texts aren't sent with lines; they meet their bitmaps at the end.

Defined results: a null or empty text is one empty line and loses nothing. Rows of one identifier are one document; those
without one are together one document, smaller than any other. Repeated rows have the same bitmap each. An empty table gives an
empty result. Other columns, whatever their names, stay as they are in ``without_repeated_lines`` and play no part.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from helmtrack.llm.common import discard, written

MIN_CHARS, MIN_DOCS = 40, 5
#: Fixed value: what is stripped from a line's ends.
BLANKS = " \t\n\x0b\x0c\r"


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _keys(text: Column, min_chars: int) -> Column:
    """For each line two hashes of its key, or null where the key is shorter than asked for. Blanks are stripped only where there
    are some at an end, and ``lower`` serves where all is ASCII: both give the same and are faster."""
    edge = lambda line: F.substring(line, 1, 1).isin(*BLANKS) | F.substring(line, -1, 1).isin(*BLANKS)
    stripped = F.transform(_lines(text), lambda line: F.when(edge(line), F.btrim(line, F.lit(BLANKS))).otherwise(line))
    long = F.transform(stripped, lambda line: F.when(F.char_length(line) >= min_chars, line))
    ascii_only = lambda line: F.char_length(line) == F.octet_length(line)
    folded = lambda line: F.when(ascii_only(line), F.lower(line)).otherwise(F.translate(line, string.ascii_uppercase, string.ascii_lowercase))
    return F.transform(F.transform(long, folded), lambda key: F.when(key.isNotNull(), F.struct(F.xxhash64(key).alias("a"), F.xxhash64(F.lit(1), key).alias("b"))))


def _streamed(docs: DataFrame, min_chars: int) -> DataFrame:
    """One row for each line with a long key: hash, document, digest of its text, place, and whether it is the key's first
    in its document; range-partitioned and sorted by hash, document and place."""
    placed = docs.select(F.col("doc_id").cast("long").alias("doc"), F.xxhash64("text").alias("digest"), F.posexplode(_keys(F.col("text"), min_chars)).alias("place", "key")).where("key IS NOT NULL")
    placed = placed.select(F.col("key.a").alias("a"), F.col("key.b").alias("b"), "doc", "digest", "place")
    stream = placed.repartitionByRange("a", "b", "doc").sortWithinPartitions("a", "b", "doc", "digest", "place")
    return stream.withColumn("first", F.expr("row_number() OVER (PARTITION BY a, b, doc ORDER BY digest, place) = 1"))


def _frequent(stream: DataFrame, min_docs: int) -> DataFrame:
    """Keys of at least ``min_docs`` documents, and the document that keeps its lines."""
    counted = stream.groupBy("a", "b").agg(F.count_if("first").alias("n"), F.max("doc").alias("keeper"))
    return counted.where(F.col("n") >= min_docs).select("a", "b", "keeper")


def _run_lengths(dropped: Column) -> Column:
    """Ascending places of dropped lines as lengths of kept, dropped, kept, ... runs; the last kept run is left open."""
    start = F.struct(F.array().cast("array<int>").alias("runs"), F.lit(0).alias("next"), F.lit(0).alias("length"))

    def step(state, place):
        goes_on = (place == state["next"]) & (state["length"] > 0)
        closed = F.when(state["length"] > 0, F.concat(state["runs"], F.array(state["length"]))).otherwise(state["runs"])
        runs = F.when(goes_on, state["runs"]).otherwise(F.concat(closed, F.array(place - state["next"])))
        return F.struct(runs.alias("runs"), (place + 1).alias("next"), F.when(goes_on, state["length"] + 1).otherwise(F.lit(1)).alias("length"))

    return F.aggregate(dropped, start, step, lambda s: F.concat(s["runs"], F.array(s["length"])))


def line_bitmaps(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """For each document text that loses lines: doc, digest (xxhash64 of the text), runs (lengths of kept, dropped,
    kept, ... lines, from the first line on; lines after the last run stay)."""
    stream = written(_streamed(docs, min_chars), "line-stream")
    frequent = written(_frequent(stream, min_docs), "line-frequent")
    met = stream.join(frequent.hint("shuffle_hash"), ["a", "b"]).where(~F.col("doc").eqNullSafe(F.col("keeper")))
    lost = met.groupBy("doc", "digest").agg(F.collect_set("place").alias("places"))
    bitmaps = written(lost.select("doc", "digest", _run_lengths(F.array_sort("places")).alias("runs")), "line-bitmaps")
    discard(stream)
    discard(frequent)
    return bitmaps


def _kept(text: Column, runs: Column) -> Column:
    """The lines of ``text`` that ``runs`` keep, as an array."""
    mask = F.flatten(F.transform(runs, lambda n, i: F.array_repeat(i % 2 == 1, n)))
    stays = F.zip_with(_lines(text), mask, lambda line, lost: F.when(~F.coalesce(lost, F.lit(False)), line))
    return F.array_compact(stays)


def _joined(docs: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """``docs`` under a struct ``row``, with the ``runs`` of each (null: it loses nothing)."""
    rows = docs.select(F.struct("*").alias("row"))
    on = F.col("row.doc_id").cast("long").eqNullSafe(F.col("doc")) & (F.xxhash64("row.text") == F.col("digest"))
    return rows.join(bitmaps.hint("shuffle_hash"), on, "left").select("row", "runs")


def without_repeated_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """``docs`` without the lines that go, all columns as they were; a null text stays null."""
    joined = _joined(docs, line_bitmaps(docs, min_chars, min_docs))
    text = F.when(F.col("runs").isNull(), F.col("row.text")).otherwise(F.concat_ws("\n", _kept(F.col("row.text"), F.col("runs"))))
    return joined.select(*((text if c == "text" else F.col("row").getField(c)).alias(c) for c in docs.columns))


def line_dedup(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """Per row of ``docs``: doc_id, n_lines, n_dropped, runs (its bitmap; null: nothing goes), kept_sha256."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    joined = _joined(rows, line_bitmaps(rows, min_chars, min_docs))
    text, runs = F.col("row.text"), F.col("runs")
    n_lines = F.size(_lines(text)).cast("long")
    dropped = F.aggregate(F.transform(runs, lambda n, i: F.when(i % 2 == 1, n).otherwise(F.lit(0))), F.lit(0), lambda a, n: a + n)
    kept = F.when(runs.isNull(), F.coalesce(text, F.lit(""))).otherwise(F.concat_ws("\n", _kept(text, runs)))
    return joined.select(F.col("row.doc_id").alias("doc_id"), n_lines.alias("n_lines"), F.coalesce(dropped, F.lit(0)).cast("long").alias("n_dropped"), "runs", F.sha2(kept.cast("binary"), 256).alias("kept_sha256"))
