"""Source divergence audit: how far apart the term shares of each two sources of a language are, and a source's own terms.

Terms are runs of letters A-Z, a-z and characters outside ASCII, A-Z lower-cased. A language keeps the terms that at least ``min_docs`` of
its documents hold. A group (language, source), and a language as a whole, gives each kept term the share
``1 + floor(10^9 * (count + 5) / (N + 5 * V))``, N being its occurrences of kept terms and V the number of them.

Terms are counted within a task first, in tables of at most TABLE_TERMS entries, then summed by (language, source, term). Kept terms
get identifiers by a range partitioning in byte order. A group's counts are arrays sorted by identifier, one for each BLOCK
of identifiers, so that no task holds a whole vocabulary. Pair tasks co-group two tiles of at most TILE groups within a block;
for each unordered pair of groups a galloping intersection finds the terms of both, and the price is
summed over terms of both, of either alone and of neither, for the two sides at once. As pairs of sources are the answer, their
number is that of the result. A source with a third of all rows is one entry in its tile like any other.

Shares are exact: counts are multiplied by 10^9 digit by digit, never beyond 63 bits for totals up to 9 * 10^15.

Defined results: null text, lang and source count as ''. Each row is a document, repeated or not. A group without terms has N = 0; a
language without kept terms gives value 0 to all pairs. A language with one source has no pairs. An empty table gives an empty result. Other columns play no part.
"""

from __future__ import annotations

import string
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from helmtrack.llm.common import discard, written

#: Documents that must hold a kept term, what is added to each count, the unit of shares, terms told of a group.
MIN_DOCS, ADDED, UNIT, TOP = 30, 5, 1_000_000_000, 50
#: Entries of a task's table of counts before it is sent on; bits of identifiers in a block; groups in a tile.
TABLE_TERMS, BLOCK_BITS, TILE = 500_000, 16, 8

#: Bytes of UTF-8 to bytes: A-Z to a-z, other ASCII than letters to a blank.
_FOLD = bytes(c + 32 if chr(c) in string.ascii_uppercase else c if chr(c) in string.ascii_lowercase or c >= 128 else 32 for c in range(256))


def _counted(batches):
    held: dict = {}
    size = 0

    def sent():
        rows = [(lang, source, term.decode(), n, docs[term]) for (lang, source), (all_, docs) in held.items() for term, n in all_.items()]
        held.clear()
        for i in range(0, len(rows), 50_000):
            lang, source, term, n, docs = zip(*rows[i : i + 50_000])
            yield pa.RecordBatch.from_arrays([pa.array(lang, pa.string()), pa.array(source, pa.string()), pa.array(term, pa.string()), pa.array(n, pa.int64()), pa.array(docs, pa.int64())], names=["lang", "source", "term", "n", "docs"])

    for batch in batches:
        for lang, source, text in zip(*(batch.column(c).to_pylist() for c in ("lang", "source", "text"))):
            if not text:
                continue
            terms = text.encode().translate(_FOLD).split()
            all_, docs = held.setdefault((lang, source), (Counter(), Counter()))
            size -= len(all_)
            all_.update(terms)
            docs.update(set(terms))
            size += len(all_)
            if size >= TABLE_TERMS:
                yield from sent()
                size = 0
    yield from sent()


def shares(counts: np.ndarray, total: int) -> np.ndarray:
    """``1 + floor(UNIT * (counts + ADDED) / total)`` exactly, as a long division by three digits at a time."""
    whole, rest = np.divmod(counts.astype(np.int64) + ADDED, total)
    for _ in range(3):
        digits, rest = np.divmod(rest * 1000, total)
        whole = whole * 1000 + digits
    return whole + 1


def _priced(a, b, size: int) -> int:
    """Sum of the differences of shares over the ``size`` terms of a block. a, b: (sorted identifiers, counts, total of shares)."""
    (short, n_short, d_short), (long, n_long, d_long) = sorted((a, b), key=lambda x: len(x[0]))
    at = np.searchsorted(long, short)  # ascending needles: each search goes on from where the last one ended
    both = np.zeros(len(short), bool)
    inside = at < len(long)
    both[inside] = long[at[inside]] == short[inside]
    (p, p0), (q, q0) = ((shares(n, d), int(shares(np.zeros(1, np.int64), d)[0])) for n, d in ((n_short, d_short), (n_long, d_long)))
    one_sided = np.ones(len(long), bool)
    one_sided[at[both]] = False
    neither = size - len(short) - int(one_sided.sum())
    return int(np.abs(p[both] - q[at[both]]).sum()) + int(np.abs(p[~both] - q0).sum()) + int(np.abs(q[one_sided] - p0).sum()) + neither * abs(p0 - q0)


_PRICES = pa.schema([("lang", pa.string()), ("a", pa.string()), ("b", pa.string()), ("value", pa.int64())])


def _pair_task(left: pa.Table, right: pa.Table) -> pa.Table:
    """Prices of all unordered pairs of a group of the left tile and one of the right tile, within a block."""

    def groups(table):
        ids, counts = (table.column(c).to_pylist() for c in ("ids", "counts"))
        totals, sources = table.column("total").to_pylist(), table.column("source").to_pylist()
        return [(s, (np.asarray(i or [], np.int64), np.asarray(c or [], np.int64), t)) for s, i, c, t in zip(sources, ids, counts, totals)]

    if not left.num_rows or not right.num_rows:
        return _PRICES.empty_table()
    lang, size, same = left.column("lang")[0].as_py(), left.column("size")[0].as_py(), left.column("tile")[0].as_py() == right.column("tile")[0].as_py()
    found = [(lang, s, t, _priced(x, y, size)) for s, x in groups(left) for t, y in groups(right) if not same or s < t]
    return pa.Table.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*found) if found else [[]] * 4, _PRICES)], schema=_PRICES)


def _pairs(groups: DataFrame, counts: DataFrame, blocks: DataFrame) -> DataFrame:
    """lang, a, b, value: one row for each unordered pair of sources of a language."""
    vectors = counts.groupBy("lang", "source", "block").agg(F.array_sort(F.collect_list(F.struct("id", "n"))).alias("v"))
    vectors = vectors.select("lang", "source", "block", F.col("v.id").alias("ids"), F.col("v.n").alias("counts"))
    # Groups without a term of a block take part in it too: they have an empty array.
    grid = written(groups.join(blocks, "lang").join(vectors, ["lang", "source", "block"], "left"), "term-vectors")
    tiles = F.col("n_tiles") - 1
    left = grid.withColumn("other", F.explode(F.sequence("tile", tiles)))
    right = grid.toDF(*grid.columns).withColumn("other", F.col("tile")).withColumn("first", F.explode(F.sequence(F.lit(0), F.col("tile"))))
    left = left.withColumn("first", F.col("tile"))
    columns = ["lang", "block", "first", "other", "tile", "source", "ids", "counts", "total", "size"]
    key = ["lang", "block", "first", "other"]
    prices = left.select(columns).groupBy(key).cogroup(right.select(columns).groupBy(key)).applyInArrow(_pair_task, "lang string, a string, b string, value long")
    return prices.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))


def source_divergence(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP) -> DataFrame:
    """lang, source, part, item, value, rank: part ``pair`` has the summed difference to each other source of the language,
    part ``term`` the ``top`` terms whose share in the group exceeds that in the language by most."""
    rows = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")))
    partial = rows.mapInArrow(_counted, "lang string, source string, term string, n long, docs long")
    counted = written(partial.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")), "term-counts")
    kept = counted.groupBy("lang", "term").agg(F.sum("n").alias("n_lang"), F.sum("docs").alias("docs")).where(F.col("docs") >= min_docs)
    kept = kept.repartitionByRange("lang", "term").sortWithinPartitions("lang", "term")
    kept = written(kept.select("lang", "term", "n_lang", F.monotonically_increasing_id().alias("id")), "kept-terms")
    kept = kept.withColumn("block", F.shiftright("id", BLOCK_BITS))
    counts = written(counted.join(kept, ["lang", "term"]).select("lang", "source", "term", "id", "block", "n", "n_lang"), "kept-counts")
    discard(counted)

    languages = kept.groupBy("lang").agg(F.count("*").alias("v"), F.sum("n_lang").alias("n_all"))
    of_group = counts.groupBy("lang", "source").agg(F.sum("n").alias("n_group"))
    groups = rows.select("lang", "source").distinct().join(of_group, ["lang", "source"], "left").join(languages, "lang", "left")
    groups = groups.select("lang", "source", (F.coalesce("n_group", F.lit(0)) + ADDED * F.coalesce("v", F.lit(0))).alias("total"), (F.col("n_all") + ADDED * F.col("v")).alias("total_all"))
    groups = written(groups.withColumn("tile", F.expr(f"cast(floor((row_number() OVER (PARTITION BY lang ORDER BY source) - 1) / {TILE}) AS int)")), "groups")
    tiled = groups.withColumn("n_tiles", F.max("tile").over(Window.partitionBy("lang")) + 1)

    blocks = kept.groupBy("lang", "block").agg(F.count("*").alias("size"))
    prices = written(_pairs(tiled, counts, blocks), "pair-prices")
    both = prices.select("lang", F.explode(F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("item")), F.struct(F.col("b").alias("source"), F.col("a").alias("item")))).alias("p"), "value")
    both = both.select("lang", "p.source", "p.item", "value")
    # Where a language keeps no term there is no block to price: its pairs are at 0.
    bare = groups.where("total_all IS NULL").select("lang", "source")
    bare = bare.join(bare.withColumnRenamed("source", "item"), "lang").where("source <> item").withColumn("value", F.lit(0).cast("long"))
    pair = both.unionByName(bare.select(both.columns)).withColumn("part", F.lit("pair"))

    share = lambda n, total: F.expr(f"1 + (cast({UNIT} AS decimal(38, 0)) * ({n} + {ADDED})) div {total}")
    own = counts.join(groups.select("lang", "source", "total", "total_all"), ["lang", "source"])
    term = own.select("lang", "source", F.col("term").alias("item"), (share("n", "total") - share("n_lang", "total_all")).alias("value")).where("value > 0").withColumn("part", F.lit("term"))

    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pair = pair.withColumn("rank", F.row_number().over(order))
    term = term.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return pair.unionByName(term.select(pair.columns)).select("lang", "source", "part", "item", "value", "rank")
