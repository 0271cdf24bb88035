"""Documents whose sets of word shingles are similar: an exact n-gram Jaccard join.

1. Chunks of documents count their shingles and send them, pre-aggregated, to buckets of their hashes; the
   buckets answer how many sets hold each. Shingles of one set only can't be shared and go no further.
2. A set's shingles are ordered from rare to common. Two similar sets of sizes m <= n share a shingle that is
   among the first m - ceil(2J / (1 + J) m) + 1 of the smaller and the first n - ceil(J n) + 1 of the larger one:
   the first shingle in the order that both hold. So a set enters a tile for each of these shingles that
   other sets hold too, per size band; a set of the next band enters the tile only as the larger one. Phrases that
   many documents hold come last in the order and don't bring strangers together.
3. A tile is compared in rounds, never with all its pairs as rows. First, its members meet one pivot; the pairs are
   made distinct over all tiles. Tiles whose members are then connected are done. The others take some PIVOTS new
   pivots a round, among the members outside the tile's largest component, until what is left is connected.
   Members are dealt to blocks of BLOCK, to which the pivots are sent. In a block, hashed bitmaps bound the overlap
   of a pair from above by bit counts, and what passes is decided by intersecting the sorted arrays. A pair
   that is connected already isn't compared. So the links found connect just what all links would connect.

Equal sets are one class from the start. Defined results: a null text and one without words have an empty set,
linked with nothing. A document of fewer words than a shingle has its whole sequence as one shingle. A
component has the name of its least identifier. Rows with a null identifier are compared like all others but
can't name a component; without any other row in it its name is null. Repeated rows are one class. Rows are told
apart by a hash of identifier and text, so rows that share an identifier but not a text are linked only
if these are similar. An empty table gives an empty result. Other columns play no part.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from helmtrack.llm.chunks import arrow_rows, bucket_bits, by_bucket, chunked, opened
from helmtrack.llm.common import discard, pack, pack_sorted, unpack, unpack_sorted, written
from helmtrack.llm.components import components
from helmtrack.llm.words import joined_hashes, mixed, word_hashes

#: Members of a block of comparisons, and pivots that a tile takes in a round after the first.
BLOCK, PIVOTS = 1024, 1024
#: Bits of a shingle's hash beyond the logarithm of their number, for counting; a chance collision only
#: makes a shingle seem more common than it is.
SPARE_BITS = 8


class Threshold:
    """Similarity of at least num / den: size bands and the numbers of leading shingles."""

    def __init__(self, num: int, den: int):
        self.num, self.den = num, den

    def bands(self, n: np.ndarray) -> np.ndarray:
        """The band of each size; sizes that are two bands apart can't be similar."""
        tops, low = [], 1
        while not tops or tops[-1] < n.max(initial=0):
            tops.append(self.den * low // self.num)
            low = tops[-1] + 1
        return np.searchsorted(tops, n)

    def leading(self, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """How many leading shingles a set of n enters as the smaller and as the larger one of a pair; none
        where the only similar set is an equal one."""
        least_common = -(-2 * self.num * n // (self.num + self.den))
        least_size = -(-self.num * n // self.den)
        only_equal = (least_common == n) & (least_size == n) & (self.den * n // self.num == n)
        return np.where(only_equal, 0, n - least_common + 1), np.where(only_equal, 0, n - least_size + 1)

    def similar(self, common, a, b):
        return self.den * common >= self.num * (a + b - common)

    def may_differ(self, a, b):
        return (a + b) * (self.den - self.num) // (self.den + self.num)


def shingle_sets(texts: list, k: int) -> list[np.ndarray]:
    """The ascending hashes of each text's distinct shingles."""
    hashes, n = word_hashes(texts)
    joined = joined_hashes(hashes, k)
    out, start = [], 0
    for count in n.tolist():
        if count >= k:
            out.append(np.unique(mixed(joined[start : start + count - k + 1], 13)))
        elif count:
            out.append(mixed(joined_hashes(hashes[start : start + count], count), count))
        else:
            out.append(np.zeros(0, np.uint64))
        start += count
    return out


class Chunk:
    """The sets of a chunk, each distinct one once, and the keys under which their shingles are counted."""

    def __init__(self, payload: bytes, k: int, key_bits: int):
        table = opened(payload)
        self.ids, self.rows, self.texts = (table.column(c).to_pylist() for c in ("doc_id", "row", "text"))
        sets = shingle_sets(self.texts, k)
        self.sizes = [len(s) for s in sets]
        self.nodes = [b"".join(int(mixed(s, salt).sum(dtype=np.uint64)).to_bytes(8, "big") for salt in (11, 12)) for s in sets]
        first = {node: i for i, node in reversed(list(enumerate(self.nodes)))}
        self.distinct = sorted(i for i in first.values() if self.sizes[i])
        self.n = np.array([self.sizes[i] for i in self.distinct], np.int64)
        self.shingles = np.concatenate([*(sets[i] for i in self.distinct), np.zeros(0, np.uint64)])
        self.low = np.uint64(64 - key_bits)
        self.keys, self.at, self.counts = np.unique(self.shingles >> self.low, return_inverse=True, return_counts=True)

    def buckets(self, bits: int) -> list[tuple[int, int, int]]:
        return by_bucket(self.keys << self.low, bits)


_SENT = pa.schema([("bucket", pa.int64()), ("chunk", pa.int64()), ("keys", pa.binary()), ("counts", pa.binary())])
_BACK = pa.schema([("chunk", pa.int64()), ("bucket", pa.int64()), ("payload", pa.binary())])


def _sent(batches, k: int, key_bits: int, bits: int):
    for batch in batches:
        for number, payload in zip(batch.column("chunk").to_pylist(), batch.column("payload").to_pylist()):
            chunk = Chunk(payload, k, key_bits)
            rows = [(b, number, pack_sorted(chunk.keys[i:j]), pack(chunk.counts[i:j].astype("<u4"))) for b, i, j in chunk.buckets(bits)]
            yield from arrow_rows(rows, _SENT).to_batches()


def _commonness(table: pa.Table) -> pa.Table:
    """For each key that a chunk sent: 0 if one set holds it, else the logarithm of how many do."""
    chunk, bucket = table.column("chunk").to_pylist(), table.column("bucket").to_pylist()
    keys = [unpack_sorted(k) for k in table.column("keys").to_pylist()]
    counts = np.concatenate([unpack(c, "<u4") for c in table.column("counts").to_pylist()])
    _, inverse = np.unique(np.concatenate(keys), return_inverse=True)
    level = np.log2(np.bincount(inverse, counts)).astype(np.uint8)[inverse]
    ends = np.cumsum([len(k) for k in keys])
    return arrow_rows([(c, b, pack(level[e - len(k) : e])) for c, b, k, e in zip(chunk, bucket, keys, ends)], _BACK)


_TILED = pa.schema([("doc_id", pa.int64()), ("row", pa.int64()), ("n", pa.int64()), ("node", pa.binary()), ("tiles", pa.list_(pa.int64())), ("smaller", pa.list_(pa.bool_())), ("body", pa.binary())])


def _tiled(table: pa.Table, k: int, key_bits: int, threshold: Threshold) -> pa.Table:
    """A chunk's rows; the first of each distinct set with the tiles it enters and its compressed text."""
    answers = sorted(zip(table.column("bucket").to_pylist(), table.column("payload").to_pylist()), key=lambda r: r[0])
    chunk = Chunk(answers[0][1], k, key_bits)
    entered: dict[int, tuple] = {}
    if len(chunk.shingles):
        level = np.concatenate([unpack(p, np.uint8) for _, p in answers[1:]])[chunk.at]
        owner = np.repeat(np.arange(len(chunk.n)), chunk.n)
        order = np.lexsort((chunk.shingles, level, owner))
        start = np.cumsum(chunk.n) - chunk.n
        place = np.arange(len(order)) - start[owner]  # owners are in order already
        as_smaller, as_larger = threshold.leading(chunk.n)
        kept = np.flatnonzero((level[order] > 0) & (place < as_larger[owner]))
        shingle, owner, place = chunk.shingles[order][kept], owner[kept], place[kept]
        band = threshold.bands(chunk.n)[owner].astype(np.uint64)
        own, below = (mixed(shingle + b * np.uint64(0xD6E8FEB86659FD93), 17).view(np.int64) for b in (band, band - np.uint64(1)))
        small = place < as_smaller[owner]
        bounds = np.searchsorted(owner, np.arange(len(chunk.n) + 1))
        for s, (i, j) in enumerate(zip(bounds, bounds[1:])):
            if i < j:
                beside = below[i:j] if band[i] else below[:0]
                entered[chunk.distinct[s]] = np.concatenate([own[i:j], beside]).tolist(), small[i:j].tolist() + [False] * len(beside)
    out = []
    for i, (doc, row, n, node, text) in enumerate(zip(chunk.ids, chunk.rows, chunk.sizes, chunk.nodes, chunk.texts)):
        tiles, smaller = entered.get(i, (None, None))
        out.append((doc, row, n, node, tiles, smaller, pack(np.frombuffer(text.encode(), np.uint8), thorough=True) if tiles else None))
    return arrow_rows(out, _TILED)


class Comparison:
    """The sets of a block and their bitmaps."""

    def __init__(self, bodies: list[bytes], k: int, threshold: Threshold):
        self.sets = shingle_sets([unpack(b, np.uint8).tobytes().decode() for b in bodies], k)
        self.sizes = np.array([len(s) for s in self.sets], np.int64)
        self.threshold = threshold
        words = 1 << max(0, int(2 * self.sizes.max() - 1).bit_length() - 6)
        self.bitmaps = np.zeros((len(self.sets), words), np.uint64)
        for row, s in zip(self.bitmaps, self.sets):
            np.bitwise_or.at(row, (s >> np.uint64(6) & np.uint64(words - 1)).astype(np.int64), np.uint64(1) << (s & np.uint64(63)))

    def linked(self, one: int, others: np.ndarray) -> np.ndarray:
        """Which of ``others`` are similar to the set at ``one``."""
        differ = np.bitwise_count(self.bitmaps[others] ^ self.bitmaps[one]).sum(1)  # at most the true difference
        out = differ <= self.threshold.may_differ(self.sizes[one], self.sizes[others])
        for i in np.flatnonzero(out):
            a, b = self.sets[one], self.sets[others[i]]
            a, b = (a, b) if len(a) <= len(b) else (b, a)
            common = int((b[np.minimum(np.searchsorted(b, a), len(b) - 1)] == a).sum())
            out[i] = self.threshold.similar(common, len(a), len(b))
        return out


_LINKS = pa.schema([("a", pa.binary()), ("b", pa.binary())])


def _links(table: pa.Table, k: int, threshold: Threshold) -> pa.Table:
    """The similar pairs of a block, each of a pivot and a member of another component. What the block itself
    connects isn't compared again."""
    node, label, pivot, body = (table.column(c).to_pylist() for c in ("node", "label", "pivot", "body"))
    order = sorted(range(len(node)), key=lambda i: (node[i], not pivot[i]))
    order = [i for n, i in enumerate(order) if not n or node[i] != node[order[n - 1]]]  # a pivot is a member too
    if len(order) < 2:
        return arrow_rows([], _LINKS)
    block = Comparison([body[i] for i in order], k, threshold)
    component = np.unique([label[i] for i in order], return_inverse=True)[1]
    found = []
    for p in [n for n, i in enumerate(order) if pivot[i]]:
        others = np.flatnonzero(component != component[p])
        if len(others):
            hit = others[block.linked(p, others)]
            found += [(node[order[p]], node[order[h]]) for h in hit]
            component[np.isin(component, component[hit])] = component[p]
    return arrow_rows(found, _LINKS)


def _compared(guests: DataFrame, pivots: DataFrame, bodies: DataFrame, k: int, threshold: Threshold) -> DataFrame:
    """Links of the pivots (meeting, node, label, blocks) with the guests (the same) of their meeting."""
    where = F.pmod(F.xxhash64("node", F.lit(7)), F.col("blocks"))
    rows = guests.select("meeting", where.alias("block"), "node", "label", F.lit(False).alias("pivot"))
    spread = pivots.select("meeting", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"), "node", "label", F.lit(True).alias("pivot"))
    met = rows.unionByName(spread).join(bodies, "node")
    return met.groupBy("meeting", "block").applyInArrow(lambda t: _links(t, k, threshold), "a binary, b binary")


def _blocks(column: str):
    return F.ceil(F.col(column) / BLOCK).alias("blocks")


def _labels(entries: DataFrame, bodies: DataFrame, k: int, threshold: Threshold) -> DataFrame:
    """(node, label) of all nodes that are linked. ``entries``: tile, node, smaller."""
    tiles = entries.groupBy("tile").agg(F.min(F.when(F.col("smaller"), F.col("node"))).alias("pivot"), F.min("node").alias("least"), F.max("node").alias("most"))
    tiles = tiles.where("least <> most AND pivot IS NOT NULL").select("tile", "pivot")
    entries = written(entries.join(tiles, "tile").select("tile", "node", "pivot").distinct(), "tile-entries")
    pairs = entries.where("node <> pivot").select("pivot", "node").distinct()
    sizes = pairs.groupBy("pivot").agg(F.count("*").alias("n")).select("pivot", F.xxhash64("pivot").alias("meeting"), _blocks("n"))
    guests = pairs.join(sizes, "pivot").select("meeting", "node", F.col("node").alias("label"), "blocks")
    links = written(_compared(guests, sizes.select("meeting", F.col("pivot").alias("node"), F.col("pivot").alias("label"), "blocks"), bodies, k, threshold), "links")
    labels = components(links)
    open_ = entries.where("node <> pivot").select("tile", "node")
    turn = 1
    while True:
        turn += 1
        known = open_.join(labels, "node", "left").select("tile", "node", F.coalesce("label", "node").alias("label"))
        digest = F.sum(F.xxhash64("node").cast("decimal(38,0)"))
        sizes = known.groupBy("tile", "label").agg(F.count("*").alias("n"), digest.alias("digest"))
        tiles = sizes.groupBy("tile").agg(F.max_by("label", F.struct("n", "label")).alias("most"), F.sum("n").alias("n"), F.max("n").alias("of_most"), F.sum("digest").alias("digest"))
        tiles = tiles.where("n > of_most").groupBy("n", "digest").agg(F.min(F.struct("tile", "most", "of_most")).alias("one"))  # equal tiles: one
        tiles = tiles.select("one.tile", "one.most", (F.col("n") - F.col("one.of_most")).alias("left"), _blocks("n"))
        known = written(known.join(tiles, "tile"), "open-tiles")
        if known.isEmpty():
            return labels
        chosen = (F.col("label") != F.col("most")) & (F.pmod(F.xxhash64("node", F.lit(turn)), F.ceil(F.col("left") / PIVOTS)) == 0)
        meeting = known.select(F.col("tile").alias("meeting"), "node", "label", "blocks", chosen.alias("chosen"))
        more = written(_compared(meeting.drop("chosen"), meeting.where("chosen").drop("chosen"), bodies, k, threshold), "links")
        if not more.isEmpty():
            links = links.union(more)
            labels = components(links)
        open_ = known.where(~chosen).select("tile", "node")


def _row_hash():
    """What tells rows apart that differ in identifier or text, also where the identifier is null."""
    return F.xxhash64(F.col("doc_id").cast("long"), "text")


def _rank():
    """The order in which rows name their component: identifiers ascending, null ones last."""
    return F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "row")


def _placed(docs: DataFrame, k: int, num: int, den: int) -> DataFrame:
    """Per row of ``docs``: doc_id, row, n and leader, the first row of its component by ``_rank``."""
    threshold = Threshold(num, den)
    chunks = chunked(docs.select(F.col("doc_id").cast("long").alias("doc_id"), _row_hash().alias("row"), "text"))
    bits = bucket_bits(chunks)
    total = chunks.agg(F.sum("bytes")).first()[0] or 0
    key_bits = min(64, max(24, total.bit_length() - 2 + SPARE_BITS))
    sent = chunks.mapInArrow(partial(_sent, k=k, key_bits=key_bits, bits=bits), "bucket long, chunk long, keys binary, counts binary")
    answers = written(sent.groupBy("bucket").applyInArrow(_commonness, "chunk long, bucket long, payload binary"), "commonness")
    asked = chunks.select("chunk", F.lit(-1).cast("long").alias("bucket"), "payload").unionByName(answers)
    fields = "doc_id long, row long, n long, node binary, tiles array<long>, smaller array<boolean>, body binary"
    tiled = written(asked.groupBy("chunk").applyInArrow(lambda t: _tiled(t, k, key_bits, threshold), fields), "sets")
    discard(chunks)
    discard(answers)
    rows = written(tiled.select("doc_id", "row", "n", "node"), "set-rows")
    entries = tiled.where("tiles IS NOT NULL").select("node", F.explode(F.arrays_zip("tiles", "smaller")).alias("e")).select(F.col("e.tiles").alias("tile"), "node", F.col("e.smaller").alias("smaller"))
    labels = _labels(entries, tiled.where("body IS NOT NULL").select("node", "body").dropDuplicates(["node"]), k, threshold)
    discard(tiled)
    classes = written(rows.groupBy("n", "node").agg(F.min(_rank()).alias("first")), "classes")
    leaders = labels.join(classes, "node").groupBy("label").agg(F.min("first").alias("leader"))
    placed = classes.join(labels.join(leaders, "label").select("node", "leader"), "node", "left")
    out = rows.join(placed.select("n", "node", F.coalesce("leader", "first").alias("leader")), ["n", "node"])
    return out.select("doc_id", "row", "n", F.when(F.col("n") == 0, _rank()).otherwise(F.col("leader")).alias("leader"))


def jaccard_components(docs: DataFrame, k: int = 5, num: int = 4, den: int = 5) -> DataFrame:
    """Per row of ``docs``: doc_id, n_shingles, component_id for links of similarity num / den or more."""
    return _placed(docs, k, num, den).select("doc_id", F.col("n").alias("n_shingles"), F.col("leader.doc_id").alias("component_id"))


def without_similar(docs: DataFrame, k: int = 5, num: int = 4, den: int = 5) -> DataFrame:
    """``docs`` with one row of each component, with all their columns: that of the least identifier, or one of
    a null identifier if the component has no other. Texts similar to no other all stay, whatever identifiers
    they have; of rows equal in identifier and text one stays."""
    stay = _placed(docs, k, num, den).where("row = leader.row").select(F.col("row").alias("_row")).distinct()
    return docs.withColumn("_row", _row_hash()).join(stay, "_row", "left_semi").dropDuplicates(["_row", "doc_id"]).select(*docs.columns)
