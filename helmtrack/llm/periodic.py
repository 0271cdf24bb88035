"""Periodic runs of words: maximal stretches that repeat with a period, found by a difference-cover LCE structure.

A run is a stretch of consecutive words with smallest period q (words q apart are identical) of at least max(``min_words``, ``min_periods`` * q)
words that no neighbouring word extends with that period.

Longest common extensions (LCE) of two places: a difference cover of the residues modulo 31 has six residues such that for any two
places some offset below 31 leads both to residues of the cover. Only suffixes at those residues are sorted: first by their
31 words, then by doubling over places 31, 62, 124, ... further on. Neighbours' common prefixes come from the same ranks, from coarse to fine. A query
compares at most 31 words one by one; if all agree, it has reached two synchronised samples, and a sparse table of
range minima tells the rest. Extensions to the left are those of the mirrored text. A text in which no query gets so far needs no sorting.

Runs by a harmonic grid: a run with period q has at least max(2 * q, ``min_words`` - q) places whose word recurs q further on, so that one of them is
on the grid of that step; all periods have n log n grid places in all. Those with equal words are extended both ways. A stretch found with a
multiple of its period is the same stretch, for which the smallest period stands.

Spark deals out whole documents; a task treats one text at a time and its grid in blocks of GRID places, so memory is bounded by the
longest text. Nothing depends on other rows, so no shuffle is needed and hot keys don't matter.

Defined results: a null, empty or blank text has no words and no run; its collapsed text is empty. Repeated rows have a row
each. A null identifier is never tiled. An empty table gives an empty result. Other columns play no part.
"""

from __future__ import annotations

import hashlib
import zlib
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MIN_WORDS, MIN_PERIODS = 24, 3
#: Places of the grid that are looked at together.
GRID = 1 << 20

#: A perfect difference set. Each residue modulo 31 other than 0 is one difference of two of these.
MODULUS, COVER = 31, (0, 1, 3, 8, 12, 18)


def _offsets() -> np.ndarray:
    """[i, j]: the least offset that leads residues i and j both into the cover."""
    inside = np.zeros(MODULUS, bool)
    inside[list(COVER)] = True
    i, j, d = np.ogrid[:MODULUS, :MODULUS, :MODULUS]
    return np.argmax(inside[(i + d) % MODULUS] & inside[(j + d) % MODULUS], axis=2)


_OFFSET = _offsets()


class CoverLCE:
    """Longest common extensions of places of one sequence of word numbers (0 and up); samples are sorted when first needed."""

    def __init__(self, words: np.ndarray):
        self.n = len(words)
        # Beyond the end there are words that equal no other: two suffixes differ there at the latest.
        self.words = np.concatenate([words, np.full(2 * MODULUS, -1, words.dtype)])
        self.table = None

    def _sorted(self) -> None:
        n = self.n
        at = np.flatnonzero(np.isin(np.arange(n) % MODULUS, COVER))
        self.index = np.full(n + MODULUS, -1, np.int64)
        self.index[at] = np.arange(len(at))
        order = np.lexsort(tuple(self.words[at + d] for d in range(MODULUS - 1, -1, -1)))
        fresh = np.zeros(len(at), bool)
        for d in range(MODULUS):
            column = self.words[at[order] + d]
            fresh[1:] |= column[1:] != column[:-1]
        levels, reach = [], MODULUS
        while True:
            rank = np.empty(len(at), np.int64)
            rank[order] = np.cumsum(fresh)
            levels.append((reach, rank))
            if reach >= n or rank[order[-1]] == len(at) - 1:
                break
            # The place ``reach`` further on is a sample too, or lies beyond the end.
            after = np.full(len(at), -1, np.int64)
            inside = at + reach < n
            after[inside] = rank[self.index[at[inside] + reach]]
            pair = rank * (len(at) + 1) + after + 1
            order = np.argsort(pair, kind="stable")
            fresh = np.concatenate([[False], np.diff(pair[order]) != 0])
            reach *= 2
        self.rank, self.at = levels[-1][1], at
        self.order = order
        # Common prefixes of neighbours: as far as coarse ranks agree, then finer ones, then single words.
        x, y, common = at[order[:-1]].copy(), at[order[1:]].copy(), np.zeros(max(len(at) - 1, 0), np.int64)
        for reach, rank in reversed(levels):
            live = (x < n) & (y < n)
            same = np.zeros(len(x), bool)
            same[live] = rank[self.index[x[live]]] == rank[self.index[y[live]]]
            same &= np.maximum(x, y) + reach <= n
            x, y, common = x + reach * same, y + reach * same, common + reach * same
        common += self._direct(x, y, np.full(len(x), MODULUS))
        table, width = [common], 1
        while 2 * width <= len(common):
            last = table[-1]
            table.append(np.minimum(last[:-width], last[width:]))
            width *= 2
        self.table = table

    def _direct(self, x, y, most) -> np.ndarray:
        """Equal words from x and y on, at most ``most`` and 31 of them."""
        found, live = np.zeros(len(x), np.int64), np.arange(len(x))
        for d in range(MODULUS):
            i, j = x[live] + d, y[live] + d
            live = live[(d < most[live]) & (np.maximum(i, j) < self.n)]
            live = live[self.words[x[live] + d] == self.words[y[live] + d]]
            if not len(live):
                break
            found[live] += 1
        return found

    def query(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Equal words from places x and y on, x != y, both up to n."""
        offset = _OFFSET[x % MODULUS, y % MODULUS]
        found = self._direct(x, y, offset)
        far = np.flatnonzero((found == offset) & (np.maximum(x, y) + offset < self.n))
        # Most pairs that agree so far differ in the very next words.
        more = self._direct(x[far] + offset[far], y[far] + offset[far], np.full(len(far), MODULUS))
        found[far] += more
        far = far[(more == MODULUS) & (np.maximum(x[far] + offset[far], y[far] + offset[far]) + MODULUS < self.n)]
        if len(far):
            if self.table is None:
                self._sorted()
            i, j = (self.rank_of(z[far] + offset[far]) for z in (x, y))
            low, high = np.minimum(i, j), np.maximum(i, j)
            level = np.frexp((high - low).astype(float))[1] - 1
            least = np.empty(len(far), np.int64)
            for k in np.unique(level):
                at = level == k
                least[at] = np.minimum(self.table[k][low[at]], self.table[k][high[at] - (1 << int(k))])
            found[far] = offset[far] + least
        return found

    def rank_of(self, place: np.ndarray) -> np.ndarray:
        return self.rank[self.index[place]]


def _grid(n: int, min_words: int, min_periods: int):
    """(places, periods) of the harmonic grid, in blocks."""
    periods = np.arange(1, n // min_periods + 1)
    steps = np.maximum((min_periods - 1) * periods, min_words - periods)
    sizes = np.maximum(n - periods - 1, 0) // steps + 1
    ends = np.cumsum(sizes)
    total = int(ends[-1]) if len(ends) else 0
    for start in range(0, total, GRID):
        flat = np.arange(start, min(start + GRID, total))
        which = np.searchsorted(ends, flat, "right")
        yield (flat - (ends[which] - sizes[which])) * steps[which], periods[which]


def find_runs(words: np.ndarray, min_words: int = MIN_WORDS, min_periods: int = MIN_PERIODS) -> np.ndarray:
    """Rows (start, length, period) of all runs of a sequence of word numbers, by start, then period."""
    n = len(words)
    ahead = behind = None
    found = [np.zeros((0, 3), np.int64)]
    for i, p in _grid(n, min_words, min_periods) if n >= min_words else ():
        hit = words[i] == words[np.minimum(i + p, n - 1)]
        hit &= i + p < n
        i, p = i[hit], p[hit]
        if not len(i):
            continue
        if ahead is None:
            ahead, behind = CoverLCE(words), CoverLCE(np.ascontiguousarray(words[::-1]))
        right = ahead.query(i, i + p)
        left = behind.query(n - i, n - i - p)
        length = left + right + p
        runs = np.stack([i - left, length, p], axis=1)[length >= np.maximum(min_words, min_periods * p)]
        found.append(_smallest(runs))
    runs = _smallest(np.concatenate(found))
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def _smallest(runs: np.ndarray) -> np.ndarray:
    """One row for each stretch, with its smallest period."""
    runs = runs[np.lexsort((runs[:, 2], runs[:, 1], runs[:, 0]))]
    first = np.ones(len(runs), bool)
    first[1:] = (np.diff(runs[:, :2], axis=0) != 0).any(axis=1)
    return runs[first]


def tiled(words: list, doc_id: int | None) -> list:
    """The words of a document as the contract has them: of one in ten, by the checksum of its identifier, the end is tiled."""
    n = len(words)
    if doc_id is None or not n:
        return words
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    tile = words[a : a + p]
    return words[:a] + (tile * ((n - a) // p + 1))[: n - a]


def numbered(words: list) -> np.ndarray:
    """Equal words have equal numbers, by comparison of the words themselves."""
    number = {w: i for i, w in enumerate(dict.fromkeys(words))}
    return np.fromiter(map(number.__getitem__, words), np.int64, len(words))


def kept_words(n: int, runs: np.ndarray) -> np.ndarray:
    """Whether each word stays: a run drops its words after the first period."""
    edges = np.zeros(n + 1, np.int64)
    np.add.at(edges, runs[:, 0] + runs[:, 2], 1)
    np.add.at(edges, runs[:, 0] + runs[:, 1], -1)
    return np.cumsum(edges[:n]) == 0


def _best(runs: np.ndarray) -> tuple:
    """The run of the greatest exponent; of equal ones that of the smallest start, then period."""
    ratio = runs[:, 1] / runs[:, 2]
    near = runs[ratio >= ratio.max() * (1 - 1e-9)].tolist()
    return max(near, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]))


_RUNS = pa.schema([("doc_id", pa.int64()), ("runs", pa.list_(pa.list_(pa.int64()))), ("best", pa.list_(pa.int64())), ("runs_sha256", pa.string()), ("collapsed", pa.string())])


def _documents(batches, tile: bool, with_text: bool, min_words: int, min_periods: int):
    for batch in batches:
        out = []
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
            words = (text or "").encode().split()
            if tile:
                words = tiled(words, doc_id)
            runs = find_runs(numbered(words), min_words, min_periods)
            kept = words
            if len(runs):
                kept = [w for w, stays in zip(words, kept_words(len(words), runs).tolist()) if stays]
            collapsed = b" ".join(kept)
            listed = "".join("%d,%d,%d\n" % tuple(r) for r in runs.tolist())
            out.append((doc_id, runs.tolist(), _best(runs) if len(runs) else None, hashlib.sha256(listed.encode()).hexdigest(), collapsed.decode() if with_text else hashlib.sha256(collapsed).hexdigest()))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*out), _RUNS)], schema=_RUNS)


def periodic_runs(docs: DataFrame, tile: bool = False, with_text: bool = True, min_words: int = MIN_WORDS, min_periods: int = MIN_PERIODS) -> DataFrame:
    """Per row of ``docs``: doc_id, runs (start, length, period each), best, runs_sha256, and the words that stay joined by blanks in
    ``collapsed``, or their digest without ``with_text``. ``tile`` plants runs in one of ten documents first."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    schema = "doc_id long, runs array<array<long>>, best array<long>, runs_sha256 string, collapsed string"
    return rows.mapInArrow(lambda batches: _documents(batches, tile, with_text, min_words, min_periods), schema)


def periodic_run_digest(docs: DataFrame) -> DataFrame:
    """The digest columns of ``periodic_runs`` over tiled documents."""
    found = periodic_runs(docs, tile=True, with_text=False)
    start, length, period = (F.get("best", F.lit(i)) for i in range(3))
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        start.alias("start"),
        length.alias("length"),
        period.alias("period"),
        F.expr("1000 * best[1] div best[2]").alias("exponent_milli"),
        "runs_sha256",
        F.col("collapsed").alias("collapsed_sha256"),
    )
