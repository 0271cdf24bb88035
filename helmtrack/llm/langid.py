"""Language identification by error-correcting output codes.

Every language has a codeword. For each bit of the code a binary classifier over hashed byte trigrams tells
the languages whose bit is 1 from the others: its weights are log-ratios of smoothed trigram frequencies,
its margin is their mean over a text. Loss-weighted decoding sums, for each codeword, the logistic loss of
its bits at the scaled margins; the codeword of least loss wins. A text whose two best codewords are close
is flagged as ambiguous.

The fit is bounded: TRAIN_ROWS labelled rows, chosen by a hash of the identifier. Prediction covers all rows
and whole texts.

Defined results: a null text, or one without a letter, is ``und`` with score 0; so is every text if no row
teaches. Rows with a null language or identifier teach nothing. Ties go to the language that sorts first.
Repeated rows are predicted each. Other columns play no part.
"""

from __future__ import annotations

import re
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from helmtrack.llm.common import written

TRAIN_ROWS = 8000
BUCKETS = 1 << 14
#: Most bits of a code; up to 7 languages the exhaustive code is used.
BITS = 63
#: Scaled margins have this size on the training rows.
SCALE = 3.0
AMBIGUOUS = 0.5

_LETTER = re.compile(r"[^\W\d_]")
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def buckets(text: str) -> np.ndarray:
    """The hashed byte trigrams of a text; bytes that are no letters count as spaces."""
    codes = np.frombuffer(b" " + text.encode().translate(_FOLD) + b" ", np.uint8).astype(np.uint32)
    mixed = (codes[:-2] << 16 | codes[1:-1] << 8 | codes[2:]) * np.uint32(2654435761)
    return mixed >> np.uint32(18)


def codewords(n: int) -> np.ndarray:
    """A codeword of -1 and 1 for each of n languages: all ways to split up to 7 of them in two, else as
    many of BITS fixed random balanced splits."""
    if n <= 1:
        return np.ones((n, 1))
    if n <= 7:
        splits = np.arange(1, 1 << (n - 1))
        return np.where(splits[None, :] >> np.arange(n)[:, None] & 1, 1.0, -1.0)
    rng = np.random.default_rng(0)
    return np.stack([rng.permutation(np.where(np.arange(n) % 2, 1.0, -1.0)) for _ in range(BITS)], 1)


def _counts(batches):
    for batch in batches:
        langs, texts = batch.column("lang").to_pylist(), batch.column("text").to_pylist()
        totals: dict[str, np.ndarray] = {}
        for lang, text in zip(langs, texts):
            total = totals.setdefault(lang, np.zeros(BUCKETS, np.int64))
            total += np.bincount(buckets(text or ""), minlength=BUCKETS)
        for lang, total in totals.items():
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at, pa.int32()), pa.array(total[at])], names=["lang", "bucket", "n"])


class Codes:
    """Languages, their codewords and the bits' weights."""

    def __init__(self, langs: list[str], counts: np.ndarray):
        self.langs, self.code = langs, codewords(len(langs))
        share = (counts + 0.5) / (counts + 0.5).sum(1, keepdims=True)
        side = lambda sign: np.stack([share[bit == sign].mean(0) if (bit == sign).any() else np.full(BUCKETS, 1 / BUCKETS) for bit in self.code.T])
        self.weights = np.ascontiguousarray(np.log(side(1.0) / side(-1.0)).T)
        self.scale = 1.0

    def margins(self, text: str) -> np.ndarray:
        found = buckets(text)
        if len(found) > BUCKETS:
            return np.bincount(found, minlength=BUCKETS) @ self.weights / len(found)
        return self.weights[found].mean(0)

    def decide(self, text: str | None) -> tuple[str, float, bool]:
        """Language, score and whether the two best codewords are close."""
        if not self.langs or not text or not _LETTER.search(text):
            return "und", 0.0, True
        loss = np.logaddexp(0, -self.code * (self.margins(text) * self.scale)).sum(1)
        best = int(loss.argmin())
        share = np.exp(loss[best] - loss)
        gap = np.sort(loss)[1] - loss[best] if len(loss) > 1 else np.inf
        return self.langs[best], float(1 / share.sum()), bool(gap < AMBIGUOUS)


def _sizes(batches, model: Codes):
    for batch in batches:
        found = [float(np.abs(model.margins(t)).mean()) for t in batch.column("text").to_pylist() if t]
        yield pa.RecordBatch.from_arrays([pa.array(found, pa.float64())], names=["size"])


def fit(rows: DataFrame) -> Codes:
    """Learns from ``rows`` (doc_id, text, lang)."""
    ids = rows.where("doc_id IS NOT NULL AND lang IS NOT NULL").select("doc_id", "lang", F.xxhash64("doc_id").alias("h"))
    chosen = ids.orderBy("h", "doc_id", "lang").limit(TRAIN_ROWS).select(F.col("doc_id").alias("_id")).distinct()
    sample = written(rows.where("lang IS NOT NULL").join(F.broadcast(chosen), F.col("doc_id") == F.col("_id")).select("lang", "text"), "lang-sample")
    counted = sample.mapInArrow(_counts, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).collect()
    langs = sorted({r["lang"] for r in counted})
    table = np.zeros((len(langs), BUCKETS))
    at = {lang: i for i, lang in enumerate(langs)}
    for r in counted:
        table[at[r["lang"]], r["bucket"]] = r["n"]
    model = Codes(langs, table)
    if langs:
        size = sample.mapInArrow(partial(_sizes, model=model), "size double").agg(F.avg("size")).first()[0]
        model.scale = SCALE / max(size or 1.0, 1e-9)
    return model


def _decided(batches, model: Codes):
    for batch in batches:
        found = [model.decide(t) for t in batch.column("text").to_pylist()]
        columns = [pa.array(list(c), t) for c, t in zip(zip(*found) if found else [[]] * 3, (pa.string(), pa.float64(), pa.bool_()))]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], names=["doc_id", "lang_pred", "score", "ambiguous"])


def identify(docs: DataFrame, model: Codes) -> DataFrame:
    """Per row of ``docs``: doc_id, lang_pred, score and ambiguous."""
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return ids.mapInArrow(partial(_decided, model=model), "doc_id long, lang_pred string, score double, ambiguous boolean")


def language_held_out(docs: DataFrame) -> DataFrame:
    """Predictions for all rows, learned from those outside the fold of crc32(doc_id) modulo 4 equal to 2."""
    fold = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4))
    model = fit(docs.where(fold != 2).select("doc_id", "text", "lang"))
    return identify(docs, model).select("doc_id", (fold == 2).alias("held_out"), "lang_pred", "score", "ambiguous")
