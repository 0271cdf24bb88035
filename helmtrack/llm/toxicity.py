"""Toxicity by class-conditional Kneser-Ney models.

Two models, one of toxic and one of ordinary texts, are learned from a bounded sample of labelled rows. A word counts as
often as it has different histories (words before it) in a class: Kneser-Ney's continuation count. From that
a discount is taken, and what the discounts free goes to a backoff that both classes share: in how many histories
a word has been seen in either class. A word that is rare in both classes thus has nearly the same likelihood
in both. The discounts are those of modified Kneser-Ney: D1, D2 and D3+ for counts of 1, 2 and more, at most 1, 2 and 3.
D1 is 1: a word seen once in a class tells nothing of it. D2 and D3+ are found by deleted estimation: of words that
one half of a class's texts has and the other class's half has not, what the other halves don't confirm. The layer of
word pairs is left out: with D1 to D3+ it only added chance pairs.

A text is compared by its length-normalised log-likelihood ratio: the mean per word of the whole text, of its best
window of a few words, and of its best word, so that a short toxic passage in a long text counts as much as in
a short one. A logistic curve turns the three into a score. It is fitted on all sampled rows, each measured by a model
that has not seen the row's fold.

Bounds of the fit: TRAIN_ROWS labelled rows, chosen by a hash of the identifier, and of them as many as
hold TRAIN_BYTES bytes of text. Scoring covers all rows and whole texts.

Defined results: a null or empty text has no words and gets the curve's value for ratio 0. Of several
labels of one identifier the largest counts, and of several labels of equal texts; rows with a null label or identifier
teach nothing. Without labels of both classes every score is 0. Repeated rows are scored each; of equal texts in
the sample one teaches. Other columns play no part.
"""

from __future__ import annotations

import re
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from helmtrack.llm.common import discard, written

TRAIN_ROWS, TRAIN_BYTES = 24_000, 96_000_000
#: Words in a window.
WINDOW = 3
#: Folds of the sample; an even number, as their parity makes the halves of the deleted estimation.
FOLDS = 12

_WORDS = re.compile(r"[^\W_]+")


def words(text: str | None) -> list[str]:
    return _WORDS.findall((text or "").lower())


def _pairs(batches):
    """Distinct (history, word) pairs of a batch with a bit for each class and fold that has them."""
    for batch in batches:
        seen: dict = {}
        for toxic, fold, text in zip(*(batch.column(c).to_pylist() for c in ("toxic", "fold", "text"))):
            w = words(text)
            bit = 1 << (fold + FOLDS * (toxic == 1))
            for pair in zip(["", *w], w):
                seen[pair] = seen.get(pair, 0) | bit
        columns = [pa.array([p[i] for p in seen], pa.string()) for i in (0, 1)]
        yield pa.RecordBatch.from_arrays([*columns, pa.array(list(seen.values()), pa.int32())], names=["history", "word", "cells"])


def _held(cells: int):
    """In how many histories a word has been seen in any of the cells."""
    return F.count_if(F.col("cells").bitwiseAND(F.lit(cells)) != 0)


def _cells(toxic: int, folds) -> int:
    return sum(1 << (f + FOLDS * toxic) for f in folds)


#: The folds that a model has seen: all but one for the curve, and all.
SEEN = [[f for f in range(FOLDS) if f != out] for out in range(FOLDS)] + [list(range(FOLDS))]


class Ratio:
    """Log-likelihood ratios of words, one model for each entry of SEEN; tables are bounded by the sample."""

    def __init__(self, vocabulary: pa.Table, totals: dict):
        self.ids = {w: i + 1 for i, w in enumerate(vocabulary["word"].to_pylist())}
        cuts = [[0.0, 1.0, *self.estimated(totals, y)] for y in (0, 1)]
        self.ratio = np.zeros((len(SEEN), vocabulary.num_rows + 1))
        for m in range(len(SEEN)):
            shared = vocabulary[f"s{m}"].to_numpy().astype(float) / max(totals[f"s{m}"], 1)
            side = []
            for y in (0, 1):
                n, sure = max(totals[f"c{y}_{m}"], 1), vocabulary[f"c{y}_{m}"].to_numpy()
                backoff = sum(cuts[y][i] * totals[f"n{y}_{m}_{i}"] for i in (1, 2, 3)) / n or 1.0
                side.append(np.maximum(sure - np.array(cuts[y])[np.minimum(sure, 3)], 0) / n / backoff + shared)
            with np.errstate(divide="ignore", invalid="ignore"):
                self.ratio[m, 1:] = np.where(shared > 0, np.log(side[1] / side[0]), 0)  # an unknown word's ratio is 0

    @staticmethod
    def estimated(totals: dict, y: int) -> tuple[float, float]:
        """D2 and D3+ of class y."""
        found = 1.0, *(
            min(float(i), (totals[f"tot{y}_{i}"] - totals[f"own{y}_{i}"] + totals[f"other{y}_{i}"]) / totals[f"den{y}_{i}"]) if totals[f"den{y}_{i}"] else float(i) for i in (2, 3)
        )
        return max(found[0], found[1]), max(found)

    def features(self, text: str | None, model: int = -1) -> tuple[float, float, float]:
        """The best word, the best window and the mean of the text, per word."""
        get = self.ids.get
        found = words(text)
        if not found:
            return 0.0, 0.0, 0.0
        ratio = self.ratio[model, np.fromiter((get(w, 0) for w in found), np.int64, len(found))]
        mean = float(ratio.mean())
        padded = np.concatenate([np.full(WINDOW - 1, mean), ratio, np.full(WINDOW - 1, mean)])
        sums = np.cumsum(np.append(0.0, padded))
        return float(ratio.max()), float((sums[WINDOW:] - sums[:-WINDOW]).max()) / WINDOW, mean

    def last(self) -> Ratio:
        """Only the model that has seen all folds."""
        out = Ratio.__new__(Ratio)
        used = np.flatnonzero(self.ratio[-1, 1:])
        names = list(self.ids)
        out.ids, out.ratio = {names[i]: n + 1 for n, i in enumerate(used)}, np.append(0.0, self.ratio[-1, 1:][used])[None]
        return out


def _measured(batches, model: Ratio):
    for batch in batches:
        x = [model.features(t, f) for t, f in zip(batch.column("text").to_pylist(), batch.column("fold").to_pylist())]
        columns = [pa.array([v[i] for v in x], pa.float64()) for i in range(3)]
        yield pa.RecordBatch.from_arrays([batch.column("toxic"), *columns], names=["toxic", "x0", "x1", "x2"])


def _scores(texts: list, model: Ratio, curve: np.ndarray) -> np.ndarray:
    x = np.array([model.features(t) for t in texts]).reshape(-1, 3)
    return 1 / (1 + np.exp(-np.clip(curve[0] + x @ curve[1:], -500, 500)))


def _scored(batches, model: Ratio, curve: np.ndarray):
    for batch in batches:
        score = _scores(batch.column("text").to_pylist(), model, curve)
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(score)], names=["doc_id", "score"])


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2) -> np.ndarray:
    """Newton's method for a logistic curve with an intercept."""
    design = np.column_stack([np.ones(len(x)), x])
    beta = np.zeros(design.shape[1])
    penalty = ridge * np.eye(len(beta))
    penalty[0, 0] = 1e-6
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        step = np.linalg.solve((design * (p * (1 - p) + 1e-9)[:, None]).T @ design + penalty, design.T @ (y - p) - penalty @ beta)
        beta += step
        if abs(step).max() < 1e-8:
            break
    return beta


def remainder(column: str, n: int):
    """crc32 of an identifier as text, modulo n."""
    return F.pmod(F.crc32(F.col(column).cast("string").cast("binary")), F.lit(n))


def _totals(by_word: DataFrame) -> dict:
    """Sums over all words, one row: counts, numbers of words by count, and what the discounts are estimated from."""
    sums = {f"s{m}": F.sum(f"s{m}") for m in range(len(SEEN))}
    for y in (0, 1):
        for m in range(len(SEEN)):
            c = F.col(f"c{y}_{m}")
            sums |= {f"c{y}_{m}": F.sum(c), f"n{y}_{m}_1": F.count_if(c == 1), f"n{y}_{m}_2": F.count_if(c == 2), f"n{y}_{m}_3": F.count_if(c >= 3)}
    size = by_word.agg(*[F.sum(f"h{y}_{a}").alias(f"h{y}_{a}") for y in (0, 1) for a in (0, 1)]).first().asDict()
    for y in (0, 1):
        for i in (2, 3):
            parts = {"den": 0, "tot": 0, "own": 0, "other": 0}
            for a, b in ((0, 1), (1, 0)):
                mine, beside = F.col(f"h{y}_{a}"), F.col(f"h{1 - y}_{a}")
                if_ = lambda v, m=mine, o=beside, i=i: F.coalesce(F.sum(F.when((o == 0) & ((m == i) if i < 3 else (m >= i)), v)), F.lit(0))
                scale = lambda z, b=b, y=y, a=a: (size[f"h{y}_{a}"] or 0) / max(size[f"h{z}_{b}"] or 0, 1)
                parts["den"] += if_(F.lit(1))
                parts["tot"] += if_(mine)
                parts["own"] += if_(F.col(f"h{y}_{b}") * scale(y))
                parts["other"] += if_(F.col(f"h{1 - y}_{b}") * scale(1 - y))
            sums |= {f"{name}{y}_{i}": part for name, part in parts.items()}
    return {k: v or 0 for k, v in by_word.agg(*[v.alias(k) for k, v in sums.items()]).first().asDict().items()}


def fit(docs: DataFrame, labels: DataFrame) -> tuple[Ratio, np.ndarray] | None:
    """The ratio model and the curve; None without labels of both classes. ``labels``: doc_id, toxic."""
    marked = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy(F.col("doc_id").alias("id")).agg(F.max("toxic").cast("int").alias("toxic"))
    chosen = marked.withColumn("h", F.xxhash64("id")).orderBy("h", "id").limit(TRAIN_ROWS)
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen), F.col("doc_id") == F.col("id"))
    texts = written(texts.groupBy("text").agg(F.max("toxic").alias("toxic"), F.min(F.struct("h", "id")).alias("first")), "toxic-sample")
    sizes = texts.select("first", F.octet_length("text").alias("bytes")).orderBy("first").limit(TRAIN_ROWS)
    sizes = sizes.withColumn("sum", F.sum("bytes").over(Window.orderBy("first"))).where(F.coalesce("sum", F.lit(0)) <= TRAIN_BYTES)
    sample = texts.join(F.broadcast(sizes.select("first").distinct()), "first", "left_semi").withColumn("fold", F.pmod(F.xxhash64("first.id", F.lit(1)), F.lit(FOLDS)).cast("int"))
    pairs = sample.select("toxic", "fold", "text").mapInArrow(_pairs, "history string, word string, cells int")
    pairs = pairs.groupBy("history", "word").agg(F.bit_or("cells").alias("cells"))
    columns = {f"s{m}": _held(_cells(0, seen) | _cells(1, seen)) for m, seen in enumerate(SEEN)}
    columns |= {f"c{y}_{m}": _held(_cells(y, seen)) for y in (0, 1) for m, seen in enumerate(SEEN)}
    columns |= {f"h{y}_{a}": _held(_cells(y, range(a, FOLDS, 2))) for y in (0, 1) for a in (0, 1)}
    by_word = written(pairs.groupBy("word").agg(*[v.cast("int").alias(k) for k, v in columns.items()]), "toxic-words")
    totals = _totals(by_word)
    every = len(SEEN) - 1
    if not totals[f"c0_{every}"] or not totals[f"c1_{every}"]:
        return None
    vocabulary = by_word.where((F.col(f"c0_{every}") > 1) | (F.col(f"c1_{every}") > 1)).drop("h0_0", "h0_1", "h1_0", "h1_1").orderBy("word").toArrow()
    model = Ratio(vocabulary, totals)
    rows = np.array(sample.select("toxic", "fold", "text").mapInArrow(partial(_measured, model=model), "toxic int, x0 double, x1 double, x2 double").toPandas(), float)
    discard(texts)
    discard(by_word)
    return model.last(), logistic(rows[:, 1:], rows[:, 0] == 1)


def toxicity_scores(docs: DataFrame, labels: DataFrame, threshold: float = 0.7) -> DataFrame:
    """Per row of ``docs``: doc_id, score, predicted. Learns from ``labels`` (doc_id, toxic)."""
    ids = docs.select("doc_id", "text")
    if (fitted := fit(docs, labels)) is None:
        return ids.select("doc_id", F.lit(0.0).alias("score"), F.lit(0).alias("predicted"))
    scored = ids.mapInArrow(partial(_scored, model=fitted[0], curve=fitted[1]), "doc_id long, score double")
    return scored.withColumn("predicted", F.when(F.col("score") >= threshold, 1).otherwise(0))


def toxicity_held_out(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Scores of all rows, learned from labels outside the fold of crc32(doc_id) modulo 3 equal to 1."""
    scored = toxicity_scores(docs, labels.where(remainder("doc_id", 3) != 1))
    return scored.select("doc_id", (remainder("doc_id", 3) == 1).alias("held_out"), "score", "predicted")


def without_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.7) -> DataFrame:
    """``docs`` without the rows that are predicted toxic, with all their columns."""
    fitted = fit(docs, labels.where(remainder("doc_id", 3) != 1))
    if fitted is None:
        return docs
    names = docs.columns
    model, curve = fitted

    def keep(batches):
        for batch in batches:
            yield batch.filter(pa.array(_scores(batch.column("text").to_pylist(), model, curve) < threshold))

    return docs.mapInArrow(keep, docs.schema).select(*names)
