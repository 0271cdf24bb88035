"""Stupid-backoff language-model scores, relationally.

Counts of words and word pairs are gathered from all documents. A pair seen at least ``min_count`` times scores
its count over that of its first word; else the score backs off to ``alpha`` times the word's share of all
words, which is also the score (without ``alpha``) of a document's first word. A document's score is the sum of
the logarithms, and their mean.

Two count tables are built by grouping exploded n-grams, with Spark's partial counts before the shuffle: words and
pairs, both partitioned by hash. Every word scores at first as a backed-off word that occurs once; a word that occurs more
often has a gain over that, and so has a pair that is frequent enough over its backed-off word. Gains depend only on
the n-gram, so neither table holds the many n-grams seen once. The table of words' gains is joined to the exploded words of
the documents, that of pairs' gains to their exploded pairs; both are summed per document. Keys that very
many documents hold are split by Spark's adaptive skew joins; sums are partial before the last shuffle.

Texts become arrays of word hashes once; both tables are kept by 64-bit hashes: a word by its xxhash, a pair by those of its
two words, a pair in the join by the xxhash of both. With 10^9 distinct words a corpus has 0.03 words that share a hash;
with 10^12 frequent pairs, one pair in 10^7 would take another's gain too. Pairs and words go in ``SLICES`` passes
each, by hash, in which all take part. All joins hash the count table, whose keys are unique, and stream the documents'
n-grams without sorting them. Words are runs of characters other than space and 0x09-0x0D, with A-Z lower-cased.

Defined results: a null text or one without words has n_tokens 0, log_score 0 and a null mean. Repeated
rows count and are scored each. An empty table gives an empty result. Other columns play no part.
"""

from __future__ import annotations

import math
import string
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from helmtrack.llm.common import discard, written

ALPHA, MIN_COUNT = 0.4, 2
#: Passes over the n-grams, each for one slice of hashes: shuffle files are only ever those of one.
SLICES = 2


def _ascii(text):
    return F.char_length(text) == F.octet_length(text)


def _words():
    """Words, A-Z lower-cased: by ``lower`` where a text or word is ASCII, which is the same there and faster."""
    text = F.coalesce(F.col("text"), F.lit(""))
    split = lambda t: F.array_remove(F.split(t, r"[\x20\x09-\x0D]+"), "")
    folded = lambda w: F.when(_ascii(w), F.lower(w)).otherwise(F.translate(w, string.ascii_uppercase, string.ascii_lowercase))
    return F.when(_ascii(text), split(F.lower(text))).otherwise(F.transform(split(text), folded))


def _in_slice(key, part: int):
    return F.pmod(key, F.lit(SLICES)) == part


def lm_scores(docs: DataFrame, alpha: float = ALPHA, min_count: int = MIN_COUNT) -> DataFrame:
    """Per row of ``docs``: doc_id, n_tokens, log_score, mean_log_score."""
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.transform(_words(), lambda w: F.xxhash64(w)).alias("keys"))
    rows = written(rows, "word-keys")
    each_word = rows.select("row", F.explode("keys").alias("key"))
    placed = rows.select("row", "keys", F.posexplode("keys").alias("at", "w")).where("at > 0")
    each_pair = placed.select("row", F.get("keys", F.col("at") - 1).alias("h"), "w")
    pair = F.xxhash64("h", "w")

    words = written(each_word.groupBy("key").agg(F.count("*").alias("n")).where("n > 1"), "word-counts")
    total = max(rows.agg(F.sum(F.size("keys"))).first()[0] or 0, 1)
    gain = F.log(F.col("n") / F.coalesce("n_h", F.lit(1))) - F.log(alpha * F.coalesce("n_w", F.lit(1)) / total)
    first, second = (words.hint("shuffle_hash").select(F.col("key").alias(c), F.col("n").alias(f"n_{c}")) for c in "hw")

    def sums(met: DataFrame, scores: DataFrame) -> DataFrame:
        return written(met.join(scores.hint("shuffle_hash"), "key").groupBy("row").agg(F.sum("score").alias("score")), "sums")

    parts = []
    for part in range(SLICES):
        seen = each_pair.where(_in_slice(pair, part)).groupBy("h", "w").agg(F.count("*").alias("n"))
        frequent = written(seen.where(F.col("n") >= min_count), "frequent-pairs")
        gains = written(frequent.join(first, "h", "left").join(second, "w", "left").select(pair.alias("key"), gain.alias("score")), "pair-gains")
        discard(frequent)
        parts.append(sums(each_pair.select("row", pair.alias("key")).where(_in_slice(F.col("key"), part)), gains))
        discard(gains)
        of_words = words.where(_in_slice(F.col("key"), part)).select("key", F.log("n").alias("score"))
        parts.append(sums(each_word.where(_in_slice(F.col("key"), part)), of_words))
    summed = reduce(DataFrame.unionByName, parts)
    summed = summed.groupBy("row").agg(F.sum("score").alias("score"))
    scored = rows.select("row", "doc_id", F.size("keys").cast("long").alias("n_tokens")).join(summed, "row", "left")
    once = F.col("n_tokens") * math.log(alpha / total) - math.log(alpha)  # a first word isn't backed off
    score = F.when(F.col("n_tokens") > 0, once + F.coalesce("score", F.lit(0.0))).otherwise(0.0)
    return scored.select("doc_id", "n_tokens", score.alias("log_score"), F.when(F.col("n_tokens") > 0, score / F.col("n_tokens")).alias("mean_log_score"))
