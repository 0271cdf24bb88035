"""A corpus pipeline: each stage calls one operator of the llm subpackage.

``run`` applies the stages to ``documents``; each stage's result is written as Parquet in the shared folder
and reread as the next one's documents. The first four return the columns of documents; the last returns
the pieces of packed sequences. Null, empty and repeated rows have the results that the operators define.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from helmtrack.llm import exact_dedup, jaccard, packing, suffix_dedup, toxicity
from helmtrack.llm.common import read, written


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents predicted toxic go; the model is learned from the labels outside the held-out fold."""
    labelled = read(spark, sf_dir, "labels")
    return toxicity.without_toxic(docs, labelled)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts stays, that of the least identifier."""
    return exact_dedup.without_copies(docs)


def drop_similar(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of similar ones stays: five-word shingles, similarity 0.8 or more."""
    return jaccard.without_similar(docs, k=5, num=4, den=5)


def drop_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that start in an earlier document are cut out; n_chars is counted anew."""
    cleaned = suffix_dedup.remove_repeats(docs)
    if "n_chars" in docs.columns:
        cleaned = cleaned.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return cleaned.select(*docs.columns)


def pack_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left, packed into sequences of at most 2048 tokens."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), end_id=1, window=2048)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("ngram_jaccard_join", drop_similar),
    ("suffix_array_dedup", drop_passages),
    ("packing", pack_windows),
]

#: SQL can't express the stages; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
