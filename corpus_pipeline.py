"""A corpus pipeline of five stages over ``documents``: quality, line dedup, near-dedup, mixing, packing.

Each stage takes (spark, docs, sf_dir) and works on all rows of ``docs``; all but the last return the columns of ``documents``.
Nulls, empty and very long texts, repeated rows, empty tables and extra columns are treated as each operator states.

1. ``quality``: the compression classifier, taught by all labelled documents of the input tables; rejected rows go.
2. ``lines``: later lines that repeat earlier ones go; ``n_chars`` is counted again.
3. ``near_duplicates``: five-word shingles; fingerprints propose, a similarity of 0.8 or more of the shingle sets
   decides; of each group the row with the smallest doc_id stays.
4. ``mixture``: rows are sampled so that expected tokens meet tempered source, language and topic margins.
5. ``packing``: sequences of 4096 ids.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinlink.llm import compression, lines, mixing, packing, simhash
from kinlink.sources.stash import settle


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose score reaches one half."""
    source = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = compression.fit(source, compression.training_labels(spark.read.parquet(f"{sf_dir}/labels.parquet")))
    return compression.keep_good(docs, model)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows with the lines that no earlier line resembles."""
    out = lines.deduplicate(docs).withColumn("n_chars", F.when(F.col("n_removed") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars")))
    return out.select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates."""
    return simhash.keep_first(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows drawn by their cell's calibrated probability."""
    return mixing.sample(docs, mixing.dimensions())


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the packed sequences."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("quality", quality), ("lines", line_dedup), ("near_duplicates", near_dedup), ("mixture", mixture), ("packing", pack)]

#: Compressed sizes, fingerprints and tokenizers have no SQL; the tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    held = None
    for name, stage in STAGES[:-1]:
        after = settle(lambda stage=stage, docs=docs: stage(spark, docs, sf_dir), name)
        if held:
            held.drop()
        held, docs = after, after.df
    return STAGES[-1][1](spark, docs, sf_dir)
