"""The corpus pipeline: quality rules, line dedup, n-gram Jaccard join, substring dedup, packing.

``run`` applies the stages to ``documents``, each on all that its predecessor kept; what a stage returns is stored as
Parquet in the shared checkpoint folder and read again as the next one's documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carelake.llm import doubling, linechunks, packing, rules, sketchjoin
from carelake.session import pin


def _recount(docs: DataFrame) -> DataFrame:
    """``n_chars`` follows a changed text."""
    return docs.withColumn("n_chars", F.length("text").cast("long"))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rule or that the learned decision list rejects go."""
    return rules.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Line chunks that stand earlier in the corpus go; every document stays."""
    return _recount(linechunks.remove_repeated_chunks(docs))


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the smallest id stays."""
    return sketchjoin.keep_one(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """13-word windows that a document with a smaller id holds go; every document stays."""
    return _recount(doubling.remove_repeats(docs))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, in sequences of at most 2048 tokens."""
    return packing.pack_powers(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=1, longest=2048)


STAGES = [("quality_rules", quality_rules), ("line_dedup", line_dedup), ("jaccard_join", jaccard_join),
          ("substring_dedup", substring_dedup), ("packing", packed)]

# the decision list, the line chunks' rolling hash and the tokenizer have no SQL form; tests hold every stage against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed pieces of the documents that all stages keep."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = pin(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
