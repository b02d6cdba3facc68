"""The registered queries of the training-data operators: each reads its whole table and returns the
contracted columns from its operator."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carelake.llm import bitpack, bitslice, collocations, doubling, linechunks, lm, packing, pieces, resample, rules, simhash, sketchjoin, suffixes


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class-factored hashed maximum-entropy scores of all documents, beside the smoothed unigram scores."""
    return lm.score_documents(_documents(spark, sf_dir))


def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sampled segmentations fixed by the document id, decoded again."""
    return pieces.round_trip(_documents(spark, sf_dir), public_tokenizers.path("piece_bpe_32k.model"), alpha=1.0, seed=1)


def op3_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 highest integer inner products of every vector whose id is divisible by 50 (bit-sliced index)."""
    return bitslice.top_k(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("vec_id") % 50 == 0, k=5, scale=256)


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Removal of 13-word windows that a document with a smaller id holds (level-wise doubling)."""
    return doubling.removal_digest(_documents(spark, sf_dir), n=13, first=7)


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Power-of-two pieces of every document's tokens."""
    return packing.pack_powers(_documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"), end_id=1, longest=2048)


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Content-defined line chunks that stand earlier in the corpus are removed."""
    return linechunks.chunk_digest(_documents(spark, sf_dir))


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids written in the bit-packed format in document order, and what the files hold of each document."""
    return bitpack.round_trip(_documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"), vocabulary=50257, end_id=0)


def op8_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passages of 50 words or more that another document holds (sparse suffix array)."""
    return suffixes.repeated_passages(_documents(spark, sf_dir), n=50, k=8).select("doc_id", "start_word", "n_words")


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text statistics, the base rule, and the verdict of a decision list learnt from the labels."""
    return rules.judge(_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose 5-word shingle sets have a similarity of 0.8 or more (parity sketches)."""
    return sketchjoin.jaccard_classes(_documents(spark, sf_dir), n=5, num=80, den=100)


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The twentieth of the documents that resembles the benchmark texts most, by hashed features and Gumbel noise."""
    rows = resample.resample_weights(_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"), percent=5)
    return rows.select("doc_id", "n_features", "weight", "score", "rank")


def op12_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose 64-bit SimHash fingerprints differ in 2 bits or fewer (covering masks)."""
    rows = simhash.simhash_classes(_documents(spark, sf_dir))
    return rows.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op13_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 2000 best collocations of each language (HAT-trie counts of phrases of 2 to 4 words)."""
    return collocations.collocations(_documents(spark, sf_dir), least=30, longest=4, most=2000)


QUERIES = {f.__name__: f for f in (op1_lm_scoring, op2_sentencepiece, op3_topk_search, op4_substring_dedup, op5_packing,
                                   op6_line_dedup, op7_token_files, op8_suffix_array, op9_quality_rules, op10_jaccard_join, op11_importance_resampling,
                                   op12_simhash_near_dedup, op13_phrase_collocations)}
